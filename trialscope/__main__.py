"""Run the whole report set: `python -m trialscope --out DIR (--tables DIR | --jdbc-url URL)`.

Under spark-submit the session comes from the submit configuration; the
horizons default to the TIMELINE_HORIZON_MONTHS, UPCOMING_HORIZON_MONTHS and
UPCOMING_TABLE_HORIZON_MONTHS environment variables.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from . import config as C


def parse_args(argv):
    p = argparse.ArgumentParser(prog="trialscope", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder holding studies/, sponsors/, interventions/, conditions/")
    src.add_argument("--jdbc-url", help="e.g. jdbc:postgresql://host:5432/db?sslmode=require")
    p.add_argument("--format", default="parquet", help="file format of --tables (parquet, csv, orc, ...)")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="reader option of --format; csv reads a header, quotes and multi-line fields by default")
    p.add_argument("--snapshot", default=None, help="read only this partition of tables kept by snapshot")
    p.add_argument("--jdbc-schema", default=None)
    p.add_argument("--jdbc-bounds", default="", help="comma list of nct_id split points for parallel reads")
    p.add_argument("--jdbc-parts", type=int, default=0, help="derive the split points: ranges of about equal size")
    p.add_argument("--jdbc-one-connection", action="store_true", help="read each table in one task")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    p.add_argument("--asof", default=None, help="YYYY-MM-DD; default: today in the session time zone")
    p.add_argument("--timeline-months", type=int,
                   default=C.horizon_from_env(C.TIMELINE_HORIZON_ENV, C.TIMELINE_HORIZON_MONTHS))
    p.add_argument("--bars-months", type=int,
                   default=C.horizon_from_env(C.BARS_HORIZON_ENV, C.BARS_HORIZON_MONTHS))
    p.add_argument("--table-months", type=int,
                   default=C.horizon_from_env(C.TABLE_HORIZON_ENV, C.TABLE_HORIZON_MONTHS))
    p.add_argument("--sponsors", default=None, help="comma list of sponsors for the chart tables")
    p.add_argument("--sponsor-request", default=None, metavar="JSON",
                   help='stored request, e.g. {"sponsors": ["A", "B"]}; --sponsors comes first')
    p.add_argument("--top-sponsors", default=C.TOP_SPONSORS_DEFAULT)
    p.add_argument("--top-intervention-types", default=C.TOP_INTERVENTION_TYPES_DEFAULT)
    return p.parse_args(argv)


def main(argv=None, spark=None) -> dict:
    from pyspark.sql import SparkSession

    from .plans.reports import TrialReports
    from .sources import jdbc_bounds, read_jdbc_tables, read_tables

    a = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("trialscope").getOrCreate()
    if a.tables:
        tables = read_tables(spark, a.tables, fmt=a.format,
                             options=dict(o.split("=", 1) for o in a.option), snapshot=a.snapshot)
    else:
        props = {"user": os.environ.get("TRIALSCOPE_JDBC_USER", ""),
                 "password": os.environ.get("TRIALSCOPE_JDBC_PASSWORD", "")}
        bounds = [b.strip() for b in a.jdbc_bounds.split(",") if b.strip()]
        if a.jdbc_parts and not bounds:
            bounds = jdbc_bounds(spark, a.jdbc_url, props, a.jdbc_parts, a.jdbc_schema)
        tables = read_jdbc_tables(spark, a.jdbc_url, props, a.jdbc_schema, bounds,
                                  one_connection=a.jdbc_one_connection)
    rep = TrialReports.from_tables(tables, asof=a.asof, timeline_months=a.timeline_months,
                                   bars_months=a.bars_months, table_months=a.table_months)
    written = rep.write_all(a.out, sponsors=C.parse_sponsor_request(a.sponsors, None, a.sponsor_request), top_sponsors=a.top_sponsors,
                            top_types=a.top_intervention_types)
    print(json.dumps({"asof": str(rep.asof), "written": written}))
    return written


if __name__ == "__main__":
    main()
