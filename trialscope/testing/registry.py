"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query derives the four trial tables from the given star-schema tables
(fixture_views) and runs one report over them, whole, at as-of 1998-06-15.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import schemas
from ..operators import charts, counts, events, ranking
from ..plans import sql_reports
from ..plans.reports import write_bars
from ..sinks import layout, writers
from ..sources import events_file, read_tables
from . import oracles
from .fixture_views import trial_tables

ASOF = _dt.date.fromisoformat(oracles.ASOF)

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark, sf_dir):
    return trial_tables(spark, sf_dir)


def _events(spark, sf_dir, strategy="explode", months=C.TABLE_HORIZON_MONTHS,
            join_hint=None) -> DataFrame:
    t = _t(spark, sf_dir)
    return events.upcoming_events(t["studies"], t["sponsors"], t["interventions"],
                                  t["conditions"], ASOF, months, strategy, join_hint=join_hint)


def _event_rows(strategy):
    def run(spark, sf_dir):
        cand = events.upcoming_studies(_t(spark, sf_dir)["studies"], ASOF, C.TABLE_HORIZON_MONTHS)
        return events.event_rows(cand, ASOF, C.TABLE_HORIZON_MONTHS, strategy=strategy)
    return run


def _bars(date_col, months=C.BARS_HORIZON_MONTHS):
    def run(spark, sf_dir):
        return counts.upcoming_phase_status(_t(spark, sf_dir)["studies"], date_col, ASOF, months)
    return run


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's reliable checkpoint folder."""
    base = ranking.checkpoint_dir(spark).rstrip("/")
    return f"{base}/trialscope-out/{name}-{uuid.uuid4().hex}"


def _csv_roundtrip(spark, sf_dir):
    path = writers.write_events_csv(_events(spark, sf_dir), _scratch(spark, "events_csv"))
    return events_file.read_events_csv(spark, path)


def _round_sum(col) -> Column:
    """The exact sum of a long column, brought into a long's range by whole
    turns of 2^64: the plain sum as long as that fits. The halves of a value
    are summed apart, which 2^31 times as many rows cannot overflow."""
    low, whole = 24, lambda n: F.lit(str(n)).cast("decimal(20,0)")
    high = F.sum(F.shiftright(col, low)).cast("decimal(20,0)") * F.lit(1 << low)
    total = high + F.sum(col.bitwiseAND((1 << low) - 1)).cast("decimal(20,0)")
    return (F.pmod(total + whole(1 << 63), whole(1 << 64)) - whole(1 << 63)).cast("long")


def _tables_roundtrip(spark, sf_dir):
    """The four tables written and read back with `read_tables`: row, study
    and text counts and a sum over a hash of each row's values, in a long that
    goes round past its end (CSV for two, parquet for two; compressed, since
    the tables lie on disk whole)."""
    root, out = _scratch(spark, "tables"), []
    tables = _t(spark, sf_dir)
    for fmt, names in (("csv", ("studies", "sponsors")), ("parquet", ("interventions", "conditions"))):
        for name in names:
            if fmt == "csv":
                writers.write_csv(tables[name], f"{root}/{name}", compression="gzip")
            else:
                writers.write_parquet(tables[name], f"{root}/{name}.parquet", compression="zstd")
    back = (read_tables(spark, {n: f"{root}/{n}" for n in ("studies", "sponsors")}, "csv")
            | read_tables(spark, {n: f"{root}/{n}.parquet" for n in ("interventions", "conditions")}))
    for name, df in back.items():
        text = "brief_title" if name == "studies" else "name"
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns])
        hashed = F.conv(F.left(F.md5(F.encode(row, "UTF-8")), F.lit(12)), 16, 10).cast("long")
        out.append(df.agg(F.lit(name).alias("name"), F.count("*").alias("n"),
                          F.countDistinct("nct_id").alias("studies"), F.count(text).alias("texts"),
                          _round_sum(hashed).alias("checksum")))
    return reduce(DataFrame.unionByName, out)


def _bars_written(spark, sf_dir):
    """Bar tables written or skipped, at a day when all have rows and one when
    a date column has none."""
    studies, root, out = _t(spark, sf_dir)["studies"], _scratch(spark, "bars"), []
    for asof in (oracles.ASOF, oracles.LATE):
        bars = counts.upcoming_bars_all(studies, _dt.date.fromisoformat(asof))
        for date_col in C.DATE_COLUMNS:
            path = write_bars(bars, date_col, f"{root}/{asof}/{date_col}")
            rows = (spark.read.option("header", "true").schema("phase_std string, status string, count long, phase_total long")
                    .csv(path) if path else spark.createDataFrame([], "count long"))
            out.append(rows.agg(F.lit(asof).alias("asof"), F.lit(date_col).alias("date_column"),
                                F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.count("*").alias("written_rows")))
    return reduce(DataFrame.unionByName, out)


def _events_bucketed(spark, sf_dir):
    """The event table over tables bucketed by study id, joined without a
    shuffle of the three tables with many rows per study."""
    prefix = layout.write_bucketed(_t(spark, sf_dir), f"trial_{uuid.uuid4().hex}", 8)
    t = layout.read_bucketed(spark, prefix)
    return events.upcoming_events(t["studies"], t["sponsors"], t["interventions"], t["conditions"], ASOF,
                                  C.TABLE_HORIZON_MONTHS, join_hint="merge")


def _events_clustered(spark, sf_dir):
    """Event rows read from studies clustered by their three dates."""
    path = layout.write_clustered(_t(spark, sf_dir)["studies"], _scratch(spark, "clustered"), 16)
    cand = events.upcoming_studies(spark.read.schema(schemas.STUDIES).parquet(path), ASOF, C.TABLE_HORIZON_MONTHS)
    return events.event_rows(cand, ASOF, C.TABLE_HORIZON_MONTHS)


def _summary(spark, sf_dir):
    return counts.study_summary(_t(spark, sf_dir)["studies"], ASOF)


def _json_export(spark, sf_dir):
    ev = _events(spark, sf_dir)
    path = writers.write_json(ev, _scratch(spark, "events_json"), order=events.event_order_columns())
    return events_file.read_events_json(spark, path)


def queries() -> dict[str, Query]:
    return {
        "phase_status_counts": lambda s, d: counts.phase_status_counts(_t(s, d)["studies"]),
        "phase_status_matrix": lambda s, d: counts.phase_status_matrix(_t(s, d)["studies"]),
        "phase_status_matrix_explicit": lambda s, d: counts.phase_status_matrix(
            _t(s, d)["studies"], list(reversed(C.MATRIX_STATUS_ORDER))),
        "phase_status_capped": lambda s, d: counts.phase_status_capped(_t(s, d)["studies"]),
        "timeline_wide": lambda s, d: counts.upcoming_timeline(_t(s, d)["studies"], ASOF),
        "timeline_long": lambda s, d: counts.timeline_long(
            counts.upcoming_timeline(_t(s, d)["studies"], ASOF)),
        "timeline_month_start": lambda s, d: counts.upcoming_timeline(
            _t(s, d)["studies"], _dt.date.fromisoformat(oracles.MONTH_START)),
        "upcoming_bars_start": _bars("start_date"),
        "upcoming_bars_primary": _bars("primary_completion_date"),
        "upcoming_bars_completion": _bars("completion_date"),
        "upcoming_bars_sparse": _bars("start_date", 1),
        "upcoming_bars_all": lambda s, d: counts.upcoming_bars_all(_t(s, d)["studies"], ASOF),
        "phase_status_counts_sql": lambda s, d: sql_reports.phase_status_counts_sql(s, _t(s, d)),
        "upcoming_counts_sql": lambda s, d: sql_reports.upcoming_counts_sql(
            s, _t(s, d), "start_date", ASOF),
        "events_union": _event_rows("union"),
        "events_explode": _event_rows("explode"),
        "lead_sponsor": lambda s, d: events.lead_sponsor_by_study(
            _t(s, d)["studies"], _t(s, d)["sponsors"]),
        "intervention_summary": lambda s, d: events.intervention_summary(_t(s, d)["interventions"]),
        "condition_summary": lambda s, d: events.condition_summary(_t(s, d)["conditions"]),
        "upcoming_events": _events,
        "upcoming_events_6m": lambda s, d: _events(s, d, months=6),
        # the same plan with shuffle joins on the candidate ids
        "upcoming_events_shuffle": lambda s, d: _events(s, d, join_hint="merge"),
        "upcoming_events_ranked": lambda s, d: ranking.global_rank(
            _events(s, d), events.event_order_keys()),
        "upcoming_events_display": lambda s, d: events.display_events(_events(s, d)),
        "top_sponsor_phase": lambda s, d: charts.top_sponsor_phase(
            _events(s, d), oracles.TOP_SPONSORS_N),
        "top_sponsor_phase_filtered": lambda s, d: charts.top_sponsor_phase(
            _events(s, d), oracles.TOP_SPONSORS_N, oracles.FILTER_REQUEST),
        "events_by_phase": lambda s, d: charts.events_by_phase(_events(s, d)),
        "events_by_status": lambda s, d: charts.events_by_status(_events(s, d)),
        "top_intervention_types": lambda s, d: charts.top_intervention_types(
            _events(s, d), oracles.TOP_TYPES_N),
        "top_intervention_types_filtered": lambda s, d: charts.top_intervention_types(
            _events(s, d), oracles.TOP_TYPES_N, oracles.FILTER_REQUEST),
        "sponsor_list": lambda s, d: charts.sponsor_list(_events(s, d)),
        "upcoming_events_page_order": lambda s, d: ranking.global_rank(
            _events(s, d), events.page_order_keys()),
        "sponsor_list_sorted": lambda s, d: ranking.global_rank(
            charts.sponsor_list(_events(s, d)), charts.locale_order_columns()),
        "upcoming_bars_labels": lambda s, d: counts.with_total_labels(_bars("start_date")(s, d)),
        "top_sponsor_phase_json_request": lambda s, d: charts.top_sponsor_phase(
            _events(s, d), "12.9", C.parse_sponsor_request(None, " , ", oracles.JSON_REQUEST)),
        "phase_status_labels": lambda s, d: counts.with_cell_labels(
            counts.phase_status_capped(_t(s, d)["studies"])),
        "summary_phase_status": lambda s, d: counts.counts_from_summary(_summary(s, d)),
        "summary_timeline": lambda s, d: counts.timeline_from_summary(_summary(s, d), ASOF),
        "summary_bars": lambda s, d: counts.bars_from_summary(_summary(s, d)),
        "timeline_env_horizon": lambda s, d: counts.upcoming_timeline(
            _t(s, d)["studies"], ASOF, C.horizon_from_env(
                C.TIMELINE_HORIZON_ENV, C.TIMELINE_HORIZON_MONTHS, {C.TIMELINE_HORIZON_ENV: oracles.ENV_MONTHS})),
        "bars_written_or_skipped": _bars_written,
        "upcoming_events_bucketed": _events_bucketed,
        "events_clustered": _events_clustered,
        "tables_roundtrip": _tables_roundtrip,
        "events_csv_roundtrip": _csv_roundtrip,
        "events_json_export": _json_export,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracles()
