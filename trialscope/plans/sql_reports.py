"""Reports written as Spark SQL text (`spark.sql`) over the given tables.

The same plans as the DataFrame functions, for users who keep report
queries as SQL. Values are bound as named parameters; the only text that is
formatted in is a date column name, checked against the allow-list first.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..functions.sql_text import phase_case, sql_in_list, status_expr
from ..sources.tables import run_sql


def phase_status_counts_sql(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return run_sql(spark, tables, f"""
        SELECT {phase_case()} AS phase_std, {status_expr()} AS status,
               CAST(count(*) AS INT) AS n
        FROM {{studies}}
        WHERE study_type = :study_type
        GROUP BY 1, 2""", study_type=C.INTERVENTIONAL)


def upcoming_counts_sql(spark: SparkSession, tables: Mapping[str, DataFrame], date_col: str,
                        asof: _dt.date, months: int = C.BARS_HORIZON_MONTHS) -> DataFrame:
    """Sparse (phase_std, status, n) counts of active studies whose
    `date_col` lies in [asof, asof + months)."""
    date_col = C.check_date_column(date_col)
    return run_sql(spark, tables, f"""
        SELECT {phase_case()} AS phase_std, {status_expr()} AS status,
               CAST(count(*) AS INT) AS n
        FROM {{studies}}
        WHERE study_type = :study_type
          AND overall_status IN {sql_in_list(C.ACTIVE_STATUSES)}
          AND {date_col} >= :asof
          AND {date_col} < add_months(:asof, :months)
        GROUP BY 1, 2""", study_type=C.INTERVENTIONAL, asof=C.check_asof(asof),
                   months=C.check_months(months))
