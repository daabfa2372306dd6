"""Declared schemas of the input and output tables, and a column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STUDIES = _struct(
    ("nct_id", _S),
    ("study_type", _S),
    ("phase", _S),
    ("overall_status", _S),
    ("brief_title", _S),
    ("enrollment", _I),
    ("enrollment_type", _S),
    ("last_update_posted_date", _D),
    ("start_date", _D),
    ("start_date_type", _S),
    ("primary_completion_date", _D),
    ("primary_completion_date_type", _S),
    ("completion_date", _D),
    ("completion_date_type", _S),
)

SPONSORS = _struct(("nct_id", _S), ("name", _S), ("lead_or_collaborator", _S))
INTERVENTIONS = _struct(("nct_id", _S), ("intervention_type", _S), ("name", _S))
CONDITIONS = _struct(("nct_id", _S), ("name", _S))

INPUTS = {
    "studies": STUDIES,
    "sponsors": SPONSORS,
    "interventions": INTERVENTIONS,
    "conditions": CONDITIONS,
}

# The upcoming-event table, in file order.
EVENTS = _struct(
    ("event_date", _D),
    ("event_type", _S),
    ("event_date_type", _S),
    ("nct_id", _S),
    ("title", _S),
    ("phase_std", _S),
    ("status", _S),
    ("enrollment", _I),
    ("enrollment_type", _S),
    ("lead_sponsor", _S),
    ("intervention_types", _S),
    ("interventions", _S),
    ("conditions", _S),
    ("last_update_posted_date", _D),
)
EVENT_COLUMNS = tuple(f.name for f in EVENTS.fields)


def require_columns(df: DataFrame, expected: Iterable[str], what: str = "input") -> DataFrame:
    """Fail, naming the sorted missing columns, unless all are present."""
    missing = set(expected) - set(df.columns)
    if missing:
        raise ValueError(f"Missing expected columns in {what}: {sorted(missing)}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of `schema`, in its order."""
    require_columns(df, schema.fieldNames())
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])
