"""Column expressions shared by all reports.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- categories -------------------------------------------------------------

def phase_std(raw: str | Column = "phase") -> Column:
    """Raw phase spelling -> one of the nine standard labels."""
    raw = col_of(raw)
    expr = None
    for label, spellings in C.PHASE_SPELLINGS.items():
        cond = raw.isin(*spellings)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.UNKNOWN_PHASE))


def status_std(raw: str | Column = "overall_status") -> Column:
    return F.coalesce(col_of(raw), F.lit(C.UNKNOWN_STATUS))


def category_rank(c: str | Column, order: Sequence[str]) -> Column:
    """1-based position of the value in `order`; null when absent, so that
    an ascending sort with nulls last puts unknown categories at the end."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), col_of(c))
    return F.nullif(pos, F.lit(0)).cast("int")


def event_rank(c: str | Column = "event_type") -> Column:
    return category_rank(c, C.EVENT_ORDER)


# --- text --------------------------------------------------------------------

def left_chars(c: str | Column, n: int) -> Column:
    """First n characters (code points), like SQL left()."""
    return F.left(col_of(c), F.lit(n))


_WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):04X}}}" for ch in C.JS_WHITESPACE) + "]"
_TRIM_PATTERN = f"^{_WS_CLASS}+|{_WS_CLASS}+$"


def js_clean(c: str | Column) -> Column:
    """null -> '', else the text with JavaScript white space trimmed from
    both ends (Spark's trim() only strips ASCII spaces)."""
    return F.coalesce(F.regexp_replace(col_of(c).cast("string"), _TRIM_PATTERN, ""), F.lit(""))


def or_unknown(c: Column, default: str = C.UNKNOWN_PHASE) -> Column:
    """'' -> default (JavaScript's `x || "Unknown"` on a cleaned string)."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def sponsor_key(c: str | Column = "lead_sponsor") -> Column:
    """Chart key of a sponsor: cleaned name, blank or null -> Unknown."""
    return or_unknown(js_clean(c))


def sorted_join(c: str | Column, sep: str) -> Column:
    """Aggregate: the non-null values (already distinct) in binary order joined
    by `sep`; null when there is none."""
    values = F.array_sort(F.collect_list(col_of(c)))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def format_count(c: str | Column) -> Column:
    """Integer with thousands separators; null -> ''."""
    return F.coalesce(F.format_number(col_of(c), 0), F.lit(""))


# --- dates -------------------------------------------------------------------

def resolve_asof(spark, asof: _dt.date | None) -> _dt.date:
    """A fixed as-of date: `asof` itself, or today's date in the session's
    time zone (one single-row job). Jobs made of several Spark queries use
    this so that all of them see the same day, even across midnight."""
    asof = C.check_asof(asof)
    if asof is not None:
        return asof
    return spark.range(1).select(F.current_date()).first()[0]


def asof_col(asof: _dt.date | None) -> Column:
    """The as-of date as a column: a literal, or current_date() when None."""
    asof = C.check_asof(asof)
    return F.current_date() if asof is None else F.lit(asof)


def window_end(asof: _dt.date | None, months: int) -> Column:
    """asof + n months (same day, clamped to the month's end)."""
    return F.add_months(asof_col(asof), C.check_months(months))


def in_window(d: str | Column, asof: _dt.date | None, months: int) -> Column:
    """Half-open window [asof, asof + n months); null dates are outside."""
    d = col_of(d)
    return (d >= asof_col(asof)) & (d < window_end(asof, months))


def month_of(d: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col_of(d), "MM")
