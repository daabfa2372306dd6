"""Chart tables over the upcoming-event table.

They count event rows (a study with two milestones in the window counts
twice). Ties in a top-N break by first appearance in the event table's own
order (date, event kind, study id, place in a list), so no step depends on row
order in a partition.

First appearance is found in two steps. Day and event kind pack into one long
that keeps their order, so counting a key and finding its first day and kind is
a single hash aggregation. Ids only matter between keys that tie there: a
second pass reads the rows of those keys on that day and kind alone and takes
the least id (a per-task limit of one row a key before the shuffle). Which keys
can reach a top N is decided by the N-th best of the first step, so no key that
could is left out.

A sponsor selection is part of the plan: the rows are counted with a flag
"requested", and the counts without it go if any has it. Names that do not
occur therefore count for nothing, and no job runs while a chart is built.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import columns as X
from .ranking import small_rank

# Order keys: count (31 bits) above day and kind (28 bits; dates of years 1 to
# 9999 need 24, with a kind in 0..4).
_KINDS = 5
_SEEN_BITS = 28
_NO_DAY = -1_000_000  # before year 1: a missing date comes first


def first_seen(date="event_date", kind="event_type") -> Column:
    """Day and event kind as one long, in their order (unknown kinds last)."""
    rank = F.coalesce(X.event_rank(kind), F.lit(len(C.EVENT_ORDER) + 1))
    return F.coalesce(F.unix_date(date), F.lit(_NO_DAY)).cast("long") * _KINDS + rank


def _requested(sponsors) -> Column:
    """Whether the row's sponsor is one of the names asked for."""
    names = C.ordered_unique(C.as_name_list(sponsors))
    return X.sponsor_key("lead_sponsor").isin(names) if names else F.lit(False)


def _only_requested(counts: DataFrame) -> DataFrame:
    """The counts of requested rows, or all of them if none was found."""
    return counts.where(F.col("asked") == counts.agg(F.coalesce(F.max("asked"), F.lit(False)).alias("a")).scalar())


def _with_first_id(counts: DataFrame, rows: DataFrame, key: str, place: Iterable[str] = ()) -> DataFrame:
    """`counts` with the id (and list place) of each key's first row: only
    rows on the key's first day and kind are looked at."""
    order = ["nct_id", *place]
    first = (rows.join(counts, [key, "asked", "seen"])
             .withColumn("first", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
             .where("first = 1"))
    return first.drop("first")


def _top(counts: DataFrame, rows: DataFrame, key: str, count: str, n: int, place: Iterable[str] = ()) -> DataFrame:
    """The n keys of largest count, ties by first appearance, with rank rk.
    `counts` has a row a key: key, asked, count, seen (its first day and kind)."""
    counts = counts.withColumn("order", F.shiftleft(-F.col(count).cast("long"), _SEEN_BITS) + F.col("seen"))
    last = counts.orderBy("order").limit(n).agg(F.max("order")).scalar()  # the n-th best, ids aside
    order = ["order", "nct_id", *place]
    top = _with_first_id(counts.where(F.col("order") <= last), rows, key, place).orderBy(*order).limit(n)
    return small_rank(top, order)  # n rows


def known_sponsors(events: DataFrame, requested: Iterable[str]) -> list[str]:
    """The requested sponsor keys that occur in the events.

    One small action whose result is bounded by the request itself.
    """
    names = C.as_name_list(requested)
    if not names:
        return []
    found = (events.select(X.sponsor_key("lead_sponsor").alias("sponsor"))
             .where(F.col("sponsor").isin(names)).distinct().collect())
    present = {r[0] for r in found}
    return [n for n in C.ordered_unique(names) if n in present]


def chart_view(events: DataFrame, sponsors=None) -> DataFrame:
    """Events restricted to a sponsor selection, as one lazy plan.

    `sponsors` is None, a comma-separated text or a list of names. Only the
    names that occur in the data count; if none is left (or none was given)
    all rows stay.
    """
    if not C.as_name_list(sponsors):
        return events
    asked = _requested(sponsors)
    return events.where(asked | ~events.where(asked).exists())


def top_sponsor_phase(events: DataFrame, n=C.TOP_SPONSORS_DEFAULT, sponsors=None) -> DataFrame:
    """Top-n sponsors by event rows, each with its count in every standard
    phase (dense n x 9, zero-filled): (sponsor, phase_std, n, total, rk)."""
    top_n = C.clamp_top_n(n, C.TOP_SPONSORS_DEFAULT, C.TOP_SPONSORS_MAX)
    phase = X.or_unknown(X.js_clean(F.coalesce("phase_std", F.lit(C.UNKNOWN_PHASE))))
    rows = events.select(X.sponsor_key("lead_sponsor").alias("sponsor"), _requested(sponsors).alias("asked"),
                         phase.alias("phase"), first_seen().alias("seen"), "nct_id")
    # one pass: a row per sponsor with its total (every phase counts there,
    # also labels outside the nine) and a number for each standard phase
    totals = _only_requested(rows.groupBy("sponsor", "asked").agg(
        F.count(F.lit(1)).cast("int").alias("total"), F.min("seen").alias("seen"),
        *[F.count_if(F.col("phase") == p).cast("int").alias(f"n{k}") for k, p in enumerate(C.PHASE_ORDER)]))
    top = _top(totals, rows.select("sponsor", "asked", "seen", "nct_id"), "sponsor", "total", top_n)  # <= 50 rows
    return top.select("sponsor", F.inline(F.array(*[
        F.struct(F.lit(p).alias("phase_std"), F.col(f"n{k}").alias("n")) for k, p in enumerate(C.PHASE_ORDER)])),
        "total", F.col("rk").cast("int").alias("rk")).select("sponsor", "phase_std", "n", "total", "rk")


def _count_by(events: DataFrame, column: str, preferred, sponsors) -> DataFrame:
    key = X.js_clean(column)  # null -> ''
    rows = events.select(key.alias(column), _requested(sponsors).alias("asked"), first_seen().alias("seen"), "nct_id")
    # One row per distinct category value.
    counts = _only_requested(rows.groupBy(column, "asked").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.min("seen").alias("seen")))
    place = X.category_rank(column, preferred)
    # the preferred values have their places; first appearance orders the others
    other = rows.where(place.isNull()).select(column, "asked", "seen", "nct_id")
    others = _with_first_id(counts.where(place.isNull()), other, column)
    every = counts.where(place.isNotNull()).withColumn("nct_id", F.lit(None).cast("string")).unionByName(others)
    return (small_rank(every, [place.asc_nulls_last(), "seen", "nct_id"])
            .select(column, "n", F.col("rk").cast("int").alias("rk")))


def events_by_phase(events: DataFrame, sponsors=None) -> DataFrame:
    """Event rows per phase: standard phases present first (in order), then
    the others by first appearance."""
    return _count_by(events, "phase_std", C.PHASE_ORDER, sponsors)


def events_by_status(events: DataFrame, sponsors=None) -> DataFrame:
    """Event rows per status, in the chart's preferred status order."""
    return _count_by(events, "status", C.CHART_STATUS_ORDER, sponsors)


def top_intervention_types(events: DataFrame, n=C.TOP_INTERVENTION_TYPES_DEFAULT,
                           sponsors=None) -> DataFrame:
    """Top-n intervention types, counting each listed type once per event
    row (the list is split on ',' and trimmed; blanks dropped); ties by first
    appearance (row, then place in the list)."""
    top_n = C.clamp_top_n(n, C.TOP_INTERVENTION_TYPES_DEFAULT, C.TOP_INTERVENTION_TYPES_MAX)
    raw = X.js_clean("intervention_types")
    parts = (events.select("nct_id", first_seen().alias("seen"), _requested(sponsors).alias("asked"),
                           F.posexplode(F.split(raw, ",")).alias("pos", "part"))
             .select(X.js_clean("part").alias("intervention_type"), "asked", "seen", "nct_id", "pos"))
    # blanks are counted too (a requested sponsor may have nothing else), then dropped
    counts = _only_requested(parts.groupBy("intervention_type", "asked").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.min("seen").alias("seen"))).where(F.col("intervention_type") != "")
    return (_top(counts, parts, "intervention_type", "n", top_n, ["pos"])  # <= 100 rows
            .select("intervention_type", "n", F.col("rk").cast("int").alias("rk")))


def sponsor_list(events: DataFrame) -> DataFrame:
    """Distinct sponsor keys (blank -> Unknown)."""
    return events.select(X.sponsor_key("lead_sponsor").alias("sponsor")).distinct()


def locale_order_columns():
    """Locale order of sponsor keys (ICU root collation: a < A < b)."""
    return [F.collate("sponsor", "UNICODE"), F.col("sponsor")]


def sorted_sponsor_list(events: DataFrame) -> DataFrame:
    """Sponsor keys in locale order."""
    return sponsor_list(events).orderBy(*locale_order_columns())
