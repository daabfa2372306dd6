"""Count reports: phase x status counts and matrix, upcoming bars, timeline.

Each report is one scan of `studies` and one hash aggregation (partial
aggregation map-side, so hot keys collapse before the shuffle); the matrix
needs its columns and so runs that aggregation when it is built. A run of all
reports needs one scan for all of them: `study_summary` holds partial counts
from which each report is added up. Everything after the aggregation works on results whose size is bounded by the category
domains (9 phases x statuses) or the horizon (months + 1), so the small
joins below broadcast data of a known bound.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import columns as X
from .events import active, any_date_in_window, event_rows, interventional

# --- phase x status, all dates -------------------------------------------------


def phase_status_counts(studies: DataFrame) -> DataFrame:
    """Long form: (phase_std, status, n) over interventional studies."""
    return (interventional(studies)
            .groupBy(X.phase_std().alias("phase_std"), X.status_std().alias("status"))
            .agg(F.count(F.lit(1)).cast("int").alias("n")))


def matrix_columns(present, preferred=C.MATRIX_STATUS_ORDER) -> list[str]:
    """Preferred statuses that are present, then the others ascending."""
    present = set(present)
    return [s for s in preferred if s in present] + sorted(present - set(preferred))


def landed_counts(studies: DataFrame) -> DataFrame:
    """The long counts, computed by one job and held as a local relation: at
    most nine rows for each status that occurs. Several reports can be made
    from them without another scan."""
    counts = phase_status_counts(studies)
    return studies.sparkSession.createDataFrame(counts.collect(), counts.schema)


def matrix_of(counts: DataFrame, preferred=C.MATRIX_STATUS_ORDER) -> DataFrame:
    """Long counts as one row per phase present and one int column per status
    present: the preferred ones first, every other one after them. Missing
    cells are 0. Rows sort by phase label."""
    present = [r[0] for r in counts.select("status").distinct().collect()]
    statuses = matrix_columns(present, preferred)
    cell = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).cast("int").alias(s)
    return counts.groupBy("phase_std").agg(*[cell(s) for s in statuses]).orderBy("phase_std") if statuses else \
        counts.select("phase_std").distinct()


def phase_status_matrix(studies: DataFrame, statuses=None) -> DataFrame:
    """Wide form, from one scan. The columns are the statuses that occur;
    `statuses` sets their order only, so no study is ever left out."""
    return matrix_of(landed_counts(studies), C.MATRIX_STATUS_ORDER if statuses is None else statuses)


def phase_status_capped(studies: DataFrame, q: float = C.QUANTILE) -> DataFrame:
    """Dense long matrix with the colour ceiling: z95 is the exact q-quantile
    (linear interpolation) over all cells, zero cells included, truncated to
    int; n_capped = least(n, z95) while n keeps the true value."""
    return capped_of(interventional(studies).select(
        X.phase_std().alias("phase_std"), X.status_std().alias("status"), F.lit(1).alias("n")), q)


def capped_of(counts: DataFrame, q: float = C.QUANTILE) -> DataFrame:
    """The capped matrix of (phase_std, status, n) rows, which are added up.

    One aggregation to a row per status with a number for each of the nine
    phases; that row gives its nine cells. A phase without any study is left
    out, and the quantile is taken from the histogram of the cells' values.
    """
    per_status = counts.groupBy("status").agg(*[
        F.sum(F.when(F.col("phase_std") == p, F.col("n")).otherwise(0)).cast("int").alias(f"n{k}")
        for k, p in enumerate(C.PHASE_ORDER)])
    cells = per_status.select("status", F.inline(F.array(*[
        F.struct(F.lit(p).alias("phase_std"), F.col(f"n{k}").alias("n")) for k, p in enumerate(C.PHASE_ORDER)])))
    dense = (cells.withColumn("_phase", F.sum("n").over(Window.partitionBy("phase_std")))
             .where("_phase > 0").select("phase_std", "status", "n"))
    histogram = dense.groupBy("n").agg(F.count(F.lit(1)).alias("cells"))
    z = histogram.agg(F.floor(F.percentile("n", F.lit(q), F.col("cells"))).cast("int")).scalar()
    return (dense.withColumn("z95", z)
            .withColumn("n_capped", F.least("n", "z95")))


def with_cell_labels(matrix: DataFrame) -> DataFrame:
    """Adds each cell's count as display text (thousands separators)."""
    return matrix.withColumn("label", X.format_count("n"))


# --- upcoming bars -------------------------------------------------------------


def active_grid(spark) -> DataFrame:
    """The fixed 9 phases x 4 active statuses grid (36 rows)."""
    return (spark.range(1)
            .select(F.explode(F.array(*[F.lit(p) for p in C.PHASE_ORDER])).alias("phase_std"))
            .select("phase_std",
                    F.explode(F.array(*[F.lit(s) for s in C.ACTIVE_STATUSES])).alias("status")))


def upcoming_counts(studies: DataFrame, date_col: str, asof: _dt.date | None = None,
                    months: int = C.BARS_HORIZON_MONTHS) -> DataFrame:
    """Sparse counts of active studies whose `date_col` is in the window."""
    date_col = C.check_date_column(date_col)
    return (active(interventional(studies))
            .where(X.in_window(date_col, asof, months))
            .groupBy(X.phase_std().alias("phase_std"), X.status_std().alias("status"))
            .agg(F.count(F.lit(1)).cast("int").alias("n")))


def upcoming_phase_status(studies: DataFrame, date_col: str = "start_date",
                          asof: _dt.date | None = None,
                          months: int = C.BARS_HORIZON_MONTHS) -> DataFrame:
    """Dense 9 x 4 bars for one date column: (phase_std, status, count,
    phase_total), in phase then status order."""
    counts = upcoming_counts(studies, date_col, asof, months)
    # counts has at most 9 x 4 rows (phase domain x active statuses).
    dense = (active_grid(studies.sparkSession)
             .join(F.broadcast(counts), ["phase_std", "status"], "left")
             .select("phase_std", "status", F.coalesce("n", F.lit(0)).cast("int").alias("count")))
    per_phase = Window.partitionBy("phase_std")
    return (dense.withColumn("phase_total", F.sum("count").over(per_phase).cast("int"))
            .orderBy(*bar_order_columns()))


def _date_column(kind: str) -> Column:
    """The date column an event kind is read from."""
    pairs = [F.lit(x) for k, (d, _) in C.EVENT_SOURCES.items() for x in (k, d)]
    return F.create_map(*pairs)[F.col(kind)]


def upcoming_bars_all(studies: DataFrame, asof: _dt.date | None = None,
                      months: int = C.BARS_HORIZON_MONTHS) -> DataFrame:
    """The three bar tables from one scan: (date_column, phase_std, status,
    count, phase_total), dense 3 x 9 x 4, grouped on the unpivoted event kind."""
    base = (active(interventional(studies)).where(any_date_in_window(asof, months))
            .select(X.phase_std().alias("phase_std"), X.status_std().alias("status"),
                    *[c for pair in C.EVENT_SOURCES.values() for c in pair]))
    ev = event_rows(base, asof, months, carry=["phase_std", "status"])
    counts = (ev.groupBy("event_type", "phase_std", "status")
              .agg(F.count(F.lit(1)).cast("int").alias("n"))
              .select(_date_column("event_type").alias("date_column"), "phase_std", "status", "n"))
    return _dense_bars(counts)


def _dense_bars(counts: DataFrame) -> DataFrame:
    """Sparse (date_column, phase_std, status, n), at most 3 x 9 x 4 rows, as
    the full grid."""
    grid = (active_grid(counts.sparkSession)
            .select(F.explode(F.array(*[F.lit(d) for d in C.DATE_COLUMNS])).alias("date_column"),
                    "phase_std", "status"))
    dense = (grid.join(F.broadcast(counts), ["date_column", "phase_std", "status"], "left")
             .select("date_column", "phase_std", "status",
                     F.coalesce("n", F.lit(0)).cast("int").alias("count")))
    per_phase = Window.partitionBy("date_column", "phase_std")
    return dense.withColumn("phase_total", F.sum("count").over(per_phase).cast("int"))


def bar_order_columns():
    """Bars in phase order, then status order."""
    return [X.category_rank("phase_std", C.PHASE_ORDER), X.category_rank("status", C.ACTIVE_STATUSES)]


def with_total_labels(bars: DataFrame) -> DataFrame:
    """Adds the stack total as display text (thousands separators)."""
    return bars.withColumn("total_label", X.format_count("phase_total"))


# --- timeline ------------------------------------------------------------------


def month_spine(spark, asof: _dt.date | None, months: int) -> DataFrame:
    """Every month from month(asof) to month(asof + n months), both ends
    included: months + 1 rows."""
    start = X.month_of(X.asof_col(asof))
    end = X.month_of(X.window_end(asof, months))
    return spark.range(1).select(
        F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).alias("month"))


def upcoming_timeline(studies: DataFrame, asof: _dt.date | None = None,
                      months: int = C.TIMELINE_HORIZON_MONTHS) -> DataFrame:
    """Wide monthly timeline: (month, starts, primary_completions,
    completions) for active interventional studies, zero months kept."""
    months = C.check_months(months)
    base = (active(interventional(studies))
            .where(any_date_in_window(asof, months))
            .select(*[c for pair in C.EVENT_SOURCES.values() for c in pair]))
    ev = event_rows(base, asof, months, carry=[])
    counts = ev.groupBy(X.month_of("event_date").alias("month")).agg(
        *[F.count_if(F.col("event_type") == k).cast("int").alias(name)
          for k, name in C.TIMELINE_COLUMNS.items()])
    return _dense_timeline(counts, asof, months)


def _dense_timeline(counts: DataFrame, asof: _dt.date | None, months: int) -> DataFrame:
    """Counts by month, at most months + 1 rows, on the whole month spine."""
    names = list(C.TIMELINE_COLUMNS.values())
    return (month_spine(counts.sparkSession, asof, months)
            .join(F.broadcast(counts), "month", "left")
            .select("month", *[F.coalesce(n, F.lit(0)).cast("int").alias(n) for n in names])
            .orderBy("month"))


def timeline_long(timeline: DataFrame) -> DataFrame:
    """(month, event, count): one row per month and timeline column."""
    names = list(C.TIMELINE_COLUMNS.values())
    return timeline.unpivot("month", names, "event", "count")


# --- all count reports from one scan ----------------------------------------------


def study_summary(studies: DataFrame, asof: _dt.date | None = None,
                  timeline_months: int = C.TIMELINE_HORIZON_MONTHS,
                  bars_months: int = C.BARS_HORIZON_MONTHS) -> DataFrame:
    """Partial counts for the phase x status, timeline and bar reports, from
    one scan: (kind, phase_std, status, month, in_timeline, in_bars, n).

    A study counts once under the null kind (all dates) and once under each
    event kind whose date lies in a window, if its status is active. The rows
    are at most nine for each status, and for each month of the longer window
    3 kinds x 9 phases x 4 statuses x 3 pairs of flags; summaries of parts of the studies
    (snapshots, regions) add up.
    """
    day = lambda k: F.col(C.EVENT_SOURCES[k][0]).cast("date").alias("day")
    kinds = [F.struct(F.lit(None).cast("string").alias("kind"), F.lit(None).cast("date").alias("day"))]
    kinds += [F.struct(F.lit(k).alias("kind"), day(k)) for k in C.EVENT_ORDER]
    flag = lambda months: F.coalesce(X.in_window("day", asof, months), F.lit(False))
    rows = (interventional(studies)
            .select(X.phase_std().alias("phase_std"), X.status_std().alias("status"), F.inline(F.array(*kinds)))
            .withColumns({"in_timeline": flag(timeline_months), "in_bars": flag(bars_months)}))
    counted = F.col("status").isin(*C.ACTIVE_STATUSES) & (F.col("in_timeline") | F.col("in_bars"))
    return (rows.where(F.col("kind").isNull() | counted)
            .groupBy("kind", "phase_std", "status", X.month_of("day").alias("month"), "in_timeline", "in_bars")
            .agg(F.count(F.lit(1)).alias("n")))


def counts_from_summary(summary: DataFrame) -> DataFrame:
    """`phase_status_counts` from a summary (or the union of several)."""
    return (summary.where(F.col("kind").isNull()).groupBy("phase_std", "status")
            .agg(F.sum("n").cast("int").alias("n")))


def timeline_from_summary(summary: DataFrame, asof: _dt.date | None = None,
                          months: int = C.TIMELINE_HORIZON_MONTHS) -> DataFrame:
    """`upcoming_timeline` from a summary made with the same day and horizon."""
    counts = summary.where("in_timeline").groupBy("month").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("n"))).cast("int").alias(name)
          for k, name in C.TIMELINE_COLUMNS.items()])
    return _dense_timeline(counts, asof, C.check_months(months))


def bars_from_summary(summary: DataFrame) -> DataFrame:
    """`upcoming_bars_all` from a summary made with the same day and horizon."""
    return _dense_bars(summary.where("in_bars")
                       .groupBy(_date_column("kind").alias("date_column"), "phase_std", "status")
                       .agg(F.sum("n").cast("int").alias("n")))
