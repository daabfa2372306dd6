"""The report set as one job.

`TrialReports` binds the four input tables to an as-of date and builds every
report as a lazy DataFrame. `write_all` runs them: the event table is
written once as parquet to the output folder (a shared, reliable location),
and the chart tables read that written table instead of recomputing the
joins, which also cuts their lineage.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import resolve_asof
from ..operators import charts, counts, events
from ..operators.ranking import global_rank
from ..sinks import writers
from ..sources import events_file


def write_bars(bars: DataFrame, date_col: str, path: str) -> str | None:
    """The bar table of one date column as a file, or None if no study has
    that date in the window."""
    return writers.write_unless_empty(
        bars.where(F.col("date_column") == date_col).drop("date_column"), writers.write_csv, path,
        counted=F.col("count") > 0, order=counts.bar_order_columns(), single_file=True)


@dataclass
class TrialReports:
    studies: DataFrame
    sponsors: DataFrame
    interventions: DataFrame
    conditions: DataFrame
    asof: _dt.date | None = None
    timeline_months: int = C.TIMELINE_HORIZON_MONTHS
    bars_months: int = C.BARS_HORIZON_MONTHS
    table_months: int = C.TABLE_HORIZON_MONTHS
    _events: DataFrame | None = field(default=None, repr=False)

    def __post_init__(self):
        # one as-of day for every report of the run
        self.asof = resolve_asof(self.studies.sparkSession, self.asof)

    @classmethod
    def from_tables(cls, tables: Mapping[str, DataFrame], **kw) -> "TrialReports":
        return cls(tables["studies"], tables["sponsors"], tables["interventions"],
                   tables["conditions"], **kw)

    # --- counts -----------------------------------------------------------
    def phase_status_counts(self) -> DataFrame:
        return counts.phase_status_counts(self.studies)

    def phase_status_matrix(self, statuses=None) -> DataFrame:
        return counts.phase_status_matrix(self.studies, statuses)

    def phase_status_capped(self) -> DataFrame:
        return counts.phase_status_capped(self.studies)

    def timeline(self) -> DataFrame:
        return counts.upcoming_timeline(self.studies, self.asof, self.timeline_months)

    def timeline_long(self) -> DataFrame:
        return counts.timeline_long(self.timeline())

    def summary(self) -> DataFrame:
        return counts.study_summary(self.studies, self.asof, self.timeline_months, self.bars_months)

    def bars(self, date_col: str) -> DataFrame:
        return counts.upcoming_phase_status(self.studies, date_col, self.asof, self.bars_months)

    # --- events -----------------------------------------------------------
    def events(self) -> DataFrame:
        if self._events is not None:
            return self._events
        return events.upcoming_events(self.studies, self.sponsors, self.interventions,
                                      self.conditions, self.asof, self.table_months)

    def use_events(self, df: DataFrame) -> "TrialReports":
        """Base the chart tables on an already computed / written table."""
        self._events = df
        return self

    def events_ranked(self) -> DataFrame:
        return global_rank(self.events(), events.event_order_keys())

    # --- charts -----------------------------------------------------------
    def top_sponsor_phase(self, n=C.TOP_SPONSORS_DEFAULT, sponsors=None) -> DataFrame:
        return charts.top_sponsor_phase(self.events(), n, sponsors)

    def events_by_phase(self, sponsors=None) -> DataFrame:
        return charts.events_by_phase(self.events(), sponsors)

    def events_by_status(self, sponsors=None) -> DataFrame:
        return charts.events_by_status(self.events(), sponsors)

    def top_intervention_types(self, n=C.TOP_INTERVENTION_TYPES_DEFAULT, sponsors=None) -> DataFrame:
        return charts.top_intervention_types(self.events(), n, sponsors)

    def sponsor_list(self) -> DataFrame:
        return charts.sorted_sponsor_list(self.events())

    # --- the whole run ----------------------------------------------------
    def write_all(self, out_dir: str, sponsors=None, top_sponsors=C.TOP_SPONSORS_DEFAULT,
                  top_types=C.TOP_INTERVENTION_TYPES_DEFAULT) -> dict[str, str | None]:
        """Write every report under `out_dir`; returns name -> path (None
        where a report had no rows and was skipped)."""
        out = out_dir.rstrip("/")
        spark = self.studies.sparkSession
        written: dict[str, str | None] = {}

        # all count reports from one scan of the studies
        summary = writers.landed(self.summary())
        long = writers.landed(counts.counts_from_summary(summary))
        for name, df in (("phase_status", long), ("phase_status_matrix", counts.matrix_of(long)),
                         ("phase_status_capped", counts.with_cell_labels(counts.capped_of(long)))):
            written[name] = writers.write_csv(df, f"{out}/{name}", single_file=True)
        timeline = writers.landed(counts.timeline_from_summary(summary, self.asof, self.timeline_months))
        written["timeline"] = writers.write_csv(timeline, f"{out}/timeline", order=["month"], single_file=True)
        written["timeline_long"] = writers.write_csv(
            counts.timeline_long(timeline), f"{out}/timeline_long", single_file=True)
        # The three bar tables (3 x 36 rows); a date column without any row in
        # the window is skipped, not zero-filled.
        bars = writers.landed(counts.with_total_labels(counts.bars_from_summary(summary)))
        for date_col in C.DATE_COLUMNS:
            written[f"bars_{date_col}"] = write_bars(bars, date_col, f"{out}/bars/{date_col}")

        # The event table: parquet once, then CSV from it in final order.
        # The candidate studies feed four joins: they are landed first.
        candidates = spark.read.parquet(writers.write_parquet(
            events.upcoming_studies(self.studies, self.asof, self.table_months), f"{out}/candidates"))
        ev_path = writers.write_parquet(events.upcoming_events(
            self.studies, self.sponsors, self.interventions, self.conditions, self.asof,
            self.table_months, candidates=candidates), f"{out}/events_parquet")
        written["events_parquet"] = ev_path
        ev = events_file.read_events_parquet(spark, ev_path)
        written["events_csv"] = writers.write_events_csv(ev, f"{out}/events_csv")
        written["events_json"] = writers.write_json(
            ev, f"{out}/events_json", order=events.event_order_columns())
        # the display page: its own order, enrollment as text
        written["events_display"] = writers.write_csv(
            events.display_events(ev), f"{out}/events_display", order=events.page_order_columns())
        charted = TrialReports(self.studies, self.sponsors, self.interventions, self.conditions,
                               self.asof, self.timeline_months, self.bars_months,
                               self.table_months).use_events(ev)
        written["top_sponsor_phase"] = writers.write_csv(
            charted.top_sponsor_phase(top_sponsors, sponsors), f"{out}/top_sponsor_phase",
            single_file=True)
        written["events_by_phase"] = writers.write_csv(
            charted.events_by_phase(sponsors), f"{out}/events_by_phase", single_file=True)
        written["events_by_status"] = writers.write_csv(
            charted.events_by_status(sponsors), f"{out}/events_by_status", single_file=True)
        written["top_intervention_types"] = writers.write_csv(
            charted.top_intervention_types(top_types, sponsors),
            f"{out}/top_intervention_types", single_file=True)
        # one row per sponsor: grows with the data, so written in parallel
        written["sponsor_list"] = writers.write_csv(charted.sponsor_list(), f"{out}/sponsor_list")
        return written
