"""Relational operators of the reports, as DataFrame -> DataFrame functions."""

from .charts import (  # noqa: F401
    chart_view,
    events_by_phase,
    events_by_status,
    known_sponsors,
    sorted_sponsor_list,
    sponsor_list,
    top_intervention_types,
    top_sponsor_phase,
)
from .counts import (  # noqa: F401
    bars_from_summary,
    capped_of,
    counts_from_summary,
    landed_counts,
    matrix_of,
    matrix_columns,
    month_spine,
    phase_status_capped,
    phase_status_counts,
    phase_status_matrix,
    study_summary,
    timeline_from_summary,
    timeline_long,
    upcoming_bars_all,
    upcoming_counts,
    upcoming_phase_status,
    upcoming_timeline,
    with_cell_labels,
    with_total_labels,
)
from .events import (  # noqa: F401
    condition_summary,
    display_events,
    event_rows,
    intervention_summary,
    lead_sponsor_by_study,
    lead_sponsors,
    sort_events,
    upcoming_events,
    upcoming_studies,
)
from .ranking import checkpoint_dir, global_rank, small_rank  # noqa: F401
