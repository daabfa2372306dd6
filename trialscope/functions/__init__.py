"""Column-level building blocks (pure `pyspark.sql.functions` expressions)."""

from .columns import (  # noqa: F401
    asof_col,
    category_rank,
    event_rank,
    format_count,
    in_window,
    js_clean,
    left_chars,
    month_of,
    or_unknown,
    phase_std,
    sorted_join,
    sponsor_key,
    status_std,
    window_end,
)
