"""Sinks: CSV / JSON lines / parquet writers and skip-if-empty."""

from .layout import interleaved, read_bucketed, write_bucketed, write_clustered  # noqa: F401
from .writers import (  # noqa: F401
    write_csv,
    write_events_csv,
    write_json,
    write_parquet,
    write_unless_empty,
)
