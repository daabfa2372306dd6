"""Sources: the four input tables (files or JDBC) and written event tables."""

from .csv_records import read_csv_records  # noqa: F401
from .events_file import read_events_csv, read_events_json, read_events_parquet  # noqa: F401
from .tables import (  # noqa: F401
    TABLE_NAMES,
    equi_depth_bounds,
    jdbc_bounds,
    nct_id_predicates,
    read_jdbc_tables,
    read_tables,
    run_sql,
    spread,
)
