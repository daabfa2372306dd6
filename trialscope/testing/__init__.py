"""Test scaffolding: the trial tables derived from the driver's test data,
and the DuckDB oracle SQL for every registered query."""
