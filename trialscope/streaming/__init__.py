"""Streaming entry points.

The reports are one-shot batch queries over a snapshot of the registry; they
keep no state across runs. What streams is the arrival of snapshots: see
`snapshots.report_each_snapshot`.
"""
