"""Snapshot stream: each landed manifest is reported at least once, and again only over its own output."""

import json
import os

from trialscope.sources import read_events_parquet
from trialscope.streaming.snapshots import report_each_snapshot

from . import golden as G


def test_each_snapshot_reported_once(spark, scratch):
    tables_dir = os.path.join(scratch, "snap1")
    for name, df in G.tables(spark).items():
        df.write.parquet(os.path.join(tables_dir, name))
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "snap1.json"), "w") as fh:
        json.dump({"snapshot_id": "snap1", "asof": G.ASOF.isoformat(), "tables": tables_dir}, fh)
    out = os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")

    q = report_each_snapshot(spark, landing, out, ckpt, available_now=True)
    q.awaitTermination(300)
    ev = read_events_parquet(spark, os.path.join(out, "snap1", "events_parquet"))
    assert ev.count() == len(G.EVENTS)

    # a second run with no new manifest does nothing
    q = report_each_snapshot(spark, landing, os.path.join(scratch, "out2"), ckpt, available_now=True)
    q.awaitTermination(300)
    assert not os.path.exists(os.path.join(scratch, "out2"))
