"""Run every registered query and tabulate its final (adaptive) physical plan:
shuffles, broadcasts, join kinds, single-partition exchanges, cross products
and generators. Writes PLANS.md.

    python tools/plan_census.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trialscope.testing import registry  # noqa: E402
from trialscope.testing.session import local_session  # noqa: E402

NODES = {
    "scans": lambda n: n.startswith("Scan "),
    "sort_agg": lambda n: n == "SortAggregate",
    "shuffles": lambda n: n == "Exchange",
    "broadcasts": lambda n: n == "BroadcastExchange",
    "reused": lambda n: n == "ReusedExchange",
    "bhj": lambda n: n == "BroadcastHashJoin",
    "smj": lambda n: n == "SortMergeJoin",
    "cross": lambda n: n in ("CartesianProduct", "BroadcastNestedLoopJoin"),
    "generate": lambda n: n == "Generate",
    "window": lambda n: n == "Window",
    "take_ordered": lambda n: n == "TakeOrderedAndProject",
}
COLUMNS = ["build_jobs"] + list(NODES) + ["single_partition", "pushed_filters"]


def census(spark, df) -> dict:
    df.collect()  # results are small at the check scale; makes this plan final
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = plan.splitlines()
    # the tree of the final adaptive plan (or the only tree without AQE)
    if any("== Final Plan ==" in ln for ln in lines):
        a = next(i for i, ln in enumerate(lines) if "== Final Plan ==" in ln)
        b = next((i for i, ln in enumerate(lines) if "== Initial Plan ==" in ln), len(lines))
        tree = lines[a + 1:b]
    else:
        tree = plan.split("\n\n")[0].splitlines()
    nodes = {int(m.group(2)): m.group(1).strip()
             for ln in tree for m in [re.search(r"([A-Za-z][\w ]*?) \((\d+)\)", ln)] if m}
    out = dict.fromkeys(COLUMNS, 0)
    for name in nodes.values():
        for key, test in NODES.items():
            out[key] += bool(test(name) or test(name.split()[0]))
    for section in plan.split("\n\n"):
        head = section.strip().splitlines()[0] if section.strip() else ""
        m = re.match(r"\((\d+)\) ", head)
        if not m or int(m.group(1)) not in nodes:
            continue
        body = section.splitlines()
        args = "".join(ln for ln in body if ln.startswith("Arguments"))
        if nodes[int(m.group(1))].split()[0] == "Exchange" and ("SinglePartition" in args
                                                     or "hashpartitioning(0," in args):
            out["single_partition"] += 1
        out["pushed_filters"] += any(ln.startswith("PushedFilters") and ln.strip() != "PushedFilters: []"
                                     for ln in body)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out_md = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = local_session(8, scratch=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    rows = []
    for k, f in registry.queries().items():
        spark.sparkContext.setJobGroup(f"build-{k}", k)
        df = f(spark, sf_dir)
        built = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{k}"))
        try:
            c = census(spark, df) | {"build_jobs": built}
        except Exception as e:  # keep going; the row says why
            c = {"error": type(e).__name__}
        rows.append((k, c))
        print(k, c, flush=True)
    cols = COLUMNS
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Final adaptive plans after execution at `{sf_dir}` on `local[8]` (AQE on), from",
        "`tools/plan_census.py`. Counts of plan nodes in the plan tree of the final query",
        "(`build_jobs` are jobs run while building it: the matrix needs its columns, a rank its order",
        "columns, the round trips write first). `shuffles` are hash / range exchanges,",
        "`broadcasts` broadcast exchanges (AQE turns shuffle joins of small runtime sides",
        "into broadcast joins), `single_partition` exchanges into one partition: they",
        "occur only above results bounded by a category domain, a top-N or a partition",
        "count. `cross` (cartesian / nested-loop joins) must be 0 everywhere.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---" for _ in cols) + " |",
    ]
    for k, c in rows:
        lines.append(f"| `{k}` | " + " | ".join(str(c.get(x, "")) for x in cols) + " |")
    with open(out_md, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
