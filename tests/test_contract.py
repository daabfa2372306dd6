"""The driver's contract: bench.py prints one JSON line; the entry module
exposes entry / queries / oracle_sql with matching keys."""

import json
import os
import subprocess
import sys

import pytest

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1",
               BENCH_CPUS="2", BENCH_QUERIES="phase_status_counts,upcoming_events",
               TRIALSCOPE_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"phase_status_counts", "upcoming_events"}


def test_entry_module_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert all(callable(f) for f in E.queries().values())
    assert all(isinstance(s, str) and s.strip().upper().startswith(("WITH", "SELECT"))
               for s in E.oracle_sql().values())


@pytest.mark.parametrize("blocked,alone", [("sentencepiece", True), ("corpus_pipeline", True), ("trialscope.llm", True),
                                           ("trialscope.sinks", None), ("json", None)])
def test_reports_work_without_the_optional_part(blocked, alone):
    """A missing optional module leaves the reports; any other one is an error."""
    code = (f"import sys\nsys.path.insert(0, {ROOT!r})\n"
            "class Block:\n"
            "    def find_spec(self, name, *a):\n"
            f"        if name == {blocked!r}:\n            raise ModuleNotFoundError('no ' + name, name=name)\n"
            f"sys.modules.pop({blocked!r}, None)\nsys.meta_path.insert(0, Block())\n"
            "import warnings; warnings.simplefilter('ignore')\n"
            "import __spark_entry__ as E\n"
            "print(len(E.queries()), any(k.startswith('op') for k in E.queries()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
    if alone:
        n, corpus = out.stdout.split()
        assert int(n) >= 38 and corpus == "False"
    else:
        assert out.returncode != 0 and "ModuleNotFoundError" in out.stderr
