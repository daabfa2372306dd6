"""Operator 3 against brute force and its SQL."""

import re

import pytest

from trialscope.llm import licenses, oracles
from trialscope.testing.compare import compare, duck

from . import fixtures as fx

NOTICES = [t for _, t in licenses.TEMPLATES]


def pairs(text):
    words = re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()
    return set(zip(words, words[1:]))


def plain_scan(rows, least):
    out = set()
    for i, text in rows:
        units = [("line", k, x) for k, x in enumerate(text.split("\n"))]
        parts = re.split(r"\n[ \t\r]*\n", text)
        units += [("paragraph", k, x) for k, x in enumerate(parts) if "\n" in x]
        if len(parts) > 1:
            units.append(("text", 0, text))
        for unit, k, x in units:
            a, best = pairs(x), None
            for name, body in licenses.TEMPLATES:
                b = pairs(body)
                dice = 2 * len(a & b) / (len(a) + len(b))
                if a and dice >= least - 1e-9 and (best is None or (-dice, name) < best):
                    best = (-dice, name)
            if best:
                out.add((i, unit, k, best[1], round(-best[0], 9)))
    return out


def license_rows():
    texts = [None, "", "word", "\n\n", *NOTICES, *(t.upper().replace(" ", "\n\t", 3) for t in NOTICES),
             "Some prose.\n" + NOTICES[0] + "\nMore prose.", "a b\n\n" + NOTICES[6].replace(". ", ".\n") + "\n \nend",
             "\n\n".join(NOTICES[:3]), NOTICES[0] + " really", " ".join(NOTICES[2].split()[:30]),
             NOTICES[0].replace("Apache", "Apaché"), (NOTICES[1] + "\n") * 50]
    return [fx.row(k, t) for k, t in enumerate(texts)] + [fx.row(4, texts[4]), fx.row(None, NOTICES[0])]


@pytest.mark.parametrize("least", [0.8, 0.6, 1.0])
def test_scan(spark, least):
    rows = license_rows()
    got = licenses.license_scan(fx.docs(spark, rows), least).collect()
    want = plain_scan(fx.pairs(rows), least)
    assert {(r.doc_id, r.unit, r.unit_no, r.license, round(r.dice, 9)) for r in got} == want
    assert len(got) == len(want) and any(r[1] == "paragraph" for r in want)


def test_edge_table(spark):
    got = licenses.license_scan(fx.docs(spark)).collect()
    assert not got and licenses.license_scan(fx.docs(spark, [])).count() == 0


def test_main_path_is_native(spark):
    plan = licenses.license_scan(fx.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    got = licenses.license_scan(spark.read.parquet(f"{sf}/documents.parquet"))
    result = compare(got, duck(sf), oracles.license_scan(licenses.TEMPLATES, licenses.LEAST))
    assert result["ok"] and result["types_match"], result
