"""Operator 3, notices that are no unit of their own, against brute force."""

import random
import re
import time

import duckdb
import pytest

from trialscope.llm import licenses

from . import fixtures as fx

MIT = next(t for name, t in licenses.TEMPLATES if name == "MIT" and len(t) > 500)
BSD2 = next(t for name, t in licenses.TEMPLATES if name == "BSD-2-Clause")
CODE = "\n\n".join(f"def function_{k}(value):\n    total = value * {k}\n    return total + {k}" for k in range(40))
PROSE = ("Thanks to all contributors for their patches. This project is licensed under the MIT License. "
         "Please open an issue before you send a large change, and add a test to it.")
MIT_HEADER = "Copyright 2020 The Authors\n\n" + MIT.replace(" The above", "\n\nThe above").replace(
    " THE SOFTWARE IS", "\n\nTHE SOFTWARE IS").replace(", ", ",\n") + "\n\n" + CODE
BSD_HEADER = BSD2.replace(" Redistributions", "\n\nRedistributions") + "\n\n" + CODE


def words_of(text):
    return re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()


def pairs_of(text):
    words = words_of(text)
    return list(zip(words, words[1:]))


def plain_passages(text, least, templates):
    """Every run of words that begins and ends at a template's bigram."""
    seq, found = pairs_of(text), set()
    for name, body in templates:
        b = set(pairs_of(body))
        longest = int((2 - least) / least * len(pairs_of(body)) + 1e-9)
        for i in range(len(seq)):
            if seq[i] in b:
                a, best = set(), None
                for j in range(i, min(i + longest, len(seq))):
                    a.add(seq[j])
                    dice = 2.0 * len(a & b) / (len(a) + len(b))
                    if seq[j] in b and (best is None or -dice < best[0]):
                        best = (-dice, name, i, j + 1)
                if best[0] <= -least + 1e-9:
                    found.add(best)
    kept = []
    for f in sorted(found):
        if all(f[3] < k[2] or k[3] < f[2] for k in kept):
            kept.append(f)
    return {(i, j, name, round(-worst, 9)) for worst, name, i, j in kept}


@pytest.mark.parametrize("text,license,first", [(PROSE, "MIT", 7), (MIT_HEADER, "MIT", 4), (BSD_HEADER, "BSD-2-Clause", 0)])
def test_a_notice_beside_other_text(spark, text, license, first):
    docs = fx.docs(spark, [fx.row(1, text)])
    assert licenses.license_scan(docs).count() == 0  # no unit is like a template
    (got,) = licenses.license_passages(docs).collect()
    assert (got.license, got.first_word, round(got.dice, 9)) == (license, first, 1.0)


@pytest.mark.parametrize("least,chunk", [(0.8, 4096), (0.8, 7), (0.6, 50), (1.0, 30)])
def test_passages(spark, least, chunk):
    rng = random.Random(7)
    vocabulary = [w for _, t in licenses.TEMPLATES for w in t.split()] + ["alpha", "beta"]

    def noisy(text):
        return " ".join(rng.choice(vocabulary) if rng.random() < 0.05 else w for w in text.split() if rng.random() > 0.04)

    notices = [t for _, t in licenses.TEMPLATES]
    texts = ["", "word", PROSE, MIT_HEADER[:1500], BSD_HEADER[:800], (notices[1] + " ") * 5, "x " * 40 + notices[0] * 2]
    texts += [" ".join([noisy(t), fx.prose(rng, 30), noisy(rng.choice(notices)), noisy(t)]) for t in notices]
    texts += [" ".join(rng.choices(vocabulary, k=120)) for _ in range(5)]
    rows = [fx.row(k, t) for k, t in enumerate(texts)] + [fx.row(2, PROSE), fx.row(2, notices[0]), fx.row(None, PROSE),
                                                          fx.row(99, None)]
    got = [(r.doc_id, r.first_word, r.last_word, r.license, round(r.dice, 9))
           for r in licenses.license_passages(fx.docs(spark, rows), least, chunk=chunk).collect()]
    want = [(i, *f) for i, t in {(r[0], r[1] or "") for r in rows} for f in plain_passages(t, least, licenses.TEMPLATES)]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) > 10


def test_passages_stay_native(spark):
    assert licenses.license_passages(fx.docs(spark, [])).count() == 0
    plan = licenses.license_passages(fx.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_many_equal_notices_in_one_text(spark):
    """Time follows the words, not their square."""
    text = "\n".join([MIT] * 80)
    begin = time.time()
    got = licenses.license_passages(fx.docs(spark, [fx.row(1, text)])).collect()
    assert time.time() - begin < 12
    assert len(got) == 80 and all(r.license == "MIT" and r.dice == 1.0 for r in got)


def test_the_second_version_of_a_licence_is_told_apart(spark):
    notice = next(t for name, t in licenses.TEMPLATES if name == "GPL-2.0" and len(t) > 100)
    (unit, passage) = sorted(licenses.license_notices(fx.docs(spark, [fx.row(1, notice)])).collect(), key=lambda r: r.unit)
    assert (unit.unit, unit.license, passage.unit, passage.license) == ("line", "GPL-2.0", "passage", "GPL-2.0")


def test_notices_are_units_and_passages(spark):
    rows = [fx.row(1, PROSE), fx.row(2, MIT_HEADER), fx.row(3, "x\n" + BSD2), fx.row(4, None)]
    docs = fx.docs(spark, rows)
    got = [tuple(r) for r in licenses.license_notices(docs).collect()]
    units = [(*r[:3], None, None, *r[3:]) for r in licenses.license_scan(docs).collect()]
    runs = [(r[0], "passage", None, *r[1:]) for r in licenses.license_passages(docs).collect()]
    assert sorted(got, key=str) == sorted(units + runs, key=str) and units and len(runs) == 3


def test_oracle_of_notices(spark, scratch):
    """The whole SQL, on the driver's documents and on noisy notices."""
    from trialscope.llm import oracles
    from trialscope.testing.compare import compare, duck
    sql = oracles.license_notices(licenses.TEMPLATES, licenses.LEAST)
    sf = "/root/testdata/sf0.001"
    result = compare(licenses.license_notices(spark.read.parquet(f"{sf}/documents.parquet")), duck(sf), sql)
    assert result["ok"] and result["types_match"], result
    rng = random.Random(3)
    notices = [t for _, t in licenses.TEMPLATES]
    noisy = lambda t: " ".join(w for w in t.split() if rng.random() > 0.05)
    rows = [(k, " ".join([noisy(t), fx.prose(rng, 20), noisy(rng.choice(notices)), noisy(t)])) for k, t in enumerate(notices)]
    rows += [(7, None), (8, PROSE), (8, PROSE), (9, MIT_HEADER[:1500]), (10, (notices[1] + " ") * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{scratch}/documents.parquet/*.parquet'")
    result = compare(licenses.license_notices(docs), con, sql)
    assert result["ok"], result
