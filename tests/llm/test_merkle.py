"""Operator 12 against a plain recursive version."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from trialscope.llm import merkle, oracles
from trialscope.testing.compare import compare, duck

from . import fixtures as fx

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, at long, tree string, digest binary, total int"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, k):
    """(digests before, after) on each level."""
    out = []
    for level in levels[:-1]:
        run = level[k // 16 * 16:k // 16 * 16 + 16]
        out.append(("".join(run[:k % 16]), "".join(run[k % 16 + 1:])))
        k //= 16
    return out


def plain(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[3]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in order:
        trees[s].sort(key=lambda x: x[:3])
        built[s] = levels_of([x[2] for x in trees[s]])
    top = levels_of([built[s][-1][0] for s in order])
    out = Counter()
    for n, s in enumerate(order):
        for k, (_, _, mine, r) in enumerate(trees[s]):
            path = siblings(built[s], k) + siblings(top, n)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r[0], lowered(r[1]), *r[2:5]) if changed else mine
            for a, b in path:
                folded = h(a + folded + b)
            root = top[-1][0]
            out[r[0], mine, built[s][-1][0], root, h("".join(a + b for a, b in path)), folded, folded == root] += 1
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "t", b"d", 2) for r in rows], SCHEMA).repartition(7)


def many(n, sources, seed=0):
    rng = random.Random(seed)
    return [(k * 3, f"Text {k} é " + "Ab" * rng.randint(0, 5), rng.choice(["en", None]), rng.choice(sources), k) for k in range(n)]


CASES = {
    "empty": [],
    "one": [(5, "A", None, None, None)],
    "a lone leaf beside a tree": many(20, ["a"]) + [(1000, "X", "en", "b", 1)],
    "sixteen": many(16, ["s"]),
    "seventeen": many(17, ["s"]),
    "a block": many(256, ["s"]),
    "a block and one": many(257, ["s"]),
    "several tiers": many(5000, ["hot"] * 9 + ["a", "b", None]),
    "a source each": [(k, f"T{k}", "en", f"s{k}", 1) for k in range(300)],
    "odd": [(1, None, None, "", None), (1, None, None, "", None), (1, "B", None, "", None), (None, "C", "x", None, 3),
            (None, "C", "x", None, 3), (2, "", "é", "é", -1), (3, "D" * 9000, "en", "zé", 5), (4, "E", "en", "Z", 5),
            (-7, "F", "en", "=", 5), (10 ** 15, "G", "en", "-", 5)],
}


@pytest.mark.parametrize("name", CASES)
def test_proofs(spark, name):
    got = merkle.manifest_proofs(table(spark, CASES[name]))
    assert Counter(map(tuple, got.collect())) == plain(CASES[name])


def test_versions_copy_only_the_path(spark):
    rows = many(600, ["a", "b"])
    manifest = merkle.build(table(spark, rows))
    want = {r[0]: r for r in plain(rows)}
    copies = defaultdict(dict)
    for r in merkle.versions(manifest).collect():
        copies[r.doc_id][r.level] = r.digest
    assert set(copies) == {i for i in want if zlib.crc32(str(i).encode()) % 5 == 0}
    texts = {r[0]: r for r in rows}
    for i, nodes in copies.items():
        # two levels in the source (600 leaves: three), one over the sources
        assert sorted(nodes) == list(range(len(nodes))) and len(nodes) == 5
        assert nodes[0] == leaf(i, lowered(texts[i][1]), *texts[i][2:]) and nodes[len(nodes) - 1] == want[i][5]


def test_long_texts_and_shared_fixture(spark):
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in fx.edge_rows()]
    docs = fx.docs(spark)  # n_chars is long there, the other columns clash
    assert Counter(map(tuple, merkle.manifest_proofs(docs).collect())) == plain(rows)


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    df = merkle.manifest_proofs(spark.read.parquet(f"{sf}/documents.parquet"))
    assert compare(df, duck(sf), oracles.merkle_manifest(merkle.FAN))["ok"]
