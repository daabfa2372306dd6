"""Operators 6 and 10 against brute force."""

import hashlib
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from trialscope.llm import exact_dedup, golay, oracles, simhash
from trialscope.llm.components import connected_components
from trialscope.testing.compare import compare, duck

from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fp, bits=3):
    root = list(range(len(fp)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(fp))]


def test_near_duplicates(spark):
    rows = fx.pairs(fx.edge_rows())
    fp = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    group = plain_components(fp)
    least = defaultdict(list)
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g].append(i)
    want = Counter((i, format(int(f), "016x"), min(least[g]) if least[g] else None)
                   for (i, _), f, g in zip(rows, fp, group))
    got = simhash.near_duplicates(fx.docs(spark).repartition(5)).collect()
    assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(fx.docs(spark, [])).count() == 0


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(0)
    word = rng.integers(0, 1 << 23, 20_000)
    bits = rng.integers(0, 23, (20_000, 2))
    near = word ^ (1 << bits[:, 0]) ^ np.where(rng.random(20_000) < 0.8, 1 << bits[:, 1], 0)
    keys = [set(zip(*(x.tolist() for x in golay.keys(w)))) for w in (word, near)]
    assert {row for row, _ in keys[0] & keys[1]} == set(range(20_000))


def test_fingerprint_keys_meet_within_three_bits():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64)
    near = fp.copy()
    for k in range(3):
        flip = np.uint64(1) << rng.integers(0, 64, 20_000).astype(np.uint64)
        near = np.where(rng.random(20_000) < 0.9, near ^ flip, near)
    rows = []
    for x in (fp, near):
        key, _, row = simhash._key_rows(x)
        rows.append(set(zip(row.tolist(), key.tolist())))
    assert {row for row, _ in rows[0] & rows[1]} == set(range(20_000))


@pytest.mark.parametrize("group", [simhash.GROUP, 20])
def test_dense_groups_keep_every_link(spark, group):
    """Near copies around a few centres; with a small group size the keys are
    dealt out again by finer bits."""
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2 ** 64, 4, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4, 150, 3)).astype(np.uint64)
    fp = np.unique((centres[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)).reshape(-1))
    want = plain_components(fp)
    nodes = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    links = simhash.near_links(nodes, group=group)
    at = {int(x): k for k, x in enumerate(fp.view(np.int64))}
    for r in links.collect():
        assert int(np.bitwise_count(np.uint64(r.x & (1 << 64) - 1) ^ np.uint64(r.y & (1 << 64) - 1))) <= 3
    roots = {r.node: r.root for r in connected_components(links).collect()}
    got = defaultdict(set)
    for x, k in at.items():
        got[roots.get(x, x)].add(k)
    groups = defaultdict(set)
    for k, g in enumerate(want):
        groups[g].add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(7, k) for k in range(200, 260)] + [(300, 7)]
    edges = spark.createDataFrame(chain + star + [(5, 4), (5, 4), (4, 5)], "x long, y long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == ({k: 100 for k in range(100, 141)} | {k: 7 for k in [7, 300, *range(200, 260)]} | {4: 4, 5: 4})
    assert connected_components(edges.limit(0)).count() == 0


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i or 0, i))
    out = Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        for m in members:
            out[m[3], keep, len(members), m[3] == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("key_bits,page", [(64, 128), (9, 2)])
def test_exact_duplicates(spark, key_bits, page):
    """With 9 key bits different texts share keys and are chained."""
    rows = fx.edge_rows(n=400)
    got = exact_dedup.exact_duplicates(fx.docs(spark, rows).repartition(6), key_bits, page).collect()
    assert Counter(map(tuple, got)) == plain_exact(fx.pairs(rows))
    assert exact_dedup.exact_duplicates(fx.docs(spark, [])).count() == 0


def test_folding_is_bounded_and_whole(spark):
    rows = fx.edge_rows()
    root = exact_dedup.shared.scratch(spark, "fold")
    manifest = exact_dedup.build_index(fx.docs(spark, rows), root, fold_bytes=100)
    groups = exact_dedup.read_index(manifest).collect()
    assert sum(r.group_size for r in groups) == len(rows)
    assert sum(r.n_entries for r in manifest.collect()) == len(groups)


@pytest.mark.parametrize("bits", [6, 40])
def test_extendible_index(scratch, bits):
    """Six bits force chains of overflow pages; forty force directory doubling."""
    rng = np.random.default_rng(bits)
    index = exact_dedup.ExtendibleIndex(bits, page=4)
    keys = rng.integers(0, 1 << bits, 700).tolist() + [5] * 30
    for n, k in enumerate(keys):
        index.insert((k, n.to_bytes(32, "big"), None if n % 9 == 0 else n, n, 1))
    path = f"file://{scratch}/one.xhash"
    assert index.write(path)[0] == len(keys)
    file = exact_dedup.IndexFile(path)
    assert 1 << file.depth == len(file.directory) and file.depth > 3
    for k in {*keys, 1, 2}:
        want = [n for n, x in enumerate(keys) if x == k]
        assert sorted(file.lookup(k)["n_code"].tolist()) == want
    every = np.concatenate(list(file.pages()))
    assert sorted(every["n_code"].tolist()) == list(range(len(keys)))
    assert (every["present"] == (every["n_code"] % 9 != 0)).all()


def test_answers_are_looked_up_in_the_index(spark):
    """A hot text is one question a task."""
    rows = [fx.row(k, "hot text" if k % 3 else f"text {k}") for k in range(600)]
    docs = fx.docs(spark, rows).repartition(6)
    got = exact_dedup.exact_duplicates(docs).collect()
    assert Counter(map(tuple, got)) == plain_exact(fx.pairs(rows))
    _, answers = exact_dedup.looked_up(docs)
    assert answers.groupBy("sha").count().agg({"count": "max"}).first()[0] <= 6


def test_a_large_key_is_dealt_out_again(spark):
    """More fingerprints under one key than a task compares at once, most of
    them not linked: time stays far from the square of their number."""
    rng = np.random.default_rng(11)
    n = 5 * simhash.GROUP
    fp = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64) << np.uint64(16))  # one equal block
    nodes = spark.createDataFrame(spark.sparkContext.parallelize([(int(x),) for x in fp.view(np.int64)], 8), "fp long")
    begin = time.time()
    links = simhash.near_links(nodes).distinct().collect()
    assert time.time() - begin < 120
    known = set(fp.view(np.int64).tolist())
    for r in links:
        assert r.x in known and r.y in known
        assert int(np.bitwise_count(np.uint64(r.x & (1 << 64) - 1) ^ np.uint64(r.y & (1 << 64) - 1))) <= 3


def test_exact_oracle(spark):
    sf = "/root/testdata/sf0.001"
    got = exact_dedup.exact_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    assert compare(got, duck(sf), oracles.EXACT_DUPLICATES)["ok"]
