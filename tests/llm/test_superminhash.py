"""Operator 13 against all pairs, and its signatures against the sequential
algorithm."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trialscope.llm import oracles, superminhash
from trialscope.testing.compare import compare, duck

from . import fixtures as fx

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, width=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def plain(rows, least=80):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    where = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            where[x].add(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < k}:
            both = len(s & sets[j])
            if 100 * both >= least * (len(s) + len(sets[j]) - both):
                root[find(k)] = find(j)
    least_of = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least_of[find(k)] = min(least_of.get(find(k), i), i)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        name = least_of.get(find(k)) if sets[k] else i
        out[i, len(sets[k]), name, i == name] += 1
    return out


def copies(rng, base, n, share):
    """Texts that differ from ``base`` in a share of single words."""
    words = base.split()
    out = []
    for _ in range(n):
        w = list(words)
        for k in rng.sample(range(len(w)), int(len(w) * share)):
            w[k] = f"x{rng.random()}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = fx.edge_rows()
    for group in range(12):  # shares around the limit: one changed word breaks four shingles
        base = fx.prose(rng, rng.choice([30, 120, 500]))
        rows += [fx.row(5000 + 100 * group + k, t) for k, t in enumerate(copies(rng, base, 9, 0.01 + 0.005 * group))]
    got = superminhash.near_duplicates(fx.docs(spark, rows).repartition(6)).collect()
    assert Counter(map(tuple, got)) == plain(fx.pairs(rows))
    assert superminhash.near_duplicates(fx.docs(spark, [])).count() == 0


@pytest.mark.parametrize("block", [superminhash.BLOCK, 7])
def test_large_groups_keep_every_link(spark, monkeypatch, block):
    """Near copies of one text, most of them not similar to the smallest; with
    a small block the open pairs are dealt into many steps."""
    monkeypatch.setattr(superminhash, "BLOCK", block)
    rng = random.Random(5)
    base = fx.prose(rng, 150)
    texts = copies(rng, base, 60, 0.03) + [base] + copies(rng, base, 40, 0.06)
    passage = fx.prose(rng, 80)
    texts += [passage + " " + fx.prose(rng, 40) for _ in range(60)]  # share a passage, are no copies
    rng.shuffle(texts)
    rows = [fx.row(k, t) for k, t in enumerate(texts)]
    got = superminhash.near_duplicates(fx.docs(spark, rows).repartition(4)).collect()
    assert Counter(map(tuple, got)) == plain(fx.pairs(rows))


def sequential(elements, m):
    """One set's signature, element by element, with swaps and the histogram
    that ends an element's ranks early."""
    h, a, hist = [None] * m, m - 1, [0] * m
    hist[m - 1] = m
    for e in elements:
        p, j = list(range(m)), 0
        while j <= a:
            part = lambda n: int(superminhash._mixed(np.array([e], np.uint64) + superminhash._odd(n))[0])
            r, k = part(2 * j + 1) >> 16, j + ((part(2 * j + 2) >> 32) * (m - j) >> 32)
            p[j], p[k] = p[k], p[j]
            value = j << 48 | r
            old = m - 1 if h[p[j]] is None else min(h[p[j]] >> 48, m - 1)
            if h[p[j]] is None or value < h[p[j]]:
                h[p[j]] = value
                if j < old:
                    hist[old] -= 1
                    hist[j] += 1
                    while hist[a] == 0:
                        a -= 1
            j += 1
    return h


@pytest.mark.parametrize("m", [8, 40, 300])
def test_signatures_equal_the_sequential_algorithm(m):
    rng = np.random.default_rng(m)
    sizes = np.array([1, 3, 0, 50, 700, 2])
    sets = [np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64)) for n in sizes]
    got = superminhash.signatures(np.concatenate(sets), sizes, m)
    for s, row in zip(sets, got):
        if len(s):
            assert row.tolist() == sequential(s, m)
        else:
            assert (row == superminhash.EMPTY).all()


def test_signatures_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(9)
    m, trials, errors = 64, 400, []
    for _ in range(trials):
        every = rng.integers(0, 2 ** 64, 60, dtype=np.uint64)
        a, b = every[:50], every[10:]  # 40 of 60
        one, two = superminhash.signatures(np.concatenate([a, b]), np.array([50, 50]), m)
        errors.append((one == two).mean() - 40 / 60)
    independent = (40 / 60) * (20 / 60) / m
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 0.95 * independent


@pytest.mark.parametrize("most", [3, 1 << 20])
def test_forest_joins_what_is_linked(most):
    rng = random.Random(6)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)]
    forest = superminhash.Forest(most)
    kept = [link for link in links if link[0] != link[1] and forest.join(*link)]

    def groups(pairs):
        root = {k: {k} for k in range(60)}
        for x, y in pairs:
            both = root[x] | root[y]
            for k in both:
                root[k] = both
        return {frozenset(g) for g in root.values()}
    assert groups(kept) == groups(links)
    if most > 60:
        assert len(kept) == 60 - len(groups(links))


def test_bound_never_rejects_a_similar_set():
    rng = np.random.default_rng(3)
    for n in (5, 100, 3000, 60_000):
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[len(a) // 9:], rng.integers(0, 2 ** 64, n // 20, dtype=np.uint64)]))
        mine, other = superminhash.sketch(a), superminhash.sketch(b)
        may = superminhash.may_be_similar(mine, other[None], len(a), np.array([len(b)]), 80)[0]
        assert superminhash.similar(a, b) <= may


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    df = superminhash.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"))
    assert compare(df, duck(sf), oracles.shingle_duplicates(superminhash.LEAST))["ok"]
