"""Operator 11 against a plain version with unbounded integers."""

import hashlib
import math

import numpy as np
import pytest

from trialscope.llm import centroids, oracles
from trialscope.testing.compare import compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int, x binary, cluster string, norm double"


def plain(rows, k, rounds, dim, scale=1024, salt="3"):
    kept = [(i, [math.floor(scale * float(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest(),
                                        np.array(r[1], "<i2" if max(map(abs, r[1])) < 1 << 15 else "<i4").tobytes()))
    cents = [v for _, v in first[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min(range(len(cents)), key=lambda c: dist(v, cents[c])) for _, v in kept]
    for _ in range(rounds):
        to = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), a in zip(kept, to) if a == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    to = assign()
    far = [dist(v, cents[c]) for (_, v), c in zip(kept, to)]
    return sorted(
        (str(i), c, d, sum(x for x, y in zip(far, to) if y == c), sum(far),
         hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
        for (i, _), c, d in zip(kept, to, far))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, None, None) for i, v in rows], SCHEMA).repartition(5)


def odd_rows(dim=64):
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 0.2, (5, dim))
    rows = [(n, (middle[n % 5] + rng.normal(0, 0.1, dim)).astype(np.float32).tolist()) for n in range(300)]
    rows += [rows[3], rows[3], (3, rows[4][1]), (7, None), (None, rows[9][1]), (900, [0.0] * dim), (901, [0.0] * dim),
             (902, []), (903, [1.0] * (dim - 1)), (904, [1.0] * (dim + 1)), (905, [None] + [1.0] * (dim - 1)),
             (906, [float("nan")] * dim), (907, [float("inf")] + [0.0] * (dim - 1)), (908, [-0.0005] * dim),
             (909, [30.0] * dim), (910, [40.0] * dim)]
    return rows


def got(df):
    return sorted((str(r.vec_id), *tuple(r)[1:]) for r in df.collect())


def test_rounds_equal_the_plain_version(spark):
    rows = odd_rows()
    assert got(centroids.clusters(table(spark, rows))) == plain(rows, 8, 10, 64)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = odd_rows()[:n]
    assert got(centroids.clusters(table(spark, rows))) == plain(rows, 8, 10, 64)


def test_products_stay_exact_and_follow_changes(spark):
    found = centroids.cluster_vectors(table(spark, odd_rows()), k=4, rounds=3)
    cents = np.array(found.centroids)
    for r in found.rows.collect():
        x = np.frombuffer(r.x, f"<i{len(r.x) // 64}").astype(np.int64)
        assert np.frombuffer(r.dots, np.int64).tolist() == (cents @ x).tolist() and r.norm == int(x @ x)
        assert r.distance == int(((cents - x) ** 2).sum(axis=1).min())


def test_only_changed_components_are_multiplied():
    change = np.zeros((2, 64), np.int64)
    change[1, 5] = 3
    x = np.arange(128).reshape(2, 64)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), centroids._packed(x.astype("<i2")), pa.array((x * x).sum(axis=1)),
         centroids._packed(np.array([[10, 20], [30, 40]]))], names=["vec_id", "x", "norm", "dots"])
    out = next(centroids._update(change, np.array([0, 9]))(iter([batch])))
    assert centroids._matrix(out.column("dots"), 2).tolist() == [[10, 20 + 3 * 5], [30, 40 + 3 * 69]]


def test_components_beyond_the_exact_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 131072"):
        centroids.clusters(table(spark, [(1, [2e5] * 64)])).collect()


def test_oracle(spark):
    sf = "/root/testdata/sf0.001"
    df = centroids.clusters(spark.read.parquet(f"{sf}/embeddings.parquet"))
    sql = oracles.centroid_clusters(centroids.CENTROIDS, centroids.ROUNDS, centroids.SALT)
    assert compare(df, duck(sf), sql)["ok"]
