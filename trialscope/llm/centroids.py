"""Operator 11: centroid clustering over an incremental distance matrix.

A vector's components become integers, so everything after is exact. The state
keeps, for each vector, its integer dot product with every centroid. A round
adds to these products only what the centroids' changed components give
(``x[j] * change[j]``; a component without change costs nothing), and the
nearest centroid follows from ``|c|^2 - 2 x.c``. New centroids are exact floors
of sums over counts. The state is one table in the shared folder, written anew
each round and read by nobody but the next one, so the table before goes; a
round that changes no centroid ends the loop, as every later one would repeat
it. The driver holds the centroids alone.

Defined results: vectors that are null, have another number of components, or
hold a null or non-finite one give no row; repeated rows count as often as they
occur; a null vec_id is clustered, but starts a centroid only if the others are
too few; with fewer vectors than centroids there are fewer centroids; equal
distances go to the smaller number; an empty table gives no rows. Components
beyond +-131072 are an error: a squared distance would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from . import shared

CENTROIDS, ROUNDS, COMPONENTS, SCALE, SALT = 8, 10, 64, 1024, "3"
LIMIT = 1 << 27           # 64 squared differences of such integers fit in 63 bits
VECTORS = "vec_id long, x binary, norm long"
STATE = VECTORS + ", dots binary, cluster int, distance long"
SUMS = "cluster int, n long, total array<long>"


def _integers(dim: int, scale: int):
    """Batches of (vec_id, embedding) to kept vectors as little-endian
    integers of two bytes, or four where a vector needs them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("embedding")), dim), False))
            flat = rows.column("embedding").flatten().cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # null becomes NaN
            kept = np.isfinite(x).all(axis=1)
            x = np.floor(x[kept] * scale)
            if x.size and np.abs(x).max() > LIMIT:
                raise ValueError(f"a vector has a component beyond {LIMIT // scale}: its distances leave 64 bits")
            v = x.astype(np.int64)
            wide = np.abs(v).max(axis=1) >= 1 << 15
            packed = _packed(v.astype("<i2"))
            if wide.any():
                packed = pc.if_else(pa.array(wide), _packed(v.astype("<i4")), packed)
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id").filter(pa.array(kept)), packed, pa.array((v * v).sum(axis=1))],
                names=["vec_id", "x", "norm"])
    return run


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """The int64 matrix of binary values, whatever their integers' width."""
    sizes = pc.binary_length(col).to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), dim), np.int64)
    for width in np.unique(sizes):
        at = np.flatnonzero(sizes == width)
        raw = b"".join(col.take(pa.array(at)).to_pylist())
        out[at] = np.frombuffer(raw, f"<i{width // dim}").reshape(-1, dim)
    return out


def _update(change: np.ndarray, norms: np.ndarray):
    """State rows with the products brought up to the new centroids, the
    nearest one and its squared distance."""
    k, dim = change.shape
    moved = [np.flatnonzero(change[c]) for c in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column("x"), dim)
            dots = _matrix(batch.column("dots"), k).copy()
            for c, j in enumerate(moved):
                if len(j):
                    dots[:, c] += x[:, j] @ change[c, j]
            far = norms - 2 * dots
            nearest = far.argmin(axis=1)  # the first of equal ones
            distance = batch.column("norm").to_numpy() + far[np.arange(len(far)), nearest]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("x"), batch.column("norm"), _packed(dots),
                 pa.array(nearest.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "x", "norm", "dots", "cluster", "distance"])
    return run


def _summer(k: int, dim: int):
    """A task's count and component sums of each cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x, cluster = _matrix(batch.column("x"), dim), batch.column("cluster").to_numpy()
            n += np.bincount(cluster, minlength=k)
            for c in range(k):
                total[c] += x[cluster == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(list(total), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])
    return run


def _means(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Floors of the clusters' means; an empty cluster keeps its centroid."""
    k, dim = old.shape
    parts = state.select("x", "cluster").mapInArrow(_summer(k, dim), SUMS)
    sums = (parts.select("cluster", "n", F.posexplode("total").alias("at", "part"))
            .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("total")))
    new = old.copy()
    for r in sums.collect():  # centroids x components rows
        if r.n:
            new[r.cluster, r.at] = r.total // r.n
    return new


def first_centroids(vectors: DataFrame, k: int, dim: int, salt: str) -> np.ndarray:
    """The k vectors of smallest hex sha256 of ``salt:vec_id``, in its order."""
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = (vectors.select("x", name.alias("name"))
            .orderBy(F.col("name").asc_nulls_last(), "x").limit(k).collect())
    return _matrix(pa.array([bytes(r.x) for r in rows], pa.binary()), dim)


@dataclass
class Clusters:
    """``rows``: (vec_id, x, norm, dots, cluster, distance) of every vector;
    ``centroids``: the final integer centroids."""

    rows: DataFrame
    centroids: list[list[int]]


def cluster_vectors(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = COMPONENTS,
                    scale: int = SCALE, salt: str = SALT) -> Clusters:
    """Lloyd rounds on exact integers; then every vector is assigned once more."""
    vectors, here = shared.replaced(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .mapInArrow(_integers(dim, scale), VECTORS), "vectors")
    new = first_centroids(vectors, k, dim, salt)
    old = np.zeros_like(new)
    state = vectors.select("*", F.lit(bytes(8 * len(new))).alias("dots"))
    for turn in range(rounds + 1):
        change = new - old
        if turn and not change.any():
            break
        state, here = shared.replaced(
            state.mapInArrow(_update(change, (new * new).sum(axis=1)), STATE), "distances", here)
        old = new
        if turn < rounds and len(new):
            new = _means(state, old)
    return Clusters(state, old.tolist())


def clusters(embeddings: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    found = cluster_vectors(embeddings)
    sums = {r.cluster: r.s for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    marks = [Row(cluster=c, cluster_inertia=s, inertia=sum(sums.values()),
                 centroid_sha256=hashlib.sha256(",".join(map(str, found.centroids[c])).encode()).hexdigest())
             for c, s in sums.items()]
    marks = found.rows.sparkSession.createDataFrame(
        marks, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.select("vec_id", "cluster", "distance").join(F.broadcast(marks), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
