"""Operator 8: a generalised additive model with pairwise interactions.

Each feature of a text (``text_stats.FEATURES``) is cut into bins. Cyclic
boosting takes the features in turn and adds a shallow tree over one feature's
bins, with a small step, to that feature's lookup table; then the pairs that
explain most of what is left get two-way tables in the same way. A score is
the sum of the looked-up values, vectorised over texts, through a logistic.

Fitted on at most about ``SAMPLE`` labelled rows, drawn by a hash of doc_id.

Defined results: a null or empty text is scored like any other (all its
features are 0); null labels are none; a null doc_id is scored, is held out
and has no label; with no usable labels or only one class every score is that
class' smoothed share (0.5 without labels); an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .labelled import held_out, labelled_sample
from .text_stats import FEATURES, features

SAMPLE = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 8
STEP = 0.1
CUTS = 3           # a tree over one feature has up to CUTS + 1 leaves
LEAST_LEAF = 8.0   # rows of a leaf
RIDGE = 1.0
THRESHOLD = 0.3


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Best leaves over ordered bins, cut greedily: a value for each bin.
    g, h, c: gradient, curvature and rows by bin."""
    leaves = [(0, len(g))]
    for _ in range(CUTS):
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(leaves):
            if b - a < 2:
                continue
            gl, hl, cl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1], np.cumsum(c[a:b])[:-1]
            gt, ht, ct = g[a:b].sum(), h[a:b].sum(), c[a:b].sum()
            gain = (gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE))
            gain = np.where((cl >= LEAST_LEAF) & (ct - cl >= LEAST_LEAF), gain, -1)
            at = int(np.argmax(gain))
            if gain[at] > best[0]:
                best = (float(gain[at]), k, a + at + 1)
        if best[1] is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _quadrants(table: np.ndarray) -> np.ndarray:
    """Sums of the four quadrants for every pair of cuts: (4, rows-1, cols-1)."""
    s = table.cumsum(0).cumsum(1)
    a, row, col = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1]
    return np.stack([a, row - a, col - a, s[-1, -1] - row - col + a])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values): one cut in each direction, over a two-way histogram."""
    qg, qh = _quadrants(g), _quadrants(h)
    value = qg / (qh + RIDGE)
    gain = (qg * value).sum(0)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty(g.shape)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:] = value[0, i, j], value[1, i, j]
    out[i + 1:, :j + 1], out[i + 1:, j + 1:] = value[2, i, j], value[3, i, j]
    return float(gain[i, j]), out


def bin_edges(x: np.ndarray, bins: int) -> list[float]:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)).tolist()


def fit_gam(x: np.ndarray, y: np.ndarray) -> dict:
    """The model's tables for rows x (rows, features) and labels y in 0, 1."""
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    model = {"intercept": float(np.log(share / (1 - share))), "edges": [], "tables": [], "pairs": []}
    if not n or y.min() == y.max():
        return model | {"edges": [[] for _ in range(width)], "tables": [[0.0] for _ in range(width)]}
    edges = [bin_edges(x[:, f], BINS) for f in range(width)]
    at = [np.searchsorted(edges[f], x[:, f], side="right") for f in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rows = [np.bincount(a, minlength=len(t)) for a, t in zip(at, tables)]
    total = np.full(n, model["intercept"])
    for _ in range(ROUNDS):
        for f in range(width):
            if len(tables[f]) < 2:
                continue
            p = _logistic(total)
            step = STEP * _tree(np.bincount(at[f], y - p, len(tables[f])),
                                np.bincount(at[f], p * (1 - p), len(tables[f])), rows[f])
            tables[f] += step
            total += step[at[f]]
    coarse = [bin_edges(x[:, f], PAIR_BINS) for f in range(width)]
    low = [np.searchsorted(coarse[f], x[:, f], side="right") for f in range(width)]

    def histogram(a: int, b: int, weight: np.ndarray) -> np.ndarray:
        shape = len(coarse[a]) + 1, len(coarse[b]) + 1
        return np.bincount(low[a] * shape[1] + low[b], weight, shape[0] * shape[1]).reshape(shape)

    p = _logistic(total)
    gains = sorted(((_pair_tree(histogram(a, b, y - p), histogram(a, b, p * (1 - p)))[0], a, b)
                    for a, b in combinations(range(width), 2) if coarse[a] and coarse[b]), reverse=True)
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in pairs:
            p = _logistic(total)
            step = STEP * _pair_tree(histogram(a, b, y - p), histogram(a, b, p * (1 - p)))[1]
            table += step
            total += step[low[a], low[b]]
    return model | {"edges": edges, "tables": [t.tolist() for t in tables],
                    "pairs": [{"a": a, "b": b, "edges_a": coarse[a], "edges_b": coarse[b], "table": t.tolist()}
                              for a, b, t in pairs]}


def score_gam(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["intercept"])
    for f, (edges, table) in enumerate(zip(model["edges"], model["tables"])):
        total += np.array(table)[np.searchsorted(edges, x[:, f], side="right")]
    for p in model["pairs"]:
        total += np.array(p["table"])[np.searchsorted(p["edges_a"], x[:, p["a"]], side="right"),
                                      np.searchsorted(p["edges_b"], x[:, p["b"]], side="right")]
    return _logistic(total)


def text_features(texts: pa.Array) -> np.ndarray:
    rows = [features(t) for t in texts.cast(pa.binary()).to_pylist()]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in shared.text_slices(batches):
        x = text_features(part.column("text"))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))],
            names=["doc_id", "label", "x"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["doc_id"], r["label"], r["x"]) for b in batches for r in b.to_pylist())
    x = np.array([r[2] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    model = fit_gam(x, np.array([r[1] for r in rows], np.float64))
    yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model)])], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> dict:
    """The fitted tables: 16 tables of 32 numbers and 8 of 64, whatever the
    corpus. One task fits them on the bounded sample's features."""
    rows = labelled_sample(docs, labels, target, sample).mapInArrow(
        _sampled, "doc_id long, label int, x array<double>")
    return json.loads(rows.repartition(1).mapInArrow(_fit, "model string").first()[0])


def _scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(score_gam(model, text_features(part.column("text"))))],
                names=["doc_id", "score"])
    return run


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = shared.id_text(docs).mapInArrow(_scorer(fit(docs, labels)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    model = fit(docs, labels)
    return shared.keep_rows(docs, lambda texts: score_gam(model, text_features(texts)) >= threshold)
