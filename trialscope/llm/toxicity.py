"""Operator 5: toxicity by FTRL-proximal logistic regression.

Features are hashed: words, word pairs, pairs that skip one word, and word
beginnings (a word's first four and five letters, which carry a word through
its endings). FTRL-proximal has a learning rate per coordinate and an L1 term
that keeps few weights; these are broadcast (at most ``MAX_WEIGHTS``, checked)
and every whole text is scored by numpy sums.

The model is fitted on at most about ``SAMPLE`` labelled rows, drawn by a hash
of doc_id, and of these on as many, in hash order, as have ``BUDGET`` features
together; a text that does not fit is left out of the fit, whole. The rest of
the corpus is only scored.

Defined results: a null or empty text is scored by the intercept; a null label
is no label, and of several labels of a doc_id the largest counts; a null
doc_id is scored, is held out and has no label; without usable labels every
score is the prior 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .labelled import hash_order, held_out, labelled_sample, within_budget

SAMPLE = 20_000        # labelled rows the model may be fitted on
BUDGET = 1 << 26       # features of these rows, 256 MB in the task that fits
BITS = 22              # 2**BITS hashed coordinates
MAX_WEIGHTS = 1 << 18  # weights that may be broadcast, 3 MB; more are an error, none is dropped
STEMS = (4, 5)
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.1
FEATURES = "doc_id long, label int, features array<int>"
WEIGHTS = "feature int, weight double"


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def hashed_features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text, coordinate) of every word, pair, skip pair and beginning; a
    feature that occurs twice is listed twice."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    ends = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    plain = pc.utf8_trim(pc.utf8_lower(coded.dictionary), ".,;:!?\"'()[]|#*$%&")
    digest = xxhash.xxh64_intdigest

    def hashes(strings: pa.Array) -> np.ndarray:
        once = strings.dictionary_encode()
        own = np.array([digest(w) for w in once.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
        return own[once.indices.to_numpy(zero_copy_only=False)]

    row = coded.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(texts)), np.diff(ends))
    own = hashes(plain)
    filled = (pc.binary_length(plain).to_numpy(zero_copy_only=False) > 0)[row]
    row, text = row[filled], text[filled]
    h = own[row]
    found = [(text, _mixed(h, 1))]
    for gap, salt in ((1, 2), (2, 3)):
        same = text[gap:] == text[:-gap]
        found.append((text[gap:][same], _mixed(_mixed(h[:-gap][same], salt) + h[gap:][same], salt)))
    for k in STEMS:
        found.append((text, _mixed(hashes(pc.utf8_slice_codeunits(plain, 0, k))[row], 16 + k)))
    return (np.concatenate([t for t, _ in found]),
            (np.concatenate([x for _, x in found]) >> np.uint64(64 - bits)).astype(np.int32))


class Ftrl:
    """FTRL-proximal for 0/1 features: state z and n for each coordinate."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias = np.zeros(2)  # z and n of the intercept, which has no L1

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1)
                        / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def intercept(self) -> float:
        return float(-self.bias[0] / ((self.beta + np.sqrt(self.bias[1])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        """One row with the distinct coordinates ``at``."""
        w, b = self.weights(at), self.intercept()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        step = (np.sqrt(self.bias[1] + g * g) - np.sqrt(self.bias[1])) / self.alpha
        self.bias += (g - step * b, g * g)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in shared.text_slices(batches):
        text, at = hashed_features(part.column("text"))
        key = np.unique(text << BITS | at)
        rows = np.split(key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(1, part.num_rows)))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("label"),
             pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))],
            names=["doc_id", "label", "features"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        flat = batch.column("features")
        values, ends = flat.flatten().to_numpy(), flat.offsets.to_numpy()
        ends = ends - ends[0]
        for i, (doc_id, label) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist())):
            rows.append((hash_order(doc_id), label, values[ends[i]:ends[i + 1]].copy()))
    if not rows:
        return
    rows.sort(key=lambda r: r[0])
    model = Ftrl()
    for _ in range(EPOCHS):
        for _, label, at in rows:
            model.learn(at, label)
    w = model.weights()
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(w[at], model.intercept()))],
        names=["feature", "weight"])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", sample: int = SAMPLE,
        budget: int = BUDGET) -> DataFrame:
    """(feature, weight), the intercept under feature -1; fitted by one task
    over the bounded sample's hashed features, never over texts."""
    rows = shared.stored(labelled_sample(docs, labels, target, sample).mapInArrow(_sampled, FEATURES), "ftrl-sample")
    rows = within_budget(rows, F.size("features"), budget)
    return shared.stored(rows.repartition(1).mapInArrow(_fit, WEIGHTS), "ftrl")


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weight, bias = model.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = weight
        for part in shared.text_slices(batches):
            text, feature = hashed_features(part.column("text"))
            hit = dense[feature] != 0
            key = np.unique(text[hit] << BITS | feature[hit])  # a feature counts once
            total = bias + np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)].astype(np.float64), part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))],
                names=["doc_id", "score"])
    return run


def score(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """(doc_id, score) of every whole text."""
    rows = weights.limit(MAX_WEIGHTS + 2).collect()
    if len(rows) > MAX_WEIGHTS + 1:
        raise ValueError("more weights than may be broadcast")
    kept = [r for r in rows if r.feature >= 0]
    model = docs.sparkSession.sparkContext.broadcast(
        (np.array([r.feature for r in kept], np.int64), np.array([r.weight for r in kept], np.float32),
         next((r.weight for r in rows if r.feature < 0), 0.0)))
    return shared.id_text(docs).mapInArrow(_scorer(model), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
