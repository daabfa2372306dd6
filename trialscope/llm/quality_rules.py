"""Operator 7: quality rules by line sequence labelling.

Rules on whole-text counts reject first. A linear-chain conditional random
field then labels every line as content or boilerplate: Viterbi decoding over
the lines' features, and the share of words in content lines decides.

The field is trained here by conditional likelihood (forward and backward
passes, Adam) on labelled documents outside the held-out fold; a line's label
is its document's quality. Documents of one label never show it where content
ends and boilerplate begins, so it also learns from splices: lines of a bad
document put between those of a good one, and the other way round, each line
with the label of the document it came from. The sample is bounded and taken
whole text by whole text: about ``SAMPLE`` documents by a hash, of these the
ones of at most ``MOST_LINES`` lines, in hash order as long as ``LINES`` lines
are not exceeded. A text that does not fit is left out of the fit alone.

Defined results: a null or empty text has no words and fails the rules; lines
without a word take part in the sequence but count no words; without usable
labels every line is content; rows with equal doc_id are judged apart; an
empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, text_stats
from .labelled import hash_order, labelled_sample, within_budget

SAMPLE = 4_000
MOST_LINES, LINES = 512, 1 << 17
CONTENT_SHARE = 0.5
LEAST_WORDS, MOST_REPEATED = 20, 30
STEPS, RATE, RIDGE = 120, 0.1, 1e-3
# Upper bounds of the bins of each line feature; a value falls in the first bin
# whose bound it does not exceed, or in one more.
LINE_BINS = (("words", (0, 3, 10, 30)), ("symbols a word", (0, 0.05, 0.3)), ("exclamations a word", (0, 0.05, 0.3)),
             ("capitals", (0.1, 0.5)), ("adjacent equal words", (0, 0.1)), ("distinct words", (0.3, 0.6)),
             ("digits", (0.05, 0.3)), ("seen before", (0,)), ("ends in a stop", (0,)), ("word length", (2.5, 10)))
BEGIN = np.cumsum([0] + [len(b) + 1 for _, b in LINE_BINS])
WIDTH = int(BEGIN[-1])
ROWS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_words long")


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, words): one feature number of each group, and the word count."""
    seen: set[bytes] = set()
    rows = []
    for line in lines:
        words = line.split()
        n, size = len(words), max(1, len(line))
        rows.append((n, text_stats.count(line, text_stats.SYMBOLS) / max(1, n), line.count(b"!") / max(1, n),
                     text_stats.count(line, text_stats.UPPER) / size,
                     sum(map(eq, words, words[1:])) / max(1, n), len(set(words)) / n if n > 7 else 1.0,
                     text_stats.count(line, text_stats.DIGITS) / size, n > 0 and line in seen,
                     line.rstrip(text_stats.SPACE)[-1:] in (b".", b"!", b"?"), size / max(1, n)))
        if n:
            seen.add(line)
    x = np.array(rows, np.float64)
    cols = [BEGIN[k] + np.searchsorted(bounds, x[:, k]) for k, (_, bounds) in enumerate(LINE_BINS)]
    return np.stack(cols, axis=1), x[:, 0].astype(np.int64)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def splices(docs: list[tuple[np.ndarray, np.ndarray]], seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every good document with a part of a bad one inside and the reverse, as
    long as there are pairs: (line features, label of each line)."""
    rng, out = np.random.default_rng(seed), []
    kinds = [[d for d in docs if d[1][0] == y] for y in (0, 1)]
    for pair in zip(*kinds):
        for (host, own), (guest, other) in (pair, pair[::-1]):
            at, n = int(rng.integers(0, len(host) + 1)), int(rng.integers(1, len(guest) + 1))
            begin = int(rng.integers(0, len(guest) - n + 1))
            out.append(tuple(np.concatenate([x[:at], y[begin:begin + n], x[at:]]) for x, y in ((host, guest), (own, other))))
    return out


def expected(model: dict, feats: np.ndarray, size: np.ndarray) -> tuple[dict, np.ndarray]:
    """Expected counts of (feature, state), (state, state) and first states
    over the paths of documents laid end to end, the longest first, and each
    document's log partition. Steps run over all documents that reach a line."""
    begin = np.cumsum(size) - size
    reach = [int((size > t).sum()) for t in range(size[0])]
    score = model["emit"][feats].sum(axis=1)
    fore, back = np.zeros((len(feats), 2)), np.zeros((len(feats), 2))
    fore[begin] = score[begin] + model["first"]
    for t in range(1, len(reach)):
        at = begin[:reach[t]] + t
        fore[at] = score[at] + _logsum(fore[at - 1][:, :, None] + model["move"], 1)
    total = _logsum(fore[begin + size - 1], 1)
    norm, move = np.repeat(total, size), np.zeros((2, 2))
    for t in range(len(reach) - 1, 0, -1):
        at = begin[:reach[t]] + t
        after = (score[at] + back[at])[:, None, :] + model["move"]
        back[at - 1] = _logsum(after, 2)
        move += np.exp(fore[at - 1][:, :, None] + after - norm[at][:, None, None]).sum(axis=0)
    state = np.exp(fore + back - norm[:, None])
    emit = np.stack([np.bincount(feats.reshape(-1), np.repeat(state[:, s], feats.shape[1]), WIDTH)
                     for s in (0, 1)], axis=1)
    return {"emit": emit, "move": move, "first": state[begin].sum(axis=0)}, total


def fit_crf(docs: list[tuple[np.ndarray, int | np.ndarray]]) -> dict:
    """Weights (feature by state), moves (state to state) and first states,
    for documents given as (line features, label of each or of all lines)."""
    model = {"emit": np.zeros((WIDTH, 2)), "move": np.zeros((2, 2)), "first": np.zeros(2)}
    docs = [(x, np.broadcast_to(np.asarray(y, np.int64), len(x))) for x, y in docs]
    if len({int(y) for _, ys in docs for y in np.unique(ys)}) == 2:
        docs = sorted(docs, key=lambda d: -len(d[0]))  # those that reach line t are a prefix
        size = np.array([len(x) for x, _ in docs])
        begin = np.cumsum(size) - size
        feats = np.concatenate([x for x, _ in docs])
        gold = np.concatenate([y for _, y in docs])
        later = np.ones(len(gold), bool)
        later[begin] = False
        later = np.flatnonzero(later)
        want = {"emit": np.stack([np.bincount(feats[gold == s].reshape(-1), minlength=WIDTH) for s in (0, 1)], axis=1),
                "move": np.bincount(2 * gold[later - 1] + gold[later], minlength=4).reshape(2, 2),
                "first": np.bincount(gold[begin], minlength=2)}
        lines = len(feats)
        mean = {k: np.zeros(v.shape) for k, v in model.items()}
        square = {k: np.zeros(v.shape) for k, v in model.items()}
        for step in range(1, STEPS + 1):
            got, _ = expected(model, feats, size)
            for k in model:
                slope = (want[k] - got[k]) / lines - RIDGE * model[k]
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.999 * square[k] + 0.001 * slope ** 2
                model[k] = model[k] + RATE * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-9)
    else:
        model["first"] = model["first"] + (0.0, 1.0)
        model["move"] = model["move"] + ((1.0, 0.0), (0.0, 1.0))
    return {k: v.tolist() for k, v in model.items()}


def viterbi(model: dict, feats: np.ndarray) -> np.ndarray:
    """The likeliest states (1: content) of a text's lines."""
    score = np.asarray(model["emit"])[feats].sum(axis=1)
    (stay0, to1), (to0, stay1) = model["move"]
    a, b = (float(s) + f for s, f in zip(score[0], model["first"]))
    came: list[tuple[int, int]] = []
    for s0, s1 in score[1:].tolist():
        from0, from1 = int(b + to0 > a + stay0), int(b + stay1 >= a + to1)
        came.append((from0, from1))
        a, b = s0 + (b + to0 if from0 else a + stay0), s1 + (b + stay1 if from1 else a + to1)
    state = int(b >= a)
    out = [state]
    for step in reversed(came):
        state = step[state]
        out.append(state)
    return np.array(out[::-1])


def verdict(raw: bytes, model: dict) -> tuple:
    """The text's counts, base_failed, kept and words in content lines."""
    n, chars, symbols, dup, repeat = text_stats.base(raw)
    failed = n < LEAST_WORDS or 100 * repeat > MOST_REPEATED * n
    feats, words = line_features(raw.split(b"\n"))
    content = int(words[viterbi(model, feats) == 1].sum())
    return n, chars, symbols, dup, repeat, failed, not failed and content >= CONTENT_SHARE * n, content


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in shared.text_slices(batches):
        texts = part.column("text").cast(pa.binary()).to_pylist()
        short = np.array([t.count(b"\n") < MOST_LINES for t in texts], bool)
        rows = [line_features(t.split(b"\n"))[0].astype("<i2").tobytes() for t, s in zip(texts, short) if s]
        ids, labels = (part.column(c).filter(pa.array(short)) for c in ("doc_id", "label"))
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((hash_order(i), y, x) for b in batches
                  for i, y, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "x"))))
    docs = []
    for _, y, x in rows:
        feats = np.frombuffer(x, "<i2").astype(np.int64).reshape(-1, len(LINE_BINS))
        docs.append((feats, np.full(len(feats), y)))
    yield pa.RecordBatch.from_arrays([pa.array([json.dumps(fit_crf(docs + splices(docs)))])], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = LINES) -> dict:
    """The field's weights, fitted by one task on the bounded sample."""
    rows = shared.stored(labelled_sample(docs, labels, "quality", sample).mapInArrow(
        _sampled, "doc_id long, label int, x binary"), "crf-sample")
    rows = within_budget(rows, F.octet_length("x") / (2 * len(LINE_BINS)), lines)
    return json.loads(rows.repartition(1).mapInArrow(_fit, "model string").first()[0])


def _judge(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            cols = list(zip(*(verdict(t, model) for t in part.column("text").cast(pa.binary()).to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.bool_() if k in (5, 6) else pa.int64())
                                          for k, c in enumerate(cols))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "content_words"])
    return run


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every row."""
    return shared.id_text(docs).mapInArrow(_judge(fit(docs, labels)), ROWS)


def keep_passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept."""
    model = fit(docs, labels)
    return shared.keep_rows(docs, lambda texts: np.array(
        [verdict(t, model)[6] for t in texts.cast(pa.binary()).to_pylist()], bool))
