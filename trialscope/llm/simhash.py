"""Operator 6: SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint has four 16-bit blocks. Of at most 3 differing bits, one
block has none; the other 48 bits are two halves of 24, of which one has at
most one, so the halves S and T fall under one of two cases: S has at most 2
differing bits, or T has none. So each block gives the keys (block, Golay keys
of S) and (block, T), and any two fingerprints that link share one. Equal
fingerprints are one node. Tasks verify the fingerprints of a key by their
real distance and emit only a spanning forest of what links, so a group of
copies never becomes all its pairs. Keys with more than ``GROUP`` fingerprints
are dealt out again by more exact bits.

Defined results: a null text, or one without words, has fingerprint 0 and
links like any other; rows with equal doc_id stay separate rows; a null doc_id
never names a component unless all its members' are null; an empty table
gives no rows. ``keep_one`` keeps one row of each component: one that has the
doc_id which names it, of several texts under it that of the least hash, and of
repeated rows any one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay, shared
from .components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
GROUP = 1 << 14         # fingerprints of one key that a task compares
DENSE = 8               # larger groups are searched, smaller ones compared pairwise
ALL = (1 << 64) - 1
KEYS = "key long, mask long, fp long"
LINKS = "kind int, key long, mask long, x long, y long"


def fingerprint(text: bytes, width: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) < width:
        words = [b" ".join(words)]
        width = 1
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    h = np.fromiter((digest(s, seed) for s in map(b" ".join, zip(*(words[k:] for k in range(width))))),
                    np.dtype(">u8"), n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t, width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "mark", "fp"])
    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, fp): the fingerprint's 64 bits as a long; ``mark`` tells
    the texts of one doc_id apart."""
    return shared.id_text(docs).withColumn("mark", F.xxhash64("text")).mapInArrow(
        _fingerprints(width), "doc_id long, mark long, fp long")


def _mix(*parts) -> np.ndarray:
    """One 64-bit key of several numbers; a clash only adds candidates."""
    out = np.array([0x9E3779B97F4A7C15], np.uint64)
    for p in parts:
        out = (out ^ np.asarray(p, np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        out = out ^ (out >> np.uint64(32))
    return out


def _key_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, mask of the bits that are equal under it, row)."""
    rows, found, masks = [], [], []
    blocks = [(fp >> np.uint64(16 * b)) & np.uint64(0xFFFF) for b in range(4)]
    for b in range(4):
        u, v, w = (blocks[k].astype(np.int64) for k in range(4) if k != b)
        rest = u | v << 16 | w << 32
        s, t = rest & 0x7FFFFF, rest >> 24  # a code word has 23 bits; verification sees the 24th
        row, code = golay.keys(s)
        own = 0xFFFF << (16 * b)
        t_bits = _spread(ALL ^ own, 24, 48)
        for r, key, mask in ((row, _mix(2 * b, blocks[b][row], code), own),
                             (np.arange(len(fp)), _mix(2 * b + 1, blocks[b], t), own | t_bits)):
            rows.append(r)
            found.append(key)
            masks.append(np.full(len(r), mask, np.uint64))
    return np.concatenate(found), np.concatenate(masks), np.concatenate(rows)


def _spread(free: int, begin: int, end: int) -> int:
    """The begin-th to end-th set bits of ``free``."""
    bits = [b for b in range(64) if free >> b & 1][begin:end]
    return sum(1 << b for b in bits)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fp), 20_000):
            part = fp[at:at + 20_000]
            key, mask, row = _key_rows(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (key, mask, part[row])], names=["key", "mask", "fp"])


def _finer(key: int, mask: int, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of fingerprints that agree on ``mask``: the other bits in four
    parts, of which one has no differing bit."""
    free = ALL ^ mask
    n = free.bit_count()
    cuts = [n * k // 4 for k in range(5)]
    found, masks = [], []
    for k in range(4):
        part = _spread(free, cuts[k], cuts[k + 1])
        found.append(_mix(key, k, fp & np.uint64(part)))
        masks.append(np.full(len(fp), mask | part, np.uint64))
    return np.concatenate(found), np.concatenate(masks), np.tile(fp, 4)


def forest(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) that connect just what links in ``fp``: a search that
    compares each reached fingerprint with those not reached yet."""
    xs, ys = [], []
    left = fp
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                hit = left[near]
                xs.append(np.full(len(hit), at))
                ys.append(hit)
                queue.extend(hit)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *xs]), np.concatenate([none, *ys])


def _linker(max_bits: int, group: int):
    def emit(kind: int, key, mask, x, y) -> pa.RecordBatch:
        n = len(x)
        cols = [np.full(n, kind, np.int32), *(np.broadcast_to(np.asarray(c, np.uint64), n).copy().view(np.int64)
                                              for c in (key, mask, x, y))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "key", "mask", "x", "y"])

    def links(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of whole, sorted groups."""
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        dense = np.flatnonzero(size > DENSE)
        for g in dense:
            x, y = forest(fp[begin[g]:begin[g] + size[g]], max_bits)
            if len(x):
                yield emit(0, 0, 0, x, y)
        small = np.repeat((size > 1) & (size <= DENSE), size)
        key, fp = key[small], fp[small]
        for d in range(1, DENSE):  # neighbours at distance d in the same group
            near = np.flatnonzero(key[d:] == key[:-d])
            if not len(near):
                break
            hit = near[np.bitwise_count(fp[near] ^ fp[near + d]) <= max_bits]
            if len(hit):
                yield emit(0, 0, 0, fp[hit], fp[hit + d])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        over = None  # (key, mask) of a group that is dealt out again
        for batch in batches:
            key, mask, fp = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64)
                             for c in ("key", "mask", "fp"))
            if not len(key):
                continue
            if over is not None:
                same = key == np.uint64(over[0])
                if same.any():
                    k, m, f = _finer(*over, fp[same])
                    yield emit(1, k, m, f, f)
                    key, mask, fp = key[~same], mask[~same], fp[~same]
                if not len(key):
                    continue
                over = None
            key, fp = np.concatenate([held_key, key]), np.concatenate([held_fp, fp])
            open_from = int(np.searchsorted(key.view(np.int64), key.view(np.int64)[-1]))
            yield from links(key[:open_from], fp[:open_from])
            held_key, held_fp = key[open_from:], fp[open_from:]
            if len(held_fp) > group and (free := ALL ^ int(mask[-1])).bit_count() > 20:
                over = (int(held_key[0]), ALL ^ free)
                k, m, f = _finer(*over, held_fp)
                yield emit(1, k, m, f, f)
                held_key, held_fp = held_key[:0], held_fp[:0]
        yield from links(held_key, held_fp)
    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """(x, y): links among the distinct fingerprints ``nodes`` (fp) that
    connect exactly the fingerprints which differ in at most ``max_bits``."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the keys hold for at most {MAX_BITS} differing bits")
    rows, found = nodes.select("fp").mapInArrow(_keyed, KEYS), None
    while True:
        step = (rows.repartition("key").sortWithinPartitions("key", "fp")
                .mapInArrow(_linker(max_bits, group), LINKS))
        step = shared.stored(step, "simhash-links")
        new = step.where("kind = 0").select("x", "y")
        found = new if found is None else found.union(new)
        rows = step.where("kind = 1").select("key", "mask", F.col("x").alias("fp")).distinct()
        if rows.isEmpty():
            return found


def components(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) of every row: ``root`` is one
    fingerprint of the component, ``component_id`` its smallest doc_id."""
    marked = shared.stored(fingerprints(docs, width), "simhash")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(near_links(nodes, max_bits))
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(named, "root").select(F.col("fp").alias("node_fp"), "root", "component_id")
    return marked.join(named, marked["fp"] == named["node_fp"]).select("doc_id", "mark", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    return components(docs, width, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row, all columns, of each group of near duplicates."""
    found = components(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = found.groupBy("root", "component_id", "mark").agg(F.count("*").alias("rows"))
    least = texts.groupBy("root").agg(F.min("mark").alias("mark"))
    stay = texts.join(least, ["root", "mark"])
    return shared.rows_marked(docs, stay.select(F.col("component_id").alias("doc_id"), "mark", "rows"))
