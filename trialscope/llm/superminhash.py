"""Operator 13: near duplicates by SuperMinHash signatures.

A document's set holds the hashes of its distinct shingles. Every element
ranks all components of the signature by a permutation of its own and adds a
uniform fraction; a component keeps the least rank + fraction over the
elements. The ranks of an element are all different, so the components are
correlated and vary less than independent minima. Ranks are dealt level by
level over a whole batch: after level j every value below j + 1 is final, and
a document whose components are all filled stops early.

Equal sets are one node. Bands of a node's signature are keys; the nodes of a
key are first compared with its hub, the node that meets most others under all
its keys (in a group of copies the one in the middle), which joins the copies
in as many comparisons as there are nodes. What is left are the pairs
under one key whose components still differ: those with no node on the hub's
side of the graph are compared with all others, in blocks, so no true link
among the nodes of a key is lost and no group forms all its pairs. Every pair
is confirmed on the full sets. Tasks join confirmed links by union-find and
emit a spanning forest; large-star / small-star rounds join the forests.

A pair at the least similarity, 0.8, shares no band of 36 with a chance of
about 2 in 100,000 (0.9: 1 in 10^12); a pair of sets that differ shares 64-bit
element hashes by chance only.

Defined results: a null text, and one without words, has no shingles and is
linked with nothing; a text of fewer words than a shingle is one shingle; rows
of one doc_id are separate rows; a null doc_id never names a component unless
all its members' are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import connected_components

WIDTH = 4
LEAST = 80               # percent of the union
BANDS, ROWS = 36, 6
BLOCK = 1024             # nodes of a key on one side of a comparison step
STEP, SETS = 1 << 16, 2048  # elements and sets of a batch that are ranked together
ASKED = 1 << 18          # doc_ids that may be broadcast; more are shuffled
FOREST = 1 << 20         # nodes of a task's union-find
EMPTY = np.uint64((1 << 64) - 1)
FRACTION = 48            # bits of a value below its rank
GOLD = 0x9E3779B97F4A7C15
BINS = 128               # of a set's sketch: how many elements fall into each, up to 255
MARKED = "doc_id long, n int, set_id binary, bands binary, sketch binary"
KEYED = "key long, node long, n int"
PAIRS = "x long, y long"


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text.lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    n = len(words) - width + 1
    hashes = map(xxhash.xxh3_64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(width)))))
    return np.unique(np.fromiter(hashes, np.uint64, n))


def _odd(n: int) -> np.uint64:
    return np.uint64(n * GOLD & (1 << 64) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(elements: np.ndarray, sizes: np.ndarray, m: int) -> np.ndarray:
    """A row of m values for each set: ``elements`` holds the sets one after
    the other. A value is rank << 48 | fraction; a set without elements keeps
    the largest value."""
    sets = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full(len(sizes) * m, EMPTY)
    order, live = None, np.arange(len(sizes))[sizes > 0]
    for j in range(m):
        fraction = _mixed(elements + _odd(2 * j + 1)) >> np.uint64(64 - FRACTION)
        draw = _mixed(elements + _odd(2 * j + 2)) >> np.uint64(32)
        pick = (j + ((draw * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64))
        rows = np.arange(len(elements))
        component = pick if order is None else order[rows, pick]
        np.minimum.at(out, sets * m + component, np.uint64(j << FRACTION) | fraction)
        open_ = (out.reshape(-1, m)[live] == EMPTY).any(axis=1)
        live = live[open_]
        if not len(live):
            break
        still = np.zeros(len(sizes), bool)
        still[live] = True
        stay = still[sets]
        elements, sets, pick = elements[stay], sets[stay], pick[stay]
        if order is None:  # places j.. of each element's permutation, shuffled as far as needed
            order = np.tile(np.arange(m, dtype=np.min_scalar_type(m)), (len(elements), 1))
        else:
            order = order[stay]
        order[np.arange(len(elements)), pick] = order[:, j]
    return out.reshape(-1, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(GOLD), parts.shape[:2])
    for r in range(rows):
        key = _mixed(key ^ parts[:, :, r])
    return key


def sketch(elements: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((elements & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)


def may_be_similar(mine: np.ndarray, others: np.ndarray, n: int, ns: np.ndarray, least: int) -> np.ndarray:
    """Which of the sets ``others`` can be similar to ``mine``: a bin's smaller
    count bounds what both have there. A full bin may hold more: no bound."""
    common = np.minimum(others, mine).sum(axis=1, dtype=np.int64)
    full = (others == 255).any(axis=1) | (mine == 255).any()
    return full | (100 * common >= least * (n + ns.astype(np.int64) - common))


def _marker(width: int, bands: int, rows: int):
    def flush(ids: list, held: list) -> pa.RecordBatch:
        sizes = np.array([len(h) for h in held], np.int64)
        keys = band_keys(signatures(np.concatenate(held), sizes, bands * rows), bands, rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes.astype(np.int32)),
             pa.array([xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None for h in held], pa.binary()),
             pa.array([k.tobytes() if n else None for k, n in zip(keys, sizes)], pa.binary()),
             pa.array([sketch(h).tobytes() if len(h) else None for h in held], pa.binary())],
            names=["doc_id", "n", "set_id", "bands", "sketch"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            ids, held, size = [], [], 0
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                ids.append(doc_id)
                held.append(shingles(text, width))
                size += len(held[-1])
                if size > STEP or len(held) > SETS:
                    yield flush(ids, held)
                    ids, held, size = [], [], 0
            if ids:
                yield flush(ids, held)
    return run


def marked(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, set_id, bands, sketch): set size, 128-bit hash, band keys
    and element counts by bin."""
    return shared.id_text(docs).mapInArrow(_marker(width, bands, rows), MARKED)


def distinct_sets(rows: DataFrame) -> DataFrame:
    """(node, set_id, n, bands, sketch, least): every set once, numbered, with the
    smallest doc_id that has it. Copies are folded before the shuffle."""
    return shared.stored(rows.where("n > 0").groupBy("set_id", "n", "bands", "sketch").agg(F.min("doc_id").alias("least"))
                         .withColumn("node", F.monotonically_increasing_id()), "sets")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            raw = part.column("bands").to_pylist()
            keys = np.frombuffer(b"".join(raw), np.int64)
            every = [len(r) // 8 for r in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *(pa.array(np.repeat(part.column(c).to_numpy(), every)) for c in ("node", "n"))],
                names=["key", "node", "n"])


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, node, n): a row for each band of each node."""
    return nodes.select("node", "n", "bands").mapInArrow(_keyed, KEYED)


# --- confirmation on full sets ----------------------------------------------------

def similar(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """100 * intersection >= least * union, of sorted distinct elements."""
    if 100 * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= least * (len(a) + len(b) - both)


class Forest:
    """Union-find over node numbers: ``join`` says whether a link is the first
    between its two components."""

    def __init__(self, most: int = FOREST):
        self.root: dict[int, int] = {}
        self.most = most

    def find(self, a: int) -> int:
        root = self.root
        while (up := root.setdefault(a, a)) != a:
            root[a] = a = root.setdefault(up, up)  # path halving
        return a

    def join(self, x: int, y: int) -> bool:
        if len(self.root) > self.most:
            self.root.clear()  # later links may repeat a join, never lose one
        a, b = self.find(x), self.find(y)
        if a != b:
            self.root[max(a, b)] = min(a, b)
        return a != b


def _confirm(least: int):
    """The similar pairs (x, y, with their sets a and b), as a spanning forest
    of what a task sees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            sets = [batch.column(c).cast(pa.binary()) for c in ("a", "b")]
            ends = [batch.column(c).to_pylist() for c in ("x", "y")]
            hit = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), least)
                   and forest.join(x, y) for a, b, x, y in zip(*sets, *ends)]
            yield batch.select(["x", "y"]).filter(pa.array(hit, pa.bool_()))
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in shared.text_slices(batches):
            sets = [shingles(t, width) for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_id", "elements"])
    return run


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """The links (x, y) among ``pairs`` of nodes, as a spanning forest a task.
    Only texts that a pair names are read into sets again."""
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    asked = shared.stored(nodes.join(ends, "node", "left_semi").select("node", "set_id", "least"), "asked")
    texts = shared.id_text(docs)
    first = asked.select(F.col("least").alias("doc_id")).distinct()
    first = first.hint("broadcast" if asked.count() <= ASKED else "shuffle_hash")
    texts = texts.join(first, texts["doc_id"].eqNullSafe(first["doc_id"]), "left_semi")
    sets = texts.mapInArrow(_sets(width), "set_id binary, elements binary")
    sets = shared.stored(sets.join(asked, "set_id").select("node", "elements"), "set-elements")
    both = (pairs.join(sets.select(F.col("node").alias("y"), F.col("elements").alias("b")), "y")
            .join(sets.select(F.col("node").alias("x"), F.col("elements").alias("a")), "x"))
    links = both.select("x", "y", "a", "b").mapInArrow(_confirm(least), PAIRS)
    return shared.stored(links, "links")


# --- candidates -------------------------------------------------------------------

def members(keys: DataFrame) -> DataFrame:
    """(key, node, n, hub): the nodes of keys that several have. A key's hub
    meets most others under all its keys; of several, the smallest node."""
    many = keys.groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    rows = shared.stored(keys.join(many, "key"), "members")
    meets = rows.groupBy("node").agg(F.sum(F.col("many") - 1).alias("meets"))
    rows = shared.stored(rows.join(meets, "node").select("key", "node", "n", "meets"), "members")
    most = rows.groupBy("key").agg(F.max("meets").alias("meets"))
    hubs = rows.join(most, ["key", "meets"]).groupBy("key").agg(F.min("node").alias("hub"))
    return shared.stored(rows.join(hubs, "key").select("key", "node", "n", "hub"), "members")


def hub_pairs(rows: DataFrame) -> DataFrame:
    """(x, y): each node with the hub of every key it has."""
    ends = F.least("hub", "node").alias("x"), F.greatest("hub", "node").alias("y")
    return shared.stored(rows.where("node <> hub").select(*ends).distinct(), "pairs")


def _rest_pairs(least: int):
    """Pairs of a comparison step's nodes (sorted by step, then size) that
    differ in label and may be similar by size and sketch, one of them outside the hub's
    component."""
    def pairs(n, node, label, core, marks) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(b"".join(marks), np.uint8).reshape(-1, BINS)
        upper = np.searchsorted(n, n.astype(np.int64) * 100 // least, side="right")  # larger sets cannot be similar
        for k in range(len(n) - 1):
            span = slice(k + 1, int(upper[k]))
            hit = np.flatnonzero((label[span] != label[k]) & ~(core[span] & core[k])) + k + 1
            hit = hit[may_be_similar(marks[k], marks[hit], int(n[k]), n[hit], least)]
            if len(hit):
                a, b = np.minimum(node[hit], node[k]), np.maximum(node[hit], node[k])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "left", "right", "n", "node", "label", "core", "sketch")]
            if not batch.num_rows:
                continue
            cols = cols if held is None else [np.concatenate(p) for p in zip(held, cols)]
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            begin = [0, *new.tolist()]
            for a, b in zip(begin, begin[1:]):
                yield from pairs(*(c[a:b] for c in cols[3:]))
            held = [c[begin[-1]:] for c in cols]
        if held is not None:
            yield from pairs(*held[3:])
    return run


def rest_pairs(rows: DataFrame, nodes: DataFrame, labels: DataFrame, least: int = LEAST) -> DataFrame:
    """(x, y): the pairs under one key that the hubs leave open, all of them:
    labels differ, neither is the hub, at least one is outside the hub's
    component (``core`` are the nodes inside). A key with many nodes is dealt
    into parts of about ``BLOCK``; a step compares two parts, never two of the
    core."""
    own, hubs = labels.select("node", "label"), labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label"))
    rows = (rows.where("node <> hub").join(own, "node", "left").join(hubs, "hub", "left")
            .withColumn("label", F.coalesce("label", "node"))
            .withColumn("core", F.col("label") == F.coalesce("hub_label", "hub")))
    count = rows.groupBy("key").agg(F.count_if("core").alias("inside"), F.count_if(~F.col("core")).alias("outside"))
    count = count.where("outside > 0 AND inside + outside > 1").select(
        "key", F.ceil(F.col("inside") / BLOCK).cast("int").alias("cores"),
        F.ceil(F.col("outside") / BLOCK).cast("int").alias("rests"))
    rows = rows.join(count, "key").join(nodes.select("node", "sketch"), "node")
    mine = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    all_of = lambda n: F.sequence(F.lit(0), n - 1)
    none = F.array().cast("array<struct<left:int,right:int>>")
    # parts: 0.. are outside the hub's component, -1.. inside
    own = mine(F.col("rests"))
    outside = F.concat(
        F.transform(all_of(F.col("rests")), lambda k: F.struct(F.least(own, k).alias("left"), F.greatest(own, k).alias("right"))),
        F.when(F.col("cores") > 0, F.transform(
            all_of(F.col("cores")), lambda k: F.struct(own.alias("left"), (-1 - k).alias("right")))).otherwise(none))
    inside = F.transform(all_of(F.col("rests")), lambda k: F.struct(k.alias("left"), (-1 - mine(F.col("cores"))).alias("right")))
    steps = rows.select("key", "node", "n", "label", "core", "sketch", F.inline(F.when(F.col("core"), inside).otherwise(outside)))
    return shared.stored(steps.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "n")
                         .mapInArrow(_rest_pairs(least), PAIRS).distinct(), "pairs")


# --- the operator -------------------------------------------------------------------

def near_duplicates(docs: DataFrame, width: int = WIDTH, least: int = LEAST, bands: int = BANDS,
                    per_band: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    every = shared.stored(marked(docs, width, bands, per_band), "superminhash")
    nodes = distinct_sets(every)
    rows = members(keyed(nodes))
    links = confirmed(hub_pairs(rows), nodes, docs, width, least)
    labels = shared.stored(connected_components(links).withColumnRenamed("root", "label"), "labels")
    more = confirmed(rest_pairs(rows, nodes, labels, least), nodes, docs, width, least)
    if not more.isEmpty():
        labels = connected_components(links.union(more)).withColumnRenamed("root", "label")
    named = nodes.join(labels, "node", "left").select("set_id", "least", F.coalesce("label", "node").alias("label"))
    names = named.groupBy("label").agg(F.min("least").alias("name"))
    named = named.join(names, "label").select("set_id", "name")
    found = every.join(named, "set_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
