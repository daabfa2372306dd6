"""Operator 4: best-fit packing by hierarchical residual packing.

Every partition cuts its documents into pieces and packs them best-fit,
longest first. Nearly full sequences are finished. The others go on as items:
each round gathers the open sequences of several tasks into one and packs them
best-fit again, until one task has seen all that can still join. Two sequences
that are more than half full never join, and a task leaves at most one that is
not; so where too many are open for one task, only those go on which the
shortest one still fits, and of each length as many as there are such small
ones. Rounds move only (sequence, length) pairs.

Defined results: a null or empty text is the end id alone; rows with equal
doc_id are packed apart and keep equal (doc_id, piece); an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import encoder, with_end

CAPACITY = 2048
FAN_IN = 8              # open sequences of so many tasks meet in one
ROUND_ITEMS = 200_000   # open sequences of one packing task
FULL_SLACK = 0          # a sequence with so many free places is finished
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "bin long, place long, fill long")
MOVES = "item long, bin long, shift long, fill long"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, place, fill of that bin) of each size: longest first, each into
    the open bin with the least room that still suffices."""
    n = len(sizes)
    bin_of, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    fill: list[int] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if some bin has r places left
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], place[i] = b, fill[b]
        fill[b] += size
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bin_of, place, np.array(fill, np.int64)[bin_of] if n else np.zeros(0, np.int64)


def _bin_base() -> int:
    """Numbers for new sequences of this task: unique within one written round."""
    return TaskContext.get().partitionId() << 36


def _cut(length: int, capacity: int) -> list[int]:
    """Piece lengths: full ones, of which the first may be shorter."""
    first = length % capacity
    return ([first] if first else []) + [capacity] * (length // capacity)


def _packer(tokenizer: str, end_id: int, capacity: int, special: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for part in shared.text_slices(batches):
            offsets, ids = with_end(*encoder(tokenizer, special).encode(part.column("text")), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            for doc_id, a, b in zip(part.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist()):
                start = 0
                for k, n in enumerate(_cut(b - a, capacity)):
                    rows.append((doc_id, k, start, n, zlib.crc32(raw[4 * (a + start):4 * (a + start + n)])))
                    start += n
        if rows:
            cols = list(zip(*rows))
            bin_of, place, fill = best_fit(np.array(cols[3], np.int64), capacity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(cols)]
                + [pa.array(x) for x in (bin_of + _bin_base(), place, fill)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "bin", "place", "fill"])
    return pack


def _merger(capacity: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("item").to_numpy(), b.column("fill").to_numpy()) for b in batches if b.num_rows]
        if got:
            item, size = (np.concatenate(x) for x in zip(*got))
            bin_of, shift, fill = best_fit(size, capacity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (item, bin_of + _bin_base(), shift, fill)],
                names=["item", "bin", "shift", "fill"])
    return merge


def _at_most(times: int, capacity: int):
    """All small items, and of each larger fill at most ``times`` a partition."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            fill = b.column("fill").to_numpy()
            order = np.argsort(fill, kind="stable")
            ranked = fill[order]
            nth = np.empty(len(fill), np.int64)
            nth[order] = np.arange(len(fill)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(fill, minlength=capacity + 1)
            yield b.filter(pa.array((2 * fill <= capacity) | (nth < times)))
    return keep


def merge_rounds(first: DataFrame, capacity: int = CAPACITY, full_slack: int = FULL_SLACK,
                 fan_in: int = FAN_IN, round_items: int = ROUND_ITEMS) -> DataFrame:
    """(bin, root, shift) for every sequence of ``first`` (bin, fill): the
    final sequence its content moves to, and where it begins there."""
    spark = first.sparkSession
    tasks = max(1, first.rdd.getNumPartitions())
    # root ids: (round << 56) | bin, so that rounds cannot clash
    where = first.select("bin", F.col("bin").alias("root"), F.lit(0).cast("long").alias("shift"), "fill")
    left = first.where(F.col("fill") < capacity - full_slack).select(F.col("bin").alias("item"), "fill")
    for k in range(1, 64):
        n, small, least = left.agg(F.count("*"), F.count_if(2 * F.col("fill") <= capacity), F.min("fill")).first()
        if n < 2 or not small:
            break
        wanted = -(-n // round_items)
        if wanted > 1:
            # each join uses up a small one, so more of one fill are never needed, now or later
            left = left.where(F.col("fill") <= capacity - least).repartitionByRange(wanted, "fill", "item")
            left = shared.stored(left.mapInArrow(_at_most(small, capacity), left.schema), f"pack-able-{k}")
            wanted = -(-left.count() // max(round_items, 2 * capacity))
        tasks = max(-(-tasks // fan_in), wanted)
        moves = shared.stored(left.repartition(tasks).mapInArrow(_merger(capacity), MOVES), f"pack-{k}")
        moves = moves.withColumn("bin", F.col("bin") + F.lit(k << 56))
        where = shared.stored(
            where.alias("w").join(moves.alias("m"), F.col("w.root") == F.col("m.item"), "left")
            .select("w.bin", F.coalesce("m.bin", "w.root").alias("root"),
                    (F.col("w.shift") + F.coalesce("m.shift", F.lit(0))).alias("shift"),
                    F.coalesce("m.fill", "w.fill").alias("fill")), f"pack-at-{k}")
        left = moves.where((F.col("shift") == 0) & (F.col("fill") < capacity - full_slack)).select(
            F.col("bin").alias("item"), "fill")
        if tasks == 1:
            break
    else:
        raise RuntimeError("the tree of packing rounds is deeper than the numbers of its sequences allow")
    return where.select("bin", "root", "shift")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
                   special: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = shared.stored(shared.id_text(docs).mapInArrow(_packer(tokenizer, end_id, capacity, special), PIECES),
                           "pack-pieces")
    # a sequence is present once, as the piece at its start
    bins = pieces.where(F.col("place") == 0).select("bin", "fill")
    where = merge_rounds(bins, capacity)
    return pieces.join(where, "bin").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("root").alias("sequence_id"),
        (F.col("place") + F.col("shift")).alias("offset"))
