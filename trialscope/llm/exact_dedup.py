"""Operator 10: exact duplicates by an extendible-hash index on shared files.

Tasks normalise whole texts and fold equal ones they meet (bounded memory).
The rest is dealt to owners by the leading bits of the text's hash, so an owner
has a key range. An owner sorts its range, compares the bytes of texts under
one key, chains those that differ, and inserts one entry per text into an
extendible-hash index: a bucket that overflows is split by one more bit, which
doubles the directory where needed; entries that no bit can part go to chained
overflow pages. Each owner writes its index as one file in the shared folder.

Answers come from the index: every task asks once for each text it has, the
questions of a key range are dealt to one task, which goes from the directory
to the bucket and through its chain, and the answer returns to the rows of the
asking task. So a text that a third of all rows have is one question a task.

Defined results: a null text counts as empty, and texts of white space alone
are equal to it; rows with equal doc_id and equal text share the verdict of
that doc_id; a null doc_id stays only if its whole group has none; an empty
table gives no rows. ``keep_first`` keeps one row of each group: of the rows
that share the doc_id that stays, one with the most code points, and of rows
that are equal in that too, any one.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

SPACE = b" \t\n\v\f\r"
FOLD_BYTES = 48 << 20     # texts a task holds to fold its own copies
PAGE = 128                # entries of a bucket page
KEY_BITS = 64
MAGIC = b"XHASH\x00\x00\x01"
ENTRY = np.dtype([("key", "<u8"), ("sha", "V32"), ("doc_id", "<i8"), ("present", "u1"),
                  ("n_code", "<i8"), ("copies", "<i8")])
FOLDED = "owner int, key long, sha binary, text binary, doc_id long, n_code long, copies long"
MANIFEST = "owner int, path string, n_entries long, depth int, n_pages long"
GROUPS = "sha binary, keep_id long, group_size long"
ROWS = "doc_id long, sha binary, part int, mark long, own_code long"
ANSWERS = "sha binary, part int, keep_id long, group_size long, n_code long"


def normalised(text: bytes) -> bytes:
    return text.translate(None, SPACE)


def _better(a: tuple, b: tuple) -> bool:
    """(n_code, doc_id) a stays rather than b."""
    return a[0] > b[0] or (a[0] == b[0] and a[1] is not None and (b[1] is None or a[1] < b[1]))


def _key(sha: bytes, key_bits: int) -> int:
    return int.from_bytes(sha[:8], "big") >> (64 - key_bits)


def owner_bits_of(spark: SparkSession, key_bits: int) -> int:
    """Owners are four to a shuffle partition, so the key ranges shrink as
    partitions grow; at most 2**31 of them."""
    return min(key_bits - 1, 31, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def owner_path(root: str, owner: int) -> str:
    return f"{root}/range-{owner:06d}.xhash"


def _folder(key_bits: int, owner_bits: int, fold_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            keys = [_key(s, key_bits) for s in held]
            cols = list(zip(*held.values()))
            return pa.RecordBatch.from_arrays([
                pa.array([k >> (key_bits - owner_bits) for k in keys], pa.int32()),
                pa.array(np.array(keys, np.uint64).view(np.int64)),
                pa.array(list(held), pa.binary()), pa.array(cols[0], pa.binary()),
                *(pa.array(c, pa.int64()) for c in (cols[2], cols[1], cols[3]))],
                names=["owner", "key", "sha", "text", "doc_id", "n_code", "copies"])

        for part in shared.text_slices(batches):
            n_code = pc.utf8_length(part.column("text")).to_pylist()
            for doc_id, raw, n in zip(part.column("doc_id").to_pylist(),
                                      part.column("text").cast(pa.binary()).to_pylist(), n_code):
                text = normalised(raw)
                sha = hashlib.sha256(text).digest()
                seen = held.get(sha)
                if seen is None:
                    held[sha] = [text, n, doc_id, 1]
                    size += len(text)
                else:
                    if seen[0] != text:
                        raise ValueError("two different texts have one SHA-256")
                    seen[3] += 1
                    if _better((n, doc_id), (seen[1], seen[2])):
                        seen[1], seen[2] = n, doc_id
            if size > fold_bytes:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()
    return run


class ExtendibleIndex:
    """Buckets of at most ``page`` entries under a directory of 2**depth slots,
    addressed by the ``bits`` low bits of the key, highest first."""

    def __init__(self, bits: int, page: int = PAGE):
        self.bits, self.page, self.depth = bits, page, 0
        self.buckets: list[tuple[int, list[tuple]]] = [(0, [])]  # (local depth, entries)
        self.directory = [0]

    def _slot(self, key: int) -> int:
        return (key & ((1 << self.bits) - 1)) >> (self.bits - self.depth) if self.depth else 0

    def insert(self, entry: tuple) -> None:
        while True:
            b = self.directory[self._slot(entry[0])]
            local, entries = self.buckets[b]
            # full pages of one key cannot be split and are chained
            if len(entries) < self.page or local == self.bits or (
                    entries[0][0] == entry[0] and all(e[0] == entry[0] for e in entries)):
                entries.append(entry)
                return
            if local == self.depth:
                self.directory = [b for b in self.directory for _ in (0, 1)]
                self.depth += 1
            shift = self.bits - local - 1
            parts = [e for e in entries if not e[0] >> shift & 1], [e for e in entries if e[0] >> shift & 1]
            new = len(self.buckets)
            self.buckets[b] = (local + 1, parts[0])
            self.buckets.append((local + 1, parts[1]))
            span = 1 << (self.depth - local - 1)
            first = self.directory.index(b)
            self.directory[first + span:first + 2 * span] = [new] * span

    def write(self, path: str) -> tuple[int, int]:
        """(entries, pages); the file appears whole under its name.

        MAGIC | depth, bits, page size, buckets, pages (u32) | directory: bucket
        of each slot (u32) | buckets: first page (u32) | pages: next page or
        2**32 - 1 (u32), entries used (u32), entries.
        """
        pages: list[tuple[int, list[tuple]]] = []
        heads = []
        for _, entries in self.buckets:
            chain = [entries[k:k + self.page] for k in range(0, len(entries), self.page)] or [[]]
            heads.append(len(pages))
            for k, part in enumerate(chain):
                pages.append((len(pages) + 1 if k + 1 < len(chain) else 0xFFFFFFFF, part))
        fs, name = pafs.FileSystem.from_uri(path)
        fs.create_dir(os.path.dirname(name), recursive=True)
        part = f"{name}.{uuid.uuid4().hex}.part"
        with fs.open_output_stream(part) as out:
            out.write(MAGIC + struct.pack("<5I", self.depth, self.bits, self.page, len(heads), len(pages)))
            out.write(np.array(self.directory, "<u4").tobytes() + np.array(heads, "<u4").tobytes())
            for after, entries in pages:
                raw = np.zeros(self.page, ENTRY)
                raw[:len(entries)] = [(k, s, d or 0, d is not None, n, c) for k, s, d, n, c in entries]
                out.write(struct.pack("<2I", after, len(entries)) + raw.tobytes())
        fs.move(part, name)
        return sum(len(e) for _, e in pages), len(pages)


class IndexFile:
    """An owner's index file, opened for lookups or a whole read."""

    def __init__(self, path: str):
        fs, name = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(name)
        if self.file.read(8) != MAGIC:
            raise ValueError(f"{path} is no index file")
        self.depth, self.bits, self.page, buckets, self.n_pages = struct.unpack("<5I", self.file.read(20))
        self.directory = np.frombuffer(self.file.read(4 << self.depth), "<u4")
        self.heads = np.frombuffer(self.file.read(4 * buckets), "<u4")
        self.begin = 28 + (4 << self.depth) + 4 * buckets
        self.page_bytes = 8 + self.page * ENTRY.itemsize

    def _page(self, k: int) -> tuple[int, np.ndarray]:
        self.file.seek(self.begin + k * self.page_bytes)
        raw = self.file.read(self.page_bytes)
        after, used = struct.unpack("<2I", raw[:8])
        return after, np.frombuffer(raw, ENTRY, used, 8)

    def lookup(self, key: int) -> np.ndarray:
        """The entries under one key: a directory slot, its bucket, its chain."""
        slot = (key & ((1 << self.bits) - 1)) >> (self.bits - self.depth) if self.depth else 0
        page, found = int(self.heads[self.directory[slot]]), []
        while page != 0xFFFFFFFF:
            page, entries = self._page(page)
            found.append(entries[entries["key"] == key])
        return np.concatenate(found)

    def pages(self) -> Iterator[np.ndarray]:
        for k in range(self.n_pages):
            yield self._page(k)[1]


def _owner(root: str, key_bits: int, owner_bits: int, page: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, index, chain, key = None, None, [], None

        def close_key() -> None:
            for _, sha, doc_id, n, copies in chain:
                index.insert((key, sha, doc_id, n, copies))
            chain.clear()

        def close_owner() -> pa.RecordBatch:
            close_key()
            path = owner_path(root, owner)
            entries, pages = index.write(path)
            return pa.RecordBatch.from_arrays(
                [pa.array([owner], pa.int32()), pa.array([path]), pa.array([entries], pa.int64()),
                 pa.array([index.depth], pa.int32()), pa.array([pages], pa.int64())],
                names=["owner", "path", "n_entries", "depth", "n_pages"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("owner", "key", "sha", "text", "doc_id", "n_code", "copies")]
            for own, k, sha, text, doc_id, n, copies in zip(*cols):
                k &= (1 << 64) - 1
                if own != owner:
                    if owner is not None:
                        yield close_owner()
                    owner, index, key = own, ExtendibleIndex(key_bits - owner_bits, page), None
                if k != key:
                    close_key()
                    key = k
                for entry in chain:  # texts under this key, equal ones by their bytes
                    if entry[0] == text:
                        entry[4] += copies
                        if _better((n, doc_id), (entry[3], entry[2])):
                            entry[3], entry[2] = n, doc_id
                        break
                else:
                    chain.append([text, sha, doc_id, n, copies])
        if owner is not None:
            yield close_owner()
    return run


def build_index(docs: DataFrame, root: str, key_bits: int = KEY_BITS, page: int = PAGE,
                fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """Write the index files below ``root``; returns their manifest."""
    spark = docs.sparkSession
    owner_bits = owner_bits_of(spark, key_bits)
    folded = shared.id_text(docs).mapInArrow(_folder(key_bits, owner_bits, fold_bytes), FOLDED)
    files = (folded.repartition("owner").sortWithinPartitions("owner", "key")
             .mapInArrow(_owner(root, key_bits, owner_bits, page), MANIFEST))
    files.write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _index_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for e in IndexFile(path).pages():
                if len(e):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s.tobytes() for s in e["sha"]], pa.binary()),
                         pa.array(e["doc_id"].copy(), mask=e["present"] == 0),
                         pa.array(e["copies"].copy())], names=["sha", "keep_id", "group_size"])


def read_index(manifest: DataFrame) -> DataFrame:
    """(sha, keep_id, group_size): every entry of the index files."""
    n = manifest.count()
    return (manifest.select("path").repartition(max(1, min(n, max(64, n // 16))), "path")
            .mapInArrow(_index_reader, GROUPS))


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part_id = TaskContext.get().partitionId()
    for part in shared.text_slices(batches):
        sha = [hashlib.sha256(normalised(t)).digest() for t in part.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sha, pa.binary()), pa.array(np.full(len(sha), part_id, np.int32)),
             part.column("mark"), pc.utf8_length(part.column("text")).cast(pa.int64())],
            names=["doc_id", "sha", "part", "mark", "own_code"])


def _asker(root: str, key_bits: int, owner_bits: int):
    """Answers questions (owner, sha, part), sorted, from the owners' files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = file = sha = entry = None
        for batch in batches:
            out = []
            for own, text_sha, part in zip(*(batch.column(c).to_pylist() for c in ("owner", "sha", "part"))):
                if own != owner:
                    owner, file, sha = own, IndexFile(owner_path(root, own)), None
                if text_sha != sha:
                    sha = text_sha
                    entry = next(e for e in file.lookup(_key(sha, key_bits)) if e["sha"].tobytes() == sha)
                out.append((sha, part, int(entry["doc_id"]) if entry["present"] else None, int(entry["copies"]),
                            int(entry["n_code"])))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                    names=["sha", "part", "keep_id", "group_size", "n_code"])
    return run


def looked_up(docs: DataFrame, key_bits: int = KEY_BITS, page: int = PAGE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sha, part, mark, own_code) of every row, ``mark`` telling the
    texts of one doc_id apart, and what the index says for each (sha, part):
    keep_id, group_size and n_code, the code points of the text that stays."""
    spark = docs.sparkSession
    root = shared.scratch(spark, "exact-index")
    build_index(docs, root, key_bits, page)
    rows = shared.stored(shared.id_text(docs).withColumn("mark", F.xxhash64("text")).mapInArrow(_hasher, ROWS), "exact-rows")
    bits = owner_bits_of(spark, key_bits)
    owner = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    # the owner's bits are the highest of the key, which are the hash's first
    asked = rows.select("sha", "part").distinct().withColumn("owner", F.shiftright(owner, 32 - bits).cast("int"))
    answers = (asked.repartition("owner").sortWithinPartitions("owner", "sha")
               .mapInArrow(_asker(root, key_bits, bits), ANSWERS))
    return rows, answers


def exact_duplicates(docs: DataFrame, key_bits: int = KEY_BITS, page: int = PAGE) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row. A group
    of many copies is one index entry and one question a task; the rows of a
    task and their answers meet by (hash, task)."""
    rows, answers = looked_up(docs, key_bits, page)
    return rows.join(answers, ["sha", "part"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row, all columns, of each group: the row that stays."""
    rows, answers = looked_up(docs)
    texts = (rows.join(answers, ["sha", "part"])
             .where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("own_code") == F.col("n_code")))
             .groupBy("sha", "keep_id", "mark").agg(F.count("*").alias("rows")))
    least = texts.groupBy("sha").agg(F.min("mark").alias("mark"))
    best = texts.join(least, ["sha", "mark"])
    return shared.rows_marked(docs, best.select(F.col("keep_id").alias("doc_id"), "mark", "rows"))
