"""Operator 9: token ids in binary files (Simple-8b), written and read by tasks.

``write_token_files`` range-partitions the documents by doc_id, sorts inside
the partitions, encodes whole texts and streams the ids to files in a shared
folder; ``read_token_files`` reads them back. File order by (part, seq) is
doc_id order.

File: MAGIC | words and escapes of each group of blocks | footer | footer
length (u64) | MAGIC. The footer holds, little-endian: the numbers of
documents, ids, blocks and groups (u64 each), the documents' ids (i64), whether
an id is present (u8), their token counts (u64), the blocks' word and escape
counts (u32 each), and the groups' byte offsets and block counts (u64 each).
Any block can be found from the footer and decoded alone.

Defined results: a null text is empty; an empty document has only the end id;
rows with equal doc_id stand in text order; a null doc_id stands first and
reads back as null; an empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared, simple8b
from .tokens import encoder, with_end

MAGIC = b"IDS8B\x00\x00\x01"
GROUP_IDS = 256 * simple8b.BLOCK     # ids coded, written and read at a time
FILE_IDS = 128 * GROUP_IDS           # a file is closed beyond so many ids
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long, n_bytes long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class TokenFileWriter:
    """Streams documents to one file; the file appears under its name when it
    is complete, so a retried or doubled task leaves whole files only."""

    def __init__(self, path: str):
        self.fs, self.path = _open(path)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(MAGIC)
        self.size = len(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.docs: list[tuple[np.ndarray, ...]] = []
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []
        self.groups: list[tuple[int, int]] = []

    def add(self, doc_ids: np.ndarray, present: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids, present, counts))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= GROUP_IDS:
            ids = np.concatenate(self.held)
            full = len(ids) // GROUP_IDS * GROUP_IDS
            for at in range(0, full, GROUP_IDS):
                self._group(ids[at:at + GROUP_IDS])
            self.held, self.n_held = [ids[full:]], len(ids) - full

    def _group(self, ids: np.ndarray) -> None:
        words, words_at, escapes, escapes_at = simple8b.encode(ids)
        self.groups.append((self.size, len(words_at) - 1))
        self.blocks.append((np.diff(words_at), np.diff(escapes_at)))
        for x in (words, escapes):
            raw = x.astype("<u8").tobytes()
            self.out.write(raw)
            self.size += len(raw)

    def close(self) -> int:
        if self.n_held:
            self._group(np.concatenate(self.held))
        cat = lambda rows, kind: np.concatenate([np.zeros(0, kind), *rows]).astype(kind).tobytes()
        doc_ids, present, counts = zip(*self.docs) if self.docs else ((), (), ())
        words, escapes = zip(*self.blocks) if self.blocks else ((), ())
        footer = b"".join([
            struct.pack("<4Q", sum(map(len, counts)), self.n_ids, sum(map(len, words)), len(self.groups)),
            cat(doc_ids, "<i8"), cat(present, "u1"), cat(counts, "<u8"), cat(words, "<u4"),
            cat(escapes, "<u4"), np.array(self.groups, "<u8").reshape(-1, 2).T.tobytes()])
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()
        self.fs.move(self.part, self.path)
        return self.size + len(footer) + 8 + len(MAGIC)


class TokenFileReader:
    def __init__(self, path: str):
        fs, path = _open(path)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = 8 + len(MAGIC)
        self.file.seek(size - tail)
        end = self.file.read(tail)
        n = struct.unpack("<Q", end[:8])[0]
        self.file.seek(size - tail - n)
        raw = self.file.read(n)
        self.n_docs, self.n_ids, n_blocks, n_groups = struct.unpack("<4Q", raw[:32])
        at = 32

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.present = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.counts = take("<u8", self.n_docs).astype(np.int64)
        self.words, self.escapes = take("<u4", n_blocks).astype(np.int64), take("<u4", n_blocks).astype(np.int64)
        self.group_at, self.group_blocks = take("<u8", n_groups), take("<u8", n_groups).astype(np.int64)
        if end[8:] != MAGIC or at != n:
            raise ValueError(f"{path} is no complete token file")

    def groups(self) -> Iterator[np.ndarray]:
        """The file's ids in order, a group of blocks at a time."""
        first = np.cumsum(self.group_blocks) - self.group_blocks
        left = self.n_ids
        for g, at in enumerate(self.group_at):
            blocks = slice(int(first[g]), int(first[g] + self.group_blocks[g]))
            n_words, n_escapes = int(self.words[blocks].sum()), int(self.escapes[blocks].sum())
            self.file.seek(int(at))
            raw = np.frombuffer(self.file.read(8 * (n_words + n_escapes)), "<u8")
            n = min(left, int(self.group_blocks[g]) * simple8b.BLOCK)
            words_at = np.concatenate([[0], np.cumsum(self.words[blocks])])
            yield simple8b.decode(raw[:n_words], words_at, raw[n_words:], n).astype(np.uint32)
            left -= n

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, place of the first id in the file, ids) of each document."""
        groups, held, place = self.groups(), np.zeros(0, np.uint32), 0
        for i in range(self.n_docs):
            n, parts = int(self.counts[i]), []
            need = n
            while need > len(held):
                parts.append(held)
                need -= len(held)
                held = next(groups)
            parts.append(held[:need])
            held = held[need:]
            yield (int(self.doc_ids[i]) if self.present[i] else None, place,
                   parts[0] if len(parts) == 1 else np.concatenate(parts))
            place += n


def _writer(root: str, tokenizer: str, end_id: int, file_ids: int, special: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out, rows = TaskContext.get().partitionId(), 0, None, []

        def close():
            nonlocal out, seq
            size = out.close()
            rows.append((part, seq, name, sum(len(c) for _, _, c in out.docs), out.n_ids, size))
            out, seq = None, seq + 1

        for piece in shared.text_slices(batches, min(shared.SLICE_BYTES, 4 * file_ids)):
            offsets, ids = with_end(*encoder(tokenizer, special).encode(piece.column("text")), end_id)
            if out is None:
                name = f"{root}/part-{part:06d}-{seq:05d}.ids"
                out = TokenFileWriter(name)
            key = piece.column("doc_id")
            out.add(key.fill_null(0).to_numpy(zero_copy_only=False), key.is_valid().to_numpy(zero_copy_only=False),
                    np.diff(offsets), ids)
            if out.n_ids >= file_ids:
                close()
        if out is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(),
                                                              pa.int64(), pa.int64(), pa.int64()))],
                names=["part", "seq", "path", "n_docs", "n_ids", "n_bytes"])
    return write


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int = 0,
                      file_ids: int = FILE_IDS, special: bool = False) -> DataFrame:
    """Write the documents' ids in ascending doc_id order below ``root``.

    Returns the manifest, one row per file, itself written beside the files.
    """
    rows = (shared.id_text(docs).repartitionByRange("doc_id")
            .sortWithinPartitions("doc_id", "text"))
    manifest = rows.mapInArrow(_writer(root, tokenizer, end_id, file_ids, special), MANIFEST)
    manifest.write.parquet(f"{root}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _crc_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            out: list[tuple] = []
            for doc_id, place, ids in TokenFileReader(row["path"]).documents():
                out.append((doc_id, row["before"] + place, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                if len(out) == 50_000:
                    yield _digest(out)
                    out = []
            if out:
                yield _digest(out)


def _digest(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _id_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for doc_id, _, ids in TokenFileReader(path).documents():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"])


def _spread(manifest: DataFrame) -> DataFrame:
    """One file a task, as far as there are files."""
    n = manifest.sparkSession.sparkContext.defaultParallelism
    files = manifest.count()
    return manifest.repartition(max(1, min(files, max(n, files // 4))), "path")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, ids) of every document, from the files."""
    return _spread(manifest).select("path").mapInArrow(_id_reader, "doc_id long, ids array<long>")


def token_file_digest(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files.

    Where a file starts is a running sum over the manifest, one row per file
    of some hundred megabytes.
    """
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    return _spread(files).mapInArrow(_crc_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    root = shared.scratch(spark, "token-files")
    return token_file_digest(write_token_files(docs, root, tokenizer, special=True))
