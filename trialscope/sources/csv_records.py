"""CSV with quoted line breaks, read in parallel.

Spark's multi-line CSV source gives one task a whole file, whatever its size.
Here a file is read as lines, so it splits like any text, and the lines are put
together to records afterwards:

* A line break is inside a value when the number of quotes before it is odd
  (a quote inside a quoted value is written twice, which changes nothing).
* Each block of a file counts its quotes, and the lines that begin outside a
  value if the block does, and if it does not; the running parity over the
  blocks of a file, one row a block, says which of the two it is, and the
  number of its first record.
* A block's lines go by in order in the task that reads them: a line that
  begins inside a value belongs to the record before it, which may have begun
  blocks earlier. A record within a block is put together there and then.
* What is cut by the end of a block comes as a piece from each block; only
  these pieces are shuffled, by record.
* A record is parsed by Spark's own CSV parser (`from_csv`).

No step needs a whole file in one task (a compressed file is one block), and
the text is read three times instead of being shuffled: for the counts, for
the whole records, for the pieces.

Rules: RFC 4180 quoting (quotes only around whole values), records end with
LF or CRLF, every file begins with the same header, empty records are skipped.
A value keeps its line breaks as they are. A file that ends inside a value, or
with another header, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARSER = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true",
          "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


COUNTS = "file string, block long, quotes long, begun long, begun_open long"
PIECES = "file string, record long, block long, whole boolean, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, quotes, text): every line with its block, a split of a
    file; a task reads the lines of a block one after the other."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    quotes.cast("long").alias("quotes"), F.col("value").alias("text")))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The rows of a batch, block by block."""
    file, block = batch.column("file"), batch.column("block")
    change = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
    cuts = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield (file[a].as_py(), block[a].as_py()), batch.slice(a, b - a)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: its quotes, and how many lines begin outside a value
    if the block does (`begun`) and if it begins inside one (`begun_open`)."""
    at, found = None, []
    names = [f.split()[0] for f in COUNTS.split(", ")]
    for batch in batches:
        for key, run in _runs(batch) if batch.num_rows else ():
            if key != at:
                at = key
                found.append([*key, 0, 0, 0])
            quotes, row = run.column("quotes").to_numpy(), found[-1]
            odd = int(((row[2] + np.cumsum(quotes) - quotes) % 2).sum())
            row[2] += int(quotes.sum())
            row[3] += len(quotes) - odd
            row[4] += odd
        if len(found) > 1:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in found[:-1]], _arrow(COUNTS))
            del found[:-1]
    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in found], _arrow(COUNTS))


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block, from its lines in order; `whole` is false for
    those that began in an earlier block or go on in a later one."""
    schema, at, held, record, open_, first = _arrow(PIECES), None, [], -1, 0, True

    def last(whole: bool):
        # the record that was still growing
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*at, whole), [schema.field(k) for k in ("file", "block", "whole")])]
            + [pa.array([record], pa.int64()), pa.array(["\n".join(held)], pa.string())],
            names=["file", "block", "whole", "record", "text"]).select(schema.names)

    for batch in batches:
        for key, run in _runs(batch) if batch.num_rows else ():
            if key != at:
                if held:
                    yield last(not first and not open_)
                at, held, first = key, [], True
                open_, record = run.column("open")[0].as_py(), run.column("earlier")[0].as_py() - 1
            quotes, text = run.column("quotes").to_numpy(), run.column("text")
            starts = np.flatnonzero((open_ + np.cumsum(quotes) - quotes) % 2 == 0)
            open_ = int(open_ + quotes.sum()) % 2
            head = int(starts[0]) if len(starts) else len(text)
            held += text[:head].to_pylist()
            if not len(starts):
                continue
            if held:
                yield last(not first)
            n, first = len(starts) - 1, False
            if n:
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), text)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(at[0], n), pa.array(np.arange(record + 1, record + 1 + n)), pa.repeat(at[1], n),
                    pa.repeat(True, n), pc.binary_join(lists, "\n")], schema=schema)
            record += len(starts)
            held = text[int(starts[-1]):].to_pylist()
    if held:
        yield last(not first and not open_)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): the records of the files at `path`, numbered from
    0 in each file; `text` has the line breaks inside values."""
    lines = _lines(spark, path)
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # one row per block: the parity at its start and end, then its first record
    blocks = lines.select("file", "block", "quotes").mapInArrow(_count, COUNTS)
    blocks = blocks.withColumns({"open": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2,
                                 "unclosed": F.sum("quotes").over(Window.partitionBy("file")) % 2})
    blocks = blocks.where(F.when(F.col("unclosed") == 0, True).otherwise(
        F.raise_error(F.concat(F.lit("the last quoted value is not closed in "), F.col("file")))))
    begun = F.when(F.col("open") == 0, F.col("begun")).otherwise(F.col("begun_open"))
    blocks = blocks.select("file", "block", "open", F.coalesce(F.sum(begun).over(before), F.lit(0)).alias("earlier"),
                           ((F.col("open") + F.col("quotes")) % 2).alias("open_after"))
    # the lines stay where they are read, in order: a broadcast, of one row a block
    lines = lines.join(F.broadcast(blocks), ["file", "block"])
    columns = ["file", "block", "open", "earlier", "quotes", "text"]
    whole = lines.select(*columns).mapInArrow(_put_together, PIECES).where("whole")
    cut = lines.where("open + open_after > 0").select(*columns).mapInArrow(_put_together, PIECES).where("NOT whole")
    joined = cut.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("pieces"))
    joined = joined.select("file", "record", F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"))
    every = whole.select("file", "record", "text").unionAll(joined)
    return every.select("file", "record", F.regexp_replace("text", "\r$", "").alias("text"))


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first record (only it is read)."""
    return spark.read.options(header="true", quote='"', escape='"', multiLine="true").csv(path).columns


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The files at `path` as one table. Columns are found by the header's
    names: all as text, or those of `schema` with its types (others are
    ignored). A value that does not parse is an error."""
    names = header_of(spark, path)
    kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
    if missing := sorted(set(kinds) - set(names)):
        raise ValueError(f"Missing expected columns in CSV: {missing}")
    whole = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    rows = records(spark, path).where(F.col("text") != "")
    first = F.from_csv("text", ", ".join(f"c{k} string" for k in range(len(names))), PARSER)
    expected = F.array(*[F.lit(n) for n in names])
    found = F.array(*[first[f"c{k}"] for k in range(len(names))])
    is_header = F.when(F.col("record") > 0, False).when(found == expected, True).otherwise(
        F.raise_error(F.concat(F.lit("another header in "), F.col("file"))))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields)
    # a header is no text to parse, in whatever order later filters are evaluated
    body = rows.select(F.when(~is_header, F.col("text")).alias("body")).where(F.col("body").isNotNull())
    parsed = body.select(F.from_csv("body", ddl, PARSER).alias("row"))
    return parsed.select([F.col(f"row.`{n}`").alias(n) for n in (schema.fieldNames() if schema else names)])
