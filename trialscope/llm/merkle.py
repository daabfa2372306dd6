"""Operator 12: a Merkle manifest of the documents as a persistent tree.

Every document is a leaf of its source's tree, the sources' roots are the
leaves of one more tree; a node is the hash of up to 16 consecutive ones.
Leaves get their place by a range sort with counts (no task sees a whole
source) and are dealt out in aligned blocks of 256; a task builds the two
levels of a block, the blocks' roots are the leaves of the next tier, and so
on. From the top down each block then learns its spine: the siblings of its
root on every level above.

Trees are persistent. A changed leaf makes a new version that shares every
node but its ancestors: inside the block they are copied from the block's
nodes, above it from the spine, in the task that holds the block, so a version
never travels and a source with a third of all rows is many blocks' work.
Leaves without change stay in the first version.

Defined results: null columns enter a leaf as ``-``; documents without a
source form a tree of their own, before the others; a null doc_id comes first
in its source; rows of one doc_id are ordered by their leaf, so repeated rows
are neighbours; other columns than the five are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

FAN = 16
LEVELS = 2                 # levels of a block
BLOCK = FAN ** LEVELS
TAMPER_EVERY = 5
HEX = 64
SLICE = 32                 # blocks in a Python step
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOPS = "tree string, at long, total long, digest binary"
SPINES = "tree string, at long, spine binary, subroot binary"
NODES = "tree string, at long, doc_id long, level int, digest string"
PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def digest(nodes: bytes) -> bytes:
    """H of concatenated digests, as hex text like each of them."""
    return sha256(nodes).hexdigest().encode()


# --- the tree of one block ----------------------------------------------------

class BlockTree:
    """Up to 256 leaves and the nodes above them. A block that is a whole tree
    ends with its root; any other has both levels, also over a lone node."""

    def __init__(self, leaves: list[bytes], whole: bool):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= LEVELS:
            last = self.levels[-1]
            self.levels.append([digest(b"".join(last[k:k + FAN])) for k in range(0, len(last), FAN)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """On each level, the digests before and after the node above ``leaf``
        in its run."""
        out = []
        for level in self.levels[:-1]:
            run = level[leaf // FAN * FAN:leaf // FAN * FAN + FAN]
            out.append((b"".join(run[:leaf % FAN]), b"".join(run[leaf % FAN + 1:])))
            leaf //= FAN
        return out


def copied_path(leaf: bytes, siblings: list[tuple[bytes, bytes]]) -> list[bytes]:
    """A version: the leaf and the copies of its ancestors, up to the root.
    Every other node is the one the siblings came from."""
    path = [leaf]
    for before, after in siblings:
        path.append(digest(before + path[-1] + after))
    return path


def write_spine(siblings: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(a) // HEX, len(b) // HEX]) + a + b for a, b in siblings)


def read_spine(spine: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(spine):
        mid = at + 2 + HEX * spine[at]
        end = mid + HEX * spine[at + 1]
        out.append((spine[at + 2:mid], spine[mid:end]))
        at = end
    return out


# --- leaves and their places ---------------------------------------------------

def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaf(text: Column) -> Column:
    fields = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.encode(F.sha2(F.concat(*fields, _field(text)), 256), "UTF-8")


def tampered(doc_id: Column) -> Column:
    """Whether the check changes this document: 5 divides its id's crc32."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): ``tree`` is empty for a null source, else
    ``=`` and the source; ``changed`` is the tampered leaf, null without one."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"), "doc_id",
        _leaf(F.col("text")).alias("leaf"),
        F.when(tampered(F.col("doc_id")), _leaf(F.translate(F.col("text").cast("string"), UPPER, LOWER))).alias("changed"))


def placed(rows: DataFrame, order: list[str], tree: Column) -> DataFrame:
    """``rows`` with ``at``, each row's place in its tree, and ``total``, the
    tree's rows. ``order`` begins with what ``tree`` depends on. The sorted
    rows are written once; what is counted is one number a partition and tree."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shared.stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("__row", F.monotonically_increasing_id()), "leaves").withColumn("__tree", tree)
    part = F.shiftright("__row", 33)
    parts = rows.groupBy("__tree", part.alias("__part")).agg(F.min("__row").alias("__first"), F.count("*").alias("__n"))
    one = Window.partitionBy("__tree")
    parts = parts.select(
        "__tree", "__part", F.sum("__n").over(one).alias("total"),
        (F.coalesce(F.sum("__n").over(one.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("__first")).alias("__base"))
    return (rows.withColumn("__part", part).join(parts, ["__tree", "__part"])
            .withColumn("at", F.col("__row") + F.col("__base")).drop("__tree", "__part", "__row", "__base"))


# --- up: blocks and tiers -------------------------------------------------------

def _blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, total, items): aligned blocks of at most 256 nodes."""
    return (nodes.groupBy("tree", F.shiftright("at", BLOCK.bit_length() - 1).alias("block"), "total")
            .agg(F.sort_array(F.collect_list(F.struct("at", "digest", *carried))).alias("items")))


def _each(schema: str, make):
    """A function over Arrow batches of blocks: ``make(row, tree)`` gives the
    rows of one block. A few blocks are in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = []
                for row in batch.slice(at, SLICE).to_pylist():
                    out += make(row, BlockTree([i["digest"] for i in row["items"]], row["total"] <= BLOCK))
                yield _batch(out, schema)
    return run


def _top(row: dict, tree: BlockTree) -> list[tuple]:
    """A block's root as a node of the next tier; total 1 marks a tree's root."""
    return [(row["tree"], row["block"], -(-row["total"] // BLOCK), tree.root)]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
                                      names=[n for n, _ in fields])


def _tiers(nodes: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every tier, lowest first, and (tree, digest) of the roots."""
    tiers, roots = [], None
    while True:
        blocks = shared.stored(_blocks(nodes, *carried), "blocks")
        tops = shared.stored(blocks.mapInArrow(_each(TOPS, _top), TOPS), "tops")
        tiers.append(blocks)
        done = tops.where("total = 1").select("tree", "digest")
        roots = done if roots is None else roots.union(done)
        nodes, carried = tops.where("total > 1"), ()
        if nodes.isEmpty():
            return tiers, roots


# --- down: spines and versions ---------------------------------------------------

def _children(name: str | None):
    """For each node of a block its spine: the siblings up to the tree's root
    and what stands above that. ``name`` is the item that names a child tree."""
    def make(row: dict, tree: BlockTree) -> list[tuple]:
        return [(item[name] if name else row["tree"], 0 if name else item["at"],
                 write_spine(tree.siblings(k)) + row["spine"], item["digest"] if name else row["subroot"])
                for k, item in enumerate(row["items"])]
    return _each(SPINES, make)


def _with_spines(blocks: DataFrame, starts: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks with what stands above them: a whole tree's from ``starts``, by
    tree, any other's from the tier above, by tree and place."""
    whole = blocks.where(F.col("total") <= BLOCK).join(starts.drop("at"), "tree")
    out = whole.select(*blocks.columns, "spine", "subroot")
    if above is None:
        return out
    rest = blocks.where(F.col("total") > BLOCK).withColumnRenamed("block", "at").join(above, ["tree", "at"])
    return out.union(rest.withColumnRenamed("at", "block").select(*out.columns))


def _descend(tiers: list[DataFrame], starts: DataFrame) -> DataFrame:
    """The lowest blocks with their spines."""
    above = None
    for blocks in reversed(tiers[1:]):
        above = shared.stored(_with_spines(blocks, starts, above).mapInArrow(_children(None), SPINES), "spines")
    return _with_spines(tiers[0], starts, above)


@dataclass
class Manifest:
    """``blocks``: the documents' blocks with their spines; ``root``: of all."""

    blocks: DataFrame
    root: str | None


def build(docs: DataFrame) -> Manifest:
    """The manifest of ``docs``; its tables stay in the shared folder."""
    spark = docs.sparkSession
    # written first: the range sort reads its rows twice, the texts are read once
    rows = placed(shared.stored(leaves(docs), "leaves"), ["tree", "doc_id", "leaf"], F.col("tree"))
    tiers, subroots = _tiers(rows.withColumnRenamed("leaf", "digest"), "doc_id", "changed")
    named = placed(subroots.withColumnRenamed("tree", "name"), ["name"], F.lit("")).withColumn("tree", F.lit(""))
    top, roots = _tiers(named, "name")
    root = roots.first()
    start = spark.createDataFrame([("", 0, b"", b"")], SPINES)
    starts = shared.stored(_descend(top, start).mapInArrow(_children("name"), SPINES), "spines")
    return Manifest(_descend(tiers, starts), root.digest.decode() if root else None)


def _proofs(root: str):
    def make(row: dict, tree: BlockTree) -> list[tuple]:
        spine, subroot, out = read_spine(row["spine"]), row["subroot"].decode(), []
        first = copied_path(tree.root, spine)[-1].decode()  # of every leaf without change
        above = b"".join(a + b for a, b in spine)
        for k, item in enumerate(row["items"]):
            inside = tree.siblings(k)
            proof = sha256(b"".join(a + b for a, b in inside))
            proof.update(above)
            folded = first
            if item["changed"] is not None:
                copies = copied_path(item["changed"], inside)
                folded = copied_path(copies[-1], spine)[-1].decode()
            out.append((item["doc_id"], item["digest"].decode(), subroot, root, proof.hexdigest(), folded,
                        folded == root))
        return out
    return _each(PROOFS, make)


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""
    return manifest.blocks.mapInArrow(_proofs(manifest.root), PROOFS)


def _copies(row: dict, tree: BlockTree) -> list[tuple]:
    spine = read_spine(row["spine"])
    return [(row["tree"], item["at"], item["doc_id"], level, d.decode())
            for k, item in enumerate(row["items"]) if item["changed"] is not None
            for level, d in enumerate(copied_path(item["changed"], tree.siblings(k) + spine))]


def versions(manifest: Manifest) -> DataFrame:
    """(tree, at, doc_id, level, digest): the nodes that each tampered
    leaf's version has for itself, the leaf (level 0) to the root; all its
    other nodes are the first version's."""
    return manifest.blocks.mapInArrow(_each(NODES, _copies), NODES)


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """Every document's proof, and its root after the tampering."""
    return proofs(build(docs))
