"""A Merkle manifest of a dataset: every row's proof, made by incremental witnesses.

Rows are leaves of their source's tree, in doc_id order; sixteen consecutive nodes have one
parent, and the sources' roots are the leaves of the tree above them.

Nodes are dealt out in aligned blocks of ``SPAN`` consecutive ones, so a source with a third of
all rows is many tasks' work.  A task appends the nodes of its blocks one by one: a new node
gets an empty witness and joins the open run, and when a run of siblings is complete, all
witnesses under it are extended by what stands left and right of them.  A block's root is
one append to the tree above, whose witnesses extend those of the whole block in the same way,
block of blocks by block of blocks, until every tree has one root.

A witness is built twice as long as a row is: it is never shuffled.  The first pass over the
blocks leaves their roots; the second makes the witnesses within a block, puts the ones of the
levels above behind them, and writes digests only.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keyloom.llm.common import in_batches
from keyloom.plans.lineage import scratch_path
from keyloom.plans.ordering import row_numbers

FAN = 16
#: Levels that a block is made of, and its nodes.
LEVELS = 2
TAMPERED = 5
_HEX = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Appender:
    """A tree under streaming append; with ``watch`` every node's witness is kept up to date.

    A witness is a list of (digests to the left, digests to the right), one pair per level.
    ``levels`` is the height of a block within a larger tree; None stands for a whole tree,
    which ends where one node is left.
    """

    def __init__(self, levels: int | None, watch: bool = False):
        self.levels, self.watch = levels, watch
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witnesses: list[list[tuple[str, str]]] = []
        self.size = 0

    def append(self, digest: str) -> None:
        if self.watch:
            self.witnesses.append([])
        self.size += 1
        self._join(0, digest, self.size - 1, self.size)

    def _join(self, level: int, digest: str, first: int, end: int) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        run.append((digest, first, end))
        if len(run) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        joined = "".join(digest for digest, _, _ in run)
        if self.watch:
            for i, (_, first, end) in enumerate(run):
                step = joined[: _HEX * i], joined[_HEX * (i + 1) :]
                for witness in self.witnesses[first:end]:
                    witness.append(step)
        self._join(level + 1, digest_of(joined), run[0][1], run[-1][2])

    def root(self) -> str:
        """Completes all open runs; the digest above them."""
        level = 0
        while self.levels is None or level < self.levels:
            if self.levels is None and level == len(self.open) - 1 and len(self.open[level]) == 1:
                break
            if self.open[level]:
                self._complete(level)
            level += 1
        return self.open[level][0][0]


def fold(digest: str, witness: list[tuple[str, str]]) -> str:
    """The root that a node and its witness lead to."""
    for left, right in witness:
        digest = digest_of(left + digest + right)
    return digest


def proof(witness: list[tuple[str, str]]) -> str:
    """Digest of all siblings, level by level, left to right."""
    out = sha256()
    for left, right in witness:
        out.update(left.encode())
        out.update(right.encode())
    return out.hexdigest()


_BLOCKS = {
    "tree": pa.int64(), "block": pa.int64(), "lone": pa.bool_(), "root": pa.string(), "digests": pa.list_(pa.binary()),
    "doc_ids": pa.list_(pa.int64()), "changed": pa.list_(pa.binary()),
}
_BLOCKS_SQL = "tree long, block long, lone boolean, root string, digests array<binary>, doc_ids array<bigint>, changed array<binary>"
_STEPS = "array<struct<left:string,right:string>>"


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of ``nodes(tree, pos, digest, size, doc_id, changed)`` with their roots, in the shared folder.

    ``size`` is the number of nodes of the tree; a tree of one block is ``lone`` and ends there.
    """
    span = FAN**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [], [])

        def closed() -> pa.RecordBatch:
            tree, block, lone = at
            tower = Appender(None if lone else levels)
            for digest in held[0]:
                tower.append(digest.hex())
            out = [[tree], [block], [lone], [tower.root()], *([list(x)] for x in held)]
            for x in held:
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, _BLOCKS.values())], names=list(_BLOCKS))

        for batch in batches:
            for tree, block, lone, *node in zip(*(batch.column(n).to_pylist() for n in ("tree", "block", "lone", "digest", "doc_id", "changed"))):
                if at is not None and at != (tree, block, lone):
                    yield closed()
                at = tree, block, lone
                for x, value in zip(held, node):
                    x.append(value)
        if at is not None:
            yield closed()

    placed = nodes.select("tree", F.floor(F.col("pos") / span).cast("long").alias("block"), "pos", (F.col("size") <= span).alias("lone"), "digest", "doc_id", "changed")
    met = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    path = scratch_path(nodes.sparkSession, "manifest-blocks")
    in_batches(met.drop("pos"), run, _BLOCKS_SQL).write.parquet(path)
    return nodes.sparkSession.read.parquet(path)


def _above(blocks: DataFrame, levels: int) -> DataFrame:
    """``tree, block, top, steps`` of every block: its tree's root and the witness of the block's own root."""
    own = blocks.select("tree", "block", "lone", "root")
    lone = own.where("lone").select("tree", "block", F.col("root").alias("top"), F.array().cast(_STEPS).alias("steps"))
    parts = own.where("NOT lone")
    if parts.isEmpty():
        return lone
    sizes = parts.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
    nodes = parts.join(sizes, "tree").select(
        "tree", F.col("block").alias("pos"), F.unhex("root").alias("digest"), "size",
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"),
    )
    return lone.union(_witnesses(nodes, levels).select("tree", F.col("pos").alias("block"), "top", "steps"))


def _witnesses(nodes: DataFrame, levels: int) -> DataFrame:
    """``tree, pos, digest, top, steps`` of every node: for block roots and sources, not for rows."""
    span = FAN**levels
    blocks = _blocks(nodes, levels)
    together = blocks.join(_above(blocks, levels), ["tree", "block"])
    types = {"tree": pa.int64(), "pos": pa.int64(), "digest": pa.binary(), "top": pa.string(), "steps": pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, lone, digests, top, steps in zip(*(batch.column(n).to_pylist() for n in ("tree", "block", "lone", "digests", "top", "steps"))):
                witnesses = _within(digests, lone, levels)
                whole = [[*({"left": a, "right": b} for a, b in w), *steps] for w in witnesses]
                n = len(digests)
                out = [[tree] * n, [block * span + i for i in range(n)], digests, [top] * n, whole]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

    return in_batches(together.select("tree", "block", "lone", "digests", "top", "steps"), run, f"tree long, pos long, digest binary, top string, steps {_STEPS}")


def _within(digests: list[bytes], lone: bool, levels: int) -> list[list[tuple[str, str]]]:
    tower = Appender(None if lone else levels, watch=True)
    for digest in digests:
        tower.append(digest.hex())
    tower.root()
    return tower.witnesses


def _leaf(text: Column) -> Column:
    """The digest of a row, whose text is ``text``."""
    def part(value: Column) -> list[Column]:
        written = value.cast("string")
        return [F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))]

    values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.unhex(F.sha2(F.concat(*[p for v in values for p in part(v)]).cast("binary"), 256))


def build_manifest(df: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``df``.

    Reads ``doc_id``, ``source``, ``lang``, ``n_chars`` and the whole ``text``; other columns,
    whatever their names, do not count.  ``folded_root`` is recomputed from the row's leaf (one of
    the tampered rows: with A-Z of the text lower-cased) and its siblings, and ``verified`` says
    whether it is the root.

    A null is a `-` in the leaf; rows without source are a source of their own, the first one.
    Rows without doc_id come first in their source and are never tampered with.  Rows that share
    a doc_id are leaves of their own, in the order of their digests; equal rows have equal leaves
    and proofs of their own places (which of them has which is not told apart).  An empty table
    gives no rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "manifest-leaves")
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False)) & F.col("text").isNotNull()
    df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        _leaf(F.col("text")).alias("digest"), F.when(altered, _leaf(F.translate("text", _UPPER, _UPPER.lower()))).alias("changed"),
    ).write.parquet(path)
    leaves = spark.read.parquet(path)

    path = scratch_path(spark, "manifest-sources")
    counted = leaves.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    row_numbers(counted, [("source", False)], "tree", start=0).write.parquet(path)
    sources = spark.read.parquet(path)
    named = sources.select(F.col("source").alias("of"), "tree", "size")
    rows = leaves.join(named, F.col("source").eqNullSafe(F.col("of"))).select("tree", "doc_id", "digest", "changed", "size")
    placed = row_numbers(rows, [("tree", False), ("doc_id", False), ("digest", False)], "pos", by=["tree"], start=0)
    blocks = _blocks(placed, levels)

    above = _above(blocks, levels)
    path = scratch_path(spark, "manifest-above")
    above.write.parquet(path)
    above = spark.read.parquet(path)
    subroots = above.where("block = 0").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.unhex("top").alias("digest"), F.lit(sources.count()).alias("size"),
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"),
    )
    tops = _witnesses(subroots, levels).select(F.col("pos").alias("tree"), F.col("top").alias("whole"), F.col("steps").alias("more"))
    reached = above.join(tops, "tree").select("tree", "block", F.col("top").alias("subroot"), F.col("whole").alias("root"), F.concat("steps", "more").alias("steps"))
    together = blocks.drop("root").join(reached, ["tree", "block"])

    types = {
        "doc_id": pa.int64(), "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof_sha256": pa.string(), "folded_root": pa.string(),
        "verified": pa.bool_(),
    }
    names = ("lone", "digests", "doc_ids", "changed", "subroot", "root", "steps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lone, digests, doc_ids, changed, subroot, root, steps in zip(*(batch.column(n).to_pylist() for n in names)):
                more = [(s["left"], s["right"]) for s in steps]
                whole = [w + more for w in _within(digests, lone, levels)]
                folded = [fold((new or old).hex(), w) for old, new, w in zip(digests, changed, whole)]
                n = len(digests)
                out = [doc_ids, [d.hex() for d in digests], [subroot] * n, [root] * n, list(map(proof, whole)), folded, [f == root for f in folded]]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types.values())], names=list(types))

    return in_batches(together.select(*names), run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
