"""Near-duplicates by SimHash, with candidates pruned by the pigeonring principle.

A fingerprint is cut into five segments laid on a ring.  If two fingerprints differ in at most
four bits, there is a segment from which every chain of ``l`` consecutive segments has at most
``l * 4 / 5`` differing bits: 0, 1, 2, 3, 4.  So the first segment is equal, and of the two
halves of the second one is equal too.  First segment and half are the key of an equality join
over distinct fingerprints; the rest of the chain is checked inside the join, and the full
Hamming distance last.

A key that very many fingerprints share is not paired: two fingerprints are within four bits
exactly if some value is within two bits of both.  Each such fingerprint is laid out to all
values within two bits of it, and every one is linked to the smallest at the same value.  That is
linear in the size of the group and loses no link between groups of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from keyloom.llm.common import in_batches, texts_of
from keyloom.llm.components import components
from keyloom.plans.lineage import cut

SHINGLE = 4
SEED = 42
DISTANCE = 4

# Segments on the ring: first bit and width of each.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Members up to which the fingerprints of one key are compared in pairs.
PAIRED = 2048


def fingerprint(text: str) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])], dtype=np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; eight bits are counted at a time in the bytes."""
    n, out = len(hashes), 0
    cuts, mask = np.arange(0, n, 255), np.uint64(0x0101010101010101)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & mask, cuts)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(byte) + bit)
    return out


def fingerprints(df: DataFrame) -> DataFrame:
    """``doc_id, tag, fp``: the 64 fingerprint bits as a signed long; the tag is a hash of the row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in texts_of(batch)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(prints)], names=["doc_id", "tag", "fp"])

    return in_batches(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _tag()), run, "doc_id long, tag long, fp long")


def _tag() -> Column:
    return F.xxhash64("text").alias("tag")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _bits(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND((1 << width) - 1)


def _keyed(prints: DataFrame) -> DataFrame:
    """Ten keys per fingerprint: a segment, and a half of the segment behind it."""
    keys = []
    for i, (first, width) in enumerate(SEGMENTS):
        start, size = SEGMENTS[(i + 1) % len(SEGMENTS)]
        half = size // 2
        for side, (a, n) in enumerate(((start, half), (start + half, size - half))):
            keys.append(F.lit(2 * i + side) + F.shiftleft(_bits(F.col("fp"), first, width), 4) + F.shiftleft(_bits(F.col("fp"), a, n), 17))
    return prints.select("fp", "first", F.explode(F.array(*keys)).alias("key"))


def _chain_masks(length: int) -> list[int]:
    """For each ring start, the bits of so many segments from there."""
    return [_signed(sum(((1 << w) - 1) << f for f, w in (SEGMENTS[(i + k) % 5] for k in range(length)))) for i in range(len(SEGMENTS))]


def _within_chain(a: str, b: str, key: str) -> Column:
    """The cumulative budgets of chains of two to five segments from the key's segment."""
    differing = F.col(a).bitwiseXOR(F.col(b))
    at = F.shiftright(F.col(key).bitwiseAND(15).cast("int"), 1) + 1
    good = F.lit(True)
    for length in (2, 3, 4):
        mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in _chain_masks(length)]), at)
        good = good & (F.bit_count(differing.bitwiseAND(mask)) <= length * DISTANCE // len(SEGMENTS))
    return good & (F.bit_count(differing) <= DISTANCE)


def _free_flips() -> list[list[int]]:
    """For each of the ten keys: masks of at most two bits outside the key's own bits."""
    out = []
    for i, (first, width) in enumerate(SEGMENTS):
        start, size = SEGMENTS[(i + 1) % len(SEGMENTS)]
        half = size // 2
        for a, n in ((start, half), (start + half, size - half)):
            own = {*range(first, first + width), *range(a, a + n)}
            free = [1 << b for b in range(64) if b not in own]
            out.append([0, *map(_signed, free), *(_signed(x | y) for x, y in combinations(free, 2))])
    return out


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``prints(fp, first)``, named by ``first``.

    Enough of them to join all that are within four bits of each other, in one step for keys of
    up to ``paired`` members and over a common neighbour value beyond it.
    """
    sized = _keyed(prints).withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("members > 1")
    small = sized.where(F.col("members") <= paired)
    left = small.select("key", F.col("fp").alias("fp_a"), F.col("first").alias("a"))
    right = small.select("key", F.col("fp").alias("fp_b"), F.col("first").alias("b"))
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("fp_a") < F.col("fp_b"))).drop(right["key"])
    near = pairs.where(_within_chain("fp_a", "fp_b", "key")).select("a", "b")

    flips = prints.sparkSession.createDataFrame([(tag, f) for tag, f in enumerate(_free_flips())], "tag int, flips array<long>")
    dense = sized.where(F.col("members") > paired).withColumn("tag", F.col("key").bitwiseAND(15).cast("int"))
    # ten rows of a fixed size
    laid = dense.join(F.broadcast(flips), "tag").select("key", "first", "fp", F.explode("flips").alias("flip"))
    meeting = Window.partitionBy("key", "value")
    crowd = (
        laid.select("key", "first", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
        .withColumn("least", F.min("first").over(meeting)).where("least < first")
    )
    return near.union(crowd.select(F.col("least").alias("a"), F.col("first").alias("b")))


def near_duplicates(df: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``df``.

    ``component_id`` is the smallest doc_id that can be reached over fingerprints with at most
    four differing bits, the own one included.

    Text without a word (null, empty, white space) has fingerprint zero and is linked like any
    other.  Equal fingerprints, repeated rows among them, are one class, so copies are never
    paired.  A row without doc_id takes its class's component (null if the whole class has no
    doc_id) and links nothing.  An empty table gives no rows.  Other columns are not read.
    """
    return _classed(df, paired).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _classed(df: DataFrame, paired: int) -> DataFrame:
    """``doc_id, tag, fp, component_id`` of every row."""
    prints = cut(fingerprints(df))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = components(links(classes.where("first IS NOT NULL"), paired))
    of_class = classes.join(joined, classes["first"] == joined["node"], "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component", "first").alias("component_id")
    )
    return prints.join(of_class, F.col("fp") == F.col("class_fp")).drop("class_fp")


def keep_one_of_each(df: DataFrame, paired: int = PAIRED) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the smallest doc_id stays.

    All columns stay as they are, whatever their names.  Rows without doc_id go if their class
    has one with a doc_id; else one of the class stays.  Of rows that share a doc_id and a
    fingerprint one text stays; rows equal in doc_id and text are one document and stay together.
    """
    found = _classed(df, paired).where("doc_id <=> component_id")
    stay = found.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min("tag").alias("tag")).select("doc_id", "tag")
    packed = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), _tag().alias("own_tag"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_tag") == F.col("tag"))
    return packed.join(stay, same, "left_semi").select("row.*")
