"""What each of several filters removes, in every order they can be applied in.

A row fails any of five conditions, so a part of the corpus is a 2x2x2x2x2 table of counts, one
axis per filter (0 passes, 1 fails); two more tables count its good and its toxic rows.  All
figures of an order are contractions of these tables with ``pass``, ``fail`` or ``all`` along
each axis: what step k removes passes the filters before it, fails its own, and may do either in
those behind.

Spark counts the cells; the texts are read once and only their digests and flags are shuffled.
A copy is any row of a text but those with its smallest doc_id, which is found by a partial
minimum per digest: a text that a third of all rows share is one row per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keyloom.llm.common import in_batches, texts_of
from keyloom.plans.lineage import scratch_path

FILTERS = "ABCDE"
#: Fixed values of the conditions: words, distinct words a hundred, capitals a hundred, marks.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)
_AXES = len(FILTERS)
_CELLS = 1 << _AXES


def conditions(text: str) -> int:
    """Bits of the filters A to D that the text fails; E is a matter of the table."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    found = len(words) < LEAST_WORDS
    found |= (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
    found |= (100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MOST_CAPITALS * len(text)) << 2
    return found | bool(_MARKS.search(raw)) << 3


def flagged(df: DataFrame) -> DataFrame:
    """``doc_id, part, digest, fails`` of every row: the text's digest and the filters it fails, A to D."""
    types = {"doc_id": pa.int64(), "part": pa.string(), "digest": pa.binary(), "fails": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            digests = [sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            out = [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(list(map(conditions, texts)), pa.int32())]
            yield pa.RecordBatch.from_arrays(out, names=list(types))

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    return in_batches(rows, run, "doc_id long, part string, digest binary, fails int")


def cells(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, cell, n, good, toxic``: rows, good rows and toxic rows of every cell that has any."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "audit-flags")
    flagged(df).write.parquet(path)
    rows = spark.read.parquet(path).groupBy("doc_id", "digest", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    firsts = spark.read.parquet(path).where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = firsts.select(F.col("digest").alias("of"), F.col("first"))
    same = (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first"))
    copies = F.col("doc_id").isNotNull() & F.col("of").isNull()
    told = rows.join(firsts, same, "left").withColumn("cell", F.col("fails") + F.when(copies, 1 << 4).otherwise(0))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    # rows without doc_id match no label and are spread by their digests
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    marked = told.withColumn("salt", salt).join(marks.withColumn("zero", F.lit(0).cast("long")), (F.col("doc_id") == F.col("id")) & (F.col("salt") == F.col("zero")), "left")
    count = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0)))
    return marked.groupBy("part", "cell").agg(F.sum("n").alias("n"), count("good").alias("good"), count("bad").alias("toxic"))


@lru_cache(maxsize=1)
def _steps() -> list[tuple[str, int, int, tuple, tuple]]:
    """Every (order, step, its filter, selection of what it removes, of what is kept behind it)."""
    out = []
    for order in permutations(range(_AXES)):
        chosen = [_ALL] * _AXES
        for step, axis in enumerate(order, 1):
            removed = (*chosen[:axis], _FAIL, *chosen[axis + 1 :])
            chosen[axis] = _PASS
            out.append(("".join(FILTERS[a] for a in order), step, axis, removed, tuple(chosen)))
    return out


def contract(tables: np.ndarray, selection: tuple) -> np.ndarray:
    """``tables`` (any leading axes, then one per filter) with each filter's axis selected and summed."""
    return np.einsum("...abcde,a,b,c,d,e->...", tables, *map(np.array, selection))


def audit(tables: np.ndarray) -> list[tuple]:
    """Rows ``filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of one part.

    ``tables`` has axes (rows, good rows, toxic rows) and one per filter.
    """
    found = {s: contract(tables, s).tolist() for s in {s for _, _, _, *both in _steps() for s in both}}
    fails, unique, shapley = [], [], [0] * _AXES
    for axis in range(_AXES):
        only = lambda rest: (*[rest] * axis, _FAIL, *[rest] * (_AXES - axis - 1))
        fails.append(int(contract(tables[0], only(_ALL))))
        unique.append(int(contract(tables[0], only(_PASS))))
    for _, _, axis, removed, _ in _steps():
        shapley[axis] += found[removed][0]
    out = []
    for order, step, axis, removed, kept in _steps():
        n, good, toxic = found[removed]
        out.append((order, step, found[kept][0], n, fails[axis] - n, unique[axis], good, toxic, shapley[axis]))
    return out


def audit_filters(df: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part (``lang``), order of the five filters and step, zeros included.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``; ``shapley`` is what the step's filter removes, added up over all orders.

    Null text counts as empty; a null ``lang`` is the part of the empty string, together with an
    empty one.  Every row counts for itself.  Texts are equal if they are identical; a row fails E
    if a row with a smaller doc_id has its text, so rows that share the smallest doc_id pass, as
    does a row without doc_id, which makes no other a copy either.  A document is good (toxic) if
    any of its label rows says so; null labels and labels of no row count nothing.  An empty table
    gives no rows.  Other columns, whatever their names, are not read.
    """
    names = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    types = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32(), **{n: pa.int64() for n in names[2:]}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, some in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                tables = np.zeros((3, _CELLS), dtype=np.int64)
                for c in some:
                    tables[:, c["cell"]] = c["n"], c["good"], c["toxic"]
                # bit k of a cell is filter k, so the last axis of the reshaped table is the first filter
                found = audit(tables.reshape(3, *[2] * _AXES).transpose(0, *range(_AXES, 0, -1)))
                columns = [[part] * len(found), *map(list, zip(*found))]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types.values())], names=list(types))

    # a part has 32 cells at most
    parts = cells(df, labels).groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))
    return in_batches(parts, run, "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names[2:]))
