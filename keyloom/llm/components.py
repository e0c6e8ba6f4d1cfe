"""Connected components by alternating star steps, entirely on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keyloom.plans.lineage import cut

#: Edges of a partition, about: every task of a step writes files for each of its shuffles.
EDGES = 50_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(least.select("high", F.col("least").alias("low")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))")).first()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``: the smallest node it is joined to.

    Steps repeat until the edges are stars, about log n times; each is cut by a checkpoint, and
    the driver sees one count and one checksum a step.  Links to null and to itself are ignored.
    Edges get no more in a step, and few of them take few partitions.
    """
    edges = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = cut(edges.where("a IS NOT NULL AND b IS NOT NULL AND high <> low").distinct())
    before = _state(edges)
    while before[0]:
        few = -(-before[0] // EDGES)
        large = _large_star(edges.coalesce(few)).coalesce(few)
        edges = cut(_small_star(large).coalesce(few).distinct().coalesce(few))
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots)
