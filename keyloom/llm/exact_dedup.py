"""Exact duplicates by sorting content, in DataFrame operations only.

Splitters sampled from (first characters of the normalised text, its hash, doc_id) cut the sort
order into ranges of about equal row count: texts are in order of their first 32 characters, then of
a hash, which splits texts that begin alike better than more of their bytes, and of their bytes
where that is equal too.  So equal texts are neighbours, and every row is compared in full with the
row before it.  The doc_id in the splitters cuts even a group of copies that holds a third of all
rows; what such a group has in the ranges it spans is put together over one narrow row per range:
digests say which ranges may go on in the next one, and the texts of those are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keyloom.plans.lineage import cut as cut_lineage, scratch_path
from keyloom.plans.ordering import sample_ranges

LARGEST, SMALLEST = "largest", "smallest"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEAD = 32  # characters of a text that a splitter carries; the hash behind them tells the rest apart
_RANGE = "__range"


def normalised(text: str = "text") -> Column:
    """Null as empty; A-Z as a-z, all else as it is."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower())


def _sorted_runs(df: DataFrame, keep: str, survivors: bool) -> tuple[DataFrame, DataFrame]:
    """(rows with their local run, what runs that cross ranges amount to), both narrow to join.

    Rows carry doc_id, the number of their run within the range, the run's size and kept doc_id
    there, and whether the row is the one of its run that stays there.  With ``survivors`` only
    those rows are written, and carry the row of ``df`` as a struct, whose names can't clash
    with others here.  The only shuffle of texts is the one to ranges.
    """
    spark = df.sparkSession
    own = F.col("__row") if survivors else F.col("__row.doc_id").alias("doc_id")
    doc_id = F.col("__row.doc_id").cast("long")
    # a row without doc_id is the last to stay
    absent = -(1 << 63) if keep == LARGEST else (1 << 63) - 1
    sides = df.select(F.struct("*").alias("__row")).withColumn("__norm", normalised("__row.text")).select(
        "__row",
        F.substring("__norm", 1, _HEAD).alias("__head"), F.xxhash64("__norm").alias("__hash"),
        F.coalesce(doc_id, F.lit(absent)).alias("__id"),
    )
    order = [("__head", False), ("__hash", False), ("__id", False)]
    cut = sample_ranges(sides, order)
    placed = cut.assign(sides, _RANGE).repartition(_RANGE).withColumn("__norm", normalised("__row.text"))
    at = Window.partitionBy(_RANGE).orderBy("__head", "__hash", "__norm", "__id")
    marked = (
        placed.withColumn("__first", ~F.coalesce(F.col("__norm") == F.lag("__norm").over(at), F.lit(False)))
        .withColumn("__last", ~F.coalesce(F.col("__norm") == F.lead("__norm").over(at), F.lit(False)))
        .withColumn("__top", F.row_number().over(at) == 1)
        .withColumn("__end", F.lead("__hash").over(at).isNull())
        .withColumn("__run", F.sum(F.col("__first").cast("int")).over(at.rowsBetween(Window.unboundedPreceding, 0)))
    )
    run = Window.partitionBy(_RANGE, "__run")
    pick = F.max if keep == LARGEST else F.min
    local = marked.select(
        own, doc_id.alias("__doc"), _RANGE, "__run", "__top", "__end", F.col("__last" if keep == LARGEST else "__first").alias("__stays"),
        F.sha2("__norm", 256).alias("__sha"), F.when(F.col("__top") | F.col("__end"), F.col("__norm")).alias("__text"),
    ).withColumns({"__keep": pick("__doc").over(run), "__size": F.count(F.lit(1)).over(run)}).drop("__doc")
    if survivors:
        local = local.where(F.col("__stays") | F.col("__top") | F.col("__end"))
    path = scratch_path(spark, "content-sort")
    local.write.parquet(path)
    rows = spark.read.parquet(path)

    # one row per range: its first and last run, and the digests of their texts
    edges = rows.where("__top OR __end")
    ends = edges.groupBy(_RANGE).agg(
        F.max(F.when(F.col("__top"), F.col("__sha"))).alias("top"), F.max(F.when(F.col("__end"), F.col("__sha"))).alias("end"),
        F.max("__run").alias("runs"),
        F.max(F.when(F.col("__top"), F.struct("__keep", "__size"))).alias("top_run"),
        F.max(F.when(F.col("__end"), F.struct("__keep", "__size"))).alias("end_run"),
    )
    along = Window.orderBy(_RANGE)
    beside = cut_lineage(ends.withColumns({"before": F.lag(_RANGE).over(along), "meets": F.col("top") == F.lag("end").over(along)}))
    first = edges.where("__top").select(F.col(_RANGE).alias("x"), F.col("__text").alias("first"))
    last = edges.where("__end").select(F.col(_RANGE).alias("y"), F.col("__text").alias("last"))
    pairs = beside.where("meets").select(F.col(_RANGE).alias("x"), F.col("before").alias("y"))
    equal = pairs.join(first, "x").join(last, "y").where("first = last").select("x", F.lit(True).alias("equal"))
    joined = beside.join(equal, F.col(_RANGE) == F.col("x"), "left").withColumn("goes_on", F.coalesce("equal", F.lit(False))).withColumn(
        "opens", F.when(~(F.col("goes_on") & (F.col("runs") == 1)), F.col(_RANGE))
    )
    joined = joined.withColumn("opened", F.max("opens").over(along.rowsBetween(Window.unboundedPreceding, -1)))
    parts = joined.select(_RANGE, F.lit(1).alias("__run"), F.col("opened").alias("chain"), F.col("top_run.*")).where("goes_on").union(
        joined.where("opens IS NOT NULL").select(_RANGE, F.col("runs").alias("__run"), F.col("opens").alias("chain"), F.col("end_run.*"))
    )
    chain = Window.partitionBy("chain")
    chains = parts.withColumns({
        "keep": pick("__keep").over(chain), "size": F.sum("__size").over(chain), "links": F.count(F.lit(1)).over(chain),
        "bound": (F.max if keep == LARGEST else F.min)(_RANGE).over(chain),
    }).where("links > 1")
    chains = chains.select(F.col(_RANGE).alias("c_range"), F.col("__run").alias("c_run"), "keep", "size", (F.col(_RANGE) == F.col("bound")).alias("here"))
    return rows, chains


def _with_chains(rows: DataFrame, chains: DataFrame) -> DataFrame:
    on = (F.col(_RANGE) == F.col("c_range")) & (F.col("__run") == F.col("c_run"))
    return rows.join(chains, on, "left").withColumns({
        "keep_id": F.coalesce("keep", "__keep"), "group_size": F.coalesce("size", "__size"),
        "kept": F.col("__stays") & F.coalesce("here", F.lit(True)),
    })


def mark_copies(df: DataFrame, keep: str = SMALLEST) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``df``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty.  Of
    equal texts the row with the smallest (or ``largest``) doc_id stays.  Exactly one row of a
    group is kept, also among rows that repeat a doc_id.  A row without doc_id stays only if
    all of its group have none (``keep_id`` is null then).  Texts of any
    length are compared whole; an empty table gives no rows; other columns are not read.
    """
    rows, chains = _sorted_runs(df.select("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")), keep, survivors=False)
    return _with_chains(rows, chains).select("doc_id", "keep_id", "group_size", "kept", F.col("__sha").alias("text_sha256"))


def drop_copies(df: DataFrame, keep: str = SMALLEST) -> DataFrame:
    """The rows of ``df`` that ``mark_copies`` keeps, with all their columns."""
    rows, chains = _sorted_runs(df, keep, survivors=True)
    return _with_chains(rows, chains).where("kept").select("__row.*")
