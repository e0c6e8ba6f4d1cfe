"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every source has a token target.  Among all document rates that meet it and stay within
``MOST`` copies, entropy balancing takes the one closest to one copy each (in relative entropy).
Its convex dual has one multiplier per source, and the rates are the exponentially tilted
``min(MOST, exp(multiplier * size / mean size))``.  Newton steps on the dual run for all sources
at once over a histogram (source, size, documents), which Spark builds with partial counts.

Rates become whole copies by cumulative rounding: along the documents of a source, longest
first, each one gets what the rounded running sum of the rates gains.  Where rounding begins is
free, and the one of ``PHASES`` beginnings that comes closest to the target is taken.  The sums
run over ranges cut by sampled borders, so a source with a third of all rows is no single task.  All sums that
decide anything are over whole or decimal numbers, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keyloom.plans.lineage import cut, scratch_path
from keyloom.plans.ordering import sample_ranges

WEIGHTS = (5, 2, 1)
MOST = 3
STEPS = 80
TOLERANCE = 1e-9
PHASES = 32
_UNIT_BITS = 24
_UNIT = 1 << _UNIT_BITS  # one copy, in the whole numbers that are summed
_RANGE = "__range"
_SPACES = "\t\n\x0b\x0c\r"


def word_count(text: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    spaced = F.translate(F.coalesce(F.col(text), F.lit("")), _SPACES, " " * len(_SPACES))
    return F.size(F.array_remove(F.split(spaced, " "), "")).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_no, source_size, documents, target`` from ``sized(source, size)``.

    Sources in code point order, null last, take the weights in turn and share the total; a
    target stops at ``most`` times its source, and what is over is shared out again by weight.
    With the sources ordered by cap over weight the capped ones come first, so running sums
    give the level of the others.  One row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("documents"))
    numbered = sums.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("source_no") % len(weights) + 1)
    everything = Window.partitionBy()
    level = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    levelled = numbered.withColumn("weight", weight).withColumns({
        "total": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything),
        "place": F.row_number().over(level), "full": most * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "gone": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }).withColumn("share", (F.col("total") - F.col("full")) / (F.col("weights") - F.col("gone")))
    open_ = F.col("source_size") * most > F.col("share") * F.col("weight")
    first = F.min(F.when(open_, F.struct("place", "share"))).over(everything)
    capped = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return levelled.withColumn("first", first).select(
        "source", "source_no", "source_size", "documents",
        F.when(capped, (F.col("source_size") * most).cast("double")).otherwise(F.col("first.share") * F.col("weight")).alias("target"),
    )


def _rate(size: str, most: int) -> Column:
    tilted = F.least(F.lit(float(most)), F.exp(F.col("multiplier") * F.col(size) / F.col("mean")))
    return F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(tilted)


def solve_multipliers(sized: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """``targets`` with ``mean`` and the dual ``multiplier`` of every source.

    Safeguarded Newton steps on the logarithm of the taken tokens; the bracket holds the
    solution, and a step that leaves it is replaced by its middle.  The driver sees one number a
    step, the largest relative miss.
    """
    histogram = cut(
        sized.where("size > 0").join(targets.select(F.col("source").alias("s"), "source_no"), F.col("source").eqNullSafe(F.col("s")))
        .groupBy("source_no", "size").agg(F.count(F.lit(1)).alias("n"))
    )
    least = histogram.groupBy("source_no").agg(F.min("size").alias("least"))
    free = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    smallest = F.col("least") / F.col("mean")
    state = cut(
        targets.join(least, "source_no", "left").withColumn("mean", F.col("source_size") / F.greatest("documents", F.lit(1)))
        .withColumns({
            "multiplier": F.lit(0.0),
            "low": F.when(free, -F.abs(F.log(F.col("source_size") / F.col("target"))) / smallest - 1.0).otherwise(0.0),
            "high": F.when(free, F.log(F.lit(float(most))) / smallest).otherwise(0.0),
        }).drop("least")
    )
    exact = "decimal(38,6)"
    for _ in range(STEPS):
        rated = histogram.join(state.where(free), "source_no").withColumn("rate", _rate("size", most))
        words = F.col("n") * F.col("size") * F.col("rate")
        moved = F.when(F.col("rate") < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = rated.groupBy("source_no").agg(F.sum(words.cast(exact)).cast("double").alias("words"), F.sum(moved.cast(exact)).cast("double").alias("slope"))
        state = cut(state.join(sums, "source_no", "left").withColumn("miss", F.when(free, F.log(F.col("words") / F.col("target")))).withColumns({
            "low": F.when(F.col("miss") <= 0, F.col("multiplier")).otherwise(F.col("low")),
            "high": F.when(F.col("miss") >= 0, F.col("multiplier")).otherwise(F.col("high")),
        }).withColumn("newton", F.when(F.col("slope") > 0, F.col("multiplier") - F.col("miss") * F.col("words") / F.col("slope"))).withColumn(
            "multiplier",
            F.when(F.col("miss").isNull() | (F.abs("miss") < TOLERANCE), F.col("multiplier"))
            .when((F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
            .otherwise((F.col("low") + F.col("high")) / 2),
        ).drop("words", "slope", "newton"))
        if (state.agg(F.max(F.abs("miss"))).first()[0] or 0.0) < TOLERANCE:
            break
        state = state.drop("miss")
    return state.drop("miss", "low", "high")


def round_to_copies(rated: DataFrame) -> DataFrame:
    """``rated(source_no, size, target, rate, doc_id, ...)`` with whole ``copies``.

    The running sums of the rates restart per source and go along sizes, longest first, so what
    rounding adds or takes is about the gap between neighbouring sizes.
    """
    units = F.least(F.floor(F.col("rate") * _UNIT + 0.5).cast("long"), F.lit(MOST * _UNIT))
    ready = rated.withColumns({"__units": units, "__mark": F.xxhash64("doc_id"), "__id": F.col("doc_id")})
    order = [("source_no", False), ("size", True), ("__mark", False), ("__id", False)]
    placed = sample_ranges(ready, order).assign(ready, _RANGE)
    along = Window.partitionBy(_RANGE, "source_no").orderBy(F.col("size").desc(), "__mark", "__id").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy("source_no", _RANGE).agg(F.sum("__units").alias("__sum"))
    ahead = Window.partitionBy("source_no").orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source_no", _RANGE, F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__base"))
    path = scratch_path(rated.sparkSession, "mix-sums")
    summed = placed.withColumn("__run", F.sum("__units").over(along)).join(bases, ["source_no", _RANGE])
    summed.select(*rated.columns, (F.col("__base") + F.col("__run")).alias("__run"), "__units").write.parquet(path)
    out = rated.sparkSession.read.parquet(path)

    def copies(shift: Column) -> Column:
        run = F.col("__run") + shift
        return (F.shiftright(run, _UNIT_BITS) - F.shiftright(run - F.col("__units"), _UNIT_BITS)).cast("long")

    shifts = [k * _UNIT // PHASES for k in range(PHASES)]
    taken = out.groupBy("source_no", "target").agg(*[F.sum(copies(F.lit(s)) * F.col("size")).alias(f"t{k}") for k, s in enumerate(shifts)])
    misses = F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(s).cast("long").alias("shift")) for k, s in enumerate(shifts)])
    best = taken.select("source_no", F.array_min(misses)["shift"].alias("__shift"))
    return out.join(best, "source_no").withColumn("copies", copies(F.col("__shift"))).select(*rated.columns, "copies")


def mix_sources(df: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, rate, copies`` for every row of ``df``.

    ``size`` counts words, ``target`` is the source's, ``copies`` (0 to 3) is how often the mix
    takes the document and ``taken`` the words that makes.

    Null and empty texts have size 0 and take 0 words.  A null source is a source of its own,
    last in order.  Repeated rows and null doc_ids are documents of their own (rows that are
    equal in source, size and doc_id may get different copies, in no order).  An empty table
    gives no rows.  Only ``doc_id``, ``text`` and ``source`` are read.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "mix-sizes")
    df.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size")).write.parquet(path)
    sized = spark.read.parquet(path)
    targets = cut(source_targets(sized))
    solved = solve_multipliers(sized, targets).withColumnRenamed("source", "s")
    rated = sized.join(solved, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", _rate("size", MOST))
    rated = rated.select("doc_id", "source_no", "size", "source_size", "target", "rate")
    out = round_to_copies(rated)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")


def take_mix(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as the mix takes them, all columns as they are: each as often as its copies say.

    Rows that repeat a doc_id are told apart by their size.
    """
    copies = mix_sources(df).select(
        F.col("doc_id").alias("__id"), "copies", F.row_number().over(Window.partitionBy("doc_id").orderBy("size", "copies")).alias("__nth")
    )
    # the row travels as a struct, whose names can't clash with others here
    packed = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), word_count().alias("words"))
    rows = packed.withColumn("place", F.row_number().over(Window.partitionBy("own_id").orderBy("words")))
    on = F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("place") == F.col("__nth"))
    taken = rows.join(copies, on).where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("row.*")
