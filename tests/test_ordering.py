"""Range-cut windows give the same answer as one plain window."""

import random

import pytest
from pyspark.sql import Window, functions as F

from keyloom.functions.predicates import key_order, sort_columns
from keyloom.plans.ordering import KeyRanges, row_numbers, sample_ranges, with_carried, with_neighbour
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of all rows; both keys repeat and may be null."""
    rng = random.Random(5)
    data = []
    for i in range(3000):
        grp = "hot" if i % 3 == 0 else f"g{rng.randrange(40)}"
        a = None if rng.random() < 0.05 else rng.randrange(6)
        b = None if rng.random() < 0.05 else rng.choice("xyz")
        data.append((i, grp, a, b, rng.random() < 0.3))
    return spark.createDataFrame(data, "recnum long, grp string, a int, b string, mark boolean").repartition(5)


@pytest.mark.parametrize("ranges", [1, 9, 150])
@pytest.mark.parametrize("by", [[], ["grp"]])
@pytest.mark.parametrize("key", [["a", "-b"]])
def test_neighbour_matches_plain_window(skewed, key, by, ranges):
    order = key_order(key, "recnum", by)
    w = Window.partitionBy(*by).orderBy(*sort_columns(order))
    for backward, fn in ((False, F.lead), (True, F.lag)):
        got = with_neighbour(skewed, order, {"near": F.col("recnum")}, by, backward, ranges)
        want = skewed.withColumn("near", fn("recnum").over(w))
        assert rows(got, "recnum", "near") == rows(want, "recnum", "near")


@pytest.mark.parametrize("ranges", [1, 9, 150])
@pytest.mark.parametrize("by", [[], ["grp"]])
def test_row_numbers_match_plain_window(skewed, by, ranges):
    order = key_order(["a", "-b"], "recnum", by)
    w = Window.partitionBy(*by).orderBy(*sort_columns(order))
    got = row_numbers(skewed, order, "n", by, ranges=ranges)
    want = skewed.withColumn("n", F.row_number().over(w).cast("long"))
    assert rows(got, "recnum", "n") == rows(want, "recnum", "n")


@pytest.mark.parametrize("ranges", [9, 150])
@pytest.mark.parametrize("by", [[], ["grp"]])
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_carry_matches_plain_window(skewed, by, ranges, backward, inclusive):
    order = key_order(["a", "-b"], "recnum", by)
    end = Window.currentRow if inclusive else -1
    w = (
        Window.partitionBy(*by)
        .orderBy(*sort_columns(order, backward))
        .rowsBetween(Window.unboundedPreceding, end)
    )
    got = with_carried(skewed, order, F.col("mark"), {"seen": F.col("recnum")}, by, backward, ranges, inclusive)
    want = skewed.withColumn("seen", F.last(F.when(F.col("mark"), F.col("recnum")), ignorenulls=True).over(w))
    assert rows(got, "recnum", "seen") == rows(want, "recnum", "seen")


def test_coarse_and_fine_agree_with_tree(skewed):
    cut = sample_ranges(skewed, key_order(["a", "-b"], "recnum"), 150)
    assert len(cut.borders) > 100
    for strict in (False, True):
        tree = cut._tree(list(enumerate(cut.borders)), 0, strict)
        both = cut.assign(skewed, "fine", strict).withColumn("tree", F.expr(tree))
        assert both.count() == skewed.count()
        assert both.where("tree != fine").count() == 0


def test_hot_group_is_cut(skewed):
    cut = sample_ranges(skewed, key_order(["a"], "recnum", ["grp"]), 30)
    sizes = cut.assign(skewed, "r").groupBy("r").count().agg(F.max("count")).first()[0]
    assert sizes < skewed.count() / 8


def test_ranges_without_rows(spark, skewed):
    cut = KeyRanges([("recnum", False)], (skewed.schema["recnum"].dataType,), ((-5,), (100,), (99999,)))
    got = row_numbers(skewed, [("recnum", False)], "n", ranges=cut)
    assert got.where("n != recnum + 1").count() == 0


def test_partitions_follow_rows(spark, monkeypatch):
    from keyloom.operators import drift as D
    from keyloom.plans import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 10)
    specs = spark.range(990).selectExpr("concat('t', id % 90) AS path", "int(id) AS segment", "2 AS length", "0 AS type")
    columns = D.created_columns(specs, specs.select("path"))
    assert "hashpartitioning(path" in (plan := columns._jdf.queryExecution().executedPlan().toString()) and ", 99)" in plan
    assert columns.count() == 990 + 90
