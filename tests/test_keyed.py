"""Retrieval in key order on tables with known answers, and bulk forms against a loop of single ones."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import records
from keyloom.functions.codec import decode_keys, encode_records
from keyloom.functions.predicates import Cursor, Term, after_cursor, key_predicate, where_terms
from keyloom.layout import KeySpec
from keyloom.operators import joins, keyed, physical
from tests.conftest import rows


@pytest.fixture(scope="module")
def cust(spark):
    return records.customers(spark).cache()


def one(df, column="VENDOR"):
    return [r[column] for r in df.collect()]


def test_single_lookups(cust):
    key = records.CUST.key(1)
    assert one(keyed.get_greater_or_equal(cust, key, ["V-1055"])) == ["V-106"]
    assert one(keyed.get_greater(cust, key, ["V-105"])) == ["V-106"]
    assert one(keyed.get_less(cust, key, ["V-105"])) == ["V-104"]
    assert one(keyed.get_less_or_equal(cust, key, ["V-105"])) == ["V-105"]
    assert one(keyed.get_equal(cust, key, ["V-105"])) == ["V-105"]
    assert one(keyed.get_equal(cust, key, ["V-199"])) == []
    assert one(keyed.get_less(cust, key, ["V-101"])) == []
    assert one(keyed.get_first(cust, key)) == ["V-101"] and one(keyed.get_last(cust, key)) == ["V-110"]


def test_page_projects_byte_ranges(cust):
    enc = encode_records(cust, records.CUST, keep=["recnum", "VENDOR"])
    page = keyed.page_next(enc, ["VENDOR"], Cursor(("V-101",), 1), 5, extract=[(8, 0)])
    assert [bytes(r.data) for r in page.collect()] == [f"V-10{i}   ".encode() for i in range(2, 7)]
    assert keyed.page_cursor(page, ["VENDOR"]) == Cursor(("V-106",), 6)
    assert keyed.page_rows(0) is None and keyed.page_rows(0, 100, 8) == 7 and keyed.page_rows(50, 100, 8) == 7 and keyed.page_rows(3, 100, 8) == 3
    back = keyed.page_previous(enc, ["VENDOR"], Cursor(("V-103",), 3), 5)
    assert one(back) == ["V-102", "V-101"]


def test_compound_and_descending_walks(spark):
    multi = records.multi(spark)
    down = records.MULTI.key(2)
    assert one(keyed.order_by_key(multi, down).limit(4), "WEIGHT") == [90, 83, 77, 64]
    assert one(keyed.get_greater(multi, down, [83]), "WEIGHT") == [77]
    assert one(keyed.get_less(multi, down, [83]), "WEIGHT") == [90]
    key = records.MULTI.key(1)
    first = keyed.get_first(multi, key).first()
    assert (first.HALL, first.RACK, first.BIN) == ("ASH", "R1", "b1")
    image = spark.createDataFrame([(bytearray(b"OAK " + bytes(10)),)], "key binary")
    values = decode_keys(image, "key", records.MULTI, key, null_wildcard=True).first()
    found = keyed.get_greater_or_equal(multi, key, [values.HALL, values.RACK, values.BIN]).first()
    assert (found.HALL, found.RACK, found.BIN) == ("OAK", "R1", "b1")
    walk = keyed.order_by_key(records.ranked(spark), records.DESC.keys[0]).limit(5)
    assert one(walk, "SCORE") == [27, 21, 14, 9, 3]


def test_percent(cust):
    place = {r.VENDOR: r.pct for r in physical.find_percent(cust).collect()}
    assert place["V-105"] == 5000 and place["V-110"] == 10000
    percents = cust.sparkSession.createDataFrame([(5000,), (0,), (10000,), (9999,)], "pct int")
    got = {r.pct: r.VENDOR for r in physical.get_by_percent(cust, percents).collect()}
    assert got == {5000: "V-106", 0: "V-101", 10000: "V-110", 9999: "V-110"}
    assert physical.get_by_percent(cust.where("false"), percents).count() == 0


def test_terms_bind_and_before_or(cust):
    wanted = [Term("AREA", "=", "FI"), Term("CREDIT", ">", 100000, "or"), Term("TOWN", "startswith", "Gh"), Term("OPEN", "=", False, "or")]
    assert one(cust.where(where_terms(wanted)).orderBy("recnum")) == ["V-103", "V-106"]
    assert cust.where(where_terms([])).count() == 10


@pytest.fixture(scope="module")
def messy(spark):
    """Repeated and null keys, and a third of all rows under one group and one key."""
    rng = random.Random(11)
    data = []
    for i in range(400):
        hot = i % 3 == 0
        a = 5 if hot else (None if rng.random() < 0.1 else rng.randrange(12))
        b = None if rng.random() < 0.1 else rng.choice("klmno")
        data.append((i, "hot" if hot else rng.choice(["u", "v"]), a, b))
    return spark.createDataFrame(data, "recnum long, grp string, a int, b string").repartition(4).cache()


def _place(values, desc):
    """Sort place of a key: nulls first ascending, last descending."""
    out = []
    for v, d in zip(values, desc):
        known = v is not None
        number = v if isinstance(v, int) else (ord(v) if known else 0)
        out.append((-int(known), -number if known else 0) if d else (int(known), number if known else 0))
    return tuple(out)


@pytest.mark.parametrize("op", [">", ">=", "<", "<="])
@pytest.mark.parametrize("by", [(), ("grp",)])
@pytest.mark.parametrize("few", [True, False])
def test_nearest_join_matches_loop(messy, op, by, few):
    probes = messy.select(F.col("recnum").alias("pid"), "grp", F.col("a").alias("pa"), F.col("b").alias("pb"))
    got = joins.nearest_join(
        probes, messy, KeySpec.of("a", "-b"), op, by, ["pa", "pb"], take=["recnum"], ranges=9, few_probes=few
    ).select("pid", "recnum", "status")
    table, desc = messy.collect(), (False, True)
    want = []
    for p in table:
        at = _place((p.a, p.b), desc)
        pool = [r for r in table if not by or r.grp == p.grp]
        side = lambda r: _place((r.a, r.b), desc)
        if op.startswith(">"):
            pool = [r for r in pool if (side(r) > at if op == ">" else side(r) >= at)]
            best = min(pool, key=lambda r: (side(r), r.recnum), default=None)
        else:
            pool = [r for r in pool if (side(r) < at if op == "<" else side(r) <= at)]
            best = max(pool, key=lambda r: (side(r), r.recnum), default=None)
        want.append((p.recnum, best and best.recnum, 0 if best else 9))
    assert rows(got) == sorted(want, key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_identical_probes_are_all_answered(messy):
    same = messy.sparkSession.range(0, 500, 1, 4).select(F.lit(5).alias("pa"))
    got = joins.nearest_join(same, messy, ["a"], ">=", probe_key=["pa"], take=["recnum"], ranges=7)
    assert rows(got.groupBy("recnum").count()) == [(0, 500)]


def test_cursor_walk_reaches_every_row_in_order(messy):
    key = KeySpec.of("a", "-b")
    want = [r.recnum for r in keyed.order_by_key(messy, key).collect()]
    for backward, page in ((False, keyed.page_next), (True, keyed.page_previous)):
        seen, cursor = [], None
        while True:
            got = page(messy, key, cursor, 90)
            part = [r.recnum for r in got.collect()]
            seen += part
            if len(part) < 90:
                break
            cursor = keyed.page_cursor(got, key, backward=backward)
        assert seen == (want[::-1] if backward else want)


def test_equal_bulk_matches_single(messy):
    probes = messy.sparkSession.createDataFrame([(i,) for i in range(-1, 14)], "pa int")
    got = {r.pa: (r.recnum, r.status) for r in keyed.get_equal(messy, ["a"], probes=probes, probe_key=["pa"]).collect()}
    for a, found in got.items():
        single = keyed.get_equal(messy, ["a"], [a]).collect()
        assert found == ((single[0].recnum, 0) if single else (None, 4))


def test_predicates_are_pushed_down(spark, table):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    orders = table("orders")
    text = plan(orders.where(key_predicate(["o_custkey", "o_orderkey"], ">", [70, 700])))
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    assert "GreaterThanOrEqual(o_custkey,70)" in pushed and "Or(GreaterThan(o_custkey,70),And(" in pushed.replace(" ", "")
    text = plan(keyed.top_n(orders, 5, ["o_custkey"], recnum="o_orderkey", where=after_cursor(["o_custkey"], Cursor((70,), 700), "o_orderkey")))
    assert "TakeOrderedAndProject" in text and "Or(GreaterThan(o_custkey,70)" in text
    text = plan(keyed.get_first(orders, ["o_orderdate"], by=["o_custkey"], recnum="o_orderkey", keys_only=True))
    assert text.count("WindowGroupLimit") == 2 and "o_totalprice" not in text


def test_global_walk_has_no_single_partition_window(messy):
    out = keyed.with_next(messy, KeySpec.of("a"), ranges=9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    main = plan.split("BroadcastExchange")[0]
    assert "hashpartitioning(__range" in plan and "SinglePartition" not in main


def test_exists_and_ranks(messy):
    probes = messy.sparkSession.createDataFrame([(5,), (99,), (None,)], "pa int")
    got = dict(rows(keyed.key_exists(probes, messy, ["a"], ["pa"])))
    assert got == {5: True, 99: False, None: True}
    assert rows(keyed.key_exists(probes, messy, ["a"], ["pa"], "anti")) == [(99,)]
    ranks = keyed.rank_in_order(messy, KeySpec.of("a"), ["grp"], ranges=6).groupBy("grp").agg(F.max("rank"), F.count_distinct("rank"))
    assert all(top == n for _, top, n in rows(ranks))
    page = keyed.preview(messy, "a = 5", 20)
    assert page.count() == 20 and page.first().truncated


def test_arrival_numbers_are_dense(messy):
    got = physical.assign_recnum(messy.drop("recnum"), start=100).agg(F.min("recnum"), F.max("recnum"), F.count_distinct("recnum"))
    assert tuple(got.first()) == (100, 499, 400)


def test_nothing_is_cut_when_no_number_is_asked(spark):
    wide = spark.range(70_000).select(F.col("id").alias("recnum"), (F.col("id") % 7).alias("a"))
    assert keyed.page_next(wide, ["a"], None).count() == 70_000
    assert physical.step_page_next(wide, None).count() == 70_000 and physical.step_page_next(wide, None, 5000).count() == 5000
    shown = keyed.preview(wide, None, 1500)
    assert shown.count() == 1500 and shown.where("truncated").count() == 1500


def test_positions_past_32_bits(spark):
    far = spark.createDataFrame([(1, "a"), (2**32 + 1, "b")], "recnum long, v string")
    positions = physical.get_position(far, low32="short")
    assert rows(positions) == [(1, 1, 1), (2**32 + 1, 2**32 + 1, 1)]
    assert rows(physical.get_direct(physical.get_position(far), far), "recnum", "position", "v", "status") == [
        (1, 1, "a", 0), (2**32 + 1, 2**32 + 1, "b", 0),
    ]


def test_lookup_with_equal_names(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, 5, "y"), (3, 6, None)], "recnum long, k int, v string")
    probes = spark.createDataFrame([(5, 70), (6, 71), (7, 72)], "k int, recnum long")
    with pytest.raises(ValueError):
        keyed.get_equal(df, ["k"], probes=probes)
    got = keyed.get_equal(df, ["k"], probes=probes, prefix="r_")
    assert rows(got, "k", "recnum", "r_recnum", "r_k", "r_v", "status") == [(5, 70, 1, 5, "x", 0), (6, 71, 3, 6, None, 0), (7, 72, None, None, None, 4)]
    plain = keyed.get_equal(df, ["k"], probes=probes.select("k"))
    assert plain.columns == ["k", "recnum", "v", "status"] and rows(plain, "k", "recnum", "status") == [(5, 1, 0), (6, 3, 0), (7, None, 4)]
    with pytest.raises(ValueError):
        joins.nearest_join(probes, df, ["k"], ">=", probe_key=["k"])


# -- probes that ask for some segments, and frames of cursors ----------------------------


def _table(spark, rng, n=120):
    pick = lambda hi: rng.choice([None, *range(hi)])
    data = [(i, rng.randrange(3), pick(6), pick(5), pick(4)) for i in range(n)]
    return spark.createDataFrame(data, "recnum long, grp int, a int, b int, c int").cache()


@pytest.mark.parametrize("op,fn", [("=", keyed.get_equal), (">", keyed.get_greater), (">=", keyed.get_greater_or_equal), ("<", keyed.get_less), ("<=", keyed.get_less_or_equal)])
@pytest.mark.parametrize("ranges", [None, 7])
def test_partial_probes_match_single_lookups(spark, op, fn, ranges):
    rng = random.Random(21)
    df = _table(spark, rng)
    key = KeySpec.of("a", "-b", "c")
    asked = [(i, rng.choice([None, 0, 3, 5]), rng.choice([None, 1, 4]), rng.choice([None, 0, 2])) for i in range(24)] + [(90, 9, None, None), (91, None, None, None)]
    probes = spark.createDataFrame(asked, "id long, x int, y int, z int")
    extra = {} if op == "=" else {"ranges": ranges}
    found = fn(df, key, probes=probes, probe_key=["x", "y", "z"], partial=True, **extra)
    got = {r.id: (r.recnum, r.status) for r in found.collect()}
    assert len(got) == len(asked)
    for i, *values in asked:
        want = fn(df, key, values).collect()
        assert got[i] == ((want[0].recnum, 0) if want else (None, 4 if op == "=" else 9)), (op, values)


@pytest.mark.parametrize("op,fn", [(">", keyed.get_greater), ("<=", keyed.get_less_or_equal)])
def test_partial_probes_stay_in_their_group(spark, op, fn):
    rng = random.Random(22)
    df = _table(spark, rng)
    asked = [(i, i % 4, rng.choice([None, 2, 5]), rng.choice([None, 1])) for i in range(16)]
    probes = spark.createDataFrame(asked, "id long, g int, x int, y int")
    found = fn(df, ["a", "b"], probes=probes, probe_key=["x", "y"], by=["grp"], probe_by=["g"], ranges=5, partial=True)
    got = {r.id: r.recnum for r in found.collect()}
    for i, g, *values in asked:
        want = fn(df.where(F.col("grp") == g), ["a", "b"], values).collect()
        assert got[i] == (want[0].recnum if want else None), (op, g, values)


def test_partial_probes_of_empty_tables(spark):
    df = _table(spark, random.Random(1), 5)
    probes = spark.createDataFrame([(1, None), (2, 3)], "id long, x int")
    none = keyed.get_greater(df.limit(0), ["a"], probes=probes, probe_key=["x"], partial=True)
    assert rows(none, "id", "recnum", "status") == [(1, None, 9), (2, None, 9)]
    assert keyed.get_greater(df, ["a"], probes=probes.limit(0), probe_key=["x"], partial=True).count() == 0
    with pytest.raises(ValueError):
        joins.partial_join(probes.withColumn("a", F.lit(1)), df, ["a"], ">", probe_key=["x"])


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("ranges", [None, 6])
def test_pages_of_many_cursors_match_single_pages(spark, backward, ranges):
    rng = random.Random(23)
    df, key = _table(spark, rng), KeySpec.of("a", "-b")
    terms = [Term("c", ">=", 1)]
    places = [(i, rng.choice([None, 0, 2, 5, 9]), rng.choice([None, 1, 3]), rng.randrange(-5, 125)) for i in range(20)]
    cursors = spark.createDataFrame(places, "id long, x int, y int, at long")
    found = keyed.pages(df, key, cursors, 5, terms, ["x", "y"], "at", backward=backward, ranges=ranges)
    got = {}
    for r in found.orderBy("id", "place").collect():
        assert r.place == len(got.setdefault(r.id, [])) + 1
        got[r.id].append(r.recnum)
    single = keyed.page_previous if backward else keyed.page_next
    for i, x, y, at in places:
        want = [r.recnum for r in single(df, key, Cursor((x, y), at), 5, terms).collect()]
        assert got.get(i, []) == want, (x, y, at)


def test_pages_by_group(spark):
    rng = random.Random(24)
    df = _table(spark, rng)
    places = [(i, i % 4, rng.choice([None, 0, 3]), rng.randrange(120)) for i in range(12)]
    cursors = spark.createDataFrame(places, "id long, g int, x int, at long")
    found = keyed.pages(df, ["a"], cursors, 4, (), ["x"], "at", by=["grp"], cursor_by=["g"], take=["recnum"], prefix="hit_", ranges=5)
    assert found.columns == ["id", "g", "x", "at", "hit_recnum", "place"]
    got = {}
    for r in found.orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.hit_recnum)
    for i, g, x, at in places:
        want = [r.recnum for r in keyed.page_next(df.where(F.col("grp") == g), ["a"], Cursor((x,), at), 4).collect()]
        assert got.get(i, []) == want
    with pytest.raises(ValueError):
        keyed.pages(df, ["a"], cursors, 0, cursor_key=["x"], cursor_recnum="at")


def test_places_of_numbers_that_are_not_there(spark):
    df = spark.createDataFrame([(n, f"r{n}") for n in (10, 20, 30, 40)], "recnum long, name string")
    asked = spark.createDataFrame([(n,) for n in (5, 10, 25, 25, 40, 99, None)], "recnum long")
    got = rows(physical.find_percent(df, asked), "recnum", "name", "pct")
    assert sorted(got) == sorted([(5, None, 0), (10, "r10", 2500), (25, None, 5000), (40, "r40", 10000), (99, None, 10000)], key=lambda t: t[0])
    by_name = rows(physical.find_percent(df, asked, order=["-name"]), "recnum", "name", "pct")
    assert sorted(by_name) == [(5, None, 0), (10, "r10", 10000), (25, None, 0), (40, "r40", 2500), (99, None, 0)]
    assert physical.find_percent(df.limit(0), asked).where("pct <> 0").count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_percent_over_ranges(spark, ranges):
    """Ties, nulls and fewer percentages than ranges, against a sorted list."""
    rng = random.Random(ranges)
    data = [(i, rng.choice([None, 1, 1, 2, 5]), f"r{i}") for i in range(157)]
    df = spark.createDataFrame(data, "recnum long, v int, name string")
    line = [(None if v is None else v, i) for i, v, _ in sorted(data, key=lambda d: (d[1] is not None, -(d[1] or 0), d[0]))]
    asked = [-5, 0, 1, 63, 64, 5000, 9999, 10000, 20000, None]
    percents = spark.createDataFrame([(p,) for p in asked], "pct int")
    for order, ordered in ((None, sorted(i for i, _, _ in data)), (["-v"], [i for v, i in line if v is not None] + [i for v, i in line if v is None])):
        got = {r.pct: (r.recnum, r.name) for r in physical.get_by_percent(df, percents, order=order, ranges=ranges).collect()}
        want = [ordered[min(min(max(p, 0), 10000) * 157 // 10000, 156)] for p in asked if p is not None]
        assert got == {p: (i, f"r{i}") for p, i in zip(asked, want)}
    only = physical.get_by_percent(df.select("recnum"), percents.where("pct = 5000"), ranges=ranges)
    assert [tuple(r) for r in only.collect()] == [(5000, 78)]
