"""Keyed and physical retrieval, joins, windows, positions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyloom.functions.predicates import Cursor, Term, after_cursor, key_predicate, where_terms
from keyloom.layout import KeySpec
from keyloom.operators import joins, keyed, physical
from keyloom.plans.ordering import with_neighbour
from suite.common import Suite, customers, events, orders, table

S = Suite()

ORDER_KEY = KeySpec.of("o_custkey", "-o_orderdate")
EVENT_KEY = KeySpec.of("ts")

# one order's place in (o_custkey asc, o_orderdate desc, o_orderkey) order, well inside the table
MID_CUST = 60


def _mid_cursor():
    import datetime as dt

    return Cursor((MID_CUST, dt.datetime(1996, 1, 1)), 500)


AFTER_MID = """(o_custkey > 60 OR (o_custkey = 60 AND o_orderdate < TIMESTAMP '1996-01-01')
  OR (o_custkey = 60 AND o_orderdate = TIMESTAMP '1996-01-01' AND o_orderkey > 500))"""
BEFORE_MID = """(o_custkey < 60 OR (o_custkey = 60 AND o_orderdate > TIMESTAMP '1996-01-01')
  OR (o_custkey = 60 AND o_orderdate = TIMESTAMP '1996-01-01' AND o_orderkey < 500))"""
PAGE_TERMS = [Term("o_orderstatus", "=", "O"), Term("o_totalprice", ">", 100000.0)]


@S.add(
    "page_next",
    f"""SELECT o_orderkey AS recnum, o_custkey, o_orderdate, o_totalprice FROM orders
    WHERE {AFTER_MID} AND o_orderstatus = 'O' AND o_totalprice > 100000
    ORDER BY o_custkey, o_orderdate DESC, o_orderkey LIMIT 20""",
)
def page_next(spark, sf):
    page = keyed.page_next(orders(spark, sf), ORDER_KEY, _mid_cursor(), 20, PAGE_TERMS)
    return page.select("recnum", "o_custkey", "o_orderdate", "o_totalprice")


@S.add(
    "page_previous",
    f"""SELECT o_orderkey AS recnum, o_custkey, o_orderdate, o_totalprice FROM orders
    WHERE {BEFORE_MID} AND o_orderstatus = 'O' AND o_totalprice > 100000
    ORDER BY o_custkey DESC, o_orderdate, o_orderkey DESC LIMIT 20""",
)
def page_previous(spark, sf):
    page = keyed.page_previous(orders(spark, sf), ORDER_KEY, _mid_cursor(), 20, PAGE_TERMS)
    return page.select("recnum", "o_custkey", "o_orderdate", "o_totalprice")


@S.add(
    "where_terms",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
    WHERE (o_orderstatus = 'F' AND o_totalprice >= 200000) OR (o_orderpriority <> '1-URGENT' AND o_custkey <= 40)""",
)
def terms(spark, sf):
    wanted = where_terms([
        Term("o_orderstatus", "=", "F"), Term("o_totalprice", ">=", 200000.0, "or"),
        Term("o_orderpriority", "<>", "1-URGENT"), Term("o_custkey", "<=", 40, "or"),
    ])
    return table(spark, sf, "orders").where(wanted).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@S.add(
    "key_predicate",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey > 70 OR (o_custkey = 70 AND o_orderkey >= 700)",
)
def key_pred(spark, sf):
    df = table(spark, sf, "orders")
    return df.where(key_predicate(["o_custkey", "o_orderkey"], ">=", [70, 700])).select("o_orderkey", "o_custkey")


@S.add("after_cursor", f"SELECT o_orderkey AS recnum, o_custkey, o_orderdate FROM orders WHERE {AFTER_MID}")
def after(spark, sf):
    df = orders(spark, sf)
    return df.where(after_cursor(ORDER_KEY, _mid_cursor())).select("recnum", "o_custkey", "o_orderdate")


def _single(name, fn, sql_where, sql_order, value):
    @S.add(
        name,
        f"""SELECT o_orderkey AS recnum, o_custkey, o_orderdate FROM orders WHERE {sql_where}
        ORDER BY {sql_order} LIMIT 1""",
    )
    def run(spark, sf):
        found = fn(orders(spark, sf), KeySpec.of("o_custkey"), value=[value])
        return found.select("recnum", "o_custkey", "o_orderdate")


_single("get_equal", keyed.get_equal, "o_custkey = 77", "o_orderkey", 77)
_single("get_greater", keyed.get_greater, "o_custkey > 77", "o_custkey, o_orderkey", 77)
_single("get_greater_or_equal", keyed.get_greater_or_equal, "o_custkey >= 77", "o_custkey, o_orderkey", 77)
_single("get_less", keyed.get_less, "o_custkey < 77", "o_custkey DESC, o_orderkey DESC", 77)
_single("get_less_or_equal", keyed.get_less_or_equal, "o_custkey <= 77", "o_custkey DESC, o_orderkey DESC", 77)


@S.add(
    "get_equal_bulk",
    """SELECT c_custkey, r.o_orderkey AS recnum, r.o_totalprice, CASE WHEN r.o_orderkey IS NULL THEN 4 ELSE 0 END AS status
    FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) r
    ON c_custkey = r.o_custkey""",
)
def equal_bulk(spark, sf):
    probes = table(spark, sf, "customer").select("c_custkey")
    records = orders(spark, sf).select("recnum", "o_custkey", "o_totalprice")
    found = keyed.get_equal(records, ["o_custkey"], probes=probes, probe_key=["c_custkey"])
    return found.select("c_custkey", "recnum", "o_totalprice", "status")


# A union of probes and records in one order; the nearest record is carried with a window.
def _asof_sql(op: str) -> str:
    side_probe, side_rec = {">=": (0, 1), "<": (0, 1), ">": (1, 0), "<=": (1, 0)}[op]
    desc = op.startswith(">")
    direction = " DESC" if desc else ""
    return f"""WITH u AS (
      SELECT ts AS k, {side_rec} AS side, event_id AS tie, event_id AS rec, NULL AS probe FROM events
      UNION ALL
      SELECT o_orderdate + INTERVAL 36 HOUR, {side_probe}, o_orderkey, NULL, o_orderkey FROM orders),
    c AS (SELECT probe, last_value(rec IGNORE NULLS) OVER (
      ORDER BY k{direction}, side{direction}, tie{direction} ROWS UNBOUNDED PRECEDING) AS found FROM u)
    SELECT probe AS o_orderkey, found AS recnum, CASE WHEN found IS NULL THEN 9 ELSE 0 END AS status
    FROM c WHERE probe IS NOT NULL"""


def _asof(name, fn, op):
    @S.add(name, _asof_sql(op))
    def run(spark, sf):
        probes = table(spark, sf, "orders").select(
            "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 36 HOUR")).alias("at")
        )
        found = fn(events(spark, sf), EVENT_KEY, probes=probes, probe_key=["at"], keys_only=True)
        return found.select("o_orderkey", "recnum", "status")


_asof("get_greater_bulk", keyed.get_greater, ">")
_asof("get_greater_or_equal_bulk", keyed.get_greater_or_equal, ">=")
_asof("get_less_bulk", keyed.get_less, "<")
_asof("get_less_or_equal_bulk", keyed.get_less_or_equal, "<=")


# Probes with no date, no customer, or both: what they do not ask for puts no constraint on its segment.
_PARTIAL = """SELECT c_custkey, CASE WHEN c_custkey % 5 IN (1, 4) THEN NULL ELSE c_custkey + 1 END AS want_cust,
  CASE WHEN c_custkey % 5 IN (2, 4) THEN NULL ELSE TIMESTAMP '1993-01-01' + INTERVAL 1 DAY * (c_custkey % 1500) END AS want_date FROM customer"""


def _partial_sql(op: str, pick: str, place: str) -> str:
    strict = op[0]
    return f"""WITH p AS ({_PARTIAL})
    SELECT p.c_custkey, f.recnum, CASE WHEN f.recnum IS NULL THEN 9 ELSE 0 END AS status FROM p LEFT JOIN (
      SELECT p.c_custkey, {pick}(o_orderkey, {place}) AS recnum FROM p JOIN orders ON
        CASE WHEN want_cust IS NULL AND want_date IS NULL THEN true
             WHEN want_cust IS NULL THEN o_orderdate {op} want_date
             WHEN want_date IS NULL THEN o_custkey {op} want_cust
             ELSE o_custkey {strict} want_cust OR (o_custkey = want_cust AND o_orderdate {op} want_date) END
      GROUP BY p.c_custkey) f ON f.c_custkey = p.c_custkey"""


def _partial(name, fn, op, pick):
    @S.add(name, _partial_sql(op, pick, "row(o_custkey, o_orderdate, o_orderkey)"))
    def run(spark, sf):
        at = F.col("c_custkey")
        day = F.expr("timestampadd(DAY, c_custkey % 1500, TIMESTAMP_NTZ '1993-01-01')").cast(orders(spark, sf).schema["o_orderdate"].dataType)
        probes = table(spark, sf, "customer").select(
            at, F.when(~(at % 5).isin(1, 4), at + 1).alias("want_cust"), F.when(~(at % 5).isin(2, 4), day).alias("want_date")
        )
        found = fn(orders(spark, sf), ["o_custkey", "o_orderdate"], probes=probes, probe_key=["want_cust", "want_date"], keys_only=True, partial=True)
        return found.select("c_custkey", "recnum", "status")


_partial("get_greater_partial_bulk", keyed.get_greater, ">", "arg_min")
_partial("get_greater_or_equal_partial_bulk", keyed.get_greater_or_equal, ">=", "arg_min")
_partial("get_less_partial_bulk", keyed.get_less, "<", "arg_max")
_partial("get_less_or_equal_partial_bulk", keyed.get_less_or_equal, "<=", "arg_max")


# A frame of cursors: every customer's place in (customer, newest order first, order) order, and each user's in its own events.
@S.add(
    "pages_next",
    """WITH cur AS (SELECT c_custkey, TIMESTAMP '1995-06-01' AS from_date, c_custkey * 7 AS from_rec FROM customer),
    kept AS (SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderdate DESC, o_orderkey) AS n FROM orders WHERE o_orderstatus = 'O' OR o_totalprice < 50000),
    first AS (SELECT c_custkey, min(n) AS n FROM cur JOIN kept ON o_custkey > c_custkey OR (o_custkey = c_custkey AND o_orderdate < from_date)
      OR (o_custkey = c_custkey AND o_orderdate = from_date AND o_orderkey > from_rec) GROUP BY c_custkey)
    SELECT c_custkey, o_orderkey AS recnum, o_custkey, o_totalprice, (kept.n - first.n + 1)::INT AS place
    FROM first JOIN kept ON kept.n BETWEEN first.n AND first.n + 3""",
)
def pages_next(spark, sf):
    records = orders(spark, sf)
    day = F.lit("1995-06-01").cast(records.schema["o_orderdate"].dataType)
    cursors = table(spark, sf, "customer").select("c_custkey", day.alias("from_date"), (F.col("c_custkey") * 7).alias("from_rec"))
    found = keyed.pages(
        records, ORDER_KEY, cursors, 4, [Term("o_orderstatus", "=", "O", "or"), Term("o_totalprice", "<", 50000.0)],
        ["c_custkey", "from_date"], "from_rec", take=["recnum", "o_custkey", "o_totalprice"],
    )
    return found.select("c_custkey", "recnum", "o_custkey", "o_totalprice", "place")


@S.add(
    "pages_previous_by_user",
    """WITH cur AS (SELECT event_id AS cursor_event, user_id AS cursor_user, ts AS cursor_ts FROM events WHERE event_type = 'purchase'),
    ranked AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
    SELECT cursor_event, e.event_id AS recnum, e.value, (c.n - e.n)::INT AS place FROM cur
    JOIN ranked c ON c.event_id = cursor_event JOIN ranked e ON e.user_id = cursor_user AND e.n BETWEEN c.n - 3 AND c.n - 1""",
)
def pages_previous(spark, sf):
    records = events(spark, sf)
    cursors = records.where("event_type = 'purchase'").select(F.col("recnum").alias("cursor_event"), F.col("user_id").alias("cursor_user"), F.col("ts").alias("cursor_ts"))
    found = keyed.pages(
        records, EVENT_KEY, cursors, 3, cursor_key=["cursor_ts"], cursor_recnum="cursor_event", by=["user_id"], cursor_by=["cursor_user"],
        backward=True, take=["recnum", "value"],
    )
    return found.select("cursor_event", "recnum", "value", "place")


@S.add(
    "nearest_join_by_user",
    """WITH u AS (
      SELECT user_id, ts AS k, 0 AS side, event_id AS tie, event_id AS rec, value AS v, NULL AS probe
        FROM events WHERE event_type = 'purchase'
      UNION ALL SELECT user_id, ts, 1, event_id, NULL, NULL, event_id FROM events WHERE event_type <> 'purchase'),
    c AS (SELECT probe,
        last_value(rec IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k, side, tie ROWS UNBOUNDED PRECEDING) AS rec,
        last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k, side, tie ROWS UNBOUNDED PRECEDING) AS v FROM u)
    SELECT probe AS event_id, rec AS near_recnum, v AS near_value, CASE WHEN rec IS NULL THEN 9 ELSE 0 END AS status
    FROM c WHERE probe IS NOT NULL""",
)
def nearest_by_user(spark, sf):
    all_events = table(spark, sf, "events")
    probes = all_events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    records = all_events.where("event_type = 'purchase'").select(F.col("event_id").alias("recnum"), "user_id", "ts", "value")
    found = joins.nearest_join(probes, records, ["ts"], "<=", by=["user_id"], take=["recnum", "value"], prefix="near_")
    return found.select("event_id", "near_recnum", "near_value", "status")


@S.add(
    "nearest_join_global",
    """SELECT c_custkey, r.o_orderkey AS recnum, r.o_totalprice, CASE WHEN r.o_orderkey IS NULL THEN 9 ELSE 0 END AS status
    FROM (SELECT c.c_custkey, (SELECT min(o_totalprice) FROM orders o WHERE o_totalprice > c_acctbal * 20) AS p FROM customer c) c
    LEFT JOIN (SELECT o_totalprice, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_totalprice) r ON r.o_totalprice = c.p""",
)
def nearest_global(spark, sf):
    probes = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") * 20).alias("wanted"))
    records = orders(spark, sf).select("recnum", "o_totalprice")
    found = joins.nearest_join(probes, records, ["o_totalprice"], ">", probe_key=["wanted"])
    return found.select("c_custkey", "recnum", "o_totalprice", "status")


@S.add(
    "lookup_join",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, o_totalprice, o_orderstatus FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey""",
)
def lookup(spark, sf):
    probes = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    records = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    found = joins.lookup_join(probes, records, ["o_orderkey"], "inner", ["l_orderkey"], "o_orderkey", unique=True)
    return found.drop("o_orderkey")


@S.add(
    "direct_join",
    """SELECT c_custkey AS position, o_orderstatus, o_totalprice, CASE WHEN o_orderkey IS NULL THEN 9 ELSE 0 END AS status
    FROM customer LEFT JOIN orders ON o_orderkey = c_custkey * 11""".replace("c_custkey AS position", "c_custkey * 11 AS position"),
)
def direct(spark, sf):
    positions = table(spark, sf, "customer").select((F.col("c_custkey") * 11).alias("position"))
    records = orders(spark, sf).select("recnum", "o_orderstatus", "o_totalprice")
    return joins.direct_join(positions, records).select("position", "o_orderstatus", "o_totalprice", "status")


S.add("get_direct", S.sql["direct_join"])(
    lambda spark, sf: physical.get_direct(
        table(spark, sf, "customer").select((F.col("c_custkey") * 11).alias("position")),
        orders(spark, sf).select("recnum", "o_orderstatus", "o_totalprice"),
    ).select("position", "o_orderstatus", "o_totalprice", "status")
)


def _ends(name, fn, sql_order, by):
    partition = "PARTITION BY o_custkey " if by else ""

    @S.add(
        name,
        f"""SELECT o_orderkey AS recnum, o_custkey, o_orderdate FROM orders
        QUALIFY row_number() OVER ({partition}ORDER BY {sql_order}) = 1""",
    )
    def run(spark, sf):
        key = KeySpec.of("-o_orderdate") if by else ORDER_KEY
        return fn(orders(spark, sf), key, by=["o_custkey"] if by else []).select("recnum", "o_custkey", "o_orderdate")


_ends("get_first", keyed.get_first, "o_custkey, o_orderdate DESC, o_orderkey", False)
_ends("get_last", keyed.get_last, "o_custkey DESC, o_orderdate, o_orderkey DESC", False)
_ends("get_first_by_customer", keyed.get_first, "o_orderdate DESC, o_orderkey", True)
_ends("get_last_by_customer", keyed.get_last, "o_orderdate, o_orderkey DESC", True)


def _walk(name, fn, word, sql_fn, by):
    partition = "PARTITION BY user_id " if by else ""

    @S.add(
        name,
        f"""SELECT event_id AS recnum, {sql_fn}(event_id) OVER w AS {word}_recnum, {sql_fn}(ts) OVER w AS {word}_ts
        FROM events WINDOW w AS ({partition}ORDER BY ts, event_id)""",
    )
    def run(spark, sf):
        out = fn(events(spark, sf), EVENT_KEY, by=["user_id"] if by else [], keys_only=True)
        return out.select("recnum", f"{word}_recnum", f"{word}_ts")


_walk("with_next_by_user", keyed.with_next, "next", "lead", True)
_walk("with_previous_by_user", keyed.with_previous, "previous", "lag", True)
_walk("with_next", keyed.with_next, "next", "lead", False)
_walk("with_previous", keyed.with_previous, "previous", "lag", False)


@S.add(
    "with_next_mixed_directions",
    """SELECT o_orderkey AS recnum, o_totalprice, lead(o_orderkey) OVER w AS next_recnum FROM orders
    WINDOW w AS (ORDER BY o_custkey, o_orderdate DESC, o_orderkey)""",
)
def next_mixed(spark, sf):
    out = keyed.with_next(orders(spark, sf), ORDER_KEY, take=["recnum"])
    return out.select("recnum", "o_totalprice", "next_recnum")


@S.add(
    "bucketed_window",
    """SELECT o_orderkey AS recnum, lag(o_orderkey) OVER w AS before FROM orders
    WINDOW w AS (ORDER BY o_totalprice DESC, o_orderkey)""",
)
def bucketed(spark, sf):
    df = orders(spark, sf).select("recnum", "o_totalprice")
    out = with_neighbour(
        df, [("o_totalprice", True), ("recnum", False)], {"before": F.col("recnum")}, backward=True, ranges=100
    )
    return out.select("recnum", "before")


def _after_one(name, fn, cond, sql_order):
    @S.add(
        name,
        f"SELECT o_orderkey AS recnum, o_custkey, o_orderdate FROM orders WHERE {cond} ORDER BY {sql_order} LIMIT 1",
    )
    def run(spark, sf):
        return fn(orders(spark, sf), ORDER_KEY, _mid_cursor(), keys_only=True).select("recnum", "o_custkey", "o_orderdate")


_after_one("next_after_cursor", keyed.next_after, AFTER_MID, "o_custkey, o_orderdate DESC, o_orderkey")
_after_one("previous_before_cursor", keyed.previous_before, BEFORE_MID, "o_custkey DESC, o_orderdate, o_orderkey DESC")


@S.add(
    "key_exists",
    "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS \"exists\" FROM customer",
)
def exists_flag(spark, sf):
    return keyed.key_exists(table(spark, sf, "customer").select("c_custkey"), orders(spark, sf), ["o_custkey"], ["c_custkey"])


@S.add("key_exists_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def exists_semi(spark, sf):
    probes = table(spark, sf, "customer").select("c_custkey")
    return keyed.key_exists(probes, orders(spark, sf), ["o_custkey"], ["c_custkey"], "semi")


@S.add(
    "key_exists_anti",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""",
)
def exists_anti(spark, sf):
    probes = table(spark, sf, "customer").select("c_custkey")
    urgent = orders(spark, sf).where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'")
    return keyed.key_exists(probes, urgent, ["o_custkey"], ["c_custkey"], "anti")


def _keys_only(name, fn, cond, sql_order):
    @S.add(
        name,
        f"SELECT o_custkey, o_orderkey AS recnum FROM orders {cond} ORDER BY {sql_order} LIMIT 1",
    )
    def run(spark, sf):
        key = KeySpec.of("o_custkey")
        return fn(orders(spark, sf), key).select("o_custkey", "recnum")


_FWD, _BACK = "o_custkey, o_orderkey", "o_custkey DESC, o_orderkey DESC"
_keys_only("keys_only_first", lambda d, k: keyed.get_first(d, k, keys_only=True), "", _FWD)
_keys_only("keys_only_last", lambda d, k: keyed.get_last(d, k, keys_only=True), "", _BACK)
_keys_only("keys_only_greater", lambda d, k: keyed.get_greater(d, k, [50], keys_only=True), "WHERE o_custkey > 50", _FWD)
_keys_only("keys_only_greater_or_equal", lambda d, k: keyed.get_greater_or_equal(d, k, [50], keys_only=True), "WHERE o_custkey >= 50", _FWD)
_keys_only("keys_only_less", lambda d, k: keyed.get_less(d, k, [50], keys_only=True), "WHERE o_custkey < 50", _BACK)
_keys_only("keys_only_less_or_equal", lambda d, k: keyed.get_less_or_equal(d, k, [50], keys_only=True), "WHERE o_custkey <= 50", _BACK)
_keys_only("keys_only_next", lambda d, k: keyed.next_after(d, k, Cursor((50,), 900), keys_only=True),
           "WHERE o_custkey > 50 OR (o_custkey = 50 AND o_orderkey > 900)", _FWD)
_keys_only("keys_only_previous", lambda d, k: keyed.previous_before(d, k, Cursor((50,), 900), keys_only=True),
           "WHERE o_custkey < 50 OR (o_custkey = 50 AND o_orderkey < 900)", _BACK)


def _step(name, run, sql):
    S.add(name, f"SELECT o_orderkey AS recnum, o_custkey, o_totalprice FROM orders {sql}")(
        lambda spark, sf: run(orders(spark, sf)).select("recnum", "o_custkey", "o_totalprice")
    )


_step("step_first", physical.step_first, "ORDER BY o_orderkey LIMIT 1")
_step("step_last", physical.step_last, "ORDER BY o_orderkey DESC LIMIT 1")
_step("step_next", lambda d: physical.step_next(d, 400, 25), "WHERE o_orderkey > 400 ORDER BY o_orderkey LIMIT 25")
_step("step_previous", lambda d: physical.step_previous(d, 400, 25), "WHERE o_orderkey < 400 ORDER BY o_orderkey DESC LIMIT 25")

LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@S.add(
    "assign_recnum",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS recnum FROM lineitem",
)
def numbered(spark, sf):
    out = physical.assign_recnum(table(spark, sf, "lineitem"), LINE_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "recnum")


_LINES = f"(SELECT *, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) AS recnum FROM lineitem)"
STEP_TERMS = [Term("l_returnflag", "=", "R"), Term("l_quantity", ">=", 10.0, "or"), Term("l_linestatus", "=", "F")]
_STEP_COND = "((l_returnflag = 'R' AND l_quantity >= 10) OR l_linestatus = 'F')"


def _step_page(name, fn, cond, direction):
    @S.add(
        name,
        f"""SELECT recnum, l_orderkey, l_quantity FROM {_LINES} WHERE {cond} AND {_STEP_COND}
        ORDER BY recnum {direction} LIMIT 256""",
    )
    def run(spark, sf):
        lines = physical.assign_recnum(table(spark, sf, "lineitem"), LINE_ORDER)
        return fn(lines, 3000, physical.STEP_DEFAULT, STEP_TERMS).select("recnum", "l_orderkey", "l_quantity")

    @S.add(
        f"{name}_all",
        f"SELECT recnum, l_orderkey, l_quantity FROM {_LINES} WHERE {cond} AND {_STEP_COND}",
    )
    def run_all(spark, sf):
        """Without a number: every record on that side, more than one step ever returned."""
        lines = physical.assign_recnum(table(spark, sf, "lineitem"), LINE_ORDER)
        return fn(lines, 3000, terms=STEP_TERMS).select("recnum", "l_orderkey", "l_quantity")


_step_page("step_page_next", physical.step_page_next, "recnum > 3000", "")
_step_page("step_page_previous", physical.step_page_previous, "recnum < 3000", "DESC")


@S.add(
    "get_position",
    "SELECT o_orderkey AS recnum, o_orderkey AS position FROM orders WHERE o_orderstatus = 'P'",
)
def position(spark, sf):
    return physical.get_position(orders(spark, sf), F.col("o_orderstatus") == "P")


@S.add(
    "get_by_percent",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS rk, count(*) OVER () AS n FROM orders),
    p AS (SELECT DISTINCT (s_suppkey * 997) % 10001 AS pct FROM supplier)
    SELECT pct, o_orderkey AS recnum, o_totalprice FROM p JOIN r ON rk = least(pct * n // 10000, n - 1)""",
)
def by_percent(spark, sf):
    percents = table(spark, sf, "supplier").select(((F.col("s_suppkey") * 997) % 10001).alias("pct")).distinct()
    return physical.get_by_percent(orders(spark, sf).select("recnum", "o_totalprice"), percents)


@S.add(
    "get_by_percent_key_order",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rk, count(*) OVER () AS n FROM orders),
    p AS (SELECT DISTINCT s_suppkey * 13 AS pct FROM supplier)
    SELECT pct, o_orderkey AS recnum, o_totalprice FROM p JOIN r ON rk = least(least(pct, 10000) * n // 10000, n - 1)""",
)
def by_percent_key(spark, sf):
    percents = table(spark, sf, "supplier").select((F.col("s_suppkey") * 13).alias("pct")).distinct()
    df = orders(spark, sf).select("recnum", "o_totalprice")
    return physical.get_by_percent(df, percents, order=["-o_totalprice"])


@S.add(
    "find_percent",
    """SELECT c_custkey AS recnum, row_number() OVER (ORDER BY c_custkey) * 10000 // count(*) OVER () AS pct FROM customer""",
)
def percent_of(spark, sf):
    return physical.find_percent(customers(spark, sf).select("recnum"))


@S.add(
    "find_percent_asked",
    """WITH a AS (SELECT o_orderkey * 3 - 40 AS recnum FROM orders WHERE o_orderkey % 7 = 0)
    SELECT recnum, (SELECT count(*) FROM orders WHERE o_orderkey <= recnum) * 10000 // (SELECT count(*) FROM orders) AS pct FROM a""",
)
def percent_asked(spark, sf):
    df = orders(spark, sf).select("recnum")
    return physical.find_percent(df, df.where("recnum % 7 = 0").select((F.col("recnum") * 3 - 40).alias("recnum")))


@S.add(
    "find_percent_key_order",
    """SELECT c_custkey AS recnum, row_number() OVER (ORDER BY c_acctbal, c_custkey) * 10000 // count(*) OVER () AS pct FROM customer""",
)
def percent_of_key(spark, sf):
    return physical.find_percent(customers(spark, sf).select("recnum", "c_acctbal"), order=["c_acctbal"]).drop("c_acctbal")


@S.add(
    "rank_by_user",
    "SELECT event_id AS recnum, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rank FROM events",
)
def rank_by(spark, sf):
    df = events(spark, sf).select("recnum", "user_id", "ts")
    return keyed.rank_in_order(df, EVENT_KEY, ["user_id"]).select("recnum", "rank")


@S.add("rank_global", "SELECT event_id AS recnum, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events")
def rank_all(spark, sf):
    df = events(spark, sf).select("recnum", "value")
    return keyed.rank_in_order(df, ["-value"]).select("recnum", "rank")


@S.add(
    "order_by_key",
    """SELECT o_orderkey AS recnum, o_custkey, o_orderdate FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey""",
)
def ordered(spark, sf):
    return keyed.order_by_key(orders(spark, sf), ORDER_KEY).select("recnum", "o_custkey", "o_orderdate")


@S.add(
    "top_n",
    """SELECT o_orderkey AS recnum, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def top(spark, sf):
    return keyed.top_n(orders(spark, sf), 100, ["-o_totalprice"], "o_orderstatus = 'F'").select("recnum", "o_totalprice")


@S.add(
    "preview",
    """SELECT p_partkey, p_name, p_size, count(*) OVER () = 50 AS truncated FROM
    (SELECT * FROM part WHERE p_size > 10 ORDER BY p_partkey LIMIT 50 OFFSET 100)""",
)
def preview(spark, sf):
    page = keyed.preview(table(spark, sf, "part"), "p_size > 10", 50, 100, "p_partkey")
    return page.select("p_partkey", "p_name", "p_size", "truncated")


@S.add(
    "page_next_all",
    "SELECT recnum, l_orderkey, l_linenumber FROM (SELECT l_orderkey * 8 + l_linenumber AS recnum, * FROM lineitem)",
)
def page_all(spark, sf):
    """A page without a number holds every record."""
    lines = table(spark, sf, "lineitem").withColumn("recnum", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return keyed.page_next(lines, ["l_orderkey", "l_linenumber"], None).select("recnum", "l_orderkey", "l_linenumber")


@S.add(
    "get_equal_same_names",
    """SELECT c.o_custkey, r.o_orderkey AS recnum, r.o_totalprice, CASE WHEN r.o_orderkey IS NULL THEN 4 ELSE 0 END AS status
    FROM (SELECT c_custkey AS o_custkey FROM customer) c
    LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) r ON c.o_custkey = r.o_custkey""",
)
def equal_same_names(spark, sf):
    """The default call: probe and record key have the same name."""
    probes = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return keyed.get_equal(orders(spark, sf).select("recnum", "o_custkey", "o_totalprice"), ["o_custkey"], probes=probes)


@S.add(
    "get_position_then_direct",
    "SELECT o_orderkey AS recnum, o_orderkey AS position, o_totalprice, 0 AS status FROM orders WHERE o_orderstatus = 'P'",
)
def position_then_direct(spark, sf):
    df = orders(spark, sf).select("recnum", "o_totalprice", "o_orderstatus")
    found = physical.get_direct(physical.get_position(df, F.col("o_orderstatus") == "P"), df)
    return found.select("recnum", "position", "o_totalprice", "status")
