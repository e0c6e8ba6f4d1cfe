"""Key statistics, change-sets, byte patches and the transaction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyloom import layout as L
from keyloom.functions.codec import decode_records, encode_records
from keyloom.layout import KeySpec, Layout
from keyloom.operators import changes, stats, translog
from suite.common import Suite, customers, events, orders, table

S = Suite()


# -- layouts ---------------------------------------------------------------------------

CUSTOMER = Layout.build(
    "CUSTOMER",
    [("c_custkey", L.INT, 8), ("c_name", L.STRING, 20), ("c_nationkey", L.INT, 4), ("c_acctbal", L.MONEY, 8),
     ("c_mktsegment", L.STRING, 12)],
    keys=[KeySpec.of("c_custkey", num=1, duplicates=False), KeySpec.of("c_mktsegment", "-c_acctbal", num=2)],
)
PART = Layout.build(
    "PART",
    [("p_partkey", L.INT, 8), ("p_name", L.STRING, 14), ("p_brand", L.ZSTRING, 10), ("p_type", L.LSTRING, 12),
     ("p_size", L.INT, 4), ("p_retailprice", L.FLOAT, 8)],
)
ORDERS = Layout.build(
    "ORDERS",
    [("o_orderkey", L.INT, 8), ("o_custkey", L.INT, 8), ("o_orderdate", L.DATE, 4), ("o_orderstatus", L.STRING, 1),
     ("o_orderpriority", L.STRING, 15), ("filler", L.STRING, 4)],
    keys=[KeySpec.of("o_custkey", "-o_orderdate", num=1)],
)


def le_hex(expr: str, size: int) -> str:
    """SQL for the little-endian hex text of an integer."""
    text = f"right(lpad(to_hex(CAST({expr} AS BIGINT)), 16, '0'), {size * 2})"
    return "(" + " || ".join(f"substr({text}, {size * 2 - 1 - 2 * i}, 2)" for i in range(size)) + ")"


def text_hex(expr: str, size: int, pad: str = " ") -> str:
    return f"hex(rpad({expr}, {size}, '{pad}'))"


CUSTOMER_HEX = " || ".join([
    le_hex("c_custkey", 8), text_hex("c_name", 20), le_hex("c_nationkey", 4),
    le_hex("round(c_acctbal * 10000)", 8), text_hex("c_mktsegment", 12),
])
ORDERS_HEX = " || ".join([
    le_hex("o_orderkey", 8), le_hex("o_custkey", 8),
    "lpad(to_hex(day(o_orderdate)), 2, '0')", "lpad(to_hex(month(o_orderdate)), 2, '0')", le_hex("year(o_orderdate)", 2),
    text_hex("o_orderstatus", 1), text_hex("o_orderpriority", 15), "'20202020'",
])


def encoded_customers(spark, sf, *keep):
    df = table(spark, sf, "customer")
    return encode_records(df, CUSTOMER, keep=[F.col("c_custkey").alias("recnum"), *keep])


# -- codec -----------------------------------------------------------------------------


@S.add("encode_records", f"SELECT c_custkey AS recnum, {CUSTOMER_HEX} AS hex FROM customer")
def encode(spark, sf):
    return encoded_customers(spark, sf).select("recnum", F.hex("rec").alias("hex"))


# the bits of a positive double: its exponent and what it is more than that power of two
_PRICE_POWER = "CASE WHEN pow(2, floor(log2(p_retailprice))) > p_retailprice THEN floor(log2(p_retailprice)) - 1 WHEN pow(2, floor(log2(p_retailprice)) + 1) <= p_retailprice THEN floor(log2(p_retailprice)) + 1 ELSE floor(log2(p_retailprice)) END"
_PRICE_BITS = f"((({_PRICE_POWER})::BIGINT + 1023) * 4503599627370496 + ((p_retailprice / pow(2, {_PRICE_POWER}) - 1) * 4503599627370496)::BIGINT)"
_PART_HEAD = " || ".join([
    le_hex("p_partkey", 8), text_hex("p_name", 14),
    "rpad(hex(p_brand), 20, '0')", "lpad(to_hex(length(p_type)), 2, '0')", text_hex("p_type", 11), le_hex("p_size", 4), le_hex(_PRICE_BITS, 8),
])


@S.add("encode_records_text_kinds", f"SELECT p_partkey, {_PART_HEAD} AS hex FROM part")
def encode_part(spark, sf):
    df = encode_records(table(spark, sf, "part"), PART, keep=["p_partkey"])
    return df.select("p_partkey", F.hex("rec").alias("hex"))


@S.add(
    "decode_records",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def decode(spark, sf):
    out = decode_records(encoded_customers(spark, sf), CUSTOMER)
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@S.add("decode_records_floats", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def decode_part(spark, sf):
    return decode_records(encode_records(table(spark, sf, "part"), PART), PART)


@S.add(
    "decode_records_dates",
    "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus, o_orderpriority, '' AS filler FROM orders",
)
def decode_orders(spark, sf):
    df = table(spark, sf, "orders").withColumn("filler", F.lit(""))
    return decode_records(encode_records(df, ORDERS), ORDERS)


@S.add(
    "extract_ranges",
    f"SELECT c_custkey AS recnum, substr({CUSTOMER_HEX}, 81, 24) || substr({CUSTOMER_HEX}, 1, 16) || substr({CUSTOMER_HEX}, 101, 4) || '000000' AS hex FROM customer",
)
def ranges(spark, sf):
    from keyloom.functions.codec import extract_ranges

    data = extract_ranges("rec", [(12, 40), (8, 0), (5, 50)])
    return encoded_customers(spark, sf).select("recnum", F.hex(data).alias("hex"))


@S.add(
    "key_image",
    f"SELECT o_orderkey, {le_hex('o_custkey', 8)} || substr({ORDERS_HEX}, 33, 8) AS hex FROM orders",
)
def images(spark, sf):
    from keyloom.functions.codec import key_image

    df = table(spark, sf, "orders").withColumn("filler", F.lit(""))
    enc = encode_records(df, ORDERS, keep=["o_orderkey"])
    return enc.select("o_orderkey", F.hex(key_image(ORDERS, ORDERS.key(1))).alias("hex"))


@S.add(
    "decode_keys",
    """SELECT o_orderkey, CASE WHEN o_custkey % 256 = 0 AND o_custkey = 0 THEN NULL ELSE o_custkey END AS o_custkey,
    o_custkey = 0 AS wild_o_custkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
    o_orderstatus = 'F' AS wild_o_orderdate FROM orders""",
)
def key_values(spark, sf):
    from keyloom.functions.codec import decode_keys, key_image

    df = table(spark, sf, "orders").withColumn("filler", F.lit(""))
    # finished orders probe with the customer only: the date segment is left at its null byte
    probe = df.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")))
    image = encode_records(probe, ORDERS, keep=["o_orderkey"]).select("o_orderkey", key_image(ORDERS, ORDERS.key(1)).alias("key"))
    return decode_keys(image, "key", ORDERS, ORDERS.key(1), null_wildcard=True).drop("key")


# -- statistics ------------------------------------------------------------------------


@S.add(
    "file_stat",
    """SELECT 52 AS record_length, 4096 AS page_size, 2 AS key_count, (SELECT count(*) FROM customer) AS record_count,
    0 AS file_flags, v.* FROM (VALUES (0, 0, 1, 8, 0, 1), (1, 0, 41, 12, 1, 0), (1, 1, 33, 8, 65, 6))
    v(key_number, segment, position, length, attributes, native_type)""",
)
def stat(spark, sf):
    return stats.file_stat(table(spark, sf, "customer"), CUSTOMER)


@S.add(
    "key_cardinality",
    """SELECT 'l_orderkey,l_linenumber' AS key, count(*) AS distinct_keys FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem
    UNION ALL SELECT 'l_partkey,l_suppkey', count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
)
def cardinality(spark, sf):
    keys = [["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey"]]
    return stats.key_cardinality(table(spark, sf, "lineitem"), keys)


@S.add(
    "unique_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def violations(spark, sf):
    return stats.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- change-sets -----------------------------------------------------------------------

_NEW_NAMES = """SELECT c_custkey AS pos, CASE WHEN c_nationkey < 8 THEN c_name
  ELSE 'New#' || (c_custkey // 3) END AS c_name, c_acctbal FROM customer"""


def _new_customers(spark, sf):
    name = F.when(F.col("c_nationkey") < 8, F.col("c_name")).otherwise(
        F.concat(F.lit("New#"), F.expr("c_custkey DIV 3").cast("string"))
    )
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("pos"), name.alias("c_name"), "c_acctbal")


@S.add(
    "insert",
    f"""WITH n AS ({_NEW_NAMES}), ok AS (SELECT * FROM n WHERE c_name NOT IN (SELECT c_name FROM customer)
      QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY pos) = 1)
    SELECT c_custkey AS recnum, c_name, c_acctbal FROM customer UNION ALL
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY pos), c_name, c_acctbal FROM ok""",
)
def insert(spark, sf):
    state = customers(spark, sf).select("recnum", "c_name", "c_acctbal")
    return changes.insert(state, _new_customers(spark, sf), [KeySpec.of("c_name", duplicates=False)])[0]


@S.add(
    "insert_rejects",
    f"""WITH n AS ({_NEW_NAMES})
    SELECT pos, c_name, 'exists' AS reason FROM n WHERE c_name IN (SELECT c_name FROM customer) UNION ALL
    (SELECT pos, c_name, 'repeated' FROM n WHERE c_name NOT IN (SELECT c_name FROM customer)
      QUALIFY row_number() OVER (PARTITION BY c_name ORDER BY pos) > 1)""",
)
def insert_rejects(spark, sf):
    state = customers(spark, sf).select("recnum", "c_name", "c_acctbal")
    rejects = changes.insert(state, _new_customers(spark, sf), [KeySpec.of("c_name", duplicates=False)])[1]
    return rejects.select("pos", "c_name", "reason")


# Verdicts depend on earlier verdicts: the SQL goes from row to row with the keys taken so far.
@S.add(
    "insert_two_keys",
    """WITH RECURSIVE n AS (SELECT pos, c_name, c_acctbal, row_number() OVER (ORDER BY pos) AS i,
        c_name IN (SELECT c_name FROM customer) OR c_acctbal IN (SELECT c_acctbal FROM customer) AS known
      FROM (SELECT c_custkey AS pos, CASE WHEN c_nationkey < 8 THEN c_name ELSE 'New#' || (c_custkey // 3) END AS c_name, round(c_acctbal, -2) + 0.0 AS c_acctbal FROM customer)),
    r AS (SELECT 0::BIGINT AS i, true AS ok, []::VARCHAR[] AS names, []::DOUBLE[] AS sums
      UNION ALL
      SELECT n.i, NOT n.known AND NOT list_contains(r.names, n.c_name) AND NOT list_contains(r.sums, n.c_acctbal),
        CASE WHEN NOT n.known AND NOT list_contains(r.names, n.c_name) AND NOT list_contains(r.sums, n.c_acctbal) THEN list_append(r.names, n.c_name) ELSE r.names END,
        CASE WHEN NOT n.known AND NOT list_contains(r.names, n.c_name) AND NOT list_contains(r.sums, n.c_acctbal) THEN list_append(r.sums, n.c_acctbal) ELSE r.sums END
      FROM r JOIN n ON n.i = r.i + 1)
    SELECT pos, c_name, c_acctbal, CASE WHEN known THEN 'exists' ELSE 'repeated' END AS reason FROM n JOIN r ON r.i = n.i WHERE NOT ok""",
)
def insert_two(spark, sf):
    df = customers(spark, sf).select("recnum", "c_name", "c_acctbal")
    rows = _new_customers(spark, sf).withColumn("c_acctbal", F.round("c_acctbal", -2) + F.lit(0.0))
    return changes.insert(df, rows, [KeySpec.of("c_name", duplicates=False), KeySpec.of("c_acctbal", duplicates=False)])[1]


# one batch per customer; an urgent order of a customer is written again under its priority
_BATCH = """SELECT o_custkey AS batch, o_orderkey AS pos, CASE WHEN o_orderstatus = 'P' THEN 'urgent#' || o_custkey
  ELSE 'order#' || o_orderkey END AS tag FROM orders"""
_BATCH_STATE = "SELECT o_orderkey AS recnum, 'order#' || (o_orderkey * 3) AS tag FROM orders"
_BATCH_JUDGED = f"""n AS ({_BATCH}), st AS ({_BATCH_STATE}),
  bad AS (SELECT *, (tag IN (SELECT tag FROM st)) OR row_number() OVER (PARTITION BY tag ORDER BY batch, pos) > 1 AS bad FROM n),
  stops AS (SELECT batch, min(pos) FILTER (WHERE bad) AS stop FROM bad GROUP BY batch)"""


def _batches(spark, sf):
    df = table(spark, sf, "orders")
    tag = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("urgent#"), F.col("o_custkey"))).otherwise(
        F.concat(F.lit("order#"), F.col("o_orderkey"))
    )
    rows = df.select(F.col("o_custkey").alias("batch"), F.col("o_orderkey").alias("pos"), tag.alias("tag"))
    state = df.select(F.col("o_orderkey").alias("recnum"), F.concat(F.lit("order#"), F.col("o_orderkey") * 3).alias("tag"))
    return changes.insert_batch(state, rows, [KeySpec.of("tag", duplicates=False)])


@S.add(
    "insert_batch",
    f"""WITH {_BATCH_JUDGED} SELECT recnum, tag FROM st UNION ALL
    SELECT (SELECT max(recnum) FROM st) + row_number() OVER (ORDER BY batch, pos), tag FROM n JOIN stops USING (batch)
    WHERE stop IS NULL OR pos < stop""",
)
def batch_state(spark, sf):
    return _batches(spark, sf)[0]


@S.add(
    "insert_batch_report",
    f"""WITH {_BATCH_JUDGED} SELECT batch, count(*) AS asked, count(*) FILTER (WHERE stop IS NULL OR pos < stop) AS inserted,
    CASE WHEN max(stop) IS NULL THEN 0 ELSE 5 END AS status, max(stop) AS stopped_at FROM n JOIN stops USING (batch) GROUP BY batch""",
)
def batch_report(spark, sf):
    return _batches(spark, sf)[1]


def _updates(spark, sf):
    df = table(spark, sf, "customer")
    change = df.select((F.col("c_custkey") * 2).alias("recnum"), F.concat(F.lit("Upd#"), "c_custkey").alias("c_name"),
                       F.when(F.col("c_nationkey") != 3, F.col("c_acctbal")).alias("c_acctbal"))
    return changes.update(df.select(F.col("c_custkey").alias("recnum"), "c_name", "c_acctbal"), change)


@S.add(
    "update",
    """SELECT a.c_custkey AS recnum, CASE WHEN b.c_custkey IS NULL THEN a.c_name ELSE 'Upd#' || b.c_custkey END AS c_name,
    CASE WHEN b.c_custkey IS NULL THEN a.c_acctbal WHEN b.c_nationkey = 3 THEN NULL ELSE b.c_acctbal END AS c_acctbal
    FROM customer a LEFT JOIN customer b ON a.c_custkey = b.c_custkey * 2""",
)
def update(spark, sf):
    return _updates(spark, sf)[0]


@S.add(
    "update_missing",
    "SELECT c_custkey * 2 AS recnum, 'Upd#' || c_custkey AS c_name FROM customer WHERE c_custkey * 2 NOT IN (SELECT c_custkey FROM customer)",
)
def update_missing(spark, sf):
    return _updates(spark, sf)[1].select("recnum", "c_name")


@S.add(
    "delete",
    "SELECT o_orderkey AS recnum, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def delete(spark, sf):
    gone = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("recnum"))
    return changes.delete(orders(spark, sf).select("recnum", "o_custkey"), gone)[0]


# -- byte patches ----------------------------------------------------------------------


def _patched_sql(patch_bytes: str) -> str:
    """Customer records as hex, byte by byte, with the last patch of each byte on top."""
    return f"""WITH rec AS (SELECT c_custkey AS recnum, {CUSTOMER_HEX} AS h FROM customer),
    pb AS ({patch_bytes}),
    last AS (SELECT recnum, pos, arg_max(b, place) AS b FROM pb GROUP BY recnum, pos),
    cells AS (SELECT recnum, i AS pos, substr(h, 2 * i + 1, 2) AS b FROM rec, range(52) t(i))
    SELECT recnum, string_agg(coalesce(last.b, cells.b), '' ORDER BY pos) AS hex
    FROM cells LEFT JOIN last USING (recnum, pos) GROUP BY recnum"""


_LETTER = "chr(CAST(65 + o_orderkey % 26 AS INTEGER))"


def _patches(spark, sf):
    """One request of two chunks per order; the second chunk may reach past the record."""
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request"), F.col("o_custkey").alias("recnum"),
        F.char(65 + F.col("o_orderkey") % 26).alias("letter"),
    )
    first = df.select("request", "recnum", F.lit(0).alias("chunk"), (F.col("request") % 48).alias("offset"),
                      F.repeat("letter", 3).cast("binary").alias("data"))
    second = df.select("request", "recnum", F.lit(1).alias("chunk"), (F.col("request") % 52).alias("offset"),
                       F.lower(F.repeat("letter", 2)).cast("binary").alias("data"))
    return first.unionByName(second)


_PATCH_BYTES = f"""SELECT o_custkey AS recnum, o_orderkey % 48 + i AS pos, o_orderkey * 2 AS place, hex({_LETTER}) AS b
    FROM orders, range(3) t(i) WHERE o_orderkey % 52 <= 50
  UNION ALL SELECT o_custkey, o_orderkey % 52 + i, o_orderkey * 2 + 1, hex(lower({_LETTER}))
    FROM orders, range(2) t(i) WHERE o_orderkey % 52 <= 50"""


@S.add("update_chunks", _patched_sql(_PATCH_BYTES))
def chunks(spark, sf):
    state, _ = changes.update_chunks(encoded_customers(spark, sf), _patches(spark, sf), CUSTOMER.record_length)
    return state.select("recnum", F.hex("rec").alias("hex"))


@S.add(
    "update_chunks_report",
    """SELECT o_orderkey AS request, o_custkey AS recnum, CASE WHEN o_orderkey % 52 > 50 THEN 103
    WHEN o_custkey NOT IN (SELECT c_custkey FROM customer) THEN 8 ELSE 0 END AS status FROM orders""",
)
def chunks_report(spark, sf):
    return changes.update_chunks(encoded_customers(spark, sf), _patches(spark, sf), CUSTOMER.record_length)[1]


@S.add(
    "update_chunks_rectangle",
    _patched_sql(f"""SELECT o_custkey AS recnum, 2 + i * 11 + j AS pos, o_orderkey * 4 + i AS place, hex(substr('abcdefgh', i * 2 + j + 1, 1)) AS b
      FROM orders, range(4) t(i), range(2) u(j) WHERE o_orderpriority = '1-URGENT'"""),
)
def rectangle(spark, sf):
    requests = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("request"), F.col("o_custkey").alias("recnum"), F.lit(4).alias("count"),
        F.lit(2).alias("size"), F.lit(11).alias("stride"), F.lit(2).alias("first"),
        F.lit("abcdefgh").cast("binary").alias("data"),
    )
    patches = changes.rectangle_patches(requests)
    state, _ = changes.update_chunks(encoded_customers(spark, sf), patches, CUSTOMER.record_length)
    return state.select("recnum", F.hex("rec").alias("hex"))


@S.add(
    "update_chunks_truncate",
    "SELECT o_orderkey AS request, o_custkey AS recnum, CASE WHEN o_orderkey % 100 < 52 THEN 28 ELSE 0 END AS status FROM orders",
)
def truncate(spark, sf):
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request"), F.col("o_custkey").alias("recnum"), (F.col("o_orderkey") % 100).alias("length")
    )
    return changes.truncate_report(requests, CUSTOMER.record_length)


# -- transaction log -------------------------------------------------------------------

# purchases mark transactions of their user; the other event types change customer records
_OP = """CASE event_type WHEN 'signup' THEN 2 WHEN 'click' THEN 3 WHEN 'view' THEN 3 WHEN 'error' THEN 4
  ELSE CASE WHEN event_id % 5 < 3 THEN 19 WHEN event_id % 5 = 3 THEN 20 ELSE 21 END END"""


def log(spark, sf):
    return events(spark, sf).select(
        F.col("recnum").alias("seq"), F.col("user_id").alias("session"),
        F.expr(_OP.replace("event_id", "recnum")).cast("int").alias("op"),
        F.expr("(recnum * 7) % 2000").alias("recnum"), F.concat(F.lit("Log#"), F.col("recnum")).alias("c_name"),
        F.col("value").alias("c_acctbal"),
    )


_LOG_SQL = f"""log AS (SELECT event_id AS seq, user_id AS session, {_OP} AS op, (event_id * 7) % 2000 AS recnum,
    'Log#' || event_id AS c_name, value AS c_acctbal FROM events),
  m1 AS (SELECT *, lag(op) OVER (PARTITION BY session ORDER BY seq) AS before FROM log WHERE op >= 19),
  m2 AS (SELECT *, CASE WHEN op = 19 AND before IS NOT DISTINCT FROM 19 THEN 37
      WHEN op <> 19 AND before IS DISTINCT FROM 19 THEN 39 ELSE 0 END AS status FROM m1),
  m3 AS (SELECT *, CASE WHEN op = 19 THEN CASE lead(op) OVER (PARTITION BY session ORDER BY seq)
      WHEN 20 THEN 'committed' WHEN 21 THEN 'aborted' ELSE 'open' END END AS outcome FROM m2 WHERE status = 0),
  marks AS (SELECT seq, session, op, outcome, status FROM m3 UNION ALL
      SELECT seq, session, op, NULL, status FROM m2 WHERE status <> 0),
  u AS (SELECT log.*, CASE WHEN m3.seq IS NULL THEN NULL ELSE coalesce(m3.outcome, 'plain') END AS mark
      FROM log LEFT JOIN m3 ON log.seq = m3.seq),
  ch AS (SELECT * FROM (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER
      (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING), 'plain') AS outcome FROM u) WHERE op < 19),
  live AS (SELECT *, last_value(CASE WHEN op <> 3 THEN op END IGNORE NULLS) OVER
      (PARTITION BY recnum ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
      FROM ch WHERE outcome IN ('plain', 'committed')),
  ex AS (SELECT *, CASE WHEN prior IS NULL THEN recnum IN (SELECT c_custkey FROM customer) ELSE prior = 2 END AS present FROM live),
  judged AS (SELECT *, CASE WHEN op = 2 AND present THEN 5 WHEN op <> 2 AND NOT present THEN 8 ELSE 0 END AS status FROM ex),
  fin AS (SELECT * FROM judged WHERE status = 0 QUALIFY row_number() OVER (PARTITION BY recnum ORDER BY seq DESC) = 1)"""


@S.add(
    "apply_log",
    f"""WITH {_LOG_SQL} SELECT c_custkey AS recnum, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT recnum FROM fin)
    UNION ALL SELECT recnum, c_name, c_acctbal FROM fin WHERE op <> 4""",
)
def apply_log(spark, sf):
    return translog.apply_log(customers(spark, sf).select("recnum", "c_name", "c_acctbal"), log(spark, sf))[0]


@S.add(
    "apply_log_report",
    f"""WITH {_LOG_SQL} SELECT seq, session, op, outcome, status FROM judged UNION ALL
    SELECT seq, session, op, outcome, NULL FROM ch WHERE outcome NOT IN ('plain', 'committed') UNION ALL
    SELECT seq, session, op, outcome, status FROM marks""",
)
def log_report(spark, sf):
    return translog.apply_log(customers(spark, sf).select("recnum", "c_name", "c_acctbal"), log(spark, sf))[1]
