"""Record files, layout texts, imports and text output.

The inputs are files that Spark first writes from the driver tables.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from fixtures import pagefiles
from keyloom.functions.codec import decode_records, encode_records
from keyloom.operators import drift as D
from keyloom.plans.lineage import scratch_path
from keyloom.sources import importer, layout_text, record_files as R, tables as T
from suite.changes import CUSTOMER, ORDERS, PART
from suite.common import Suite, table

S = Suite()

_CUSTOMER_KEYS = [[(0, 8, 1, 0x100, 0)], [(40, 12, 0, 0x101, 0x20), (32, 8, 6, 0x141, 0)]]


def _folder(spark, name: str) -> str:
    path = scratch_path(spark, name)
    local = path.removeprefix("file:")
    if "://" not in local:
        os.makedirs(local, exist_ok=True)
    return path


def customer_files(spark, sf, build, per_file: int = 400, one_name: bool = False) -> str:
    folder = _folder(spark, "customer-files")
    enc = encode_records(table(spark, sf, "customer"), CUSTOMER, keep=["c_custkey"])
    pagefiles.write_files(enc, "c_custkey", folder, "CUSTOMER", build, per_file, one_name)
    return folder


def _v6(records):
    return pagefiles.v6_file(records, page_size=1024, keys=_CUSTOMER_KEYS, dead_every=7)


def _stale(records):
    return pagefiles.v6_file(records, page_size=1024, keys=_CUSTOMER_KEYS, dead_every=5, stale=True, newer_map_second=True)


def _v5(records):
    """Every third record of a file is on its deleted chain, from the last to the first."""
    return pagefiles.v5_file(records, [i for i in range(len(records)) if i % 3 == 1][::-1], page_size=1024, keys=_CUSTOMER_KEYS, spare=3)


CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _decoded(records):
    return decode_records(records, CUSTOMER).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@S.add("read_record_files", CUSTOMER_SQL)
def read_raw(spark, sf):
    return _decoded(R.read_record_files(spark, customer_files(spark, sf, _v6), mode="raw"))


@S.add("read_record_files_mapped", CUSTOMER_SQL)
def read_mapped(spark, sf):
    return _decoded(R.read_record_files(spark, customer_files(spark, sf, _stale)))


_PLACED = "(SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer)"


@S.add("read_record_files_v5", f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {_PLACED} WHERE n % 400 % 3 <> 1")
def read_v5(spark, sf):
    return _decoded(R.read_record_files(spark, customer_files(spark, sf, _v5)))


_FILE = "'CUSTOMER_' || (n // 400) || '.B'"


def _short(df):
    return df.withColumn("file", F.regexp_extract("file", r"([^/]*)$", 1))


@S.add("collect_files", f"SELECT DISTINCT {_FILE} AS file FROM {_PLACED}")
def listed(spark, sf):
    return _short(R.collect_files(spark, customer_files(spark, sf, _v6))).select("file")


@S.add(
    "record_file_info",
    f"""SELECT {_FILE} AS file, 6 AS version, 1024 AS page_size, 52 AS record_length, 54 AS slot_length, 2 AS key_count,
    count(*) AS declared_records, count(*) AS active_records, 'fixed' AS record_kind, 24 AS uncovered_bytes, CAST(NULL AS VARCHAR) AS problem
    FROM {_PLACED} GROUP BY n // 400""",
)
def info(spark, sf):
    out = _short(R.record_file_info(spark, customer_files(spark, sf, _stale)))
    return out.select("file", "version", "page_size", "record_length", "slot_length", "key_count", "declared_records",
                      "active_records", "record_kind", "uncovered_bytes", "problem")


@S.add(
    "derive_layouts",
    f"""SELECT table_name, v.* FROM (SELECT DISTINCT 'CUSTOMER_' || (n // 400) AS table_name FROM {_PLACED}),
    (VALUES (1, 'K1_SEG1', 1, 8, 0, 1), (2, 'K2_SEG1', 0, 12, 40, 2), (3, 'K2_SEG2', 6, 8, 32, 2)) v(num, name, native_type, length, "offset", field_index)""",
)
def derived(spark, sf):
    headers = R.read_headers(R.collect_files(spark, customer_files(spark, sf, _v6)))
    return R.derive_layouts(headers).fields.select("table_name", "num", "name", "native_type", "length", "offset", "field_index")


@S.add(
    "covered_bytes",
    """SELECT l_orderkey, count(DISTINCT b) AS covered_bytes FROM (SELECT l_orderkey, unnest(range(CAST(l_quantity AS BIGINT), CAST(l_quantity AS BIGINT) + l_linenumber)) AS b
    FROM lineitem) GROUP BY 1""",
)
def covered(spark, sf):
    """Every order is a file here, its line items are key segments."""
    segs = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("int").alias("offset"), F.col("l_linenumber").alias("length"))
    return R.covered_bytes(segs, ["l_orderkey"])


# -- layout texts ----------------------------------------------------------------------


def _layout_texts(spark, sf):
    """One layout text per order: its line items are the fields, its status picks the key blocks."""
    from suite.catalog import lines

    ln = lines(spark, sf, several=False)
    n = F.col("n").cast("string")
    block = F.concat(
        F.lit("FIELD_NUMBER "), n, F.lit("\nFIELD_NAME  Col"), n, F.lit("\nFIELD_NATIVE_TYPE "), (F.col("n") % 8).cast("string"),
        F.lit("\nFIELD_NATIVE_LENGTH 20\nFIELD_NATIVE_OFFSET "), ((F.col("n") - 1) * 20).cast("string"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("\nFIELD_INDEX "), (F.col("n") % 2 + 1).cast("string"))).otherwise(""),
        F.when(F.col("l_linestatus") == "F", "\nFIELD_DEFAULT_VALUE 0001-01-01").otherwise(""), F.lit("\n"),
    )
    body = ln.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", block.alias("t")))), lambda s: s["t"]), "").alias("body"))
    o = table(spark, sf, "orders").join(body, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    head = F.concat(
        F.lit("; layout of an order\nTABLE_NAME T"), F.col("o_orderkey"), F.lit("\nlogical_record_length 200\nLOCAL_CACHE Yes\nPRIMARY_INDEX 0\n"),
        F.when(F.col("o_orderstatus") == "O", "SCHEMA_NAME sales\n").otherwise(""),
    )
    keys = F.when(
        F.col("o_orderstatus") == "F",
        "INDEX_NUMBER 1\nINDEX_NUMBER_SEGMENTS 3\nINDEX_SEGMENT_FIELD 1\nINDEX_SEGMENT_FLAG 19\nINDEX_SEGMENT_FIELD 2\n"
        "INDEX_SEGMENT_DIRECTION descending\nINDEX_SEGMENT_NULL_VALUE 32\nINDEX_SEGMENT_FLAG 3\nINDEX_SEGMENT_FIELD 0\nINDEX_SEGMENT_FLAG -1\n",
    ).otherwise("")
    return o.select(F.concat(F.lit("/layouts/T"), "o_orderkey", F.lit(".int")).alias("file"), F.concat(head, F.coalesce("body", F.lit("")), keys).alias("value"))


_LN = """ln AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS num FROM lineitem)"""


def _parsed(spark, sf):
    return layout_text.parse_layouts(_layout_texts(spark, sf), db="MAIN", schema="dbo")[0]


@S.add(
    "read_layouts_tables",
    """SELECT 'T' || o_orderkey AS table_name, 'MAIN' AS db_name, CASE WHEN o_orderstatus = 'O' THEN 'sales' ELSE 'dbo' END AS schema_name,
    200 AS record_length, 0 AS primary_index, true AS local_cache FROM orders""",
)
def parsed_tables(spark, sf):
    return _parsed(spark, sf).tables.select("table_name", "db_name", "schema_name", "record_length", "primary_index", "local_cache")


@S.add(
    "read_layouts_fields",
    f"""WITH {_LN} SELECT 'T' || l_orderkey AS table_name, num, 'Col' || num AS name, num % 8 AS native_type, 20 AS length, (num - 1) * 20 AS "offset",
    CASE WHEN l_returnflag = 'R' THEN num % 2 + 1 END AS field_index, CASE WHEN l_linestatus = 'F' THEN '0001-01-01' END AS default_value
    FROM ln WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
)
def parsed_fields(spark, sf):
    return _parsed(spark, sf).fields.select("table_name", "num", "name", "native_type", "length", "offset", "field_index", "default_value")


@S.add(
    "read_layouts_segments",
    f"""WITH {_LN} SELECT 'T' || o_orderkey AS table_name, v.* FROM orders, (VALUES (1, 0, 1, 19, false, 0), (1, 1, 2, 3, true, 32))
      v(num, segment, field_num, attrs, descending, null_value) WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'T' || l_orderkey, num % 2 + 1, row_number() OVER (PARTITION BY l_orderkey, num % 2 ORDER BY num) - 1, num, 0, false, 0
      FROM ln JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND o_orderstatus <> 'F'""",
)
def parsed_segments(spark, sf):
    return _parsed(spark, sf).segments.select("table_name", "num", "segment", "field_num", "attrs", "descending", "null_value")


# -- import ----------------------------------------------------------------------------


def _mixed_folder(spark, sf, per_file: int = 100_000) -> str:
    """Files of three tables; a table of more records has several files of the same name."""
    folder = customer_files(spark, sf, _v6, per_file, one_name=True)
    part = encode_records(table(spark, sf, "part"), PART, keep=["p_partkey"])
    pagefiles.write_files(part, "p_partkey", folder, "PART", lambda r: pagefiles.v6_file(r, page_size=2048), per_file, one_name=True)
    orders = encode_records(table(spark, sf, "orders").withColumn("filler", F.lit("")), ORDERS, keep=["o_orderkey"])
    pagefiles.write_files(orders, "o_orderkey", folder, "ORDERS", lambda r: pagefiles.v6_file(r, keys=[[(8, 8, 1, 0x100, 0)]]), 10 * per_file, one_name=True)
    return folder


def _named(layout, name):
    from dataclasses import replace

    return replace(layout, name=name)


@S.add(
    "import_files",
    """SELECT 'CUSTOMER_0' AS table_name, 'ok' AS status, (SELECT count(*) FROM customer) AS records, '' AS message
    UNION ALL SELECT 'PART_0', 'ok', (SELECT count(*) FROM part), ''
    UNION ALL SELECT 'ORDERS_0', 'ok', (SELECT count(*) FROM orders), '32 bytes are covered by no key'""",
)
def imported(spark, sf):
    catalog = importer.catalog_of(spark, [_named(CUSTOMER, "CUSTOMER_0"), _named(PART, "PART_0")])
    report, _ = importer.import_files(spark, _mixed_folder(spark, sf), catalog, scratch_path(spark, "imported"))
    # the report has a row per file
    return report.groupBy("table_name", "status", "message").agg(F.sum("records").alias("records")).select("table_name", "status", "records", "message")


@S.add("import_files_rows", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def imported_rows(spark, sf):
    folder = _folder(spark, "part-files")
    part = encode_records(table(spark, sf, "part"), PART, keep=["p_partkey"])
    pagefiles.write_files(part, "p_partkey", folder, "PART", lambda r: pagefiles.v6_file(r, dead_every=9), 500)
    target = scratch_path(spark, "imported")
    importer.import_files(spark, folder, importer.catalog_of(spark, [PART]), target, table="PART")
    return spark.read.parquet(f"{target}/PART").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@S.add(
    "reconcile",
    f"""SELECT {_FILE} AS file, count(*) AS declared_records, count(*) AS active_records, count(*) AS loaded, 0 AS active_minus_declared,
    0 AS loaded_minus_active FROM {_PLACED} GROUP BY n // 400""",
)
def reconciled(spark, sf):
    folder = customer_files(spark, sf, _v6)
    report, _ = importer.import_files(spark, folder, importer.catalog_of(spark, [CUSTOMER]), scratch_path(spark, "imported"), table="CUSTOMER")
    return _short(D.reconcile(R.record_file_info(spark, folder), report))


# -- tables and text -------------------------------------------------------------------


@S.add("write_table", "SELECT * FROM part")
def written(spark, sf):
    path = scratch_path(spark, "part-table")
    T.write_table(table(spark, sf, "part"), path, "overwrite")
    return spark.read.parquet(path)


@S.add("rows_as_text", "SELECT c_custkey || '|' || c_name || '|' || coalesce(CASE WHEN c_nationkey <> 3 THEN c_mktsegment END, '') AS row_text FROM customer")
def as_text(spark, sf):
    df = table(spark, sf, "customer")
    return T.rows_as_text(df.select("c_custkey", "c_name", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))))


@S.add("export_csv", "SELECT doc_id, lang, text FROM documents")
def exported(spark, sf):
    path = scratch_path(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    T.export_csv(docs, path)
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').schema(docs.schema)
    return back.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


@S.add(
    "query_text",
    """SELECT o_orderpriority || '|' || count(*) || '|' || min(o_orderkey) AS row_text FROM orders GROUP BY o_orderpriority""",
)
def queried(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("keyloom_orders")
    return T.query_text(spark, "SELECT o_orderpriority, count(*), min(o_orderkey) FROM keyloom_orders GROUP BY o_orderpriority")
