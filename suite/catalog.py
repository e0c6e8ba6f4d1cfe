"""Catalog, drift and health over a catalog that Spark derives from orders and line items.

Every order stands for one table layout and its line items for the layout's fields, so the
catalog has as many tables as there are orders and grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from keyloom.operators import catalog as C
from keyloom.operators import drift as D
from keyloom.operators.joins import drift_join
from keyloom.plans.lineage import scratch_path
from keyloom.plans.ordering import by_rows, row_numbers
from suite.common import Suite, table

S = Suite()

ID_SQL = "'T' || {k} AS table_name, 'DB' || ({k} % 3) AS db_name, '/data/D' || ({k} % 5) AS source_dir"


def _id(key: str):
    k = F.col(key)
    return [
        F.concat(F.lit("T"), k).alias("table_name"), F.concat(F.lit("DB"), k % 3).alias("db_name"),
        F.concat(F.lit("/data/D"), k % 5).alias("source_dir"),
    ]


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def lines(spark, sf, several: bool = True):
    """Line items numbered within their order, which stands for a layout and so has few.

    ``several`` frames made of them read them by the column from where they are written down.
    """
    df = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", "l_linestatus", "l_tax")
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_KEY[1:])
    numbered = by_rows(df, "l_orderkey").withColumn("n", F.row_number().over(w))
    if not several:
        return numbered
    path = scratch_path(spark, "lines")
    numbered.write.parquet(path)
    return spark.read.parquet(path)


NUM = f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_KEY[1:])})"
_LENGTH = "CASE num % 8 WHEN 0 THEN 20 WHEN 2 THEN 8 WHEN 5 THEN 8 WHEN 6 THEN 8 WHEN 7 THEN 1 ELSE 4 END"
BASE = f"""ln AS (SELECT *, {NUM} AS num FROM lineitem),
  fields AS (SELECT {ID_SQL.format(k='l_orderkey')}, num, 'Col' || num AS name, num % 8 AS native_type,
    {_LENGTH} AS length, (num - 1) * 20 AS "offset" FROM ln),
  segs AS (SELECT {ID_SQL.format(k='l_orderkey')}, CASE WHEN num < 3 THEN 1 ELSE 2 END AS num,
    CASE WHEN num < 3 THEN num - 1 ELSE 0 END AS segment, num AS field_num, l_linestatus = 'F' AS descending FROM ln WHERE num <= 3),
  keys AS (SELECT table_name, db_name, source_dir, num, count(*) AS num_segments FROM segs GROUP BY ALL),
  tables AS (SELECT {ID_SQL.format(k='o_orderkey')}, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 's_' || o_orderstatus END AS schema_name,
    100 AS record_length, CASE WHEN o_custkey % 2 = 0 THEN 0 WHEN o_custkey % 5 = 0 THEN 7 END AS primary_index,
    o_orderkey % 6 AS declared_fields, o_orderstatus = 'F' AS migrated,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS migrated_at,
    CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS row_count, o_orderkey AS k FROM orders)"""
# backend columns: some are gone, some have another type, some are new
BACKEND = """backend AS (SELECT lower('T' || l_orderkey) AS table_name, lower('Col' || num) AS column_name,
    CASE WHEN l_linestatus = 'F' AND l_tax > 0.05 THEN 'TEXT' WHEN num % 8 = 0 THEN 'varchar(20)' ELSE t END AS data_type
    FROM (SELECT *, CASE num % 8 WHEN 1 THEN 'int' WHEN 2 THEN 'float' WHEN 3 THEN 'date' WHEN 4 THEN 'time(7)'
      WHEN 5 THEN 'decimal(9,2)' WHEN 6 THEN 'decimal' ELSE 'tinyint' END AS t FROM ln) WHERE l_returnflag <> 'R'
    UNION ALL SELECT 'T' || l_orderkey, 'Extra' || num, 'INT' FROM ln WHERE l_returnflag = 'A' AND l_tax > 0.06)"""
_EXPECTED_TYPE = """CASE native_type WHEN 0 THEN 'VARCHAR(20)' WHEN 1 THEN 'INT' WHEN 2 THEN 'FLOAT' WHEN 3 THEN 'DATE'
    WHEN 4 THEN 'TIME(0)' WHEN 5 THEN 'DECIMAL(18,0)' WHEN 6 THEN 'DECIMAL(18,4)' ELSE 'TINYINT' END"""


def derived(spark, sf, ln=None, several: bool = True) -> C.Catalog:
    ln = ln or lines(spark, sf, several)
    num = F.col("n")
    length = F.expr(_LENGTH.replace("num", "n"))
    fields = ln.select(
        *_id("l_orderkey"), num.alias("num"), F.concat(F.lit("Col"), num).alias("name"), (num % 8).alias("native_type"),
        length.alias("length"), ((num - 1) * 20).alias("offset"), F.lit(None).cast("int").alias("field_index"),
        F.lit(None).cast("string").alias("default_value"),
    )
    heads = ln.where("n <= 3")
    segments = heads.select(
        *_id("l_orderkey"), F.when(num < 3, 1).otherwise(2).alias("num"), F.when(num < 3, num - 1).otherwise(0).alias("segment"),
        num.alias("field_num"), F.lit(0).alias("attrs"), (F.col("l_linestatus") == "F").alias("descending"), F.lit(0).alias("null_value"),
    )
    keys = segments.groupBy(*C.ID, "num").agg(F.count(F.lit(1)).cast("int").alias("num_segments"))
    o = table(spark, sf, "orders")
    done = F.col("o_orderstatus") == "F"
    made = {
        "schema_name": F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("s_"), "o_orderstatus")),
        "record_length": F.lit(100),
        "primary_index": F.when(F.col("o_custkey") % 2 == 0, 0).when(F.col("o_custkey") % 5 == 0, 7),
        "declared_fields": (F.col("o_orderkey") % 6).cast("int"),
        "migrated": done, "migrated_at": F.when(done, F.col("o_orderdate")).cast("timestamp"), "row_count": F.when(done, F.col("o_custkey")),
    }
    schema = spark.createDataFrame([], C.TABLE_DDL).schema
    own = {f.name: made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema if f.name not in C.ID}
    tables = o.select(*_id("o_orderkey"), *own.values())
    return C.Catalog(tables, fields, keys, segments)


def backend(ln):
    n = F.col("n")
    kind = F.expr("""CASE n % 8 WHEN 1 THEN 'int' WHEN 2 THEN 'float' WHEN 3 THEN 'date' WHEN 4 THEN 'time(7)'
      WHEN 5 THEN 'decimal(9,2)' WHEN 6 THEN 'decimal' ELSE 'tinyint' END""")
    have = ln.where("l_returnflag <> 'R'").select(
        F.lower(F.concat(F.lit("T"), "l_orderkey")).alias("table_name"), F.lower(F.concat(F.lit("Col"), n)).alias("column_name"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.05), "TEXT").when(n % 8 == 0, "varchar(20)").otherwise(kind).alias("data_type"),
    )
    extra = ln.where("l_returnflag = 'A' AND l_tax > 0.06").select(
        F.concat(F.lit("T"), "l_orderkey").alias("table_name"), F.concat(F.lit("Extra"), n).alias("column_name"), F.lit("INT").alias("data_type")
    )
    return have.unionByName(extra)


@S.add(
    "drift_join",
    f"""WITH {BASE}, {BACKEND} SELECT coalesce(f.table_name, b.table_name) AS table_name, coalesce(f.name, b.column_name) AS column_name,
    {_EXPECTED_TYPE} AS expected_type, b.data_type AS actual_type, f.name IS NOT NULL AS is_expected, b.column_name IS NOT NULL AS is_actual
    FROM fields f FULL JOIN backend b ON upper(f.table_name) = upper(b.table_name) AND upper(f.name) = upper(b.column_name)""".replace(
        "ELSE 'TINYINT' END AS expected_type", "WHEN 7 THEN 'TINYINT' END AS expected_type"),
)
def drifted(spark, sf):
    ln = lines(spark, sf)
    return drift_join(D.expected_columns(derived(spark, sf, ln)), backend(ln))


_NORMAL = "upper(regexp_extract({c}, '^[^ (]*')) || CASE WHEN upper({c}) LIKE 'VARCHAR%' THEN regexp_extract({c}, '\\([^)]*\\)?') ELSE '' END"
_DIFF = f"""{BASE}, {BACKEND},
  pairs AS (SELECT coalesce(f.table_name, b.table_name) AS table_name, coalesce(f.name, b.column_name) AS column_name,
    CASE WHEN f.name IS NOT NULL THEN {_EXPECTED_TYPE} END AS expected_type, b.data_type AS actual_type
    FROM fields f FULL JOIN backend b ON upper(f.table_name) = upper(b.table_name) AND upper(f.name) = upper(b.column_name)),
  diff AS (SELECT *, CASE WHEN expected_type IS NULL THEN 'extra' WHEN actual_type IS NULL THEN 'missing'
    WHEN {_NORMAL.format(c='expected_type')} = {_NORMAL.format(c='actual_type')} THEN 'matched' ELSE 'mismatch' END AS outcome FROM pairs
    WHERE actual_type IS NOT NULL OR upper(table_name) IN (SELECT upper(table_name) FROM backend))"""


@S.add("schema_diff", f"WITH {_DIFF} SELECT table_name, column_name, expected_type, actual_type, outcome FROM diff")
def diff(spark, sf):
    ln = lines(spark, sf)
    return D.schema_diff(D.expected_columns(derived(spark, sf, ln)), backend(ln))


_HEALTH = f"""{_DIFF},
  h AS (SELECT upper(table_name) AS t, count(*) FILTER (WHERE outcome = 'missing') AS missing,
    count(*) FILTER (WHERE outcome = 'extra') AS extra, count(*) FILTER (WHERE outcome = 'mismatch') AS mismatches FROM diff GROUP BY 1),
  fc AS (SELECT table_name, count(*) AS n FROM fields GROUP BY 1),
  health AS (SELECT tables.table_name, db_name, source_dir, coalesce(fc.n, 0) AS field_count,
    source_dir <> '/data/D4' AND h.t IS NOT NULL AS table_exists, migrated, row_count,
    CASE WHEN fc.n > 0 AND source_dir <> '/data/D4' THEN coalesce(missing, 0) ELSE 0 END AS missing,
    CASE WHEN fc.n > 0 AND source_dir <> '/data/D4' THEN coalesce(extra, 0) ELSE 0 END AS extra,
    CASE WHEN fc.n > 0 AND source_dir <> '/data/D4' THEN coalesce(mismatches, 0) ELSE 0 END AS mismatches,
    CASE WHEN fc.n IS NULL THEN 'no_schema' WHEN source_dir = '/data/D4' THEN 'no_connection' WHEN h.t IS NULL THEN 'missing'
      WHEN missing + extra + mismatches = 0 THEN 'ok' ELSE 'drift' END AS status
    FROM tables LEFT JOIN fc USING (table_name) LEFT JOIN h ON upper(tables.table_name) = h.t)"""


def _health(spark, sf):
    ln = lines(spark, sf)
    cat = derived(spark, sf, ln)
    connected = cat.tables.where("source_dir <> '/data/D4'").select("source_dir").distinct()
    return D.health(cat, backend(ln), connected)


@S.add("health", f"WITH {_HEALTH} SELECT * FROM health")
def health(spark, sf):
    return _health(spark, sf)


@S.add(
    "health_summary",
    f"""WITH {_HEALTH} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'ok') AS in_sync,
    count(*) FILTER (WHERE status = 'drift') AS drifted, count(*) FILTER (WHERE status = 'missing') AS missing_table,
    count(*) FILTER (WHERE status = 'no_schema') AS no_schema, count(*) FILTER (WHERE migrated) AS migrated FROM health""",
)
def health_total(spark, sf):
    return D.health_summary(_health(spark, sf))


@S.add(
    "table_summary",
    f"""WITH {BASE} SELECT table_name, db_name, source_dir, record_length, coalesce(f.n, 0) AS field_count, coalesce(k.n, 0) AS key_count
    FROM tables LEFT JOIN (SELECT table_name, count(*) AS n FROM fields GROUP BY 1) f USING (table_name)
    LEFT JOIN (SELECT table_name, count(*) AS n FROM keys GROUP BY 1) k USING (table_name)""",
)
def summary(spark, sf):
    return C.table_summary(derived(spark, sf))


@S.add(
    "migration_status",
    f"""WITH {BASE} SELECT table_name, source_dir, migrated, migrated_at, row_count, CAST(NULL AS VARCHAR) AS target_db,
    coalesce(f.n, 0) AS field_count FROM tables LEFT JOIN (SELECT table_name, count(*) AS n FROM fields GROUP BY 1) f USING (table_name)""",
)
def migration(spark, sf):
    return C.migration_status(derived(spark, sf, several=False))


@S.add("migration_summary", "SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) AS total FROM orders")
def migration_total(spark, sf):
    return C.migration_summary(derived(spark, sf, several=False))


def _marks(spark, sf):
    return table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.lower(F.concat(F.lit("T"), "o_orderkey")).alias("table_name"), F.col("o_orderdate").alias("migrated_at"),
        F.col("o_custkey").alias("row_count"), F.lit("srv").alias("target_server"), F.lit("tgt").alias("target_db"),
    )


@S.add(
    "mark_migrated",
    """SELECT 'T' || o_orderkey AS table_name, o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' AS migrated,
    CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN o_orderdate END AS migrated_at,
    CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN o_custkey END AS row_count,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'tgt' END AS target_db FROM orders""",
)
def mark(spark, sf):
    out = C.mark_migrated(derived(spark, sf, several=False).tables, _marks(spark, sf))
    return out.select("table_name", "migrated", "migrated_at", "row_count", "target_db")


@S.add(
    "clear_migrated",
    """SELECT 'T' || o_orderkey AS table_name, o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AS migrated,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN o_custkey END AS row_count FROM orders""",
)
def clear(spark, sf):
    out = C.clear_migrated(derived(spark, sf, several=False).tables, _marks(spark, sf))
    return out.select("table_name", "migrated", "row_count")


@S.add("expected_columns", f"WITH {BASE} SELECT table_name, db_name, source_dir, name AS column_name, num, {_EXPECTED_TYPE} AS data_type FROM fields")
def expected(spark, sf):
    return D.expected_columns(derived(spark, sf, several=False))


@S.add(
    "resolve_recnum",
    f"""WITH {BASE} SELECT t.table_name, t.db_name, t.source_dir, CASE WHEN primary_index = 0 AND n.name IS NOT NULL THEN n.name
    WHEN t.db_name = 'DB1' THEN 'ROW_1' ELSE 'ROW_ID' END AS recnum FROM tables t
    LEFT JOIN (SELECT table_name, name FROM fields WHERE num = 1) n USING (table_name)""",
)
def recnum(spark, sf):
    config = spark.createDataFrame(
        [("config", "RECNUM_COLUMN", "ROW_ID"), ("config", "RECNUM_COLUMN.DB1", "ROW_1"), ("config", "RECNUM_COLUMN.DB2", "")],
        "section string, key string, value string",
    )
    return C.resolve_recnum(derived(spark, sf, several=False), config)


_CONFIG_SQL = """cfg AS (SELECT CASE WHEN c_custkey = 0 THEN 'config' ELSE 'S' || c_custkey END AS section, 'DATABASE' AS key,
    CASE WHEN c_mktsegment = 'BUILDING' AND c_custkey > 0 THEN '' ELSE 'DB' || (c_custkey % 3) END AS value FROM customer)"""


def _config(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    blank = (F.col("c_mktsegment") == "BUILDING") & (k > 0)
    return c.select(
        F.when(k == 0, "config").otherwise(F.concat(F.lit("S"), k)).alias("section"), F.lit("DATABASE").alias("key"),
        F.when(blank, "").otherwise(F.concat(F.lit("DB"), k % 3)).alias("value"),
    )


@S.add(
    "resolve_config",
    f"""WITH {_CONFIG_SQL}, w AS (SELECT DISTINCT 's' || (o_custkey * 2) AS section FROM orders)
    SELECT w.section, 'database' AS key, coalesce(CASE WHEN cfg.value <> '' THEN cfg.value END, 'DB0') AS value
    FROM w LEFT JOIN cfg ON upper(w.section) = cfg.section""",
)
def config_values(spark, sf):
    wanted = table(spark, sf, "orders").select(F.concat(F.lit("s"), F.col("o_custkey") * 2).alias("section")).distinct()
    return C.resolve_config(_config(spark, sf), wanted.withColumn("key", F.lit("database")))


@S.add(
    "resolve_tables",
    f"""WITH {BASE}, {_CONFIG_SQL},
    p AS (SELECT o_orderkey AS k, 'G:\\s' || o_custkey || '\\t' || (o_orderkey * 2) || CASE WHEN o_orderstatus = 'F' THEN '.b.B' ELSE '.B' END AS path,
      coalesce((SELECT CASE WHEN value <> '' THEN value END FROM cfg WHERE section = 'S' || o_custkey), 'DB0') AS db, o_orderkey * 2 AS want FROM orders)
    SELECT path, t.table_name, t.db_name, t.source_dir, t.schema_name FROM p LEFT JOIN
    (SELECT table_name, db_name, source_dir, CASE WHEN schema_name <> '' THEN schema_name ELSE '' END AS schema_name, k FROM tables) t
    ON t.k = p.want AND t.db_name = p.db""",
)
def tables_of(spark, sf):
    o = table(spark, sf, "orders")
    tail = F.when(F.col("o_orderstatus") == "F", ".b.B").otherwise(".B")
    paths = o.select(F.concat(F.lit("G:\\s"), "o_custkey", F.lit("\\t"), F.col("o_orderkey") * 2, tail).alias("path"))
    return C.resolve_tables(paths, derived(spark, sf, several=False), _config(spark, sf))


@S.add(
    "resolve_key",
    f"""WITH {BASE}, r AS (SELECT o_orderkey AS request, {ID_SQL.format(k='o_orderkey')},
      CASE o_custkey % 4 WHEN 0 THEN -1 WHEN 1 THEN o_orderkey % 3 WHEN 2 THEN 256 + 12 ELSE 256 + 8 END AS key_number,
      1 + o_orderkey % 3 AS current FROM orders),
    kl AS (SELECT s.table_name, s.num, sum(f.length) AS len FROM segs s JOIN fields f ON s.table_name = f.table_name AND s.field_num = f.num GROUP BY ALL),
    pick AS (SELECT r.request, r.table_name, r.db_name, r.source_dir, r.key_number, r.current,
      (SELECT min(num) FROM keys k WHERE k.table_name = r.table_name AND k.num = CASE WHEN key_number = -1 THEN current ELSE key_number + 1 END) AS byn,
      (SELECT min(num) FROM kl WHERE kl.table_name = r.table_name AND kl.len = key_number - 256) AS byl,
      (SELECT min(num) FROM keys k WHERE k.table_name = r.table_name) AS fst FROM r)
    SELECT request, table_name, db_name, source_dir, key_number, current,
      CASE WHEN key_number >= 256 THEN coalesce(byl, fst) ELSE byn END AS key_num FROM pick""",
)
def key_of(spark, sf):
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("request"), *_id("o_orderkey"),
        F.expr("CASE o_custkey % 4 WHEN 0 THEN -1 WHEN 1 THEN o_orderkey % 3 WHEN 2 THEN 256 + 12 ELSE 256 + 8 END").alias("key_number"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("current"),
    )
    return C.resolve_key(requests, derived(spark, sf))


@S.add(
    "validate_layouts",
    f"""WITH {BASE}, fc AS (SELECT table_name, count(*) AS n FROM fields GROUP BY 1),
    lead AS (SELECT table_name, name FROM fields WHERE num = 1),
    down AS (SELECT DISTINCT table_name, num FROM segs WHERE descending)
    SELECT table_name, db_name, source_dir, 'primary index names no key' AS finding, CAST(primary_index AS VARCHAR) AS detail FROM tables
      LEFT JOIN lead USING (table_name) WHERE primary_index IS NOT NULL AND (primary_index = 7 OR lead.name IS NULL)
    UNION ALL SELECT t.table_name, db_name, source_dir, 'record number key is descending', '1' FROM tables t JOIN lead USING (table_name)
      JOIN down ON down.table_name = t.table_name AND down.num = 1 WHERE primary_index = 0
    UNION ALL SELECT f.table_name, f.db_name, f.source_dir, 'field ends past the record', f.name FROM fields f JOIN tables t USING (table_name)
      WHERE f."offset" + f.length > 100
    UNION ALL SELECT table_name, db_name, source_dir, 'declared field count differs', CAST(coalesce(fc.n, 0) AS VARCHAR) FROM tables
      LEFT JOIN fc USING (table_name) WHERE declared_fields > 0 AND declared_fields <> coalesce(fc.n, 0)""",
)
def validate(spark, sf):
    return C.validate_layouts(derived(spark, sf))


_DETAIL_FIELDS = "string_agg(num || ':' || name, ',' ORDER BY num)"


@S.add(
    "layout_detail",
    f"""WITH {BASE} SELECT tables.table_name, source_dir, 1 AS profiles, f.s AS fields, k.s AS keys FROM tables
    LEFT JOIN (SELECT table_name, {_DETAIL_FIELDS} AS s FROM fields GROUP BY 1) f USING (table_name)
    LEFT JOIN (SELECT table_name, string_agg(num || '/' || segment || ':' || field_num, ',' ORDER BY num, segment) AS s FROM segs GROUP BY 1) k USING (table_name)""",
)
def detail(spark, sf):
    out = C.layout_detail(derived(spark, sf))
    fields = F.expr("array_join(transform(fields, f -> concat(f.num, ':', f.name)), ',')")
    keys = F.expr("array_join(flatten(transform(`keys`, k -> transform(k.segments, s -> concat(k.num, '/', s.segment, ':', s.field_num)))), ',')")
    return out.select("table_name", "source_dir", "profiles", fields.alias("fields"), keys.alias("keys"))


def _half(catalog: C.Catalog, keep: str) -> C.Catalog:
    return C.Catalog(*[df.where(keep) for df in catalog.frames().values()])


@S.add(
    "upsert_layouts",
    f"""WITH {BASE} SELECT t.table_name, t.db_name, t.source_dir, CASE WHEN t.source_dir = '/data/D1' THEN 120 ELSE 100 END AS record_length,
    migrated, row_count, coalesce(CASE WHEN t.source_dir = '/data/D1' THEN f.kept ELSE f.n END, 0) AS field_count FROM tables t
    LEFT JOIN (SELECT table_name, count(*) AS n, count(*) FILTER (WHERE num <> 2) AS kept FROM fields GROUP BY 1) f USING (table_name)""",
)
def upsert(spark, sf):
    """Every layout of one directory is read again: longer, and without its second field."""
    old = derived(spark, sf)
    new = _half(old, "source_dir = '/data/D1'")
    marks = {c: F.lit(None).cast(t) for c, t in C.MIGRATION.items()}
    new = C.Catalog(new.tables.withColumn("record_length", F.lit(120)).withColumns(marks), new.fields.where("num <> 2"), new.keys, new.segments)
    out = C.upsert_layouts(old, new)
    counts = C.table_summary(out).select("table_name", "field_count")
    return out.tables.select(*C.ID, "record_length", "migrated", "row_count").join(counts, "table_name")


def _edits(spark, sf, ln):
    """One edit per line item: set, put or drop, in line order; late orders drop their table."""
    n = F.col("n")
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], C.EDIT_DDL).schema}
    action = F.when(F.col("l_returnflag") == "R", "drop_field").when(F.col("l_returnflag") == "A", "put_field").otherwise("set")
    field = F.struct(
        F.concat(F.lit("New"), n).alias("name"), F.lit(1).alias("native_type"), F.lit(4).alias("length"), (n * 4).alias("offset"),
        F.lit(None).cast("int").alias("field_index"), F.lit(None).cast("string").alias("default_value"),
    )
    made = {
        "seq": n.cast("long"), "table_name": F.lower(F.concat(F.lit("T"), "l_orderkey")), "action": action,
        "property": F.when(F.col("l_returnflag") == "N", "reclen"),
        "value": F.when(F.col("l_returnflag") == "N", (100 + n).cast("string")),
        "num": F.when(F.col("l_returnflag") != "N", F.greatest(n - 1, F.lit(1))),
        "field": F.when(F.col("l_returnflag") == "A", field),
    }
    line_edits = ln.select(*[made[c].alias(c) if c in made else none[c] for c in none])
    drops = table(spark, sf, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'").select(
        *[{"seq": F.lit(99).cast("long"), "table_name": F.concat(F.lit("T"), "o_orderkey"), "action": F.lit("drop_table")}.get(c, none[c]).alias(c) for c in none]
    )
    return line_edits.unionByName(drops)


_EDITED = f"""{BASE}, dead AS (SELECT 'T' || o_orderkey AS table_name FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'),
  ed AS (SELECT 'T' || l_orderkey AS table_name, l_orderkey AS k, num AS seq, l_returnflag AS flag, greatest(num - 1, 1) AS target FROM ln),
  fe AS (SELECT * FROM ed WHERE flag <> 'N' QUALIFY row_number() OVER (PARTITION BY table_name, target ORDER BY seq DESC) = 1)"""


@S.add(
    "apply_layout_edits",
    f"""WITH {_EDITED} SELECT f.table_name, f.num, f.name FROM fields f ANTI JOIN fe ON fe.table_name = f.table_name AND fe.target = f.num
      WHERE f.table_name NOT IN (SELECT table_name FROM dead)
    UNION ALL SELECT table_name, target, 'New' || seq FROM fe WHERE flag = 'A' AND table_name NOT IN (SELECT table_name FROM dead)
      AND table_name IN (SELECT table_name FROM tables)""",
)
def edited_fields(spark, sf):
    ln = lines(spark, sf)
    return C.apply_layout_edits(derived(spark, sf, ln), _edits(spark, sf, ln))[0].fields.select("table_name", "num", "name")


@S.add(
    "apply_layout_edits_tables",
    f"""WITH {_EDITED}, st AS (SELECT table_name, max(seq) AS seq FROM ed WHERE flag = 'N' GROUP BY 1)
    SELECT table_name, coalesce(100 + seq, 100) AS record_length FROM tables LEFT JOIN st USING (table_name)
    WHERE table_name NOT IN (SELECT table_name FROM dead)""",
)
def edited_tables(spark, sf):
    ln = lines(spark, sf)
    return C.apply_layout_edits(derived(spark, sf, ln), _edits(spark, sf, ln))[0].tables.select("table_name", "record_length")


_SPECS_SQL = "SELECT l_orderkey AS k, num - 1 AS segment, (num - 1) * 20 + 1 + CASE WHEN l_returnflag = 'R' THEN 3 ELSE 0 END AS position, l_linestatus FROM ln WHERE num <= 2"


@S.add(
    "add_key",
    f"""WITH {BASE}, sp AS ({_SPECS_SQL}), hit AS (SELECT *, (position - 1) % 20 = 0 AS found FROM sp),
    nk AS (SELECT table_name, max(num) + 1 AS num FROM keys GROUP BY 1)
    SELECT 'T' || k AS table_name, nk.num, row_number() OVER (PARTITION BY k ORDER BY segment) - 1 AS segment, segment + 1 AS field_num,
      l_linestatus = 'O' AS descending FROM hit JOIN nk ON nk.table_name = 'T' || k WHERE found""",
)
def key_added(spark, sf):
    ln = lines(spark, sf)
    cat, n = derived(spark, sf, ln), F.col("n")
    specs = ln.where("n <= 2").select(
        *_id("l_orderkey"), (n - 1).alias("segment"), ((n - 1) * 20 + 1 + F.when(F.col("l_returnflag") == "R", 3).otherwise(0)).alias("position"),
        F.lit(0).alias("length"), F.when(F.col("l_linestatus") == "O", 0x40).otherwise(0).alias("flags"),
    )
    out, report = C.add_key(cat, specs)
    new = report.where("status = 0").select("table_name", "num")
    return out.segments.join(new, ["table_name", "num"], "left_semi").select("table_name", "num", "segment", "field_num", "descending")


@S.add(
    "drop_key",
    f"""WITH {BASE} SELECT table_name, db_name, source_dir, num FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY num) - 1 AS ord FROM keys)
    WHERE ord <> CAST(substr(table_name, 2) AS BIGINT) % 3""",
)
def key_dropped(spark, sf):
    cat = derived(spark, sf)
    requests = table(spark, sf, "orders").select(*_id("o_orderkey"), (F.col("o_orderkey") % 3).cast("int").alias("ordinal"))
    return C.drop_key(cat, requests)[0].keys.select(*C.ID, "num")


_KINDS = "CASE num % 7 WHEN 0 THEN 'varchar' WHEN 1 THEN 'int' WHEN 2 THEN 'bigint' WHEN 3 THEN 'bit' WHEN 4 THEN 'datetime2' WHEN 5 THEN 'char' ELSE 'money' END"


@S.add(
    "layout_from_schema",
    f"""WITH ln AS (SELECT *, {NUM} AS num FROM lineitem),
    c AS (SELECT 'T' || l_orderkey AS table_name, num AS ordinal, {_KINDS} AS kind, CAST(l_quantity AS INTEGER) * 8 AS maxlen FROM ln WHERE num <> 2),
    z AS (SELECT *, CASE kind WHEN 'int' THEN 1 WHEN 'bigint' THEN 1 WHEN 'bit' THEN 7 WHEN 'datetime2' THEN 3 ELSE 0 END AS native_type,
      CASE kind WHEN 'int' THEN 4 WHEN 'bigint' THEN 8 WHEN 'bit' THEN 1 WHEN 'datetime2' THEN 8 WHEN 'char' THEN greatest(maxlen, 1)
        ELSE greatest(1, maxlen) END AS length FROM c)
    SELECT table_name, row_number() OVER w AS num, 'Col' || ordinal AS name, native_type, length,
      CAST(sum(length) OVER w - length AS INTEGER) AS "offset" FROM z WINDOW w AS (PARTITION BY table_name ORDER BY ordinal)""",
)
def discovered(spark, sf):
    """Columns of as many backend tables as there are orders; the second column is the row identity."""
    df = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity")
    ln = row_numbers(df, [(c, False) for c in LINE_KEY], "num", by=["l_orderkey"])
    columns = ln.select(
        F.concat(F.lit("T"), "l_orderkey").alias("table_name"), F.col("num").cast("int").alias("ordinal"),
        F.when(F.col("num") == 2, "mds_recnum").otherwise(F.concat(F.lit("Col"), "num")).alias("column_name"),
        F.expr(_KINDS).alias("data_type"), (F.col("l_quantity").cast("int") * 8).alias("max_length"),
    )
    return D.layout_from_columns(columns)[0]


@S.add(
    "layout_from_table",
    """SELECT 'orders' AS table_name, v.num, v.name, v.native_type, coalesce(v.length, m.longest) AS length,
      v.base + CASE WHEN v.num > 3 THEN m.status ELSE 0 END AS "offset"
    FROM (VALUES (1, 'o_orderkey', 1, 8, 0), (2, 'o_custkey', 1, 8, 8), (4, 'o_totalprice', 2, 8, 16), (5, 'o_orderdate', 3, 8, 24))
      v(num, name, native_type, length, base), (SELECT max(length(o_orderstatus)) AS status, max(length(o_orderpriority)) AS longest FROM orders) m
    UNION ALL SELECT 'orders', 3, 'o_orderstatus', 0, max(length(o_orderstatus)), 16 FROM orders
    UNION ALL SELECT 'orders', 6, 'o_orderpriority', 0, max(length(o_orderpriority)), 32 + max(length(o_orderstatus)) FROM orders""",
)
def discovered_orders(spark, sf):
    return D.layout_from_columns(D.columns_of(table(spark, sf, "orders"), "orders"))[0]


@S.add("apply_diff", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_clerk FROM orders")
def repaired(spark, sf):
    """Orders brought to a layout with a clerk and without date and priority."""
    df = table(spark, sf, "orders")
    wanted = df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").withColumn("o_clerk", F.lit("x"))
    expected = D.columns_of(wanted, "orders")
    found = D.schema_diff(expected, D.columns_of(df, "ORDERS"))
    return D.apply_diff(df, found, wanted.schema, drop_extra=True)


@S.add(
    "created_columns",
    f"""WITH ln AS (SELECT *, {NUM} AS num FROM lineitem), t AS (SELECT o_orderkey AS k, 'new_t' || o_orderkey AS table_name FROM orders),
    s AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY num) - 1 AS i, CASE num % 6 WHEN 0 THEN 'VARCHAR(' || greatest(num * 2, 1) || ')'
      WHEN 1 THEN 'INT' WHEN 3 THEN 'REAL' ELSE 'VARBINARY(' || greatest(num * 2, 1) || ')' END AS ty FROM ln)
    SELECT table_name, 0 AS ordinal, 'recnum' AS column_name, 'BIGINT' AS data_type FROM t
    UNION ALL SELECT table_name, i + 1, 'col_' || lpad(CAST(i AS VARCHAR), 2, '0'), ty FROM t JOIN s USING (k)
    UNION ALL SELECT table_name, 1, 'col_00', 'VARCHAR(255)' FROM t WHERE k NOT IN (SELECT k FROM s)""",
)
def created(spark, sf):
    path = lambda k: F.concat(F.lit("C:\\x\\New-T"), k, F.lit(".b"))
    tables = table(spark, sf, "orders").select(path("o_orderkey").alias("path"))
    specs = lines(spark, sf, several=False).select(path("l_orderkey").alias("path"), F.col("n").alias("segment"), (F.col("n") * 2).alias("length"), (F.col("n") % 6).alias("type"))
    return D.created_columns(specs, tables)
