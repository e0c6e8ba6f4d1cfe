"""Expected against actual columns: types, drift, health, repair and load reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from keyloom import layout as L
from keyloom.operators.catalog import ID, Catalog
from keyloom.operators.joins import drift_join
from keyloom.plans.ordering import by_rows

TARGETS = ("mssql", "postgres", "sqlite")


def column_type(target: str, native: str = "native_type", length: str = "length") -> Column:
    """Column type text of a field in a target database."""
    t, n = F.col(native), F.col(length)
    size = F.greatest(F.when(t == L.LSTRING, n - 1).otherwise(n), F.lit(1)).cast("string")
    # Column types by native type.
    base = (
        F.when(t.isin(*L.TEXT_TYPES), F.concat(F.lit("VARCHAR("), size, F.lit(")")))
        .when(t == L.INT, F.when(n == 1, "TINYINT").when(n == 2, "SMALLINT").when(n == 4, "INT").otherwise("BIGINT"))
        .when(t.isin(L.AUTOINC, L.AUTOINCREMENT), "INT")
        .when(t == L.FLOAT, F.when(n <= 4, "REAL").otherwise("FLOAT"))
        .when(t == L.DATE, "DATE")
        .when(t == L.TIME, "TIME(0)")
        .when(t == L.DECIMAL, "DECIMAL(18,0)")
        .when(t == L.MONEY, "DECIMAL(18,4)")
        .when(t == L.LOGICAL, "TINYINT")
        .otherwise(F.concat(F.lit("VARBINARY("), F.greatest(n, F.lit(1)).cast("string"), F.lit(")")))
    )
    if target == "mssql":
        return base
    if target == "postgres":
        return F.when(base.startswith("VARBINARY"), "BYTEA").when(base == "TINYINT", "SMALLINT").otherwise(base)
    if target == "sqlite":
        return (
            F.when(base.startswith("VARCHAR") | (base == "DATE"), "TEXT").when(base.startswith("VARBINARY"), "BLOB")
            .when(base.isin("TINYINT", "SMALLINT", "INT", "BIGINT"), "INTEGER").otherwise(base)
        )
    raise ValueError(f"unknown target {target!r}")


def export_type(native: str = "native_type", length: str = "length") -> Column:
    """Column type text of the layout exporter, which knows more native types than the codec."""
    t, n = F.col(native), F.col(length)
    text = lambda kind: F.concat(F.lit(f"{kind}("), n.cast("string"), F.lit(")"))
    digits = lambda low, scale: F.concat(F.lit("DECIMAL("), F.greatest(n * 2 - 1, F.lit(low)).cast("string"), F.lit(f", {scale})"))
    # Exported column types by native type.
    return (
        F.when(t.isin(0, 8, 10, 11, 17, 18), text("VARCHAR"))
        .when(t == 1, F.when(n == 1, "TINYINT").when(n == 2, "SMALLINT").when(n == 4, "INT").when(n == 8, "BIGINT").otherwise(text("VARBINARY")))
        .when(t.isin(2, 9), F.when(n == 4, "REAL").otherwise("FLOAT"))
        .when(t == 3, "DATE").when(t == 4, "TIME(0)").when(t == 5, digits(1, 0)).when(t == 6, digits(5, 4))
        .when(t == 7, "BIT")
        .when(t == 14, F.when(n == 2, "INT").when(n == 4, "BIGINT").otherwise(text("VARBINARY")))
        .when(t == 15, "INT").when(t == 19, "DECIMAL(19, 4)").when(t == 20, "DATETIME2(7)")
        .otherwise(text("VARBINARY"))
    )


def expected_columns(catalog: Catalog, target: str = "mssql") -> DataFrame:
    return catalog.fields.select(
        *ID, F.col("name").alias("column_name"), "num", column_type(target).alias("data_type")
    )


def normal_type(target: str, column: Column) -> Column:
    """Type text for comparison: upper case, collation and most lengths dropped, aliases merged."""
    raw = F.upper(F.trim(column))
    core = F.regexp_extract(raw, r"^[^ (]*", 0)
    if target == "sqlite":
        return (
            F.when(core.isin("INT", "TINYINT", "SMALLINT", "BIGINT", "BIT"), "INTEGER")
            .when(core.isin("VARCHAR", "CHAR", "NVARCHAR", "DATETIME", "DATE"), "TEXT").otherwise(core)
        )
    if target == "postgres":
        return (
            F.when(core == "DATETIME", "TIMESTAMP").when(core == "VARCHAR", "CHARACTER VARYING")
            .when(core == "INT", "INTEGER").when(core.isin("BIT", "TINYINT"), "SMALLINT").otherwise(core)
        )
    size = F.regexp_extract(raw, r"\([^)]*\)?", 0)
    return F.when(core.isin("VARCHAR", "CHAR", "NVARCHAR", "NCHAR"), F.concat(core, size)).otherwise(core)


def schema_diff(expected: DataFrame, actual: DataFrame, target: str = "mssql") -> DataFrame:
    """One row per column with ``outcome`` matched, missing, extra or mismatch.

    ``expected`` and ``actual`` have ``table_name``, ``column_name``, ``data_type``.  A table
    that does not exist at all reports no missing columns.
    """
    pairs = drift_join(expected, actual)
    present = actual.select(F.upper("table_name").alias("__t")).distinct()
    pairs = pairs.join(present, F.upper("table_name") == F.col("__t"), "left")
    same = normal_type(target, F.col("expected_type")) == normal_type(target, F.col("actual_type"))
    outcome = (
        F.when(~F.col("is_expected"), "extra").when(~F.col("is_actual"), "missing").when(same, "matched").otherwise("mismatch")
    )
    return pairs.where(F.col("is_actual") | F.col("__t").isNotNull()).select(
        "table_name", "column_name", "expected_type", "actual_type", outcome.alias("outcome")
    )


def apply_diff(df: DataFrame, diff: DataFrame, types: T.StructType, add_missing: bool = True, drop_extra: bool = False) -> DataFrame:
    """Bring one table to its layout: missing columns become nulls, extra ones may be dropped.

    ``diff`` holds one table's columns, so reading it to the driver is bounded by the layout.
    """
    rows = diff.where("outcome IN ('missing', 'extra')").select("column_name", "outcome").collect()
    wanted = {f.name.upper(): f for f in types.fields}
    out = df
    if add_missing:
        new = {wanted[r.column_name.upper()].name: F.lit(None).cast(wanted[r.column_name.upper()].dataType)
               for r in rows if r.outcome == "missing"}
        out = out.withColumns(new) if new else out
    if drop_extra:
        out = out.drop(*[r.column_name for r in rows if r.outcome == "extra"])
    return out


def health(catalog: Catalog, actual: DataFrame, connected: DataFrame | None = None, target: str = "mssql") -> DataFrame:
    """Per table: missing, extra and mismatched columns and ``status``.

    ``connected`` lists the source directories with a working connection; without it all have one.
    """
    t = catalog.tables
    fields = expected_columns(catalog, target)
    field_count = fields.groupBy(*[F.col(c).alias(f"__c_{c}") for c in ID]).agg(F.count(F.lit(1)).alias("field_count"))
    base = t.join(field_count, [t[c].eqNullSafe(field_count[f"__c_{c}"]) for c in ID], "left").select(
        *[t[c] for c in ID], F.coalesce(t["migrated"], F.lit(False)).alias("migrated"), t["row_count"],
        F.coalesce("field_count", F.lit(0)).alias("field_count"),
    )
    if connected is None:
        base = base.withColumn("__connected", F.lit(True))
    else:
        c = connected.select(F.col("source_dir").alias("__cs"), F.lit(True).alias("__connected")).distinct()
        base = base.join(c, base["source_dir"].eqNullSafe(c["__cs"]), "left").drop("__cs")

    # several profiles of a name are compared with the same actual table
    e = fields.select(*[F.col(c).alias(f"__e_{c}") for c in ID], F.upper("table_name").alias("__t"), F.upper("column_name").alias("__col"),
                      normal_type(target, F.col("data_type")).alias("__etype"))
    a = actual.groupBy(F.upper("table_name").alias("__t"), F.upper("column_name").alias("__col")).agg(
        F.max(normal_type(target, F.col("data_type"))).alias("__atype")
    )
    sizes = a.groupBy("__t").agg(F.count(F.lit(1)).alias("__columns"))
    joined = e.join(a, ["__t", "__col"], "left").groupBy(*[f"__e_{c}" for c in ID]).agg(
        F.count_if(F.col("__atype").isNull()).alias("__missing"),
        F.count_if(F.col("__atype") != F.col("__etype")).alias("__mismatch"),
        F.count("__atype").alias("__found"),
    )
    out = base.join(joined, [base[c].eqNullSafe(joined[f"__e_{c}"]) for c in ID], "left")
    out = out.join(sizes, F.upper(base["table_name"]) == F.col("__t"), "left")
    has_schema = F.col("field_count") > 0
    connected_ = F.coalesce("__connected", F.lit(False))
    exists = F.coalesce(F.col("__columns") > 0, F.lit(False)) & connected_
    compared = exists & has_schema
    number = lambda c: F.when(compared, F.coalesce(c, F.lit(0))).otherwise(F.lit(0))
    missing, mismatch = number(F.col("__missing")), number(F.col("__mismatch"))
    extra = number(F.col("__columns") - F.col("__found"))
    status = (
        F.when(~has_schema, "no_schema").when(~connected_, "no_connection").when(~exists, "missing")
        .when(missing + extra + mismatch == 0, "ok").otherwise("drift")
    )
    return out.select(
        *[base[c] for c in ID], "field_count", exists.alias("table_exists"), missing.alias("missing"), extra.alias("extra"),
        mismatch.alias("mismatches"), "migrated", "row_count", status.alias("status"),
    )


def health_summary(tables: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return tables.agg(
        F.count(F.lit(1)).alias("total"), count("ok").alias("in_sync"), count("drift").alias("drifted"),
        count("missing").alias("missing_table"), count("no_schema").alias("no_schema"), F.count_if("migrated").alias("migrated"),
    )


def reconcile(info: DataFrame, imported: DataFrame) -> DataFrame:
    """Declared, active and loaded records per file, and the differences between them."""
    loaded = imported.select("file", F.col("records").alias("loaded"))
    out = info.select("file", "declared_records", "active_records").join(loaded, "file", "full_outer")
    return out.select(
        "file", "declared_records", "active_records", "loaded",
        (F.col("active_records") - F.col("declared_records")).alias("active_minus_declared"),
        (F.coalesce("loaded", F.lit(0)) - F.coalesce("active_records", F.lit(0))).alias("loaded_minus_active"),
    )


def layout_from_columns(columns: DataFrame, recnum: str = "MDS_RECNUM") -> tuple[DataFrame, DataFrame]:
    """Fields and record lengths from backend columns ``(table_name, ordinal, column_name, data_type, max_length)``.

    Offsets run on in column order; the row-identity column is left out.  A table's columns
    are bounded by its schema, so its window is small however many tables there are.
    """
    kind, n = F.lower(F.trim("data_type")), F.coalesce(F.col("max_length"), F.lit(0))
    short = F.greatest(F.lit(1), n)
    # Native type and length by column type.
    native = (
        F.when(kind.isin("int", "smallint", "bigint"), L.INT).when(kind == "tinyint", L.AUTOINC)
        .when(kind.isin("decimal", "numeric"), L.DECIMAL).when(kind.isin("float", "real"), L.FLOAT)
        .when(kind == "bit", L.LOGICAL).when(kind.isin("datetime", "datetime2", "date"), L.DATE).otherwise(L.STRING)
    )
    length = (
        F.when(kind.isin("char", "nchar"), F.greatest(n, F.lit(1))).when(kind.isin("int", "date"), 4).when(kind == "smallint", 2)
        .when(kind.isin("tinyint", "bit"), 1)
        .when(kind.isin("bigint", "decimal", "numeric", "float", "real", "datetime", "datetime2"), 8).otherwise(short)
    )
    kept = columns.where(F.upper("column_name") != recnum.upper())
    sized = kept.select("table_name", "ordinal", F.col("column_name").alias("name"), native.alias("native_type"), length.cast("int").alias("length"))
    w = Window.partitionBy("table_name").orderBy("ordinal")
    fields = sized.select(
        "table_name", F.row_number().over(w).alias("num"), "name", "native_type", "length",
        F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int").alias("offset"),
    )
    return fields, fields.groupBy("table_name").agg(F.sum("length").cast("int").alias("record_length"))


# Column type names of Spark types.
_SPARK_KINDS = {
    "tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint", "float": "real", "double": "float",
    "boolean": "bit", "date": "date", "timestamp": "datetime2", "timestamp_ntz": "datetime2",
}


def columns_of(df: DataFrame, table_name: str) -> DataFrame:
    """A frame's own schema as backend columns; text columns take their longest value as length."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.max(F.length(c)).alias(c) for c in text]) if text else df.sparkSession.range(1)
    entries = []
    for i, f in enumerate(df.schema, 1):
        name = f.dataType.simpleString()
        kind = "decimal" if name.startswith("decimal") else "varchar" if f.name in text else _SPARK_KINDS.get(name, "varbinary")
        size = F.coalesce(F.col(f"`{f.name}`"), F.lit(0)).cast("int") if f.name in text else F.lit(0)
        entries.append(F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(kind).alias("data_type"), size.alias("max_length")))
    return longest.select(F.explode(F.array(*entries)).alias("c")).select(F.lit(table_name).alias("table_name"), "c.*")


# -- creating tables -------------------------------------------------------------------


def created_columns(specs: DataFrame, tables: DataFrame) -> DataFrame:
    """Columns of new tables from key-segment specs ``(path, segment, length, type)``.

    Every table starts with a row-number column; one without segments has a text column.
    """
    stem = F.lower(F.regexp_replace(F.regexp_extract("path", r"([^\\/]*)$", 1), r"(?<=.)\.[^.]*$", ""))
    name = F.regexp_replace(stem, "[^a-z0-9_]", "_").alias("table_name")
    size = F.greatest(F.col("length"), F.lit(1)).cast("string")
    # Column types by segment type.
    kind = (
        F.when(F.col("type") == 0, F.concat(F.lit("VARCHAR("), size, F.lit(")"))).when(F.col("type") == 1, "INT")
        .when(F.col("type") == 3, "REAL").when(F.col("type") == 9, "DATE").when(F.col("type") == 10, "TIME")
        .otherwise(F.concat(F.lit("VARBINARY("), size, F.lit(")")))
    )
    w = Window.partitionBy("path").orderBy("segment")
    given = by_rows(specs, "path").select("path", (F.row_number().over(w) - 1).alias("__i"), kind.alias("data_type"))
    blank = tables.select("path").distinct().join(specs.select("path").distinct(), "path", "left_anti").select(
        "path", F.lit(0).alias("__i"), F.lit("VARCHAR(255)").alias("data_type")
    )
    both = given.unionByName(blank)
    keyed = both.select("path", (F.col("__i") + 1).alias("ordinal"), F.format_string("col_%02d", "__i").alias("column_name"), "data_type")
    head = tables.select("path").distinct().select(
        "path", F.lit(0).alias("ordinal"), F.lit(L.DEFAULT_RECNUM).alias("column_name"), F.lit("BIGINT").alias("data_type")
    )
    return head.unionByName(keyed).select(name, "ordinal", "column_name", "data_type")


ALREADY_EXISTS = 59

_SPARK_COLUMN = {"INT": "INT", "REAL": "FLOAT", "DATE": "DATE", "TIME": "STRING", "BIGINT": "BIGINT"}


def create_table(spark, path: str, segments: Sequence[tuple[int, int]], exclusive: bool = False) -> int:
    """Create an empty table from ``(length, type)`` segments; 59 when it must not exist but does."""
    specs = spark.createDataFrame([(path, i, n, t) for i, (n, t) in enumerate(segments)], "path string, segment int, length int, type int")
    columns = created_columns(specs, spark.createDataFrame([(path,)], "path string")).orderBy("ordinal").collect()
    name = columns[0].table_name
    if exclusive and spark.catalog.tableExists(name):
        return ALREADY_EXISTS
    kind = lambda t: "STRING" if t.startswith("VARCHAR") else "BINARY" if t.startswith("VARBINARY") else _SPARK_COLUMN[t]
    ddl = ", ".join(f"`{c.column_name}` {kind(c.data_type)}" for c in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({ddl}) USING parquet")
    return 0
