"""Loading directories of record files into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from keyloom.functions.codec import decode_records
from keyloom.layout import Layout
from keyloom.operators.catalog import (
    FIELD_DDL,
    KEY_DDL,
    SEGMENT_DDL,
    TABLE_DDL,
    Catalog,
    layout_detail,
    path_parts,
    to_layout,
    upsert_layouts,
)
from keyloom.plans.lineage import cut
from keyloom.sources.record_files import active_records, collect_files, covered_bytes, derive_layouts, key_segments, read_headers, records_of
from keyloom.sources.tables import write_table

PLACE = ["file", "page_no", "slot_no"]


def decoded_files(headers: DataFrame, layout: Layout, mode: str = "auto") -> DataFrame:
    """Typed records of files that share a layout; file, page and slot identify a record."""
    return decode_records(records_of(headers, mode), layout, keep=PLACE)


def _table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def import_files(
    spark: SparkSession, paths: str | Sequence[str], catalog: Catalog, target: str, create: bool = True,
    truncate: bool = False, dry_run: bool = False, auto_layout: bool = True, table: str | None = None,
    recursive: bool = True, mode: str = "auto", ext: str = "b",
) -> tuple[DataFrame, Catalog]:
    """Load every file into the table named by its stem (or ``table``), under ``target``.

    The layout comes from the catalog, else from the file's keys when ``auto_layout`` is set.
    One job runs per table, whatever number of files it has; the tables' rows keep file, page
    and slot.  Returns one report row per file and the catalog with the derived layouts
    (save it to keep them).
    """
    headers = read_headers(collect_files(spark, paths, ext, recursive))
    stem, _, _ = path_parts("file")
    headers = cut(headers.withColumn("__table", F.lit(table.upper()) if table else stem))
    names = headers.select("__table").distinct()
    known = catalog.tables.select(F.upper("table_name").alias("__table")).distinct()
    good = headers.where("problem IS NULL")

    unknown = good.join(known, "__table", "left_anti")
    # files of one table share one derived layout: the first file by name stands for all
    first = unknown.groupBy("__table").agg(F.min("file").alias("file"))
    derived = derive_layouts(unknown.join(first.select("file"), "file", "left_semi"))
    if table:
        renamed = {n: df.withColumn("table_name", F.lit(table.upper())) for n, df in derived.frames().items()}
        derived = Catalog(**renamed)
    if auto_layout:
        derived = Catalog(*[cut(df) for df in derived.frames().values()])
        catalog = upsert_layouts(catalog, derived)

    wanted = names.withColumnRenamed("__table", "__wanted")
    needed = Catalog(*[
        df.join(wanted, F.upper(df["table_name"]) == F.col("__wanted"), "left_semi") for df in catalog.frames().values()
    ])
    # one row per table to load; what the driver holds grows with layouts, not with records
    layouts = [to_layout(r) for r in layout_detail(needed).collect()]
    layouts = [l for l in layouts if l.fields]
    missing = {l.name.upper() for l in layouts if not create and not dry_run and not _table_exists(spark, f"{target}/{l.name.upper()}")}
    layouts = [l for l in layouts if l.name.upper() not in missing]

    loaded = None
    for layout in layouts:
        mine = good.where(F.col("__table") == layout.name.upper())
        if dry_run:
            counts = active_records(mine, mode)
        else:
            path = f"{target}/{layout.name.upper()}"
            before = spark.read.parquet(path).groupBy("file").agg(F.count(F.lit(1)).alias("__old")) if not truncate and _table_exists(spark, path) else None
            before = cut(before) if before is not None else None
            write_table(decoded_files(mine, layout, mode), path, "overwrite" if truncate else "append")
            counts = spark.read.parquet(path).join(mine.select("file"), "file", "left_semi").groupBy("file").agg(F.count(F.lit(1)).alias("active_records"))
            if before is not None:
                counts = counts.join(before, "file", "left").select("file", (F.col("active_records") - F.coalesce("__old", F.lit(0))).alias("active_records"))
        loaded = counts if loaded is None else loaded.unionByName(counts)
    sizes = spark.createDataFrame(
        [(l.name.upper(), l.record_length) for l in layouts], "__table string, __layout_length int"
    )
    gone = spark.createDataFrame([(m,) for m in sorted(missing)], "__table string").withColumn("__missing", F.lit(True))
    covered = covered_bytes(key_segments(unknown)) if auto_layout else spark.createDataFrame([], "file string, covered_bytes long")
    from_keys = unknown.select("file", F.lit(True).alias("__derived"))
    out = headers.join(sizes, "__table", "left").join(gone, "__table", "left").join(covered, "file", "left").join(from_keys, "file", "left")
    out = out.join(loaded, "file", "left") if loaded is not None else out.withColumn("active_records", F.lit(None).cast("long"))
    ok = F.col("problem").isNull() & F.col("__layout_length").isNotNull()
    uncovered = F.col("record_length") - F.coalesce("covered_bytes", F.lit(0))
    message = F.concat_ws(
        "; ",
        F.col("problem"),
        F.when(F.col("__missing"), "table does not exist"),
        F.when(F.col("problem").isNull() & F.col("__layout_length").isNull() & F.col("__missing").isNull(), "no layout"),
        F.when(ok & (F.col("record_length") != F.col("__layout_length")),
               F.format_string("file has record length %d, layout %d", "record_length", "__layout_length")),
        F.when(ok & F.col("__derived") & (uncovered > 0), F.format_string("%d bytes are covered by no key", uncovered)),
    )
    report = out.select(
        "file", F.col("__table").alias("table_name"), F.when(ok, "ok").otherwise("skipped").alias("status"),
        F.when(ok, F.coalesce("active_records", F.lit(0))).otherwise(0).alias("records"), message.alias("message"),
    )
    return cut(report), catalog


def empty_catalog(spark: SparkSession) -> Catalog:
    return Catalog(*[spark.createDataFrame([], ddl) for ddl in (TABLE_DDL, FIELD_DDL, KEY_DDL, SEGMENT_DDL)])


def catalog_of(spark: SparkSession, layouts: Sequence[Layout], source_dir: str = "") -> Catalog:
    """Catalog frames of layouts declared in code."""
    schema = spark.createDataFrame([], TABLE_DDL).schema
    tables, fields, keys, segments = [], [], [], []
    for l in layouts:
        ident = (l.name, "", source_dir)
        known = {"table_name": l.name, "db_name": "", "source_dir": source_dir, "schema_name": "", "record_length": l.record_length,
                 "page_size": l.page_size, "file_flags": l.file_flags, "primary_index": l.primary_index, "migrated": False}
        tables.append(tuple(known.get(f.name) for f in schema))
        numbers = {f.name: f.num for f in l.fields}
        fields += [(*ident, f.num, f.name, f.native_type, f.length, f.offset, f.index, f.default) for f in l.fields]
        for k in l.keys:
            keys.append((*ident, k.num, len(k.segments)))
            segments += [(*ident, k.num, i, numbers[s.column], s.attrs, s.descending, s.null_byte) for i, s in enumerate(k.segments)]
    return Catalog(
        spark.createDataFrame(tables, TABLE_DDL), spark.createDataFrame(fields, FIELD_DDL),
        spark.createDataFrame(keys, KEY_DDL), spark.createDataFrame(segments, SEGMENT_DDL),
    )
