"""The layout catalog as four frames, and the operators that change and read it.

Every entry is identified by table name, database and source directory.  Catalogs may
describe any number of tables, so all of this is joins and aggregations over frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from keyloom import layout as L

ID = ["table_name", "db_name", "source_dir"]
MIGRATION = {"migrated": "boolean", "migrated_at": "timestamp", "row_count": "bigint", "target_server": "string", "target_db": "string"}

TABLE_DDL = (
    "table_name string, db_name string, source_dir string, schema_name string, source_file string, "
    "record_length int, page_size int, file_flags int, primary_index int, ignore_null_values boolean, "
    "trim_string_fields boolean, translate_oem_to_ansi boolean, local_cache boolean, driver_name string, "
    "server_name string, permanent boolean, declared_fields int, migrated boolean, migrated_at timestamp, "
    "row_count bigint, target_server string, target_db string"
)
FIELD_DDL = (
    "table_name string, db_name string, source_dir string, num int, name string, native_type int, "
    "length int, offset int, field_index int, default_value string"
)
KEY_DDL = "table_name string, db_name string, source_dir string, num int, num_segments int"
SEGMENT_DDL = (
    "table_name string, db_name string, source_dir string, num int, segment int, field_num int, attrs int, "
    "descending boolean, null_value int"
)

# Fixed value: the most keys a file may have.
MAX_KEYS = 119


@dataclass(frozen=True)
class Catalog:
    tables: DataFrame
    fields: DataFrame
    keys: DataFrame
    segments: DataFrame

    def frames(self) -> dict[str, DataFrame]:
        return {"tables": self.tables, "fields": self.fields, "keys": self.keys, "segments": self.segments}

    def save(self, path: str, mode: str = "errorifexists") -> None:
        for name, df in self.frames().items():
            df.write.mode(mode).parquet(f"{path}/layout_{name}")

    @staticmethod
    def load(spark, path: str) -> "Catalog":
        return Catalog(*[spark.read.parquet(f"{path}/layout_{n}") for n in ("tables", "fields", "keys", "segments")])


def on_id(left: DataFrame, right: DataFrame, columns: Sequence[str] = ID) -> list[Column]:
    return [left[c].eqNullSafe(right[c]) for c in columns]


def upsert_layouts(catalog: Catalog, new: Catalog) -> Catalog:
    """Replace the tables named in ``new`` with their fields and keys; migration marks stay."""
    named = new.tables.select(*ID).distinct()

    def kept(df: DataFrame) -> DataFrame:
        return df.join(named, on_id(df, named), "left_anti")

    marks = catalog.tables.select(*[F.col(c).alias(f"__{c}") for c in ID], *[F.col(c).alias(f"__{c}") for c in MIGRATION])
    on = [new.tables[c].eqNullSafe(marks[f"__{c}"]) for c in ID]
    renewed = new.tables.join(marks, on, "left")
    renewed = renewed.select(
        *[c for c in new.tables.columns if c not in MIGRATION],
        *[F.coalesce(F.col(f"__{c}"), F.lit(False)).alias(c) if c == "migrated" else F.col(f"__{c}").alias(c) for c in MIGRATION],
    )
    return Catalog(
        kept(catalog.tables).unionByName(renewed.select(*catalog.tables.columns)),
        kept(catalog.fields).unionByName(new.fields),
        kept(catalog.keys).unionByName(new.keys),
        kept(catalog.segments).unionByName(new.segments),
    )


# -- edits -----------------------------------------------------------------------------

EDIT_DDL = (
    "seq bigint, table_name string, action string, property string, value string, num int, "
    "field struct<name:string,native_type:int,length:int,offset:int,field_index:int,default_value:string>, "
    "segments array<struct<field_num:int,attrs:int,descending:boolean,null_value:int>>"
)

# Short names of table properties.
_SHORT_PROPERTIES = {
    "schema": "schema_name", "database": "db_name", "reclen": "record_length", "ignore_null": "ignore_null_values",
    "trim": "trim_string_fields", "oem": "translate_oem_to_ansi", "server": "server_name", "driver": "driver_name",
    "permanent": "permanent",
}
_PROPERTIES = [
    "schema_name", "db_name", "record_length", "page_size", "file_flags", "ignore_null_values", "trim_string_fields",
    "translate_oem_to_ansi", "primary_index", "local_cache", "server_name", "driver_name", "permanent",
]


def _last_edit(edits: DataFrame, actions: Sequence[str], *target: str) -> DataFrame:
    w = Window.partitionBy("__name", *target).orderBy(F.col("seq").desc())
    kept = edits.where(F.col("action").isin(*actions))
    return kept.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def apply_layout_edits(catalog: Catalog, edits: DataFrame) -> tuple[Catalog, DataFrame]:
    """Apply edits in ``seq`` order: the last edit of a property, field or key wins.

    Actions: ``set``, ``put_field``, ``drop_field``, ``put_key``, ``drop_key``, ``drop_table``.
    An edit names its table without regard to case and goes to every profile of that name.
    Returns the new catalog and the edits that name no known table or property.
    """
    edits = edits.withColumn("__name", F.upper("table_name"))
    known = catalog.tables.select(F.upper("table_name").alias("__name"), *ID).distinct()
    unknown_property = (F.col("action") == "set") & ~F.coalesce(_property().isin(*_PROPERTIES), F.lit(False))
    orphans = edits.join(known.select("__name").distinct(), "__name", "left_anti")
    refused = orphans.unionByName(
        edits.join(known.select("__name").distinct(), "__name", "left_semi").where(unknown_property)
    ).select("seq", "table_name", "action", "property")

    dropped = edits.where("action = 'drop_table'").select("__name").distinct()

    def alive(df: DataFrame) -> DataFrame:
        named = df.withColumn("__name", F.upper("table_name"))
        return named.join(dropped, "__name", "left_anti")

    settings = _last_edit(edits.withColumn("property", _property()), ["set"], "property")
    values = settings.groupBy("__name").pivot("property", _PROPERTIES).agg(F.first("value"))
    values = values.select("__name", *[F.col(p).alias(f"__{p}") for p in _PROPERTIES])
    tables = alive(catalog.tables).join(values, "__name", "left")
    types = dict(catalog.tables.dtypes)
    new_tables = tables.select(*[
        F.coalesce(F.col(f"__{c}").try_cast(types[c]), F.col(c)).alias(c) if c in _PROPERTIES else F.col(c)
        for c in catalog.tables.columns
    ])
    renamed = tables.select("__name", *ID, F.coalesce("__db_name", "db_name").alias("__db"))

    def rebase(df: DataFrame) -> DataFrame:
        """Children follow their table when its database changes."""
        here = renamed.select(*[F.col(c).alias(f"__t_{c}") for c in ID], "__db")
        moved = df.join(here, [df[c].eqNullSafe(here[f"__t_{c}"]) for c in ID], "left")
        return moved.select(*[F.coalesce("__db", "db_name").alias(c) if c == "db_name" else F.col(c) for c in df.columns])

    profiles = renamed.select("__name", *ID)

    def expanded(changes: DataFrame) -> DataFrame:
        return changes.drop("table_name").join(profiles, "__name")

    field_edits = _last_edit(edits, ["put_field", "drop_field"], "num")
    fields = alive(catalog.fields)
    fields = fields.join(field_edits.select("__name", "num"), ["__name", "num"], "left_anti").select(*catalog.fields.columns)
    put = expanded(field_edits.where("action = 'put_field'"))
    fields = fields.unionByName(put.select(*ID, "num", "field.*").select(*catalog.fields.columns))

    key_edits = _last_edit(edits, ["put_key", "drop_key"], "num")
    touched = key_edits.select("__name", "num")
    keys = alive(catalog.keys).join(touched, ["__name", "num"], "left_anti").select(*catalog.keys.columns)
    segments = alive(catalog.segments).join(touched, ["__name", "num"], "left_anti").select(*catalog.segments.columns)
    put = expanded(key_edits.where("action = 'put_key'"))
    keys = keys.unionByName(put.select(*ID, "num", F.size("segments").alias("num_segments")))
    each = put.select(*ID, "num", F.posexplode("segments").alias("segment", "s"))
    segments = segments.unionByName(each.select(*ID, "num", "segment", "s.*").select(*catalog.segments.columns))
    return Catalog(new_tables, rebase(fields), rebase(keys), rebase(segments)), refused


def _property() -> Column:
    name = F.lower("property")
    for short, full in _SHORT_PROPERTIES.items():
        name = F.when(name == short, F.lit(full)).otherwise(name)
    return name


# -- migration marks -------------------------------------------------------------------


def mark_migrated(tables: DataFrame, marks: DataFrame) -> DataFrame:
    """Set the flag, time, row count and target of the tables in ``marks`` (``migrated_at`` is given)."""
    given = marks.select(
        F.upper("table_name").alias("__name"),
        *[F.col(c).cast(t).alias(f"__{c}") for c, t in MIGRATION.items() if c != "migrated"],
    )
    joined = tables.join(given, F.upper(tables["table_name"]) == F.col("__name"), "left")
    marked = F.col("__name").isNotNull()
    columns = []
    for c in tables.columns:
        if c == "migrated":
            columns.append(F.when(marked, F.lit(True)).otherwise(F.col(c)).alias(c))
        elif c in MIGRATION:
            columns.append(F.when(marked, F.col(f"__{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(tables[c])
    return joined.select(*columns)


def clear_migrated(tables: DataFrame, names: DataFrame) -> DataFrame:
    """Reset flag, time and row count; the target stays."""
    given = names.select(F.upper("table_name").alias("__name")).distinct()
    joined = tables.join(given, F.upper(tables["table_name"]) == F.col("__name"), "left")
    clear = F.col("__name").isNotNull()
    columns = []
    for c in tables.columns:
        if c == "migrated":
            columns.append((F.col(c) & ~clear).alias(c))
        elif c in ("migrated_at", "row_count"):
            columns.append(F.when(~clear, F.col(c)).alias(c))
        else:
            columns.append(tables[c])
    return joined.select(*columns)


def migration_status(catalog: Catalog) -> DataFrame:
    counts = catalog.fields.groupBy(*[F.col(c).alias(f"__{c}") for c in ID]).agg(F.count(F.lit(1)).alias("__fields"))
    joined = catalog.tables.join(counts, [catalog.tables[c].eqNullSafe(counts[f"__{c}"]) for c in ID], "left")
    return joined.select(
        "table_name", "source_dir", F.coalesce("migrated", F.lit(False)).alias("migrated"), "migrated_at", "row_count",
        "target_db", F.coalesce("__fields", F.lit(0)).alias("field_count"),
    )


def migration_summary(catalog: Catalog) -> DataFrame:
    return catalog.tables.agg(
        F.count_if(F.coalesce("migrated", F.lit(False))).alias("done"), F.count(F.lit(1)).alias("total")
    )


# -- reading ---------------------------------------------------------------------------


def table_summary(catalog: Catalog) -> DataFrame:
    """Field and key counts per table."""
    out = catalog.tables.select(*ID, "record_length")
    for name, df in (("field_count", catalog.fields), ("key_count", catalog.keys)):
        n = df.groupBy(*[F.col(c).alias(f"__{c}") for c in ID]).agg(F.count(F.lit(1)).alias(f"__{name}"))
        joined = out.join(n, [out[c].eqNullSafe(n[f"__{c}"]) for c in ID], "left")
        out = joined.select(*out.columns, F.coalesce(f"__{name}", F.lit(0)).alias(name))
    return out


def layout_detail(catalog: Catalog, table_name: str | None = None, source_dir: str | None = None) -> DataFrame:
    """One row per table name with its ordered fields, keys and segments.

    Of several profiles of one name the first by source directory is taken; ``profiles``
    tells how many there are.  The nested lists hold one layout, which its format bounds.
    """
    tables = catalog.tables
    if table_name is not None:
        tables = tables.where(F.upper("table_name") == table_name.upper())
    if source_dir is not None:
        tables = tables.where(F.col("source_dir") == source_dir)
    named = tables.withColumn("__name", F.upper("table_name"))
    many = named.groupBy("__name").agg(F.count(F.lit(1)).alias("profiles"))
    w = Window.partitionBy("__name").orderBy(F.col("source_dir").asc_nulls_first(), F.col("db_name").asc_nulls_first())
    first = named.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
    first = first.join(many, "__name").drop("__name")

    def nested(df: DataFrame, by: list[str], name: str, *columns: str) -> DataFrame:
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))

    def attach(left: DataFrame, right: DataFrame, columns: list[str], name: str) -> DataFrame:
        hidden = right.select(*[F.col(c).alias(f"__{c}") for c in columns], name)
        joined = left.join(hidden, [left[c].eqNullSafe(hidden[f"__{c}"]) for c in columns], "left")
        return joined.drop(*[f"__{c}" for c in columns])

    wanted = first.select(*ID)
    only = lambda df: df.join(wanted, on_id(df, wanted), "left_semi")
    fields = nested(only(catalog.fields), ID, "fields", "num", "name", "native_type", "length", "offset", "field_index", "default_value")
    segments = nested(only(catalog.segments), [*ID, "num"], "segments", "segment", "field_num", "attrs", "descending", "null_value")
    keys = attach(only(catalog.keys), segments, [*ID, "num"], "segments")
    keys = nested(keys, ID, "keys", "num", "num_segments", "segments")
    return attach(attach(first, fields, ID, "fields"), keys, ID, "keys")


def to_layout(row, recnum: str = L.DEFAULT_RECNUM) -> L.Layout:
    """A ``Layout`` from one row of ``layout_detail``."""
    fields = tuple(
        L.Field(f.num, f.name, f.native_type, f.length, f.offset, f.field_index, f.default_value) for f in row.fields or []
    )
    names = {f.num: f.name for f in fields}
    keys = tuple(
        L.KeySpec(
            tuple(L.Segment(names[s.field_num], s.descending, s.attrs, s.null_value) for s in k.segments or [] if s.field_num in names),
            k.num,
        )
        for k in row["keys"] or []
    )
    return L.Layout(row.table_name, row.record_length, fields, keys, recnum, row.page_size, row.file_flags, row.primary_index)


def key_lengths(catalog: Catalog) -> DataFrame:
    """Key length in bytes: the sum of its segments' field lengths."""
    s, f = catalog.segments.alias("s"), catalog.fields.alias("f")
    on = [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ID] + [F.col("s.field_num") == F.col("f.num")]
    sized = s.join(f, on, "left").groupBy(*[F.col(f"s.{c}").alias(c) for c in ID], F.col("s.num").alias("num"))
    return sized.agg(F.coalesce(F.sum("f.length"), F.lit(0)).cast("int").alias("key_length"))


def resolve_key(requests: DataFrame, catalog: Catalog) -> DataFrame:
    """Requests ``(request, <table id>, key_number, current)`` with the key they mean, or null.

    -1 means the current key; a small number is 0-based; with the high byte set the low
    byte is a key length, and the first key answers when no key has that length.
    """
    lengths = key_lengths(catalog)
    keys = catalog.keys
    number = F.col("key_number").cast("int")
    low = number.bitwiseAND(255)
    by_length = (number >= 256) | (number < -1)
    asked = requests.withColumn(
        "__num", F.when(number == -1, F.col("current")).when(~by_length, low + 1)
    ).withColumn("__length", F.when(by_length & (low > 0), low))
    known = keys.select(*[F.col(c).alias(f"__k_{c}") for c in ID], F.col("num").alias("__known"))
    sized = lengths.groupBy(*[F.col(c).alias(f"__l_{c}") for c in ID], "key_length").agg(F.min("num").alias("__sized"))
    first = keys.groupBy(*[F.col(c).alias(f"__f_{c}") for c in ID]).agg(F.min("num").alias("__first"))
    out = asked.join(known, [asked[c].eqNullSafe(known[f"__k_{c}"]) for c in ID] + [F.col("__num") == F.col("__known")], "left")
    out = out.join(sized, [asked[c].eqNullSafe(sized[f"__l_{c}"]) for c in ID] + [F.col("__length") == F.col("key_length")], "left")
    out = out.join(first, [asked[c].eqNullSafe(first[f"__f_{c}"]) for c in ID], "left")
    meant = F.coalesce("__known", F.when(F.col("__length").isNotNull(), F.coalesce("__sized", "__first")))
    return out.select(*[asked[c] for c in requests.columns], meant.alias("key_num"))


def add_key(catalog: Catalog, specs: DataFrame) -> tuple[Catalog, DataFrame]:
    """Add one key per table from segment specs ``(<table id>, segment, position, length, flags)``.

    A segment is matched to the field at its 1-based position (length 0 matches any);
    unmatched segments are left out.  Reports 26 at the key limit, 6 when nothing matched.
    """
    spec = specs.withColumn("__off", F.greatest(F.col("position") - 1, F.lit(0)))
    f = catalog.fields.select(
        *[F.col(c).alias(f"__f_{c}") for c in ID], F.col("num").alias("field_num"), F.col("length").alias("__len"), F.col("offset").alias("__at")
    )
    on = [spec[c].eqNullSafe(f[f"__f_{c}"]) for c in ID] + [
        F.col("__at") == F.col("__off"), (F.col("__len") == spec["length"]) | (spec["length"] == 0)
    ]
    matched = spec.join(f, on, "left").groupBy(*ID, "segment").agg(
        F.min("field_num").alias("field_num"), F.first("flags").alias("flags")
    )
    top = catalog.keys.groupBy(*[F.col(c).alias(f"__k_{c}") for c in ID]).agg(
        F.max("num").alias("__top"), F.count(F.lit(1)).alias("__count")
    )
    per = matched.groupBy(*ID).agg(F.count("field_num").cast("int").alias("num_segments"))
    judged = per.join(top, [per[c].eqNullSafe(top[f"__k_{c}"]) for c in ID], "left").select(
        *[per[c] for c in ID], "num_segments", (F.coalesce("__top", F.lit(0)) + 1).alias("num"),
        F.when(F.col("num_segments") == 0, F.lit(6)).when(F.coalesce("__count", F.lit(0)) >= MAX_KEYS, F.lit(26)).otherwise(F.lit(0)).alias("status"),
    )
    good = judged.where(F.col("status") == 0)
    live = matched.where(F.col("field_num").isNotNull())
    w = Window.partitionBy(*ID).orderBy("segment")
    placed = live.withColumn("__seg", F.row_number().over(w) - 1)
    picked = placed.join(good.select(*[F.col(c).alias(f"__g_{c}") for c in ID], "num"),
                         [placed[c].eqNullSafe(F.col(f"__g_{c}")) for c in ID])
    segments = picked.select(
        *ID, "num", F.col("__seg").alias("segment"), "field_num", F.lit(0).alias("attrs"),
        (F.col("flags").bitwiseAND(L.ATTR_DESCENDING) != 0).alias("descending"), F.lit(0).alias("null_value"),
    )
    out = Catalog(
        catalog.tables, catalog.fields,
        catalog.keys.unionByName(good.select(*ID, "num", "num_segments")),
        catalog.segments.unionByName(segments),
    )
    return out, judged.select(*ID, "status", F.when(F.col("status") == 0, F.col("num")).alias("num"))


def drop_key(catalog: Catalog, requests: DataFrame) -> tuple[Catalog, DataFrame]:
    """Drop keys by 0-based ordinal ``(<table id>, ordinal)``; reports 6 where there is none."""
    w = Window.partitionBy(*ID).orderBy("num")
    numbered = catalog.keys.withColumn("ordinal", F.row_number().over(w) - 1)
    asked = requests.select(*ID, "ordinal").distinct()
    gone = numbered.join(asked, on_id(numbered, asked, [*ID, "ordinal"]), "left_semi").select(*ID, "num", "ordinal")
    flag = gone.select(*[F.col(c).alias(f"__{c}") for c in [*ID, "ordinal"]], F.lit(True).alias("__hit"))
    report = asked.join(flag, [asked[c].eqNullSafe(flag[f"__{c}"]) for c in [*ID, "ordinal"]], "left").select(
        *[asked[c] for c in [*ID, "ordinal"]], F.when(F.col("__hit"), F.lit(0)).otherwise(F.lit(6)).alias("status")
    )
    rest = lambda df: df.join(gone, on_id(df, gone, [*ID, "num"]), "left_anti")
    return Catalog(catalog.tables, catalog.fields, rest(catalog.keys), rest(catalog.segments)), report


# -- resolution ------------------------------------------------------------------------


def resolve_config(config: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values for ``(section, key)`` pairs: the section's own, where not empty, else the global one.

    ``config`` has ``section`` (``config`` is the global one), ``key`` and ``value``.
    """
    filled = config.where(F.coalesce(F.col("value"), F.lit("")) != "")
    own = filled.groupBy(F.upper("section").alias("__s"), F.upper("key").alias("__k")).agg(F.max("value").alias("__own"))
    general = own.where("__s = 'CONFIG'").select(F.col("__k").alias("__gk"), F.col("__own").alias("__general"))
    out = wanted.join(own, (F.upper(wanted["section"]) == F.col("__s")) & (F.upper(wanted["key"]) == F.col("__k")), "left")
    out = out.join(general, F.upper(wanted["key"]) == F.col("__gk"), "left")
    return out.select(*[wanted[c] for c in wanted.columns], F.coalesce("__own", "__general", F.lit("")).alias("value"))


def _normal(name: Column) -> Column:
    return F.translate(F.upper(F.trim(name)), "\\/.", "___")


def path_parts(path: str) -> tuple[Column, Column, Column]:
    """Upper-case file stem, directory, and last directory name of a path column."""
    p = F.col(path)
    folder = F.regexp_replace(p, r"[\\/]?[^\\/]*$", "")
    base = F.regexp_extract(p, r"([^\\/]*)$", 1)
    # the stem ends at the last dot, unless that is the first character
    stem = F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
    section = F.upper(F.regexp_extract(folder, r"([^\\/]*)$", 1))
    return F.upper(stem), F.upper(folder), section


def resolve_tables(paths: DataFrame, catalog: Catalog, config: DataFrame, path: str = "path") -> DataFrame:
    """The catalog table each file path means.

    The path's directory names a database; only tables of that database are looked at, by
    name and by name with ``\\ / .`` turned into ``_``.  Without a database the plain name
    counts.  A table is also known as ``NAME.B`` and ``NAME_B``.  An empty schema falls
    back to the global one.
    """
    stem, folder, section = path_parts(path)
    asked = paths.select(*paths.columns, stem.alias("__stem"), section.alias("__section"))
    wanted = asked.select(F.col("__section").alias("section")).distinct().withColumn("key", F.lit("DATABASE"))
    databases = resolve_config(config, wanted).select(F.col("section").alias("__s"), F.upper("value").alias("__db"))
    asked = asked.join(databases, F.col("__section") == F.col("__s"), "left").drop("__s")

    name = F.upper(F.trim("table_name"))
    variants = F.array_distinct(F.array(name, F.concat(name, F.lit(".B")), F.concat(name, F.lit("_B")), _normal(F.col("table_name"))))
    known = catalog.tables.select(
        F.explode(variants).alias("__variant"), name.alias("__table"), F.upper("db_name").alias("__tdb"), "source_dir", "schema_name"
    )
    # of several tables under one name the last by (name, source directory) answers
    choice = lambda df, *by: df.groupBy(*by).agg(F.max(F.struct("__table", "source_dir", "__tdb", "schema_name")).alias("__hit"))
    scoped = choice(known, "__tdb", "__variant").select(F.col("__tdb").alias("__d"), F.col("__variant").alias("__v"), "__hit")
    plain = choice(known, "__variant").select(F.col("__variant").alias("__pv"), F.col("__hit").alias("__plain"))
    other = scoped.select(F.col("__d").alias("__d2"), F.col("__v").alias("__v2"), F.col("__hit").alias("__hit2"))
    out = asked.join(scoped, (F.col("__db") != "") & (F.col("__db") == F.col("__d")) & (F.col("__stem") == F.col("__v")), "left")
    out = out.join(other, (F.col("__db") != "") & (F.col("__db") == F.col("__d2")) & (_normal(F.col("__stem")) == F.col("__v2")), "left")
    out = out.join(plain, (F.col("__db") == "") & (F.col("__stem") == F.col("__pv")), "left")
    found = F.coalesce("__hit", "__hit2", "__plain")
    general = resolve_config(config, paths.sparkSession.createDataFrame([("config", "SCHEMA")], "section string, key string"))
    fallback = general.agg(F.max("value")).scalar()
    return out.withColumn("__found", found).select(
        *paths.columns, F.col("__found.__table").alias("table_name"), F.col("__found.__tdb").alias("db_name"),
        F.col("__found.source_dir").alias("source_dir"),
        F.when(F.col("__found").isNotNull(), F.when(F.col("__found.schema_name") != "", F.col("__found.schema_name")).otherwise(fallback)).alias("schema_name"),
    )


def resolve_recnum(catalog: Catalog, config: DataFrame, default: str = "MDS_RECNUM") -> DataFrame:
    """Row-identity column per table.

    The first field of key ``primary_index + 1``, else the database's ``RECNUM_COLUMN.<DB>``,
    else the global ``RECNUM_COLUMN``, else ``default``.
    """
    t = catalog.tables.select(*ID, "primary_index")
    s = catalog.segments.select(*[F.col(c).alias(f"__s_{c}") for c in ID], F.col("num").alias("__key"), "segment", "field_num")
    w = Window.partitionBy(*[f"__s_{c}" for c in ID], "__key").orderBy("segment")
    s = s.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n", "segment")
    f = catalog.fields.select(*[F.col(c).alias(f"__f_{c}") for c in ID], F.col("num").alias("__num"), F.col("name").alias("__field"))
    out = t.join(s, [t[c].eqNullSafe(s[f"__s_{c}"]) for c in ID] + [F.col("primary_index") + 1 == F.col("__key")], "left")
    out = out.join(f, [t[c].eqNullSafe(f[f"__f_{c}"]) for c in ID] + [F.col("field_num") == F.col("__num")], "left")
    filled = config.where((F.upper("section") == "CONFIG") & (F.coalesce(F.col("value"), F.lit("")) != ""))
    per_db = filled.where(F.upper("key").startswith("RECNUM_COLUMN.")).groupBy(
        F.upper(F.expr(f"substring(key, {len('RECNUM_COLUMN.') + 1})")).alias("__db")
    ).agg(F.max("value").alias("__per_db"))
    general = filled.where(F.upper("key") == "RECNUM_COLUMN").agg(F.max("value")).scalar()
    out = out.join(per_db, F.upper(t["db_name"]) == F.col("__db"), "left")
    return out.select(*[t[c] for c in ID], F.coalesce("__field", "__per_db", general, F.lit(default)).alias("recnum"))


def validate_layouts(catalog: Catalog, skipped: DataFrame | None = None, default: str = "MDS_RECNUM") -> DataFrame:
    """Findings ``(<table id>, finding, detail)`` over the whole catalog."""
    tables, fields, segments = catalog.tables, catalog.fields, catalog.segments
    empty = catalog.tables.sparkSession.createDataFrame([], "section string, key string, value string")
    recnum = resolve_recnum(catalog, empty, default)

    def line(df: DataFrame, finding: str, detail: Column) -> DataFrame:
        return df.select(*ID, F.lit(finding).alias("finding"), detail.cast("string").alias("detail"))

    r = recnum.select(*[F.col(c).alias(f"__r_{c}") for c in ID], F.col("recnum").alias("__recnum"))
    with_recnum = lambda df: df.join(r, [df[c].eqNullSafe(r[f"__r_{c}"]) for c in ID])
    parts = [
        line(
            with_recnum(tables).where((F.col("__recnum") == default) & F.col("primary_index").isNotNull()),
            "primary index names no key", F.col("primary_index"),
        )
    ]
    f = fields.select(*[F.col(c).alias(f"__f_{c}") for c in ID], F.col("num").alias("__num"), F.col("name").alias("__name"))
    named = segments.join(
        f, [segments[c].eqNullSafe(f[f"__f_{c}"]) for c in ID] + [segments["field_num"] == f["__num"]], "left"
    )
    parts.append(line(named.where(F.col("__num").isNull()), "segment names no field",
                      F.concat_ws(".", segments["num"].cast("string"), segments["segment"].cast("string"))))
    down = segments.where("descending").select(*[F.col(c).alias(f"__d_{c}") for c in ID], F.col("num").alias("__dnum")).distinct()
    leads = with_recnum(named.where("segment = 0")).where(F.upper("__name") == F.upper("__recnum"))
    parts.append(line(
        leads.join(down, [leads[c].eqNullSafe(down[f"__d_{c}"]) for c in ID] + [leads["num"] == F.col("__dnum")], "left_semi"),
        "record number key is descending", F.col("num"),
    ))
    # a layout's fields are few: they meet their table once, in one row
    held = fields.groupBy(*[F.col(c).alias(f"__c_{c}") for c in ID]).agg(
        F.count(F.lit(1)).alias("__fields"), F.collect_list(F.struct((F.col("offset") + F.col("length")).alias("end"), "name")).alias("__ends")
    )
    counted = tables.join(held, [tables[c].eqNullSafe(held[f"__c_{c}"]) for c in ID], "left").withColumn("__fields", F.coalesce("__fields", F.lit(0)))
    found = lambda finding, detail: F.struct(F.lit(finding).alias("finding"), detail.cast("string").alias("detail"))
    past = F.transform(
        F.filter("__ends", lambda e: e["end"] > F.col("record_length")), lambda e: found("field ends past the record", e["name"])
    )
    differs = F.when((F.col("declared_fields") > 0) & (F.col("declared_fields") != F.col("__fields")), F.array(found("declared field count differs", F.col("__fields"))))
    parts.append(counted.select(*ID, F.inline(F.concat(F.coalesce(past, F.array()), F.coalesce(differs, F.array())))))
    if skipped is not None:
        parts.append(skipped.select(F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("string").alias("db_name"),
                                    F.lit(None).cast("string").alias("source_dir"), F.lit("file does not parse").alias("finding"),
                                    F.col("file").alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
