"""Layout texts as a catalog.

A text describes one table and is one row.  Its key lines are met once, in Arrow batches, and
become rows of the frame that is asked for: nothing is shuffled until the catalog frames are
joined by somebody.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keyloom.operators.catalog import FIELD_DDL, ID, KEY_DDL, SEGMENT_DDL, TABLE_DDL, Catalog

# Header keys of a layout text and the catalog columns they fill.
_HEADER = {
    "TABLE_NAME": ("table_name", "string"), "SCHEMA_NAME": ("schema_name", "string"), "DATABASE_SPACE_NAME": ("db_name", "string"),
    "LOGICAL_RECORD_LENGTH": ("record_length", "int"), "PAGE_SIZE": ("page_size", "int"), "FILE_FLAGS": ("file_flags", "int"),
    "PRIMARY_INDEX": ("primary_index", "int"), "IGNORE_NULL_VALUES": ("ignore_null_values", "number"),
    "TRIM_STRING_FIELDS": ("trim_string_fields", "number"), "TRANSLATE_OEM_TO_ANSI": ("translate_oem_to_ansi", "number"),
    "LOCAL_CACHE": ("local_cache", "word"), "DRIVER_NAME": ("driver_name", "string"), "SERVER_NAME": ("server_name", "string"),
    "PERMANENT_INT": ("permanent", "word"), "NUMBER_DF_FIELDS": ("declared_fields", "int"),
}


def layout_texts(spark: SparkSession, path: str | Sequence[str], recursive: bool = True, ext: str = "int") -> DataFrame:
    """Layout texts as ``(file, value)``."""
    pattern = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in ext)
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    return texts.select(F.col("_metadata.file_path").alias("file"), "value")


# A key at a line's start; the lines of a text are joined by newlines only, the other ends of a line begin a line too.
_KEY = re.compile(r"(?:^|(?<=[\x85\u2028\u2029]))[ \t\x0b\f\r]*([A-Z_]+)(?=[\t-\r \x85\u2028\u2029]|\Z)", re.M | re.I | re.A)
_WORD = re.compile(r"[ \t\x0b\f\r]*([^\t-\r ]*)")
_BLANK = " \t\x0b\f\r"
_INT = re.compile(r"[\x00-\x20\x7f]*([+-]?[0-9]+)[\x00-\x20\x7f]*")
_FIELD = {"FIELD_NAME", "FIELD_NATIVE_TYPE", "FIELD_NATIVE_LENGTH", "FIELD_NATIVE_OFFSET", "FIELD_INDEX", "FIELD_DEFAULT_VALUE"}


def _number(text: str) -> int | None:
    """An int as Spark's ``try_cast`` reads it."""
    found = _INT.fullmatch(text)
    value = int(found[1]) if found else None
    return value if value is not None and -(1 << 31) <= value < 1 << 31 else None


class _Text:
    """One pass over the key lines of a text; of lines with the same key in a block the last counts."""

    def __init__(self, text: str):
        self.heads: dict[str, str] = {}
        self.blocks: list[tuple[str, dict[str, str]]] = []
        self.keys: list[tuple] = []
        self.has_flags = False
        field = key = segment = None
        for m in _KEY.finditer(text):
            name, end = m[1].upper(), m.end()
            stop = text.find("\n", end)
            line = text[end:] if stop < 0 else text[end:stop]
            if name in _HEADER:
                if end < len(text) and text[end] in "\t\n\x0b\f\r ":
                    self.heads[name] = line.strip(_BLANK)
            elif name == "FIELD_NUMBER":
                field = {}
                self.blocks.append((line.strip(_BLANK), field))
            elif name in _FIELD:
                if field is not None:
                    field[name] = line.strip(_BLANK)
            elif name == "INDEX_NUMBER":
                key, segment = {"segments": [], "num": _WORD.match(line)[1]}, None
                self.keys.append(key)
            elif name == "INDEX_NUMBER_SEGMENTS":
                if key is not None:
                    key["count"] = line.strip(_BLANK)
            elif name == "INDEX_SEGMENT_FIELD":
                if key is not None:
                    segment = {"field": _WORD.match(line)[1]}
                    key["segments"].append(segment)
            elif name == "INDEX_SEGMENT_FLAG":
                self.has_flags = True
                # a segment block ends with its first flag line; direction and null value stand before it
                if segment is not None and "flag" not in segment:
                    segment["flag"] = _WORD.match(line)[1]
            elif name in ("INDEX_SEGMENT_DIRECTION", "INDEX_SEGMENT_NULL_VALUE"):
                if segment is not None and "flag" not in segment:
                    segment[name] = line.strip(_BLANK)

    def fields(self) -> list[tuple]:
        """``num, name, native_type, length, offset, field_index, default_value`` of every field block with number and name."""
        out = []
        for number, block in self.blocks:
            num, name = _number(number), block.get("FIELD_NAME", "")
            if num is not None and num >= 0 and name:
                sizes = (_number(block.get(f"FIELD_NATIVE_{k}", "")) or 0 for k in ("TYPE", "LENGTH", "OFFSET"))
                out.append((num, name, *sizes, _number(block.get("FIELD_INDEX", "")), block.get("FIELD_DEFAULT_VALUE") or None))
        return out

    def segments(self) -> list[tuple]:
        """``num, num_segments, segment, field_num, attrs, descending, null_value``; a key without usable blocks comes from the fields that name it."""
        out = []
        for key in self.keys if self.has_flags else []:
            num, place = _number(key["num"]), 0
            for s in key["segments"] if num is not None and num >= 0 else []:
                at, flag = _number(s["field"]) or 0, _number(s.get("flag", ""))
                if at > 0 and flag is not None and flag != -1:
                    down = s.get("INDEX_SEGMENT_DIRECTION", "").upper() == "DESCENDING"
                    out.append((num, _number(key.get("count", "")) or 0, place, at, flag & 65535, down, _number(s.get("INDEX_SEGMENT_NULL_VALUE", "")) or 0))
                    place += 1
        if out:
            return out
        named: dict[int, list[int]] = {}
        for num, _, _, _, _, index, _ in self.fields():
            if index is not None:
                named.setdefault(index, []).append(num)
        return [(k, len(nums), i, num, 0, False, 0) for k, nums in named.items() for i, num in enumerate(nums)]


_FIELD_ROW = "num int, name string, native_type int, length int, offset int, field_index int, default_value string"
_SEGMENT_ROW = "num int, num_segments int, segment int, field_num int, attrs int, descending boolean, null_value int"


def _parsed(texts: DataFrame, rows: Callable[[_Text], list[tuple]], ddl: str) -> DataFrame:
    """``file``, the header values and the columns of ``ddl``: a row for each of a text's ``rows``."""
    own = [c.rsplit(" ", 1)[0] for c in ddl.split(", ")]
    types = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds = [types[c.rsplit(" ", 1)[1]] for c in ddl.split(", ")]
    heads = list(_HEADER) if ddl == _NOTHING else ["TABLE_NAME", "DATABASE_SPACE_NAME"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, named, found = [], [], []
            for file, text in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                parsed = _Text((text or "").replace("\r\n", "\n").replace("\r", "\n"))
                mine = rows(parsed)
                found += mine
                files += [file] * len(mine)
                named += [[parsed.heads.get(h, "") for h in heads]] * len(mine)
            columns = zip(*found) if found else [[]] * len(own)
            values = zip(*named) if named else [[]] * len(heads)
            arrays = [pa.array(files, pa.string()), *[pa.array(v, pa.string()) for v in values], *[pa.array(c, t) for c, t in zip(columns, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["file", *heads, *own])

    schema = ", ".join(["file string", *[f"{h} string" for h in heads], ddl])
    return texts.select("file", "value").mapInArrow(run, schema)


_NOTHING = "has_text boolean"


def parse_layouts(texts: DataFrame, db: str | None = None, schema: str | None = None) -> tuple[Catalog, DataFrame]:
    """Catalog frames of layout texts ``(file, value)``, and the files without a table name.

    ``db`` and ``schema`` fill in where a text leaves them empty.
    """
    value = F.col
    int_of = lambda text: text.try_cast("int")
    made = {"source_file": F.col("file"), "migrated": F.lit(False), "source_dir": F.regexp_replace("file", "/[^/]*$", "")}
    for key, (name, kind) in _HEADER.items():
        text = value(key)
        default = {"db_name": db, "schema_name": schema}.get(name)
        made[name] = {
            "int": int_of(text) if name == "primary_index" else F.coalesce(int_of(text), F.lit(0)),
            "number": (text != "") & (text != "0"),
            "word": F.upper(text) == "YES",
            "string": F.when(text == "", F.lit(default or "")).otherwise(text),
        }[kind]
    layout_schema = texts.sparkSession.createDataFrame([], TABLE_DDL).schema
    heads = _parsed(texts, lambda t: [(True,)], _NOTHING)
    tables = heads.select("file", *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in layout_schema])
    skipped = tables.where("table_name = ''").select("file")
    tables = tables.where("table_name <> ''")

    columns = lambda ddl: [c.split()[0] for c in ddl.split(", ")]
    named = lambda df: df.where("TABLE_NAME <> ''").withColumns({c: made[c].cast("string") for c in ("db_name", "source_dir")})
    fields = named(_parsed(texts, _Text.fields, _FIELD_ROW)).select(*columns(FIELD_DDL))
    segments = named(_parsed(texts, _Text.segments, _SEGMENT_ROW))
    keys = named(_parsed(texts, _Text.segments, _SEGMENT_ROW)).where("segment = 0")
    return Catalog(tables.select(*columns(TABLE_DDL)), fields, keys.select(*columns(KEY_DDL)), segments.select(*columns(SEGMENT_DDL))), skipped


def read_layouts(
    spark: SparkSession, path: str | Sequence[str], recursive: bool = True, db: str | None = None, schema: str | None = None
) -> tuple[Catalog, DataFrame]:
    """All layout texts under ``path`` as a catalog, and the files that were skipped."""
    return parse_layouts(layout_texts(spark, path, recursive), db, schema)
