"""Key statistics and uniqueness audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from keyloom import layout as L
from keyloom.layout import KeySpec, Layout, as_key

# Fixed value: attributes reported for a segment that declares none.
_PLAIN_ATTRS = 0x0103

_SEGMENT_DDL = "key_number int, segment int, position int, length int, attributes int, native_type int"


def _segment_rows(layout: Layout) -> list[tuple]:
    rows = []
    for k, key in enumerate(layout.keys):
        for s, segment in enumerate(key.segments):
            f = layout.field(segment.column)
            attrs = segment.attrs
            if attrs is None:
                attrs = _PLAIN_ATTRS
                attrs |= L.ATTR_OLD_BINARY if f.native_type != L.STRING else 0
                attrs |= L.ATTR_SEGMENTED if s + 1 < len(key.segments) else 0
            rows.append((k, s, f.offset + 1, f.length, attrs, f.native_type))
    return rows or [(None,) * 6]


def file_stat(df: DataFrame, layout: Layout) -> DataFrame:
    """One row per key segment, each with the file's lengths, flags and exact row count."""
    segments = df.sparkSession.createDataFrame(_segment_rows(layout), _SEGMENT_DDL)
    count = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return segments.select(
        F.lit(layout.record_length).alias("record_length"),
        F.lit(layout.page_size).alias("page_size"),
        F.lit(len(layout.keys)).alias("key_count"),
        count.alias("record_count"),
        F.lit(layout.file_flags).alias("file_flags"),
        *segments.columns,
    )


def key_cardinality(df: DataFrame, keys: Sequence[KeySpec | Sequence[str]], approx: bool = False) -> DataFrame:
    """Distinct values per key in one pass.

    A single column does not count its nulls, a combination of columns does.
    """
    specs = [as_key(k) for k in keys]
    count = F.approx_count_distinct if approx else F.count_distinct
    found = df.agg(
        *[
            count(k.columns[0] if len(k.columns) == 1 else F.struct(*k.columns)).alias(f"k{i}")
            for i, k in enumerate(specs)
        ]
    )
    lines = [F.struct(F.lit(",".join(k.columns)).alias("key"), F.col(f"k{i}").alias("n")) for i, k in enumerate(specs)]
    return found.select(F.explode(F.array(*lines)).alias("line")).select(
        F.col("line.key").alias("key"), F.col("line.n").alias("distinct_keys")
    )


def unique_violations(df: DataFrame, key: KeySpec | Sequence[str]) -> DataFrame:
    """Values of a unique key that occur more than once, with their number of records."""
    columns = as_key(key).columns
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def unique_audit(df: DataFrame, layout: Layout) -> DataFrame:
    """All violations of the layout's unique keys; ``key_values`` holds the values as text."""
    parts = [
        unique_violations(df, k).select(
            F.lit(k.num).alias("key_number"),
            F.array(*[F.col(c).cast("string") for c in k.columns]).alias("key_values"),
            "copies",
        )
        for k in layout.keys
        if k.unique
    ]
    if not parts:
        return df.sparkSession.createDataFrame([], "key_number int, key_values array<string>, copies long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
