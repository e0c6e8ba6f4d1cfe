"""Global order without a global task.

A window ordered over a whole table (or over one hot group) would move all of it into one
task.  Here the sort key space is cut into ranges of about equal row count; every range is
windowed by itself, and what has to cross a range border travels in a frame with at most
one row per range.

The range borders are literals taken from a sample of the *full* sort key, record number
included.  A key, user or table that holds a third of all rows is therefore cut into many
ranges, and a recomputed task puts every row into the same range as before, which a
`spark_partition_id()` after `repartitionByRange` would not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from keyloom.functions.predicates import Order, sort_columns

# Ranges follow the rows.  Frames with a row per range are broadcast up to this many ranges.
BROADCAST_RANGES = 100_000
ROWS_PER_RANGE = 1_000_000
# Sampled keys per range; fewer where there are many ranges, as the driver holds the sample.
SAMPLE_PER_RANGE = 24
MANY_RANGES, SAMPLE_PER_MANY = 8192, 6
_SMALL_RANGE_ROWS = 2_000
_RANGES_PER_PARTITION = 4
_TREE_BORDERS = 63

_BUCKET = "__range"


def by_rows(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many partitions as its rows ask for, the session's number at least."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(max(width, math.ceil(df.count() / ROWS_PER_RANGE)), *keys)


def _literal(value, dtype: T.DataType) -> str:
    """SQL text of one border value (timestamps are held as microseconds)."""
    name = dtype.simpleString()
    if value is None:
        return f"CAST(NULL AS {name})"
    if isinstance(dtype, T.StringType):
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    if isinstance(dtype, T.BinaryType):
        return f"X'{bytes(value).hex()}'"
    if isinstance(dtype, T.TimestampType):
        return f"timestamp_micros({value}L)"
    return f"CAST('{value}' AS {name})"


def _later_sql(left: list[str], right: list[str], descending: list[bool]) -> str:
    parts = []
    for i, desc in enumerate(descending):
        l, r = left[i], right[i]
        if desc:
            strict = f"coalesce({l} < {r}, {l} IS NULL AND {r} IS NOT NULL)"
        else:
            strict = f"coalesce({l} > {r}, {r} IS NULL AND {l} IS NOT NULL)"
        parts.append(" AND ".join([f"{left[j]} <=> {right[j]}" for j in range(i)] + [strict]))
    return "(" + " OR ".join(f"({p})" for p in parts) + ")"


@dataclass(frozen=True)
class KeyRanges:
    """Sorted literal borders; range ``i`` starts at border ``i - 1``.

    A few borders become a tree of comparisons inside generated code.  Many borders use a
    coarse tree and then a broadcast equi-join on the coarse number with the borders inside
    it, so neither the plan nor the work per row grows with the number of ranges.
    """

    order: Order
    types: tuple[T.DataType, ...]
    borders: tuple[tuple, ...]

    def __len__(self) -> int:
        return len(self.borders) + 1

    def assign(self, df: DataFrame, name: str = _BUCKET, strict: bool = False) -> DataFrame:
        """Add the range number: borders at or before the row (``strict``: before it)."""
        if len(self.borders) <= _TREE_BORDERS:
            return df.withColumn(name, F.expr(self._tree(list(enumerate(self.borders)), 0, strict)))
        stride = math.ceil(len(self.borders) / _TREE_BORDERS)
        coarse = list(enumerate(self.borders))[stride - 1 :: stride]
        tree = self._tree([(i, b) for i, (_, b) in enumerate(coarse)], 0, strict)
        fine = _per_range(self._fine_ranges(df, [i for i, _ in coarse]), self)
        row = [f"`{c}`" for c, _ in self.order]
        lo = [f"__lo{i}" for i in range(len(row))]
        hi = [f"__hi{i}" for i in range(len(row))]
        desc = [d for _, d in self.order]
        if strict:
            inside = f"(__open_lo OR {_later_sql(row, lo, desc)}) AND (__open_hi OR NOT {_later_sql(row, hi, desc)})"
        else:
            inside = f"(__open_lo OR NOT {_later_sql(lo, row, desc)}) AND (__open_hi OR {_later_sql(hi, row, desc)})"
        placed = df.withColumn("__coarse", F.expr(tree))
        on = (placed["__coarse"] == fine["__coarse_of"]) & F.expr(inside)
        return placed.join(fine, on).select(*df.columns, F.col("__fine").alias(name))

    def _tree(self, borders: list[tuple[int, tuple]], start: int, strict: bool) -> str:
        if not borders:
            return str(start)
        mid = len(borders) // 2
        number, border = borders[mid]
        row = [f"`{c}`" for c, _ in self.order]
        literal = [_literal(v, t) for v, t in zip(border, self.types)]
        desc = [d for _, d in self.order]
        before = f"NOT {_later_sql(row, literal, desc)}" if strict else _later_sql(literal, row, desc)
        left = self._tree(borders[:mid], start, strict)
        right = self._tree(borders[mid + 1 :], number + 1, strict)
        return f"IF({before}, {left}, {right})"

    def _fine_ranges(self, df: DataFrame, coarse: list[int]) -> DataFrame:
        """One row per range: its coarse number and its two borders."""
        width = len(self.order)
        rows, group = [], 0
        for i in range(len(self)):
            lo = self.borders[i - 1] if i else None
            hi = self.borders[i] if i < len(self.borders) else None
            values = list(lo or [None] * width) + list(hi or [None] * width)
            rows.append((group, i, lo is None, hi is None, *values))
            if group < len(coarse) and i == coarse[group]:
                group += 1
        names = [f"__lo{i}" for i in range(width)] + [f"__hi{i}" for i in range(width)]
        head = "__coarse_of int, __fine int, __open_lo boolean, __open_hi boolean"
        return _border_frame(df, head, rows, names, self.types * 2)


def _per_range(frame: DataFrame, ranges: KeyRanges) -> DataFrame:
    """A frame with at most a row or two per range: broadcast while that is known to be few."""
    return F.broadcast(frame) if len(ranges) <= BROADCAST_RANGES else frame


def _border_frame(df: DataFrame, head: str, rows: list[tuple], names: list[str], types) -> DataFrame:
    """A frame of border values; they travel as text and are cast back inside Spark."""
    fixed = head.count(",") + 1
    text = [
        (*r[:fixed], *[v if v is None else v.hex() if isinstance(v, (bytes, bytearray)) else str(v) for v in r[fixed:]])
        for r in rows
    ]
    raw = df.sparkSession.createDataFrame(text, head + "".join(f", {n} string" for n in names))

    def typed(name: str, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.BinaryType):
            return F.unhex(name)
        if isinstance(dtype, T.TimestampType):
            return F.timestamp_micros(F.col(name).cast("long"))
        return F.col(name).cast(dtype)

    return raw.select(*raw.columns[:fixed], *[typed(n, t).alias(n) for n, t in zip(names, types)])


def _key_values(c: str, dtype: T.DataType) -> Column:
    return F.unix_micros(c).alias(c) if isinstance(dtype, T.TimestampType) else F.col(c)


def borders_of(keys: DataFrame, order: Order) -> KeyRanges:
    """Every row of a small key frame as a border."""
    types = tuple(keys.schema[c].dataType for c, _ in order)
    ordered = keys.orderBy(*sort_columns(order)).select(*[_key_values(c, t) for (c, _), t in zip(order, types)])
    return KeyRanges(order, types, tuple(tuple(r) for r in ordered.collect()))


def sample_ranges(df: DataFrame, order: Order, ranges: int | None = None) -> KeyRanges:
    """Cut ``order`` into ranges of about equal row count.

    Runs a count and a sampling job over the sort columns only; the sample brought to the
    driver has about ``SAMPLE_PER_RANGE`` keys per range.
    """
    keys = df.select(*dict.fromkeys(c for c, _ in order))
    types = tuple(keys.schema[c].dataType for c, _ in order)
    rows = keys.count()
    if ranges is None:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        ranges = max(
            math.ceil(rows / ROWS_PER_RANGE),
            min(width * _RANGES_PER_PARTITION, math.ceil(rows / _SMALL_RANGE_ROWS)),
        )
    ranges = max(1, ranges)
    if ranges == 1 or rows == 0:
        return KeyRanges(order, types, ())
    fraction = min(1.0, ranges * (SAMPLE_PER_RANGE if ranges <= MANY_RANGES else SAMPLE_PER_MANY) / rows)
    sample = keys if fraction == 1.0 else keys.sample(fraction=fraction, seed=17)
    ordered = sample.orderBy(*sort_columns(order)).select(*[_key_values(c, t) for (c, _), t in zip(order, types)])
    picked = [tuple(r) for r in ordered.collect()]
    borders = list(dict.fromkeys(picked[len(picked) * i // ranges] for i in range(1, ranges))) if picked else []
    # leading columns that tell the borders apart are enough: a value that fills more than a
    # range would have been picked twice
    width = next((p for p in range(1, len(order)) if len({b[:p] for b in borders}) == len(borders)), len(order))
    return KeyRanges(order[:width], types[:width], tuple(b[:width] for b in borders))


def _edge_rows(
    df: DataFrame, ranges: KeyRanges, order: Order, value: Column, last: bool, where: Column | None = None
) -> DataFrame:
    """First (or last) row of every range: at most one row per range and map task is shuffled."""
    if where is not None:
        df = df.where(where)
    sorts = sort_columns(order, backward=last)
    w = Window.partitionBy(_BUCKET).orderBy(*sorts)
    return (
        ranges.assign(df)
        .select(_BUCKET, *dict.fromkeys(c for c, _ in order), value.alias("__edge"))
        .withColumn("__n", F.row_number().over(w))
        .where(F.col("__n") == 1)
        .select(_BUCKET, "__edge")
    )


def _all_ranges(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    return df.sparkSession.range(0, len(ranges), 1, 1).select(F.col("id").cast("int").alias(_BUCKET))


def _carried_edges(df: DataFrame, edges: DataFrame, ranges: KeyRanges, backward: bool) -> DataFrame:
    """For every range the nearest edge from the ranges before (or after) it.

    The window has no partitioning, its input has one row per range.
    """
    steps = _all_ranges(df, ranges).join(_per_range(edges, ranges), _BUCKET, "left")
    side = F.col(_BUCKET).desc() if backward else F.col(_BUCKET).asc()
    w = Window.orderBy(side).rowsBetween(Window.unboundedPreceding, -1)
    return steps.select(_BUCKET, F.last("__edge", ignorenulls=True).over(w).alias("__edge"))


def _same_group(by: Sequence[str], carried: Column) -> Column:
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(carried[f"by_{c}"])
    return same


def with_neighbour(
    df: DataFrame,
    order: Order,
    take: dict[str, Column],
    by: Sequence[str] = (),
    backward: bool = False,
    ranges: int | KeyRanges | None = None,
) -> DataFrame:
    """Columns of the next (or previous) row in ``order``; null beyond the group's end.

    ``order`` starts with the ``by`` columns and ends with a unique column.
    """
    cut = ranges if isinstance(ranges, KeyRanges) else sample_ranges(df, order, ranges)
    packed = F.struct(*[F.col(c).alias(f"by_{c}") for c in by], *[e.alias(f"v_{n}") for n, e in take.items()])
    placed = cut.assign(df)
    w = Window.partitionBy(_BUCKET).orderBy(*sort_columns(order, backward))
    out = placed.withColumn("__near", F.lead(packed).over(w))
    if len(cut) > 1:
        edges = _edge_rows(df, cut, order, packed, last=backward)
        carried = _carried_edges(df, edges, cut, backward=not backward)
        out = out.join(_per_range(carried, cut), _BUCKET, "left")
        near = F.coalesce("__near", "__edge")
    else:
        near = F.col("__near")
    out = out.withColumn("__near", near)
    same = _same_group(by, F.col("__near"))
    return out.select(
        *df.columns, *[F.when(same, F.col("__near")[f"v_{n}"]).alias(n) for n in take]
    )


def with_carried(
    df: DataFrame,
    order: Order,
    present: Column,
    take: dict[str, Column],
    by: Sequence[str] = (),
    backward: bool = False,
    ranges: int | KeyRanges | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Columns of the nearest earlier (or later) row for which ``present`` holds.

    Walking backward sorts in reverse, so the frame always ends at the current row; frames
    that end at the partition's end would be evaluated again for every row.
    """
    cut = ranges if isinstance(ranges, KeyRanges) else sample_ranges(df, order, ranges)
    packed = F.struct(*[F.col(c).alias(f"by_{c}") for c in by], *[e.alias(f"v_{n}") for n, e in take.items()])
    placed = cut.assign(df).withColumn("__seen", F.when(present, packed))
    end = Window.currentRow if inclusive else -1
    w = (
        Window.partitionBy(_BUCKET)
        .orderBy(*sort_columns(order, backward))
        .rowsBetween(Window.unboundedPreceding, end)
    )
    out = placed.withColumn("__near", F.last("__seen", ignorenulls=True).over(w))
    if len(cut) > 1:
        edges = _edge_rows(df, cut, order, packed, last=not backward, where=present)
        carried = _carried_edges(df, edges, cut, backward)
        out = out.join(_per_range(carried, cut), _BUCKET, "left")
        out = out.withColumn("__near", F.coalesce("__near", "__edge"))
    same = _same_group(by, F.col("__near"))
    return out.select(
        *df.columns, *[F.when(same, F.col("__near")[f"v_{n}"]).alias(n) for n in take]
    )


def with_running(
    df: DataFrame, order: Order, value: str, name: str, largest: bool = False, backward: bool = False, ranges: int | KeyRanges | None = None,
) -> DataFrame:
    """Smallest (or ``largest``) ``value`` among the rows up to each one in ``order``, or from it on when walking ``backward``.

    Nulls in ``value`` are passed over.  What crosses a range border is one value per range.
    """
    cut = ranges if isinstance(ranges, KeyRanges) else sample_ranges(df, order, ranges)
    pick, either = (F.max, F.greatest) if largest else (F.min, F.least)
    placed = cut.assign(df)
    w = Window.partitionBy(_BUCKET).orderBy(*sort_columns(order, backward)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.withColumn("__near", pick(value).over(w))
    if len(cut) > 1:
        best = placed.where(F.col(value).isNotNull()).groupBy(_BUCKET).agg(pick(value).alias("__best"))
        steps = _all_ranges(df, cut).join(_per_range(best, cut), _BUCKET, "left")
        side = F.col(_BUCKET).desc() if backward else F.col(_BUCKET).asc()
        ahead = Window.orderBy(side).rowsBetween(Window.unboundedPreceding, -1)
        carried = steps.select(_BUCKET, pick("__best").over(ahead).alias("__edge"))
        out = out.join(_per_range(carried, cut), _BUCKET, "left").withColumn("__near", either("__near", "__edge"))
    return out.select(*df.columns, F.col("__near").alias(name))


def row_numbers(
    df: DataFrame,
    order: Order,
    name: str,
    by: Sequence[str] = (),
    start: int = 1,
    ranges: int | KeyRanges | None = None,
) -> DataFrame:
    """Dense numbers in ``order``, restarting per group when ``by`` is given.

    ``order`` starts with the ``by`` columns.  A group that spans ranges is named by the
    border between them, so its offset needs only a count of border groups: one row per range.
    """
    cut = ranges if isinstance(ranges, KeyRanges) else sample_ranges(df, order, ranges)
    placed = cut.assign(df)
    w = Window.partitionBy(_BUCKET, *by).orderBy(*sort_columns(order))
    local = placed.withColumn("__local", F.row_number().over(w).cast("long"))
    # borders that do not reach past the group columns never cut a group
    if len(cut) == 1 or (by and len(cut.order) <= len(by)):
        return local.select(*df.columns, (F.col("__local") + F.lit(start - 1)).alias(name))
    if not by:
        counts = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__count"))
        running = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(_BUCKET, F.coalesce(F.sum("__count").over(running), F.lit(0)).alias("__base"))
        out = local.join(_per_range(offsets, cut), _BUCKET, "left")
    else:
        pairs = [f"__b_{c}" for c in by]
        open_rows = _border_groups(df, cut, by)
        tail = (
            placed.select(_BUCKET, *by)
            .join(_per_range(open_rows, cut), _BUCKET)
            .where(_matches(by, pairs))
            .groupBy(_BUCKET)
            .agg(F.count(F.lit(1)).alias("__count"))
        )
        running = Window.partitionBy(*pairs).orderBy(_BUCKET)
        offsets = open_rows.join(_per_range(tail, cut), _BUCKET, "left").select(
            (F.col(_BUCKET) + 1).alias(_BUCKET),
            *pairs,
            F.sum(F.coalesce("__count", F.lit(0))).over(running).alias("__base"),
        )
        out = local.join(_per_range(offsets, cut), _BUCKET, "left").withColumn(
            "__base", F.when(_matches(by, pairs), F.col("__base"))
        )
    return out.select(
        *df.columns,
        (F.col("__local") + F.coalesce("__base", F.lit(0)) + F.lit(start - 1)).alias(name),
    )


def rows_at(df: DataFrame, order: Order, wanted: DataFrame, name: str, ranges: int | KeyRanges | None = None) -> DataFrame:
    """The rows whose number in ``order``, from 1, is one of the few in ``wanted``'s column ``name``.

    Ranges are counted, and only those that hold a wanted number are shuffled and sorted.
    """
    cut = ranges if isinstance(ranges, KeyRanges) else sample_ranges(df, order, ranges)
    placed = cut.assign(df)
    numbers = wanted.select(name).distinct()
    counts = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__count"))
    ahead = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.coalesce(F.sum("__count").over(ahead), F.lit(0)).alias("__base"), _BUCKET)
    # a row per range and per wanted number: the range that begins at or before a number holds it
    marks = bases.select("__base", F.struct(_BUCKET, "__base").alias("__of")).unionByName(
        numbers.select((F.col(name) - 1).alias("__base"), F.lit(None).alias("__of"))
    )
    near = Window.orderBy("__base", F.col("__of").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = marks.select(F.col("__of").isNull().alias("__asked"), F.last("__of", ignorenulls=True).over(near).alias("__of"))
    held = found.where("__asked AND __of IS NOT NULL").select("__of.*").distinct()
    local = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*sort_columns(order)))
    numbered = placed.join(F.broadcast(held), _BUCKET).withColumn(name, local + F.col("__base"))
    return numbered.join(F.broadcast(numbers), name, "left_semi").select(*df.columns, name)


def _border_groups(df: DataFrame, cut: KeyRanges, by: Sequence[str]) -> DataFrame:
    """The group named by each range's upper border; the rows come from the literal borders."""
    rows = [(i, *border[: len(by)]) for i, border in enumerate(cut.borders)]
    return _border_frame(df, f"{_BUCKET} int", rows, [f"__b_{c}" for c in by], cut.types)


def _matches(by: Sequence[str], pairs: Sequence[str]) -> Column:
    same = F.lit(True)
    for c, p in zip(by, pairs):
        same = same & F.col(c).eqNullSafe(F.col(p))
    return same
