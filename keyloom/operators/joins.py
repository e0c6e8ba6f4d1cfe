"""Lookups of many probe keys at once: exact, nearest, by record number, and schema drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from keyloom.functions.predicates import key_order, sort_columns
from keyloom.layout import KeySpec, as_key
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import KeyRanges, borders_of, row_numbers, with_carried, with_running

# Outcome codes of a lookup.
FOUND = 0
NO_SUCH_KEY = 4
NO_SUCH_RECORD = 9


def first_per_key(df: DataFrame, key: KeySpec | str | Sequence[str], recnum: str) -> DataFrame:
    """Oldest record of every key value.  Each map task keeps one row per key before the shuffle."""
    w = Window.partitionBy(*as_key(key).columns).orderBy(F.col(recnum).asc_nulls_first())
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def _record_columns(probes: DataFrame, df: DataFrame, same: dict[str, str], prefix: str) -> dict[str, str]:
    """Output names of the record columns.

    Without a prefix, a column is left out only where it equals the probe column of its name by
    the join itself (``same``: record column to probe column); any other clash is an error.
    """
    named = {c: prefix + c for c in df.columns if prefix or same.get(c) != c or c not in probes.columns}
    clash = sorted(set(named.values()) & set(probes.columns))
    if clash:
        raise ValueError(f"probes and records share the columns {clash}; give a prefix")
    return named


def lookup_join(
    probes: DataFrame,
    df: DataFrame,
    key: KeySpec | str | Sequence[str],
    how: str = "left",
    probe_key: Sequence[str] | None = None,
    recnum: str = "recnum",
    unique: bool = False,
    prefix: str = "",
    hit: str | None = None,
) -> DataFrame:
    """One match per probe: the oldest record with the probe's key.

    ``df`` is cut to one row per key before the join (skipped for a unique key), so a hot
    key repeats only on the probe side, where adaptive execution splits it.  Record columns
    come as ``prefix + name``; a key column that has its probe column's name is not repeated.
    ``hit`` names a flag of the probes that found one.
    """
    key = as_key(key)
    probe_cols = list(probe_key or key.columns)
    if how in ("left_semi", "left_anti"):
        records = df.select(*key.columns)
    else:
        records = df if unique else first_per_key(df, key, recnum)
    hidden = [f"__k{i}" for i in range(len(key.columns))]
    whole = [] if how in ("left_semi", "left_anti") else [F.struct(*[F.col(c) for c in df.columns]).alias("__rec")]
    records = records.select(*[F.col(c).alias(h) for c, h in zip(key.columns, hidden)], *whole)
    on = [F.col(p).eqNullSafe(F.col(h)) for p, h in zip(probe_cols, hidden)]
    joined = probes.join(records, on, how)
    if not whole:
        return joined
    named = _record_columns(probes, df, dict(zip(key.columns, probe_cols)), prefix)
    flag = [F.col("__rec").isNotNull().alias(hit)] if hit else []
    return joined.select(*probes.columns, *[F.col("__rec")[c].alias(n) for c, n in named.items()], *flag)


def direct_join(
    positions: DataFrame, df: DataFrame, position: str = "position", recnum: str = "recnum", prefix: str = ""
) -> DataFrame:
    """The record at every position, with ``status`` 0, or 9 where there is none.

    Positions may carry the record number that ``get_position`` returns beside them.
    """
    records = df.select(F.col(recnum).alias("__at"), F.struct(*[F.col(c) for c in df.columns]).alias("__rec"))
    joined = positions.join(records, F.col(position) == F.col("__at"), "left")
    status = F.when(F.col("__rec").isNotNull(), F.lit(FOUND)).otherwise(F.lit(NO_SUCH_RECORD))
    named = _record_columns(positions, df, {recnum: recnum}, prefix)
    return joined.select(*positions.columns, *[F.col("__rec")[c].alias(n) for c, n in named.items()], status.alias("status"))


def nearest_join(
    probes: DataFrame,
    df: DataFrame,
    key: KeySpec | str | Sequence[str],
    op: str,
    by: Sequence[str] = (),
    probe_key: Sequence[str] | None = None,
    probe_by: Sequence[str] | None = None,
    recnum: str = "recnum",
    take: Sequence[str] | None = None,
    prefix: str = "",
    ranges: int | None = None,
    few_probes: bool = False,
) -> DataFrame:
    """For every probe the nearest record with key ``>``, ``>=``, ``<`` or ``<=`` in key order.

    Probes and records are laid on one order and the nearest record is carried to each
    probe.  ``>``/``>=`` find the oldest of equal keys, ``<``/``<=`` the newest.  The order is
    cut into ranges on the full sort key, so neither a hot group nor a hot key value ends
    up in one task.  ``take`` columns are returned as ``prefix + name``; ``status`` is 0 or 9.
    ``few_probes`` says that the probe keys fit the driver: they become the borders, and records
    are cut to one per gap in the map tasks.  The rows are the same either way.
    """
    if op not in (">", ">=", "<", "<="):
        raise ValueError(f"unknown nearest comparison {op!r}")
    key = as_key(key)
    take = list(take or df.columns)
    clash = sorted({prefix + c for c in take} & set(probes.columns))
    if clash:
        raise ValueError(f"probes and records share the columns {clash}; give a prefix")
    probe_cols = list(probe_by or by) + list(probe_key or key.columns)
    record_cols = list(by) + key.columns
    desc = [False] * len(by) + [s.descending for s in key.segments]
    hidden = [f"__k{i}" for i in range(len(record_cols))]
    backward = op.startswith(">")
    probe_first = op in (">=", "<")

    records = df.select(
        *[F.col(c).alias(h) for c, h in zip(record_cols, hidden)],
        F.lit(1 if probe_first else 0).alias("__side"),
        F.col(recnum).cast("long").alias("__tie"),
        F.struct(*[F.col(c).alias(c) for c in take]).alias("__rec"),
    )
    if few_probes:
        keys = probes.select(*[F.col(c).alias(h) for c, h in zip(probe_cols, hidden)])
        records = _nearest_to_borders(records, borders_of(keys.distinct(), list(zip(hidden, desc))), op)
    # the tie spreads equal probes over ranges; it is stable for a recomputed input partition
    tie = F.xxhash64(*probe_cols, *probes.columns, F.spark_partition_id())
    asked = probes.select(
        *[F.col(c).alias(h) for c, h in zip(probe_cols, hidden)],
        F.lit(0 if probe_first else 1).alias("__side"),
        tie.alias("__tie"),
        F.struct(*[F.col(c).alias(c) for c in probes.columns]).alias("__probe"),
    )
    together = records.unionByName(asked, allowMissingColumns=True)
    order = [*zip(hidden, desc), ("__side", False), ("__tie", False)]
    carried = with_carried(
        together, order, F.col("__rec").isNotNull(), {"__found": F.col("__rec")},
        by=hidden[: len(by)], backward=backward, ranges=ranges,
    )
    out = carried.where(F.col("__probe").isNotNull())
    status = F.when(F.col("__found").isNull(), F.lit(NO_SUCH_RECORD)).otherwise(F.lit(FOUND))
    return out.select(
        *[F.col("__probe")[c].alias(c) for c in probes.columns],
        *[F.col("__found")[c].alias(f"{prefix}{c}") for c in take],
        status.alias("status"),
    )


def partial_join(
    probes: DataFrame,
    df: DataFrame,
    key: KeySpec | str | Sequence[str],
    op: str,
    by: Sequence[str] = (),
    probe_key: Sequence[str] | None = None,
    probe_by: Sequence[str] | None = None,
    recnum: str = "recnum",
    take: Sequence[str] | None = None,
    prefix: str = "",
    ranges: int | None = None,
) -> DataFrame:
    """For every probe the first (``<``, ``<=``: last) record in key order, among those its asked segments allow.

    A null in a probe puts no constraint on its segment, as a ``None`` value of a single lookup
    does; ``=``, ``>``, ``>=``, ``<`` and ``<=`` compare the other segments.  A probe without any
    asked segment finds the end of its group.  Null segments of records come first, as in any key
    order.  ``take`` columns are returned as ``prefix + name``; ``status`` is 0, or 9 (4 for ``=``)
    where there is no such record.

    The records are numbered once in key order.  Probes are taken together by which segments they
    ask for (their number is bounded by the segments, not by the data): records and those probes
    lie on one order of the asked segments, and the smallest number from a probe's place on is
    carried to it.  Only key columns and numbers are sorted; the records found are fetched by
    number at the end.
    """
    if op not in ("=", ">", ">=", "<", "<="):
        raise ValueError(f"unknown key comparison {op!r}")
    key, by = as_key(key), list(by)
    take = list(take or df.columns)
    clash = sorted({prefix + c for c in take} & set(probes.columns))
    if clash:
        raise ValueError(f"probes and records share the columns {clash}; give a prefix")
    segments, backward = key.segments, op.startswith("<")
    groups = [f"__b{i}" for i in range(len(by))]
    hidden = [f"__k{i}" for i in range(len(segments))]
    asked = probes.select(
        F.struct(*[F.col(c).alias(c) for c in probes.columns]).alias("__probe"),
        *[F.col(c).alias(g) for c, g in zip(probe_by or by, groups)],
        *[F.col(c).alias(h) for c, h in zip(probe_key or key.columns, hidden)],
        F.xxhash64(*probes.columns, F.spark_partition_id()).alias("__tie"),
    )
    mask = F.lit(0)
    for i, h in enumerate(hidden):
        mask = mask + F.when(F.col(h).isNull(), F.lit(0)).otherwise(F.lit(1 << i))
    asked = cut(asked.withColumn("__mask", mask))
    whole = df.select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)], *[F.col(s.column).alias(h) for s, h in zip(segments, hidden)],
        F.col(recnum).alias("__rn"), F.struct(*[F.col(c).alias(c) for c in take]).alias("__rec"),
    )
    order = [(g, False) for g in groups] + [(h, s.descending) for s, h in zip(segments, hidden)] + [("__rn", False)]
    numbered = cut(row_numbers(whole, order, "__pos", ranges=ranges))
    places = numbered.select(*groups, *hidden, "__pos")

    found = []
    for bits in sorted(r[0] for r in asked.select("__mask").distinct().collect()):
        some = asked.where(F.col("__mask") == bits)
        kept = [(h, s.descending) for i, (s, h) in enumerate(zip(segments, hidden)) if bits >> i & 1]
        if op == "=" or not (kept or groups):
            found.append(_first_equal(some, places, [*groups, *[h for h, _ in kept]], backward))
            continue
        # in ascending order, equal records come behind a probe that takes them when it looks up, before one that looks down
        probe_first = (op in (">=", "<")) if kept else not backward
        columns = [*groups, *[h for h, _ in kept]]
        records = places.select(*columns, "__pos", F.lit(1 if probe_first else 0).alias("__side"), F.col("__pos").alias("__tie"))
        beside = some.select(*columns, F.lit(0 if probe_first else 1).alias("__side"), "__tie", "__probe", F.lit(True).alias("__asks"))
        together = records.unionByName(beside, allowMissingColumns=True)
        line = [(g, False) for g in groups] + kept + [("__side", False), ("__tie", False)]
        near = with_running(together, line, "__pos", "__near", largest=backward, backward=not backward, ranges=ranges)
        found.append(near.where("__asks").select("__probe", *groups, "__near"))
    if not found:
        found.append(asked.select("__probe", *groups, F.lit(None).cast("long").alias("__near")))
    near = found[0]
    for more in found[1:]:
        near = near.union(more)
    mine = [f"__of{i}" for i in range(len(groups))]
    records = numbered.select(F.col("__pos").alias("__near"), *[F.col(g).alias(m) for g, m in zip(groups, mine)], "__rec")
    joined = near.join(records, "__near", "left")
    # numbers go up from group to group, so a neighbour group's is met only where the own one has none
    hit = F.col("__rec").isNotNull()
    for g, m in zip(groups, mine):
        hit = hit & F.col(g).eqNullSafe(F.col(m))
    return joined.select(
        *[F.col("__probe")[c].alias(c) for c in probes.columns],
        *[F.when(hit, F.col("__rec")[c]).alias(f"{prefix}{c}") for c in take],
        F.when(hit, F.lit(FOUND)).otherwise(F.lit(NO_SUCH_KEY if op == "=" else NO_SUCH_RECORD)).alias("status"),
    )


def _first_equal(asked: DataFrame, places: DataFrame, columns: list[str], last: bool) -> DataFrame:
    """The first (or last) record's number per value of ``columns``, of all without any."""
    pick = F.max if last else F.min
    if not columns:
        number = places.agg(pick("__pos")).first()[0]
        return asked.select("__probe", F.lit(number).cast("long").alias("__near"))
    firsts = places.groupBy(*[F.col(c).alias(f"__q{c}") for c in columns]).agg(pick("__pos").alias("__near"))
    on = [asked[c].eqNullSafe(firsts[f"__q{c}"]) for c in columns]
    return asked.join(firsts, on, "left").select("__probe", *[c for c in columns if c.startswith("__b")], "__near")


def _nearest_to_borders(records: DataFrame, borders: KeyRanges, op: str) -> DataFrame:
    """Only the record next to each probe key matters: one per gap and map task is shuffled."""
    placed = borders.assign(records, "__gap", strict=op in (">", "<="))
    order = [*borders.order, ("__tie", False)]
    w = Window.partitionBy("__gap").orderBy(*sort_columns(order, backward=op.startswith("<")))
    return placed.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n", "__gap")


def drift_join(expected: DataFrame, actual: DataFrame, table: str = "table_name", column: str = "column_name") -> DataFrame:
    """Expected and actual columns side by side; names are compared without regard to case.

    Both inputs have ``table``, ``column`` and ``data_type``.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.upper(table).alias("__table"), F.upper(column).alias("__column"),
            F.col(table).alias(f"{name}_table"), F.col(column).alias(f"{name}_column"),
            F.col("data_type").alias(f"{name}_type"),
        )

    joined = side(expected, "expected").join(side(actual, "actual"), ["__table", "__column"], "full_outer")
    return joined.select(
        F.coalesce("expected_table", "actual_table").alias("table_name"),
        F.coalesce("expected_column", "actual_column").alias("column_name"),
        "expected_type", "actual_type",
        F.col("expected_column").isNotNull().alias("is_expected"),
        F.col("actual_column").isNotNull().alias("is_actual"),
    )
