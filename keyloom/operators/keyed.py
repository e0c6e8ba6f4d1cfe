"""Retrieval in key order: one key or cursor at a time, or a frame of probe keys at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from keyloom.functions.codec import extract_ranges
from keyloom.functions.predicates import (
    Cursor,
    Term,
    after_cursor,
    key_order,
    key_predicate,
    sort_columns,
    where_terms,
)
from keyloom.layout import KeySpec, as_key
from keyloom.operators.joins import FOUND, NO_SUCH_KEY, lookup_join, nearest_join, partial_join
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import row_numbers, with_neighbour

Key = KeySpec | str | Sequence[str]

# Fixed value: the most rows that one extended read of the record manager returns; a caller may ask for it.
MOST_ROWS = 65_535


def order_by_key(df: DataFrame, key: Key, recnum: str | None = "recnum", backward: bool = False) -> DataFrame:
    """All records in key order, ties by record number; backward is the exact reverse."""
    return df.orderBy(*sort_columns(key_order(key, recnum), backward))


def top_n(df: DataFrame, n: int, key: Key, where=None, recnum: str | None = "recnum", backward: bool = False) -> DataFrame:
    """The first ``n`` records in key order that satisfy ``where``."""
    kept = df if where is None else df.where(where)
    return order_by_key(kept, key, recnum, backward).limit(n)


def _keys(df: DataFrame, key: Key, recnum: str, keys_only: bool, extra: Sequence[str] = ()) -> DataFrame:
    """With ``keys_only`` the scan is cut down to the key columns and the record number."""
    if not keys_only:
        return df
    return df.select(*dict.fromkeys([*extra, *as_key(key).columns, recnum]))


def _one(df: DataFrame, key: Key, op: str, value: Sequence, recnum: str) -> DataFrame:
    backward = op.startswith("<")
    return top_n(df, 1, key, key_predicate(key, op, value), recnum, backward)


def get_equal(
    df: DataFrame, key: Key, value: Sequence | None = None, probes: DataFrame | None = None,
    probe_key: Sequence[str] | None = None, recnum: str = "recnum", keys_only: bool = False, unique: bool = False,
    prefix: str = "", partial: bool = False,
) -> DataFrame:
    """Oldest record with the key; for ``probes`` one row each, ``status`` 0 or 4.

    With ``partial`` a null in a probe puts no constraint on its segment, and the first record in
    key order is found; without, it is compared null-safe.
    """
    df = _keys(df, key, recnum, keys_only)
    if probes is None:
        return _one(df, key, "=", value, recnum)
    if partial:
        return partial_join(probes, df, key, "=", (), probe_key, None, recnum, None, prefix)
    found = lookup_join(probes, df, key, "left", probe_key, recnum, unique, prefix, hit="__found")
    return found.withColumn("status", F.when(F.col("__found"), F.lit(FOUND)).otherwise(F.lit(NO_SUCH_KEY))).drop("__found")


def _nearest(op: str, doc: str):
    def get(
        df: DataFrame, key: Key, value: Sequence | None = None, probes: DataFrame | None = None,
        by: Sequence[str] = (), probe_key: Sequence[str] | None = None, probe_by: Sequence[str] | None = None,
        recnum: str = "recnum", keys_only: bool = False, prefix: str = "", ranges: int | None = None, few_probes: bool = False, partial: bool = False,
    ) -> DataFrame:
        df = _keys(df, key, recnum, keys_only, by)
        if probes is None:
            return _one(df, key, op, value, recnum)
        if partial:
            return partial_join(probes, df, key, op, by, probe_key, probe_by, recnum, None, prefix, ranges)
        return nearest_join(probes, df, key, op, by, probe_key, probe_by, recnum, None, prefix, ranges, few_probes)

    get.__doc__ = doc + """

    With ``partial`` a null in a probe puts no constraint on its segment (``joins.partial_join``)."""
    return get


get_greater = _nearest(">", "First record after the key; the oldest of equal keys.")
get_greater_or_equal = _nearest(">=", "First record at or after the key; the oldest of equal keys.")
get_less = _nearest("<", "Last record before the key; the newest of equal keys.")
get_less_or_equal = _nearest("<=", "Last record at or before the key; the newest of equal keys.")


def _end(df: DataFrame, key: Key, by: Sequence[str], recnum: str, keys_only: bool, backward: bool) -> DataFrame:
    df = _keys(df, key, recnum, keys_only, by)
    if not by:
        return order_by_key(df, key, recnum, backward).limit(1)
    # the filter on the row number keeps one row per group and map task before the shuffle
    w = Window.partitionBy(*by).orderBy(*sort_columns(key_order(key, recnum), backward))
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def get_first(df: DataFrame, key: Key, by: Sequence[str] = (), recnum: str = "recnum", keys_only: bool = False) -> DataFrame:
    """First record of the key order, or of every group."""
    return _end(df, key, by, recnum, keys_only, False)


def get_last(df: DataFrame, key: Key, by: Sequence[str] = (), recnum: str = "recnum", keys_only: bool = False) -> DataFrame:
    """Last record of the key order, or of every group."""
    return _end(df, key, by, recnum, keys_only, True)


def _step(df, key, by, take, prefix, recnum, keys_only, backward, ranges) -> DataFrame:
    df = _keys(df, key, recnum, keys_only, by)
    take = list(take or [*as_key(key).columns, recnum])
    order = key_order(key, recnum, by)
    return with_neighbour(df, order, {f"{prefix}{c}": F.col(c) for c in take}, by, backward, ranges)


def with_next(
    df: DataFrame, key: Key, by: Sequence[str] = (), take: Sequence[str] | None = None, prefix: str = "next_",
    recnum: str = "recnum", keys_only: bool = False, ranges: int | None = None,
) -> DataFrame:
    """Every record with the key and record number (or ``take``) of its successor."""
    return _step(df, key, by, take, prefix, recnum, keys_only, False, ranges)


def with_previous(
    df: DataFrame, key: Key, by: Sequence[str] = (), take: Sequence[str] | None = None, prefix: str = "previous_",
    recnum: str = "recnum", keys_only: bool = False, ranges: int | None = None,
) -> DataFrame:
    """Every record with the key and record number (or ``take``) of its predecessor."""
    return _step(df, key, by, take, prefix, recnum, keys_only, True, ranges)


def next_after(df: DataFrame, key: Key, cursor: Cursor, recnum: str = "recnum", keys_only: bool = False) -> DataFrame:
    """The one record after a cursor."""
    df = _keys(df, key, recnum, keys_only)
    return top_n(df, 1, key, after_cursor(key, cursor, recnum), recnum)


def previous_before(df: DataFrame, key: Key, cursor: Cursor, recnum: str = "recnum", keys_only: bool = False) -> DataFrame:
    """The one record before a cursor."""
    df = _keys(df, key, recnum, keys_only)
    return top_n(df, 1, key, after_cursor(key, cursor, recnum, backward=True), recnum, backward=True)


def page_rows(max_records: int, byte_budget: int | None = None, record_bytes: int | None = None) -> int | None:
    """Rows of one page: the asked number, less when the answer (2 + 6 per row + data) must fit a budget.

    None stands for all rows: no number is asked and there is no budget.
    """
    n = max_records if max_records > 0 else None
    if byte_budget is not None:
        fitting = max(0, (byte_budget - 2) // (6 + record_bytes))
        n = fitting if n is None else min(n, fitting)
    return n


def _page(
    df, key, cursor, max_records, terms, extract, recnum, byte_budget, record_bytes, rec, backward
) -> DataFrame:
    if extract and record_bytes is None:
        record_bytes = sum(n for n, _ in extract)
    n = page_rows(max_records, byte_budget, record_bytes)
    wanted = where_terms(terms)
    if cursor is not None:
        wanted = after_cursor(key, cursor, recnum, backward) & wanted
    page = order_by_key(df.where(wanted), key, recnum, backward)
    if n is not None:
        page = page.limit(n)
    if extract is None:
        return page
    return page.select(*as_key(key).columns, recnum, extract_ranges(rec, extract).alias("data"))


def page_next(
    df: DataFrame, key: Key, cursor: Cursor | None, max_records: int = 0, terms: Sequence[Term | tuple] = (),
    extract: Sequence[tuple[int, int]] | None = None, recnum: str = "recnum", byte_budget: int | None = None,
    record_bytes: int | None = None, rec: str = "rec",
) -> DataFrame:
    """The records after a cursor that satisfy ``terms``, in key order; ``extract`` projects byte ranges."""
    return _page(df, key, cursor, max_records, terms, extract, recnum, byte_budget, record_bytes, rec, False)


def page_previous(
    df: DataFrame, key: Key, cursor: Cursor | None, max_records: int = 0, terms: Sequence[Term | tuple] = (),
    extract: Sequence[tuple[int, int]] | None = None, recnum: str = "recnum", byte_budget: int | None = None,
    record_bytes: int | None = None, rec: str = "rec",
) -> DataFrame:
    """The records before a cursor, nearest first."""
    return _page(df, key, cursor, max_records, terms, extract, recnum, byte_budget, record_bytes, rec, True)


def pages(
    df: DataFrame, key: Key, cursors: DataFrame, max_records: int, terms: Sequence[Term | tuple] = (),
    cursor_key: Sequence[str] | None = None, cursor_recnum: str | None = None, recnum: str = "recnum", by: Sequence[str] = (),
    cursor_by: Sequence[str] | None = None, backward: bool = False, take: Sequence[str] | None = None, prefix: str = "", place: str = "place",
    ranges: int | None = None,
) -> DataFrame:
    """One page per row of ``cursors``: the ``max_records`` records behind it (``backward``: before it) that satisfy ``terms``.

    A cursor is a place in (key, record number) order: its ``cursor_key`` and ``cursor_recnum``
    columns, null-safe like every place.  With ``by`` a page stays within the cursor's group, which
    ``cursor_by`` names.  The columns of the cursor come back with the ``take`` columns of a
    record as ``prefix + name`` and with its ``place`` in the page, from 1 on, nearest first.
    A cursor without a record behind it has no row.

    The records that satisfy the terms are numbered once; every cursor finds the number of its first
    record on the same order, and the numbers of its page meet the records in one join.  So there is
    no job per cursor, and the rows that are moved are the pages.
    """
    if max_records < 1:
        raise ValueError("pages of a frame of cursors need a number of records")
    key, by = as_key(key), list(by)
    take = list(take or df.columns)
    clash = sorted(({prefix + c for c in take} | {place}) & set(cursors.columns))
    if clash:
        raise ValueError(f"cursors and records share the columns {clash}; give a prefix")
    order = key_order(key, recnum, by)
    kept = df.where(where_terms(terms)).select(
        *[F.col(c).alias(f"__o{i}") for i, (c, _) in enumerate(order)], F.struct(*[F.col(c).alias(c) for c in take]).alias("__rec")
    )
    hidden = [(f"__o{i}", d) for i, (_, d) in enumerate(order)]
    numbered = cut(row_numbers(kept, hidden, "__pos", ranges=ranges))
    groups, inner = [h for h, _ in hidden[: len(by)]], hidden[len(by) :]
    places = numbered.select(*[h for h, _ in hidden], "__pos")

    own = [*(cursor_by or by), *(cursor_key or key.columns)]
    own += [cursor_recnum or recnum] if len(order) > len(own) else []
    asked = cursors.select(F.struct(*[F.col(c).alias(c) for c in cursors.columns]).alias("__cursor"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(own)])
    spec = KeySpec.of(*["-" + h if d else h for h, d in inner])
    near = nearest_join(
        asked, places, spec, "<" if backward else ">", groups, [f"__c{i}" for i in range(len(by), len(own))], [f"__c{i}" for i in range(len(by))],
        "__pos", ["__pos"], "__near", ranges,
    ).where(f"status = {FOUND}")
    step = -1 if backward else 1
    wanted = near.select("__cursor", *[f"__c{i}" for i in range(len(by))], F.posexplode(F.expr(f"sequence(__near__pos, __near__pos + {step * (max_records - 1)}L, {step}L)")).alias("__at", "__pos"))
    joined = wanted.join(numbered.select("__pos", *groups, "__rec"), "__pos")
    for i, g in enumerate(groups):
        joined = joined.where(F.col(f"__c{i}").eqNullSafe(F.col(g)))
    return joined.select(
        *[F.col("__cursor")[c].alias(c) for c in cursors.columns], *[F.col("__rec")[c].alias(f"{prefix}{c}") for c in take], (F.col("__at") + 1).alias(place)
    )


def page_cursor(page: DataFrame, key: Key, recnum: str = "recnum", backward: bool = False) -> Cursor | None:
    """Where the next page starts: the place of the page's last record."""
    key = as_key(key)
    last = order_by_key(page.select(*key.columns, F.col(recnum)), key, recnum, not backward).limit(1).collect()
    return Cursor(tuple(last[0][c] for c in key.columns), last[0][recnum]) if last else None


def key_exists(
    probes: DataFrame, df: DataFrame, key: Key, probe_key: Sequence[str] | None = None, how: str = "flag"
) -> DataFrame:
    """Probes with (``semi``) or without (``anti``) a record of their key, or all with an ``exists`` flag."""
    if how in ("semi", "anti"):
        return lookup_join(probes, df, key, f"left_{how}", probe_key)
    key = as_key(key)
    hidden = [f"__k{i}" for i in range(len(key.columns))]
    known = df.select(*[F.col(c).alias(h) for c, h in zip(key.columns, hidden)]).distinct().withColumn("__hit", F.lit(True))
    on = [F.col(p).eqNullSafe(known[h]) for p, h in zip(probe_key or key.columns, hidden)]
    return probes.join(known, on, "left").select(*probes.columns, F.coalesce("__hit", F.lit(False)).alias("exists"))


def rank_in_order(
    df: DataFrame, key: Key, by: Sequence[str] = (), recnum: str = "recnum", name: str = "rank", ranges: int | None = None
) -> DataFrame:
    """1-based row number in key order, per group when ``by`` is given."""
    return row_numbers(df, key_order(key, recnum, by), name, by, ranges=ranges)


def preview(df: DataFrame, where: str | None = None, limit: int = 50, offset: int = 0, recnum: str = "recnum") -> DataFrame:
    """One page of ``limit`` rows for display; ``truncated`` marks a full page.

    Page and offset go through one task: for a place far into a table use ``page_next`` and its cursor.
    """
    limit = max(1, limit)
    kept = df.where(where) if where and where.strip() else df
    page = kept.orderBy(F.col(recnum).asc_nulls_first()).offset(offset).limit(limit)
    # the page itself is the window's whole input
    size = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    return page.withColumn("truncated", size == limit)
