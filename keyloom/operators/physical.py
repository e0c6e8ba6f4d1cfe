"""Retrieval in record-number order, positions, and places as hundredths of a percent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from keyloom.functions.codec import extract_ranges
from keyloom.functions.predicates import Term, key_order, where_terms
from keyloom.layout import KeySpec
from keyloom.operators.joins import direct_join, nearest_join
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import row_numbers, rows_at

# Rows that one filtered step of the record manager returns by default and at most; a caller may ask for them.
STEP_DEFAULT = 256
STEP_MAX = 1024

WHOLE = 10_000  # hundredths of a percent


def step_first(df: DataFrame, recnum: str = "recnum") -> DataFrame:
    return df.orderBy(F.col(recnum).asc()).limit(1)


def step_last(df: DataFrame, recnum: str = "recnum") -> DataFrame:
    return df.orderBy(F.col(recnum).desc()).limit(1)


def step_next(df: DataFrame, after: int | None, n: int | None = 1, recnum: str = "recnum") -> DataFrame:
    """The next ``n`` records behind a record number; all of them for None."""
    kept = (df if after is None else df.where(F.col(recnum) > after)).orderBy(F.col(recnum).asc())
    return kept if n is None else kept.limit(n)


def step_previous(df: DataFrame, before: int | None, n: int | None = 1, recnum: str = "recnum") -> DataFrame:
    kept = (df if before is None else df.where(F.col(recnum) < before)).orderBy(F.col(recnum).desc())
    return kept if n is None else kept.limit(n)


def _step_page(step, df, place, max_records, terms, extract, recnum, rec) -> DataFrame:
    page = step(df.where(where_terms(terms)), place, max_records if max_records > 0 else None, recnum)
    if extract is None:
        return page
    return page.select(recnum, extract_ranges(rec, extract).alias("data"))


def step_page_next(
    df: DataFrame, after: int | None, max_records: int = 0, terms: Sequence[Term | tuple] = (),
    extract: Sequence[tuple[int, int]] | None = None, recnum: str = "recnum", rec: str = "rec",
) -> DataFrame:
    """A batch of records behind ``after`` that satisfy ``terms``; ``extract`` projects byte ranges."""
    return _step_page(step_next, df, after, max_records, terms, extract, recnum, rec)


def step_page_previous(
    df: DataFrame, before: int | None, max_records: int = 0, terms: Sequence[Term | tuple] = (),
    extract: Sequence[tuple[int, int]] | None = None, recnum: str = "recnum", rec: str = "rec",
) -> DataFrame:
    return _step_page(step_previous, df, before, max_records, terms, extract, recnum, rec)


def assign_recnum(
    df: DataFrame, order: KeySpec | str | Sequence[str] | None = None, start: int = 1,
    name: str = "recnum", ranges: int | None = None,
) -> DataFrame:
    """Dense record numbers from ``start``, in ``order``, which should end in a unique column.

    Without an order the rows are numbered as they arrive.  Arrival order is not repeatable,
    so it is written to the checkpoint folder before it is ranked.
    """
    if order is not None:
        return row_numbers(df, key_order(order), name, start=start, ranges=ranges)
    arrived = cut(df.withColumn("__arrival", F.monotonically_increasing_id()))
    return row_numbers(arrived, [("__arrival", False)], name, start=start, ranges=ranges).drop("__arrival")


def get_position(df: DataFrame, where: Column | None = None, recnum: str = "recnum", low32: str | None = None) -> DataFrame:
    """Position tokens of the selected records: the record number in full.

    ``low32`` names an extra column with its low 32 bits, the form of four-byte callers; it is no
    position, as record numbers that differ above bit 31 share it.
    """
    kept = df if where is None else df.where(where)
    number = F.col(recnum).cast("long")
    short = [number.bitwiseAND(F.expr("4294967295L")).alias(low32)] if low32 else []
    return kept.select(recnum, number.alias("position"), *short)


def get_direct(positions: DataFrame, df: DataFrame, position: str = "position", recnum: str = "recnum") -> DataFrame:
    """Records at positions; ``status`` 9 where there is none."""
    return direct_join(positions, df, position, recnum)


def _ranked(df: DataFrame, order, recnum: str, ranges: int | None) -> DataFrame:
    key = order if order is not None else [recnum]
    return row_numbers(df, key_order(key, recnum), "__rank", ranges=ranges)


def _total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def get_by_percent(
    df: DataFrame, percents: DataFrame, percent: str = "pct", order: KeySpec | str | Sequence[str] | None = None,
    recnum: str = "recnum", ranges: int | None = None,
) -> DataFrame:
    """Record at 0-based rank ``clamp(floor(pct * N / 10000), 0, N - 1)`` for every percentage; none for a null one.

    Record numbers are unique.  Only the columns of the order are ranked, in the ranges that hold a
    wanted rank; the records found are then picked out of the table by their numbers.
    """
    # least and greatest pass over nulls
    place = F.when(F.col(percent).isNotNull(), F.greatest(F.lit(0), F.least(F.lit(WHOLE), F.col(percent).cast("long"))))
    asked = percents.withColumn("__place", place)
    # percentages are clamped to 0..10000, so the wanted ranks and their records are at most 10001 rows
    places = asked.select("__place").where("__place IS NOT NULL").distinct().withColumn("__n", _total(df))
    rank = F.expr(f"LEAST((__place * __n) DIV {WHOLE}, __n - 1) + 1")
    wanted = places.where("__n > 0").select("__place", rank.alias("__rank"))
    by = key_order(order if order is not None else [recnum], recnum)
    keys = df.select(*dict.fromkeys([*[c for c, _ in by], recnum]))
    hits = rows_at(keys, by, wanted, "__rank", ranges).join(F.broadcast(wanted), "__rank")
    if set(df.columns) != set(keys.columns):
        hits = df.join(F.broadcast(hits.select(F.col(recnum).alias("__at"), "__place")), F.col(recnum) == F.col("__at"))
    return asked.join(F.broadcast(hits), "__place").select(*percents.columns, *df.columns)


def find_percent(
    df: DataFrame, subset: DataFrame | None = None, order: KeySpec | str | Sequence[str] | None = None,
    recnum: str = "recnum", name: str = "pct", ranges: int | None = None,
) -> DataFrame:
    """Place of every record as ``floor(rank * 10000 / N)``.

    ``subset`` asks for some record numbers only, in the table or not, one row per distinct number:
    in record-number order a number's rank is the count of records up to it, 0 before the first.
    In the order of a key a number that is not in the table has no place, and its place is 0.
    Rows of a subset have the columns of ``df``, null but for the number where there is no record.
    """
    ranked = _ranked(df, order, recnum, ranges)
    place = F.expr(f"(__rank * {WHOLE}) DIV __n")
    if subset is None:
        return ranked.withColumn("__n", _total(df)).select(*df.columns, place.alias(name))
    asked = subset.select(F.col(recnum).alias("__asked")).where("__asked IS NOT NULL").distinct()
    whole = ranked.select(F.col(recnum).alias("__at"), F.struct(*[F.col(c).alias(c) for c in df.columns]).alias("__rec"), "__rank")
    if order is None:
        # the record at or before an asked number has its rank
        found = nearest_join(asked, whole, ["__at"], "<=", probe_key=["__asked"], recnum="__at").withColumn("__n", _total(df))
    else:
        found = asked.join(whole, F.col("__asked") == F.col("__at"), "left").withColumn("__n", _total(df))
    here = F.col("__at") == F.col("__asked")
    columns = [F.col("__asked").alias(c) if c == recnum else F.when(here, F.col("__rec")[c]).alias(c) for c in df.columns]
    return found.select(*columns, F.coalesce(place, F.lit(0).cast("long")).alias(name))
