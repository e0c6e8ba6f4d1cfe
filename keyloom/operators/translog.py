"""Replaying a log of transactions onto a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from keyloom.operators.changes import DUPLICATE_KEY, INVALID_POSITION, OK, _flag, matching_rows
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import KeyRanges, sample_ranges, with_carried, with_neighbour

# Operation numbers in a log, and marker outcome codes.
INSERT = 2
UPDATE = 3
DELETE = 4
BEGIN = 19
END = 20
ABORT = 21
BEGIN_CONCURRENT = 1019
ALREADY_OPEN = 37
NOT_OPEN = 39

_BEGINS = f"op IN ({BEGIN}, {BEGIN_CONCURRENT})"
_MARKERS = f"op IN ({BEGIN}, {BEGIN_CONCURRENT}, {END}, {ABORT})"
_CHANGES = f"op IN ({INSERT}, {UPDATE}, {DELETE})"


_ORDER = [("session", False), ("seq", False)]


def judge_markers(log: DataFrame, ranges: KeyRanges) -> DataFrame:
    """Begin, end and abort markers with ``status`` and, for accepted begins, ``outcome``.

    A transaction is open exactly when the marker before is a begin, accepted or not.
    """
    markers = log.where(_MARKERS).select("session", "seq", "op")
    before = with_neighbour(markers, _ORDER, {"before": F.col("op")}, ["session"], backward=True, ranges=ranges)
    is_open = F.coalesce(F.col("before").isin(BEGIN, BEGIN_CONCURRENT), F.lit(False))
    status = (
        F.when(F.expr(_BEGINS) & is_open, F.lit(ALREADY_OPEN))
        .when(~F.expr(_BEGINS) & ~is_open, F.lit(NOT_OPEN))
        .otherwise(F.lit(OK))
    )
    judged = cut(before.withColumn("status", status).drop("before"))
    # among accepted markers begins and ends alternate, so a begin's outcome is the next marker
    closed = with_neighbour(
        judged.where(F.col("status") == OK), _ORDER, {"closing": F.col("op")}, ["session"], ranges=ranges
    )
    outcome = F.when(
        F.expr(_BEGINS),
        F.when(F.col("closing") == END, F.lit("committed")).when(F.col("closing") == ABORT, F.lit("aborted")).otherwise(F.lit("open")),
    )
    accepted = closed.select("session", "seq", "op", "status", outcome.alias("outcome"))
    return accepted.unionByName(judged.where(F.col("status") != OK).withColumn("outcome", F.lit(None).cast("string")))


def resolve_changes(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes with their transaction's ``outcome`` (``plain`` outside any), and the judged markers."""
    # one set of ranges over the whole log serves its markers and its changes
    ranges = sample_ranges(log, _ORDER)
    markers = cut(judge_markers(log, ranges))
    together = log.where(_CHANGES).withColumn("__marker", F.lit(None).cast("string")).unionByName(
        markers.where(F.col("status") == OK).select("session", "seq", "op", F.coalesce("outcome", F.lit("plain")).alias("__marker")),
        allowMissingColumns=True,
    )
    carried = with_carried(
        together, _ORDER, F.col("__marker").isNotNull(), {"outcome": F.col("__marker")}, ["session"], ranges=ranges
    )
    changes = carried.where(_CHANGES).drop("__marker").withColumn("outcome", F.coalesce("outcome", F.lit("plain")))
    return changes, markers


def judge_changes(known: DataFrame, live: DataFrame, recnum: str = "recnum") -> DataFrame:
    """Changes with ``status``: an insert on an existing record 5, an update or delete of a missing one 8.

    Of ``known`` only the record numbers are read.
    """
    order = [(recnum, False), ("seq", False)]
    # an update leaves existence as it was, so only the last insert or delete decides
    seen = with_carried(
        live, order, F.col("op") != UPDATE, {"__last": F.col("op")}, [recnum], inclusive=False
    )
    seen = _flag(seen, matching_rows(known, live, [recnum]), [recnum], "__in_state")
    exists = F.when(F.col("__last").isNull(), F.col("__in_state")).otherwise(F.col("__last") == INSERT)
    status = (
        F.when((F.col("op") == INSERT) & exists, F.lit(DUPLICATE_KEY))
        .when((F.col("op") != INSERT) & ~exists, F.lit(INVALID_POSITION))
        .otherwise(F.lit(OK))
    )
    return seen.withColumn("status", status).drop("__last", "__in_state")


def last_changes(judged: DataFrame, recnum: str = "recnum") -> DataFrame:
    """The last accepted change of every record; each map task keeps one row per record."""
    w = Window.partitionBy(recnum).orderBy(F.col("seq").desc())
    accepted = judged.where(F.col("status") == OK)
    return accepted.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def overlay(state: DataFrame, last: DataFrame, recnum: str = "recnum") -> DataFrame:
    """The state with the last change of every record on top; records without one pass through."""
    kept = state.join(last.select(recnum), recnum, "left_anti").select(*state.columns)
    return kept.unionByName(last.where(F.col("op") != DELETE).select(*state.columns))


def replay(state: DataFrame, live: DataFrame, recnum: str = "recnum") -> tuple[DataFrame, DataFrame]:
    """Apply changes in ``seq`` order; returns the new state and the changes with their ``status``."""
    judged = cut(judge_changes(state, live, recnum))
    return overlay(state, last_changes(judged, recnum), recnum), judged


LIVE = "outcome IN ('plain', 'committed')"


def apply_log(state: DataFrame, log: DataFrame, recnum: str = "recnum") -> tuple[DataFrame, DataFrame]:
    """Replay ``(seq, session, op, <record number>, columns...)`` onto a state.

    Changes outside transactions and in committed ones count, in ``seq`` order; those of
    aborted and still open ones do not.  Returns the new state and one report row per log row.
    """
    changes, markers = resolve_changes(log)
    changes = cut(changes)
    new_state, judged = replay(state, changes.where(LIVE), recnum)
    report = (
        judged.select("seq", "session", "op", F.col("outcome"), "status")
        .unionByName(changes.where(f"NOT ({LIVE})").select(
            "seq", "session", "op", "outcome", F.lit(None).cast("int").alias("status")))
        .unionByName(markers.select("seq", "session", "op", "outcome", "status"))
    )
    return new_state, report
