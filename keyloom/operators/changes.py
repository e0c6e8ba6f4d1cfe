"""Inserts, updates, deletes and byte patches as change-sets over a table.

A state is a frame with a record-number column.  Every operator returns a new state; the
caller writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from keyloom.layout import KeySpec, as_key
from keyloom.plans.lineage import cut
from keyloom.plans.ordering import row_numbers

# Outcome codes.
OK = 0
DUPLICATE_KEY = 5
INVALID_POSITION = 8
TOO_SHORT = 28
CHUNK_PAST_END = 103

Keys = Sequence[KeySpec | Sequence[str]]


def matching_rows(state: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct key values of ``keys`` that occur in ``state``.

    The change-set's keys are the build side of a semi join, so a small change-set against
    a large state is broadcast by its measured size and the state is not shuffled.
    """
    asked = keys.select(*[F.col(c).alias(f"__q{i}") for i, c in enumerate(columns)]).distinct()
    on = [state[c].eqNullSafe(asked[f"__q{i}"]) for i, c in enumerate(columns)]
    return state.select(*columns).join(asked, on, "left_semi").distinct()


def _flag(rows: DataFrame, found: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    other = found.select(*[F.col(c).alias(f"__f{i}") for i, c in enumerate(columns)], F.lit(True).alias("__hit"))
    on = [rows[c].eqNullSafe(other[f"__f{i}"]) for i, c in enumerate(columns)]
    kept = rows.join(other, on, "left")
    return kept.select(*rows.columns, F.coalesce("__hit", F.lit(False)).alias(name))


def _blocked(rows: DataFrame, keys: list[KeySpec], seq: Sequence[str], by_accepted: str) -> DataFrame:
    """Flag rows whose key an earlier accepted row already has."""
    place = F.struct(*seq)
    out = rows.withColumn("__blocked", F.lit(False))
    for key in keys:
        cols = key.columns
        first = (
            rows.where(by_accepted).groupBy(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(cols)])
            .agg(F.min(place).alias("__first"))
        )
        on = [out[c].eqNullSafe(first[f"__g{i}"]) for i, c in enumerate(cols)]
        joined = out.join(first, on, "left")
        taken = F.coalesce(F.col("__first") < F.struct(*seq), F.lit(False))
        out = joined.select(*rows.columns, (F.col("__blocked") | taken).alias("__blocked"))
    return out


def _settle(rows: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Repeat ``judge`` until no verdict (``__ok``) changes.

    A rejected row must not block later rows, so a verdict depends on earlier verdicts.  A
    row's verdict is final once those of the rows before it are, so this always ends.
    """
    current = cut(rows)
    while True:
        after = cut(judge(current.withColumnRenamed("__ok", "__was")))
        if after.where("__ok <> __was").isEmpty():
            return after.drop("__was")
        current = after.drop("__was")


def _settle_conflicts(rows: DataFrame, specs: list[KeySpec], pos: str) -> DataFrame:
    """``__p, __ok``: the verdict on each of ``rows``, taken in ``pos`` order: refused if an earlier accepted row has one of its keys.

    Open rows are settled from the front.  A row that is the first open one of all its keys is
    accepted.  A row with exactly one open row before it, over all its keys, has the opposite
    verdict of that row: such rows are links of chains, and pointers along a chain are doubled, so
    a chain of n rows takes log n passes.  Rows that share a key with an accepted one are refused
    and leave with it.  Only rows that wait for several others need another round, and each round
    settles at least the first open row.

    Per key only the two first open rows are looked for, by partial minima, so a key of very many
    rows is no single task.
    """
    names = [f"__k{i}" for i in range(len(specs))]
    open_ = cut(rows.select(F.col(pos).alias("__p"), *[F.struct(*[F.col(c) for c in s.columns]).alias(k) for s, k in zip(specs, names)]))
    verdicts = open_.select("__p", F.lit(True).alias("__ok")).limit(0)
    while not open_.isEmpty():
        ranked = open_
        for i, k in enumerate(names):
            first = open_.groupBy(F.col(k).alias("__g")).agg(F.min("__p").alias(f"__a{i}"))
            ranked = ranked.join(first, ranked[k].eqNullSafe(first["__g"])).drop("__g")
            second = ranked.where(F.col("__p") > F.col(f"__a{i}")).groupBy(F.col(k).alias("__g")).agg(F.min("__p").alias(f"__b{i}"))
            ranked = ranked.join(second, ranked[k].eqNullSafe(second["__g"]), "left").drop("__g")
        before = F.array_distinct(F.filter(F.array(*[F.when(F.col("__p") > F.col(f"__a{i}"), F.col(f"__a{i}")) for i in range(len(names))]), lambda a: a.isNotNull()))
        several = F.size(before) > 1
        for i in range(len(names)):
            several = several | F.coalesce(F.col("__p") > F.col(f"__b{i}"), F.lit(False))
        linked = ranked.select("__p", before.alias("before"), several.alias("several"))
        # a pointer, how often the verdict turns along it, and whether it has come to the end of its chain
        alone = F.col("several") | (F.size("before") == 0)
        chains = cut(linked.select(
            "__p", F.when(alone, F.col("__p")).otherwise(F.col("before")[0]).alias("to"), (~alone).alias("turned"), alone.alias("ended"),
            (~F.col("several") & (F.size("before") == 0)).alias("known"),
        ))
        while not chains.where("NOT ended").isEmpty():
            ahead = chains.select(F.col("__p").alias("at"), F.col("to").alias("on"), F.col("turned").alias("turns"), F.col("ended").alias("end"), F.col("known").alias("knows"))
            moved = chains.join(ahead, chains["to"] == ahead["at"])
            chains = cut(moved.select(
                "__p", F.when(F.col("ended"), F.col("to")).otherwise(F.col("on")).alias("to"),
                F.when(F.col("ended"), F.col("turned")).otherwise(F.col("turned") != F.col("turns")).alias("turned"),
                (F.col("ended") | F.col("end")).alias("ended"), F.when(F.col("ended"), F.col("known")).otherwise(F.col("knows")).alias("known"),
            ))
        settled = chains.where("known").select("__p", (~F.col("turned")).alias("__ok"))
        accepted = open_.join(settled.where("__ok"), "__p", "left_semi")
        left = open_.join(settled, "__p", "left_anti").withColumn("__gone", F.lit(False))
        for k in names:
            taken = accepted.select(F.col(k).alias("__g")).distinct().withColumn("__hit", F.lit(True))
            left = left.join(taken, left[k].eqNullSafe(taken["__g"]), "left").withColumn("__gone", F.col("__gone") | F.col("__hit").isNotNull()).drop("__g", "__hit")
        left = cut(left)
        verdicts = verdicts.union(settled).union(left.where("__gone").select("__p", F.lit(False).alias("__ok")))
        open_ = left.where("NOT __gone").drop("__gone")
    return verdicts


def _judge_inserts(state: DataFrame, rows: DataFrame, keys: Keys, pos: Sequence[str]) -> tuple[DataFrame, list[KeySpec]]:
    specs = [as_key(k) for k in keys]
    out = rows.withColumn("__exists", F.lit(False))
    for key in specs:
        found = matching_rows(state, rows, key.columns)
        out = _flag(out, found, key.columns, "__e").withColumn("__exists", F.col("__exists") | F.col("__e")).drop("__e")
    return out, specs


def insert(
    state: DataFrame, rows: DataFrame, keys: Keys = (), pos: str = "pos", recnum: str = "recnum",
    identity: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Append rows in ``pos`` order (every row has its own), numbered from the largest record number on.

    Returns the new state and the rejected rows with a ``reason``: ``exists`` (the key is in
    the state) or ``repeated`` (an earlier accepted row has it).  ``identity`` names an
    autoincrement column that takes the record number.
    """
    identity_cols = {recnum, identity}
    keys = [k for k in keys if not identity_cols & set(as_key(k).columns)]
    judged, specs = _judge_inserts(state, rows, keys, [pos])
    judged = judged.withColumn("__ok", ~F.col("__exists"))
    if len(specs) == 1:
        # one key: equal keys share their fate with the state, so the first occurrence wins
        judged = _blocked(judged, specs, [pos], "__ok").withColumn("__ok", F.col("__ok") & ~F.col("__blocked"))
    elif specs:
        judged = cut(judged)
        verdicts = _settle_conflicts(judged.where("__ok"), specs, pos).withColumnRenamed("__ok", "__verdict")
        joined = judged.join(verdicts, judged[pos] == verdicts["__p"], "left")
        judged = joined.withColumn("__ok", F.coalesce("__verdict", F.lit(False))).drop("__p", "__verdict")
    judged = cut(judged.drop("__blocked"))
    rejects = judged.where("NOT __ok").withColumn(
        "reason", F.when(F.col("__exists"), F.lit("exists")).otherwise(F.lit("repeated"))
    ).drop("__exists", "__ok")
    accepted = judged.where("__ok").select(*rows.columns)
    return _append(state, accepted, [pos], recnum, identity), rejects


def _append(state: DataFrame, accepted: DataFrame, order: Sequence[str], recnum: str, identity: str | None) -> DataFrame:
    last = state.agg(F.coalesce(F.max(recnum), F.lit(0)).alias("n")).scalar()
    numbered = row_numbers(accepted.drop(recnum), [(c, False) for c in order], "__new")
    given = numbered.withColumn(recnum, (F.col("__new") + last).cast(state.schema[recnum].dataType))
    if identity is not None and identity != recnum:
        given = given.withColumn(identity, F.col(recnum).cast(state.schema[identity].dataType))
    return state.unionByName(given.select(*state.columns))


def insert_batch(
    state: DataFrame, rows: DataFrame, keys: Keys, batch: str = "batch", pos: str = "pos",
    recnum: str = "recnum", identity: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert batches in order; each stops at its first bad row, the rows before it stay.

    Returns the new state and one report row per batch: rows asked and inserted, status 0,
    or 5 when the batch stopped, and where it stopped.
    """
    keys = [k for k in keys if not {recnum, identity} & set(as_key(k).columns)]
    order = [batch, pos]
    judged, specs = _judge_inserts(state, rows, keys, order)

    def judge(df: DataFrame) -> DataFrame:
        seen = _blocked(df, specs, order, "__was")
        bad = F.col("__exists") | F.col("__blocked")
        stops = seen.where(bad).groupBy(F.col(batch).alias("__batch")).agg(F.min(pos).alias("__stop"))
        kept = seen.join(stops, seen[batch].eqNullSafe(stops["__batch"]), "left").drop("__batch", "__blocked")
        return kept.withColumn("__ok", F.coalesce(F.col(pos) < F.col("__stop"), F.lit(True)))

    start = judged.withColumn("__ok", ~F.col("__exists")).withColumn("__stop", F.lit(None).cast(rows.schema[pos].dataType))
    settled = _settle(start, lambda df: judge(df.drop("__stop")).select(*df.columns, "__ok"))
    report = settled.groupBy(batch).agg(
        F.count(F.lit(1)).alias("asked"),
        F.count_if("__ok").alias("inserted"),
        F.when(F.min("__stop").isNull(), F.lit(OK)).otherwise(F.lit(DUPLICATE_KEY)).alias("status"),
        F.min("__stop").alias("stopped_at"),
    )
    return _append(state, settled.where("__ok").select(*rows.columns), order, recnum, identity), report


def update(
    state: DataFrame, changes: DataFrame, recnum: str = "recnum", sequence: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Replace every column but the record number by the change with that number.

    Of several changes for a number the one with the largest ``sequence`` holds (each map task
    keeps one per number before the shuffle); without a sequence none of them does.  Also returns
    the changes that were not applied: without a record, repeated, or overtaken by a later one.
    """
    if sequence is not None:
        latest = Window.partitionBy(recnum).orderBy(F.col(sequence).desc_nulls_last(), *[F.col(c) for c in changes.columns])
        ranked = changes.withColumn("__n", F.row_number().over(latest))
    else:
        ranked = changes.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(recnum)))
    changes, others = ranked.where("__n = 1").drop("__n"), ranked.where("__n > 1").drop("__n")
    new = changes.select(
        F.col(recnum).alias("__at"), F.struct(*[c for c in state.columns if c != recnum]).alias("__new")
    )
    joined = state.join(new, state[recnum] == F.col("__at"), "left")
    changed = F.col("__at").isNotNull()
    columns = [
        F.col(c) if c == recnum else F.when(changed, F.col("__new")[c]).otherwise(F.col(c)).alias(c)
        for c in state.columns
    ]
    found = matching_rows(state, changes, [recnum])
    return joined.select(*columns), changes.join(found, recnum, "left_anti").unionByName(others)


def delete(state: DataFrame, positions: DataFrame, recnum: str = "recnum") -> tuple[DataFrame, DataFrame]:
    """Remove the records at positions; also returns the positions that held none."""
    gone = positions.select(recnum).distinct()
    return state.join(gone, recnum, "left_anti"), gone.join(matching_rows(state, gone, [recnum]), recnum, "left_anti")


# -- byte patches ----------------------------------------------------------------------


def rectangle_patches(requests: DataFrame) -> DataFrame:
    """``count`` chunks of ``size`` bytes at a ``stride`` from ``first``, as single patches."""
    chunk = F.explode(F.expr("sequence(0, `count` - 1)"))
    each = requests.where(F.col("count") > 0).select("*", chunk.alias("chunk"))
    return each.select(
        "request", "recnum", "chunk",
        (F.col("first") + F.col("chunk") * F.col("stride")).alias("offset"),
        F.expr("substring(data, chunk * size + 1, size)").alias("data"),
    )


def truncate_report(requests: DataFrame, record_length: int) -> DataFrame:
    """Fixed-length records cannot shrink: status 28 below the record length, else no change."""
    short = F.col("length") < record_length
    return requests.select("request", "recnum", F.when(short, F.lit(TOO_SHORT)).otherwise(F.lit(OK)).alias("status"))


#: What patches of a record are ordered by, the later one on top.
_PLACE = ["request", "chunk", "offset", "data"]
#: Patch bytes and patches that a map task lays over each other at once; a byte takes some eighty in between.
_PATCH_BLOCK, _PATCHES = 1 << 20, 1 << 17


def _seen_runs(patches: DataFrame, recnum: str) -> DataFrame:
    """The runs of bytes of each patch that no later patch of its block covers, as patches."""
    rows = patches.select(F.col(recnum), "request", "chunk", F.col("offset").cast("long").alias("offset"), "data")

    def seen(table: pa.Table) -> pa.RecordBatch:
        table = table.take(pc.sort_indices(table, sort_keys=[(n, "ascending") for n in _PLACE], null_placement="at_start"))
        record = table.column(recnum).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        data = table.column("data").cast(pa.large_binary()).combine_chunks()
        ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        sizes, start = np.diff(ends), table.column("offset").to_numpy()
        value = np.frombuffer(data.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = start[owner] + np.arange(len(owner)) - (ends[:-1] - ends[0])[owner]
        # the bytes of a record side by side, those of one place in the order of their patches
        order = np.lexsort((at, record[owner]))
        owner, at, value = owner[order], at[order], value[order]
        last = np.append((np.diff(record[owner]) != 0) | (np.diff(at) != 0), True)
        owner, at, value = owner[last], at[last], value[last]
        opens = np.flatnonzero(np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(at) != 1))))
        closes = np.append(opens[1:], len(owner))
        raw = value.tobytes()
        held = table.take(pa.array(owner[opens]))
        runs = pa.array([raw[i:j] for i, j in zip(opens.tolist(), closes.tolist())], type=table.schema.field("data").type)
        columns = [pa.array(at[opens]) if n == "offset" else runs if n == "data" else held.column(n).combine_chunks() for n in table.schema.names]
        return pa.RecordBatch.from_arrays(columns, names=table.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[pa.RecordBatch] = []
        size = count = 0
        for batch in batches:
            if batch.num_rows:
                block.append(batch)
                size += pc.sum(pc.binary_length(batch.column("data"))).as_py()
                count += batch.num_rows
            if size >= _PATCH_BLOCK or count >= _PATCHES:
                yield seen(pa.Table.from_batches(block))
                block, size, count = [], 0, 0
        if block:
            yield seen(pa.Table.from_batches(block))

    return rows.mapInArrow(run, rows.schema)


def update_chunks(
    state: DataFrame, patches: DataFrame, record_length: int, recnum: str = "recnum", rec: str = "rec"
) -> tuple[DataFrame, DataFrame]:
    """Overlay ``(request, recnum, chunk, offset, data)`` patches on encoded records.

    Requests apply in order, their chunks in order.  A request with a chunk past the
    record's end changes nothing and reports 103; one without a record reports 8.

    Map tasks lay the patches of a block over each other and send on what is seen of each, as
    runs of bytes with their place.  The shuffle moves at most two runs a patch, and a record that
    is patched any number of times brings at most ``record_length`` runs a block together.  Patches
    of equal request and chunk go in the order of offset and data.
    """
    reach = patches.groupBy("request", recnum).agg(
        F.max(F.col("offset") + F.octet_length("data")).alias("__reach"), F.min("offset").alias("__low")
    )
    found = matching_rows(state, reach, [recnum])
    report = _flag(reach, found, [recnum], "__found").select(
        "request", recnum,
        F.when((F.col("__reach") > record_length) | (F.col("__low") < 0), F.lit(CHUNK_PAST_END))
        .when(~F.col("__found"), F.lit(INVALID_POSITION)).otherwise(F.lit(OK)).alias("status"),
    )
    good = patches.join(report.where(F.col("status") == OK).select("request", recnum), ["request", recnum], "left_semi")
    runs = _seen_runs(good.where(F.octet_length("data") > 0), recnum)
    whole = runs.groupBy(F.col(recnum).alias("__at")).agg(F.collect_list(F.struct(*_PLACE)).alias("__runs"))
    joined = state.join(whole, state[recnum] == F.col("__at"), "left")
    patched = F.aggregate(
        F.array_sort("__runs"), F.col(rec),
        lambda acc, p: F.overlay(acc, p["data"], (p["offset"] + 1).cast("int"), F.octet_length(p["data"])),
    )
    new = F.when(F.col("__at").isNull(), F.col(rec)).otherwise(patched).alias(rec)
    return joined.select(*[new if c == rec else F.col(c) for c in state.columns]), report
