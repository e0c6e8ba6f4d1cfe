"""Replaying a transaction log as it arrives.

A state folder holds one version per micro-batch.  ``version=N/changes`` has the last change
of every record the batch touched and ``version=N/pending`` the log rows whose time has not
come; every ``COMPACT_EVERY`` versions ``version=N/state`` holds the whole state, in between
it is the last whole state with the changes since on top.  Micro-batch ``b`` reads version
``b`` and writes version ``b + 1``, so a repeated one gives the same files, and what a batch
writes grows with its log rows, not with the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from keyloom.operators.translog import LIVE, OK, judge_changes, last_changes, overlay, replay, resolve_changes
from keyloom.plans.lineage import cut
from keyloom.streaming.import_stream import _start

COMPACT_EVERY = 16


def _path(root: str, version: int, part: str) -> str:
    return f"{root}/version={version}/{part}"


def start_state(state: DataFrame, root: str) -> None:
    """Write version 0."""
    state.write.mode("overwrite").parquet(_path(root, 0, "state"))


def read_state(spark: SparkSession, root: str, version: int, recnum: str = "recnum") -> DataFrame:
    """The state of a version."""
    whole = version - version % COMPACT_EVERY
    state = spark.read.parquet(_path(root, whole, "state"))
    if whole == version:
        return state
    parts = None
    for v in range(whole + 1, version + 1):
        part = spark.read.parquet(_path(root, v, "changes")).withColumn("__version", F.lit(v))
        parts = part if parts is None else parts.unionByName(part)
    w = Window.partitionBy(recnum).orderBy(F.col("__version").desc())
    last = parts.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1)
    return overlay(state, last, recnum)


def _pending(spark: SparkSession, root: str, version: int, log: DataFrame) -> DataFrame:
    if version == 0:
        return spark.createDataFrame([], log.schema).withColumn("outcome", F.lit(None).cast("string"))
    return spark.read.parquet(_path(root, version, "pending"))


def apply_batch(log: DataFrame, root: str, version: int, recnum: str = "recnum") -> None:
    """Apply one micro-batch to ``version`` and write ``version + 1``.

    Changes of open transactions wait, and so do all later changes of the same records:
    what is applied is the same as in one run over the whole log.
    """
    spark = log.sparkSession
    state = read_state(spark, root, version, recnum)
    waiting = _pending(spark, root, version, log)
    decided = waiting.where("outcome IS NOT NULL AND outcome <> 'open'")
    undecided = waiting.where("outcome IS NULL OR outcome = 'open'").drop("outcome")
    changes, markers = resolve_changes(log.unionByName(undecided))
    changes = cut(changes.unionByName(decided))
    first_open = changes.where("outcome = 'open'").groupBy(recnum).agg(F.min("seq").alias("__open"))
    judged = cut(changes.join(first_open, recnum, "left"))
    blocked = F.coalesce(F.col("seq") >= F.col("__open"), F.lit(False))
    ready = judged.where(~blocked & F.expr(LIVE)).drop("__open")
    last = cut(last_changes(judge_changes(state, ready, recnum), recnum))
    last.select("op", *state.columns).write.mode("overwrite").parquet(_path(root, version + 1, "changes"))
    if (version + 1) % COMPACT_EVERY == 0:
        overlay(state, last, recnum).write.mode("overwrite").parquet(_path(root, version + 1, "state"))

    held = judged.where(blocked & F.expr("outcome <> 'aborted'")).drop("__open").select(*waiting.columns)
    # the begin of an open transaction waits with its changes
    begins = markers.where((F.col("status") == OK) & (F.col("outcome") == "open")).select(
        "seq", "session", "op", F.lit(None).cast("string").alias("outcome")
    )
    held.unionByName(begins, allowMissingColumns=True).write.mode("overwrite").parquet(_path(root, version + 1, "pending"))


def finish(spark: SparkSession, root: str, version: int, recnum: str = "recnum") -> DataFrame:
    """The state once the log has ended: open transactions are dropped, what waited for them is applied."""
    rest = spark.read.parquet(_path(root, version, "pending")).where(LIVE)
    return replay(read_state(spark, root, version, recnum), rest, recnum)[0]


def apply_log_stream(
    log_stream: DataFrame, root: str, checkpoint: str, recnum: str = "recnum", processing_time: str | None = None
) -> StreamingQuery:
    """Keep the state under ``root`` up to date with a stream of log rows, in ``seq`` order across batches."""
    return _start(log_stream, lambda log, batch_id: apply_batch(log, root, batch_id, recnum), checkpoint, processing_time)
