"""What the corpus operators share: reading, folds, bounded Arrow batches, ragged gathers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows and bytes of text that one step of a Python task holds at once.
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20

#: An Arrow batch from the JVM: it bounds what a Python worker gets in one piece.
BATCH_BYTES = "16m"
BATCH_ROWS = "2048"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the identifier as text, modulo ``parts``; null for a null identifier."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def give_back() -> None:
    """What Arrow and malloc keep for later goes back to the system: workers of an executor wait, many at a time, for their next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which leaves no memory that it does not use to the worker's next task."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size (long texts would make them huge)."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(giving_back(run), schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def blocks(batch: pa.RecordBatch, text: str = "text", rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``size`` bytes of text (or one row) each."""
    col = batch.column(text)
    lengths = np.array([0 if v is None else v for v in pc.binary_length(col).to_pylist()], dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, done + size, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated slices ``values[starts[i] : starts[i] + lengths[i]]``."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    shift += np.arange(total, dtype=shift.dtype)
    return values[shift]


def record(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], type=t) for n, t in types.items()], names=list(types))
