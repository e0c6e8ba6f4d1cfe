"""Loading record files as they arrive in a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keyloom.layout import Layout
from keyloom.sources.importer import decoded_files
from keyloom.plans.lineage import cut
from keyloom.sources.record_files import read_headers


def import_stream(
    spark: SparkSession, folder: str, layout: Layout, target: str, checkpoint: str, mode: str = "auto",
    ext: str = "b", max_files: int | None = None, processing_time: str | None = None,
) -> StreamingQuery:
    """Decode every new file under ``folder`` into ``target/batch=<id>``.

    The stream carries file names only; each micro-batch splits its files into page chunks
    like a batch import.  A repeated micro-batch overwrites its own folder, so no record is
    loaded twice.  Without ``processing_time`` it takes what is there and stops.
    """
    pattern = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in ext)
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    arrived = reader.load(folder).selectExpr("path AS file", "length AS size")

    def load(batch: DataFrame, batch_id: int) -> None:
        headers = cut(read_headers(batch))
        decoded_files(headers, layout, mode).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return _start(arrived, load, checkpoint, processing_time)


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, processing_time: str | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()
