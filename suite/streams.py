"""Incremental forms: the same rows as one batch run over everything."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyloom.plans.lineage import scratch_path
from keyloom.sources.record_files import collect_files
from keyloom.streaming import import_stream as I
from keyloom.streaming import log_stream as G
from suite.changes import _LOG_SQL, CUSTOMER, log
from suite.common import Suite, customers, table
from suite.files import CUSTOMER_SQL, _v6, customer_files

S = Suite()

#: Micro-batches that files which are all there are dealt over; a batch has a fixed cost, so their number does not grow.
BATCHES = 8


@S.add("import_stream", CUSTOMER_SQL)
def import_stream(spark, sf):
    folder = customer_files(spark, sf, _v6)
    target = scratch_path(spark, "stream-import")
    each = max(2, -(-collect_files(spark, folder).count() // BATCHES))
    query = I.import_stream(spark, folder, CUSTOMER, target, scratch_path(spark, "stream-mark"), max_files=each)
    query.awaitTermination()
    out = spark.read.parquet(target).drop("batch", "file", "page_no", "slot_no")
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@S.add(
    "apply_log_stream",
    f"""WITH {_LOG_SQL} SELECT c_custkey AS recnum, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT recnum FROM fin)
    UNION ALL SELECT recnum, c_name, c_acctbal FROM fin WHERE op <> 4""",
)
def apply_log_stream(spark, sf):
    """The log arrives in three parts that cut through transactions."""
    whole = log(spark, sf)
    n = table(spark, sf, "events").count()
    source, root = scratch_path(spark, "log"), scratch_path(spark, "log-state")
    G.start_state(customers(spark, sf).select("recnum", "c_name", "c_acctbal"), root)
    part = F.expr(f"CAST(seq * 3 DIV {n} AS INT)")
    # a part is one micro-batch, whatever number of files it has
    whole.withColumn("part", part).write.partitionBy("part").parquet(source)
    mark = scratch_path(spark, "log-mark")
    for i in range(3):
        stream = spark.readStream.schema(whole.schema).parquet(f"{source}/part=[0-{i}]")
        G.apply_log_stream(stream, root, mark).awaitTermination()
    return G.finish(spark, root, 3)
