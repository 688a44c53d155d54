"""Incremental work on Structured Streaming: a request queue and tables that follow newly arrived files.

A batch changes only the buckets of keys that it holds and marks its rows with its number, so a batch that runs again after a
failure, wherever that struck, leaves the keys that it had finished as they are: with the checkpoint that is exactly once.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lightloom.operators.store import swap_write, upsert
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.results import requests as requests_of
from lightloom.session import cut


#: Buckets of keys of a table that is merged into; a batch rewrites those that it has keys of.
BUCKETS = 64


def workspace(spark: SparkSession) -> str:
    """A new folder within the shared one that ``spark.checkpoint.dir`` names; a local temporary one only on a single machine."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if shared is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="stream-")


def files(spark: SparkSession, path: str, schema: StructType, per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files under a path, as they arrive."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(path)


def follow(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Runs ``batch`` for each micro-batch: over what is there and then ends, or, with ``every``, for good."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def merge_into(path: str, key: list[str], combine: Callable[[DataFrame, DataFrame | None], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch function that replaces the keys of ``combine(batch, old)`` in the table at ``path``; ``combine`` sees the old rows of those buckets.

    Keys that this batch has written already, before a failure, are left out.  Only buckets with keys of the batch are written.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
        batch = batch.withColumn("bucket", bucket)
        old = None
        if there:
            touched = batch.select("bucket").distinct()  # BUCKETS rows at most
            old = spark.read.parquet(path).join(F.broadcast(touched), "bucket", "left_semi")
            done = old.filter(F.col("batch") >= number).select(*key)
            batch = batch.join(done, key, "left_anti")
        fresh = combine(batch.drop("bucket"), None if old is None else old.drop("batch", "bucket"))
        fresh = fresh.withColumns({"batch": F.lit(number).cast("long"), "bucket": bucket})
        swap_write(cut(fresh if old is None else upsert(old, fresh, key)), path, "bucket")

    return run


def merged(spark: SparkSession, path: str) -> DataFrame:
    """A table that is merged into, without its marks."""
    return spark.read.parquet(path).drop("batch", "bucket")


def claim(requests: DataFrame, most: int) -> DataFrame:
    """The queue with its first ``most`` queued requests, by (requested_at, req_id), running; one writer holds the queue."""
    first = requests.filter("status = 'queued'").orderBy("requested_at", "req_id").limit(most).select("req_id", F.lit(True).alias("__mine"))
    out = requests.join(first, "req_id", "left").withColumn("status", F.when(F.col("__mine"), "running").otherwise(F.col("status")))
    return out.select(*requests.columns)


def recover(requests: DataFrame) -> DataFrame:
    """The queue after a restart: what was running is queued again, in its old place."""
    return requests.withColumn("status", F.when(F.col("status") == "running", "queued").otherwise(F.col("status")))


def process_requests(requests: DataFrame, handle: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A batch function of the queue: ``handle`` turns a batch of requests into rows (req_id, ...) of results.

    Requests without a result come out as failed.  A micro-batch is claimed whole; for a bounded claim see ``claim``.
    """

    def combine(batch: DataFrame, old: DataFrame | None) -> DataFrame:
        done = handle(batch).withColumn("status", F.lit("done"))
        return batch.join(done, "req_id", "left").withColumn("status", F.coalesce("status", F.lit("failed")))

    return merge_into(path, ["req_id"], combine)


def nights_of(stream: DataFrame, at: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Nights as session windows of an event-time stream, closed once the watermark has passed them."""
    session = F.session_window(at, gap)
    return stream.withWatermark(at, late).groupBy(session.alias("night")).agg(F.count("*").alias("n"))


def _add(batch: DataFrame, old: DataFrame | None) -> DataFrame:
    new = batch.groupBy("night_id").agg(F.count("*").alias("n_frames"), F.max("frame_index").alias("last_frame"))
    if old is None:
        return new
    both = new.unionByName(old.join(new.select("night_id"), "night_id", "left_semi"))
    return both.groupBy("night_id").agg(F.sum("n_frames").alias("n_frames"), F.max("last_frame").alias("last_frame"))


@query("t2_t4_follow_frames", "SELECT night_id, count(*) AS n_frames, max(frame_index) AS last_frame FROM frame GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    place = workspace(t.spark)
    path, source = f"{place}/nights", f"{t.folder}/frame.parquet"
    stream = files(t.spark, source if os.path.isdir(source) else source + "*", t.table("frame").schema)
    follow(stream.select("night_id", "frame_index"), merge_into(path, ["night_id"], _add), f"{place}/checkpoint").awaitTermination()
    return merged(t.spark, path)


@query("t1_t3_request_queue", """
SELECT det_id AS req_id, CASE WHEN tc_bjd_tdb IS NOT NULL THEN 'done' ELSE 'failed' END AS status FROM det WHERE kind = 'transit'""")
def _(t: Inputs) -> DataFrame:
    place = workspace(t.spark)
    t.det.filter("kind = 'transit'").select(F.col("det_id").alias("req_id"), "tc_bjd_tdb").write.parquet(f"{place}/requests")
    requests = files(t.spark, f"{place}/requests", t.spark.read.parquet(f"{place}/requests").schema)
    handle = lambda batch: batch.filter("tc_bjd_tdb is not null").select("req_id")
    follow(requests, process_requests(requests, handle, f"{place}/results"), f"{place}/checkpoint").awaitTermination()
    return merged(t.spark, f"{place}/results").select("req_id", "status")


@query("t1_claim_in_order", """
WITH q AS (SELECT req_id, status, row_number() OVER (PARTITION BY status ORDER BY requested_at, req_id) AS r FROM rr) SELECT req_id, CASE WHEN status = 'queued' AND r <= 5 THEN 'running' ELSE status END AS status FROM q""")
def _(t: Inputs) -> DataFrame:
    return claim(requests_of(t), 5).select("req_id", "status")


@query("t3_recovery", "SELECT req_id, status FROM rr")
def _(t: Inputs) -> DataFrame:
    """A claim that a crash cut short leaves no request behind."""
    return recover(claim(requests_of(t), 5)).select("req_id", "status")
