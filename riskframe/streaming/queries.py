"""Streams of the given tables, and the live operators without state of their own (L1, L9, W7
hopping windows); those with state are in :mod:`live`.

Each query reads a file source with an explicit schema, applies the same
column expressions as the batch path, and writes through ``foreachBatch``
with idempotent writes keyed by ``batch_id`` (a replayed micro-batch
overwrites its own output), so a restart from the checkpoint after an
executor or driver loss gives the same table. Checkpoints and outputs live
under the cluster's shared ``spark.checkpoint.dir``.

``run_available(...)`` drains what is present (``Trigger.AvailableNow``) and
returns the result table as a batch DataFrame - used by the registry and
the stream == batch tests.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import risk as RK
from ..session import scratch_path
from ..sources.tables import map_events

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
CONVERSATIONS_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The Parquet files of the table at ``path`` (one file, or a directory of part
    files, as large tables are) as a stream with an explicit schema."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    r = spark.readStream.schema(schema)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        # a stream reads directories: the file's own, limited to its name
        r, path = r.option("pathGlobFilter", at.getName()), at.getParent().toString()
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Scored-transaction stream from parquet ``events`` files; ``ts_event`` is
    the UTC TIMESTAMP event time (watermarks need TIMESTAMP, not NTZ)."""
    ev = file_stream(spark, path, EVENTS_SCHEMA, max_files_per_trigger)
    return map_events(ev).withColumn("ts_event", F.col("ts").cast("timestamp"))


def _new_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    run = f"{name}-{uuid.uuid4().hex[:12]}"
    return scratch_path(spark, f"stream/{run}/out"), scratch_path(spark, f"stream/{run}/checkpoint")


def _append_batches(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # idempotent: a replay of batch N rewrites batch N only
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def run_available(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Drain the stream (availableNow) through foreachBatch and read the result back."""
    out, ckpt = _new_dirs(spark, name)
    q = (df.writeStream.outputMode("append").option("checkpointLocation", ckpt)
         .foreachBatch(_append_batches(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).drop("batch_id")


# ------------------------------------------------------------------ queries
def record_stream(stream: DataFrame) -> DataFrame:
    """L1: each scored transaction as a log record (ids from the source)."""
    return RK.assess(stream, with_text=False).select(
        "id", "ts", "Amount", "probability", "risk_score", "risk_category", "decision", "is_flagged")


def dedup_resubmitted(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop resubmitted transaction ids within the watermark."""
    return stream.withWatermark("ts_event", delay).dropDuplicatesWithinWatermark(["id"])


def action_stream(spark: SparkSession, path: str) -> DataFrame:
    conv = file_stream(spark, path, CONVERSATIONS_SCHEMA)
    status = (F.when(F.col("role") == "user", F.lit(" confirmed_fraud "))
              .when(F.col("role") == "assistant", F.lit("Dismissed_False_Alarm")).otherwise(F.lit("archive")))
    return conv.select(F.col("conv_id").alias("queue_id"), F.col("turn").alias("action_seq"),
                       status.alias("status_raw"), F.col("text").alias("notes_raw"))


def streaming_velocity(stream: DataFrame, length: str = "1 hour", slide: str = "15 minutes",
                       delay: str = "1 hour") -> DataFrame:
    """Per-entity sliding-window counts and sums (hopping windows), for update mode:
    a window leaves the state when the watermark has passed it."""
    s = stream.withWatermark("ts_event", delay)
    return s.groupBy("entity", F.window("ts_event", length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("Amount").cast("decimal(30,6)")).alias("amount")
    ).select("entity", F.col("w.start").alias("window_start"), "n", "amount")
