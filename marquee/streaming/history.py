"""Append-only usage history (K5) and running per-model counts (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.session import scratch_path
from marquee.streaming.publish import publish

USAGE_RECORD_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
])

#: one record per question (see ``usage.question_records``)
QUESTION_RECORD_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("question_no", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("question", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
    T.StructField("sql_executed", T.BooleanType()),
])


def _source(spark: SparkSession, landing_dir: str, max_files: int | None,
            schema: T.StructType = USAGE_RECORD_SCHEMA) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(landing_dir)


def stream_history(spark: SparkSession, landing_dir: str, history_dir: str,
                   checkpoint: str | None = None, available_now: bool = True,
                   max_files: int | None = None, schema: T.StructType = USAGE_RECORD_SCHEMA):
    """Append records arriving in ``landing_dir`` to the Parquet ``history_dir``.

    The file sink with a checkpoint is exactly-once: a restart neither skips
    nor duplicates files.  With ``available_now`` the query processes what is
    there and stops; otherwise it keeps running (returned handle).
    """
    checkpoint = checkpoint or scratch_path(spark, "history-checkpoint")
    w = (_source(spark, landing_dir, max_files, schema).writeStream
         .format("parquet").outputMode("append")
         .option("path", history_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def stream_model_counts(spark: SparkSession, landing_dir: str, counts_dir: str,
                        checkpoint: str | None = None, available_now: bool = True,
                        schema: T.StructType = USAGE_RECORD_SCHEMA):
    """Keep ``model -> uses`` as streaming state; each micro-batch publishes the
    complete totals as the version of its number.  Read them with
    :func:`~marquee.streaming.publish.read_published`; a batch that is run
    again changes nothing."""
    checkpoint = checkpoint or scratch_path(spark, "model-counts-checkpoint")
    counts = _source(spark, landing_dir, None, schema).groupBy("model").count() \
        .withColumnRenamed("count", "uses")

    w = (counts.writeStream.outputMode("complete")
         .foreachBatch(lambda batch, epoch: publish(batch, counts_dir, epoch, checkpoint) and None)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
