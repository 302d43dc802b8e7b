"""Streaming sensor log.

The device poll loop becomes a Structured Streaming query: new replies arrive as files
(or a Kafka topic) -> the same parse as the batch path -> good rows and rejects appended
to two sinks from one ``foreachBatch``.  ``trigger="once"`` drains what is there and stops
(the one-shot mode, ``availableNow``); ``trigger="10 seconds"`` keeps polling (the log
mode).  Offsets and sink commits live under the checkpoint folder, so a restarted job
neither loses nor repeats a batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import readings as ops
from ..session import checkpoint_dir, landed
from ..sources.files import NO_TABLE

DEFAULT_INTERVAL = "10 seconds"   # the original poll interval


def reply_stream(spark: SparkSession, source_dir: str, schema: StructType, file_glob: str | None = None,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """S10 (re-aimed): replies arriving as files in ``source_dir``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def kafka_reply_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                       starting_offsets: str = "latest") -> DataFrame:
    """Replies from a Kafka topic (needs the Spark Kafka connector on the classpath;
    not available in this build environment).  The record value is the raw reply bytes,
    the record timestamp the device time."""
    from ..functions.replies import latin1_text
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets).load()
            .select(F.col("offset").alias("event_id"), F.col("timestamp").cast("timestamp_ntz").alias("ts"),
                    latin1_text("value").alias("raw")))


def parsed_stream(replies: DataFrame, raw: str = "raw", variant: str = "A") -> DataFrame:
    """R1 + R4: parse each reply; ``ingest_ts`` is the arrival time, ``ts`` the device time."""
    return ops.parse_replies(replies, raw, variant).withColumn("ingest_ts", F.current_timestamp())


def _batch_writer(out_dir: str, keep, fmt: str = "parquet"):
    def write(batch: DataFrame, batch_id: int) -> None:
        # R2: good rows and rejects go to separate tables.  Each batch overwrites only its
        # own batch_id partition, so a batch replayed after a failure is idempotent.
        # The micro-batch feeds two sinks: persist it so the source is read once.
        tagged = batch.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            good = ops.good(tagged, keep=(*keep, "ingest_ts", "batch_id"))
            bad = ops.rejected(tagged, keep=(*keep, "ingest_ts", "batch_id"))
            for name, df in (("good", good), ("rejected", bad)):
                # K7: CSV logs carry a header line in every file, so any file reads alone
                (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
                 .partitionBy("batch_id").format(fmt).save(os.path.join(out_dir, name)))
        finally:
            tagged.unpersist()
    return write


def run_reading_log(parsed: DataFrame, out_dir: str, checkpoint: str, trigger: str = "once",
                    keep=("event_id", "ts"), fmt: str = "parquet"):
    """R1 + R2 + R3 + K7: start the log stream; returns the ``StreamingQuery``.

    ``trigger="once"`` -> ``availableNow`` (process everything present, then stop);
    otherwise a processing-time interval such as ``"10 seconds"``.
    """
    writer = (parsed.writeStream.foreachBatch(_batch_writer(out_dir, keep, fmt))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger == "once" else writer.trigger(processingTime=trigger)
    return writer.start()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    root = checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def pending_days(days: DataFrame, run_log: DataFrame, day: str = "day") -> DataFrame:
    """R5 (re-aimed): days that still need their daily run -- every day with data that the
    run table does not list yet.  Started late, the job catches up on all missing days;
    the state is the run table, so it survives restarts."""
    return days.select(day).distinct().join(run_log.select(day).distinct(), day, "left_anti")


def record_runs(done: DataFrame, run_log_path: str, day: str = "day", run: str | None = None) -> None:
    """R5 + K8: append the processed days to the run table."""
    (done.select(day).distinct().withColumn("run_ts", F.current_timestamp()).withColumn("run", F.lit(run).cast("string"))
     .write.mode("append").parquet(run_log_path))


def catch_up(data: DataFrame, run_log_path: str, job, day: str = "day") -> DataFrame:
    """Run ``job`` once over every day that has data but no entry in the run table,
    then record those days.  Started late, one run processes all missed days together
    (one job, not a loop); restarted, it skips what the run table already lists.

    ``job`` receives the rows of the pending days and returns the DataFrame it produced.  The
    result is written (to the shared checkpoint folder) before the days are recorded, so a
    failed job leaves its days pending.
    """
    spark = data.sparkSession
    done = _run_table(spark, run_log_path, data, day)
    checkpoint_dir(spark)
    pending = pending_days(data.select(day), done, day).checkpoint()
    result = job(data.join(pending, day, "left_semi")).checkpoint()
    record_runs(pending, run_log_path, day)
    return result


def rollup_stream(parsed: DataFrame, every: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """A12 in streaming form: per event-time bucket (tumbling window) count, mean, min and
    max of RH and temperature over the good replies.  The watermark bounds the state:
    a bucket is final (and its state dropped) once replies ``watermark`` later have been
    seen; later replies for it are ignored."""
    good = parsed.where(F.col("reject_reason").isNull()).withColumn("_tly_et", F.col("ts").cast("timestamp"))
    n = F.count(F.lit(1))
    return (good.withWatermark("_tly_et", watermark)
            .groupBy(F.window("_tly_et", every).alias("w"))
            .agg(n.alias("n"),
                 F.try_sum(F.col("rh").try_cast("decimal(38,3)")).alias("_rh_sum"), F.min("rh").alias("rh_min"),
                 F.max("rh").alias("rh_max"),
                 F.try_sum(F.col("temp_c").try_cast("decimal(38,3)")).alias("_t_sum"),
                 F.min("temp_c").alias("temp_c_min"), F.max("temp_c").alias("temp_c_max"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("bucket"), "n",
                    (F.col("_rh_sum").cast("double") / F.col("n")).alias("rh_avg"), "rh_min", "rh_max",
                    (F.col("_t_sum").cast("double") / F.col("n")).alias("temp_c_avg"), "temp_c_min", "temp_c_max"))


def run_rollup(rollup: DataFrame, out_dir: str, checkpoint: str, trigger: str = "once"):
    """Append finished buckets to parquet (each bucket is written once, after the watermark
    passes it); returns the ``StreamingQuery``."""
    writer = (rollup.writeStream.outputMode("append").format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger == "once" else writer.trigger(processingTime=trigger)
    return writer.start()


def run_merged_rollup(parsed: DataFrame, out_dir: str, checkpoint: str, unit: str = "hour", trigger: str = "once"):
    """R1 + A12 without a watermark: each micro-batch writes its partial sums per bucket.

    A batch replaces only its own ``batch_id`` partition, so a replayed one changes nothing, and
    no state is kept, so no reply is too late.  ``merged_rollup`` adds the parts up.
    """
    writer = parsed.writeStream.foreachBatch(partial_writer(out_dir, unit)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger == "once" else writer.trigger(processingTime=trigger)
    return writer.start()


def partial_writer(out_dir: str, unit: str = "hour"):
    def write(batch: DataFrame, batch_id: int) -> None:
        (ops.partial_stats(batch.where(F.col("reject_reason").isNull()), unit).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_dir))
    return write


def merged_rollup(spark: SparkSession, out_dir: str) -> DataFrame:
    """R1 + A12: the buckets of all batches written so far (``run_merged_rollup``)."""
    return ops.merge_stats(spark.read.parquet(out_dir), "bucket")


def run_days(data: DataFrame, out_dir: str, run_log_path: str, job, run: str, day: str = "day") -> None:
    """``job`` over every day that the run table does not list; the result is kept by day.

    The days' results replace their own partitions first, marked with the name of the run; the
    run table is appended after.  A result counts only if the table lists its day with the same
    run (``committed_days``): a job killed between the two writes leaves its days pending and
    its results unseen, and the next run replaces them, so no day is lost or doubled.  ``job``
    gets the rows of the pending days and returns rows with the ``day`` column.  ``run`` must
    differ from run to run.
    """
    spark = data.sparkSession
    done = _run_table(spark, run_log_path, data, day)
    pending = landed(pending_days(data.select(day), done, day), "pending-days")
    (job(data.join(pending, day, "left_semi")).withColumn("run", F.lit(run))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(out_dir))
    record_runs(pending, run_log_path, day, run)


def committed_days(spark: SparkSession, out_dir: str, run_log_path: str, day: str = "day") -> DataFrame:
    """The results of ``run_days`` whose day and run are in the run table."""
    log = spark.read.parquet(run_log_path)
    kept = spark.read.parquet(out_dir).withColumn(day, F.col(day).cast(log.schema[day].dataType))
    return kept.join(log.select(day, "run").distinct(), [day, "run"], "left_semi")


def _run_table(spark: SparkSession, path: str, data: DataFrame, day: str) -> DataFrame:
    try:
        return spark.read.parquet(path).select(day)
    except AnalysisException as e:
        if e.getCondition() not in NO_TABLE:
            raise
        return spark.createDataFrame([], data.select(day).schema)   # nothing has run
