"""Calls and tokens per time window of a stream of model calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.sources import published


def throughput(calls: DataFrame, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """``window_start, calls, tokens`` per tumbling window, for batch and streaming input alike.

    In a stream, rows older than the watermark are dropped; the batch result is met only while
    rows come no later than that.
    """
    stamped = calls.withColumn("ts", F.col("ts").cast("timestamp"))
    if calls.isStreaming:
        stamped = stamped.withWatermark("ts", late)
    grouped = stamped.groupBy(F.window("ts", window).alias("w")).agg(
        F.count("*").alias("calls"),
        F.coalesce(F.sum("total_tokens"), F.lit(0).cast("bigint")).alias("tokens"),
    )
    return grouped.select(F.col("w.start").alias("window_start"), "calls", "tokens")


def run_throughput(calls: DataFrame, dst: str, checkpoint: str, window: str = "1 minute", late: str = "10 minutes") -> None:
    """Process what is available; every batch stores the windows it touched in a folder of its own."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dst}/batch={batch_id}")

    query = (
        throughput(calls, window, late)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_windows(spark: SparkSession, dst: str) -> DataFrame:
    """The newest figures of every window."""
    rows = spark.read.option("basePath", dst).parquet(f"{dst}/batch=*")
    newest = F.max_by(F.struct("calls", "tokens"), F.col("batch")).alias("r")
    return rows.groupBy("window_start").agg(newest).select("window_start", "r.*")


def run_throughput_keeping_late(calls: DataFrame, dst: str, checkpoint: str, late: str = "10 minutes", window: str = "1 minute") -> None:
    """Like ``run_throughput``, but rows behind the watermark go to a side table instead of nowhere.

    Every batch adds three folders of its own, which a retry replaces: the counts that it brings to
    windows (``windows``), its rows that are more than ``late`` behind the newest time of all batches
    before it (``late``), and the newest time so far (``marks``), which the next batch starts from.
    Counts only add up, so no window is held in memory.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamped = batch.withColumn("ts", F.col("ts").cast("timestamp"))
        newest = F.max("ts").alias("newest")
        behind = F.lit(False)
        if batch_id > 0:
            before = spark.read.parquet(f"{dst}/marks/batch={batch_id - 1}").first()["newest"]
            behind = F.coalesce(F.col("ts") < F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {late}"), F.lit(False))
            newest = F.greatest(newest, F.lit(before).cast("timestamp")).alias("newest")
        stamped.filter(behind).write.mode("overwrite").parquet(f"{dst}/late/batch={batch_id}")
        throughput(stamped.filter(~behind), window).write.mode("overwrite").parquet(f"{dst}/windows/batch={batch_id}")
        stamped.agg(newest).coalesce(1).write.mode("overwrite").parquet(f"{dst}/marks/batch={batch_id}")

    query = (
        calls.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _batches(spark: SparkSession, dst: str, name: str) -> DataFrame:
    return spark.read.option("basePath", f"{dst}/{name}").parquet(f"{dst}/{name}/batch=*").drop("batch")


def late_rows(spark: SparkSession, dst: str) -> DataFrame:
    return _batches(spark, dst, "late")


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start").agg(F.sum("calls").alias("calls"), F.sum("tokens").alias("tokens"))


def windows_on_time(spark: SparkSession, dst: str) -> DataFrame:
    """The figures of every window without the rows that came late."""
    return _added(_batches(spark, dst, "windows"))


def fold_late(spark: SparkSession, dst: str, window: str = "1 minute") -> DataFrame:
    """The batch correction: figures with all late rows so far, published as a new version and read back."""
    rows = _batches(spark, dst, "windows").unionByName(throughput(late_rows(spark, dst), window))
    published.publish(_added(rows), f"{dst}/corrected")
    return published.read_published(spark, f"{dst}/corrected")
