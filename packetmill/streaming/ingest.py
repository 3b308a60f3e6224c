"""Incremental ingestion of manifest rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def ingest_incremental(source: DataFrame, dst: str, checkpoint: str) -> None:
    """Append everything not seen before to a Parquet table and stop.

    ``source`` is a streaming DataFrame. The checkpoint remembers the files that were read, so a
    restart continues and a second run over the same files adds nothing.
    """
    query = (
        source.writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _first_of(order: list[str]):
    """Of each load's rows of a batch the first by ``order``; nulls come before all values."""

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(order, kind="stable", na_position="first").drop_duplicates("load_id")

    return pick


def _first_rows(source: DataFrame, order: str) -> DataFrame:
    """Of the loads that a batch touches those that no batch touched before, each with its first row.

    The state of a load holds the times of the first and of the last batch that brought it and the
    smallest row, nulls before all values. In update mode a batch gives the loads it brings; where both
    times are equal all rows of the load came with this batch. A repeated batch keeps its time.
    """
    rest = [c for c in source.columns if c not in ("load_id", order)]
    row = F.struct(*dict.fromkeys([order, *rest]))
    seen = source.withColumn("_at", F.current_timestamp()).groupBy("load_id").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.min(row).alias("_row"))
    return seen.filter(F.col("_first") == F.col("_last")).select(
        *["load_id" if c == "load_id" else F.col(f"_row.`{c}`").alias(c) for c in source.columns])


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """While a query starts: its state lies in RocksDB, and a checkpoint holds what changed.

    Batches without data would let a query with a timeout go on for ever.
    """
    prefix = "spark.sql.streaming.stateStore."
    wanted = {
        f"{prefix}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{prefix}rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest_first_seen(source: DataFrame, dst: str, checkpoint: str, order: str = "path",
                      forget_ms: int | None = None) -> StreamingQuery:
    """One row per load across all batches, the first by ``order`` within the batch that brings it.

    Which loads were seen is keyed state: a batch looks up its own loads, one by one, in a store on
    the executors' disks, and its checkpoint holds what changed. Nothing that earlier batches wrote
    is read again, so a batch costs what it brings. Before the exchange a task shrinks to one row per
    load, so a load with very many files stays small. ``forget_ms`` lets loads go that were last seen
    that long ago; one that comes later counts as new. That takes a timeout per load, so loads are then
    visited one by one in Python, which is many times slower. A checkpoint serves one of the two ways.
    Each batch owns a folder that a retry replaces, which makes a repeated batch harmless.

    Returns the finished query.
    """
    spark, schema = source.sparkSession, source.schema
    pick = _first_of([order, *[c for c in source.columns if c not in ("load_id", order)]])

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pick(batch)

    def unseen(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, best = state.exists, None
        for batch in batches:
            if not seen:
                best = pick(batch if best is None else pd.concat([best, batch]))
        state.update((True,))
        state.setTimeoutDuration(forget_ms)
        if best is not None:
            yield best

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dst}/batch={batch_id}")

    if forget_ms is None:
        fresh, mode = _first_rows(source, order), "update"
    else:
        mode = "append"
        fresh = source.mapInPandas(shrink, schema).groupBy("load_id").applyInPandasWithState(
            unseen, schema, "seen boolean", mode, GroupStateTimeout.ProcessingTimeTimeout)
    with _state_on_disk(spark):
        query = (
            fresh.writeStream.outputMode(mode).foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query


def first_seen(spark: SparkSession, dst: str) -> DataFrame:
    return spark.read.option("basePath", dst).parquet(f"{dst}/batch=*").drop("batch")
