"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators count on. Adaptive execution splits a hot join key into several
# tasks; forcing it keeps that true when the split costs one more exchange further up the plan.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods above 8000 bytes; wide projections run faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Shuffled bytes that one task takes, and bytes of the tables' files that one initial partition stands
# for. A task that sorts wide rows holds more than ten times the shuffled bytes it takes.
TASK_BYTES = "16m"
INPUT_PER_PARTITION = 2 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Bytes of the loads' tables that are worked on at a time, and the most shares that are made of them: every
# share reads the tables again, so beyond that a share grows with the input.
SHARE_BYTES = 32 << 20
MOST_SHARES = 16
_sizes: dict[tuple[str, str], dict[str, int]] = {}


def _table_sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of the files of each table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _sizes:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        name = F.regexp_extract("path", r"/([^/]+)\.parquet(/|$)", 1).alias("name")
        _sizes[key] = {r["name"]: r["size"] for r in files.groupBy(name).agg(F.sum("length").alias("size")).collect()}
    return _sizes[key]


def shares(spark: SparkSession, folder: str, *names: str) -> int:
    """The number of shares, a power of two, that tables are worked on in, one after the other."""
    sizes = _table_sizes(spark, folder)
    wanted = max(1, min(MOST_SHARES, sum(sizes.get(n, 0) for n in names) // SHARE_BYTES))
    return 1 << wanted.bit_length() - 1


def fit_partitions(spark: SparkSession, folder: str) -> None:
    """Let the number of partitions follow the size of the tables, so that the memory of a task does not."""
    wanted, number = -(-sum(_table_sizes(spark, folder).values()) // INPUT_PER_PARTITION), INITIAL_PARTITIONS
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(number, str(wanted))
    else:
        spark.conf.unset(number)


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "packetmill") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PACKETMILL_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Of each ``discarding`` that is open the scratch folders made within.
_passing: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir`` when the session names one. Without it only a local
    master may use a temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        path = f"{base.rstrip('/')}/packetmill-{name}-{uuid.uuid4().hex}"
        if _passing:
            _passing[-1].append(path)
        return path
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix=f"run-{name}-")
        if _passing:
            _passing[-1].append(path)
        return path
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made within are deleted at the end, so nothing that reads them may leave."""
    _passing.append([])
    try:
        yield
    finally:
        for name in _passing.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(name)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def changed(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds within, and then is what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def freeing(spark: SparkSession):
    """Writes that are started within give their shuffle files back when they are done.

    Otherwise these stay until the driver happens to collect what refers to them. What is only
    described within, and run later, keeps its files as usual.
    """
    return changed(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def stored(df: DataFrame, name: str, *partition_by: str, compression: str | None = None) -> DataFrame:
    """The same rows, written once under the shared scratch folder and read from there."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with freeing(spark):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
