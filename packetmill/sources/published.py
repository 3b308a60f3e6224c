"""Tables in versions: a job writes a folder of its own, then a small pointer file is switched to it.

Readers resolve the pointer once, when they make their plan, so they see one whole version however
long they run. A job that is stopped in mid-write leaves a folder that no pointer names; the table
stays what it was. Files are reached through the file system classes Spark itself uses.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from packetmill.sources.writers import export_ml

POINTER = "_current"
VERSION = "version-"


def _path(spark: SparkSession, name: str):
    """A path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the version that readers see; None before the first one is published."""
    pointer, files = _path(spark, f"{path}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Switch the pointer in one step: a file under a temporary name takes the place of the old one."""
    folder, files = _path(spark, f"{path}/{version}")
    if not files.exists(folder):
        raise ValueError(f"no version {version!r} under {path}")
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    written, _ = _path(spark, f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(written, True)
    stream.write(version.encode())
    stream.close()
    pointer, _ = _path(spark, f"{path}/{POINTER}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(written), files.makeQualified(pointer), options)


def publish(table: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a new version as ``export_ml`` does and make it the current one; its name comes back."""
    version = f"{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    export_ml(table, f"{path}/{version}", fmt)
    point_to(table.sparkSession, path, version)
    return version


def read_published(spark: SparkSession, path: str, fmt: str = "parquet", version: str | None = None, **options) -> DataFrame:
    """The current version, or a named one."""
    version = version or current_version(spark, path)
    if version is None:
        raise ValueError(f"nothing is published under {path}")
    return spark.read.format(fmt).options(**options).load(f"{path}/{version}")


def versions(spark: SparkSession, path: str) -> list[str]:
    """All version folders, the oldest first, unfinished ones among them."""
    folder, files = _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(name for f in files.listStatus(folder) if (name := f.getPath().getName()).startswith(VERSION))


def expire(spark: SparkSession, path: str, keep: int = 3) -> list[str]:
    """Delete versions older than the current one but for the ``keep - 1`` before it.

    Newer folders stay, as a running job may still be writing one.
    """
    current = current_version(spark, path)
    older = [v for v in versions(spark, path) if current is not None and v < current]
    gone = older[:max(0, len(older) - (keep - 1))]
    for version in gone:
        folder, files = _path(spark, f"{path}/{version}")
        files.delete(folder, True)
    return gone
