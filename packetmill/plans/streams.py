"""Incremental runs with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.operators import manifest
from packetmill.plans import fixtures
from packetmill.plans.fixtures import RAW_PREFIX, with_tables
from packetmill.plans.registry import ORACLES, query
from packetmill.session import scratch_dir
from packetmill.streaming import ingest, throughput


def _stream(spark: SparkSession, sf_dir: str, base: str, name: str) -> DataFrame:
    """A derived table over a base table that is read as a stream of files."""
    schema = fixtures.base(spark, sf_dir, base).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{base}.parquet").parquet(sf_dir)
    rows.createOrReplaceTempView(f"{fixtures.VIEW}stream_{base}")
    return spark.sql(fixtures.over_views(fixtures.SQL[name], [base]).replace(fixtures.VIEW, f"{fixtures.VIEW}stream_"))


def _pdf_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = manifest.scan_manifest(_stream(spark, sf_dir, "lineitem", "manifest"), RAW_PREFIX)
    return files.select("load_id", "path", "length")


@query(with_tables("SELECT split_part(path, '/', 3) AS load_id, path, length FROM manifest WHERE lower(path) LIKE '%.pdf'", "manifest"))
def j1_ingest_incremental(spark, sf_dir):
    """Run twice over the same files; the second run must add nothing."""
    out, checkpoint = scratch_dir(spark, "j1") + "/table", scratch_dir(spark, "j1-checkpoint")
    for _ in range(2):
        ingest.ingest_incremental(_pdf_stream(spark, sf_dir), out, checkpoint)
    return spark.read.parquet(out)


@query(with_tables("SELECT split_part(path, '/', 3) AS load_id, min(path) AS path FROM manifest WHERE lower(path) LIKE '%.pdf' GROUP BY 1", "manifest"))
def j2_ingest_first_seen(spark, sf_dir):
    """One row per load, its first file by name."""
    out = scratch_dir(spark, "j2") + "/table"
    ingest.ingest_first_seen(_pdf_stream(spark, sf_dir), out, scratch_dir(spark, "j2-checkpoint"))
    return ingest.first_seen(spark, out).select("load_id", "path")


@query(with_tables("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, count(*) AS calls,
  cast(coalesce(sum(total_tokens), 0) AS BIGINT) AS tokens FROM usage_calls GROUP BY 1""", "usage_calls"))
def j3_throughput(spark, sf_dir):
    out = scratch_dir(spark, "j3") + "/table"
    calls = _stream(spark, sf_dir, "events", "usage_calls")
    throughput.run_throughput(calls, out, scratch_dir(spark, "j3-checkpoint"), "1 hour")
    rows = throughput.latest_windows(spark, out)
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))


@query(ORACLES["j3_throughput"])
def j3_late_rows(spark, sf_dir):
    """Calls in four files, each over the whole time: what comes late is kept and folded in."""
    out, calls = scratch_dir(spark, "j3-late"), fixtures.table(spark, sf_dir, "usage_calls").select("call_id", "ts", "total_tokens")
    calls.withColumn("turn", F.col("call_id") % 4).repartition(4, "turn").drop("turn").write.parquet(f"{out}/calls")
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/calls")
    throughput.run_throughput_keeping_late(stream, f"{out}/table", f"{out}/checkpoint", "10 minutes", "1 hour")
    rows = throughput.fold_late(spark, f"{out}/table", "1 hour")
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))
