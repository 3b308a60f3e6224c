"""From a listing of raw files to the list of loads still to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetmill.functions import ids, triage
from packetmill.operators.joins import join_summary
from packetmill.operators.ranking import with_position

# Fixed value: pages one synchronous OCR call accepts.
OCR_PAGE_LIMIT = 30


def scan_manifest(objects: DataFrame, prefix: str, suffix: str = ".pdf") -> DataFrame:
    """Files under the prefix with the suffix in any case, with their load id and sort key."""
    files = objects.filter(F.col("path").startswith(prefix) & ids.has_suffix(F.col("path"), suffix))
    load = ids.load_id(F.col("path"), prefix)
    return files.withColumn("load_id", load).withColumn("sort_key", ids.load_sort_key(load))


def with_triage(files: DataFrame) -> DataFrame:
    """Add ``status`` (ok or invalid) and ``reason``."""
    reason = triage.triage_reason(
        F.col("length"), F.col("openable"), F.col("needs_pass"), F.col("page_count")
    )
    return files.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), "ok").otherwise("invalid")
    )


def files_per_load(files: DataFrame) -> DataFrame:
    """``load_id, doc_count``; more than one marks a multi-file load."""
    return files.groupBy("load_id").agg(F.count("*").alias("doc_count"))


def multi_loads(files: DataFrame) -> DataFrame:
    return files_per_load(files).filter("doc_count > 1")


def done_from_listing(outputs: DataFrame, prefix: str, suffix: str = ".json") -> DataFrame:
    """Load ids that own an output object ``<prefix><load_id>.json``."""
    path = F.col("path")
    name = F.substr(path, F.lit(len(prefix) + 1))
    return (
        outputs.filter(path.startswith(prefix) & path.endswith(suffix))
        .select(F.substr(name, F.lit(1), F.length(name) - len(suffix)).alias("load_id"))
        .distinct()
    )


def worklist(files: DataFrame, done: DataFrame) -> DataFrame:
    """The one file of every load that has exactly one and no output yet.

    One grouping finds the single-file loads and their file together, so a load with a huge
    number of files shrinks to one row per task before the exchange.
    """
    single = (
        files.groupBy("load_id")
        .agg(F.count("*").alias("doc_count"), F.min("path").alias("path"))
        .filter("doc_count = 1")
        .select("load_id", "path", ids.load_sort_key(F.col("load_id")).alias("sort_key"))
    )
    return single.join(done.select("load_id"), "load_id", "left_anti")


def ordered_worklist(work: DataFrame, newest_first: bool = False) -> DataFrame:
    """By numeric load id; files of equal key stay in name order in both directions."""
    key = F.col("sort_key").desc() if newest_first else F.col("sort_key").asc()
    return work.orderBy(key, F.col("path").asc())


def positioned_worklist(work: DataFrame, newest_first: bool = False) -> DataFrame:
    """The ordered list as a table: every entry with its ``position`` from 1."""
    key = F.col("sort_key").desc() if newest_first else F.col("sort_key").asc()
    return with_position(work, key, F.col("path").asc())


def limited_worklist(work: DataFrame, n: int | None, newest_first: bool = False) -> DataFrame:
    """The first n entries of the ordered list; all of them when n is None."""
    ordered = ordered_worklist(work, newest_first)
    return ordered if n is None else ordered.limit(n)


def skip_report(files: DataFrame, done: DataFrame) -> DataFrame:
    """Loads and files by outcome: ``done``, ``multi`` (not done, several files) or ``todo``."""
    per_load = files_per_load(files).join(done.select("load_id", F.lit(True).alias("is_done")), "load_id", "left")
    outcome = (
        F.when(F.col("is_done"), "done").when(F.col("doc_count") > 1, "multi").otherwise("todo")
    )
    return per_load.groupBy(outcome.alias("outcome")).agg(
        F.count("*").alias("loads"), F.sum("doc_count").alias("files")
    )


def multi_csv_rows(files: DataFrame) -> DataFrame:
    """``folder, doc_count`` of the multi-file loads, sorted by folder name."""
    return multi_loads(files).select(F.col("load_id").alias("folder"), "doc_count").orderBy("folder")


def multi_manifest_lines(files: DataFrame) -> DataFrame:
    """Text lines: a heading per multi-file load, then its files, in load and name order.

    Returns the sort columns too; ``line`` is what is written.
    """
    multi = multi_loads(files)
    heading = multi.select(
        "load_id",
        F.lit("").alias("file"),
        F.concat("load_id", F.lit(" ("), F.col("doc_count").cast("string"), F.lit(" PDFs)")).alias("line"),
    )
    listed = join_summary(files.select("load_id", "path"), multi.select("load_id"), ["load_id"], "left_semi")
    entries = listed.select("load_id", F.col("path").alias("file"), F.concat(F.lit("    "), "path").alias("line"))
    return heading.unionByName(entries).orderBy("load_id", "file")


def page_chunks(files: DataFrame, limit: int = OCR_PAGE_LIMIT) -> DataFrame:
    """Inclusive 0-based page chunks of at most ``limit`` pages; one row per chunk."""
    n = F.col("page_count").cast("bigint")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(limit).cast("bigint")))
    rows = files.filter("page_count > 0").withColumn("start_page", starts)
    return rows.withColumn("end_page", F.least(F.col("start_page") + limit, n) - 1).withColumn(
        "chunk_no", F.floor(F.col("start_page") / limit).cast("bigint")
    )
