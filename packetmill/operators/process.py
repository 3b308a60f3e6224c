"""One run over the files: from the worklist to bronze records, quarantine and run results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetmill import schemas
from packetmill.operators import extractor, manifest, verify
from packetmill.operators import pages as page_ops

NO_TEXT = "no page text"


@dataclass
class Run:
    """What a run leaves behind; all tables are plans over what it stored."""

    bronze: DataFrame       # records with computed confidence and unverified fields
    results: DataFrame      # load_id, status, detail: one row per load of the worklist
    quarantine: DataFrame   # the invalid and failed ones of them
    new_pages: DataFrame    # pages that the OCR cache lacked


def _score(packets: DataFrame, pages: DataFrame) -> DataFrame:
    """The records with ``ocr_confidence`` and ``unverified_fields`` of every document filled in."""
    rows = packets.select("load_id", "part_no", F.explode("documents").alias("doc"))
    fields = ["doc_seq", "page_range", *schemas.KEY_FIELDS, *schemas.EVIDENCE_FIELDS.values()]
    docs = rows.select("load_id", *[F.col(f"doc.{f}").alias(f) for f in fields])
    scored = verify.check_documents(docs, pages).select("load_id", "doc_seq", "ocr_confidence", "unverified_fields")
    numbered = rows.withColumn("doc_seq", F.col("doc.doc_seq")).join(scored, ["load_id", "doc_seq"], "left")
    doc = F.col("doc").withField("ocr_confidence", F.col("ocr_confidence")).withField("unverified_fields", F.col("unverified_fields"))
    ordered = F.array_sort(F.collect_list(F.struct("doc_seq", doc.alias("doc"))))
    documents = numbered.groupBy("load_id", "part_no").agg(F.transform(ordered, lambda x: x["doc"]).alias("_documents"))
    kept = packets.join(documents, ["load_id", "part_no"], "left")
    none = F.array().cast(schemas.PACKET["documents"].dataType)
    return kept.withColumn("documents", F.coalesce("_documents", none)).select(*[f.name for f in schemas.PACKET])


def process(files: DataFrame, pages: DataFrame, cache: DataFrame | None, done: DataFrame,
            extract: Callable[[dict], dict | str], scratch: str, ledger: extractor.Ledger | None = None) -> Run:
    """Process every load that has one file and no record yet.

    ``files``: the scanned manifest; ``pages``: OCR pages as the service returns them, used where
    ``cache`` lacks a load; ``done``: load ids with a record. A file that fails triage is invalid; a
    load without page text, whose extraction raises or whose packet breaks a rule, is failed; one
    load never affects another. The extractor's answers are stored under ``scratch`` before anything
    reads them, so it is called once per load however many tables are used. With a ``ledger`` a run
    that follows one that was stopped goes on where that one was.
    """
    spark = files.sparkSession
    work = manifest.worklist(files, done).select("load_id", "path")
    checked = manifest.with_triage(files.join(work, ["load_id", "path"], "left_semi"))
    loads = checked.filter("status = 'ok'").select("load_id", F.col("path").alias("source_pdf"))
    if cache is None:
        known, missing = pages.limit(0), loads
    else:
        known, missing = page_ops.cached_pages(loads, cache), page_ops.cache_misses(loads, cache)
    new_pages = page_ops.cached_pages(missing, pages)
    all_pages = known.unionByName(new_pages)

    answers = extractor.apply_extractor(page_ops.marked_text(all_pages), extract, ledger)
    answers.write.mode("overwrite").parquet(f"{scratch}/answers")
    answers = spark.read.parquet(f"{scratch}/answers")
    per_load = loads.join(extractor.load_results(answers), "load_id", "left")
    results = checked.filter("status = 'invalid'").select("load_id", "status", F.col("reason").alias("detail")).unionByName(
        per_load.select(
            "load_id", F.coalesce("status", F.lit("failed")).alias("status"),
            F.when(F.col("status").isNull(), F.lit(NO_TEXT)).otherwise(F.col("detail")).alias("detail")))
    packets = extractor.packets_of(answers).drop("source_pdf").join(loads, "load_id")
    bronze = _score(packets.select(*[f.name for f in schemas.PACKET]), all_pages)
    return Run(bronze, results, results.filter("status <> 'ok'"), new_pages)
