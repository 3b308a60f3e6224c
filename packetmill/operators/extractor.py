"""The pluggable extraction step."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetmill import schemas
from packetmill.operators.conformance import packet_faults
from packetmill.operators.joins import join_summary
from packetmill.session import stored

WAVE_ROWS = 10_000


@dataclass(frozen=True)
class Ledger:
    """Where the answers of paid calls are kept, by version of the extractor.

    Rows are called in waves of about ``wave_rows``; a wave's answers are written before the next
    one starts, and rows with an answer are never called again. So a run that is stopped, or a task
    that is tried again, repeats the calls of one wave at most. Calls that failed are kept with
    their reason and called again by the next run.
    """

    path: str
    version: str = "v1"
    wave_rows: int = WAVE_ROWS

    @property
    def folder(self) -> str:
        return f"{self.path}/version={self.version}"

    def rows(self, spark) -> DataFrame | None:
        """``load_id, part_no, run, wave, _error, _json`` of all calls of this version so far."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/run=*")
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        if not found:
            return None
        schema = "load_id string, part_no int, _error string, _json string, run string, wave int"
        return spark.read.schema(schema).option("basePath", self.folder).parquet(f"{self.folder}/run=*")


def _answers(inputs: DataFrame, extract: Callable[[dict], dict | str], keys: list[str]) -> DataFrame:
    """The keys, the answer as JSON text, and the error of each call."""
    schema = T.StructType([
        *[inputs.schema[k] for k in keys], T.StructField("_error", T.StringType()), T.StructField("_json", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors, answers = [], []
            for row in batch.to_dict("records"):
                try:
                    answer = extract(row)
                    answers.append(answer if isinstance(answer, str) else json.dumps(answer))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - one bad row must not end the job
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield batch[keys].assign(_error=errors, _json=answers)

    return inputs.mapInPandas(run, schema)


def _ledgered(inputs: DataFrame, extract: Callable[[dict], dict | str], keys: list[str], ledger: Ledger) -> DataFrame:
    """The answers of ``_answers``, from the ledger where it has them, called in waves where not."""
    spark, run = inputs.sparkSession, uuid.uuid4().hex
    part = F.col("part_no").cast("int") if "part_no" in inputs.columns else F.lit(0)
    asked = inputs.select(F.col("load_id").cast("string").alias("load_id"), part.alias("part_no"))

    def answered() -> DataFrame | None:
        rows = ledger.rows(spark)
        return None if rows is None else rows.filter("_error IS NULL").select("load_id", "part_no").distinct()

    known = answered()
    open_keys = asked if known is None else asked.join(known, ["load_id", "part_no"], "left_anti")
    open_keys = stored(open_keys.distinct(), "open-calls")  # keys only, fixed for the whole run
    n = open_keys.count()
    waves = max(1, math.ceil(n / ledger.wave_rows))
    keyed = inputs.withColumns({"_load": F.col("load_id").cast("string"), "_part": part})
    now = open_keys.select(F.col("load_id").alias("_load"), F.col("part_no").alias("_part"))
    waiting = join_summary(keyed, now, ["_load", "_part"], "left_semi")
    waiting = waiting.withColumn("_wave", F.pmod(F.xxhash64("_load", "_part"), F.lit(waves)).cast("int"))
    if waves > 1:  # one folder a wave, so that no wave reads the others' rows
        waiting = stored(waiting, "waves", "_wave")
    for i in range(waves if n else 0):
        rows = waiting.filter(F.col("_wave") == i).select(*inputs.columns)
        rows = rows.repartition(spark.sparkContext.defaultParallelism) if waves > 1 else rows
        answers = _answers(rows, extract, keys)
        told = part if "part_no" in keys else F.lit(0)
        answers.select(F.col("load_id").cast("string").alias("load_id"), told.alias("part_no"), "_error", "_json").write.parquet(
            f"{ledger.folder}/run={run}/wave={i}")
    rows = ledger.rows(spark)
    if rows is None:
        return _answers(inputs.limit(0), extract, keys)
    # An answer counts before any failure, and of failures the one of this run.
    best = F.max_by(F.struct("_error", "_json"), F.struct(F.col("_error").isNull(), F.col("run") == run, "run")).alias("r")
    best = rows.groupBy("load_id", "part_no").agg(best).select("load_id", "part_no", "r.*")
    best = join_summary(best, asked.distinct(), ["load_id", "part_no"], "left_semi")
    kinds = {f.name: f.dataType for f in inputs.schema if f.name in keys}
    return best.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys], "_error", "_json")


def apply_extractor(inputs: DataFrame, extract: Callable[[dict], dict | str], ledger: Ledger | None = None) -> DataFrame:
    """Call ``extract`` on every row; ``load_id, part_no, status, detail, packet`` come back.

    ``extract`` gets the row as a dict and returns the packet as a dict or as JSON text. A call that
    raises, an answer that is no packet, and a packet that breaks a declared rule make the load
    ``failed`` with the whole reason; other loads are not affected. Rows stream through in Arrow
    batches.

    A load whose text comes in several parts (``part_no``) is one load: it fails if any part does,
    with the reason of the first such part, and its documents are numbered through all parts in
    ``doc_seq``. Accepted packets have the declared types and carry the load's own id.

    With a ``ledger`` answers are kept over runs and rows that have one are not called again.
    """
    parted = "part_no" in inputs.columns
    keys = ["load_id", "part_no"] if parted else ["load_id"]
    read_schema = T.StructType([*schemas.lenient(schemas.PACKET).fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    answers = _answers(inputs, extract, keys) if ledger is None else _ledgered(inputs, extract, keys, ledger)
    read = answers.withColumn("_packet", F.from_json("_json", read_schema, options))
    misfit = F.col("_packet").isNull() | F.col("_packet._corrupt_record").isNotNull()
    fault = F.get(packet_faults(F.col("_packet")), F.lit(0))
    judged = read.withColumn("_fault", F.when(F.col("_error").isNotNull(), F.col("_error")).when(
        misfit, F.lit("answer does not fit the schema")).otherwise(fault))
    part = F.col("part_no") if parted else F.lit(0)
    judged = judged.select("load_id", part.cast("int").alias("part_no"), "_fault", "_packet").withColumn(
        "_n", F.coalesce(F.size("_packet.documents"), F.lit(0)))

    # A load has one part per thousand pages, so these windows are short.
    whole = Window.partitionBy("load_id")
    before = whole.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    reason = F.min(F.when(F.col("_fault").isNotNull(), F.struct("part_no", "_fault"))).over(whole)["_fault"]
    first = F.coalesce(F.sum("_n").over(before), F.lit(0))
    judged = judged.withColumns({"detail": reason, "_first": first})
    packet = schemas.as_declared(F.col("_packet"), schemas.PACKET)
    documents = F.transform(packet["documents"], lambda d, i: d.withField("doc_seq", (F.col("_first") + i + 1).cast("int")).withField(
        "continued", F.lit(None).cast("boolean")).withField("n_stops", F.lit(None).cast("int")).withField("n_accessorials", F.lit(None).cast("int")))
    own = packet.withField("load_id", F.col("load_id")).withField("part_no", F.col("part_no")).withField("documents", documents)
    failed = F.col("detail").isNotNull()
    return judged.select(
        "load_id", "part_no", F.when(failed, "failed").otherwise("ok").alias("status"), "detail",
        F.when(~failed, own).alias("packet"))


def load_results(results: DataFrame) -> DataFrame:
    """``load_id, status, detail``: one row per load, whatever its number of parts."""
    return results.groupBy("load_id").agg(F.max("status").alias("status"), F.max("detail").alias("detail"))


def packets_of(results: DataFrame) -> DataFrame:
    """The accepted packets as bronze records."""
    return results.filter("status = 'ok'").select("packet.*")
