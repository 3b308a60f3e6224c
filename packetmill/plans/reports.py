"""Usage, cost and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from packetmill.operators import profiles, usage
from packetmill.plans.fixtures import table, with_tables
from packetmill.plans.registry import query
from packetmill.session import scratch_dir
from packetmill.sources import readers, writers

_SUMS = """cast(coalesce(sum(ocr_pages) FILTER (WHERE NOT ocr_cached), 0) AS BIGINT) AS ocr_pages,
  cast(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS in_tokens, cast(coalesce(sum(candidate_tokens), 0) AS BIGINT) AS out_tokens,
  cast(coalesce(sum(thought_tokens), 0) AS BIGINT) AS think_tokens, cast(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens,
  count(*) FILTER (WHERE ocr_cached AND (finish_reason IS NULL OR finish_reason = 'STOP')) AS ocr_cache_hits,
  count(*) FILTER (WHERE coalesce(prompt_tokens, candidate_tokens, thought_tokens, total_tokens) IS NULL) AS no_usage_meta,
  count(*) FILTER (WHERE total_tokens <> 0 AND total_tokens NOT BETWEEN
    coalesce(prompt_tokens, 0) + coalesce(candidate_tokens, 0) + coalesce(thought_tokens, 0) - 1 AND
    coalesce(prompt_tokens, 0) + coalesce(candidate_tokens, 0) + coalesce(thought_tokens, 0) + 1) AS tally_mismatch,
  count(*) FILTER (WHERE finish_reason <> 'STOP') AS truncated"""
TALLY = f"tally AS (SELECT {_SUMS} FROM usage_calls)"


def _oracle(select: str) -> str:
    return with_tables(f"WITH {TALLY}\n{select}", "usage_calls", "run_results")


@query(_oracle("SELECT * FROM tally"))
def e9_usage_tally(spark, sf_dir):
    return usage.usage_tally(table(spark, sf_dir, "usage_calls"))


@query(with_tables(f"SELECT load_id, {_SUMS} FROM usage_calls GROUP BY load_id", "usage_calls"))
def e9_usage_tally_by_load(spark, sf_dir):
    return usage.usage_tally(table(spark, sf_dir, "usage_calls"), ["load_id"])


@query(_oracle("""SELECT round(ocr_cost, 6) AS ocr_cost, round(in_cost, 6) AS in_cost, round(out_cost, 6) AS out_cost, round(think_cost, 6) AS think_cost,
  round(ocr_cost + in_cost + out_cost + think_cost, 6) AS total_cost, processed,
  round((ocr_cost + in_cost + out_cost + think_cost) / processed, 8) AS per_packet, round((ocr_cost + in_cost + out_cost + think_cost) / processed * 17112, 4) AS projected
FROM (SELECT ocr_pages / cast(1000 AS double) * cast(1.5 AS double) AS ocr_cost,
        in_tokens / cast(1000000 AS double) * cast(0.3 AS double) AS in_cost,
        out_tokens / cast(1000000 AS double) * cast(2.5 AS double) AS out_cost,
        think_tokens / cast(1000000 AS double) * cast(2.5 AS double) AS think_cost,
        (SELECT count(*) FROM run_results WHERE status = 'ok') AS processed FROM tally)"""))
def e10_cost_summary(spark, sf_dir):
    processed = usage.succeeded(table(spark, sf_dir, "run_results")).scalar()
    cost = usage.cost_summary(usage.usage_tally(table(spark, sf_dir, "usage_calls")), processed)
    return cost.select(
        *[F.round(c, 6).alias(c) for c in ["ocr_cost", "in_cost", "out_cost", "think_cost", "total_cost"]],
        "processed", F.round("per_packet", 8).alias("per_packet"), F.round("projected", 4).alias("projected"),
    )


@query(_oracle("""SELECT *, total_tokens - priced_tokens AS drift, CASE WHEN total_tokens = 0 THEN 'SKIPPED'
  WHEN abs(total_tokens - priced_tokens) * 100 > greatest(10000, total_tokens) THEN 'UNPRICED' ELSE 'clean' END AS verdict,
  cast(no_usage_meta > 0 AS INTEGER) + cast(truncated > 0 AS INTEGER) + cast(tally_mismatch > 0 AS INTEGER) AS warnings
FROM (SELECT *, in_tokens + out_tokens + think_tokens AS priced_tokens FROM tally)"""))
def e11_usage_drift(spark, sf_dir):
    return usage.usage_drift(usage.usage_tally(table(spark, sf_dir, "usage_calls")))


@query(with_tables(f"""WITH t AS (SELECT load_id, {_SUMS} FROM usage_calls GROUP BY load_id),
p AS (SELECT *, in_tokens + out_tokens + think_tokens AS priced_tokens FROM t)
SELECT load_id, priced_tokens, total_tokens - priced_tokens AS drift, CASE WHEN total_tokens = 0 THEN 'SKIPPED'
  WHEN abs(total_tokens - priced_tokens) * 100 > greatest(10000, total_tokens) THEN 'UNPRICED' ELSE 'clean' END AS verdict FROM p""", "usage_calls"))
def e11_usage_drift_by_load(spark, sf_dir):
    drift = usage.usage_drift(usage.usage_tally(table(spark, sf_dir, "usage_calls"), ["load_id"]))
    return drift.select("load_id", "priced_tokens", "drift", "verdict")


@query(with_tables("""SELECT *, ok + failed + invalid AS done, round((ok + failed + invalid) / cast(3600 AS double) * 60, 6) AS per_minute,
  round((ok + failed + invalid) * cast(100 AS double) / total, 6) AS percent,
  round((total - ok - failed - invalid) * cast(3600 AS double) / (ok + failed + invalid), 6) AS eta_seconds
FROM (SELECT count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status IS NULL OR status = 'failed') AS failed,
        count(*) FILTER (WHERE status = 'invalid') AS invalid, (SELECT count(*) FROM manifest) AS total FROM run_results)""", "run_results"))
def e12_run_status(spark, sf_dir):
    """An hour into a run over everything the manifest lists."""
    total = table(spark, sf_dir, "manifest").agg(F.count("*").alias("n")).scalar()
    status = usage.run_status(table(spark, sf_dir, "run_results"), total, 3600.0)
    return status.select(
        "ok", "failed", "invalid", "done", "total",
        *[F.round(c, 6).alias(c) for c in ["per_minute", "percent", "eta_seconds"]],
    )


@query(with_tables("""SELECT load_id, status, detail FROM run_results WHERE status <> 'ok'
QUALIFY row_number() OVER (PARTITION BY status, load_id ORDER BY recorded DESC) = 1""", "run_results"))
def b3_write_quarantine(spark, sf_dir):
    """Two runs: one of the invalid files, then one of everything; the last reason must win."""
    out = scratch_dir(spark, "b3")
    results = table(spark, sf_dir, "run_results")
    writers.write_quarantine(results.filter("status = 'invalid'").withColumn("recorded", F.lit("")), out, "recorded")
    writers.write_quarantine(results, out, "recorded")
    return readers.read_quarantine(spark, out, "recorded").select("load_id", "status", "detail")


# Every column of the table.
FIELDS = [
    "load_id", "doc_seq", "doc_type_raw", "load_number", "rate_total", "line_haul", "fuel_surcharge", "weight", "weight_unit",
    "pallet_count", "pieces", "pieces_received", "miles", "pickup_date", "delivery_date", "broker_name", "carrier_name",
    "carrier_mc", "origin_state", "destination_state", "commodity", "equipment_type_raw", "is_signed_delivery_copy",
]


@query(with_tables(" UNION ALL ".join(
    f"""SELECT '{f}' AS field, count(*) AS n_rows, count(*) FILTER (WHERE {f} IS NULL) AS n_nulls,
  round(count(*) FILTER (WHERE {f} IS NULL) / cast(count(*) AS double), 6) AS null_share FROM freight_documents""" for f in FIELDS
), "freight_documents"))
def e14_null_profile(spark, sf_dir):
    return profiles.null_profile(table(spark, sf_dir, "freight_documents"))


@query(with_tables("SELECT equipment_type_raw AS value, count(*) AS n_rows FROM freight_documents GROUP BY 1", "freight_documents"))
def e15_value_profile(spark, sf_dir):
    return profiles.value_profile(table(spark, sf_dir, "freight_documents"), "equipment_type_raw")
