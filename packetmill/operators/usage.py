"""Usage, cost and run reports.

``calls`` is one row per model call: ``load_id, prompt_tokens, candidate_tokens, thought_tokens,
total_tokens, ocr_pages, ocr_cached, finish_reason`` and optionally ``tool_tokens``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prices in dollars, and the number of loads of a full backfill.
INPUT_PER_1M = 0.30
OUTPUT_PER_1M = 2.50
OCR_PER_1K_PAGES = 1.50
BACKFILL_LOADS = 17112
# Finish reasons of a complete answer; tolerated differences of token sums.
COMPLETE_REASONS = ["STOP", "FINISH_REASON_STOP"]
CALL_TOLERANCE = 1
RUN_TOLERANCE = 100
RUN_TOLERANCE_SHARE = 0.01


def _tokens(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def usage_tally(calls: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Token and page totals and warning counts, over everything or per key."""
    parts = ["prompt_tokens", "candidate_tokens", "thought_tokens"]
    parts += ["tool_tokens"] if "tool_tokens" in calls.columns else []
    reported = F.lit(False)
    for name in [*parts, "total_tokens"]:
        reported = reported | F.col(name).isNotNull()
    summed = sum((_tokens(p) for p in parts[1:]), _tokens(parts[0]))
    total = _tokens("total_tokens")
    truncated = (F.col("finish_reason") != "") & ~F.upper("finish_reason").isin(COMPLETE_REASONS)
    zero = F.lit(0).cast("bigint")
    return calls.groupBy(*(by or [])).agg(
        F.coalesce(F.sum(F.when(~F.col("ocr_cached"), F.col("ocr_pages").cast("bigint"))), zero).alias("ocr_pages"),
        F.coalesce(F.sum(_tokens("prompt_tokens")), zero).alias("in_tokens"),
        F.coalesce(F.sum(_tokens("candidate_tokens")), zero).alias("out_tokens"),
        F.coalesce(F.sum(_tokens("thought_tokens")), zero).alias("think_tokens"),
        F.coalesce(F.sum(total), zero).alias("total_tokens"),
        # A truncated call is rejected, so its packet does not count as served from the cache.
        _count_if(F.col("ocr_cached") & ~F.coalesce(truncated, F.lit(False))).alias("ocr_cache_hits"),
        _count_if(~reported).alias("no_usage_meta"),
        _count_if((total != 0) & (F.abs(total - summed) > CALL_TOLERANCE)).alias("tally_mismatch"),
        _count_if(truncated).alias("truncated"),
    )


def succeeded(results: DataFrame) -> DataFrame:
    """One row, ``processed``: the loads that ended well."""
    return results.agg(F.count_if(F.col("status") == "ok").alias("processed"))


def cost_summary(
    tally: DataFrame,
    processed: Column,
    input_per_1m: float = INPUT_PER_1M,
    output_per_1m: float = OUTPUT_PER_1M,
    ocr_per_1k: float = OCR_PER_1K_PAGES,
    backfill_loads: int = BACKFILL_LOADS,
) -> DataFrame:
    """Dollars by kind, per succeeded packet and projected on a backfill."""
    priced = tally.select(
        (F.col("ocr_pages") / 1000 * ocr_per_1k).alias("ocr_cost"),
        (F.col("in_tokens") / 1_000_000 * input_per_1m).alias("in_cost"),
        (F.col("out_tokens") / 1_000_000 * output_per_1m).alias("out_cost"),
        (F.col("think_tokens") / 1_000_000 * output_per_1m).alias("think_cost"),
        processed.cast("bigint").alias("processed"),
    ).withColumn("total_cost", F.col("ocr_cost") + F.col("in_cost") + F.col("out_cost") + F.col("think_cost"))
    return priced.withColumn(
        "per_packet", F.try_divide("total_cost", F.col("processed").cast("double"))
    ).withColumn("projected", F.col("per_packet") * backfill_loads)


def usage_drift(tally: DataFrame) -> DataFrame:
    """Compare the reported total with the priced tokens: SKIPPED, UNPRICED or clean."""
    priced = F.col("in_tokens") + F.col("out_tokens") + F.col("think_tokens")
    limit = F.greatest(F.lit(float(RUN_TOLERANCE)), F.lit(RUN_TOLERANCE_SHARE) * F.col("total_tokens"))
    verdict = (
        F.when(F.col("total_tokens") == 0, "SKIPPED")
        .when(F.abs("drift") > limit, "UNPRICED")
        .otherwise("clean")
    )
    warnings = sum(
        (F.when(F.col(c) > 0, 1).otherwise(0) for c in ["no_usage_meta", "truncated"]),
        F.when(F.col("tally_mismatch") > 0, 1).otherwise(0),
    )
    return tally.withColumn("priced_tokens", priced).withColumn(
        "drift", F.col("total_tokens") - F.col("priced_tokens")
    ).withColumn("verdict", verdict).withColumn("warnings", warnings)


def run_status(results: DataFrame, total: Column, elapsed_seconds: float) -> DataFrame:
    """Progress of a run: counts by outcome, percent, packets per minute, seconds to go."""
    counts = results.agg(
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.coalesce(~F.col("status").isin("ok", "invalid"), F.lit(True))).alias("failed"),
        F.count_if(F.col("status") == "invalid").alias("invalid"),
    )
    done = F.col("ok") + F.col("failed") + F.col("invalid")
    rated = counts.withColumn("done", done).withColumn("total", total.cast("bigint"))
    rate = F.col("done") / F.lit(float(elapsed_seconds)) if elapsed_seconds > 0 else F.lit(0.0)
    return (
        rated.withColumn("per_minute", rate * 60)
        .withColumn("percent", F.coalesce(F.try_divide(F.col("done") * 100.0, F.col("total")), F.lit(0.0)))
        .withColumn("eta_seconds", F.coalesce(F.try_divide(F.col("total") - F.col("done"), rate), F.lit(0.0)))
    )


def latest_results(results: DataFrame, order: str) -> DataFrame:
    """The last reason of each load within its outcome, as a later run overwrites an earlier one."""
    return results.groupBy("status", "load_id").agg(
        F.max_by("detail", F.col(order)).alias("detail"), F.max(order).alias(order)
    )
