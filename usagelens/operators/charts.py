"""The aggregates behind the dashboard's charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import percent
from usagelens.functions.quantiles import histogram, mean, mean_of, quantiles, value_counts
from usagelens.operators import metrics
from usagelens.schemas import Star


def errors_by_status(star: Star, keep_null_status: bool = False) -> DataFrame:
    """Errors per status code; a user who saw two messages counts twice in affected_users.

    Errors without a numeric status are left out unless `keep_null_status` is set.
    """
    errors = star.fact_api_errors
    if not keep_null_status:
        errors = errors.filter(F.col("status_code").isNotNull())
    return (
        errors.groupBy("status_code", "error_message")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_email").alias("users"))
        .groupBy("status_code")
        .agg(F.sum("n").alias("error_count"), F.sum("users").alias("affected_users"))
        .orderBy(F.asc_nulls_last("status_code"))
    )


def _turn_counts(star: Star) -> DataFrame:
    return value_counts(metrics.prompts_per_session(star), [], "prompt_count")


def prompts_per_session_stats(star: Star) -> DataFrame:
    counts, probs = _turn_counts(star), {"median_prompts": 0.5}
    stats = quantiles(counts, [], "prompt_count", probs, mean_of("prompt_count"))
    # at most one row; the aggregate makes it one when there are no sessions
    return stats.agg(
        F.max(mean()).alias("avg_prompts"), F.max("median_prompts").alias("median_prompts")
    )


def session_turn_histogram(star: Star, max_bins: int = 30) -> DataFrame:
    return histogram(_turn_counts(star), "prompt_count", max_bins)


def prompt_length_avg(star: Star) -> DataFrame:
    return metrics.prompt_length_distribution(star).agg(
        F.avg("prompt_length").alias("avg_prompt_length")
    )


def prompt_length_histogram(star: Star, max_bins: int = 50) -> DataFrame:
    counts = value_counts(metrics.prompt_length_distribution(star), [], "prompt_length")
    return histogram(counts, "prompt_length", max_bins)


BOX = {"min_ms": 0.0, "q1_ms": 0.25, "median_ms": 0.5, "q3_ms": 0.75, "max_ms": 1.0}


def latency_box_stats(star: Star, multiplier: float = 1.5) -> DataFrame:
    """Five-number summary, whisker ends and outlier count per tool.

    Whiskers end at the outermost values within `multiplier` interquartile ranges of the box. Boxes
    and counts come from the same value counts, computed once, so the calls are scanned once.
    """
    rows = metrics.tool_latency_distribution(star)
    counts = value_counts(rows, ["tool_name"], "duration_ms")
    reach = f"{float(multiplier)!r}D * (q3_ms - q1_ms)"
    boxes = quantiles(counts, ["tool_name"], "duration_ms", BOX).selectExpr(
        "tool_name AS tool", *BOX, f"q1_ms - {reach} AS low", f"q3_ms + {reach} AS high"
    )
    placed = counts.join(boxes, F.col("tool_name").eqNullSafe(F.col("tool")))
    within = F.col("duration_ms").between(F.col("low"), F.col("high"))
    return (
        placed.groupBy("tool_name", *BOX)
        .agg(
            F.min(F.when(within, F.col("duration_ms"))).alias("lower_whisker_ms"),
            F.max(F.when(within, F.col("duration_ms"))).alias("upper_whisker_ms"),
            F.coalesce(F.sum(F.when(~within, F.col("n"))), F.lit(0)).alias("outlier_count"),
        )
        .orderBy(F.asc_nulls_last("tool_name"))
    )


def request_share_by_model(star: Star) -> DataFrame:
    per_model = star.fact_api_requests.groupBy("model").agg(
        F.count(F.lit(1)).alias("request_count")
    )
    total = per_model.agg(F.sum("request_count").alias("total"))
    return (
        per_model.crossJoin(F.broadcast(total))  # one row
        .select(
            "model",
            "request_count",
            percent(F.col("request_count"), F.col("total")).alias("request_share_pct"),
        )
        .orderBy(F.desc("request_count"), F.asc_nulls_last("model"))
    )
