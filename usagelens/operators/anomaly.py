"""Statistical outliers: z-score on request cost, interquartile range on tool latency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import exact_total, round_to, utc_text
from usagelens.functions.joins import hint_if_small, settle
from usagelens.functions.moments import moments, statistics
from usagelens.functions.quantiles import quantiles, value_counts
from usagelens.operators import metrics
from usagelens.schemas import Star


def _seconds(ms):
    return round_to(ms / F.lit(1000.0), 2)


def cost_moments(star: Star) -> DataFrame:
    """Count, exact sum and exact squares of the positive request costs, in one scan."""
    return moments(star.fact_api_requests, F.col("cost_usd"))


def flagged_costs(requests: DataFrame, known: DataFrame, z_threshold: float) -> DataFrame:
    """The requests whose cost is `z_threshold` deviations above the mean of the moments `known`, with `__z`."""
    stats = statistics(known).select(F.col("mean").alias("__mean"), F.col("std").alias("__std"))
    z = (F.col("cost_usd") - F.col("__mean")) / F.nullif(F.col("__std"), F.lit(0.0))
    positive = requests.filter(F.col("cost_usd") > 0)
    scored = positive.crossJoin(F.broadcast(stats)).withColumn("__z", z)  # one row
    return scored.filter(F.col("__z") >= z_threshold)


def _flagged_costs(star: Star, z_threshold: float, known: DataFrame | None = None) -> DataFrame:
    return flagged_costs(star.fact_api_requests, known or cost_moments(star), z_threshold)


def described_costs(flagged: DataFrame) -> DataFrame:
    """The public columns of flagged requests."""
    return flagged.select(
        "epoch_ms",
        utc_text(F.col("epoch_ms")).alias("timestamp"),
        "user_email",
        "model",
        round_to(F.col("cost_usd"), 4).alias("cost_usd"),
        "duration_ms",
        _seconds(F.col("duration_ms")).alias("duration_sec"),
        round_to(F.col("__z"), 2).alias("z_score"),
        "session_id",
    )


def cost_anomalies(
    star: Star, z_threshold: float = 3.0, known: DataFrame | None = None
) -> DataFrame:
    """Requests at least `z_threshold` sample standard deviations above the mean positive cost.

    Mean and deviation come from moments that do not depend on row order or partitioning: those of the star's
    requests, or `known` ones, such as the stored ones of `sources.sidetables.COST_MOMENTS`, which save the scan.
    """
    flagged = _flagged_costs(star, z_threshold, known)
    order = [F.desc("cost_usd"), *map(F.asc_nulls_last, ["epoch_ms", "user_email", "session_id", "model"])]
    return described_costs(flagged.orderBy(*order))


def latency_bounds(star: Star, iqr_multiplier: float = 1.5) -> DataFrame:
    """Upper latency limit per tool, from exact quartiles of positive durations."""
    rows = metrics.tool_latency_distribution(star)
    counts = value_counts(rows, ["tool_name"], "duration_ms")
    quartiles = quantiles(counts, ["tool_name"], "duration_ms", {"q1": 0.25, "q3": 0.75})
    limit = F.col("q3") + F.lit(float(iqr_multiplier)) * (F.col("q3") - F.col("q1"))
    return quartiles.select(F.col("tool_name").alias("__tool"), limit.alias("__limit"))


def latency_anomalies(
    star: Star, iqr_multiplier: float = 1.5, limit: int | None = None
) -> DataFrame:
    """Tool calls above their tool's limit, longest first; `limit` keeps the longest only.

    The limits are computed first (a few rows, one per tool): their counted size decides whether
    they may be broadcast to the facts.
    """
    limits = hint_if_small(settle(latency_bounds(star, iqr_multiplier)))
    calls = star.fact_tool_usage.filter(F.col("duration_ms") > 0)
    over = calls.join(limits, F.col("tool_name") == F.col("__tool")).filter(
        F.col("duration_ms") > F.col("__limit")
    )
    order = [
        F.desc("duration_ms"),
        *map(F.asc_nulls_last, ["epoch_ms", "user_email", "tool_name", "session_id"]),
    ]
    ranked = over.orderBy(*order)
    if limit is not None:
        ranked = ranked.limit(limit)
    return ranked.select(
        "epoch_ms",
        utc_text(F.col("epoch_ms")).alias("timestamp"),
        "user_email",
        "tool_name",
        "duration_ms",
        _seconds(F.col("duration_ms")).alias("duration_sec"),
        _seconds(F.col("__limit")).alias("threshold_sec"),
        "session_id",
    )


def anomaly_summary(star: Star, known: DataFrame | None = None) -> DataFrame:
    """Counts and extremes of both detectors, over all they find, aggregated where the data is.

    With stored moments as `known` the requests are scanned once.
    """
    costs = _flagged_costs(star, 3.0, known).agg(
        F.count(F.lit(1)).alias("cost_anomaly_count"),
        round_to(
            F.coalesce(exact_total(round_to(F.col("cost_usd"), 4)), F.lit(0.0)), 2
        ).alias("total_anomalous_cost_usd"),
    )
    latencies = latency_anomalies(star).agg(
        F.count(F.lit(1)).alias("latency_anomaly_count"),
        round_to(F.coalesce(F.max("duration_sec"), F.lit(0.0)), 1).alias("max_latency_sec"),
    )
    return costs.crossJoin(F.broadcast(latencies))  # one row each


def top_cost_anomalies(
    star: Star, n: int = 50, z_threshold: float = 3.0, known: DataFrame | None = None
) -> DataFrame:
    return cost_anomalies(star, z_threshold, known).limit(n)


def top_latency_anomalies(star: Star, n: int = 15, iqr_multiplier: float = 1.5) -> DataFrame:
    return latency_anomalies(star, iqr_multiplier, limit=n)
