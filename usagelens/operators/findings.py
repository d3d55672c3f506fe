"""Reports behind the published findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import exact_total, in_range, percent, round_to, to_timestamp
from usagelens.functions.joins import rollup_by_employee
from usagelens.functions.quantiles import mean, mean_of, quantiles
from usagelens.operators import metrics
from usagelens.schemas import Star, TelemetryError

# The model families told apart in cost reports.
FAMILIES = ("opus", "sonnet", "haiku")
SENIOR_LEVEL = 7
HOUR_MS = 3600 * 1000


def cost_by_model_family(star: Star, pattern: str = "|".join(FAMILIES)) -> DataFrame:
    """Cost, request share and cost per request by the part of the model name `pattern` finds."""
    found = F.regexp_extract("model", f"({pattern})", 1)
    per_family = star.fact_api_requests.groupBy(F.nullif(found, F.lit("")).alias("family")).agg(
        F.count(F.lit(1)).alias("request_count"), exact_total(F.col("cost_usd")).alias("total_cost")
    )
    totals = per_family.agg(
        F.sum("request_count").alias("__requests"), F.sum("total_cost").alias("__cost")
    )
    return (
        per_family.crossJoin(F.broadcast(totals))  # one row
        .select(
            "family",
            "request_count",
            "total_cost",
            percent(F.col("request_count"), F.col("__requests")).alias("request_share_pct"),
            round_to(
                F.col("total_cost") * 100.0 / F.nullif(F.col("__cost"), F.lit(0.0)), 1
            ).alias("cost_share_pct"),
            round_to(F.col("total_cost") / F.col("request_count"), 4).alias("cost_per_request"),
        )
        .orderBy(F.desc_nulls_last("total_cost"), F.asc_nulls_last("family"))
    )


def errors_by_hour(star: Star, by: str = "window") -> DataFrame:
    """Errors, 429s, requests and error rate per hour.

    by="window" takes hours along the time line, by="hour_of_day" adds up all days. Events without
    a time form a group of their own.
    """
    ms = in_range(F.col("epoch_ms"))
    if by == "window":
        slot = to_timestamp(ms - F.pmod(ms, F.lit(HOUR_MS))).alias("hour_start")
    elif by == "hour_of_day":
        slot = F.floor(F.pmod(ms, F.lit(24 * HOUR_MS)) / HOUR_MS).cast("int").alias("hour_of_day")
    else:
        raise TelemetryError(f"unknown grouping '{by}': use 'window' or 'hour_of_day'")
    name = "hour_start" if by == "window" else "hour_of_day"
    errors = star.fact_api_errors.select(slot, "status_code", F.lit(True).alias("is_error"))
    requests = star.fact_api_requests.select(
        slot, F.lit(None).cast("int").alias("status_code"), F.lit(False).alias("is_error")
    )
    failed, total = F.count_if(F.col("is_error")), F.count(F.lit(1))
    return (
        errors.unionByName(requests)
        .groupBy(name)
        .agg(
            failed.alias("error_count"),
            F.count_if(F.col("status_code") == 429).alias("rate_limit_count"),
            F.count_if(~F.col("is_error")).alias("request_count"),
            percent(failed, total).alias("error_rate_pct"),
        )
        .orderBy(F.asc_nulls_last(name))
    )


def prompt_length_by_level(star: Star) -> DataFrame:
    """Prompt lengths below L7 and from L7 up; levels that are no L<n> form a band of their own."""
    number = metrics.level_number()
    band = F.when(number >= SENIOR_LEVEL, "L7+").when(number < SENIOR_LEVEL, "below L7")
    dim = star.dim_employees.withColumn("level_band", F.coalesce(band, F.lit("other")))
    lengths = star.fact_user_prompts.filter(F.col("prompt_length") > 0)
    # frequency of each length per user, then per band: a hot user is reduced before the join
    per_user = lengths.filter(F.col("user_email").isNotNull()).groupBy(
        "user_email", "prompt_length"
    ).agg(F.count(F.lit(1)).alias("n"))
    members = dim.select("email", "level_band")
    counts = (
        per_user.join(members, per_user["user_email"] == members["email"])
        .groupBy("level_band", "prompt_length")
        .agg(F.sum("n").alias("n"))
    )
    out = quantiles(
        counts,
        ["level_band"],
        "prompt_length",
        {"p50_length": 0.5, "p90_length": 0.9},
        {"prompt_count": (F.sum, F.col("n"))} | mean_of("prompt_length"),
    )
    return out.select(
        "level_band",
        "prompt_count",
        round_to(mean(), 1).alias("avg_length"),
        "p50_length",
        "p90_length",
    ).orderBy("level_band")


def prompts_per_session_by_practice(star: Star) -> DataFrame:
    sessions = metrics.prompts_per_session(star)
    return (
        rollup_by_employee(
            sessions,
            star.dim_employees,
            "practice",
            per_user=[F.count(F.lit(1)).alias("__sessions"), F.sum("prompt_count").alias("__prompts")],
            final=[
                F.sum("__sessions").alias("session_count"),
                F.sum("__prompts").alias("prompt_count"),
                round_to(F.sum("__prompts") / F.sum("__sessions"), 2).alias("avg_prompts_per_session"),
            ],
        )
        .orderBy(F.asc_nulls_last("practice"))
    )


def reject_rate_by_practice(star: Star) -> DataFrame:
    decided = star.fact_tool_usage.filter(F.col("decision") != "")
    return rollup_by_employee(
        decided,
        star.dim_employees,
        "practice",
        per_user=[
            F.count(F.lit(1)).alias("__rows"),
            F.count_if(F.col("decision") == "reject").alias("__rejects"),
        ],
        final=[
            F.sum("__rows").alias("decision_count"),
            F.sum("__rejects").alias("reject_count"),
            percent(F.sum("__rejects"), F.sum("__rows")).alias("reject_rate_pct"),
        ],
    ).orderBy(F.asc_nulls_last("practice"))


def cache_savings_by_practice(star: Star) -> DataFrame:
    """Tokens written to and read from the cache, and reads per token written."""
    return rollup_by_employee(
        star.fact_api_requests,
        star.dim_employees,
        "practice",
        per_user=[
            F.sum("cache_creation_tokens").alias("__created"),
            F.sum("cache_read_tokens").alias("__read"),
        ],
        final=[
            F.sum("__created").alias("cache_creation_tokens"),
            F.sum("__read").alias("cache_read_tokens"),
            round_to(F.sum("__read") / F.nullif(F.sum("__created"), F.lit(0)), 2).alias(
                "reads_per_created"
            ),
        ],
    ).orderBy(F.asc_nulls_last("practice"))
