"""Counts of what did not load cleanly. Rows are counted here, never removed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import exact_total, to_date
from usagelens.operators.facts import safe_cast
from usagelens.schemas import BODIES, FACT_TABLES, DuplicateKeyError, Star

REQUIRED_REQUEST_NUMBERS = ("cost_usd", "duration_ms", "input_tokens", "output_tokens")


def _any_null(names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def reject_counts(star: Star) -> DataFrame:
    return star.fact_api_requests.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_any_null(REQUIRED_REQUEST_NUMBERS)).alias("rejected_rows"),
    )


def tool_usage_counts(star: Star) -> DataFrame:
    return star.fact_tool_usage.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("decision") != "").alias("decision_rows"),
        F.count_if(F.col("is_success").isNotNull()).alias("result_rows"),
    )


def null_status_count(star: Star) -> DataFrame:
    return star.fact_api_errors.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("status_code").isNull()).alias("null_status_rows"),
    )


def null_prompt_count(star: Star) -> DataFrame:
    return star.fact_user_prompts.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("prompt_length").isNull()).alias("null_length_rows"),
    )


def orphan_emails(star: Star) -> DataFrame:
    """Distinct (table, email) pairs in the facts without an employee.

    Emails are made distinct first, so a user with many rows is shuffled to the join once. Where the
    dimension is small enough to broadcast, Spark looks the emails up before that instead.
    """
    used = [star.table(t).select(F.lit(t).alias("table_name"), "user_email") for t in FACT_TABLES]
    pairs = reduce(DataFrame.unionByName, used).filter(F.col("user_email") != "").distinct()
    known = star.dim_employees.select("email")
    return pairs.join(known, pairs["user_email"] == known["email"], "left_anti")


def orphan_counts(star: Star) -> DataFrame:
    return orphan_emails(star).groupBy("table_name").agg(F.count(F.lit(1)).alias("orphan_count"))


def dim_key_violations(dim: DataFrame) -> DataFrame:
    """Emails that are missing or occur more than once."""
    counts = dim.groupBy("email").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter((F.col("row_count") > 1) | F.col("email").isNull())


def require_unique_dim(dim: DataFrame) -> DataFrame:
    bad = dim_key_violations(dim).limit(5).collect()
    if bad:
        emails = [row["email"] for row in bad]
        raise DuplicateKeyError(f"dim_employees has missing or repeated emails: {emails}")
    return dim


def row_counts(star: Star) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in star.tables().items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def event_counts_by_body(stg: DataFrame) -> DataFrame:
    return (
        stg.groupBy("body")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), F.asc_nulls_last("body"))
    )


def event_totals(stg: DataFrame) -> DataFrame:
    """Event count, simulated cost of all requests, first and last day."""
    cost = F.when(F.col("body") == BODIES["api_request"], F.expr(safe_cast("cost_usd")))
    day = to_date(F.col("epoch_ms"))
    return stg.select(cost.alias("cost_usd"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.coalesce(exact_total(F.col("cost_usd")), F.lit(0.0)).alias("total_cost"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def unknown_body_counts(stg: DataFrame) -> DataFrame:
    """Events whose body names no known kind, including events without a body."""
    known = F.coalesce(F.col("body").isin(list(BODIES.values())), F.lit(False))
    return event_counts_by_body(stg.filter(~known))
