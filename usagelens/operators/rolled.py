"""The KPIs and grouped metrics again, from the roll-ups kept beside a star instead of its facts.

A roll-up has a row for each part, day, user and what else the reports group by; totals are exact decimals, so
a report equals the one over the facts to the last digit. `rolled` adds the parts up first, since rows of replaced
events cancel out there; `first_day` and `last_day` keep some days only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.casts import TwoLevelTotal, percent, round_to
from usagelens.operators.metrics import level_number
from usagelens.schemas import TelemetryError
from usagelens.sources import sidetables, star

COST = TwoLevelTotal("cost_usd")


@dataclass(frozen=True)
class Rolled:
    dim_employees: DataFrame
    requests: DataFrame
    tools: DataFrame
    errors: DataFrame


def _merged(rows: DataFrame, side: sidetables.SideTable) -> DataFrame:
    """The parts' rows added up, without the days (the caller has chosen them)."""
    names = side.schema.fieldNames()
    keys, sums = names[1 : names.index("n")], names[names.index("n") :]
    total = [F.sum(c).cast(side.schema[c].dataType).alias(c) for c in sums]
    return rows.groupBy(*keys).agg(*total).filter("n <> 0")


def rolled(
    spark: SparkSession, root: str, first_day: date | None = None, last_day: date | None = None
) -> Rolled:
    """The roll-ups of the newest version at `root`; parts that have none get them first, the others are not read.

    Events without a time have no day: they count unless days are chosen.
    """
    log = sidetables.brought_up(spark, root, *sidetables.ROLLUPS)
    day, chosen = F.col("event_date"), F.lit(True)
    if first_day is not None:
        chosen = chosen & (day >= F.lit(first_day))
    if last_day is not None:
        chosen = chosen & (day <= F.lit(last_day))
    requests, tools, errors = (
        _merged(sidetables.read_side(spark, root, log, side).filter(chosen), side) for side in sidetables.ROLLUPS
    )
    return Rolled(star.read_dim(spark, root, log.version), requests, tools, errors)


def _sum(name: str) -> Column:
    """A total that is NULL, like SUM, where there is no value."""
    return F.when(F.sum(f"{name}_n") > 0, F.sum(name))


def _cost() -> Column:
    return F.when(F.sum("cost_n") > 0, COST.total())


def _tokens() -> Column:
    return _sum("tokens").cast("bigint")


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0)


def kpis(rows: Rolled) -> DataFrame:
    requests = rows.requests.agg(
        F.coalesce(_cost(), F.lit(0.0)).alias("cost"),
        _or_zero(_tokens()).alias("total_tokens"),
        _ratio(_or_zero(_sum("cache_read")), _or_zero(_sum("prompt_side"))).alias("cache"),
        _or_zero(F.sum("n")).alias("requests"),
    )
    errors = rows.errors.agg(_or_zero(F.sum("n")).alias("errors"))
    return requests.crossJoin(F.broadcast(errors)).select(  # one row each
        round_to(F.col("cost"), 2).alias("total_cost_usd"),
        "total_tokens",
        round_to(F.col("cache"), 1).alias("cache_read_ratio_pct"),
        round_to(_ratio(F.col("errors"), F.col("requests") + F.col("errors")), 1).alias("api_error_rate_pct"),
    )


def _by_employee(rows: Rolled, by: str, *final: Column) -> DataFrame:
    """One row a user first, as in `rollup_by_employee`: the roll-up has some rows for each user and model."""
    names = [f.name for f in rows.requests.schema.fields if f.name not in ("user_email", "model")]
    users = rows.requests.filter("user_email IS NOT NULL").groupBy("user_email")
    per_user = users.agg(*[F.sum(c).cast(rows.requests.schema[c].dataType).alias(c) for c in names])
    members = rows.dim_employees.select("email", by)
    return per_user.join(members, F.col("user_email") == F.col("email")).groupBy(by).agg(*final)


def _cost_by(rows: Rolled, by: str) -> DataFrame:
    return _by_employee(
        rows, by, _cost().alias("total_cost"), _tokens().alias("total_tokens"), F.sum("n").alias("request_count")
    )


def cost_by_practice(rows: Rolled) -> DataFrame:
    return _cost_by(rows, "practice").orderBy(F.desc_nulls_last("total_cost"), F.asc_nulls_last("practice"))


def cost_by_level(rows: Rolled) -> DataFrame:
    return _cost_by(rows, "level").orderBy(level_number().asc_nulls_last(), F.asc_nulls_last("level"))


def token_efficiency_by_practice(rows: Rolled) -> DataFrame:
    def mean(total: Column, count: str) -> Column:
        return total.cast("double") / F.nullif(F.sum(count), F.lit(0))

    return _by_employee(
        rows,
        "practice",
        round_to(mean(_cost(), "cost_n") * 1000, 4).alias("avg_cost_per_request_x1000"),
        percent(_sum("cache_read"), _sum("prompt_side")).alias("cache_hit_pct"),
        round_to(mean(_sum("ms"), "ms_n"), 0).alias("avg_duration_ms"),
    ).orderBy(F.asc_nulls_last("practice"))


def model_usage_breakdown(rows: Rolled) -> DataFrame:
    grouped = rows.requests.groupBy("model").agg(
        F.sum("n").alias("request_count"), _cost().alias("total_cost"), _tokens().alias("total_tokens")
    )
    return grouped.orderBy(F.desc("request_count"), F.asc_nulls_last("model"))


def tool_usage_frequency(rows: Rolled, basis: str = "all") -> DataFrame:
    if basis not in ("all", "decisions"):
        raise TelemetryError(f"unknown basis '{basis}': use 'all' or 'decisions'")
    usage = rows.tools.filter(F.col("decision") != "")
    if basis == "decisions":
        usage = usage.filter(F.col("event_kind") == "tool_decision")
    rejects = _or_zero(F.sum(F.when(F.col("decision") == "reject", F.col("n"))))
    return (
        usage.groupBy("tool_name")
        .agg(F.sum("n").alias("usage_count"), rejects.alias("reject_count"), percent(rejects, F.sum("n")).alias("reject_rate_pct"))
        .orderBy(F.desc("usage_count"), F.asc_nulls_last("tool_name"))
    )


def common_api_errors(rows: Rolled) -> DataFrame:
    return (
        rows.errors.groupBy("status_code", "error_message")
        .agg(F.sum("n").alias("error_count"), F.count_distinct("user_email").alias("affected_users"))
        .orderBy(F.desc("error_count"), F.asc_nulls_last("status_code"), F.asc_nulls_last("error_message"))
    )


def error_rate_by_model(rows: Rolled) -> DataFrame:
    requests = rows.requests.groupBy("model").agg(F.sum("n").alias("requests"))
    errors = rows.errors.groupBy(F.col("model").alias("e_model")).agg(F.sum("n").alias("errors"))
    both = requests.join(errors, F.col("model") == F.col("e_model"), "full_outer").select(
        F.coalesce("model", "e_model").alias("model"),
        _or_zero(F.col("requests")).alias("request_count"),
        _or_zero(F.col("errors")).alias("error_count"),
    )
    rate = percent(F.col("error_count"), F.col("request_count") + F.col("error_count"))
    return both.withColumn("error_rate_pct", rate).orderBy(
        F.desc_nulls_last("error_rate_pct"), F.asc_nulls_last("model"), F.desc("request_count")
    )
