"""KPIs and grouped metrics over the star. Every function is lazy: `f(star, **opts) -> DataFrame`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import TwoLevelTotal, exact_total, percent, round_to
from usagelens.functions.joins import rollup_by_employee, settle
from usagelens.functions.quantiles import mean, mean_of, quantiles, value_counts
from usagelens.functions.refined import quantiles_by_steps
from usagelens.schemas import Star, TelemetryError


def _rows() -> Column:
    return F.count(F.lit(1))


def _tokens() -> Column:
    return F.col("input_tokens") + F.col("output_tokens")


def _prompt_side_tokens() -> Column:
    return F.col("input_tokens") + F.col("cache_read_tokens") + F.col("cache_creation_tokens")


def _zero_if_empty(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


# KPIs: one row each


def total_cost(star: Star) -> DataFrame:
    total = F.coalesce(exact_total(F.col("cost_usd")), F.lit(0.0))
    return star.fact_api_requests.agg(total.alias("total_cost"))


def total_tokens(star: Star) -> DataFrame:
    return star.fact_api_requests.agg(_zero_if_empty(F.sum(_tokens())).alias("total_tokens"))


def _ratio_pct(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0
    )


def _cache_ratio() -> Column:
    return _ratio_pct(
        _zero_if_empty(F.sum("cache_read_tokens")), _zero_if_empty(F.sum(_prompt_side_tokens()))
    )


def cache_read_ratio(star: Star) -> DataFrame:
    return star.fact_api_requests.agg(_cache_ratio().alias("cache_read_ratio"))


def _with_error_count(star: Star, requests: DataFrame) -> DataFrame:
    # both sides are global aggregates, one row each
    errors = star.fact_api_errors.agg(_rows().alias("errors"))
    return requests.crossJoin(F.broadcast(errors))


def _error_rate() -> Column:
    return _ratio_pct(F.col("errors"), F.col("requests") + F.col("errors"))


def api_error_rate(star: Star) -> DataFrame:
    both = _with_error_count(star, star.fact_api_requests.agg(_rows().alias("requests")))
    return both.select(_error_rate().alias("api_error_rate"))


def kpis(star: Star) -> DataFrame:
    """The four KPIs in one row; requests are read once."""
    requests = star.fact_api_requests.agg(
        F.coalesce(exact_total(F.col("cost_usd")), F.lit(0.0)).alias("cost"),
        _zero_if_empty(F.sum(_tokens())).alias("total_tokens"),
        _cache_ratio().alias("cache"),
        _rows().alias("requests"),
    )
    return _with_error_count(star, requests).select(
        round_to(F.col("cost"), 2).alias("total_cost_usd"),
        "total_tokens",
        round_to(F.col("cache"), 1).alias("cache_read_ratio_pct"),
        round_to(_error_rate(), 1).alias("api_error_rate_pct"),
    )


# Costs by employee attribute


def _cost_by(star: Star, by: str) -> DataFrame:
    cost = TwoLevelTotal("cost_usd")
    return rollup_by_employee(
        star.fact_api_requests,
        star.dim_employees,
        by,
        per_user=[*cost.parts(), F.sum(_tokens()).alias("__tokens"), _rows().alias("__rows")],
        final=[
            cost.total().alias("total_cost"),
            F.sum("__tokens").alias("total_tokens"),
            F.sum("__rows").alias("request_count"),
        ],
    )


def cost_by_practice(star: Star) -> DataFrame:
    return _cost_by(star, "practice").orderBy(
        F.desc_nulls_last("total_cost"), F.asc_nulls_last("practice")
    )


def level_number(level: str = "level") -> Column:
    """The number in L<n>; NULL for anything else."""
    return F.replace(F.col(level), F.lit("L"), F.lit("")).try_cast("int")


def cost_by_level(star: Star) -> DataFrame:
    return _cost_by(star, "level").orderBy(
        level_number().asc_nulls_last(), F.asc_nulls_last("level")
    )


def token_efficiency_by_practice(star: Star) -> DataFrame:
    cost = TwoLevelTotal("cost_usd")
    out = rollup_by_employee(
        star.fact_api_requests,
        star.dim_employees,
        "practice",
        per_user=[
            *cost.parts(),
            F.count("cost_usd").alias("__costs"),
            F.sum("cache_read_tokens").alias("__read"),
            F.sum(_prompt_side_tokens()).alias("__side"),
            F.sum(F.col("duration_ms").cast("decimal(38,0)")).alias("__ms"),
            F.count("duration_ms").alias("__durations"),
        ],
        final=[
            cost.total().alias("__cost"),
            *[F.sum(c).alias(c) for c in ("__costs", "__read", "__side", "__ms", "__durations")],
        ],
    )

    def mean(total: str, count: str) -> Column:
        return F.col(total).cast("double") / F.nullif(F.col(count), F.lit(0))

    return out.select(
        "practice",
        round_to(mean("__cost", "__costs") * 1000, 4).alias("avg_cost_per_request_x1000"),
        percent(F.col("__read"), F.col("__side")).alias("cache_hit_pct"),
        round_to(mean("__ms", "__durations"), 0).alias("avg_duration_ms"),
    ).orderBy(F.asc_nulls_last("practice"))


# Models and tools


def model_usage_breakdown(star: Star) -> DataFrame:
    return (
        star.fact_api_requests.groupBy("model")
        .agg(
            _rows().alias("request_count"),
            exact_total(F.col("cost_usd")).alias("total_cost"),
            F.sum(_tokens()).alias("total_tokens"),
        )
        .orderBy(F.desc("request_count"), F.asc_nulls_last("model"))
    )


def tool_usage_frequency(star: Star, basis: str = "all") -> DataFrame:
    """Uses and rejections per tool.

    Results repeat the decision they followed, so with basis="all" an executed call counts twice
    and the reject rate comes out low; basis="decisions" counts each decision once.
    """
    usage = star.fact_tool_usage.filter(F.col("decision") != "")
    if basis == "decisions":
        if "event_kind" not in usage.columns:
            raise TelemetryError("basis='decisions' needs the event_kind column in fact_tool_usage")
        usage = usage.filter(F.col("event_kind") == "tool_decision")
    elif basis != "all":
        raise TelemetryError(f"unknown basis '{basis}': use 'all' or 'decisions'")
    rejects = F.count_if(F.col("decision") == "reject")
    return (
        usage.groupBy("tool_name")
        .agg(
            _rows().alias("usage_count"),
            rejects.alias("reject_count"),
            percent(rejects, _rows()).alias("reject_rate_pct"),
        )
        .orderBy(F.desc("usage_count"), F.asc_nulls_last("tool_name"))
    )


def tool_success_rates(star: Star) -> DataFrame:
    results = star.fact_tool_usage.filter(F.col("is_success").isNotNull())
    # Success is a key of the counts, not one more aggregate: that would be pruned from one of the two
    # places that read them, and the counts be computed twice.
    counts = value_counts(results, ["tool_name", "is_success"], "duration_ms")
    counts = counts.withColumn("ok", F.when(F.col("is_success"), F.col("n")).otherwise(F.lit(0)))
    sums = {"total_results": (F.sum, F.col("n")), "success_count": (F.sum, F.col("ok"))}
    out = quantiles(
        counts, ["tool_name"], "duration_ms", {"p95": 0.95}, sums | mean_of("duration_ms")
    )
    return out.select(
        "tool_name",
        "total_results",
        "success_count",
        percent(F.col("success_count"), F.col("total_results")).alias("success_rate_pct"),
        round_to(mean(), 0).alias("avg_duration_ms"),
        round_to(F.col("p95"), 0).alias("p95_duration_ms"),
    ).orderBy(F.desc("total_results"), F.asc_nulls_last("tool_name"))


def tool_latency_distribution(star: Star) -> DataFrame:
    return star.fact_tool_usage.filter(F.col("duration_ms") > 0).select("tool_name", "duration_ms")


def _latency(rows: DataFrame, key: str, count_name: str, probs: dict[str, float]) -> DataFrame:
    """Count, mean, quantiles and maximum of duration_ms per key, times in whole milliseconds."""
    aggregates = {count_name: (F.sum, F.col("n")), "max_ms": (F.max, F.col("duration_ms"))}
    out = quantiles(
        value_counts(rows, [key], "duration_ms"),
        [key],
        "duration_ms",
        probs,
        aggregates | mean_of("duration_ms"),
    )
    return out.select(
        key,
        count_name,
        round_to(mean(), 0).alias("avg_ms"),
        *[round_to(F.col(name), 0).alias(name) for name in probs],
        "max_ms",
    )


def _latency_by_steps(rows: DataFrame, key: str, count_name: str, probs: dict[str, float]) -> DataFrame:
    """`_latency` for durations with any number of distinct values; the value counts are computed once."""
    counts = settle(value_counts(rows, [key], "duration_ms"))
    found = quantiles_by_steps(counts, [key], "duration_ms", probs).withColumnRenamed(key, "__key")
    sums = {name: fn(value).alias(name) for name, (fn, value) in mean_of("duration_ms").items()}
    whole = counts.groupBy(key).agg(F.sum("n").alias(count_name), F.max("duration_ms").alias("max_ms"), *sums.values())
    return whole.join(found, F.col(key).eqNullSafe(F.col("__key"))).select(
        key, count_name, round_to(mean(), 0).alias("avg_ms"), *[round_to(F.col(name), 0).alias(name) for name in probs], "max_ms"
    )


def high_latency_tools(star: Star, by_steps: bool = False) -> DataFrame:
    """Count, mean, p50, p95, p99 and maximum of positive durations per tool.

    `by_steps` is for durations in fine units, with more distinct values in 0.4 % of their range than a task sorts.
    """
    probs = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}
    found = _latency_by_steps if by_steps else _latency
    return found(tool_latency_distribution(star), "tool_name", "call_count", probs).orderBy(
        F.desc_nulls_last("p95_ms"), F.asc_nulls_last("tool_name")
    )


def api_request_latency_by_model(star: Star) -> DataFrame:
    timed = star.fact_api_requests.filter(F.col("duration_ms").isNotNull())
    probs = {"p50_ms": 0.50, "p95_ms": 0.95}
    return _latency(timed, "model", "request_count", probs).orderBy(
        F.desc_nulls_last("avg_ms"), F.asc_nulls_last("model")
    )


# Errors, sessions, prompts


def common_api_errors(star: Star) -> DataFrame:
    return (
        star.fact_api_errors.groupBy("status_code", "error_message")
        .agg(_rows().alias("error_count"), F.count_distinct("user_email").alias("affected_users"))
        .orderBy(
            F.desc("error_count"),
            F.asc_nulls_last("status_code"),
            F.asc_nulls_last("error_message"),
        )
    )


def error_rate_by_model(star: Star) -> DataFrame:
    """Both facts shrink to one row per model before they meet; NULL models do not match."""
    requests = star.fact_api_requests.groupBy("model").agg(_rows().alias("requests"))
    errors = star.fact_api_errors.groupBy(F.col("model").alias("e_model")).agg(
        _rows().alias("errors")
    )
    both = requests.join(errors, F.col("model") == F.col("e_model"), "full_outer").select(
        F.coalesce("model", "e_model").alias("model"),
        _zero_if_empty(F.col("requests")).alias("request_count"),
        _zero_if_empty(F.col("errors")).alias("error_count"),
    )
    rate = percent(F.col("error_count"), F.col("request_count") + F.col("error_count"))
    return both.withColumn("error_rate_pct", rate).orderBy(
        F.desc_nulls_last("error_rate_pct"), F.asc_nulls_last("model"), F.desc("request_count")
    )


def _session_prompts(star: Star) -> DataFrame:
    return star.fact_user_prompts.groupBy("session_id", "user_email").agg(
        _rows().alias("prompt_count"),
        round_to(F.avg("prompt_length"), 0).alias("avg_prompt_length"),
        F.min("epoch_ms").alias("session_start"),
        F.max("epoch_ms").alias("session_end"),
    )


def session_interaction_stats(star: Star) -> DataFrame:
    # the session breaks ties, so equal prompt counts still spread over sort partitions
    return _session_prompts(star).orderBy(
        F.desc("prompt_count"), F.asc_nulls_last("session_id"), F.asc_nulls_last("user_email")
    )


def prompts_per_session(star: Star) -> DataFrame:
    """(session, user, prompt_count) without the ordering of the report."""
    return _session_prompts(star).select("session_id", "user_email", "prompt_count")


def prompt_length_distribution(star: Star) -> DataFrame:
    return star.fact_user_prompts.filter(F.col("prompt_length") > 0).select("prompt_length")
