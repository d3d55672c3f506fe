"""Every operator as a query over the sample tables, and the SQL it is checked against.

`QUERIES[name](spark, sf_dir)` returns a DataFrame; `ORACLES[name]` is the same question in SQL,
asked of the event rows directly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import adhoc, anomaly, charts, facts, findings, metrics, parse, quality, rolled
from usagelens.plans import ingest, sample_data
from usagelens.plans.oracle import BROKEN, JUNK, over, without_broken
from usagelens.schemas import CONTRACT, STAGING_COLUMNS, TYPED_EVENT, Star
from usagelens.session import scratch_path
from usagelens.sources import employees, logs, sidetables, star
from usagelens.streaming import ingest as stream
from usagelens.streaming import outliers, upsert, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def on_star(name: str, fn: Callable[[Star], DataFrame], sql: str | None) -> None:
    query(name, sql)(lambda spark, sf: fn(sample_data.sample_star(spark, sf)))


def columns_of(table: str) -> str:
    return ", ".join(CONTRACT[table].fieldNames())


# Sources and sinks


@query("read_employees", over("SELECT * FROM dim_employees"))
def _(spark, sf):
    return employees.read_employees(spark, sample_data.employee_files(spark, sf))


@query(
    "check_columns",
    over("SELECT practice, count(*) AS employee_count FROM dim_employees GROUP BY practice"),
)
def _(spark, sf):
    path = sample_data.employee_files(spark, sf)
    checked = employees.check_columns(spark.read.options(**employees.CSV).csv(path))
    return checked.groupBy("practice").agg(F.count(F.lit(1)).alias("employee_count"))


@query(
    "write_employees",
    over("SELECT level, count(*) AS employee_count, min(email) AS first_email FROM dim_employees GROUP BY level"),
)
def _(spark, sf):
    path = scratch_path(spark, "employees-out")
    employees.write_employees(sample_data.dim_employees(spark, sf), path)
    read = employees.read_employees(spark, path)
    return read.groupBy("level").agg(
        F.count(F.lit(1)).alias("employee_count"), F.min("email").alias("first_email")
    )


@query(
    "read_log_batches",
    f"SELECT count(*) AS junk_lines, true AS batches_hold_at_most_ten FROM events WHERE {JUNK}",
)
def _(spark, sf):
    # how events fall into batches depends on the scan; what must hold is said in the columns
    lines = logs.read_log_batches(spark, sample_data.raw_files(spark, sf))
    sizes = parse.parse_batch(lines).select("batch_error", F.size("batch.logEvents").alias("n"))
    return sizes.agg(
        F.count_if(F.col("batch_error").isNotNull()).alias("junk_lines"),
        (F.coalesce(F.max("n"), F.lit(0)) <= logs.MAX_BATCH).alias("batches_hold_at_most_ten"),
    )


@query(
    "write_log_batches",
    over(
        "SELECT event_id, epoch_ms, body, session_id, user_email, model, cost_usd, "
        "decision, decision_source FROM stg"
    ),
)
def _(spark, sf):
    path = scratch_path(spark, "raw-out")
    logs.write_log_batches(sample_data.messages(spark, sf, broken=False), path)
    staged = parse.stage_events(parse.parse_lines(logs.read_log_batches(spark, path)))
    return staged.select(
        "event_id",
        *["epoch_ms", "body", "session_id", "user_email", "model", "cost_usd"],
        *["decision", "decision_source"],
    )


_BROKEN_RECORD = "CASE CAST(regexp_extract(email, '[0-9]+') AS BIGINT) % 50 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'too many fields' WHEN 2 THEN 'broken quotes' END"
_BROKEN_PEOPLE = f"""SELECT email, CASE WHEN CAST(regexp_extract(email, '[0-9]+') AS BIGINT) % 7 = 0
    THEN full_name || chr(10) || '"Jr"' ELSE full_name END AS full_name, practice, level, location,
    {_BROKEN_RECORD} AS reason FROM dim_employees"""


@query(
    "employee_records",
    over(f"SELECT email, full_name, practice, level, location FROM ({_BROKEN_PEOPLE}) WHERE reason IS NULL"),
)
def _(spark, sf):
    # good records among broken ones, some with line breaks in a name
    return employees.read_employees(spark, sample_data.broken_employee_files(spark, sf))


@query("employee_quarantine", over(f"SELECT reason, count(*) AS row_count FROM ({_BROKEN_PEOPLE}) WHERE reason IS NOT NULL GROUP BY reason"))
def _(spark, sf):
    # from the quarantine of a loaded star, where the broken log rows are as well
    root = _load(spark, sf, sample_data.broken_employee_files(spark, sf))
    rejected = star.read_quarantine(spark, root).filter(F.col("stage") == employees.STAGE)
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def _load(spark: SparkSession, sf: str, people: str | None = None, layout: tuple[str, ...] = star.BY_TABLE) -> str:
    root = scratch_path(spark, "star")
    people = people or sample_data.employee_files(spark, sf)
    ingest.load_star(spark, sample_data.raw_files(spark, sf), people, root, layout)
    return root


def _typed_once(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """The typed events from the raw text, parsed once for all writes of a query."""
    facts.typed_events(_parsed(spark, sf)).write.parquet(path)
    return spark.read.schema(TYPED_EVENT).parquet(path)


def _even(events: DataFrame) -> DataFrame:
    return events.filter("event_id % 2 = 0")


def _load_even(spark: SparkSession, sf: str, events: DataFrame, root: str) -> None:
    star.write_star(sample_data.dim_employees(spark, sf), _even(events), f"{root}/star", star.BY_TABLE)


def _two_parts(spark: SparkSession, sf: str) -> str:
    """A star of the even events, loaded, and of all events, upserted; written once in an application."""

    def write(path: str) -> None:
        delta = _typed_once(spark, sf, f"{path}/typed")
        _load_even(spark, sf, delta, path)
        sidetables.brought_up(spark, f"{path}/star", sidetables.COST_MOMENTS, *sidetables.ROLLUPS)
        upsert.incremental_upsert(delta, f"{path}/star", star.BY_TABLE, sides=(sidetables.COST_MOMENTS, *sidetables.ROLLUPS))

    return f"{sample_data.written_once(spark, sf, 'two-parts', write)}/star"


LOAD_REPORT = over(
    f"""SELECT table_name, detail, count(*) AS row_count FROM (
        SELECT CASE kind WHEN 'api_request' THEN 'fact_api_requests'
            WHEN 'api_error' THEN 'fact_api_errors' WHEN 'user_prompt' THEN 'fact_user_prompts'
            ELSE 'fact_tool_usage' END AS table_name, CAST(NULL AS VARCHAR) AS detail
        FROM stg WHERE NOT {BROKEN}
        UNION ALL SELECT 'quarantine', 'message' FROM stg WHERE {BROKEN}
        UNION ALL SELECT 'quarantine', 'batch' FROM stg WHERE {JUNK}) GROUP BY ALL"""
)


@query("write_star", LOAD_REPORT)
def _(spark, sf):
    return ingest.load_report(spark, _load(spark, sf))


@query(
    "read_star",
    over(f"SELECT {columns_of('fact_api_requests')} FROM fact_api_requests", where=f"NOT {BROKEN}"),
)
def _(spark, sf):
    return star.read_star(spark, _load(spark, sf)).contract("fact_api_requests")


# Parsing, over the raw text of all events


def _parsed(spark, sf):
    return parse.parse_lines(sample_data.raw_lines(spark, sf))


@query("stage_events", over(f"SELECT {', '.join(STAGING_COLUMNS)} FROM stg", where=f"NOT {BROKEN}"))
def _(spark, sf):
    return sample_data.raw_staged(spark, sf).select(*STAGING_COLUMNS)


@query(
    "parse_batch",
    f"""SELECT coalesce(batch_error, 'none') AS batch_error, sum(n) AS row_count FROM (
        SELECT NULL AS batch_error, count(*) AS n FROM events UNION ALL
        SELECT 'malformed line', count(*) FROM events WHERE {JUNK}) GROUP BY ALL""".replace(
        "sum(n)", "CAST(sum(n) AS BIGINT)"
    ),
)
def _(spark, sf):
    batches = parse.parse_batch(logs.clean_lines(sample_data.raw_lines(spark, sf)))
    rows = F.when(F.col("batch_error").isNotNull(), 1).otherwise(F.size("batch.logEvents"))
    return batches.groupBy(F.coalesce("batch_error", F.lit("none")).alias("batch_error")).agg(
        F.sum(rows).alias("row_count")
    )


@query(
    "unnest_events",
    over("SELECT event_id, CAST(epoch_ms AS VARCHAR) AS timestamp_text FROM stg"),
)
def _(spark, sf):
    lines = logs.clean_lines(sample_data.raw_lines(spark, sf))
    events = parse.unnest_events(parse.parse_batch(lines)).filter(F.col("batch_error").isNull())
    return events.select(
        F.col("event.id").alias("event_id"), F.col("event.timestamp").alias("timestamp_text")
    )


@query(
    "parse_message",
    over(
        f"SELECT event_id, epoch_ms, CASE WHEN {BROKEN} THEN NULL ELSE body END AS body, "
        f"CASE WHEN {BROKEN} THEN 'malformed message' END AS reason FROM stg",
    ),
)
def _(spark, sf):
    lines = logs.clean_lines(sample_data.raw_lines(spark, sf))
    messages = parse.parse_message(parse.unnest_events(parse.parse_batch(lines)))
    kept = messages.filter(~F.col("stage").eqNullSafe("batch"))
    return kept.select("event_id", "epoch_ms", F.col("message.body").alias("body"), "reason")


@query(
    "parse_errors",
    over(
        f"""SELECT 'batch' AS stage, count(*) AS error_count FROM stg WHERE {JUNK} HAVING count(*) > 0
        UNION ALL SELECT 'message', count(*) FROM stg WHERE {BROKEN} HAVING count(*) > 0"""
    ),
)
def _(spark, sf):
    return parse.parse_errors(parse.quarantine(_parsed(spark, sf)))


@query(
    "project_attributes",
    over(f"SELECT event_id, {', '.join(STAGING_COLUMNS)} FROM stg", where=f"NOT {BROKEN}"),
)
def _(spark, sf):
    return parse.stage_events(_parsed(spark, sf))


def _alias_counts(column: str) -> Query:
    def run(spark, sf):
        staged = sample_data.raw_staged(spark, sf)
        return staged.groupBy("body", column).agg(F.count(F.lit(1)).alias("row_count"))

    return run


for _name, _column in {"alias_decision": "decision", "alias_source": "decision_source"}.items():
    query(
        _name,
        over(
            f"SELECT body, {_column}, count(*) AS row_count FROM stg GROUP BY ALL",
            where=f"NOT {BROKEN}",
        ),
    )(_alias_counts(_column))


@query(
    "safe_cast",
    over(
        """SELECT event_id, TRY_CAST(cost_usd AS DOUBLE) AS cost_usd,
        TRY_CAST(cost_usd AS BIGINT) AS cost_rounded, TRY_CAST(status_code AS INTEGER) AS status_code
        FROM stg"""
    ),
)
def _(spark, sf):
    return sample_data.staged_events(sample_data.events(spark, sf)).selectExpr(
        "event_id",
        f"{facts.safe_cast('cost_usd')} AS cost_usd",
        f"{facts.to_long('cost_usd')} AS cost_rounded",
        f"{facts.safe_cast('status_code')} AS status_code",
    )


@query(
    "bool_from_text",
    over(
        """SELECT CASE WHEN success = 'true' THEN true WHEN success = 'false' THEN false END
        AS is_success, count(*) AS row_count FROM stg GROUP BY ALL"""
    ),
)
def _(spark, sf):
    flags = sample_data.staged_events(sample_data.events(spark, sf)).selectExpr(
        f"{facts.safe_cast('is_success')} AS is_success"
    )
    return flags.groupBy("is_success").agg(F.count(F.lit(1)).alias("row_count"))


# Facts, from the raw text (the broken messages are missing)


def _fact_from_raw(name: str, build) -> Query:
    columns = CONTRACT[name].fieldNames()
    return lambda spark, sf: build(sample_data.raw_staged(spark, sf)).select(*columns)


for _name, _table, _filter in [
    ("fact_api_requests", "fact_api_requests", "true"),
    ("tool_decisions", "fact_tool_usage", "event_kind = 'tool_decision'"),
    ("tool_results", "fact_tool_usage", "event_kind = 'tool_result'"),
    ("fact_tool_usage", "fact_tool_usage", "true"),
    ("fact_api_errors", "fact_api_errors", "true"),
    ("fact_user_prompts", "fact_user_prompts", "true"),
]:
    query(
        _name,
        over(f"SELECT {columns_of(_table)} FROM {_table} WHERE {_filter}", where=f"NOT {BROKEN}"),
    )(_fact_from_raw(_table, getattr(facts, _name)))


# Quality

on_star(
    "reject_counts",
    quality.reject_counts,
    over(
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE cost_usd IS NULL
        OR duration_ms IS NULL OR input_tokens IS NULL OR output_tokens IS NULL) AS rejected_rows
        FROM fact_api_requests"""
    ),
)
on_star(
    "tool_usage_counts",
    quality.tool_usage_counts,
    over(
        """SELECT count(*) AS total_rows,
        count(*) FILTER (WHERE decision IS NOT NULL AND decision != '') AS decision_rows,
        count(*) FILTER (WHERE is_success IS NOT NULL) AS result_rows FROM fact_tool_usage"""
    ),
)
on_star(
    "null_status_count",
    quality.null_status_count,
    over(
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE status_code IS NULL)
        AS null_status_rows FROM fact_api_errors"""
    ),
)
on_star(
    "null_prompt_count",
    quality.null_prompt_count,
    over(
        """SELECT count(*) AS total_rows, count(*) FILTER (WHERE prompt_length IS NULL)
        AS null_length_rows FROM fact_user_prompts"""
    ),
)
_USED_EMAILS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, user_email FROM {t}" for t in CONTRACT if t.startswith("fact_")
)
_ORPHANS = f"""SELECT DISTINCT table_name, user_email FROM ({_USED_EMAILS}) f
    LEFT JOIN dim_employees e ON f.user_email = e.email
    WHERE e.email IS NULL AND f.user_email IS NOT NULL AND f.user_email != ''"""
on_star("orphan_emails", quality.orphan_emails, over(_ORPHANS))
on_star(
    "orphan_counts",
    quality.orphan_counts,
    over(f"SELECT table_name, count(*) AS orphan_count FROM ({_ORPHANS}) GROUP BY table_name"),
)


@query(
    "dim_key_unique",
    """SELECT concat('user', c_nationkey, '@example.com') AS email, count(*) AS row_count
    FROM customer GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark, sf):
    # customers keyed by nation, so that there is something to find
    customer = sample_data.table(spark, sf, "customer")
    clashing = customer.selectExpr("concat('user', c_nationkey, '@example.com') AS email")
    return quality.dim_key_violations(clashing)


_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in CONTRACT
)
on_star("row_counts", quality.row_counts, over(_ROW_COUNTS))


@query(
    "event_counts_by_body", over("SELECT body, count(*) AS event_count FROM stg GROUP BY body")
)
def _(spark, sf):
    return quality.event_counts_by_body(sample_data.staged_events(sample_data.events(spark, sf)))


@query(
    "event_totals",
    over(
        """SELECT (SELECT count(*) FROM stg) AS event_count,
        (SELECT coalesce(CAST(sum(CAST(cost_usd AS DECIMAL(18, 4))) AS DOUBLE), 0.0)
            FROM fact_api_requests) AS total_cost,
        CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS last_day FROM events"""
    ),
)
def _(spark, sf):
    return quality.event_totals(sample_data.staged_events(sample_data.events(spark, sf)))


@query(
    "unknown_body",
    "SELECT event_type AS body, count(*) AS event_count FROM events GROUP BY event_type",
)
def _(spark, sf):
    # the sample's own event types are no known bodies, so all of them must turn up
    bare = sample_data.events(spark, sf).select(F.col("event_type").alias("body"))
    return quality.unknown_body_counts(bare)


# KPIs

COST = "CAST(sum(CAST({0}cost_usd AS DECIMAL(18, 4))) AS DOUBLE)"
TOKENS = "CAST(sum({0}input_tokens + {0}output_tokens) AS BIGINT)"
CACHE = """CASE WHEN coalesce(sum(input_tokens + cache_read_tokens + cache_creation_tokens), 0) = 0
    THEN 0.0 ELSE CAST(coalesce(sum(cache_read_tokens), 0) AS DOUBLE)
    / CAST(sum(input_tokens + cache_read_tokens + cache_creation_tokens) AS DOUBLE) * 100 END"""
ERROR_RATE = """CASE WHEN r.n + e.n = 0 THEN 0.0
    ELSE CAST(e.n AS DOUBLE) / CAST(r.n + e.n AS DOUBLE) * 100 END"""
COUNTS = """(SELECT count(*) AS n FROM fact_api_requests) r,
    (SELECT count(*) AS n FROM fact_api_errors) e"""

on_star(
    "total_cost",
    metrics.total_cost,
    over(f"SELECT coalesce({COST.format('')}, 0.0) AS total_cost FROM fact_api_requests"),
)
on_star(
    "total_tokens",
    metrics.total_tokens,
    over(f"SELECT coalesce({TOKENS.format('')}, 0) AS total_tokens FROM fact_api_requests"),
)
on_star(
    "cache_read_ratio",
    metrics.cache_read_ratio,
    over(f"SELECT {CACHE} AS cache_read_ratio FROM fact_api_requests"),
)
on_star(
    "api_error_rate",
    metrics.api_error_rate,
    over(f"SELECT {ERROR_RATE} AS api_error_rate FROM {COUNTS}"),
)
on_star(
    "kpis",
    metrics.kpis,
    over(
        f"""SELECT round(cost, 2) AS total_cost_usd, total_tokens,
        round(cache, 1) AS cache_read_ratio_pct, round({ERROR_RATE}, 1) AS api_error_rate_pct
        FROM (SELECT coalesce({COST.format('')}, 0.0) AS cost,
            coalesce({TOKENS.format('')}, 0) AS total_tokens, {CACHE} AS cache
            FROM fact_api_requests) k, {COUNTS}"""
    ),
)

# Grouped metrics

JOINED = "fact_api_requests f JOIN dim_employees e ON f.user_email = e.email"


def _cost_by(by: str) -> str:
    return over(
        f"""SELECT e.{by}, {COST.format('f.')} AS total_cost, {TOKENS.format('f.')} AS total_tokens,
        count(*) AS request_count FROM {JOINED} GROUP BY e.{by}"""
    )


on_star("cost_by_practice", metrics.cost_by_practice, _cost_by("practice"))
on_star("cost_by_level", metrics.cost_by_level, _cost_by("level"))
on_star(
    "token_efficiency_by_practice",
    metrics.token_efficiency_by_practice,
    over(
        f"""SELECT e.practice, round(avg(f.cost_usd) * 1000, 4) AS avg_cost_per_request_x1000,
        round(CAST(sum(f.cache_read_tokens) AS DOUBLE) * 100.0 / nullif(CAST(
            sum(f.input_tokens + f.cache_read_tokens + f.cache_creation_tokens) AS DOUBLE), 0), 1)
            AS cache_hit_pct,
        round(avg(f.duration_ms), 0) AS avg_duration_ms FROM {JOINED} GROUP BY e.practice"""
    ),
)
on_star(
    "model_usage_breakdown",
    metrics.model_usage_breakdown,
    over(
        f"""SELECT model, count(*) AS request_count, {COST.format('')} AS total_cost,
        {TOKENS.format('')} AS total_tokens FROM fact_api_requests GROUP BY model"""
    ),
)


def _frequency(condition: str) -> str:
    return over(
        f"""SELECT tool_name, count(*) AS usage_count,
        count(*) FILTER (WHERE decision = 'reject') AS reject_count,
        round(CAST(count(*) FILTER (WHERE decision = 'reject') AS DOUBLE) * 100.0
            / nullif(count(*), 0), 1) AS reject_rate_pct
        FROM fact_tool_usage WHERE decision IS NOT NULL AND decision != '' AND {condition}
        GROUP BY tool_name"""
    )


on_star("tool_usage_frequency", metrics.tool_usage_frequency, _frequency("true"))
on_star(
    "tool_usage_frequency_decisions",
    lambda s: metrics.tool_usage_frequency(s, basis="decisions"),
    _frequency("event_kind = 'tool_decision'"),
)
on_star(
    "tool_success_rates",
    metrics.tool_success_rates,
    over(
        """SELECT tool_name, count(*) AS total_results,
        count(*) FILTER (WHERE is_success) AS success_count,
        round(CAST(count(*) FILTER (WHERE is_success) AS DOUBLE) * 100.0 / nullif(count(*), 0), 1)
            AS success_rate_pct,
        round(avg(duration_ms), 0) AS avg_duration_ms,
        round(percentile_cont(0.95) WITHIN GROUP (ORDER BY duration_ms), 0) AS p95_duration_ms
        FROM fact_tool_usage WHERE is_success IS NOT NULL GROUP BY tool_name"""
    ),
)
on_star(
    "tool_latency_distribution",
    metrics.tool_latency_distribution,
    over("SELECT tool_name, duration_ms FROM fact_tool_usage WHERE duration_ms > 0"),
)
_ERRORS = """SELECT status_code, error_message, count(*) AS error_count,
    count(DISTINCT user_email) AS affected_users FROM fact_api_errors GROUP BY ALL"""
on_star("common_api_errors", metrics.common_api_errors, over(_ERRORS))
on_star(
    "error_rate_by_model",
    metrics.error_rate_by_model,
    over(
        """SELECT model, CAST(sum(is_request) AS BIGINT) AS request_count,
        CAST(sum(1 - is_request) AS BIGINT) AS error_count,
        round(CAST(sum(1 - is_request) AS DOUBLE) * 100.0 / count(*), 1) AS error_rate_pct
        FROM (SELECT model, 1 AS is_request FROM fact_api_requests
            UNION ALL SELECT model, 0 FROM fact_api_errors)
        GROUP BY model, CASE WHEN model IS NULL THEN is_request END"""
    ),
)
on_star(
    "session_interaction_stats",
    metrics.session_interaction_stats,
    over(
        """SELECT session_id, user_email, count(*) AS prompt_count,
        round(avg(prompt_length), 0) AS avg_prompt_length, min(epoch_ms) AS session_start,
        max(epoch_ms) AS session_end FROM fact_user_prompts GROUP BY session_id, user_email"""
    ),
)
on_star(
    "prompt_length_distribution",
    metrics.prompt_length_distribution,
    over("SELECT prompt_length FROM fact_user_prompts WHERE prompt_length > 0"),
)


def _pct(p: float, column: str = "duration_ms") -> str:
    return f"percentile_cont({p}) WITHIN GROUP (ORDER BY {column})"


on_star(
    "high_latency_tools",
    metrics.high_latency_tools,
    over(
        f"""SELECT tool_name, count(*) AS call_count, round(avg(duration_ms), 0) AS avg_ms,
        round({_pct(0.5)}, 0) AS p50_ms, round({_pct(0.95)}, 0) AS p95_ms,
        round({_pct(0.99)}, 0) AS p99_ms, max(duration_ms) AS max_ms
        FROM fact_tool_usage WHERE duration_ms > 0 GROUP BY tool_name"""
    ),
)
_FINE = "duration_ms * 1000000 + epoch_ms % 999983"
on_star(
    "high_latency_tools_fine",
    lambda s: metrics.high_latency_tools(
        replace(s, fact_tool_usage=s.fact_tool_usage.withColumn("duration_ms", F.expr(_FINE))), by_steps=True
    ),
    over(
        f"""SELECT tool_name, count(*) AS call_count, round(avg(duration_ms), 0) AS avg_ms,
        round({_pct(0.5)}, 0) AS p50_ms, round({_pct(0.95)}, 0) AS p95_ms,
        round({_pct(0.99)}, 0) AS p99_ms, max(duration_ms) AS max_ms
        FROM (SELECT tool_name, {_FINE} AS duration_ms FROM fact_tool_usage) WHERE duration_ms > 0 GROUP BY tool_name"""
    ),
)
on_star(
    "api_request_latency_by_model",
    metrics.api_request_latency_by_model,
    over(
        f"""SELECT model, count(*) AS request_count, round(avg(duration_ms), 0) AS avg_ms,
        round({_pct(0.5)}, 0) AS p50_ms, round({_pct(0.95)}, 0) AS p95_ms,
        max(duration_ms) AS max_ms
        FROM fact_api_requests WHERE duration_ms IS NOT NULL GROUP BY model"""
    ),
)

# Chart aggregates


def _by_status(condition: str) -> str:
    return over(
        f"""SELECT status_code, CAST(sum(error_count) AS BIGINT) AS error_count,
        CAST(sum(affected_users) AS BIGINT) AS affected_users
        FROM ({_ERRORS}) WHERE {condition} GROUP BY status_code"""
    )


on_star("errors_by_status", charts.errors_by_status, _by_status("status_code IS NOT NULL"))
on_star(
    "errors_by_status_with_null",
    lambda s: charts.errors_by_status(s, keep_null_status=True),
    _by_status("true"),
)
_TURNS = "SELECT count(*) AS v FROM fact_user_prompts GROUP BY session_id, user_email"
_LENGTHS = "SELECT prompt_length AS v FROM fact_user_prompts WHERE prompt_length > 0"
on_star(
    "prompts_per_session_stats",
    charts.prompts_per_session_stats,
    over(f"SELECT avg(v) AS avg_prompts, median(v) AS median_prompts FROM ({_TURNS})"),
)


def _histogram(values: str, bins: int) -> str:
    return over(
        f"""SELECT CAST(lo + b * w AS BIGINT) AS bin_start, CAST(lo + (b + 1) * w AS BIGINT) AS bin_end,
        count(*) AS row_count FROM (
            SELECT lo, w, (v - lo) // w AS b FROM ({values}) x, (
                SELECT min(v) AS lo, CAST(ceil((max(v) - min(v) + 1) / {bins}) AS BIGINT) AS w
                FROM ({values}))) GROUP BY lo, w, b"""
    )


on_star("session_turn_histogram", charts.session_turn_histogram, _histogram(_TURNS, 30))
on_star("prompt_length_histogram", charts.prompt_length_histogram, _histogram(_LENGTHS, 50))
on_star(
    "prompt_length_avg",
    charts.prompt_length_avg,
    over(f"SELECT avg(v) AS avg_prompt_length FROM ({_LENGTHS})"),
)
on_star(
    "latency_box_stats",
    charts.latency_box_stats,
    over(
        f"""SELECT tool_name, min_ms, q1_ms, median_ms, q3_ms, max_ms,
        min(duration_ms) FILTER (WHERE duration_ms >= q1_ms - 1.5 * (q3_ms - q1_ms))
            AS lower_whisker_ms,
        max(duration_ms) FILTER (WHERE duration_ms <= q3_ms + 1.5 * (q3_ms - q1_ms))
            AS upper_whisker_ms,
        count(*) FILTER (WHERE duration_ms < q1_ms - 1.5 * (q3_ms - q1_ms)
            OR duration_ms > q3_ms + 1.5 * (q3_ms - q1_ms)) AS outlier_count
        FROM fact_tool_usage JOIN (
            SELECT tool_name, CAST(min(duration_ms) AS DOUBLE) AS min_ms,
            CAST({_pct(0.25)} AS DOUBLE) AS q1_ms, CAST({_pct(0.5)} AS DOUBLE) AS median_ms,
            CAST({_pct(0.75)} AS DOUBLE) AS q3_ms, CAST(max(duration_ms) AS DOUBLE) AS max_ms
            FROM fact_tool_usage WHERE duration_ms > 0 GROUP BY tool_name) USING (tool_name)
        WHERE duration_ms > 0 GROUP BY ALL"""
    ),
)
on_star(
    "request_share_by_model",
    charts.request_share_by_model,
    over(
        """SELECT model, count(*) AS request_count, round(CAST(count(*) AS DOUBLE) * 100.0
            / (SELECT count(*) FROM fact_api_requests), 1) AS request_share_pct
        FROM fact_api_requests GROUP BY model"""
    ),
)

# Anomalies

_AT_SECOND = "strftime(make_timestamp(epoch_ms * 1000), '%Y-%m-%d %H:%M:%S') AS timestamp"
_SECONDS = "round(duration_ms / CAST(1000 AS DOUBLE), 2) AS duration_sec"
_COST_ANOMALIES = f"""SELECT epoch_ms, {_AT_SECOND}, user_email, model,
    round(cost_usd, 4) AS cost_usd, duration_ms, {_SECONDS}, round(z, 2) AS z_score, session_id
    FROM (SELECT *, (cost_usd - avg(cost_usd) OVER ()) / nullif(stddev(cost_usd) OVER (), 0) AS z
        FROM fact_api_requests WHERE cost_usd > 0) WHERE z >= 3"""
_LATENCY_ANOMALIES = f"""SELECT epoch_ms, {_AT_SECOND}, user_email, tool_name, duration_ms,
    {_SECONDS}, round(bound / CAST(1000 AS DOUBLE), 2) AS threshold_sec, session_id
    FROM (SELECT *, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS bound
        FROM (SELECT *, quantile_cont(duration_ms, 0.25) OVER tool AS q1,
                quantile_cont(duration_ms, 0.75) OVER tool AS q3
            FROM fact_tool_usage WHERE duration_ms > 0 WINDOW tool AS (PARTITION BY tool_name)))
    WHERE duration_ms > bound AND tool_name IS NOT NULL"""
_BY_COST = "ORDER BY cost_usd DESC, epoch_ms, user_email, session_id, model"
_BY_LATENCY = "ORDER BY duration_ms DESC, epoch_ms, user_email, tool_name, session_id"

on_star("cost_anomalies", anomaly.cost_anomalies, over(_COST_ANOMALIES))
on_star(
    "latency_anomalies",
    anomaly.latency_anomalies,
    over(_LATENCY_ANOMALIES),
)
on_star(
    "latency_anomalies_all",
    lambda s: anomaly.latency_anomalies(s, limit=None),
    over(_LATENCY_ANOMALIES),
)
on_star(
    "top_cost_anomalies",
    anomaly.top_cost_anomalies,
    over(f"SELECT * FROM ({_COST_ANOMALIES}) {_BY_COST} LIMIT 50"),
)
on_star(
    "top_latency_anomalies",
    anomaly.top_latency_anomalies,
    over(f"SELECT * FROM ({_LATENCY_ANOMALIES}) {_BY_LATENCY} LIMIT 15"),
)
on_star(
    "anomaly_summary",
    anomaly.anomaly_summary,
    over(
        f"""SELECT * FROM (SELECT count(*) AS cost_anomaly_count,
            round(coalesce(CAST(sum(CAST(cost_usd AS DECIMAL(18, 4))) AS DOUBLE), 0.0), 2)
            AS total_anomalous_cost_usd FROM ({_COST_ANOMALIES})) c,
        (SELECT count(*) AS latency_anomaly_count,
            round(coalesce(max(duration_sec), 0.0), 1) AS max_latency_sec
            FROM ({_LATENCY_ANOMALIES})) l"""
    ),
)



@query("cost_anomalies_stored", over(_COST_ANOMALIES, where=f"NOT {BROKEN}"))
def _(spark, sf):
    # mean and deviation from the moments kept beside the star's parts
    root = _two_parts(spark, sf)
    log = sidetables.brought_up(spark, root, sidetables.COST_MOMENTS)
    known = sidetables.read_side(spark, root, log, sidetables.COST_MOMENTS)
    return anomaly.cost_anomalies(star.read_star(spark, root), known=known)


@query(
    "cost_anomalies_stream",
    over(
        f"""SELECT epoch_ms, {_AT_SECOND}, user_email, model, round(cost_usd, 4) AS cost_usd, duration_ms,
            {_SECONDS}, round(z, 2) AS z_score, session_id
        FROM (SELECT *, (cost_usd - avg(cost_usd) OVER ()) / nullif(stddev(cost_usd) OVER (), 0) AS z
            FROM (SELECT event_id, epoch_ms, user_email, model, session_id, TRY_CAST(cost_usd AS DOUBLE) AS cost_usd,
                    TRY_CAST(duration_ms AS BIGINT) AS duration_ms FROM stg WHERE kind = 'api_request')
            WHERE cost_usd > 0) WHERE z >= 3 AND CAST(event_id AS BIGINT) % 2 = 1""",
        where=f"NOT {BROKEN}",
    ),
)
def _(spark, sf):
    # the even events are loaded; the odd ones come as a stream and are judged by all
    root = scratch_path(spark, "outliers")
    _load_even(spark, sf, facts.typed_events(_parsed(spark, sf)), root)
    logs.to_log_batches(sample_data.messages(spark, sf).filter("CAST(id AS BIGINT) % 2 = 1")).write.text(f"{root}/odd")
    lines = stream.stream_lines(spark, f"{root}/odd")
    outliers.stream_cost_anomalies(
        lines, f"{root}/star", f"{root}/checkpoint", f"{root}/out", partition_by=star.BY_TABLE
    ).awaitTermination()
    return outliers.read_outliers(spark, f"{root}/out").drop("batch")


# Ad-hoc access

on_star("list_tables", adhoc.list_tables, over(_ROW_COUNTS))
_SHOWN = "fact_api_requests"
on_star(
    "show_schema",
    lambda s: adhoc.show_schema(s, _SHOWN, with_counts=True),
    over(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS column_name, "
            f"'{f.dataType.simpleString()}' AS data_type, count({f.name}) AS filled_rows FROM {_SHOWN}"
            for i, f in enumerate(CONTRACT[_SHOWN], 1)
        )
    ),
)
_ADHOC = """SELECT model, CAST(sum(CAST(cost_usd AS DECIMAL(18, 4))) AS DOUBLE) AS total_cost,
    count(DISTINCT session_id) AS sessions FROM fact_api_requests GROUP BY model"""
on_star("run_sql", lambda s: adhoc.run_sql(s, _ADHOC), over(_ADHOC))


# Roll-ups kept beside the parts

for _name, _report, _sql in [
    ("kpis", rolled.kpis, ORACLES["kpis"]),
    ("cost_by_practice", rolled.cost_by_practice, _cost_by("practice")),
    ("cost_by_level", rolled.cost_by_level, _cost_by("level")),
    ("token_efficiency_by_practice", rolled.token_efficiency_by_practice, ORACLES["token_efficiency_by_practice"]),
    ("model_usage_breakdown", rolled.model_usage_breakdown, ORACLES["model_usage_breakdown"]),
    ("tool_usage_frequency", rolled.tool_usage_frequency, ORACLES["tool_usage_frequency"]),
    ("common_api_errors", rolled.common_api_errors, ORACLES["common_api_errors"]),
    ("error_rate_by_model", rolled.error_rate_by_model, ORACLES["error_rate_by_model"]),
]:
    query(f"{_name}_rolled", without_broken(_sql))(
        lambda spark, sf, report=_report: report(rolled.rolled(spark, _two_parts(spark, sf)))
    )


# Published findings

on_star(
    "cost_by_model_family",
    lambda s: findings.cost_by_model_family(s, pattern="model-[0-1]|model-[2-4]"),
    over(
        f"""SELECT family, request_count, total_cost,
        round(CAST(request_count AS DOUBLE) * 100.0 / sum(request_count) OVER (), 1)
            AS request_share_pct,
        round(total_cost * 100.0 / sum(total_cost) OVER (), 1) AS cost_share_pct,
        round(total_cost / request_count, 4) AS cost_per_request
        FROM (SELECT model AS family, count(*) AS request_count, {COST.format('')} AS total_cost
            FROM fact_api_requests GROUP BY model)"""
    ),
)


def _with_family_names(loaded: Star) -> Star:
    names = {"model-0": "vendor-opus-4", "model-1": "vendor-sonnet-4-5", "model-2": "haiku-3"}
    model = F.col("model")
    named = F.coalesce(*[F.when(model == old, new) for old, new in names.items()], model)
    return replace(loaded, fact_api_requests=loaded.fact_api_requests.withColumn("model", named))


on_star(
    "cost_by_named_model_family",
    lambda s: findings.cost_by_model_family(_with_family_names(s)),
    over(
        f"""SELECT family, request_count, total_cost,
        round(CAST(request_count AS DOUBLE) * 100.0 / sum(request_count) OVER (), 1)
            AS request_share_pct,
        round(total_cost * 100.0 / sum(total_cost) OVER (), 1) AS cost_share_pct,
        round(total_cost / request_count, 4) AS cost_per_request
        FROM (SELECT CASE model WHEN 'model-0' THEN 'opus' WHEN 'model-1' THEN 'sonnet' WHEN 'model-2' THEN 'haiku' END
                AS family, count(*) AS request_count, {COST.format('')} AS total_cost
            FROM fact_api_requests GROUP BY 1)"""
    ),
)


def _errors_by(slot: str, name: str) -> str:
    return over(
        f"""SELECT {name}, coalesce(error_count, 0) AS error_count,
        coalesce(rate_limit_count, 0) AS rate_limit_count,
        coalesce(request_count, 0) AS request_count,
        round(CAST(coalesce(error_count, 0) AS DOUBLE) * 100.0
            / (coalesce(error_count, 0) + coalesce(request_count, 0)), 1) AS error_rate_pct
        FROM (SELECT {slot} AS {name}, count(*) AS error_count,
            count(*) FILTER (WHERE status_code = 429) AS rate_limit_count
            FROM fact_api_errors GROUP BY 1)
        FULL OUTER JOIN (SELECT {slot} AS {name}, count(*) AS request_count
            FROM fact_api_requests GROUP BY 1) USING ({name})"""
    )


_AT = "make_timestamp(epoch_ms * 1000)"
on_star("errors_by_hour", findings.errors_by_hour, _errors_by(f"date_trunc('hour', {_AT})", "hour_start"))
on_star(
    "errors_by_hour_of_day",
    lambda s: findings.errors_by_hour(s, by="hour_of_day"),
    _errors_by(f"CAST(hour({_AT}) AS INTEGER)", "hour_of_day"),
)
on_star(
    "prompt_length_by_level",
    findings.prompt_length_by_level,
    over(
        f"""SELECT CASE WHEN n >= 7 THEN 'L7+' WHEN n < 7 THEN 'below L7' ELSE 'other' END
            AS level_band, count(*) AS prompt_count, round(avg(prompt_length), 1) AS avg_length,
        CAST({_pct(0.5, 'prompt_length')} AS DOUBLE) AS p50_length,
        CAST({_pct(0.9, 'prompt_length')} AS DOUBLE) AS p90_length
        FROM fact_user_prompts JOIN (SELECT email, TRY_CAST(replace(level, 'L', '') AS INTEGER) AS n
            FROM dim_employees) ON user_email = email WHERE prompt_length > 0 GROUP BY 1"""
    ),
)
on_star(
    "prompts_per_session_by_practice",
    findings.prompts_per_session_by_practice,
    over(
        """SELECT practice, count(*) AS session_count, CAST(sum(n) AS BIGINT) AS prompt_count,
        round(CAST(sum(n) AS DOUBLE) / count(*), 2) AS avg_prompts_per_session
        FROM (SELECT session_id, user_email, count(*) AS n FROM fact_user_prompts GROUP BY ALL)
        JOIN dim_employees ON user_email = email GROUP BY practice"""
    ),
)
on_star(
    "reject_rate_by_practice",
    findings.reject_rate_by_practice,
    over(
        """SELECT practice, count(*) AS decision_count,
        count(*) FILTER (WHERE decision = 'reject') AS reject_count,
        round(CAST(count(*) FILTER (WHERE decision = 'reject') AS DOUBLE) * 100.0 / count(*), 1)
            AS reject_rate_pct
        FROM fact_tool_usage JOIN dim_employees ON user_email = email
        WHERE decision IS NOT NULL AND decision != '' GROUP BY practice"""
    ),
)
on_star(
    "cache_savings_by_practice",
    findings.cache_savings_by_practice,
    over(
        f"""SELECT practice, CAST(sum(cache_creation_tokens) AS BIGINT) AS cache_creation_tokens,
        CAST(sum(cache_read_tokens) AS BIGINT) AS cache_read_tokens,
        round(CAST(sum(cache_read_tokens) AS DOUBLE) / sum(cache_creation_tokens), 2)
            AS reads_per_created FROM {JOINED} GROUP BY practice"""
    ),
)
on_star(
    "practice_view",
    lambda s: metrics.cost_by_level(adhoc.practice_view(s, "BUILDING")),
    over(
        f"""SELECT e.level, {COST.format('f.')} AS total_cost, {TOKENS.format('f.')} AS total_tokens,
        count(*) AS request_count FROM {JOINED} WHERE e.practice = 'BUILDING' GROUP BY e.level"""
    ),
)

# Streaming: run to the end of the available files, then read what was written


@query("stream_ingest", LOAD_REPORT)
def _(spark, sf):
    root = scratch_path(spark, "stream")
    lines = stream.stream_lines(spark, sample_data.raw_files(spark, sf))
    stream.stream_ingest(lines, root, f"{root}/checkpoint", star.BY_TABLE).awaitTermination()
    return ingest.load_report(spark, root)


@query("mixed_writes", LOAD_REPORT)
def _(spark, sf):
    # the load, then a stream of the same files through the upsert, then a repeated delta
    root = _load(spark, sf)
    lines = stream.stream_lines(spark, sample_data.raw_files(spark, sf))
    upsert.stream_upsert(
        lines.filter("value LIKE '%logEvents%'"), root, f"{root}/checkpoint", star.BY_TABLE
    ).awaitTermination()
    again = parse.parse_lines(spark.read.text(sample_data.raw_files(spark, sf)))
    with_id = facts.typed_events(again).filter("event_id IS NOT NULL")
    upsert.incremental_upsert(with_id, root, star.BY_TABLE)
    return ingest.load_report(spark, root)


@query("without_repeats", over("SELECT kind AS event_kind, count(*) AS row_count FROM stg GROUP BY kind", where=f"NOT {BROKEN}"))
def _(spark, sf):
    # every line twice, in one stream
    root = scratch_path(spark, "repeats")
    lines = stream.stream_lines(spark, sample_data.raw_files(spark, sf))
    twice = lines.select(F.explode(F.array("value", "value")).alias("value"))
    once = stream.without_repeats(stream.stream_events(twice), "10 days")
    run = once.writeStream.format("parquet").option("path", f"{root}/out")
    run.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    good = spark.read.schema(once.schema).parquet(f"{root}/out").filter("stage IS NULL")
    return good.groupBy("event_kind").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "incremental_upsert",
    over(
        """SELECT kind AS event_kind, count(*) AS row_count, count(DISTINCT event_id) AS ids
        FROM stg GROUP BY kind""",
    ),
)
def _(spark, sf):
    # the even events as they are, then all of them, some of them broken, then all of them repaired
    root = scratch_path(spark, "upsert")
    parsed = _typed_once(spark, sf, f"{root}/typed").filter("event_id IS NOT NULL")
    upsert.incremental_upsert(parsed.filter("event_id % 2 = 0"), root, star.BY_TABLE)
    upsert.incremental_upsert(parsed, root, star.BY_TABLE)
    lines = logs.to_log_batches(sample_data.messages(spark, sf, broken=False))
    upsert.incremental_upsert(facts.typed_events(parse.parse_lines(lines)), root, star.BY_TABLE)
    loaded = star.read_events(spark, root).filter("stage IS NULL")
    return loaded.groupBy("event_kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("ids")
    )


@query(
    "rejected_origins",
    f"""SELECT 'message' AS stage, 'collector' AS log_stream, count(*) FILTER (WHERE {BROKEN}) AS row_count,
        count(*) FILTER (WHERE {BROKEN}) AS rows_with_file FROM events
    UNION ALL SELECT 'batch', NULL, count(*) FILTER (WHERE {JUNK}), count(*) FILTER (WHERE {JUNK}) FROM events""",
)
def _(spark, sf):
    # by a stream into days, and each file the quarantine names is one of those delivered
    root = scratch_path(spark, "origins")
    files = spark.read.text(sample_data.raw_files(spark, sf)).select("_metadata.file_path").distinct()
    lines = stream.stream_lines(spark, sample_data.raw_files(spark, sf), origin=True)
    stream.stream_ingest(lines, f"{root}/star", f"{root}/checkpoint").awaitTermination()
    rejected = star.read_rejected(spark, f"{root}/star")
    known = rejected.join(files, F.col("source_file") == F.col("file_path"), "left")
    return known.groupBy("stage", "log_stream").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("file_path").alias("rows_with_file")
    )


_COUNTED = {
    "fact_api_requests": {"total_rows": "true", "rejected_rows": "cost_usd IS NULL OR duration_ms IS NULL OR input_tokens IS NULL OR output_tokens IS NULL"},
    "fact_tool_usage": {"total_rows": "true", "decision_rows": "decision <> ''", "result_rows": "is_success IS NOT NULL"},
    "fact_api_errors": {"total_rows": "true", "null_status_rows": "status_code IS NULL"},
    "fact_user_prompts": {"total_rows": "true", "null_length_rows": "prompt_length IS NULL"},
}


@query(
    "load_counts",
    over(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{d}' AS detail, count(*) FILTER (WHERE {c}) AS row_count FROM {t}"
            for t, details in _COUNTED.items()
            for d, c in details.items()
        )
        + f""" UNION ALL SELECT 'quarantine', 'message', count(*) FILTER (WHERE {BROKEN}) FROM all_stg
            UNION ALL SELECT 'quarantine', 'batch', count(*) FILTER (WHERE {JUNK}) FROM all_stg
            UNION ALL SELECT 'quarantine', 'timestamp', 0 UNION ALL SELECT 'quarantine', 'employee', 0
            UNION ALL SELECT 'unknown_body', 'total_rows', 0""",
        where=f"NOT {BROKEN}",
    ),
)
def _(spark, sf):
    # counted in the jobs that wrote the parts: a load of the even events, an upsert of all, a repeated delta
    root = _two_parts(spark, sf)
    again = facts.typed_events(_parsed(spark, sf))
    upsert.incremental_upsert(_even(again), root, star.BY_TABLE)
    return star.load_counts(spark, root)


_MOVED = 36 * 3600 * 1000


@query(
    "upsert_replaces",
    over(
        f"""SELECT event_id, kind AS event_kind, user_email,
        epoch_ms + CASE WHEN CAST(event_id AS BIGINT) % 10 = 0 THEN {_MOVED} ELSE 0 END AS epoch_ms,
        CASE WHEN kind = 'api_request' THEN TRY_CAST(cost_usd AS DOUBLE) END AS cost_usd FROM stg""",
        where=f"NOT {BROKEN}",
    ),
)
def _(spark, sf):
    # every tenth event comes again with another time, on another day, and then once more as it was then
    root = scratch_path(spark, "replaced")
    whole = sample_data.messages(spark, sf).filter(f"NOT ({sample_data.BROKEN_MESSAGE})")
    star.append_part(facts.typed_events(parse.parse_lines(logs.to_log_batches(whole))), root)
    moved = whole.filter("CAST(id AS BIGINT) % 10 = 0").withColumn("timestamp", F.col("timestamp") + _MOVED)
    delta = facts.typed_events(parse.parse_lines(logs.to_log_batches(moved)))
    upsert.incremental_upsert(delta, root)
    upsert.incremental_upsert(delta, root)
    return star.read_events(spark, root).select("event_id", "event_kind", "user_email", "epoch_ms", "cost_usd")


@query(
    "stream_without_repeats",
    over(f"SELECT {columns_of('fact_tool_usage')} FROM fact_tool_usage", where=f"NOT {BROKEN}"),
)
def _(spark, sf):
    # every line twice in the stream, and all files delivered again later: into a star by days, each event once
    root = scratch_path(spark, "once")
    for _ in range(2):
        spark.read.text(sample_data.raw_files(spark, sf)).write.mode("append").text(f"{root}/logs")
        lines = stream.stream_lines(spark, f"{root}/logs")
        twice = lines.select(F.explode(F.array("value", "value")).alias("value"))
        stream.stream_ingest(twice, f"{root}/star", f"{root}/checkpoint", lateness="10 days").awaitTermination()
    return star.read_star(spark, f"{root}/star").contract("fact_tool_usage")


_WINDOWS = f"""SELECT date_trunc('hour', {_AT}) AS window_start,
    date_trunc('hour', {_AT}) + INTERVAL 1 HOUR AS window_end, {COST.format('')} AS total_cost,
    {TOKENS.format('')} AS total_tokens, count(*) FILTER (WHERE kind = 'api_request') AS request_count,
    count(*) FILTER (WHERE kind = 'api_error') AS error_count
    FROM (SELECT epoch_ms, 'api_request' AS kind, cost_usd, input_tokens, output_tokens
        FROM fact_api_requests UNION ALL
        SELECT epoch_ms, 'api_error', NULL, NULL, NULL FROM fact_api_errors) GROUP BY 1, 2"""


@query("windowed_kpis", over(_WINDOWS, where=f"NOT {BROKEN}"))
def _(spark, sf):
    return windows.windowed_kpis(facts.typed_events(_parsed(spark, sf)))


@query("windowed_kpis_stream", over(_WINDOWS, where=f"NOT {BROKEN}"))
def _(spark, sf):
    # what the watermark has closed, and what is open at the end of the input
    root = scratch_path(spark, "windows")
    lines = stream.stream_lines(spark, sample_data.raw_files(spark, sf))
    windows.stream_windowed_kpis(lines, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return windows.read_windows(spark, f"{root}/out", f"{root}/checkpoint").drop("is_final")
