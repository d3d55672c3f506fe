"""The sample tables (events, customer, nation) seen as telemetry.

They hold no telemetry of their own, so each event row stands for one log event and each customer
for an employee; FIXTURES.md lists the mapping. 5 % of the users have no employee on purpose, and
some costs and messages are broken on purpose.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import facts, parse
from usagelens.schemas import ATTRIBUTE_KEYS, BODIES, Star
from usagelens.session import configure, scratch_path
from usagelens.sources import employees, logs

KIND_OF_EVENT_TYPE = {
    "view": "api_request",
    "click": "tool_decision",
    "purchase": "tool_result",
    "error": "api_error",
}
OTHER_KIND = "user_prompt"

# In the raw form, every 101st message is cut off and every 1000th event adds a line of junk.
BROKEN_MESSAGE = "CAST(id AS BIGINT) % 101 = 0"
JUNK_LINE = "event_id % 1000 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dim_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .selectExpr(
            "concat('user', c_custkey, '@example.com') AS email",
            "c_name AS full_name",
            "c_mktsegment AS practice",
            "concat('L', c_nationkey % 10 + 1) AS level",
            "n_name AS location",
        )
    )


def _by_event_type(values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{t}' THEN '{values[k]}'" for t, k in KIND_OF_EVENT_TYPE.items())
    return f"CASE event_type {whens} ELSE '{values[OTHER_KIND]}' END"


def events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Event rows, of some kinds only if given; that filter reaches the scan."""
    rows = table(spark, sf_dir, "events")
    if not kinds:
        return rows
    wanted = F.col("event_type").isin([t for t, k in KIND_OF_EVENT_TYPE.items() if k in kinds])
    if OTHER_KIND in kinds:
        other = ~F.col("event_type").isin(list(KIND_OF_EVENT_TYPE))
        wanted = wanted | other | F.col("event_type").isNull()
    return rows.filter(wanted)


def _epoch_ms() -> str:
    """`ts` has no zone and is taken as UTC."""
    since = "CAST(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND)"
    return f"CAST(floor(CAST({since} AS DECIMAL(20, 6)) * 1000) AS BIGINT)"


def _user(row_id: str = "event_id") -> str:
    """Some events have no address, some one that no employee has."""
    return (
        f"CASE WHEN {row_id} % 89 = 0 THEN NULL WHEN {row_id} % 83 = 7 "
        "THEN concat('guest', user_id, '@example.com') ELSE concat('user', user_id, '@example.com') END"
    )


def staged_events(rows: DataFrame) -> DataFrame:
    """The staging columns, computed straight from the event rows (no JSON in between)."""
    status = (
        "CASE event_id % 7 WHEN 0 THEN '429' WHEN 1 THEN '400' WHEN 2 THEN '500' "
        "WHEN 3 THEN '401' ELSE 'undefined' END"
    )
    return rows.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        f"{_epoch_ms()} AS epoch_ms",
        f"{_by_event_type(BODIES)} AS body",
        "concat('s', user_id, '-', CAST(ts AS DATE)) AS session_id",
        f"{_user()} AS user_email",
        f"{_by_event_type({kind: kind for kind in BODIES})} AS event_name",
        "CASE WHEN event_id % 61 <> 0 THEN concat('model-', event_id % 5) END AS model",
        "CASE WHEN event_id % 97 = 0 THEN 'not_a_number' ELSE CAST(value AS STRING) END"
        " AS cost_usd",
        "CAST(CAST(ROUND(value * 100) AS BIGINT) AS STRING) AS duration_ms",
        "CAST(event_id % 900 AS STRING) AS input_tokens",
        "CAST(event_id % 450 + 1 AS STRING) AS output_tokens",
        "CAST(event_id * 37 % 90000 AS STRING) AS cache_read_tokens",
        "CAST(event_id * 13 % 6000 AS STRING) AS cache_creation_tokens",
        "CASE WHEN event_type = 'click' AND event_id % 50 = 3 THEN 'reject'"
        " WHEN event_type IN ('click', 'purchase') THEN 'accept' END AS decision",
        "CASE WHEN event_type IN ('click', 'purchase') THEN 'config' END AS decision_source",
        "concat('tool-', event_id % 6) AS tool_name",
        "CASE WHEN event_id % 15 = 0 THEN 'false' ELSE 'true' END AS success",
        f"concat('err-', {status}) AS error_message",
        f"{status} AS status_code",
        "CAST(CAST(ROUND(value * 10) AS BIGINT) AS STRING) AS prompt_length",
    )


@lru_cache(maxsize=8)
def sample_star(spark: SparkSession, sf_dir: str) -> Star:
    def staged(*kinds: str) -> DataFrame:
        return staged_events(events(spark, sf_dir, *kinds))

    return Star(
        dim_employees=dim_employees(spark, sf_dir),
        fact_api_requests=facts.fact_api_requests(staged("api_request")),
        fact_tool_usage=facts.fact_tool_usage(staged("tool_decision", "tool_result")),
        fact_api_errors=facts.fact_api_errors(staged("api_error")),
        fact_user_prompts=facts.fact_user_prompts(staged("user_prompt")),
    )


def _spread(rows: DataFrame) -> DataFrame:
    """Give every core a share of a small file; large inputs come in enough splits already.

    The text built from a row is many times its size, so this is done before it is built.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _message() -> str:
    """The JSON text of one event; tool results spell their decision keys differently."""
    pairs = []
    for name, keys in ATTRIBUTE_KEYS.items():
        if len(keys) == 1:
            pairs.append(f"'{keys[0]}', {name}")
        else:
            pairs.append(f"'{keys[0]}', CASE WHEN event_name <> 'tool_result' THEN {name} END")
            pairs.append(f"'{keys[1]}', CASE WHEN event_name = 'tool_result' THEN {name} END")
    attributes = f"named_struct({', '.join(pairs)})"
    return f"to_json(named_struct('body', body, 'attributes', {attributes}))"


def messages(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    """(id, timestamp, message) per event; `broken` cuts the end off some messages."""
    whole = staged_events(_spread(events(spark, sf_dir))).selectExpr(
        "event_id AS id", "epoch_ms AS timestamp", f"{_message()} AS message"
    )
    if not broken:
        return whole
    cut = f"CASE WHEN {BROKEN_MESSAGE} THEN left(message, length(message) - 5) ELSE message END"
    return whole.selectExpr("id", "timestamp", f"{cut} AS message")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log batch lines with some broken messages, junk lines and blank lines among them."""
    good = logs.to_log_batches(messages(spark, sf_dir))
    junk = events(spark, sf_dir).filter(JUNK_LINE)
    lines = F.explode(F.array(F.lit("not json"), F.lit("   "), F.lit("")))
    return good.unionByName(junk.select(lines.alias("value")))


_written: dict[tuple[str, ...], str] = {}


def written_once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of sample files under the shared folder, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    return written_once(
        spark,
        sf_dir,
        "raw-logs",
        lambda path: raw_lines(spark, sf_dir).write.mode("overwrite").text(path),
    )


def employee_files(spark: SparkSession, sf_dir: str) -> str:
    """Employee CSV with its columns in another order and one column too many."""
    shuffled = dim_employees(spark, sf_dir).select(
        "location", "email", F.lit("x").alias("extra"), "level", "practice", "full_name"
    )
    return written_once(
        spark,
        sf_dir,
        "employees",
        lambda path: shuffled.write.mode("overwrite").options(**employees.CSV).csv(path),
    )


# Of every fifty employees one record lacks a field, one has one too many and one an unclosed quote; the names of
# others hold a line break.
BROKEN_RECORDS = {0: "too few fields", 1: "too many fields", 2: "broken quotes"}


def broken_employee_files(spark: SparkSession, sf_dir: str) -> str:
    """Employee CSV with malformed records and with line breaks inside good ones."""
    names = employees.COLUMNS
    rows = dim_employees(spark, sf_dir).withColumn("k", F.regexp_extract("email", "[0-9]+", 0).cast("long"))
    rows = rows.withColumn(
        "full_name", F.when(F.col("k") % 7 == 0, F.concat(F.col("full_name"), F.lit('\n"Jr"'))).otherwise(F.col("full_name"))
    )
    kind = F.col("k") % 50
    quoted = [F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in names]
    plain = [F.regexp_replace(F.col(c), '\n"Jr"', "") for c in names]
    line = (
        F.when(kind == 0, F.concat_ws(",", *plain[:-1]))
        .when(kind == 1, F.concat_ws(",", *plain, F.lit("more")))
        .when(kind == 2, F.concat_ws(",", F.concat(F.lit('"'), plain[0]), *plain[1:]))
        .otherwise(F.concat_ws(",", *quoted))
    )
    return written_once(
        spark,
        sf_dir,
        "broken-employees",
        lambda path: employees.with_header(rows.select(line.alias("value")), ",".join(names)).write.mode("overwrite").text(path),
    )


def raw_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging columns after the way through JSON text."""
    return parse.stage_events(parse.parse_lines(raw_lines(spark, sf_dir)))


