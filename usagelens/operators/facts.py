"""Typed facts from staged events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions.casts import (
    to_bool,
    to_date,
    to_double,
    to_int,
    to_long,
)
from usagelens.schemas import (
    BODIES,
    CONTRACT,
    FACT_TABLES,
    QUARANTINE_TABLE,
    TABLE_OF_KIND,
    TYPED_EVENT,
    UNKNOWN_TABLE,
    Star,
)

LONGS = ("duration_ms", "input_tokens", "output_tokens", "cache_read_tokens", "cache_creation_tokens")


def safe_cast(name: str) -> str:
    """A staging text column in its fact type; NULL where the text does not convert."""
    if name == "cost_usd":
        return to_double(name)
    if name == "status_code":
        return to_int(name)
    if name == "is_success":
        return to_bool("success")
    if name in (*LONGS, "prompt_length"):
        return to_long(name)
    return name


def _select(rows: DataFrame, table: str, **fixed: str) -> DataFrame:
    """Rows in the columns of `table`; `fixed` replaces or adds single columns."""
    columns = {name: safe_cast(name) for name in CONTRACT[table].fieldNames()} | fixed
    return rows.selectExpr(*[f"{value} AS {name}" for name, value in columns.items()])


def _of_kinds(stg: DataFrame, *kinds: str) -> DataFrame:
    return stg.filter(F.col("body").isin([BODIES[kind] for kind in kinds]))


def fact_api_requests(stg: DataFrame) -> DataFrame:
    return _select(_of_kinds(stg, "api_request"), "fact_api_requests")


def tool_decisions(stg: DataFrame) -> DataFrame:
    return _select(
        _of_kinds(stg, "tool_decision"),
        "fact_tool_usage",
        is_success="CAST(NULL AS BOOLEAN)",
        duration_ms="CAST(NULL AS BIGINT)",
        event_kind="'tool_decision'",
    )


def tool_results(stg: DataFrame) -> DataFrame:
    """Results keep their decision columns, as decisions do."""
    return _select(
        _of_kinds(stg, "tool_result"), "fact_tool_usage", event_kind="'tool_result'"
    )


def fact_tool_usage(stg: DataFrame) -> DataFrame:
    """Decisions and results in one table, from one scan.

    event_kind tells them apart; it is not part of the contract.
    """
    is_result = f"body = '{BODIES['tool_result']}'"
    return _select(
        _of_kinds(stg, "tool_decision", "tool_result"),
        "fact_tool_usage",
        is_success=f"CASE WHEN {is_result} THEN {safe_cast('is_success')} END",
        duration_ms=f"CASE WHEN {is_result} THEN {safe_cast('duration_ms')} END",
        event_kind=f"CASE WHEN {is_result} THEN 'tool_result' ELSE 'tool_decision' END",
    )


def fact_api_errors(stg: DataFrame) -> DataFrame:
    return _select(_of_kinds(stg, "api_error"), "fact_api_errors")


def fact_user_prompts(stg: DataFrame) -> DataFrame:
    return _select(_of_kinds(stg, "user_prompt"), "fact_user_prompts")


def build_star(dim: DataFrame, stg: DataFrame) -> Star:
    """Lazy star over staged events that are cheap to read again (a table, not raw text)."""
    return Star(
        dim_employees=dim.select(*CONTRACT["dim_employees"].fieldNames()),
        fact_api_requests=fact_api_requests(stg),
        fact_tool_usage=fact_tool_usage(stg),
        fact_api_errors=fact_api_errors(stg),
        fact_user_prompts=fact_user_prompts(stg),
    )


def _by_body(values: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{BODIES[kind]}' THEN '{value}'" for kind, value in values.items())
    return f"CASE body {whens} END"


def _typed_column(name: str) -> str:
    """A typed column, set only for the kinds of event whose table carries it."""
    if name in ("is_success", "duration_ms"):
        # decisions share a table with results but have neither
        condition = "event_kind IN ('tool_result', 'api_request')"
    else:
        owners = [t for t in FACT_TABLES if name in CONTRACT[t].fieldNames()]
        if not owners or owners == FACT_TABLES:
            return name
        condition = f"table IN ({', '.join(map(repr, owners))})"
    return f"CASE WHEN {condition} THEN {safe_cast(name)} END AS {name}"


def typed_events(parsed: DataFrame) -> DataFrame:
    """Every parsed row, typed and labelled with the table it belongs to.

    One projection covers all facts, the quarantine and unknown bodies: the text is parsed once
    however many tables are filled.
    """
    labelled = parsed.selectExpr(
        "*",
        f"CASE WHEN stage IS NULL THEN {_by_body({k: k for k in BODIES})} END AS event_kind",
        f"CASE WHEN stage IS NOT NULL THEN '{QUARANTINE_TABLE}' "
        f"ELSE coalesce({_by_body(TABLE_OF_KIND)}, '{UNKNOWN_TABLE}') END AS table",
    ).withColumn("event_date", to_date(F.col("epoch_ms")))
    return labelled.selectExpr(*[_typed_column(name) for name in TYPED_EVENT.fieldNames()])


def quarantined(rejected: DataFrame) -> DataFrame:
    """Rejected rows that are no events, in the columns of typed events: those they have, the others empty."""
    given = {c: F.col(c) for c in rejected.columns} | {"table": F.lit(QUARANTINE_TABLE)}
    return rejected.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TYPED_EVENT.fields]
    )
