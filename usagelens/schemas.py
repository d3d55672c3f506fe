"""Input formats, table contracts and the fixed values both depend on."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The message bodies found in the log data, by kind of event.
BODIES = {
    "api_request": "claude_code.api_request",
    "tool_decision": "claude_code.tool_decision",
    "tool_result": "claude_code.tool_result",
    "api_error": "claude_code.api_error",
    "user_prompt": "claude_code.user_prompt",
}

# The fact table each kind of event belongs to.
TABLE_OF_KIND = {
    "api_request": "fact_api_requests",
    "tool_decision": "fact_tool_usage",
    "tool_result": "fact_tool_usage",
    "api_error": "fact_api_errors",
    "user_prompt": "fact_user_prompts",
}

# Staging column -> attribute keys in the message, first present one wins.
ATTRIBUTE_KEYS = {
    "session_id": ("session.id",),
    "user_email": ("user.email",),
    "event_name": ("event.name",),
    "model": ("model",),
    "cost_usd": ("cost_usd",),
    "duration_ms": ("duration_ms",),
    "input_tokens": ("input_tokens",),
    "output_tokens": ("output_tokens",),
    "cache_read_tokens": ("cache_read_tokens",),
    "cache_creation_tokens": ("cache_creation_tokens",),
    "decision": ("decision", "decision_type"),
    "decision_source": ("source", "decision_source"),
    "tool_name": ("tool_name",),
    "success": ("success",),
    "error_message": ("error",),
    "status_code": ("status_code",),
    "prompt_length": ("prompt_length",),
}

STAGING_COLUMNS = ["epoch_ms", "body", *ATTRIBUTE_KEYS]

UNKNOWN_TABLE = "unknown_body"
QUARANTINE_TABLE = "quarantine"


TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def struct(**columns: str | T.DataType) -> T.StructType:
    """A struct from name=type; unlike DDL text it needs no running session."""
    fields_ = [(n, TYPES[t] if isinstance(t, str) else t) for n, t in columns.items()]
    return T.StructType([T.StructField(n, t) for n, t in fields_])


# Timestamps are read as text so that one bad value costs one event, not its whole batch.
EVENT = struct(id="string", timestamp="string", message="string")
# The rest of a batch (owner, log group, date parts, ...) is not read.
BATCH = struct(logEvents=T.ArrayType(EVENT), logStream="string")
# Where a line was read: its file, and where the piece of the file begins that a task read.
ORIGIN = ["source_file", "source_offset"]

CONTRACT = {
    "dim_employees": struct(
        email="string", full_name="string", practice="string", level="string", location="string"
    ),
    "fact_api_requests": struct(
        epoch_ms="bigint",
        session_id="string",
        user_email="string",
        model="string",
        cost_usd="double",
        duration_ms="bigint",
        input_tokens="bigint",
        output_tokens="bigint",
        cache_read_tokens="bigint",
        cache_creation_tokens="bigint",
    ),
    "fact_tool_usage": struct(
        epoch_ms="bigint",
        session_id="string",
        user_email="string",
        tool_name="string",
        decision="string",
        decision_source="string",
        is_success="boolean",
        duration_ms="bigint",
    ),
    "fact_api_errors": struct(
        epoch_ms="bigint",
        session_id="string",
        user_email="string",
        model="string",
        error_message="string",
        status_code="int",
    ),
    "fact_user_prompts": struct(
        epoch_ms="bigint", session_id="string", user_email="string", prompt_length="bigint"
    ),
}

FACT_TABLES = [name for name in CONTRACT if name.startswith("fact_")]

# One row per input event, typed. The fact tables are column subsets of this, one partition each,
# so a single pass over the raw text fills all of them; columns a kind never has cost nothing in
# parquet. event_id and event_kind serve de-duplication and the decision-only tool report.
TYPED_EVENT = struct(
    event_id="string",
    event_kind="string",
    body="string",
    **{f.name: f.dataType for t in FACT_TABLES for f in CONTRACT[t]},
    stage="string",
    reason="string",
    raw="string",
    # of rejected rows only
    source_file="string",
    source_offset="bigint",
    log_stream="string",
    table="string",
    event_date="date",
)


@dataclass(frozen=True)
class Star:
    """The five tables every metric reads."""

    dim_employees: DataFrame
    fact_api_requests: DataFrame
    fact_tool_usage: DataFrame
    fact_api_errors: DataFrame
    fact_user_prompts: DataFrame

    def table(self, name: str) -> DataFrame:
        if name not in CONTRACT:
            raise UnknownTableError(f"table '{name}' not found; expected one of {sorted(CONTRACT)}")
        return getattr(self, name)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def contract(self, name: str) -> DataFrame:
        """The table with its public columns only."""
        return self.table(name).select(*CONTRACT[name].fieldNames())

    def register_views(self) -> None:
        for name in self.tables():
            self.contract(name).createOrReplaceTempView(name)


class TelemetryError(Exception):
    """Base of the errors raised here."""


class MissingSourceError(TelemetryError):
    """An input path does not exist."""


class MissingColumnsError(TelemetryError):
    """The employee file lacks a required column."""


class DuplicateKeyError(TelemetryError):
    """dim_employees has a missing or repeated email."""


class CommitConflictError(TelemetryError):
    """Another writer changed the star meanwhile."""


class UnknownTableError(TelemetryError):
    """A table name is not part of the star."""


class QueryError(TelemetryError):
    """An ad-hoc statement failed."""
