"""From JSON lines to staged events, with everything malformed kept aside.

Every step is a narrow projection of built-in functions, so the same code serves batch and
streaming input. Rows that fail a step stay in the frame with `stage`, `reason` and `raw` set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.functions.casts import blank_to_null, to_long
from usagelens.schemas import ATTRIBUTE_KEYS, BATCH, EVENT, ORIGIN, STAGING_COLUMNS, TYPED_EVENT, struct
from usagelens.sources.logs import clean_lines

# What follows every text; a text that holds it and ends the array itself could still pass.
END_MARK = "__usagelens_end_of_text"


def _decode(text: str, schema: T.StructType) -> str:
    """Column __p: an array of the one JSON object in `text`, or something else if malformed.

    The JSON reader stops after the first value and would accept `{...} garbage`. Inside an array
    it has to read on, and the array has to end with the mark that follows the text: garbage after
    the object makes it malformed or longer, and a text that closes it early leaves the mark unread.

    The explode of one value keeps a row a row. It is there because filters are not pushed through
    it: through a plain projection they would be, and decode the text once more per filter.
    """
    marked = T.StructType([*schema.fields, T.StructField(END_MARK, T.BooleanType())])
    mark = f',{{"{END_MARK}":true}}]'
    decoded = (
        f"from_json(concat('[', {text}, '{mark}'), 'ARRAY<{marked.simpleString()}>', "
        "map('allowSingleQuotes', 'false'))"
    )
    return f"explode(array({decoded})) AS __p"


def _is_single(parsed: str) -> str:
    one = f"size({parsed}) = 2 AND get({parsed}, 0) IS NOT NULL AND get({parsed}, 0).{END_MARK} IS NULL"
    return f"coalesce({one} AND get({parsed}, 1).{END_MARK}, false)"


def parse_batch(lines: DataFrame) -> DataFrame:
    """Decode each line into `batch`; undecodable lines get a reason instead."""
    origin = [c if c in lines.columns else f"CAST(NULL AS {TYPED_EVENT[c].dataType.simpleString()}) AS {c}" for c in ORIGIN]
    parsed = lines.selectExpr("value", *origin, _decode("value", BATCH))
    ok = _is_single("__p")
    return parsed.selectExpr(
        "value",
        *ORIGIN,
        f"CASE WHEN {ok} THEN get(__p, 0) END AS batch",
        f"""CASE WHEN NOT {ok} THEN 'malformed line'
            WHEN get(__p, 0).logEvents IS NULL AND contains(value, '"logEvents"')
            THEN 'logEvents is not a list of events' END AS batch_error""",
    )


def unnest_events(batches: DataFrame) -> DataFrame:
    """One row per event; a rejected line passes as a single row with an empty event."""
    # the line is dropped before the explode, or it would be copied once per event
    slim = batches.selectExpr(
        "CASE WHEN batch_error IS NOT NULL THEN value END AS line",
        "batch_error",
        *ORIGIN,
        "batch.logStream AS log_stream",
        f"""CASE WHEN batch_error IS NOT NULL
            THEN array(CAST(NULL AS {EVENT.simpleString()}))
            ELSE batch.logEvents END AS events""",
    )
    return slim.selectExpr("line", "batch_error", *ORIGIN, "log_stream", "explode(events) AS event")


def _message_schema(extra_attributes: tuple[str, ...]) -> T.StructType:
    keys = [key for keys in ATTRIBUTE_KEYS.values() for key in keys]
    keys += [key for key in extra_attributes if key not in keys]
    return struct(body="string", attributes=struct(**{f"`{key}`": "string" for key in keys}))


def parse_message(events: DataFrame, extra_attributes: tuple[str, ...] = ()) -> DataFrame:
    """Decode the message inside each event and settle whether the event is usable.

    Only the listed attributes are read. `extra_attributes` adds others, such as
    `organization.id`; they end up in the `message.attributes` struct.
    """
    text = "event.message"
    parsed = events.selectExpr(
        "line",
        "batch_error",
        *ORIGIN,
        "log_stream",
        "event",
        f"{blank_to_null('event.timestamp')} AS time_text",
        _decode(text, _message_schema(extra_attributes)),
    )
    ok = _is_single("__p")
    judged = parsed.selectExpr(
        "line",
        *ORIGIN,
        "log_stream",
        "event",
        "__p",
        f"{to_long('time_text')} AS epoch_ms",
        f"""CASE WHEN batch_error IS NOT NULL THEN named_struct('stage', 'batch', 'reason', batch_error)
            WHEN NOT {ok} THEN named_struct('stage', 'message', 'reason', 'malformed message')
            WHEN get(__p, 0).attributes IS NULL AND contains({text}, '"attributes"')
            THEN named_struct('stage', 'message', 'reason', 'attributes is not an object')
            WHEN time_text IS NOT NULL AND {to_long('time_text')} IS NULL
            THEN named_struct('stage', 'timestamp', 'reason', 'timestamp is not a number')
            END AS fault""",
    )
    return judged.selectExpr(
        "event.id AS event_id",
        "epoch_ms",
        "CASE WHEN fault IS NULL THEN get(__p, 0) END AS message",
        "fault.stage AS stage",
        "fault.reason AS reason",
        f"CASE WHEN fault.stage = 'batch' THEN line WHEN fault IS NOT NULL THEN {text} END AS raw",
        *[f"CASE WHEN fault IS NOT NULL THEN {c} END AS {c}" for c in (*ORIGIN, "log_stream")],
    )


def _attribute(key: str) -> str:
    return f"message.attributes.`{key}`"


def _first_present(keys: tuple[str, ...]) -> str:
    return f"coalesce({', '.join(map(_attribute, keys))})" if keys[1:] else _attribute(keys[0])


def alias_decision() -> str:
    return _first_present(ATTRIBUTE_KEYS["decision"])


def alias_source() -> str:
    return _first_present(ATTRIBUTE_KEYS["decision_source"])


def project_attributes(messages: DataFrame) -> DataFrame:
    """The nineteen staging columns as text, empty values as NULL."""
    texts = {name: _first_present(keys) for name, keys in ATTRIBUTE_KEYS.items()}
    texts |= {"decision": alias_decision(), "decision_source": alias_source()}
    return messages.selectExpr(
        "event_id",
        "epoch_ms",
        f"{blank_to_null('message.body')} AS body",
        *[f"{blank_to_null(text)} AS {name}" for name, text in texts.items()],
        "stage",
        "reason",
        "raw",
        *ORIGIN,
        "log_stream",
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """All steps in a row: good events and rejected ones in one frame."""
    steps = [clean_lines, parse_batch, unnest_events, parse_message, project_attributes]
    return reduce(lambda df, step: step(df), steps, lines)


def stage_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("stage").isNull()).select("event_id", *STAGING_COLUMNS)


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("stage").isNotNull()).select("stage", "reason", "raw", "event_id")


def parse_errors(rejected: DataFrame) -> DataFrame:
    """Rejected rows per stage; the sum over stages is the total."""
    return rejected.groupBy("stage").agg(F.count(F.lit(1)).alias("error_count")).orderBy("stage")
