import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelens.operators import facts, parse, quality
from usagelens.schemas import BODIES, STAGING_COLUMNS
from usagelens.sources import logs


def line(*events, **extra):
    return json.dumps({"messageType": "DATA_MESSAGE", "logEvents": list(events), **extra})


def event(message, id="e1", timestamp=1700000000000):
    text = message if isinstance(message, str) else json.dumps(message)
    return {"id": id, "timestamp": timestamp, "message": text}


def parsed(spark, *lines):
    return parse.parse_lines(spark.createDataFrame([(text,) for text in lines], "value STRING"))


def faults(df):
    return sorted(rows_of(parse.quarantine(df).select("stage", "reason")))


@pytest.mark.parametrize(
    "message",
    [
        *["not json", "", "[1]", "5", "null", '"text"', "{'body': 1}", '{"body": "a'],
        *['{"body": "a"} trailing', '{"body": "a"} {"body": "b"}', '{"body": "a"}, {"body": "b"}'],
        *['{"body": "a",}', '{"body": "a"}]', '{"body": "a"}}', '{"body": "a\tb"}'],
    ],
)
def test_malformed_messages_are_set_aside(spark, message):
    df = parsed(spark, line(event(message), event({"body": "ok"}, id="e2")))
    assert faults(df) == [("message", "malformed message")]
    assert parse.quarantine(df).first()["raw"] == message
    assert rows_of(parse.stage_events(df).select("event_id", "body")) == [("e2", "ok")]


@pytest.mark.parametrize(
    "message",
    ['{"x": NaN, "body": "a"}', '{"body": "x", "body": "a"}', ' {"body": "a"}\n', '{"body":"a"}\t'],
)
def test_odd_but_readable_messages_load(spark, message):
    df = parsed(spark, line(event(message)))
    assert rows_of(parse.stage_events(df).select("body")) == [("a",)]


@pytest.mark.parametrize(
    "text", ["not json", "[1]", "5", '{"logEvents": []} trailing', '{"logEvents": [', "{'a': 1}"]
)
def test_malformed_lines_are_set_aside(spark, text):
    df = parsed(spark, text, line(event({"body": "ok"})))
    assert faults(df) == [("batch", "malformed line")]
    assert parse.stage_events(df).count() == 1


def test_wrong_shapes_never_abort(spark):
    df = parsed(
        spark,
        '{"logEvents": null}',
        '{"logEvents": 5}',
        line(
            event('{"body": "a", "attributes": null}', id="x"),
            event('{"body": "a", "attributes": [1]}', id="y"),
            event({"body": "a"}, id="z", timestamp="noon"),
            {"id": "w", "timestamp": 1},
            event({"body": "fine"}, id="ok", timestamp="1700000000000.0"),
        ),
    )
    assert faults(df) == [
        ("batch", "logEvents is not a list of events"),
        ("batch", "logEvents is not a list of events"),
        ("message", "attributes is not an object"),
        ("message", "attributes is not an object"),
        ("message", "malformed message"),
        ("timestamp", "timestamp is not a number"),
    ]
    staged = parse.stage_events(df).select("event_id", "epoch_ms", "body")
    assert rows_of(staged) == [("ok", 1700000000000, "fine")]


def test_blank_lines_and_empty_batches_are_no_errors(spark):
    df = parsed(spark, "", "   ", "\t \r", "{}", line(), "  " + line(event({"body": "a"})) + " \t")
    assert faults(df) == []
    assert parse.stage_events(df).count() == 1


def test_attributes_and_aliases(spark):
    decision = {"tool_name": "Edit", "decision": "reject", "source": "user_reject"}
    result = {"decision_type": "accept", "decision_source": "config", "success": True}
    df = parsed(
        spark,
        line(
            event({"body": BODIES["tool_decision"], "attributes": decision}, id="d"),
            event({"body": BODIES["tool_result"], "attributes": result}, id="r"),
            event({"attributes": {"session.id": "", "user.email": 5, "cost_usd": 0.5}}, id="n"),
        ),
    )
    staged = parse.stage_events(df)
    assert staged.columns == ["event_id", *STAGING_COLUMNS]
    by_id = {r["event_id"]: r for r in staged.collect()}
    assert (by_id["d"]["decision"], by_id["d"]["decision_source"]) == ("reject", "user_reject")
    assert (by_id["r"]["decision"], by_id["r"]["decision_source"]) == ("accept", "config")
    assert by_id["r"]["success"] == "true"
    assert by_id["n"]["body"] is None and by_id["n"]["session_id"] is None
    assert (by_id["n"]["user_email"], by_id["n"]["cost_usd"]) == ("5", "0.5")
    assert rows_of(quality.unknown_body_counts(staged)) == [(None, 1)]


def test_other_attributes_stay_in_reach(spark):
    text = line(event({"body": "a", "attributes": {"organization.id": "o1", "attempt": "2"}}))
    events = parse.unnest_events(parse.parse_batch(spark.createDataFrame([(text,)], "value STRING")))
    messages = parse.parse_message(events, extra_attributes=("organization.id", "attempt"))
    picked = messages.selectExpr("message.attributes.`organization.id`", "message.attributes.attempt")
    assert rows_of(picked) == [("o1", "2")]


def test_each_text_is_decoded_once(spark):
    df = parsed(spark, line(event({"body": BODIES["api_request"]})))
    plan = facts.fact_api_requests(parse.stage_events(df))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 2  # the line and the message


def test_parse_errors_count_both_stages(spark):
    df = parsed(spark, "junk", line(event("junk"), event("junk", id="e2")))
    assert rows_of(parse.parse_errors(parse.quarantine(df))) == [("batch", 1), ("message", 2)]


def test_typed_events_agree_with_the_fact_builders(spark):
    attrs = {
        **{"session.id": "s", "user.email": "u", "model": "m", "cost_usd": "1.5"},
        **{"duration_ms": "12", "input_tokens": "1", "output_tokens": "2", "success": "true"},
        **{"cache_read_tokens": "3", "cache_creation_tokens": "x", "tool_name": "T"},
        **{"decision": "accept", "source": "c", "error": "e", "status_code": "429"},
        "prompt_length": "7",
    }
    events = [event({"body": b, "attributes": attrs}, id=k) for k, b in BODIES.items()]
    df = parsed(spark, line(*events))
    typed, staged = facts.typed_events(df), parse.stage_events(df)
    for build in (
        *(facts.fact_api_requests, facts.fact_tool_usage),
        *(facts.fact_api_errors, facts.fact_user_prompts),
    ):
        want = build(staged)
        got = typed.filter(F.col("table") == build.__name__).select(want.columns)
        assert sorted(map(str, rows_of(got))) == sorted(map(str, rows_of(want)))
        assert want.count() >= 1


def test_log_batches_round_trip(spark, tmp_path):
    rows = [(str(i), 1700000000000 + i, json.dumps({"body": f"b{i}"})) for i in range(57)]
    events = spark.createDataFrame(rows, "id STRING, timestamp BIGINT, message STRING").coalesce(1)
    path = str(tmp_path / "logs")
    logs.write_log_batches(events, path)
    lines = logs.read_log_batches(spark, path)
    batches = [json.loads(r["value"]) for r in lines.collect()]
    assert [len(b["logEvents"]) for b in batches] == [10, 10, 10, 10, 10, 7]
    assert (batches[0]["year"], batches[0]["month"], batches[0]["day"]) == (2023, 11, 14)
    back = parse.stage_events(parse.parse_lines(lines)).select("event_id", "epoch_ms", "body")
    assert sorted(rows_of(back)) == sorted((i, t, json.loads(m)["body"]) for i, t, m in rows)


@pytest.mark.parametrize("tail", ["] junk }", "]}", "] }", "}", " {}", ",{}", "] junk", "]", ' ]{"a":1}'])
def test_text_after_the_object_makes_it_malformed(spark, tail):
    text = line(event({"body": "x"})) + tail
    assert parse.parse_batch(spark.createDataFrame([(text,)], "value STRING")).first()["batch_error"] == "malformed line"
