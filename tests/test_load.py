
import pytest

from tests.conftest import rows_of
from tests.test_parse import event, line
from usagelens.operators import quality
from usagelens.plans import ingest
from usagelens.schemas import (
    BODIES,
    CONTRACT,
    FACT_TABLES,
    DuplicateKeyError,
    MissingColumnsError,
    MissingSourceError,
)
from usagelens.sources import employees, star

WHO = {"session.id": "s1", "user.email": "alice@example.com"}


def message(kind, **attributes):
    return {"body": BODIES[kind], "attributes": {**WHO, **attributes}}


MADE_OF = {"input_tokens": "700", "output_tokens": "40", "model": "x-9", "duration_ms": "55"}
NINE_EVENTS = [
    message("user_prompt", prompt_length="31"),
    message("api_request", cost_usd="2.5", **MADE_OF),
    message("tool_decision", tool_name="Grep", decision="reject", source="hook"),
    message("api_request", cost_usd="12,5", **MADE_OF),
    message("tool_result", tool_name="Write", success="false", duration_ms="7"),
    message("tool_result", tool_name="Grep", success="true", duration_ms="8"),
    message("api_error", model="x-9", error="overloaded", status_code="503"),
    message("api_request", cost_usd="0.75", **MADE_OF),
    message("api_error", model="x-9", error="lost", status_code="none"),
]


@pytest.fixture
def inputs(tmp_path):
    logs_path, people = tmp_path / "logs.jsonl", tmp_path / "employees.csv"
    events = [event(m, id=f"e{i}") for i, m in enumerate(NINE_EVENTS)]
    extra = line(event({"body": "other"}, id="u"), event("junk", id="j"))
    logs_path.write_text("\n".join([line(*events), "junk", "", extra]) + "\n")
    people.write_text(
        "level,email,full_name,practice,extra,location\n"
        'L5,alice@example.com,"Doe, Alice",Backend,x,Germany\n'
    )
    return str(logs_path), str(people), str(tmp_path / "star")


@pytest.mark.parametrize("partition_by", [star.DAILY, star.BY_TABLE])
def test_load(spark, inputs, partition_by):
    logs_path, people, root = inputs
    ingest.load_star(spark, logs_path, people, root, partition_by)
    loaded = star.read_star(spark, root)
    counts = dict(rows_of(quality.row_counts(loaded)))
    assert counts == {
        "dim_employees": 1,
        "fact_api_requests": 3,
        "fact_tool_usage": 3,
        "fact_api_errors": 2,
        "fact_user_prompts": 1,
    }
    for name, schema in CONTRACT.items():
        assert loaded.contract(name).schema == schema
    costs = {r["cost_usd"] for r in loaded.fact_api_requests.collect()}
    assert costs == {None, 0.75, 2.5}
    assert {r["status_code"] for r in loaded.fact_api_errors.collect()} == {None, 503}
    assert loaded.dim_employees.first()["full_name"] == "Doe, Alice"
    assert rows_of(quality.reject_counts(loaded)) == [(3, 1)]
    assert rows_of(quality.tool_usage_counts(loaded)) == [(3, 1, 2)]
    # every event is somewhere
    assert rows_of(ingest.load_report(spark, root)) == [
        ("fact_api_errors", None, 2),
        ("fact_api_requests", None, 3),
        ("fact_tool_usage", None, 3),
        ("fact_user_prompts", None, 1),
        ("quarantine", "batch", 1),
        ("quarantine", "message", 1),
        ("unknown_body", "other", 1),
    ]
    assert star.read_quarantine(spark, root).count() == 2
    assert rows_of(star.read_unknown(spark, root).select("body")) == [("other",)]


def test_load_twice_gives_the_same_rows(spark, inputs):
    logs_path, people, root = inputs
    first = ingest.load_star(spark, logs_path, people, root)
    second = ingest.load_star(spark, logs_path, people, root)
    assert star.current_version(spark, root) == second != first
    for name in CONTRACT:
        a, b = (star.read_star(spark, root, v).contract(name) for v in (first, second))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_unfinished_load_is_not_seen(spark, inputs):
    logs_path, people, root = inputs
    first = ingest.load_star(spark, logs_path, people, root)
    dim = star.read_star(spark, root).dim_employees
    dim.write.parquet(f"{root}/versions/99999-crashed/dim_employees")
    assert star.current_version(spark, root) == first


def test_a_fact_reads_only_its_directory(spark, inputs):
    logs_path, people, root = inputs
    ingest.load_star(spark, logs_path, people, root)
    facts = star.read_star(spark, root).fact_api_errors
    plan = facts._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("PushedFilters")[0]
    assert "table" in filters
    # committed parts are read by their paths
    files = facts.inputFiles()
    assert files and all("/part=load/" in f for f in files)


def test_missing_inputs(spark, inputs, tmp_path):
    logs_path, people, root = inputs
    with pytest.raises(MissingSourceError):
        ingest.load_star(spark, logs_path, str(tmp_path / "no.csv"), root)
    with pytest.raises(MissingSourceError):
        ingest.load_star(spark, str(tmp_path / "no.jsonl"), people, root)
    with pytest.raises(MissingSourceError):
        star.read_star(spark, str(tmp_path / "nothing"))


def test_employee_columns(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("email,full_name,practice,level\na,b,c,d\n")
    with pytest.raises(MissingColumnsError, match="location"):
        employees.read_employees(spark, str(path))


def test_employees_round_trip(spark, tmp_path):
    rows = [("a@x", 'Quote "Q", Jr.', "P", "L1", None)]
    dim = spark.createDataFrame(rows, CONTRACT["dim_employees"])
    employees.write_employees(dim, str(tmp_path / "out"))
    assert rows_of(employees.read_employees(spark, str(tmp_path / "out"))) == rows


@pytest.mark.parametrize("emails", [["a", "a"], ["a", None]])
def test_employee_key(spark, emails):
    dim = spark.createDataFrame([(e, "n", "p", "L1", "x") for e in emails], CONTRACT["dim_employees"])
    with pytest.raises(DuplicateKeyError):
        quality.require_unique_dim(dim)


def test_orphans(make_star):
    facts = [(1, "s", e, "m", 1.0, 1, 1, 1, 1, 1) for e in ("known", "x", "x", "", None)]
    loaded = make_star(
        dim_employees=[("known", "n", "p", "L1", "l")],
        fact_api_requests=facts,
        fact_user_prompts=[(1, "s", "y", 5)],
    )
    assert sorted(rows_of(quality.orphan_emails(loaded))) == [
        ("fact_api_requests", "x"),
        ("fact_user_prompts", "y"),
    ]
    logged = []
    ingest.log_validation(loaded, logged.append)
    assert len(logged) == 2 * len(FACT_TABLES)
    assert any("fact_api_requests: 1 emails" in text for text in logged)


def test_event_totals(spark):
    staged = spark.createDataFrame(
        [(BODIES["api_request"], "1.5", 0), (BODIES["api_error"], "9", 86400000), (None, None, None)],
        "body STRING, cost_usd STRING, epoch_ms BIGINT",
    )
    row = quality.event_totals(staged).first()
    assert (row["event_count"], row["total_cost"]) == (3, 1.5)
    assert (str(row["first_day"]), str(row["last_day"])) == ("1970-01-01", "1970-01-02")
    assert len(rows_of(quality.event_counts_by_body(staged))) == 3


def test_rejected_rows_name_where_they_came_from(spark, inputs):
    logs_path, people, root = inputs
    with open(people, "a") as file:
        file.write("L1,short\n")
    ingest.load_star(spark, logs_path, people, root)
    found = {(r.stage, r.source_file.split("/")[-1], r.source_offset, r.log_stream) for r in star.read_rejected(spark, root).collect()}
    assert found == {("batch", "logs.jsonl", 0, None), ("message", "logs.jsonl", 0, None), ("employee", "employees.csv", 2, None)}
    # good rows carry none of it
    events = star.read_events(spark, root)
    assert events.filter("stage IS NULL AND (source_file IS NOT NULL OR log_stream IS NOT NULL)").isEmpty()
