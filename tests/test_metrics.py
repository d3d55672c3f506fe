import pytest

from tests.conftest import rows_of
from usagelens.operators import charts, findings, metrics
from usagelens.schemas import TelemetryError

ANA, BO, CY = "ana@x.org", "bo@x.org", "cy@x.org"
BIG, TINY = "x-opus-1", "y-haiku-2"
T0 = 1700000000000


@pytest.fixture
def star(make_star):
    """Two people in one practice and one in another; numbers that are easy to add up."""
    return make_star(
        dim_employees=[
            (ANA, "Ana", "Data", "L8", "Peru"),
            (BO, "Bo", "Data", "L2", "Chad"),
            (CY, "Cy", "Web", "L6", "Fiji"),
        ],
        fact_api_requests=[
            (T0, "p1", ANA, BIG, 1.5, 2000, 300, 100, 600, 50),
            (T0 + 60000, "p1", ANA, BIG, 0.5, 4000, 100, 100, 0, 0),
            (T0, "p2", BO, TINY, 0.25, 3000, 200, 200, 200, 40),
            (T0, "p3", CY, TINY, 0.75, 3000, 400, 600, 0, 10),
        ],
        fact_tool_usage=[
            (T0, "p1", ANA, "Grep", "accept", "hook", None, None),
            (T0, "p1", ANA, "Grep", None, None, True, 100),
            (T0, "p2", BO, "Grep", None, None, False, 300),
            (T0, "p2", BO, "Write", "reject", "user", None, None),
            (T0, "p3", CY, "Write", "accept", "user", None, None),
            (T0, "p3", CY, "Write", None, None, True, 20),
        ],
        fact_api_errors=[(T0, "p1", ANA, BIG, "overloaded", 529)],
        fact_user_prompts=[
            (T0, "p1", ANA, 40),
            (T0 + 9000, "p1", ANA, 60),
            (T0 + 9500, "p1", ANA, 80),
            (T0, "p2", BO, 100),
        ],
    )


def test_kpis(star):
    assert rows_of(metrics.total_cost(star)) == [(3.0,)]
    assert rows_of(metrics.total_tokens(star)) == [(2000,)]
    assert metrics.cache_read_ratio(star).first()[0] == pytest.approx(100 * 800 / 1900)
    assert rows_of(metrics.api_error_rate(star)) == [(20.0,)]
    assert rows_of(metrics.kpis(star)) == [(3.0, 2000, 42.1, 20.0)]


def test_kpis_of_nothing(make_star):
    assert rows_of(metrics.kpis(make_star())) == [(0.0, 0, 0.0, 0.0)]
    assert rows_of(metrics.cost_by_practice(make_star())) == []
    assert rows_of(charts.prompts_per_session_stats(make_star())) == [(None, None)]


def test_costs(star):
    assert rows_of(metrics.cost_by_practice(star)) == [("Data", 2.25, 1000, 3), ("Web", 0.75, 1000, 1)]
    assert [r["level"] for r in metrics.cost_by_level(star).collect()] == ["L2", "L6", "L8"]
    assert sorted(rows_of(metrics.token_efficiency_by_practice(star))) == [
        ("Data", 750.0, 53.7, 3000.0),
        ("Web", 750.0, 0.0, 3000.0),
    ]


def test_levels_sort_by_number_and_odd_ones_come_last(make_star):
    levels = ["L10", "Lx", "L9", None, "L1"]
    dim = [(f"u{i}", "n", "p", level, "x") for i, level in enumerate(levels)]
    facts = [(T0, "s", f"u{i}", "m", 1.0, 1, 1, 1, 1, 1) for i in range(len(levels))]
    out = metrics.cost_by_level(make_star(dim_employees=dim, fact_api_requests=facts))
    assert [r["level"] for r in out.collect()] == ["L1", "L9", "L10", "Lx", None]


def test_one_user_with_most_rows_and_unknown_users(make_star):
    request = ("m", 0.1, 10, 1, 1, 1, 1)
    facts = [(T0 + i, "s", "hot", *request) for i in range(300)]
    facts += [(T0, "s", e, *request) for e in ("cold", "stranger", None)]
    dim = [("hot", "n", "P", "L1", "x"), ("cold", "n", "P", "L2", "x")]
    out = metrics.cost_by_practice(make_star(dim_employees=dim, fact_api_requests=facts))
    assert rows_of(out) == [("P", 30.1, 602, 301)]


def test_null_numbers(make_star):
    facts = [
        (T0, "s", "u", "m", None, None, None, 5, 7, None),
        (T0, "s", "u", "m", 2.0, 10, 1, 2, 3, 4),
    ]
    star = make_star(fact_api_requests=facts, dim_employees=[("u", "n", "P", "L1", "x")])
    assert rows_of(metrics.total_tokens(star)) == [(3,)]
    # the numerator keeps rows whose denominator term is missing
    assert metrics.cache_read_ratio(star).first()[0] == pytest.approx(100 * 10 / 8)
    assert rows_of(metrics.token_efficiency_by_practice(star)) == [("P", 2000.0, 125.0, 10.0)]


def test_models(star):
    assert sorted(rows_of(metrics.model_usage_breakdown(star))) == [(BIG, 2, 2.0, 600), (TINY, 2, 1.0, 1400)]
    assert sorted(rows_of(metrics.error_rate_by_model(star))) == [(BIG, 2, 1, 33.3), (TINY, 2, 0, 0.0)]
    assert sorted(rows_of(charts.request_share_by_model(star))) == [(BIG, 2, 50.0), (TINY, 2, 50.0)]
    assert sorted(rows_of(metrics.api_request_latency_by_model(star))) == [
        (BIG, 2, 3000.0, 3000.0, 3900.0, 4000),
        (TINY, 2, 3000.0, 3000.0, 3000.0, 3000),
    ]
    family = rows_of(findings.cost_by_model_family(star).select("family", "request_count"))
    assert family == [("opus", 2), ("haiku", 2)]


def test_missing_models_do_not_meet(make_star):
    star = make_star(
        fact_api_requests=[(T0, "s", "u", None, 1.0, 0, 1, 1, 1, 1)],
        fact_api_errors=[(T0, "s", "u", None, "e", None)],
    )
    rates = sorted(rows_of(metrics.error_rate_by_model(star)), key=str)
    assert rates == [(None, 0, 1, 100.0), (None, 1, 0, 0.0)]
    # but they are one group, and a duration of 0 counts here
    assert rows_of(metrics.api_request_latency_by_model(star)) == [(None, 1, 0.0, 0.0, 0.0, 0)]


def test_tools(star):
    assert rows_of(metrics.tool_usage_frequency(star)) == [("Write", 2, 1, 50.0), ("Grep", 1, 0, 0.0)]
    assert rows_of(metrics.tool_success_rates(star)) == [
        ("Grep", 2, 1, 50.0, 200.0, 290.0),
        ("Write", 1, 1, 100.0, 20.0, 20.0),
    ]
    assert rows_of(metrics.high_latency_tools(star))[0] == ("Grep", 2, 200.0, 200.0, 290.0, 298.0, 300)
    durations = sorted(rows_of(metrics.tool_latency_distribution(star)))
    assert durations == [("Grep", 100), ("Grep", 300), ("Write", 20)]


def test_success_rates_scan_the_fact_once(spark, star, tmp_path):
    star.fact_tool_usage.write.parquet(str(tmp_path / "usage"))
    usage = spark.read.parquet(str(tmp_path / "usage"))
    out = metrics.tool_success_rates(type(star)(**{**star.tables(), "fact_tool_usage": usage}))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_results_count_as_decisions_unless_told_apart(spark, make_star):
    usage = [
        (T0, "s", "u", "Edit", "accept", "c", None, None, "tool_decision"),
        (T0, "s", "u", "Edit", "accept", "c", True, 5, "tool_result"),
        (T0, "s", "u", "Edit", "reject", "c", None, None, "tool_decision"),
    ]
    plain = make_star(fact_tool_usage=[u[:-1] for u in usage])
    assert rows_of(metrics.tool_usage_frequency(plain)) == [("Edit", 3, 1, 33.3)]
    with pytest.raises(TelemetryError):
        metrics.tool_usage_frequency(plain, basis="decisions")
    kinds = spark.createDataFrame([u[-1:] for u in usage], "event_kind STRING")
    schema = plain.fact_tool_usage.schema.fields + kinds.schema.fields
    marked = spark.createDataFrame(usage, type(kinds.schema)(schema))
    star = type(plain)(**{**plain.tables(), "fact_tool_usage": marked})
    assert rows_of(metrics.tool_usage_frequency(star, "decisions")) == [("Edit", 2, 1, 50.0)]


def test_tool_without_durations_keeps_its_row(make_star):
    star = make_star(fact_tool_usage=[(T0, "s", "u", None, None, None, True, None)])
    assert rows_of(metrics.tool_success_rates(star)) == [(None, 1, 1, 100.0, None, None)]


def test_errors(make_star):
    star = make_star(
        fact_api_errors=[
            (T0, "s", "u1", "m", "a", 429),
            (T0, "s", "u1", "m", "a", 429),
            (T0, "s", "u1", "m", "b", 429),
            (T0, "s", "u2", "m", "c", None),
        ]
    )
    assert rows_of(metrics.common_api_errors(star)) == [
        (429, "a", 2, 1),
        (429, "b", 1, 1),
        (None, "c", 1, 1),
    ]
    assert rows_of(charts.errors_by_status(star)) == [(429, 3, 2)]
    assert rows_of(charts.errors_by_status(star, keep_null_status=True)) == [(429, 3, 2), (None, 1, 1)]
    by_hour = findings.errors_by_hour(star, by="hour_of_day")
    assert rows_of(by_hour) == [(22, 4, 3, 0, 100.0)]
    untimed = make_star(
        fact_api_errors=[(None, "s", "u", "m", "a", 429), (0, "s", "u", "m", "a", 500)],
        fact_api_requests=[(None, "s", "u", "m", 1.0, 1, 1, 1, 1, 1)],
    )
    by_hour = findings.errors_by_hour(untimed, by="hour_of_day")
    assert rows_of(by_hour) == [(0, 1, 0, 0, 100.0), (None, 1, 1, 1, 50.0)]
    with pytest.raises(TelemetryError):
        findings.errors_by_hour(star, by="minute")


def test_sessions_and_prompts(star):
    assert rows_of(metrics.session_interaction_stats(star)) == [
        ("p1", ANA, 3, 60.0, T0, T0 + 9500),
        ("p2", BO, 1, 100.0, T0, T0),
    ]
    assert rows_of(charts.prompts_per_session_stats(star)) == [(2.0, 2.0)]
    assert rows_of(charts.session_turn_histogram(star)) == [(1, 2, 1), (3, 4, 1)]
    assert charts.prompt_length_avg(star).first()[0] == pytest.approx(70)
    assert sum(r["row_count"] for r in charts.prompt_length_histogram(star).collect()) == 4
    assert rows_of(findings.prompts_per_session_by_practice(star)) == [("Data", 2, 4, 2.0)]
    by_level = {r[0]: r[1:] for r in rows_of(findings.prompt_length_by_level(star))}
    assert by_level.pop("below L7") == (1, 100.0, 100.0, 100.0)
    assert list(by_level.values()) == [(3, 60.0, 60.0, 76.0)]


def test_by_practice(star):
    assert sorted(rows_of(findings.reject_rate_by_practice(star))) == [("Data", 2, 1, 50.0), ("Web", 1, 0, 0.0)]
    assert sorted(rows_of(findings.cache_savings_by_practice(star))) == [("Data", 90, 800, 8.89), ("Web", 10, 0, 0.0)]


def test_box_stats(make_star):
    durations = [10, 20, 30, 40, 1000]
    star = make_star(
        fact_tool_usage=[(T0, "s", "u", "Bash", None, None, True, d) for d in [*durations, 0, None]]
    )
    assert rows_of(charts.latency_box_stats(star)) == [
        ("Bash", 10.0, 20.0, 30.0, 40.0, 1000.0, 10, 40, 1)
    ]


def test_joins_move_one_row_per_user(star):
    """The facts are aggregated by user before anything is joined to them."""
    plan = metrics.cost_by_practice(star)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join") :]
    assert "Aggregate [user_email" in join
