import statistics

import pytest

from tests.conftest import rows_of
from usagelens.operators import anomaly

T0 = 1700000000000


def request(cost, at=T0):
    return (at, "s", "u", "m", cost, 1234, 1, 1, 1, 1)


def call(ms, tool="Bash", at=T0):
    return (at, "s", "u", tool, None, None, True, ms)


COSTS = [1.0, 2.0, 3.0] * 20 + [40.0]


@pytest.fixture
def star(make_star):
    """Quartiles of the calls are 200 and 400 ms, so their limit is 700 ms."""
    return make_star(
        fact_api_requests=[request(c) for c in [*COSTS, None, 0.0]],
        fact_tool_usage=[call(100 * k, "Grep") for k in (1, 2, 3, 4) for _ in range(8)]
        + [call(900, "Grep"), call(None, "Grep"), call(0, "Grep"), call(9, None)],
    )


def test_costs(star):
    rows = anomaly.cost_anomalies(star).collect()
    z = (40.0 - statistics.mean(COSTS)) / statistics.stdev(COSTS)
    assert [(r["cost_usd"], r["z_score"]) for r in rows] == [(40.0, round(z, 2))]
    assert (rows[0]["timestamp"], rows[0]["duration_sec"]) == ("2023-11-14 22:13:20", 1.23)
    assert rows_of(anomaly.cost_anomalies(star, z_threshold=100.0)) == []


def test_cost_statistics_do_not_depend_on_row_order(make_star):
    costs = [0.1 * i + 1e-7 for i in range(400)] + [1e9, 3e-9]
    found = set()
    for order in (costs, costs[::-1], sorted(costs, key=str)):
        df = make_star(fact_api_requests=[request(c) for c in order])
        found.add(str(sorted(rows_of(anomaly._flagged_costs(df, 0.0).select("cost_usd", "__z")))))
    assert len(found) == 1


def test_no_spread_no_anomalies(make_star):
    for costs in ([], [1.0], [1.0, 1.0]):
        star = make_star(fact_api_requests=[request(c) for c in costs])
        assert rows_of(anomaly.cost_anomalies(star, 0.0)) == []


def test_latency(star):
    rows = anomaly.latency_anomalies(star).collect()
    assert [(r["tool_name"], r["duration_ms"], r["threshold_sec"]) for r in rows] == [("Grep", 900, 0.7)]


def test_all_outliers_and_ties(make_star):
    calls = [call(50)] * 1000 + [call(5000, at=T0 + i) for i in range(120)]
    star = make_star(fact_tool_usage=calls)
    assert anomaly.latency_anomalies(star).count() == 120
    top = [r["epoch_ms"] for r in anomaly.latency_anomalies(star, limit=100).collect()]
    assert top == [T0 + i for i in range(100)]
    assert anomaly.top_latency_anomalies(star).count() == 15
    assert anomaly.anomaly_summary(star).first()["latency_anomaly_count"] == 120


def test_same_result_when_limits_are_too_many_to_broadcast(make_star, monkeypatch):
    star = make_star(
        fact_tool_usage=[call(50, f"t{i}") for i in range(20) for _ in range(9)]
        + [call(5000, f"t{i}") for i in range(20)]
    )
    small = rows_of(anomaly.latency_anomalies(star))
    hinted = anomaly.hint_if_small
    monkeypatch.setattr(anomaly, "hint_if_small", lambda df: hinted(df, max_rows=3))
    assert rows_of(anomaly.latency_anomalies(star)) == small
    assert len(small) == 20


def test_summary(star, make_star):
    assert rows_of(anomaly.anomaly_summary(star)) == [(1, 40.0, 1, 0.9)]
    assert rows_of(anomaly.anomaly_summary(make_star())) == [(0, 0.0, 0, 0.0)]
