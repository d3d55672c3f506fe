import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from usagelens.functions.quantiles import histogram, quantiles, value_counts

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def check(spark, rows):
    df = spark.createDataFrame(rows, "k STRING, v BIGINT")
    got = quantiles(value_counts(df, ["k"], "v"), ["k"], "v", PROBS).collect()
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert {r["k"] for r in got} == set(groups)
    for r in got:
        want = np.quantile(groups[r["k"]], list(PROBS.values()))
        assert [r[name] for name in PROBS] == pytest.approx(list(want), rel=1e-12, abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(-(10**12), 10**12), st.integers(0, 5)),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_match_numpy(spark, rows):
    check(spark, rows)


def test_hot_value_and_long_tail(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", 7)] * 3000 + [("hot", int(v)) for v in rng.lognormal(8, 2, 3000)]
    check(spark, rows + [("one", 5)] + [("two", 1), ("two", 2)])


def test_without_groups_and_empty(spark):
    df = spark.createDataFrame([(1,), (2,), (10,)], "v BIGINT")
    got = quantiles(value_counts(df, [], "v"), [], "v", {"m": 0.5}).collect()
    assert [tuple(r) for r in got] == [(2.0,)]
    none = df.filter("v > 100")
    assert quantiles(value_counts(none, [], "v"), [], "v", {"m": 0.5}).collect() == []


def test_doubles(spark):
    values = [0.001 * i for i in range(101)]
    df = spark.createDataFrame([("a", v) for v in values], "k STRING, v DOUBLE")
    got = quantiles(value_counts(df, ["k"], "v"), ["k"], "v", {"m": 0.95}).first()["m"]
    assert got == pytest.approx(np.quantile(values, 0.95))


@pytest.mark.parametrize("bins", [1, 3, 30])
def test_histogram_counts_every_row_once(spark, bins):
    values = [1, 1, 2, 5, 9, 40, 41]
    df = spark.createDataFrame([(v,) for v in values], "v BIGINT")
    got = histogram(value_counts(df, [], "v"), "v", bins).collect()
    assert len(got) <= bins
    for r in got:
        assert r["row_count"] == sum(r["bin_start"] <= v < r["bin_end"] for v in values)
    assert sum(r["row_count"] for r in got) == len(values)
