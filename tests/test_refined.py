"""Quantiles of values that crowd, by repeated refinement."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usagelens.functions import refined
from usagelens.functions.quantiles import value_counts
from usagelens.functions.refined import quantiles_by_steps
from usagelens.operators import metrics

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, rows, kind="DOUBLE", most=3, keys=("k",)):
    df = spark.createDataFrame(rows, f"k STRING, v {kind}")
    found = quantiles_by_steps(value_counts(df, list(keys), "v"), list(keys), "v", PROBS, most).collect()
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k if keys else None, []).append(v)
    got = {r["k"] if keys else None: [r[name] for name in PROBS] for r in found}
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k] == pytest.approx(list(np.quantile(values, list(PROBS.values()))), rel=1e-12, abs=1e-12)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", None]), st.one_of(st.none(), st.floats(-1e9, 1e9), st.sampled_from([0.0, 1.0]))), max_size=40))
def test_match_numpy(spark, rows):
    check(spark, rows)


def test_a_crowd_beside_far_values(spark):
    rng = np.random.default_rng(1)
    crowd = 1.0 + rng.random(2000) * 1e-9
    rows = [("a", float(v)) for v in [*crowd, -1e12, 5e11, 1.003]] + [("b", 7.0)] * 500 + [("c", None)]
    check(spark, rows, most=40)


def test_nanoseconds_in_one_bucket_never_meet_in_one_sort(spark, monkeypatch):
    """300,000 distinct values within 0.03 % of their size; the sorted rest is a few hundred."""
    base, n = 10**15, 300_000
    df = spark.range(n).select(F.lit("t").alias("tool_name"), (F.lit(base) + F.col("id") * 1_000_003 % n * 1_000_003).alias("duration_ms"))
    sorted_rows = []
    inside = refined._inside

    def seen(*args):
        out = inside(*args)
        sorted_rows.append(out.count())
        return out

    monkeypatch.setattr(refined, "_inside", seen)
    counts = value_counts(df, ["tool_name"], "duration_ms")
    row = quantiles_by_steps(counts, ["tool_name"], "duration_ms", {"p50": 0.5, "p99": 0.99}, 1000).first()
    values = base + np.arange(n) * 1_000_003
    assert (row.p50, row.p99) == pytest.approx(tuple(np.quantile(values, [0.5, 0.99])), rel=1e-15)
    assert sorted_rows[0] == n and sorted_rows[-1] <= 2000


def test_report_by_steps_is_the_report(spark, make_star, monkeypatch):
    monkeypatch.setattr(refined, "MOST_DISTINCT", 2)
    rows = [(i, "s", "u", [None, "A", "B"][i % 3], None, None, True, i * i % 97) for i in range(150)]
    star = make_star(fact_tool_usage=rows)
    assert metrics.high_latency_tools(star, by_steps=True).collect() == metrics.high_latency_tools(star).collect()
