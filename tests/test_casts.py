import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usagelens.functions import casts

TEXTS = [
    *["5", "+5", " 5 ", "-5.5", "5.7", "5.", ".5", "0.5", "2.5", "-2.5", "1e3", "1E3", "1e+2"],
    *["1e-1", "1e-400", "00012", "\t5\n", "0.0123", "9223372036854775807", "9223372036854775808"],
    *["9223372036854775807.4", "3000000000", "1e30", "-1e30", "", " ", "abc", "not_a_number"],
    *["5d", "5f", "--5", "5e", "1e3.5", "1,5", "undefined", "1 2", "true", None],
]


def test_numbers_convert_as_in_the_checking_engine(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i INT, t STRING")
    got = df.selectExpr(
        "i",
        f"{casts.to_double('t')} AS d",
        f"{casts.to_long('t')} AS b",
        f"{casts.to_int('t')} AS n",
    ).orderBy("i")
    sql = "SELECT TRY_CAST($1 AS DOUBLE), TRY_CAST($1 AS BIGINT), TRY_CAST($1 AS INTEGER)"
    for row, text in zip(got.collect(), TEXTS, strict=True):
        assert (row["d"], row["b"], row["n"]) == duckdb.execute(sql, [text]).fetchone(), repr(text)


@pytest.mark.parametrize("text", ["nan", "NaN", "inf", "-Infinity", "1e400"])
def test_numbers_that_are_not_finite_are_rejected(spark, text):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.selectExpr(casts.to_double("t")).first()[0] is None


def test_bool_and_blank(spark):
    df = spark.createDataFrame([("true",), ("false",), ("True",), ("",), (None,)], "t STRING")
    got = df.selectExpr(casts.to_bool("t"), casts.blank_to_null("t")).collect()
    assert [r[0] for r in got] == [True, False, None, None, None]
    assert [r[1] for r in got] == ["true", "false", "True", None, None]


def test_rounding_follows_the_binary_value(spark):
    values = [1.005, 2.675, 0.125, -0.125, 12.345, 1234.565, 0.5, 1.5, 2.5]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = [r[0] for r in df.select(casts.round_to(F.col("v"), 2)).collect()]
    want = [duckdb.execute("SELECT round(CAST(? AS DOUBLE), 2)", [v]).fetchone()[0] for v in values]
    assert got == want


def test_totals_are_exact_and_lose_nothing(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e20,)], "v DOUBLE")
    assert df.filter("v < 1").agg(casts.exact_total(F.col("v"))).first()[0] == 1.0
    assert df.agg(casts.exact_total(F.col("v"))).first()[0] == 1e20 + 1.0
    assert df.filter("v < 0").agg(casts.exact_total(F.col("v"))).first()[0] is None


def test_times_outside_the_calendar_become_null(spark):
    df = spark.createDataFrame([(1700000000999,), (9 * 10**18,), (None,)], "ms BIGINT")
    got = [r[0] for r in df.select(casts.utc_text(F.col("ms"))).collect()]
    assert got == ["2023-11-14 22:13:20", None, None]


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_rounding_agrees_with_the_checked_engine(spark, data):
    digits = st.text("0123456789", min_size=1, max_size=30)
    whole = st.integers(-(10**15), 10**15)
    texts = data.draw(st.lists(st.builds(lambda w, d: f"{w}.{d}", whole, digits), min_size=300, max_size=300))
    exponents = st.builds(lambda t, e: f"{t}e{e}", st.sampled_from(texts), st.integers(-18, 3))
    texts += data.draw(st.lists(exponents, min_size=300, max_size=300))
    texts += ["4.99999999999999999999e-1", "1.4499999999999999999999999e1", "149e-2", "1499999e-6", "0.00005e4", "0.00015e4", ".5e1", "1.e1", ".e1", "e1", "1e", "-4.9e-1", "1e-400", "1e2.5"]
    texts += ["0.49999999999", "1234.49999999999", "-0.5", "0.5", "2.49999999999999999999999999999", "1e3", "1.5e0", "25e-1"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    ours = [r[0] for r in df.selectExpr(f"{casts.to_long('t')} AS n").collect()]
    theirs = [duckdb.execute("SELECT TRY_CAST(? AS BIGINT)", [t]).fetchone()[0] for t in texts]
    assert ours == theirs
