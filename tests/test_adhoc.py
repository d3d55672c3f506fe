import json

import pytest

from tests.conftest import rows_of
from usagelens.functions import joins
from usagelens.operators import adhoc, metrics
from usagelens.schemas import CONTRACT, QueryError, UnknownTableError


@pytest.fixture
def star(make_star):
    return make_star(
        dim_employees=[("a", "A", "P", "L1", "x"), ("b", "B", "Q", "L2", "x")],
        fact_user_prompts=[(i, f"s{i}", "a" if i % 3 else "b", i) for i in range(150)],
        fact_api_requests=[(0, "s", "a", "m", 1.0, 1, 1, 1, 1, None)],
    )


def test_tables(star):
    tables = rows_of(adhoc.list_tables(star))
    assert [t for t, _ in tables] == sorted(CONTRACT)
    assert dict(tables)["fact_user_prompts"] == 150


def test_schema(star):
    assert rows_of(adhoc.show_schema(star, "fact_user_prompts")) == [
        (1, "epoch_ms", "bigint"),
        (2, "session_id", "string"),
        (3, "user_email", "string"),
        (4, "prompt_length", "bigint"),
    ]
    filled = rows_of(adhoc.show_schema(star, "fact_api_requests", with_counts=True))
    assert filled[-2:] == [
        (9, "cache_read_tokens", "bigint", 1),
        (10, "cache_creation_tokens", "bigint", 0),
    ]
    with pytest.raises(UnknownTableError):
        adhoc.show_schema(star, "nope")


def test_sql(star):
    assert adhoc.run_sql(star, "SELECT * FROM fact_user_prompts").count() == 150
    assert adhoc.run_sql(star, "SELECT * FROM fact_user_prompts;", max_rows=100).count() == 100
    with_names = "WITH a AS (SELECT 1 AS x) SELECT x + 1 FROM a -- done"
    assert rows_of(adhoc.run_sql(star, with_names)) == [(2,)]
    assert rows_of(adhoc.run_sql(star, "SELECT count(*) FROM dim_employees")) == [(2,)]
    for bad in ("SELEC 1", "SELECT nope FROM dim_employees", "SELECT * FROM nowhere"):
        with pytest.raises(QueryError):
            adhoc.run_sql(star, bad)


def test_sql_only_reads(star, tmp_path):
    out = tmp_path / "out"
    for text in (
        f"INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT 1 AS a",
        f"FROM fact_user_prompts INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT *",
        f"CREATE TABLE t USING parquet LOCATION '{out}' AS SELECT 1 AS a",
        "DROP VIEW fact_user_prompts",
        "SET spark.sql.shuffle.partitions = 1",
    ):
        with pytest.raises(QueryError):
            adhoc.run_sql(star, text)
    assert not out.exists()


def test_errors_while_running(star):
    failing = "SELECT 1 DIV (prompt_length - prompt_length) FROM fact_user_prompts"
    with pytest.raises(QueryError):
        adhoc.fetch_sql(star, failing, 10)
    assert len(adhoc.fetch_sql(star, "SELECT * FROM fact_user_prompts", 10)) == 10


def test_json_rows(spark):
    df = spark.sql("SELECT DATE'2024-01-02' AS d, X'0AFF' AS b, CAST(NULL AS INT) AS n, 'é' AS `s.t`")
    assert json.loads(adhoc.to_json_rows(df).first()["json"]) == {
        **{"d": "2024-01-02", "b": "0aff", "n": None, "s.t": "é"}
    }


def test_practice_view(star):
    seen = adhoc.practice_view(star, "Q")
    assert seen.dim_employees.count() == 1
    assert seen.fact_user_prompts.count() == 50
    assert seen.fact_api_requests.count() == 0
    assert rows_of(metrics.total_cost(seen)) == [(0.0,)]


def test_practice_view_without_broadcast(star, monkeypatch):
    monkeypatch.setattr(adhoc, "hint_if_small", lambda df: joins.hint_if_small(df, max_rows=0))
    assert adhoc.practice_view(star, "P").fact_user_prompts.count() == 100
