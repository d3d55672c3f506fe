"""Ad-hoc access: tables, schemas, free SQL, and one practice's view of the data."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.operators import quality
from usagelens.schemas import FACT_TABLES, QueryError, Star


def list_tables(star: Star) -> DataFrame:
    return quality.row_counts(star)


def show_schema(star: Star, table: str, with_counts: bool = False) -> DataFrame:
    """Columns and types in order; `with_counts` adds how many rows have a value."""
    df = star.contract(table)
    spark = df.sparkSession
    columns = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes, 1)]
    described = spark.createDataFrame(columns, "position INT, column_name STRING, data_type STRING")
    if with_counts:
        filled = df.agg(*[F.count(name).alias(name) for name in df.columns])
        named = F.create_map(*[x for name in df.columns for x in (F.lit(name), F.col(name))])
        filled = filled.select(F.explode(named).alias("column_name", "filled_rows"))
        described = described.join(filled, "column_name")
        return described.select("position", "column_name", "data_type", "filled_rows").orderBy(
            "position"
        )
    return described.orderBy("position")


def run_sql(star: Star, sql: str, max_rows: int | None = None) -> DataFrame:
    """Any query over the star's tables; all its rows, unless `max_rows` says otherwise.

    The text is taken as a table expression, so a statement that writes or changes something is no
    valid SQL there.
    """
    star.register_views()
    inner = sql.strip().removesuffix(";")
    try:
        out = star.dim_employees.sparkSession.sql(f"SELECT * FROM (\n{inner}\n)")
    except PySparkException as e:
        raise QueryError(str(e)) from e
    return out if max_rows is None else out.limit(max_rows)


def fetch_sql(star: Star, sql: str, max_rows: int) -> list[Row]:
    """The first `max_rows` rows of a query; what fails while it runs is a QueryError too."""
    try:
        return run_sql(star, sql, max_rows).collect()
    except PySparkException as e:
        raise QueryError(str(e)) from e


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row: dates as ISO text, binary as hex, NULLs kept."""
    columns = [
        F.lower(F.hex(name)).alias(name) if dtype == "binary" else F.col(f"`{name}`")
        for name, dtype in df.dtypes
    ]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def practice_view(star: Star, practice: str) -> Star:
    """The star restricted to one practice's employees.

    The members are counted first, which decides whether they may be broadcast to the facts.
    """
    members = star.dim_employees.filter(F.col("practice") == practice)
    emails = members.select(F.col("email").alias("__member"))
    emails = hint_if_small(emails)
    is_member = F.col("user_email") == F.col("__member")
    facts = {name: star.table(name).join(emails, is_member, "left_semi") for name in FACT_TABLES}
    return Star(dim_employees=members, **facts)
