"""The load: raw log batches and the employee file in, a star on disk out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import facts, parse, quality
from usagelens.schemas import FACT_TABLES, QUARANTINE_TABLE, UNKNOWN_TABLE, Star
from usagelens.session import configure, scratch_path
from usagelens.sources import employees, logs, star
from usagelens.sources.commits import remove_path


def load_star(
    spark: SparkSession,
    logs_path: str,
    employees_path: str,
    root: str,
    partition_by: tuple[str, ...] = star.DAILY,
) -> str:
    """Full, repeatable rebuild; returns the version written. The log text is read once.

    Malformed log rows and malformed employee records go to the same quarantine, with stage and reason.
    """
    configure(spark)
    staged = scratch_path(spark, "employee-records")
    employees.read_records(spark, employees_path).write.parquet(staged)  # parsed once, read for both of its kinds
    try:
        records = spark.read.parquet(staged)
        dim = quality.require_unique_dim(employees.good(records))
        parsed = parse.parse_lines(logs.read_log_batches(spark, logs_path))
        rejected = facts.quarantined(employees.rejected(records))
        return star.write_star(dim, facts.typed_events(parsed).unionByName(rejected), root, partition_by)
    finally:
        remove_path(spark, staged)


def load_report(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Where every input row went, from the written tables: (table_name, detail, row_count)."""
    version = version or star.current_version(spark, root)
    events = star.read_events(spark, root, version)
    detail = F.when(F.col("table") == QUARANTINE_TABLE, F.col("stage")).when(
        F.col("table") == UNKNOWN_TABLE, F.col("body")
    )
    return (
        events.groupBy(F.col("table").alias("table_name"), detail.alias("detail"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("table_name", F.asc_nulls_last("detail"))
    )


def log_counts(spark: SparkSession, root: str, log=print) -> None:
    """Print the counts a load is checked by, as they were taken while it was written."""
    for row in star.load_counts(spark, root).collect():
        log(f"[INGEST] {row.table_name}: {row.detail} {row.row_count}")


def log_validation(loaded: Star, log=print) -> None:
    """Print the counts a load is checked by. Each is one aggregate; only single rows are fetched."""
    checks = {
        "fact_api_requests": quality.reject_counts,
        "fact_tool_usage": quality.tool_usage_counts,
        "fact_api_errors": quality.null_status_count,
        "fact_user_prompts": quality.null_prompt_count,
    }
    for table, check in checks.items():
        log(f"[INGEST] {table}: {check(loaded).first().asDict()}")
    orphans = {r["table_name"]: r["orphan_count"] for r in quality.orphan_counts(loaded).collect()}
    for table in FACT_TABLES:
        log(f"[VALIDATE] {table}: {orphans.get(table, 0)} emails without an employee")
