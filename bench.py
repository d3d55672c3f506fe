"""Times the load and the reports on the sample tables; prints one JSON line.

The raw log files are prepared first, untimed. `load` reads them and writes the star; every other
entry reads that star from disk. Each figure is the best of RUNS runs, so that it shows the work and
not the first compilation of the plan. `more` holds single runs: the first load, the load by day, a
practice's view, the stream, an upsert of events that are all there, the roll-ups and moments of the loaded part,
and reports from these. `calibration` is a fixed job of plain arithmetic: figures of two machines, or of two rounds,
compare after division by it.

    BENCH_SF_DIR   sample tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)
    BENCH_COPIES   events that many times over with new ids (default 1); a third of the copies belong to one user, one
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.operators import adhoc, anomaly, charts, facts, findings, metrics, parse, quality, rolled
from usagelens.plans import ingest, sample_data
from usagelens.session import configure, scratch_path
from usagelens.sources import sidetables, star
from usagelens.streaming import ingest as stream
from usagelens.streaming import upsert

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
RUNS = 3

QUERIES = [
    metrics.kpis,
    metrics.cost_by_practice,
    metrics.cost_by_level,
    metrics.token_efficiency_by_practice,
    metrics.model_usage_breakdown,
    metrics.tool_usage_frequency,
    metrics.tool_success_rates,
    metrics.tool_latency_distribution,
    metrics.common_api_errors,
    metrics.error_rate_by_model,
    metrics.session_interaction_stats,
    metrics.prompt_length_distribution,
    metrics.high_latency_tools,
    metrics.api_request_latency_by_model,
    charts.errors_by_status,
    charts.prompts_per_session_stats,
    charts.session_turn_histogram,
    charts.prompt_length_histogram,
    charts.latency_box_stats,
    charts.request_share_by_model,
    anomaly.cost_anomalies,
    anomaly.latency_anomalies,
    anomaly.anomaly_summary,
    findings.cost_by_model_family,
    findings.errors_by_hour,
    findings.prompt_length_by_level,
    findings.prompts_per_session_by_practice,
    findings.reject_rate_by_practice,
    findings.cache_savings_by_practice,
    quality.orphan_emails,
    adhoc.list_tables,
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def calibration(spark: SparkSession) -> float:
    """Seconds for a job that no change of the library touches."""
    job = lambda: drain(spark.range(40_000_000).selectExpr("xxhash64(id) AS h").groupBy((F.col("h") % 1000).alias("k")).count())
    return min(timed(job) for _ in range(RUNS))


def copied(spark: SparkSession, folder: str) -> str:
    """The sample tables with the events COPIES times over; of each three copies one is hot."""
    out = scratch_path(spark, "copies")
    events = spark.read.parquet(f"{folder}/events.parquet")
    top = events.agg(F.max("event_id")).first()[0] + 1
    copies = events.crossJoin(F.broadcast(spark.range(COPIES).withColumnRenamed("id", "copy")))  # COPIES rows
    hot = F.col("copy") % 3 == 1
    given = {"user_id": F.lit(1), "event_type": F.lit("purchase"), "value": F.lit(12.5)}
    for name, value in given.items():
        copies = copies.withColumn(name, F.when(hot, value.cast(events.schema[name].dataType)).otherwise(F.col(name)))
    copies = copies.withColumn("event_id", F.col("event_id") + F.col("copy") * top).drop("copy")
    copies.write.parquet(f"{out}/events.parquet")
    for name in ("customer", "nation"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("usagelens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        # skips recording the Python call site of every expression while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = copied(spark, SF_DIR) if COPIES > 1 else SF_DIR
    raw = sample_data.raw_files(spark, folder)
    people = sample_data.employee_files(spark, folder)
    events = sample_data.events(spark, folder).count()

    roots: list[str] = []

    def load(layout: tuple[str, ...] = star.BY_TABLE) -> None:
        roots.append(scratch_path(spark, "bench-star"))
        ingest.load_star(spark, raw, people, roots[-1], layout)

    # once each, beside the headline
    more = {"calibration": calibration(spark)}
    more |= {"load_cold": timed(load), "load_daily": timed(lambda: load(star.DAILY))}
    seconds = {"load": min(timed(load) for _ in range(RUNS))}
    loaded = star.read_star(spark, roots[-1])
    for query in QUERIES:
        runs = [timed(lambda: drain(query(loaded))) for _ in range(RUNS)]  # noqa: B023
        seconds[query.__name__] = min(runs)
        print(f"{query.__name__:34s} {seconds[query.__name__]:.2f} s", file=sys.stderr)

    more["practice_view"] = timed(lambda: drain(metrics.cost_by_level(adhoc.practice_view(loaded, "BUILDING"))))
    root = scratch_path(spark, "bench-stream")
    lines = stream.stream_lines(spark, raw)
    more["stream_ingest"] = timed(
        lambda: stream.stream_ingest(lines, root, f"{root}/checkpoint", star.BY_TABLE).awaitTermination()
    )
    again = facts.typed_events(parse.parse_lines(spark.read.text(raw))).filter("event_id IS NOT NULL")
    more["upsert_of_known_events"] = timed(lambda: upsert.incremental_upsert(again, root, star.BY_TABLE))

    built = lambda: sidetables.brought_up(spark, roots[-1], sidetables.COST_MOMENTS, *sidetables.ROLLUPS)
    more["rollups_and_moments"] = timed(built)
    known = sidetables.read_side(spark, roots[-1], built(), sidetables.COST_MOMENTS)
    for name in ("kpis", "cost_by_practice", "model_usage_breakdown"):
        report = getattr(rolled, name)
        more[f"{name}_rolled"] = min(timed(lambda: drain(report(rolled.rolled(spark, roots[-1])))) for _ in range(RUNS))  # noqa: B023
    more["cost_anomalies_stored"] = min(timed(lambda: drain(anomaly.cost_anomalies(loaded, known=known))) for _ in range(RUNS))

    print(
        json.dumps(
            {
                "metric": "load_and_report_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "more": {name: round(s, 3) for name, s in more.items()},
                "sf": float(os.path.basename(SF_DIR).removeprefix("sf")),
                "copies": COPIES,
                "load_events_per_sec": round(events / seconds["load"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
