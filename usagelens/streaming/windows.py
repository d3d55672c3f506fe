"""KPIs per tumbling window, over batch or streaming typed events.

A stream emits a window once the watermark has passed it. The windows still open lie in the stream's state, already
aggregated; `open_windows` reads them there, so the last windows of an input that ends, or the current state of one
that goes on, can be delivered at any time without touching the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions.casts import exact_total, join_parts, to_instant, to_timestamp
from usagelens.streaming.ingest import stream_events

#: The aggregates of `windowed_kpis` as its state holds them, by position: a decimal sum has a mark for "no value".
STATE = "struct<dec: decimal(38,12), no_dec: boolean, big: double, tokens: bigint, requests: bigint, errors: bigint>"


def windowed_kpis(events: DataFrame, width: str = "1 hour", lateness: str | None = None) -> DataFrame:
    """Cost, tokens, requests and errors per window.

    With `lateness` the state of a stream is bounded: a window is emitted once no event within that
    delay can still reach it. All aggregates combine on the map side, so a hot hour costs one row
    per task. Events without a time belong to no window.
    """
    timed = events.withColumn("event_ts", to_instant(F.col("epoch_ms"))).filter(
        F.col("event_ts").isNotNull() & F.col("table").isin("fact_api_requests", "fact_api_errors")
    )
    if lateness is not None:
        timed = timed.withWatermark("event_ts", lateness)
    is_request = F.col("table") == "fact_api_requests"
    kpis = timed.groupBy(F.window("event_ts", width)).agg(
        exact_total(F.col("cost_usd")).alias("total_cost"),
        F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
        F.count_if(is_request).alias("request_count"),
        F.count_if(~is_request).alias("error_count"),
    )
    return _described(kpis)


def _described(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        to_timestamp(F.unix_millis("window.start")).alias("window_start"),
        to_timestamp(F.unix_millis("window.end")).alias("window_end"),
        "total_cost",
        "total_tokens",
        "request_count",
        "error_count",
    )


def stream_windowed_kpis(
    lines: DataFrame, out: str, checkpoint: str, width: str = "1 hour", lateness: str = "10 minutes", **trigger
) -> StreamingQuery:
    """Write each window to the files at `out` when the watermark has passed it, exactly once."""
    kpis = windowed_kpis(stream_events(lines), width, lateness)
    run = kpis.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return run.trigger(**(trigger or {"availableNow": True})).start()


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a `stream_windowed_kpis` has not emitted yet, as of its last finished micro-batch."""
    state = spark.read.format("statestore").load(checkpoint)
    kpis = state.select("key.window", F.col("value").cast(STATE).alias("value")).select(
        "window",
        join_parts(F.when(~F.col("value.no_dec"), F.col("value.dec")), F.col("value.big")).alias("total_cost"),
        F.col("value.tokens").alias("total_tokens"),
        F.col("value.requests").alias("request_count"),
        F.col("value.errors").alias("error_count"),
    )
    return _described(kpis)


def read_windows(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """All windows so far: the emitted ones (`is_final`) and the open ones, each once.

    While the stream runs, a window it emits meanwhile counts as emitted.
    """
    still_open = open_windows(spark, checkpoint)
    emitted = spark.read.schema(still_open.schema).parquet(out)
    rest = still_open.join(emitted.select("window_start"), "window_start", "left_anti")
    return emitted.withColumn("is_final", F.lit(True)).unionByName(rest.withColumn("is_final", F.lit(False)))
