"""Cost outliers as events arrive, against the moments kept with the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelens.operators import anomaly, facts, parse
from usagelens.schemas import CONTRACT, TYPED_EVENT
from usagelens.sources.commits import Log, read_log
from usagelens.sources.sidetables import COST_MOMENTS, brought_up, read_folders, read_side
from usagelens.sources.star import DAILY, append_part, started
from usagelens.streaming.ingest import part_name


def as_of(log: Log, part: str) -> Log:
    """The log as it was when `part` was committed; later writers do not change what a retried batch sees."""
    last = max(i for i, e in enumerate(log.entries) if e.part == part and e.version == log.version)
    return Log(log.seq, log.entries[: last + 1])


def part_outliers(spark: SparkSession, root: str, part: str, z_threshold: float = 3.0) -> DataFrame:
    """The requests of one committed part that are outliers by the moments of all parts up to it.

    Reads that part and the stored moments, some ten rows a part; no other part.
    """
    log = as_of(read_log(spark, root), part)
    own = [e for e in log.of(log.version, "events") if e.part == part]
    events = read_folders(spark, root, own, TYPED_EVENT).filter("table = 'fact_api_requests'")
    requests = events.select(*CONTRACT["fact_api_requests"].fieldNames())
    known = read_side(spark, root, log, COST_MOMENTS)
    return anomaly.described_costs(anomaly.flagged_costs(requests, known, z_threshold))


def stream_cost_anomalies(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    out: str,
    z_threshold: float = 3.0,
    partition_by: tuple[str, ...] = DAILY,
    **trigger,
) -> StreamingQuery:
    """Append events to the star at `root` and write each micro-batch's outliers to `out`/batch=<part>.

    A batch is judged by the moments of everything loaded before it and of itself: the rows that `cost_anomalies`
    finds in it with the same moments. What is loaded already without moments is brought up once, at the start. A
    batch that is retried gives the same rows under the same name.
    """
    spark = lines.sparkSession
    brought_up(spark, root, COST_MOMENTS, log=started(spark, root, partition_by))

    def apply(batch: DataFrame, batch_id: int) -> None:
        part = part_name(checkpoint, batch_id)
        events = facts.typed_events(parse.parse_lines(batch))
        append_part(events, root, part, partition_by, (COST_MOMENTS,))
        part_outliers(spark, root, part, z_threshold).write.mode("overwrite").parquet(f"{out}/batch={part}")

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_outliers(spark: SparkSession, out: str) -> DataFrame:
    """All outliers a stream has written, with the batch they came in."""
    return spark.read.parquet(out).withColumn("batch", F.col("batch").cast("string"))
