"""The ids of a star's events, beside its parts: which part holds an id, and at which time.

    <root>/versions/<v>/ids/<folder>-<buckets>/part=<p>/bucket=<b>/

A part's ids lie in buckets by hash, sorted, with a Bloom filter on the id. A lookup reads the buckets its ids fall
into; few ids are also pushed into the scan, where the filters and the order leave out most row groups. No event is
read, and an id is found whatever day it was loaded under.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small
from usagelens.schemas import TYPED_EVENT, struct
from usagelens.sources.commits import Entry, Log, commit
from usagelens.sources.sidetables import WITH_PART, read_folders

IDS = struct(event_id="string", epoch_ms="bigint", is_good="boolean", bucket="int")
TABLE = "ids"
#: Rows of one part that share a bucket, about, and the most buckets of a part.
BUCKET_ROWS, MAX_BUCKETS = 1 << 20, 1024
#: Up to so many wanted ids are pushed into the scan.
PUSHED_IDS = 500


def is_bad() -> Column:
    return F.col("stage").isNotNull()


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(n_buckets)).cast("int")


def write_ids(events: DataFrame, root: str, version: str, part: str, within: str = WITH_PART) -> Entry:
    """Index the events of one part, as written; the index counts once the entry is committed."""
    rows, n = events.count(), 1
    while n < MAX_BUCKETS and n * BUCKET_ROWS < rows:
        n *= 2
    folder = f"{TABLE}/{within}-{n}/part={part}"
    ids = events.filter("event_id IS NOT NULL").select("event_id", "epoch_ms", (~is_bad()).alias("is_good")).distinct()
    placed = ids.withColumn("bucket", bucket_of(n)).repartition(n, "bucket").sortWithinPartitions("bucket", "event_id")
    (
        placed.write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#event_id", "true")
        .option("parquet.bloom.filter.expected.ndv#event_id", str(max(1024, min(BUCKET_ROWS, rows))))
        .partitionBy("bucket")
        .parquet(f"{root}/versions/{version}/{folder}")
    )
    return Entry(version, TABLE, part, folder)


def brought_up(spark: SparkSession, root: str, log: Log) -> Log:
    """Index the parts that are not yet, such as those of plain loads and streams; returns the log that has them."""
    have = set(log.parts(log.version, TABLE))
    missing = [e for e in log.of(log.version, "events") if e.part not in have]
    within = uuid.uuid4().hex
    made = [write_ids(read_folders(spark, root, [e], TYPED_EVENT), root, e.version, e.part, within) for e in missing]
    return commit(spark, root, log, made) if made else log


def _buckets(entry: Entry) -> int:
    return int(entry.folder.split("/")[1].rpartition("-")[2])


def looked_up(spark: SparkSession, root: str, log: Log, wanted: DataFrame) -> DataFrame:
    """(event_id, part, epoch_ms, is_good) of the indexed events with an id of `wanted` (event_id).

    `wanted` is counted and its bucket numbers are collected, so it should be a table or a small result, with each
    id once.
    """
    ids = wanted.select("event_id").filter("event_id IS NOT NULL")
    few = [r.event_id for r in ids.limit(PUSHED_IDS + 1).collect()]
    out = spark.createDataFrame([], "event_id string, part string, epoch_ms long, is_good boolean")
    by_count: dict[int, list[Entry]] = {}
    for e in log.of(log.version, TABLE):
        by_count.setdefault(_buckets(e), []).append(e)
    for n, entries in sorted(by_count.items()):
        rows = read_folders(spark, root, entries, IDS)
        if n > 1:
            hit = [r.b for r in ids.select(bucket_of(n).alias("b")).distinct().collect()]  # n numbers at most
            rows = rows.filter(F.col("bucket").isin(hit))
        if len(few) <= PUSHED_IDS:
            rows = rows.filter(F.col("event_id").isin(few))
        out = out.unionByName(rows.select("event_id", "part", "epoch_ms", "is_good"))
    return out if len(few) <= PUSHED_IDS else out.join(hint_if_small(ids), "event_id", "left_semi")
