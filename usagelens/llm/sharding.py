"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; the fractional rank (rank + 1/2) / rows of the
source lies evenly between 0 and 1 whatever the source's size. Sorted by it, every stretch of rows holds
the sources in their proportion, so cutting the sequence into shards of as many rows (the law `rows`)
gives each shard the mixture.

Ranks are running totals over buckets of the hash, places are running totals over equal stretches of
the fractional rank: no task sorts a source or the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import buckets_for, running_total, stored, with_columns

SHARDS = 40
SEED = 11


def measured(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return with_columns(docs, "doc_id", "source", "text").select(
        "doc_id",
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(F.lit(SEED), "doc_id", "text").alias("mixed"),
    )


def interleave(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard: one row for each row of `docs`.

    Null sources are a source of their own, a null text has no bytes and the checksum of the empty
    text. Rows may repeat and ids may be null or tied; equal rows are interchangeable, so reruns give
    the same result. With fewer rows than shards the last shards stay empty; an empty table gives an empty
    result. grown_shard is always null: only the law `key` promises anything about one more shard.
    """
    rows = stored(measured(docs), "sharding")
    n_rows = rows.count()
    n_buckets = buckets_for(n_rows)
    order = ["mixed", "doc_id", "size", "text_crc32"]
    bucket = F.pmod(F.shiftright("mixed", 20), F.lit(n_buckets))
    ranked = running_total(rows, ["key"], bucket, order, F.lit(1), "rank")
    of_source = rows.groupBy("key").agg(F.count("*").alias("n_source"))
    ranked = ranked.join(of_source, "key").withColumn(
        "fraction", (F.col("rank") + F.lit(0.5)) / F.col("n_source")
    )
    stretch = F.floor(F.col("fraction") * n_buckets)
    placed = running_total(ranked, [], stretch, ["fraction", "key", *order], F.lit(1), "place")
    shard = F.expr(f"place * {shards}L div {max(n_rows, 1)}L")
    first = F.expr(f"(shard * {max(n_rows, 1)}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        F.when(~F.col("key.none"), F.col("key.name")).alias("source"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents, a folder for each shard, rows in the order of their slots.

    `docs` needs unique ids, as texts are joined to places by them.
    """
    texts = with_columns(docs, "doc_id", "text")
    rows = placed.drop("text_crc32", "law", "grown_shard").join(texts, "doc_id")
    (
        rows.repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
