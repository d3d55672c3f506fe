"""From raw documents to shards: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns rows, which are written as Parquet and read again as the
next one's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from usagelens.llm.common import remove_stored, stored, stored_paths
from usagelens.llm.queries import table, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below their language's threshold, from a model trained on the labelled ones among them."""
    return toxicity.keep_clean(docs, toxicity_model(docs, spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, the one with the least doc_id."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of a benchmark item."""
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; sources above their share lose rows, others repeat some."""
    return mixing.mixed_rows(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot."""
    return sharding.interleave(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]
#: Training and hashing have no SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stores on its way, and the table it read, is removed once its rows are stored."""
    docs, before = table(spark, sf_dir, "documents"), set(stored_paths())
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        remove_stored(spark, [p for p in stored_paths()[:-1] if p not in before])
    return docs
