"""What several operators share: intermediate tables, running totals, and pieces of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelens.session import scratch_path
from usagelens.sources.commits import remove_path

# Rows that one task sorts at a time where running totals are taken bucket by bucket.
BUCKET_ROWS = 1024
# Text that Python code holds as objects at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


class LlmError(ValueError):
    """An input or a setting that an operator of this package can't work with."""


_stored: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _stored.append(path)
    return df.sparkSession.read.parquet(path)


def stored_paths() -> list[str]:
    """The tables that this process has stored and not removed, in order."""
    return list(_stored)


def remove_stored(spark: SparkSession, paths: list[str]) -> None:
    """Remove stored tables; frames that still read them fail from then on."""
    for path in paths:
        remove_path(spark, path)
        _stored.remove(path)


def with_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; a typed error where one is missing."""
    if missing := [x for x in names if x not in df.columns]:
        raise LlmError(f"missing columns: {', '.join(missing)}")
    return df.select(*names)


def id_text(doc_id: str = "doc_id") -> Column:
    """The id as a text that is never null, to join by."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))


def buckets_for(n_rows: int) -> int:
    """How many buckets keep one at about BUCKET_ROWS rows."""
    return max(1, -(-n_rows // BUCKET_ROWS))


def running_total(df: DataFrame, by: list[str], bucket: Column, order: list, value: Column, name: str) -> DataFrame:
    """Add `name`: the total of `value` over the rows before this one in its group.

    A group's order is (bucket, order). Rows are only sorted within a bucket, and bucket totals are
    summed in a table of one row per group and bucket, so no task sorts a whole group. All of `by`
    and the bucket must not be null, and `df` must give the same rows each time it is computed.
    """
    keyed = df.withColumn("_bucket", bucket).withColumn("_value", value)
    keys = [*by, "_bucket"]
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*keys)
        .agg(F.sum("_value").alias("_sum"))
        .select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_inner", F.coalesce(F.sum("_value").over(inner), F.lit(0)))
    return (
        placed.join(offsets, keys)
        .withColumn(name, (F.col("_offset") + F.col("_inner")).cast("long"))
        .drop("_bucket", "_value", "_inner", "_offset")
    )


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold about `limit` bytes at most."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each value of `key` (an integer, never null), from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for a, b in zip(starts, starts[1:]):
            if held and values[a] != last:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield held


def numbers(group: list[pa.RecordBatch], column: str) -> np.ndarray:
    return np.concatenate([b.column(column).to_numpy() for b in group])


def lists(group: list[pa.RecordBatch], column: str) -> list[np.ndarray]:
    out = []
    for b in group:
        c = b.column(column)
        flat, cuts = c.values.to_numpy(), c.offsets.to_numpy()
        out += [flat[i:j] for i, j in zip(cuts, cuts[1:])]
    return out
