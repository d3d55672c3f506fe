"""Joins that stay safe when keys are skewed or the small side is not small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.session import checkpoint_dir

# A hint is only given below this many rows; the tables concerned have a handful of columns.
BROADCAST_ROWS = 200_000


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once and cut its lineage, in storage that outlives executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hint_if_small(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a join side for broadcast if its counted size allows.

    Beyond that it is shuffled like any other table, and adaptive execution splits hot keys of the
    other side. Counting is a job of its own, so `side` should be settled or a small scan.
    """
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def rollup_by_employee(
    fact: DataFrame, dim: DataFrame, by: str, per_user: list[Column], final: list[Column]
) -> DataFrame:
    """Aggregate a fact by an employee attribute: per user first, then the join, then by attribute.

    One user may own most rows; after the first step each user is one row, so the join moves as
    many rows as there are users and needs no hint.
    """
    users = fact.filter(F.col("user_email").isNotNull()).groupBy("user_email").agg(*per_user)
    members = dim.select("email", by)
    return users.join(members, users["user_email"] == members["email"]).groupBy(by).agg(*final)
