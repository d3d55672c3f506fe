"""Exact quantiles and histograms that no single task has to hold.

Both start from value counts: one row per (group, distinct value) with its frequency, aggregated
on the map side, so a hot group or a hot value shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets are about 0.4 % wide, so a group has at most some 22,000 of them whatever its size.
BUCKETS_PER_E = 256


def value_counts(rows: DataFrame, keys: list[str], value: str, *extra: Column) -> DataFrame:
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), *extra)


def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where NULL keys match each other, as they do in GROUP BY."""
    renamed = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"r_{k}"]) for k in keys])
    return left.join(renamed, same).drop(*[f"r_{k}" for k in keys])


def _bucket(value: Column) -> Column:
    """A coarse bucket number that never decreases as the value grows."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log1p(F.abs(v)) * BUCKETS_PER_E)).cast("bigint")


# An aggregate that can be taken in steps: a function (sum, max, ...) and what it is applied to.
Carried = tuple[Callable[[Column | str], Column], Column]


def quantiles(
    counts: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    carry: dict[str, Carried] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of `probs`.

    Ranks are located in two steps: a running count over the bounded number of buckets says which
    buckets hold the wanted ranks, then only those buckets are ordered value by value.

    `carry` adds other aggregates over the value counts; they ride along instead of being computed
    apart and joined. With it a group without any value stays, with NULL quantiles; without it such
    a group has nothing to report and is left out.
    """
    carry = carry or {}
    constant = ["__all"] if not keys else []
    if constant:
        counts, keys = counts.withColumn("__all", F.lit(0)), constant
    counts = counts.withColumn("__b", _bucket(F.col(value)))

    has_value = F.col(value).isNotNull()
    per_bucket = counts.groupBy(*keys, "__b").agg(
        F.coalesce(F.sum(F.when(has_value, F.col("n"))), F.lit(0)).alias("__bn"),
        *[fn(column).alias(name) for name, (fn, column) in carry.items()],
    )
    # both frames share one sort
    by_bucket = Window.partitionBy(*keys).orderBy("__b")
    running = by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = per_bucket.select(
        *keys,
        "__b",
        F.sum("__bn").over(group).alias("__total"),
        F.sum("__bn").over(running).alias("__upto"),
        (F.sum("__bn").over(running) - F.col("__bn")).alias("__below"),
        *[fn(name).over(group).alias(name) for name, (fn, _) in carry.items()],
    )

    ranks = {name: f"(__total - 1) * {float(p)!r}D" for name, p in probs.items()}
    holds = " OR ".join(
        f"(__below <= {edge}({r}) AND {edge}({r}) < __upto)"
        for r in ranks.values()
        for edge in ("floor", "ceil")
    )
    # a group without values has one bucket, the one of NULL
    empty = "__total = 0" if carry else "false"
    wanted = ranked.filter(f"{holds} OR {empty}").drop("__upto")

    inside = _join_on_keys(counts.select(*keys, "__b", value, "n"), wanted, [*keys, "__b"])
    by_value = (
        Window.partitionBy(*keys, "__b")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = inside.withColumn("__end", F.col("__below") + F.sum("n").over(by_value))

    def at(edge: str, rank: str) -> str:
        position = f"{edge}({rank})"
        inside_run = f"__end - n <= {position} AND {position} < __end"
        return f"CAST(max(CASE WHEN {inside_run} THEN {value} END) AS DOUBLE)"

    picked = inside.groupBy(*keys).agg(
        F.max("__total").alias("__total"),
        *[F.expr(at("floor", r)).alias(f"__lo_{name}") for name, r in ranks.items()],
        *[F.expr(at("ceil", r)).alias(f"__hi_{name}") for name, r in ranks.items()],
        *[F.max(name).alias(name) for name in carry],
    )
    interpolated = [
        f"__lo_{name} + (__hi_{name} - __lo_{name}) * ({r} - floor({r})) AS {name}"
        for name, r in ranks.items()
    ]
    return picked.selectExpr(*[k for k in keys if k not in constant], *interpolated, *carry)


def mean_of(value: str) -> dict[str, Carried]:
    """What `mean` needs: exact sum and number of the integers behind value counts."""
    wide = "decimal(19,0)"
    total = F.col(value).cast(wide) * F.col("n").cast(wide)
    counted = F.when(F.col(value).isNotNull(), F.col("n"))
    return {"__mean_sum": (F.sum, total), "__mean_n": (F.sum, counted)}


def mean() -> Column:
    return F.col("__mean_sum").cast("double") / F.nullif(F.col("__mean_n"), F.lit(0))


def histogram(counts: DataFrame, value: str, max_bins: int) -> DataFrame:
    """At most `max_bins` equal, whole-numbered bins over integer values; empty bins are left out."""
    bounds = counts.agg(F.min(value).alias("__min"), F.max(value).alias("__max"))
    # one row by construction
    placed = counts.crossJoin(F.broadcast(bounds))
    width = F.ceil((F.col("__max") - F.col("__min") + 1) / F.lit(max_bins))
    lower = F.col("__min") + F.floor((F.col(value) - F.col("__min")) / width) * width
    return (
        placed.groupBy(
            lower.cast("bigint").alias("bin_start"), (lower + width).cast("bigint").alias("bin_end")
        )
        .agg(F.sum("n").cast("bigint").alias("row_count"))
        .orderBy("bin_start")
    )
