"""Exact quantiles of values that crowd: nanoseconds, doubles, anything with very many distinct values.

`functions.quantiles` sorts the values of one bucket by one task, which holds where a bucket has few distinct values. Here
the range that holds a wanted rank is cut again and again, each time into equal parts between the least and the greatest
value in it, until it has few distinct values; only those are sorted. Every step is a pass over the value counts with
an aggregate that combines before the shuffle; what passes between steps is one row for each group and rank.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.joins import hint_if_small, settle

#: Parts that a range is cut into at each step, and the distinct values that one task may sort.
PARTS = 1024
MOST_DISTINCT = 1 << 16
#: Steps at most; every step takes off at least the least or the greatest value's part, and mostly all but one in PARTS.
MOST_STEPS = 64


def _same(keys: list[str], names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)], F.lit(True))


def quantiles_by_steps(
    counts: DataFrame, keys: list[str], value: str, probs: dict[str, float], most_distinct: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group from value counts (keys, value, n), one column per entry of `probs`.

    `counts` should be a table: it is read once a step. Groups without a value are left out.
    """
    most_distinct = most_distinct or MOST_DISTINCT
    counts = counts.filter(F.col(value).isNotNull())
    group = [f"__k{i}" for i in range(len(keys))]
    totals = counts.groupBy(*[F.col(k).alias(g) for k, g in zip(keys, group)]).agg(
        F.sum("n").alias("total"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("distinct")
    )
    ranks = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(edge).alias("edge"), rounded((F.col("total") - 1) * F.lit(float(p))).cast("long").alias("rank"))
        for name, p in probs.items()
        for edge, rounded in (("lo", F.floor), ("hi", F.ceil))
    ])
    wanted = totals.select(*group, "total", "lo", "hi", "distinct", F.lit(0).cast("long").alias("below"), F.explode(ranks).alias("r"))
    ranges = settle(wanted.select(*group, "total", "lo", "hi", "distinct", "below", "r.*"))
    for _ in range(MOST_STEPS):
        wide = (F.col("distinct") > most_distinct) & (F.col("lo") < F.col("hi"))
        if ranges.filter(wide).isEmpty():
            break
        ranges = settle(_cut(counts, keys, group, value, ranges.filter(wide)).unionByName(ranges.filter(~wide)))
    return _picked(counts, keys, group, value, ranges, probs)


def _inside(counts: DataFrame, keys: list[str], group: list[str], value: str, ranges: DataFrame) -> DataFrame:
    """The value counts within each range of their group; ranges wanted for several ranks once."""
    once = hint_if_small(ranges.select(*group, "lo", "hi", "below").distinct())
    return counts.join(once, _same(keys, group) & F.col(value).between(F.col("lo"), F.col("hi")))


def _cut(counts: DataFrame, keys: list[str], group: list[str], value: str, ranges: DataFrame) -> DataFrame:
    """For each range the part of it that holds the wanted rank."""
    span = F.col("hi").cast("double") - F.col("lo").cast("double")
    part = F.least(F.lit(PARTS - 1), F.floor((F.col(value).cast("double") - F.col("lo").cast("double")) / span * PARTS))
    own = [*group, "lo", "hi", "below"]
    parts = _inside(counts, keys, group, value, ranges).groupBy(*own, part.alias("part")).agg(
        F.sum("n").alias("inside"), F.min(value).alias("least"), F.max(value).alias("most"), F.count(F.lit(1)).alias("here")
    )
    # at most PARTS rows a range
    before = Window.partitionBy(*own).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("start", F.col("below") + F.coalesce(F.sum("inside").over(before), F.lit(0)))
    placed = placed.select(*[F.col(c).alias(f"__p_{c}") for c in own], "start", "inside", "least", "most", "here")
    holds = (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("inside"))
    same = _same([*group, "lo", "hi", "below"], [f"__p_{c}" for c in own])
    return ranges.join(placed, same & holds).select(
        *group, "total", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("here").alias("distinct"),
        F.col("start").alias("below"), "name", "edge", "rank",
    )


def _picked(counts: DataFrame, keys: list[str], group: list[str], value: str, ranges: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Sort what is left of each range and take the values at the ranks."""
    own = [*group, "lo", "hi", "below"]
    by_value = Window.partitionBy(*own).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = _inside(counts, keys, group, value, ranges).withColumn("end", F.col("below") + F.sum("n").over(by_value))
    inside = inside.select(*[F.col(c).alias(f"__p_{c}") for c in own], value, "n", "end")
    same = _same(own, [f"__p_{c}" for c in own])
    holds = (F.col("rank") >= F.col("end") - F.col("n")) & (F.col("rank") < F.col("end"))
    found = ranges.join(inside, same & holds)

    def at(name: str, edge: str) -> Column:
        return F.max(F.when((F.col("name") == name) & (F.col("edge") == edge), F.col(value)).cast("double"))

    def interpolated(name: str, p: float) -> Column:
        rank = (F.max("total") - 1) * F.lit(float(p))
        return (at(name, "lo") + (at(name, "hi") - at(name, "lo")) * (rank - F.floor(rank))).alias(name)

    out = found.groupBy(*group).agg(*[interpolated(name, p) for name, p in probs.items()])
    return out.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *probs)
