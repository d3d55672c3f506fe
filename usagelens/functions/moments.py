"""Mean and standard deviation from counts, sums and sums of squares that can be added and taken away.

Values are summed as whole numbers of a unit, so the order of rows, partitions, parts and retries changes nothing.
The unit follows the value's magnitude, a power of 1000: 13 digits of each value count, however large or small
the values are, and a sum holds 10^12 of the largest squares. There is one row for each magnitude that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.schemas import struct

DIGITS = 13
WHOLE = "decimal(38,0)"
MOMENTS = struct(magnitude="int", n="bigint", units=T.DecimalType(38, 0), squares=T.DecimalType(38, 0))
NAMES = MOMENTS.fieldNames()


def moments(rows: DataFrame, value: Column, sign: int = 1) -> DataFrame:
    """The moments of the positive values of `rows`; with `sign` -1 those that take them away again."""
    size = (F.ceil(F.log10("v") / 3) * 3).cast("int")
    counted = rows.select(value.alias("v")).filter("v > 0").withColumn("magnitude", size)
    units = F.round(F.col("v") * F.pow(F.lit(10.0), F.lit(DIGITS) - F.col("magnitude")), 0).cast("decimal(18,0)")
    scaled = counted.select("magnitude", units.alias("u"))
    sums = {
        "n": F.count(F.lit(1)),
        "units": F.sum(F.col("u").cast(WHOLE)),
        "squares": F.sum((F.col("u") * F.col("u")).cast(WHOLE)),
    }
    return scaled.groupBy("magnitude").agg(*[(c if sign > 0 else -c).alias(name) for name, c in sums.items()])


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Moments of several sets of rows added up; magnitudes that nothing is left of are gone."""
    sums = [F.sum(c).cast(MOMENTS[c].dataType).alias(c) for c in NAMES[1:]]
    return parts.groupBy(*keys, "magnitude").agg(*sums).filter("n <> 0")


def statistics(parts: DataFrame) -> DataFrame:
    """One row (n, mean, std) of moments; std is NULL for fewer than two values, mean for none.

    Squares are taken relative to each magnitude's mean in whole numbers before anything is rounded, so a mean far
    above the deviation costs no digits. The magnitudes, some ten rows at most, are folded in their order.
    """
    whole_mean = F.expr("units div n").cast(WHOLE)
    rest = F.col("units") - whole_mean * F.col("n").cast(WHOLE)
    about_mean = F.col("squares") - (whole_mean * (F.col("units") + rest)).cast(WHOLE)
    unit = F.pow(F.lit(10.0), F.col("magnitude") - DIGITS)
    n, units, left = (c.cast("double") for c in (F.col("n"), F.col("units"), rest))
    own = merged(parts).select(
        "magnitude",
        n.alias("n"),
        (units * unit).alias("total"),
        (units / n * unit).alias("mean"),
        ((about_mean.cast("double") - left * left / n) * unit * unit).alias("about"),
    )
    held = own.agg(F.sort_array(F.collect_list(F.struct("magnitude", "n", "total", "mean", "about"))).alias("held"))

    def folded(term) -> Column:
        return F.aggregate("held", F.lit(0.0), lambda total, x: total + term(x))

    whole = held.select("held", folded(lambda x: x["n"]).alias("n"), folded(lambda x: x["total"]).alias("total"))
    about = whole.select(
        "held", "n", (F.col("total") / F.nullif("n", F.lit(0.0))).alias("mean")
    ).withColumn("about", folded(lambda x: x["about"] + x["n"] * (x["mean"] - F.col("mean")) * (x["mean"] - F.col("mean"))))
    std = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("about"), F.lit(0.0)) / (F.col("n") - 1)))
    return about.select(F.col("n").cast("long").alias("n"), "mean", std.alias("std"))
