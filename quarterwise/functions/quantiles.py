"""Exact quantiles of groups of any size, from counts in value ranges.

Spark's exact percentile keeps a group's distinct values in one buffer. Here a group is first counted
in ranges of a fixed scale, the same for all groups, so the counts combine map-side and a group
is a few hundred rows however long it is. A wanted rank then lies in one known range, and mostly
at an end of it, whose value is known. Only where it does not, the rows of that one range are
put in order, by a sort that can spill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Ranges per factor e of the value.
SCALE = 64


def value_range(value: Column) -> Column:
    """The number of the range that a value lies in; never falls while the value grows."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * SCALE)


def group_quantiles(rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """(keys, quantiles): as `percentile(value, probabilities)` by `keys`; null and NaN values do not count.

    `rows` is read twice and should be stored.
    """
    own = rows.select(*keys, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    own = own.withColumn("part", value_range(F.col("v")))
    counted = own.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("here"), F.min("v").alias("low"), F.max("v").alias("high"))

    up = W.partitionBy(*keys).orderBy("part")
    placed = counted.withColumn("before", F.sum("here").over(up.rowsBetween(W.unboundedPreceding, 0)) - F.col("here"))
    placed = placed.withColumn("total", F.sum("here").over(W.partitionBy(*keys)))
    ranks = []
    for i, p in enumerate(probabilities):
        at = F.lit(float(p)) * (F.col("total") - 1)
        ranks += [F.struct(F.lit(2 * i).alias("slot"), F.floor(at).alias("rank")), F.struct(F.lit(2 * i + 1).alias("slot"), F.ceil(at).alias("rank"))]
    inside = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("here")))
    wanted = placed.select(*keys, "part", "here", "low", "high", "total", "before", F.inline(inside)).withColumn("rank", F.col("rank") - F.col("before"))
    end = F.when((F.col("rank") == 0) | (F.col("low") == F.col("high")), F.col("low")).when(F.col("rank") == F.col("here") - 1, F.col("high"))
    wanted = wanted.select(*keys, "part", "total", "slot", "rank", end.alias("v"))

    open_ = wanted.where("v is null").select(*keys, "part", "total", "slot", "rank")
    numbered = own.join(open_.select(*keys, "part").distinct(), [*keys, "part"], "left_semi")
    numbered = numbered.withColumn("rank", (F.row_number().over(W.partitionBy(*keys, "part").orderBy("v")) - 1).cast("long"))
    found = open_.join(numbered, [*keys, "part", "rank"]).select(*keys, "total", "slot", "v")
    every = wanted.where("v is not null").select(*keys, "total", "slot", "v").unionByName(found)

    slots = [F.max(F.when(F.col("slot") == s, F.col("v"))).alias(f"s{s}") for s in range(2 * len(probabilities))]
    wide = every.groupBy(*keys).agg(F.max("total").alias("total"), *slots)
    out = []
    for i, p in enumerate(probabilities):
        at, low, high = F.lit(float(p)) * (F.col("total") - 1), F.col(f"s{2 * i}"), F.col(f"s{2 * i + 1}")
        between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        out.append(F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise(between))
    return wide.select(*keys, F.array(*out).alias("quantiles"))
