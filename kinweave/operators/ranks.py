"""Exact quantiles per group without holding a group.

Equal values of a group are counted first, before anything is shuffled; running counts in the
order of the values then tell which value stands at a position. The largest group is sorted in
one task, which spills, and never kept in memory.

Defined results: nulls and NaN are no values; between two positions the value is interpolated;
groups without values have no row; an empty table has no groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quantiles(rows: DataFrame, key: str, value: str, points: dict[str, float]) -> DataFrame:
    """(key, a column for each of ``points``): name to the part of the values below, 0 to 1."""
    counts = rows.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)").groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("_c"))
    reached = F.sum("_c").over(Window.partitionBy("_key").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    totals = counts.groupBy("_key").agg(F.sum("_c").alias("_n"))
    placed = counts.withColumn("_upto", reached).join(totals, "_key")
    at = lambda place: F.min(F.when(F.col("_upto") > place, F.col("_v")))
    place = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in points.items()}
    sides = [side for name, x in place.items() for side in (at(F.floor(x)).alias(f"_low_{name}"), at(F.ceil(x)).alias(f"_high_{name}"))]
    found = placed.groupBy("_key", "_n").agg(*sides)
    between = lambda name, x: F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (x - F.floor(x))
    return found.select(F.col("_key").alias(key), *[between(name, x).alias(name) for name, x in place.items()])
