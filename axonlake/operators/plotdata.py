"""Tables behind the plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import side_of
from . import windows


def by_side(stats: DataFrame, name: str, value: str) -> DataFrame:
    """(base, L, R, C, mean, residual, min_side, max_side) of a value by the side in its name."""
    base, side = side_of(F.col(name))
    x = stats.select(base.alias("base"), side.alias("side"), value).groupBy("base").pivot("side", ["L", "R", "C"]).agg(F.max(value))
    both = F.col("L").isNotNull() & F.col("R").isNotNull()
    mean = F.when(both, (F.col("L") + F.col("R")) / 2)
    least = F.when(both, F.when(F.col("L") <= F.col("R"), F.lit("L")).otherwise(F.lit("R")))
    most = F.when(both, F.when(F.col("L") <= F.col("R"), F.lit("R")).otherwise(F.lit("L")))
    return x.select("base", "L", "R", "C", mean.alias("mean"), (F.greatest("L", "R") - mean).alias("residual"), least.alias("min_side"), most.alias("max_side"))


def weighted_mean(stats: DataFrame, value: str, weight: str) -> DataFrame:
    return stats.agg(F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight)).alias("mean"))


def bar_edges(stats: DataFrame, order: str, width: str) -> DataFrame:
    """Running right edges of bars of a given width, in an order of different values; summed up by ranges."""
    x = windows.ranked(stats.withColumn("edge", F.col(width)), [], order, "_rank")
    return windows.running(x, "_rank", ["edge"]).drop("_rank")
