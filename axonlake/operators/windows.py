"""Global ranks and running sums without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved

#: Running sums are taken within blocks of so many ranks.
BLOCK = 65_536


def ranked_within(df: DataFrame, groups: list[str], keys: list[str], tie: str, into: str = "rank") -> DataFrame:
    """df with ranks 1, 2, ... within each group by keys (greatest first, nulls last), ties by a column, smallest first.

    Rows are dealt out by ranges of groups, keys and tie and sorted within each range; a row's rank is its place there
    and the rows of its group in the ranges before, of which there is one number for each range and group. So a group
    may span ranges and a range may hold many groups. The sorted rows are saved once, when this is called, so that places
    and numbers come from the same ranges; equal keys are told apart by the tie, so they fill as many ranges as they need.
    """
    order = [*(F.asc_nulls_first(g) for g in groups), *(F.desc_nulls_last(k) for k in keys), F.asc(tie)]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = saved(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftrightunsigned("_at", 33)
    counts = x.groupBy(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)), part.alias("_p")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = [f"_g{k}" for k in range(len(groups))]
    before = F.sum("_n").over(Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*own, "_p", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = part == F.col("_p")
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    return x.join(starts, same).withColumn(into, F.col("_at") + F.col("_shift")).select(*df.columns, into)


def ranked(df: DataFrame, keys: list[str], tie: str, into: str = "rank") -> DataFrame:
    """ranked_within() with all rows as one group."""
    return ranked_within(df, [], keys, tie, into)


def running_within(df: DataFrame, groups: list[str], rank: str, columns: list[str]) -> DataFrame:
    """df with columns replaced by their running sums within each group in the order of a rank 1, 2, ...: sums within
    blocks of ranks, and the totals of the group's blocks before."""
    x = df.withColumn("_b", F.floor((F.col(rank) - 1) / BLOCK))
    totals = x.groupBy(*groups, "_b").agg(*(F.sum(c).alias(c) for c in columns))
    up = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)), F.col("_b").alias("_k"), *(F.coalesce(F.sum(c).over(up), F.lit(0)).alias(f"_{c}") for c in columns))
    within = Window.partitionBy(*groups, "_b").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_b") == F.col("_k")
    for k, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    y = x.join(before, same)
    return y.select(*((F.sum(c).over(within) + F.col(f"_{c}")).alias(c) if c in columns else c for c in df.columns))


def running(df: DataFrame, rank: str, columns: list[str]) -> DataFrame:
    """running_within() with all rows as one group."""
    return running_within(df, [], rank, columns)
