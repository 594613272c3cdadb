"""Groups of rows dealt to a bounded number of files, each group whole in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows


def of_groups(df: DataFrame, key: str, files: int) -> DataFrame:
    """(key, size, batch): the groups of equal keys with their rows and the number of the file that they go to.

    Groups stand in a row, the largest first (ties by key, greatest first), and a file takes what begins within its
    share, so groups are never cut. A group that fills a share of all rows has a file of its own; the other files'
    share is what remains without those, and is corrected for them once. Files are numbered from 0 without gaps. Null
    keys are a group. There are as many rows here as groups, ranked and added up by ranges; no task sees them all.
    """
    if files < 1:
        raise ValueError("at least one file")
    groups = windows.ranked(df.groupBy(key).agg(F.count("*").alias("size")), ["size", key], key, "_rank")
    n = groups.agg(F.sum("size")).first()[0] or 0
    share = -(-n // files)
    alone, rows = groups.where(F.col("size") >= share).agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = max(1, (n - rows + files - 1) // max(1, files - alone))
    upto = windows.running(groups.withColumn("_upto", F.col("size")), "_rank", ["_upto"])
    raw = upto.select(key, "size", F.floor((F.col("_upto") - F.col("size")) / share).alias("_raw"))
    numbers = windows.ranked(raw.select("_raw").distinct(), [], "_raw", "batch")
    return raw.join(numbers, "_raw").select(key, "size", (F.col("batch") - 1).cast("int").alias("batch"))


def with_batch(df: DataFrame, key: str, batches: DataFrame, *columns: str) -> DataFrame:
    """df with the columns of its group's batch. An inner join with one row a group, so Spark may split a large group."""
    b = batches.select(F.col(key).alias("_key"), *(columns or ("batch",)))
    return df.join(b, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def regions(batches: DataFrame, key: str, unnamed: bool = False) -> DataFrame:
    """(batch, rows, combinations, regions): what each file holds; key is a comma-joined list of region names, and
    regions are the sorted names that any of its groups has. With unnamed, a group without regions has an empty name."""
    names = F.split(key, ",")
    name = F.explode_outer(names if unnamed else F.filter(names, lambda r: r != ""))
    sizes = batches.groupBy("batch").agg(F.sum("size").alias("rows"), F.count("*").alias("combinations"))
    names = batches.select("batch", name.alias("_r")).distinct().groupBy("batch").agg(F.array_sort(F.collect_list("_r")).alias("regions"))
    return sizes.join(names, "batch")


def flags(names: Column, of: Column) -> Column:
    """A text for each region in of: true where the comma-joined names hold it, else empty."""
    held = F.split(names, ",")
    return F.transform(of, lambda r: F.when(F.array_contains(held, r), F.lit("true")).otherwise(F.lit("")))
