"""Connected components of a graph given as an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges with the least neighbour m of u. The key is an expression, so both sides are dealt out anew for the join
    and adaptive execution may split a node of very high degree."""
    least = least.select(F.col("u").bitwiseXOR(F.lit(0)).alias("k"), "m")
    return edges.join(least.hint("shuffle_merge"), F.col("u").bitwiseXOR(F.lit(0)) == F.col("k")).drop("k")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the least node reachable. Only nodes with an edge to another node appear.

    Null ends and loops are ignored; repeated edges count once; no edges give no rows. Nothing is collected: each round
    is two shuffles of the current edges, which shrink to one star for each component, and is written to the shared
    folder. The minimum of a node's neighbours is pre-aggregated before the shuffle.
    """
    lo, hi = F.least(a, b).cast("long"), F.greatest(a, b).cast("long")
    e = saved(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    before = _digest(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least).where("v <> m").select("v", "m").union(least.select("u", "m"))
        e = saved(small.toDF("u", "v").distinct(), "small")
        after = _digest(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components have not settled")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
