"""Merkle manifest of a table: a digest for each row, a root for the whole, and a proof for each row.

Rows are leaves in groups; within a group every eight consecutive nodes become a parent, level by level, until one is
left; the groups' last nodes become one root in the same way. Each level is a self-join: every node's siblings have
indices that follow from its own (slot offsets within its run), so nodes meet siblings by equality of (group, index),
and the rows in slot zero emit the parents. Proofs come from the top down: a node's path is its own siblings and then its
parent's path, so that no key has more than eight rows, however large a group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

ARITY = 8


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null is a hyphen."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return digest(*map(field, columns))


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path of siblings give."""
    return F.aggregate(path, node, lambda h, step: digest(step["before"], h, step["after"]))


def _indexed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes (g, order...) with i, their place from 0 in their group, and n, the group's size.

    Rows are sorted by ranges of group and order; a range's own places are shifted by the group's rows in the ranges
    before, of which there is a number for each range and group.
    """
    keys = [F.asc_nulls_first(c) for c in ("g", *order)]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = saved(nodes.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "leaves")
    part = F.shiftrightunsigned("at", 33)
    runs = x.groupBy("g", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("m"))
    group = Window.partitionBy("g")
    before = F.sum("m").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(F.col("g").alias("g_"), F.col("part").alias("part_"), (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("m").over(group).alias("n"))
    return x.join(starts, (F.col("g") == F.col("g_")) & (part == F.col("part_"))).withColumn("i", F.col("at") + F.col("shift")).drop("at", "g_", "part_", "shift")


def _level(nodes: DataFrame) -> DataFrame:
    """nodes (g, i, n, h, ...) with before and after: the digests of their siblings on either side."""
    slot = F.col("i") % ARITY
    near = nodes.select("g", "i", "n", F.explode(F.sequence(F.lit(1), F.lit(ARITY - 1))).alias("off")).select("g", "i", "n", (F.col("i") - slot + (slot + F.col("off")) % ARITY).alias("j")).where("j < n")
    met = near.join(nodes.select("g", F.col("i").alias("j"), F.col("h").alias("other")), ["g", "j"]).groupBy("g", "i").agg(F.array_sort(F.collect_list(F.struct("j", "other"))).alias("s"))
    side = lambda test: F.array_join(F.transform(F.filter("s", test), lambda x: x["other"]), "")
    text = lambda c: F.coalesce(c, F.lit(""))
    return nodes.join(met, ["g", "i"], "left").select(*nodes.columns, text(side(lambda x: x["j"] < F.col("i"))).alias("before"), text(side(lambda x: x["j"] > F.col("i"))).alias("after"))


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of nodes that have a parent, and the nodes (g, n = 1, h, level) at which groups end."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.where("n = 1").select("g", "h", F.lit(0).alias("level"))
    while most > 1:
        levels.append(saved(_level(nodes.where("n > 1")), f"level{len(levels)}"))
        parents = levels[-1].where(F.col("i") % ARITY == 0)
        nodes = parents.select("g", F.floor(F.col("i") / ARITY).alias("i"), F.ceil(F.col("n") / ARITY).alias("n"), digest("h", "after").alias("h"))
        tops = tops.unionByName(nodes.where("n = 1").select("g", "h", F.lit(len(levels)).alias("level")))
        most = -(-most // ARITY)
    return levels, tops


def _paths(levels: list[DataFrame], tops: DataFrame, leaves: DataFrame) -> DataFrame:
    """leaves with the columns of their group's top (but level) and path, their siblings from the leaf up to the root.
    tops: (g, level, path, ...), path the part above the group."""
    more = [c for c in tops.columns if c not in ("g", "level", "path")]
    out = None
    for k in range(len(levels), -1, -1):
        here = tops.where(F.col("level") == k)
        own = [c for c in leaves.columns if c not in ("g", "i", "n", "h")] if k == 0 else []
        if k == 0:
            ended = leaves.where("n = 1").join(here, "g").select("g", "i", *(["h", *own]), "path", *more)
        else:
            ended = here.select("g", F.lit(0).cast("long").alias("i"), "path", *more)
        if k < len(levels):
            up = out.select("g", F.col("i").alias("up"), F.col("path").alias("above"), *more)
            x = levels[k].withColumn("up", F.floor(F.col("i") / ARITY)).join(up, ["g", "up"])
            path = F.concat(F.array(F.struct("before", "after")), "above").alias("path")
            ended = ended.unionByName(x.select("g", "i", *(["h", *own] if k == 0 else []), path, *more))
        out = ended
    return out


def manifest(rows: DataFrame, group: Column, order: Column, node: Column, keep: dict[str, Column]) -> DataFrame:
    """Each row's columns keep, its leaf, subroot, root and path, an array of (before, after): the siblings' digests.

    rows: any table; only the given expressions of it are used, so its other columns may have any names. group and order
    say which leaf stands where (null ones first; equal places by leaf and kept columns, so repeated rows stand
    together), node is the leaf's digest. An empty table gives no rows.
    """
    named = {f"keep_{k}": c for k, c in keep.items()}
    key = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("g")
    x = _indexed(saved(rows.select(key, order.alias("o"), node.alias("h"), *(c.alias(k) for k, c in named.items())), "digests"), ["o", "h", *named])
    x = x.select("g", "i", "n", "h", *named)
    levels, tops = _grown(x)
    tops = saved(tops, "subroots")
    heads = _indexed(tops.select(F.lit("").alias("g"), F.col("g").alias("o"), "h", F.col("level").alias("height")), ["o"])
    heads = heads.select("g", "i", "n", "h", "o", "height")
    above, root = _grown(heads)
    root = root.select("g", "level", F.array().cast("array<struct<before:string,after:string>>").alias("path"), F.col("h").alias("root"))
    heads = _paths(above, root, heads)
    heads = saved(heads.select(F.col("o").alias("g"), F.col("height").alias("level"), "path", F.col("h").alias("subroot"), "root"), "heads")
    out = _paths(levels, heads, x)
    return out.select(*(F.col(k).alias(k.removeprefix("keep_")) for k in named), F.col("h").alias("leaf"), "subroot", "root", "path")


def proof(path: Column) -> Column:
    """All siblings of a path in order, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
