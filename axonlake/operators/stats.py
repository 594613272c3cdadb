"""Counts by body and region."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED
from . import windows
from .rois import unpivoted

COUNTS = ("pre", "post", "downstream", "upstream", "synweight")


def _tagged(points: DataFrame, partners: DataFrame, *keys: str) -> DataFrame:
    """Points and partners as one stream of keys and a tag, so that all counts come from one shuffle."""
    own = points.select(F.col("body"), *keys, F.when(F.col("kind") == "PreSyn", 0).otherwise(1).alias("tag"))
    return own.unionByName(partners.select(F.col("body_pre").alias("body"), *keys, F.lit(2).alias("tag")))


def _counts(x: DataFrame, *keys: str) -> DataFrame:
    n = [F.count_if(F.col("tag") == k) for k in range(3)]
    return x.groupBy(*keys).agg(n[0].alias("pre"), n[1].alias("post"), n[2].alias("downstream"), n[1].alias("upstream"), (n[1] + n[2]).alias("synweight"))


def body_stats(points: DataFrame, partners: DataFrame) -> DataFrame:
    """(body, pre, post, downstream, upstream, synweight): upstream is the post count, downstream the partner rows."""
    return _counts(_tagged(points, partners), "body")


def body_region_stats(points: DataFrame, partners: DataFrame, roisets: list[str]) -> DataFrame:
    """body_stats for each region; a partner counts where its post end lies. Unspecified regions only for the first
    roiset by name, so every body has a row."""
    own = unpivoted(points, roisets, "body", "kind").select("body", "roiset", "roi", F.when(F.col("kind") == "PreSyn", 0).otherwise(1).alias("tag"))
    out = unpivoted(partners, roisets, "body_pre").select(F.col("body_pre").alias("body"), "roiset", "roi", F.lit(2).alias("tag"))
    x = own.unionByName(out).where((F.col("roi") != UNSPECIFIED) | (F.col("roiset") == min(roisets)))
    return _counts(x, "body", "roi")


def compartment_counts(points: DataFrame, partners: DataFrame, *keys: str) -> DataFrame:
    """Inputs (from PostSyn points) and outputs (from partners) of each body by compartment."""
    ins = points.where("kind = 'PostSyn'").select("body", *keys, F.lit("In").alias("way"), F.col("compartment").alias("c"))
    outs = partners.select(F.col("body_pre").alias("body"), *keys, F.lit("Out").alias("way"), F.col("compartment_pre").alias("c"))
    n = lambda c, w: F.count_if((F.col("c") == c) & (F.col("way") == w)).alias(f"{c}{w}")
    return ins.unionByName(outs).groupBy("body", *keys).agg(*(n(c, w) for c in ("axon", "dendrite") for w in ("In", "Out")))


def element_counts(elements: DataFrame, kinds: list[str]) -> DataFrame:
    """Elements of each body in all and by kind."""
    return elements.groupBy("body").agg(F.count("*").alias("total"), *(F.count_if(F.col("type") == k).alias(k) for k in kinds))


def element_pivot(elements: DataFrame, kinds: list[str]) -> DataFrame:
    return elements.groupBy("body", "roi").pivot("type", kinds).agg(F.count(F.lit(1))).na.fill(0, kinds)


def region_totals(by_region: DataFrame) -> DataFrame:
    return by_region.where(F.col("roi") != UNSPECIFIED).groupBy("roi").agg(F.sum("pre").alias("pre"), F.sum("post").alias("post"))


def dataset_totals(by_region: DataFrame, rois: list[str] | None = None) -> DataFrame:
    x = by_region if rois is None else by_region.where(F.col("roi").isin(rois))
    return x.agg(F.coalesce(F.sum("pre"), F.lit(0)).alias("pre"), F.coalesce(F.sum("post"), F.lit(0)).alias("post"))


def region_info(by_region: DataFrame) -> DataFrame:
    """(body, roiInfo, roiset_hash): JSON of each region's counts in order of names, zeros and unspecified left out."""
    counts = F.struct(*(F.when(F.col(c) != 0, F.col(c)).alias(c) for c in COUNTS))
    entry = F.when(F.col("roi") != UNSPECIFIED, F.struct("roi", counts.alias("counts")))
    names = F.array_join(F.array_sort(F.collect_set(F.when(F.col("roi") != UNSPECIFIED, F.col("roi")))), ",")
    return by_region.groupBy("body").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("roiInfo"), F.xxhash64(names).alias("roiset_hash"))


def region_names(by_region: DataFrame) -> DataFrame:
    """(body, rois): the named regions of each body in order, comma-joined."""
    named = F.when(F.col("roi") != UNSPECIFIED, F.col("roi"))
    return by_region.groupBy("body").agg(F.array_join(F.array_sort(F.collect_set(named)), ",").alias("rois"))


def ranked(stats: DataFrame, ann: DataFrame) -> DataFrame:
    """Body counts with status and type, ranked by synweight, pre and post, ties by body."""
    return windows.ranked(stats, ["synweight", "pre", "post"], "body").join(ann, "body", "left")


def regions(by_region: DataFrame) -> DataFrame:
    """(body, roiInfo, rois): region_info() and region_names() from one aggregation."""
    counts = F.struct(*(F.when(F.col(c) != 0, F.col(c)).alias(c) for c in COUNTS))
    entry = F.when(F.col("roi") != UNSPECIFIED, F.struct("roi", counts.alias("counts")))
    found = by_region.groupBy("body").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return found.select("body", F.to_json(F.map_from_entries("e")).alias("roiInfo"), F.array_join(F.transform("e", lambda x: x["roi"]), ",").alias("rois"))


def counts_of(tables: dict[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """(key, a count for each name): rows of each table by a column of it, 0 where a key is in other tables only. Tables
    are one stream of keys and tags, so there is one shuffle instead of an aggregation and an outer join for each."""
    rows = [df.select(F.col(c).alias(key), F.lit(k).alias("tag")) for k, (df, c) in enumerate(tables.values())]
    return union_all(*rows).groupBy(key).agg(*(F.count_if(F.col("tag") == k).alias(n) for k, n in enumerate(tables)))


def with_properties(counts: DataFrame, *tables: DataFrame, key: str = "body") -> DataFrame:
    """counts with the columns of tables that have a row or none for a key."""
    return reduce(lambda a, b: a.join(b, key, "left"), tables, counts)


def flags(by_region: DataFrame, rois: list[str]) -> DataFrame:
    """One boolean column for each region that a body is in (null elsewhere)."""
    return by_region.groupBy("body").pivot("roi", rois).agg(F.first(F.lit(True)))


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
