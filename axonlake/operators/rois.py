"""Regions: labels, unions, parents, volumes."""

from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED, VOLUME_SHIFT
from ..functions.scalars import literal_map, parent_fallback


def region_table(points: DataFrame, roiset: str) -> DataFrame:
    """(roi, roi_label): names in order, the unspecified one first with label 0; null names are unspecified."""
    names = points.select(F.coalesce(roiset, F.lit(UNSPECIFIED)).alias("roi")).distinct()
    w = Window.orderBy(F.when(F.col("roi") == UNSPECIFIED, 0).otherwise(1), "roi")
    first = F.max(F.when(F.col("roi") == UNSPECIFIED, 1).otherwise(0)).over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return names.select("roi", (F.row_number().over(w) - first).cast("int").alias("roi_label"))


def with_labels(points: DataFrame, roiset: str) -> DataFrame:
    """points with {roiset}_label; the table of names is small, so Spark broadcasts it if its measured size allows."""
    t = region_table(points, roiset).select(F.col("roi").alias(roiset), F.col("roi_label").alias(f"{roiset}_label"))
    return points.withColumn(roiset, F.coalesce(roiset, F.lit(UNSPECIFIED))).join(t, roiset, "left")


def union_of(points: DataFrame, source: str, unions: dict[str, list[str]], name: str) -> DataFrame:
    """points with a roiset of disjoint unions of another's regions."""
    members = [m for ms in unions.values() for m in ms]
    if len(members) != len(set(members)):
        raise ValueError("a region is in two unions")
    return points.withColumn(name, literal_map({m: u for u, ms in unions.items() for m in ms}, F.col(source), F.lit(UNSPECIFIED)))


def renamed(points: DataFrame, roiset: str, names: dict[str, str]) -> DataFrame:
    return points.withColumn(roiset, literal_map(names, F.col(roiset), F.col(roiset)))


def with_parents(points: DataFrame, parents: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Unspecified regions filled from parent roisets (roiset -> (parent, parent regions)), parents before children."""
    for roiset in TopologicalSorter({r: [p] for r, (p, _) in parents.items()}).static_order():
        if roiset in parents:
            parent, rois = parents[roiset]
            points = points.withColumn(roiset, parent_fallback(F.col(roiset), F.col(parent), rois))
    return points


def from_volume(points: DataFrame, voxels: DataFrame, roiset: str) -> DataFrame:
    """{roiset}_label of points from sparse voxels (bz, by, bx, label) of 32 units; outside there is 0."""
    at = [F.shiftright(c, VOLUME_SHIFT).alias(f"b{c}") for c in "zyx"]
    x = points.select("*", *at).join(voxels, ["bz", "by", "bx"], "left")
    return x.withColumn(f"{roiset}_label", F.coalesce("label", F.lit(0)).cast("int")).drop("bz", "by", "bx", "label")


def named(points: DataFrame, roiset: str, labels: dict[str, int]) -> DataFrame:
    """roiset of points from {roiset}_label; label 0 is unspecified, a label without a name is an error."""
    label, names = F.col(f"{roiset}_label"), {v: k for k, v in labels.items()} | {0: UNSPECIFIED}
    known = F.coalesce(label.isin(list(names)), F.lit(False))
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    checked = points.where(F.assert_true(known, F.lit(f"a label of {roiset} has no name")).isNull())
    return checked.withColumn(roiset, F.element_at(table, label))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unpivoted(df: DataFrame, roisets: list[str], *keep: str) -> DataFrame:
    """One row for each roiset: (keep..., roiset, roi), so that every roiset is handled by one plan."""
    pairs = F.array(*(F.struct(F.lit(r).alias("roiset"), F.col(r).alias("roi")) for r in roisets))
    return df.select(*keep, F.explode(pairs).alias("_r")).select(*keep, "_r.roiset", "_r.roi")
