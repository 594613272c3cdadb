"""Points and partners: filters, semi-joins and the columns that partners take from points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED, ZONE_CUT_Z
from ..functions.scalars import AXIS


def check_kinds(points: DataFrame) -> DataFrame:
    """points, whose kind is asserted row by row while they are read: PreSyn or PostSyn, never null."""
    ok = F.coalesce(F.col("kind").isin("PreSyn", "PostSyn"), F.lit(False))
    return points.where(F.assert_true(ok, F.lit("kind must be PreSyn or PostSyn")).isNull())


def drop_fake(points: DataFrame, partners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Without Fake points and without partners that have a zero end."""
    return points.where(~F.col("kind").eqNullSafe("Fake")), partners.where("pre_id <> 0 AND post_id <> 0")


def in_zone(points: DataFrame, partners: DataFrame, zone: str, cut: int = ZONE_CUT_Z) -> tuple[DataFrame, DataFrame]:
    """One side of a z plane. z is the most significant part of an id, so both filters are id ranges that reach the scan."""
    first = cut << 2 * AXIS
    test = {"brain": "{} < {}", "vnc": "{} >= {}"}.get(zone)
    if not test:
        return points, partners
    return points.where(test.format("point_id", first)), partners.where(f"{test.format('pre_id', first)} AND {test.format('post_id', first)}")


def confident(points: DataFrame, partners: DataFrame, least: float, kind: str = "float") -> tuple[DataFrame, DataFrame]:
    """Points and partners (with conf_pre and conf_post) of at least that confidence, compared in the column's own type."""
    if not least:
        return points, partners
    t = F.lit(least).cast(kind)
    return points.where(F.col("conf") >= t), partners.where((F.col("conf_pre") >= t) & (F.col("conf_post") >= t))


def with_ends(partners: DataFrame, points: DataFrame, *columns: str, regions: list[str] | None = None) -> DataFrame:
    """partners with {column}_pre and {column}_post of every column from both ends, and regions from the post end, which is
    where a connection lies: one join a side, however many columns. Columns of those names are derived anew."""
    left = partners.drop(*(f"{c}_{side}" for c in columns for side in ("pre", "post")), *(regions or []))
    for side in ("pre", "post"):
        own = [F.col(c).alias(f"{c}_{side}") for c in columns] + [F.col(r) for r in (regions or []) if side == "post"]
        left = left.join(points.select(F.col("point_id").alias(f"{side}_id"), *own), f"{side}_id", "left")
    return left


def with_regions(partners: DataFrame, points: DataFrame, roisets: list[str]) -> DataFrame:
    """partners with region columns from the post end, which is where a connection lies."""
    return partners.join(points.select(F.col("point_id").alias("post_id"), *roisets), "post_id", "left")


def drop_body_zero(points: DataFrame, partners: DataFrame) -> tuple[DataFrame, DataFrame]:
    keep = lambda c: ~F.col(c).eqNullSafe(0)
    return points.where(keep("body")), partners.where(keep("body_pre") & keep("body_post"))


def ends_of(partners: DataFrame) -> DataFrame:
    """Distinct point ids that partners refer to."""
    return partners.select(F.explode(F.array("pre_id", "post_id")).alias("point_id")).distinct()


def self_consistent(points: DataFrame, partners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partners both of whose ends exist, then points that still have a partner."""
    ids = points.select("point_id")
    for side in ("pre_id", "post_id"):
        partners = partners.join(ids.withColumnRenamed("point_id", side), side, "left_semi")
    return points.join(ends_of(partners), "point_id", "left_semi"), partners


def in_region(points: DataFrame, partners: DataFrame, roiset: str, roi: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Partners that lie in a region (None: in any of the roiset) and the points that they refer to."""
    partners = partners.where(F.col(roiset) == roi if roi else ~F.col(roiset).eqNullSafe(UNSPECIFIED) & F.col(roiset).isNotNull())
    return points.join(ends_of(partners), "point_id", "left_semi"), partners


def in_bounds(points: DataFrame, partners: DataFrame, roiset: str, rois: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points, partners, bodies): bodies at either end of a connection within rois; partners with such a body at one
    end at least; the points that they refer to. One semi-join on an array's element would not be an equi-join, so each
    end gets a flag."""
    bodies = partners.where(F.col(roiset).isin(rois)).select(F.explode(F.array("body_pre", "body_post")).alias("body")).distinct()
    flagged = partners
    for side in ("body_pre", "body_post"):
        flagged = flagged.join(bodies.select(F.col("body").alias(side), F.lit(True).alias(f"_{side}")), side, "left")
    kept = flagged.where("_body_pre OR _body_post").drop("_body_pre", "_body_post")
    return points.join(ends_of(kept), "point_id", "left_semi"), kept, bodies


def relabelled(points: DataFrame, mapping: DataFrame, key: str = "sv") -> DataFrame:
    """points with body from mapping(key, body); a key that the mapping lacks is its own body."""
    m = mapping.select(F.col(key), F.col("body").alias("_body"))
    return points.drop("body").join(m, key, "left").withColumn("body", F.coalesce("_body", key)).drop("_body")
