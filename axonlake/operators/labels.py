"""Region labels: tables of (roi, label) that are one-to-one, complete and stable from one snapshot to the next.

Label 0 is the unspecified region's and no other's. Tables are DataFrames with a row for each region.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED
from ..functions.scalars import label_template, literal_map
from ..sources import shared
from . import windows
from .rois import unpivoted, with_parents


def table_of(spark: SparkSession, ids: dict[str, int]) -> DataFrame:
    """Given labels as a table."""
    return spark.createDataFrame([(k, v) for k, v in ids.items()], "roi string, label int")


def names_in(points: DataFrame, roiset: str) -> DataFrame:
    """(roi): the regions that occur; null ones are unspecified."""
    return points.select(F.coalesce(roiset, F.lit(UNSPECIFIED)).alias("roi")).distinct()


def region_list(points: DataFrame, roiset: str) -> list[str]:
    """The named regions of a roiset in order: a short list, for settings."""
    return [r.roi for r in names_in(points, roiset).where(F.col("roi") != UNSPECIFIED).orderBy("roi").collect()]


def allocated(names: DataFrame, given: DataFrame) -> DataFrame:
    """Labels for all names: given ones stay, whether their region occurs or not, new names come after the greatest in
    their order. The unspecified region has 0 if it occurs or is given."""
    new = names.where(F.col("roi") != UNSPECIFIED).join(given, "roi", "left_anti").select("roi").distinct()
    ranked = windows.ranked(new, [], "roi", "place")
    most = given.agg(F.coalesce(F.max("label"), F.lit(0)).alias("most"))
    after = ranked.join(most, F.lit(True)).select("roi", (F.col("most") + F.col("place")).cast("int").alias("label"))
    zero = names.where(F.col("roi") == UNSPECIFIED).join(given, "roi", "left_anti").select("roi", F.lit(0).alias("label")).distinct()
    return given.select("roi", F.col("label").cast("int").alias("label")).unionByName(after).unionByName(zero)


def one_to_one(table: DataFrame) -> DataFrame:
    """The table, if no region and no label is in it twice, and 0 is the unspecified region's; else its reading fails."""
    n = lambda c: F.count("*").over(Window.partitionBy(c))
    x = table.withColumn("_r", n("roi")).withColumn("_l", n("label"))
    good = (F.col("_r") == 1) & (F.col("_l") == 1) & F.col("label").isNotNull() & ((F.col("label") == 0) == (F.col("roi") == UNSPECIFIED))
    said = F.concat(F.lit("labels are not one-to-one at "), F.coalesce("roi", F.lit("null")), F.lit(" = "), F.coalesce(F.col("label").cast("string"), F.lit("null")))
    return x.where(F.assert_true(F.coalesce(good, F.lit(False)), said).isNull()).select("roi", "label")


def distinct_across(tables: dict[str, DataFrame]) -> None:
    """Fails if a region other than the unspecified one is in two roisets."""
    x = reduce(DataFrame.unionByName, (t.select("roi").distinct() for t in tables.values()))
    twice = [r.roi for r in x.where(F.col("roi") != UNSPECIFIED).groupBy("roi").count().where("count > 1").orderBy("roi").limit(20).collect()]
    if twice:
        raise ValueError(f"regions in more than one roiset: {twice}")


def labelled(points: DataFrame, roiset: str, table: DataFrame) -> DataFrame:
    """points with {roiset}_label by name. A region without a label, or a table that isn't one-to-one, fails when the
    points are read; the check is part of the join, so it costs no pass of its own."""
    t = one_to_one(table).select(F.col("roi").alias("_roi"), F.col("label").alias("_label"))
    x = points.drop(f"{roiset}_label").withColumn(roiset, F.coalesce(roiset, F.lit(UNSPECIFIED)))
    x = x.join(t, F.col(roiset) == F.col("_roi"), "left")
    known = F.assert_true(F.col("_label").isNotNull(), F.concat(F.lit(f"a region of {roiset} has no label: "), F.col(roiset)))
    return x.where(known.isNull()).withColumnRenamed("_label", f"{roiset}_label").drop("_roi")


def named(points: DataFrame, roiset: str, table: DataFrame) -> DataFrame:
    """points with the region's name by {roiset}_label, checked as in labelled()."""
    t = one_to_one(table).select(F.col("roi").alias("_roi"), F.col("label").alias("_label"))
    x = points.drop(roiset).join(t, F.col(f"{roiset}_label") == F.col("_label"), "left")
    x = x.withColumn("_roi", F.coalesce("_roi", F.when(F.coalesce(f"{roiset}_label", F.lit(0)) == 0, F.lit(UNSPECIFIED))))
    known = F.assert_true(F.col("_roi").isNotNull(), F.concat(F.lit(f"a label of {roiset} has no name: "), F.col(f"{roiset}_label").cast("string")))
    return x.where(known.isNull()).withColumnRenamed("_roi", roiset).drop("_label").withColumn(f"{roiset}_label", F.coalesce(f"{roiset}_label", F.lit(0)))


def loaded(points: DataFrame, roiset: str, ids: dict[str, int] | None = None, template: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(points with {roiset} and {roiset}_label, table), whichever of the two columns the points have.

    ids: labels by name, which must then list every region that occurs; without them and with names, labels are given in
    the order of names, and with a template the names are made from the labels that occur.
    """
    has_name, has_label = roiset in points.columns, f"{roiset}_label" in points.columns
    if not (has_name or has_label):
        raise ValueError(f"points have neither {roiset} nor {roiset}_label")
    if template:
        if not has_label:
            raise ValueError(f"a template for {roiset} needs {roiset}_label")
        found = points.select(F.coalesce(f"{roiset}_label", F.lit(0)).cast("int").alias("label")).distinct()
        table = found.select(F.when(F.col("label") == 0, F.lit(UNSPECIFIED)).otherwise(label_template(template, F.col("label"))).alias("roi"), "label")
    elif ids:
        table = table_of(points.sparkSession, {UNSPECIFIED: 0, **ids})
    elif has_name:
        table = shared.saved(allocated(names_in(points, roiset), table_of(points.sparkSession, {})), "labels")
    else:
        raise ValueError(f"{roiset}_label has no names: give ids or a template")
    return (labelled if has_name else named)(points, roiset, table), table


def renamed(points: DataFrame, roiset: str, table: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Regions renamed in points and table; labels stay. Two regions can't become one."""
    new = lambda c: literal_map(names, F.col(c), F.col(c)).alias(c)
    return points.withColumn(roiset, new(roiset)), one_to_one(table.select(new("roi"), "label"))


def with_parent_labels(points: DataFrame, tables: dict[str, DataFrame], parents: dict[str, tuple[str, list[str]]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Unspecified regions filled from parent roisets, as with_parents() does, and the regions that this makes labelled
    after the roiset's greatest label, in the order of names; if no point is unspecified any more, that region goes. The
    regions of all roisets are found in one pass over the points; they and the new tables are saved."""
    filled, out = with_parents(points, parents), dict(tables)
    names = shared.saved(unpivoted(filled, list(parents)).select("roiset", F.coalesce("roi", F.lit(UNSPECIFIED)).alias("roi")).distinct(), "names")
    for roiset in parents:
        out[roiset] = shared.saved(allocated(names.where(F.col("roiset") == roiset).select("roi"), tables[roiset].where(F.col("roi") != UNSPECIFIED)), "labels")
    for roiset in parents:
        filled = labelled(filled, roiset, out[roiset])
    return filled, out
