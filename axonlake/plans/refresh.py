"""Body tables that are brought up to date instead of being built anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotations, stats
from ..sources import shared, versions


def of_bodies(points: DataFrame, partners: DataFrame, bodies: DataFrame) -> DataFrame:
    """Counts of the given bodies only: points and partners of other bodies are left out before they are shuffled."""
    return stats.body_stats(points.join(bodies, "body", "left_semi"), partners.join(bodies.withColumnRenamed("body", "body_pre"), "body_pre", "left_semi"))


def body_counts(spark: SparkSession, path: str, points: DataFrame, partners: DataFrame, changes: DataFrame, upto: int, rows_a_range: int = 1_000_000) -> versions.Manifest:
    """The table of body counts as of a mutation: built in full if there is none, else its stale bodies computed again.

    changes: (version, changed, created) as annotations.stale() takes them. The manifest notes the last mutation that the
    counts hold for; bodies that were changed or created after it and until upto are stale. A body that has no points any
    more has no row any more. If the table holds for upto already nothing is written.
    """
    if not versions.versions(spark, path):
        return versions.create(stats.body_stats(points, partners), path, "body", rows_a_range, {"mutation": upto})
    m = versions.manifest(spark, path)
    if m.source.get("mutation", -1) >= upto:
        return m
    stale = shared.saved(annotations.stale(changes, m.source.get("mutation", -1), upto).select(F.col("body").cast("long").alias("body")), "stale")
    return versions.refresh(spark, path, stale, of_bodies(points, partners, stale), {"mutation": upto})


def sizes(spark: SparkSession, path: str, fetched: DataFrame, stale: DataFrame | None = None, source: dict | None = None) -> versions.Manifest:
    """The cache of body sizes with fetched sizes (body, size) of the stale bodies (of all, if none are given); stale
    bodies that have none keep what the cache has."""
    if not versions.versions(spark, path):
        return versions.create(fetched.select("body", "size"), path, "body", source=source)
    keys = fetched.select("body") if stale is None else fetched.select("body").join(stale.select("body"), "body", "left_semi")
    return versions.refresh(spark, path, keys, fetched.select("body", "size"), source)
