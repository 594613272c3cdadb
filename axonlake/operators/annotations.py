"""Body annotations, sizes and element tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED
from ..functions.scalars import camel_case, literal_map, simple_status
from .rois import unpivoted


def replaced(ann: DataFrame, values: dict[str, dict], rename: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Values replaced by column, columns renamed and dropped."""
    for c, mapping in values.items():
        ann = ann.withColumn(c, literal_map(mapping, F.col(c), F.col(c)))
    return ann.withColumnsRenamed(rename or {}).drop(*drop)


def status_counts(ann: DataFrame) -> DataFrame:
    """Bodies by status, the best first; empty statuses are left out."""
    return ann.groupBy("status", "status_rank").agg(F.count("*").alias("n")).where("status <> ''").orderBy(F.desc("status_rank")).select("status", "n")


def first_per_body(points: DataFrame) -> DataFrame:
    """The first point of each body in z, y, x order."""
    w = Window.partitionBy("body").orderBy("z", "y", "x")
    return points.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_point_annotations(ann: DataFrame, points: DataFrame, column: str) -> DataFrame:
    """ann outer-joined with each body's first annotated point; its value replaces the column."""
    p = first_per_body(points).select("body", F.col(column).alias("_new"))
    return ann.join(p, "body", "full").withColumn(column, F.col("_new")).drop("_new")


def combined(new: DataFrame, cached: DataFrame, key: str, value: str) -> DataFrame:
    """New values win, cached ones fill."""
    return new.select(key, F.col(value).alias("_new")).join(cached.select(key, F.col(value).alias("_old")), key, "full").select(key, F.coalesce("_new", "_old").alias(value))


def stale(changes: DataFrame, after: int, upto: int) -> DataFrame:
    """Bodies that a range of versions changed or created."""
    x = changes.where((F.col("version") > after) & (F.col("version") <= upto))
    return x.select(F.explode(F.array("changed", "created")).alias("body")).where("body IS NOT NULL").distinct()


def coalesced(df: DataFrame, into: str, columns: list[str]) -> DataFrame:
    """The first non-null of duplicate columns."""
    return df.withColumn(into, F.coalesce(*columns)).drop(*(c for c in columns if c != into))


def graph_names(columns: list[str], explicit: dict[str, str]) -> dict[str, list[str]]:
    """Export name -> source columns: explicit names win ('' drops), others are camel case with Position as Location.
    Several sources of one name are coalesced in order."""
    out: dict[str, list[str]] = {}
    for c in columns:
        name = explicit.get(c, camel_case(c).replace("Position", "Location"))
        if name:
            out.setdefault(name, []).append(c)
    return out


def graph_annotations(ann: DataFrame, explicit: dict[str, str]) -> DataFrame:
    """Annotations under export names; statusLabel gives status; empty strings are null; all-null columns are dropped."""
    names = graph_names([c for c in ann.columns if c != "body"], explicit)
    kinds = dict(ann.dtypes)
    clean = lambda c: F.nullif(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c)
    x = ann.select("body", *(F.coalesce(*(clean(c) for c in cs)).alias(n) for n, cs in names.items()))
    if "statusLabel" in names:
        x = x.withColumn("status", simple_status(F.col("statusLabel")))
    full = x.agg(*(F.count(c).alias(c) for c in x.columns)).first().asDict()
    return x.select(*(c for c in x.columns if full[c] or c == "body"))


def numeric(c: Column, kind: str) -> Column:
    """Text as a number where it is one, else null."""
    return c.try_cast(kind)


def choices(ann: DataFrame, column: str) -> DataFrame:
    return ann.agg(F.array_join(F.array_sort(F.collect_set(column)), ";").alias("choices"))


def presence(elements: DataFrame, roisets: list[str]) -> DataFrame:
    """Distinct (body, roiset, roi, element) without unspecified regions."""
    return unpivoted(elements, roisets, "body", "element").where(F.col("roi") != UNSPECIFIED).select("body", "roiset", "roi", "element").distinct()


def elements_in(elements: DataFrame, roiset: str, distances: DataFrame | None, synapses: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Elements in a region; distances both of whose ends are a synapse or such an element."""
    kept = elements.where(F.col(roiset) != UNSPECIFIED)
    if distances is None:
        return kept, None
    ids = synapses.select("point_id").union(kept.select("point_id")).distinct()
    for side in ("source_id", "target_id"):
        distances = distances.join(ids.withColumnRenamed("point_id", side), side, "left_semi")
    return kept, distances
