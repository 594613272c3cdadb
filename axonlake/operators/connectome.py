"""Body-to-body connectivity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import COMPARTMENT_WEIGHTS, SIGNIFICANT, UNSPECIFIED
from .rois import unpivoted


def compartment_weights() -> list[Column]:
    return [F.count_if((F.col("compartment_pre") == a) & (F.col("compartment_post") == b)).alias(n) for n, (a, b) in COMPARTMENT_WEIGHTS.items()]


def weighted(partners: DataFrame, compartments: bool = False) -> DataFrame:
    """Connections between each two bodies, with the compartment breakdown from the same pass."""
    x = partners.dropna(subset=["body_pre", "body_post"]).groupBy("body_pre", "body_post")
    return x.agg(F.count("*").alias("weight"), *(compartment_weights() if compartments else []))


def confidence_weights(partners: DataFrame, high_accuracy: float, high_precision: float, compartments: bool = False) -> DataFrame:
    """weightHR (all), weight (medium and high), weightHP (high): a connection is high from high_precision on, else
    medium from high_accuracy on."""
    high = F.col("conf_post") >= high_precision
    medium = F.col("conf_post") >= high_accuracy
    aggs = [F.count("*").alias("weightHR"), F.count_if(high | medium).alias("weight"), F.count_if(high).alias("weightHP")]
    return partners.groupBy("body_pre", "body_post").agg(*aggs, *(compartment_weights() if compartments else []))


def regional(partners: DataFrame, roisets: list[str], min_conf: float | None = None) -> DataFrame:
    """(body_pre, body_post, roi, post): connections of each pair by region over all roisets, zero counts left out.
    Unspecified ones only count for the first roiset by name, which gives every pair a row."""
    first = min(roisets)
    x = unpivoted(partners, roisets, "body_pre", "body_post", "conf_post").where(f"roi <> '{UNSPECIFIED}' OR roiset = '{first}'")
    n = F.count("*") if min_conf is None else F.count_if(F.col("conf_post") >= min_conf)
    return x.where("roi IS NOT NULL").groupBy("body_pre", "body_post", "roi").agg(n.alias("post"))


def pair_region_info(partners: DataFrame, roisets: list[str], min_conf: float | None = None) -> DataFrame:
    """(body_pre, body_post, roiInfo): JSON of the regions in order, {} for pairs without a named one."""
    named = (F.col("roi") != UNSPECIFIED) & (F.col("post") > 0)
    entry = F.when(named, F.struct("roi", F.struct("post").alias("counts")))
    return regional(partners, roisets, min_conf).groupBy("body_pre", "body_post").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("roiInfo"))


def of_status(partners: DataFrame, ann: DataFrame, least: int = SIGNIFICANT) -> DataFrame:
    """Partners between bodies whose status rank is at least that."""
    good = ann.where(F.col("status_rank") >= least).select("body")
    for side in ("body_pre", "body_post"):
        partners = partners.join(good.withColumnRenamed("body", side), side, "left_semi")
    return partners


def with_types(weights: DataFrame, ann: DataFrame) -> DataFrame:
    for side in ("pre", "post"):
        weights = weights.join(ann.select(F.col("body").alias(f"body_{side}"), F.col("type").alias(f"type_{side}")), f"body_{side}", "left")
    return weights
