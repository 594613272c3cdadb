"""Neurotransmitters: predictions of points, bodies and cell types."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import NT_LIMITS
from ..functions.scalars import argmax_name, literal_map


def normalised_names(columns: list[str], translations: dict[str, str]) -> dict[str, str]:
    """Column name -> nt_<transmitter>_prob for columns such as nts_8.gaba or nt_gaba_prob."""
    out = {}
    for c in columns:
        if m := re.fullmatch(r"nts?_(?:[0-9]+\.)?([a-z]+)(?:_prob)?", c):
            out[c] = f"nt_{translations.get(m[1], m[1])}_prob"
    return out


def predicted(points: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """points with pred1, the most probable transmitter."""
    return points.withColumn("pred1", argmax_name(F.array(*columns), names))


def not_training(points: DataFrame, indicators: tuple[str, ...] = ("train", "validation")) -> DataFrame:
    """Points of bodies none of whose points were used in training."""
    used = points.where(F.col("split").isin(*indicators)).select("body").distinct()
    return points.join(used, "body", "left_anti")


def confusion(points: DataFrame, truth: DataFrame, names: list[str]) -> DataFrame:
    """(ground_truth, pred1, p): of every pair of transmitters, the share of a truth's points that were so predicted;
    0 where a truth has none."""
    spark = points.sparkSession
    n = points.join(truth, "cell_type").where("pred1 IS NOT NULL").groupBy("ground_truth", "pred1").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(a, b) for a in names for b in names], "ground_truth string, pred1 string")
    x = every.join(n, ["ground_truth", "pred1"], "left").na.fill(0, ["n"])
    total = F.sum("n").over(Window.partitionBy("ground_truth"))
    return x.select("ground_truth", "pred1", F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0)).alias("p"))


def mode(points: DataFrame, group: str) -> DataFrame:
    """(group, group_pred): the most frequent prediction, ties by name; null predictions compete, nulls last."""
    n = points.groupBy(group, "pred1").agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), F.asc_nulls_last("pred1"))
    x = n.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    pred = F.when(F.col(group).isNotNull(), F.col("pred1"))
    return x.select(group, pred.alias("group_pred"))


def group_confidence(points: DataFrame, modes: DataFrame, matrix: DataFrame, group: str) -> DataFrame:
    """(group, confidence, num_tbar_nt_predictions): mean of the matrix at (group prediction, point prediction). A pair of
    predictions that the matrix lacks is an error."""
    own = modes.select(F.col(group).alias("_g"), "group_pred")
    x = points.select(group, "pred1").join(own, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    m = matrix.select(F.col("ground_truth").alias("group_pred"), "pred1", "p")
    y = x.join(m, ["group_pred", "pred1"], "left")
    known = F.col("group_pred").isNull() | F.col("pred1").isNull() | F.col("p").isNotNull()
    y = y.where(F.assert_true(known, F.lit("the confusion matrix lacks a pair of predictions")).isNull())
    return y.groupBy(group).agg(F.coalesce(F.avg("p"), F.lit(0.0)).alias("confidence"), F.count("pred1").alias("num_tbar_nt_predictions"))


def group_predictions(points: DataFrame, ann: DataFrame, matrix: DataFrame, group: str) -> DataFrame:
    """(group, top_pred, confidence, num_tbar_nt_predictions) of every group of the points or annotations; groups
    without points are unclear, with null counts."""
    modes = mode(points, group)
    x = modes.join(group_confidence(points, modes, matrix, group).withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    known = ann.select("body", "cell_type") if group == "body" else ann.select("cell_type").distinct()
    on = known.select(F.col(group).alias("_k"), *(["cell_type"] if group == "body" else []))
    y = x.join(on, F.col(group).eqNullSafe(F.col("_k")), "full")
    cols = [F.coalesce(group, "_k").alias(group)] + (["cell_type"] if group == "body" else [])
    return y.select(*cols, F.coalesce("group_pred", F.lit("unclear")).alias("top_pred"), "confidence", "num_tbar_nt_predictions")


def erased(bodies: DataFrame, types: DataFrame, limits: dict = NT_LIMITS) -> tuple[DataFrame, DataFrame]:
    """Unreliable predictions become unclear; a type of at most one cell has the limit of a body."""
    weak = (F.col("confidence") < limits["body_confidence"]) | (F.col("num_tbar_nt_predictions") < limits["body_presyn"])
    b = bodies.withColumn("top_pred", F.when(weak, F.lit("unclear")).otherwise(F.col("top_pred")))
    cells = bodies.where("cell_type IS NOT NULL").groupBy("cell_type").agg(F.count("*").alias("num_cells"))
    t = types.join(cells, "cell_type", "left").na.fill(0, ["num_cells"])
    least = F.when(F.col("num_cells") <= 1, limits["body_presyn"]).otherwise(limits["celltype_presyn"])
    weak = (F.col("confidence") < limits["celltype_confidence"]) | (F.col("num_tbar_nt_predictions") < least)
    return b, t.withColumn("top_pred", F.when(weak, F.lit("unclear")).otherwise(F.col("top_pred")))


def with_type_predictions(bodies: DataFrame, types: DataFrame) -> DataFrame:
    """Bodies with their cell type's prediction; untyped bodies match the untyped row."""
    t = types.select(F.col("cell_type").alias("_t"), F.col("top_pred").alias("celltype_predicted_nt"), F.col("confidence").alias("celltype_predicted_nt_confidence"), F.col("num_tbar_nt_predictions").alias("celltype_total_nt_predictions"))
    total = F.coalesce("num_tbar_nt_predictions", F.lit(0))
    x = bodies.join(t, F.col("cell_type").eqNullSafe(F.col("_t")), "left")
    return x.select("body", "cell_type", F.col("top_pred").alias("predicted_nt"), F.col("confidence").alias("predicted_nt_confidence"), total.alias("total_nt_predictions"), "celltype_predicted_nt", "celltype_predicted_nt_confidence", F.coalesce("celltype_total_nt_predictions", total).alias("celltype_total_nt_predictions"))


def with_consensus(bodies: DataFrame, override: dict[str, str], truth: DataFrame) -> DataFrame:
    """consensus_nt: the type's prediction, or the body's own if it is untyped; overrides; then experimental truth."""
    own = F.when(F.col("cell_type").isNull(), F.col("predicted_nt")).otherwise(F.col("celltype_predicted_nt"))
    t = truth.select(F.col("cell_type").alias("_t"), F.col("consensus_nt").alias("_truth"))
    x = bodies.join(t, F.col("cell_type") == F.col("_t"), "left")
    return x.withColumn("consensus_nt", F.coalesce("_truth", literal_map(override, own, own))).drop("_t", "_truth")


def mean_scores(points: DataFrame, columns: list[str]) -> DataFrame:
    return points.groupBy("body").agg(*(F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in columns))


def kept_if_same_type(bodies: DataFrame, ann: DataFrame) -> DataFrame:
    """Predictions of bodies whose type changed since are erased."""
    x = bodies.join(ann.select("body", "type"), "body", "left")
    return x.withColumn("predicted_nt", F.when(F.col("cell_type") != F.col("type"), None).otherwise(F.col("predicted_nt"))).drop("type")


def prediction_counts(points: DataFrame, group: str) -> DataFrame:
    """(group, n): points with a prediction; a null group is one."""
    return points.groupBy(group).agg(F.count("pred1").alias("n"))


def of_points(points: DataFrame, predictions: DataFrame) -> DataFrame:
    """Pre points with the columns of their predictions (by point_id), null where there is none."""
    return points.where("kind = 'PreSyn'").join(predictions, "point_id", "left")


def multi_split(points: DataFrame) -> DataFrame:
    """(body, splits): bodies whose points are in more than one part of the split for training; unsplit points don't
    count."""
    return points.groupBy("body").agg(F.countDistinct("split").alias("splits")).where("splits > 1")
