"""Label volumes kept as runs within blocks of 32 x 32 x 32 voxels, valid for the label ids that they were built with."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import VOLUME_SHIFT
from .versions import _folders

#: A block's edge as a power of two.
EDGE = 5
AXES = ("z", "y", "x")
BLOCK = ["kz", "ky", "kx"]


def runs(voxels: DataFrame) -> DataFrame:
    """(kz, ky, kx, runs): blocks of voxels (bz, by, bx, label) that have a label other than 0; a run (at, n, label) is n
    voxels in a row along x from place at, whose bits are z, y and x within the block.

    A voxel that is given twice has its least label. Runs are found in rows of 32 voxels, so no task sees a volume.
    """
    v = voxels.where("label <> 0").groupBy("bz", "by", "bx").agg(F.min("label").cast("int").alias("label"))
    x = v.select(*(F.shiftright(f"b{a}", EDGE).alias(f"k{a}") for a in AXES), *(F.col(f"b{a}").bitwiseAND(F.lit((1 << EDGE) - 1)).cast("int").alias(a) for a in AXES), "label")
    row = Window.partitionBy(*BLOCK, "z", "y", "label").orderBy("x")
    at = F.shiftleft("z", 2 * EDGE).bitwiseOR(F.shiftleft("y", EDGE)).bitwiseOR(F.min("x"))
    found = x.withColumn("_run", F.col("x") - F.row_number().over(row)).groupBy(*BLOCK, "z", "y", "label", "_run").agg(at.alias("at"), F.count("*").cast("int").alias("n"))
    return found.groupBy(*BLOCK).agg(F.array_sort(F.collect_list(F.struct("at", "n", "label"))).alias("runs"))


def save(voxels: DataFrame, path: str, ids: dict[str, int]) -> None:
    """The volume under path: its blocks in order of place, and then a manifest with its box (first and last block by
    axis), the numbers of blocks and voxels, and the ids that it holds for."""
    spark = voxels.sparkSession
    runs(voxels).repartitionByRange(*BLOCK).sortWithinPartitions(*BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")
    x = spark.read.parquet(f"{path}/blocks")
    n = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["n"])
    box = x.agg(*(f(k).alias(f"{name}_{k}") for k in BLOCK for name, f in (("least", F.min), ("most", F.max))), F.count("*").alias("blocks"), F.sum(n).alias("voxels")).first().asDict()
    spark.createDataFrame([(json.dumps({"ids": ids, **box}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def load(spark: SparkSession, path: str, ids: dict[str, int]) -> tuple[DataFrame, dict] | None:
    """(blocks, manifest) of the volume under path; None if there is none or it was built for other ids."""
    if "_SUCCESS" not in _folders(spark, f"{path}/manifest"):
        return None
    m = json.loads("".join(r.value for r in spark.read.text(f"{path}/manifest", wholetext=True).collect()))
    return None if m["ids"] != ids else (spark.read.parquet(f"{path}/blocks"), m)


def cached(spark: SparkSession, path: str, ids: dict[str, int], build: Callable[[], DataFrame]) -> tuple[DataFrame, dict]:
    """The volume under path if it is valid for ids, else the one that is built, and saved there for the next time."""
    if (got := load(spark, path, ids)) is None:
        save(build(), path, ids)
        got = load(spark, path, ids)
    return got


def near(blocks: DataFrame, box: dict, points: DataFrame) -> DataFrame:
    """Voxels (bz, by, bx, label) of the blocks that hold a point. The points' own box, within the volume's, is a filter
    on the blocks' columns, so Parquet skips what lies outside it; the blocks left are met by equality and only theirs
    are unfolded."""
    if not box["blocks"]:
        return blocks.select(*(F.lit(0).alias(f"b{a}") for a in AXES), F.lit(0).alias("label")).where("false")
    here = points.select(*(F.shiftright(a, VOLUME_SHIFT + EDGE).alias(f"k{a}") for a in AXES)).where(" AND ".join(f"{k} BETWEEN {box[f'least_{k}']} AND {box[f'most_{k}']}" for k in BLOCK)).distinct()
    own = here.agg(*(f(k) for k in BLOCK for f in (F.min, F.max))).first()
    if own[0] is None:
        return near(blocks, {"blocks": 0}, points)
    for i, k in enumerate(BLOCK):
        blocks = blocks.where(F.col(k).between(own[2 * i], own[2 * i + 1]))
    x = blocks.join(here, BLOCK, "left_semi").select(*BLOCK, F.explode("runs").alias("r"))
    x = x.select(*BLOCK, F.explode(F.sequence(F.col("r.at"), F.col("r.at") + F.col("r.n") - 1)).alias("p"), F.col("r.label").alias("label"))
    part = lambda k, shift: F.shiftleft(k, EDGE).bitwiseOR(F.shiftright("p", shift).bitwiseAND(F.lit((1 << EDGE) - 1)))
    return x.select(part("kz", 2 * EDGE).alias("bz"), part("ky", EDGE).alias("by"), part("kx", 0).alias("bx"), "label")
