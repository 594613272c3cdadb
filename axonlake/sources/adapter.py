"""Star-schema tables as connectome tables: lineitem rows are connections, orders pre points, parts bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import UNSPECIFIED

#: Body ids are sparse: customers and parts times this.
STEP = 100_003


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections with bodies, integer confidence, compartments and regions; a post id is the line's place in its order.
    Lines and orders meet by pre_id itself, so that what comes next by pre_id needs no shuffle of its own."""
    t = lambda n: read(spark, sf_dir, n)
    place = F.row_number().over(Window.partitionBy("pre_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"))
    lines = t("lineitem").withColumn("pre_id", F.col("l_orderkey") * 64).select("pre_id", "l_partkey", "l_suppkey", "l_discount", "l_returnflag", place.alias("n"))
    orders = t("orders").select((F.col("o_orderkey") * 64).alias("_pre"), "o_custkey", "o_orderstatus")
    regions = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    x = lines.join(orders, F.col("pre_id") == F.col("_pre")).join(regions, F.col("l_suppkey") == F.col("s_suppkey"))
    one_of = lambda c, a, b, other: F.when(F.col(c) == a, F.lit("axon")).when(F.col(c) == b, F.lit("dendrite")).otherwise(F.lit(other))
    return x.select(
        "pre_id",
        (F.col("pre_id") + F.col("n")).alias("post_id"),
        (F.col("o_custkey") * STEP).alias("body_pre"),
        (F.col("l_partkey") * STEP).alias("body_post"),
        F.round(F.col("l_discount") * 100).cast("int").alias("conf_post"),
        one_of("o_orderstatus", "F", "O", "unknown").alias("compartment_pre"),
        one_of("l_returnflag", "A", "N", "linker").alias("compartment_post"),
        F.when(F.col("n_nationkey") % 5 == 0, F.lit(UNSPECIFIED)).otherwise(F.col("n_name")).alias("primary_roi"),
        F.when(F.col("r_regionkey") == 4, F.lit(UNSPECIFIED)).otherwise(F.col("r_name")).alias("shell_roi"),
    )


def points(syn: DataFrame) -> DataFrame:
    """Pre points once each (regions of no meaning there), post points with the connection's confidence and regions."""
    pre = syn.select(F.col("pre_id").alias("point_id"), F.col("body_pre").alias("body"), F.lit("PreSyn").alias("kind"), F.lit(10).alias("conf"), F.col("compartment_pre").alias("compartment"), F.lit(UNSPECIFIED).alias("primary_roi"), F.lit(UNSPECIFIED).alias("shell_roi")).distinct()
    return pre.unionByName(syn.select(F.col("post_id").alias("point_id"), F.col("body_post").alias("body"), F.lit("PostSyn").alias("kind"), F.col("conf_post").alias("conf"), F.col("compartment_post").alias("compartment"), "primary_roi", "shell_roi"))


def ends(syn: DataFrame) -> DataFrame:
    """Body and kind of points(), for which connections need no post ids, confidences and regions."""
    pre = syn.select("pre_id", F.col("body_pre").alias("body"), "compartment_pre").distinct().select("body", F.lit("PreSyn").alias("kind"))
    return pre.unionByName(syn.select(F.col("body_post").alias("body"), F.lit("PostSyn").alias("kind")))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with a status rank and a type, null for large parts."""
    p = read(spark, sf_dir, "part")
    return p.select((F.col("p_partkey") * STEP).alias("body"), ((F.col("p_partkey") * 7) % 30).cast("int").alias("status_rank"), F.when(F.col("p_size") <= 45, F.col("p_type")).alias("type"))


#: Names of the transmitters that the embeddings' first numbers stand for.
TRANSMITTERS = ["acetylcholine", "dopamine", "gaba", "glutamate", "histamine", "octopamine", "serotonin"]


def nt_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with seven scores, a body, a cell type (null for some) and a training split."""
    e = read(spark, sf_dir, "embeddings")
    scores = [F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate(TRANSMITTERS)]
    split = F.when(F.col("vec_id") % 97 == 0, F.lit("train")).otherwise(F.lit("test"))
    body = F.floor(F.col("vec_id") / 8)
    return e.select("vec_id", (body * STEP).alias("body"), F.when(body % 7 != 0, F.concat(F.lit("T"), (body % 12).cast("string"))).alias("cell_type"), split.alias("split"), *scores)


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element points: lines by ship date, part and supplier, typed by their status."""
    x = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    z = F.datediff("l_shipdate", F.lit("1995-01-01"))
    return x.select((z + 4000).alias("z"), F.col("l_partkey").alias("y"), F.col("l_suppkey").alias("x"), (F.col("l_partkey") * STEP).alias("body"), F.col("l_linestatus").alias("type"), F.when(F.col("s_nationkey") % 5 == 0, F.lit(UNSPECIFIED)).otherwise(F.concat(F.lit("R"), F.col("s_nationkey").cast("string"))).alias("roi")).distinct()
