"""Streams: the log's last message of each user, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def last_per_user(stream: DataFrame, user: str, order: tuple[str, ...]) -> DataFrame:
    """The streaming form of operators.logs.last_per_user: state is one row for each user."""
    row = F.struct(*(F.col(c) for c in stream.columns))
    x = stream.groupBy(F.col(user).alias("_u")).agg(F.max_by(row, F.struct(*order)).alias("m"), F.count("*").alias("requests"))
    return x.select("m.*", "requests")


def requests_by_window(stream: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Messages by time window, with a watermark so that state is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w")).agg(F.count("*").alias("n")).select("w.start", "w.end", "n")


def events(spark: SparkSession, path: str) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)
