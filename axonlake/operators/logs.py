"""Request logs: nearly JSON, over several lines, with bad escapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import local_time

SCHEMA = "uri string, status int, bytes_in long, bytes_out long, duration double, time double, user string, category string, debug string"


def messages(spark: SparkSession, path: str) -> DataFrame:
    """(value): one row for each message. A line that starts with {" begins one, so files are split there, not at every
    line, and large files still split between tasks. Text before the first message of a file is dropped when parsed."""
    x = spark.read.option("lineSep", '\n{"').text(path)
    return x.select(F.when(F.col("value").startswith('{"'), F.col("value")).otherwise(F.concat(F.lit('{"'), "value")).alias("value"))


def parsed(raw: DataFrame) -> DataFrame:
    """Messages as columns: line ends inside are escaped, backslashes that escape nothing doubled; what still is no JSON
    is dropped."""
    text = F.regexp_replace(F.rtrim(F.regexp_replace("value", r"[\r\n]+$", "")), r"\r?\n", r"\\n")
    text = F.regexp_replace(text, r'(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrtu])', r"$1\\\\")
    return raw.select(F.from_json(text, SCHEMA, {"mode": "PERMISSIVE"}).alias("m")).where("m.uri IS NOT NULL").select("m.*")


def with_time(log: DataFrame, zone: str) -> DataFrame:
    return log.withColumn("timestamp", local_time(F.col("time"), zone))


def last_per_user(log: DataFrame, user: str = "user", order: tuple[str, ...] = ("time",), which: str = "last") -> DataFrame:
    """Each user's first or last message and number of messages. max_by pre-aggregates, so a busy user costs one row a
    task rather than a window over all of theirs."""
    pick = F.max_by if which == "last" else F.min_by
    row = F.struct(*(F.col(c) for c in log.columns))
    x = log.groupBy(F.col(user).alias("_u")).agg(pick(row, F.struct(*order)).alias("m"), F.count("*").alias("requests"))
    return x.select("m.*", "requests")
