"""Row selections that several products share: key membership, values, order, first of a group, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_key(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key others hold."""
    return df.join(others.select(key).distinct(), key, "left_semi")


def without_key(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key no other row holds; rows with a null key stay."""
    return df.join(others.select(key).distinct(), key, "left_anti")


def without_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows whose column is none of the values; null is none of them."""
    return df.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def retained(df: DataFrame, column: str, pattern: str, date: str, now: str, days: int) -> DataFrame:
    """Rows that a retention rule names: column matches the pattern and the date is more than days before now."""
    return df.where(F.col(column).rlike(pattern) & (F.datediff(F.lit(now), F.col(date)) > days))


def greatest_of(df: DataFrame, group: str, key: str, by: str) -> DataFrame:
    """(group, key): of each group the key (a number) of the row that is greatest by a column, ties by the least key."""
    return df.groupBy(group).agg(F.max_by(key, F.struct(by, F.negative(key))).alias(key))


def with_group_size(df: DataFrame, group: str, into: str) -> DataFrame:
    """df with the number of rows of each row's group. Counts are added up before the shuffle and joined."""
    sizes = df.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias(into))
    return df.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def in_order(df: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Rows by keys, greatest first, ties by a column, least first."""
    return df.orderBy(*(F.desc(k) for k in keys), F.asc(tie))


def first_of(df: DataFrame, keys: list[str], tie: str, n: int) -> DataFrame:
    """The first n rows in order; each task passes on n rows at most."""
    return in_order(df, keys, tie).limit(n)


def once_each(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of columns."""
    return df.select(*columns).dropDuplicates()


def join_null_safe(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """left joined with right on a key for which null equals null; one column of it stays."""
    r = right.withColumnRenamed(key, "_key")
    return left.join(r, F.col(key).eqNullSafe(F.col("_key")), how).drop("_key")


def distinct_counts(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """By key, how many different values each column has: name -> column."""
    return df.groupBy(key).agg(*(F.countDistinct(c).alias(n) for n, c in columns.items()))


def latest(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the latest value of any of the columns."""
    return df.agg(F.max(F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])).alias("latest"))
