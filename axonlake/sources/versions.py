"""Tables that are refreshed in part: ranges of a key, each in the version that last changed it.

A table lies in {path}/data/version=V/low=L, a folder for the keys from L up to the next range's, and has a manifest for
each version in {path}/manifests/V, which says for each range in which version it is to be found. A refresh writes only
the ranges that hold changed keys and then its manifest; files of other ranges are neither read nor touched, readers of
an older version are not disturbed, and a refresh that fails leaves the table as it was. Everything goes by Hadoop paths.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import range_of
from . import shared

#: Of the first range; no key is less.
LOWEST = -(1 << 63)


@dataclass
class Manifest:
    """A version: its number, the key column, how many rows a range is to have, the schema, what the rows were computed
    from, and for each range (low, the version that holds it, rows) in order."""

    version: int
    key: str
    rows_a_range: int
    schema: str
    source: dict = field(default_factory=dict)
    ranges: list[tuple[int, int, int]] = field(default_factory=list)

    @property
    def lows(self) -> list[int]:
        return [r[0] for r in self.ranges]


def _folders(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that a table has; none if there is no table."""
    return sorted(int(v) for v in _folders(spark, f"{path}/manifests") if v.isdigit() and "_SUCCESS" in _folders(spark, f"{path}/manifests/{v}"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """Of a version, the last one by default."""
    if not (every := versions(spark, path)) or (version is not None and version not in every):
        raise ValueError(f"no such version of {path}: {version}")
    rows = spark.read.text(f"{path}/manifests/{every[-1] if version is None else version}", wholetext=True).collect()
    m = json.loads("".join(r.value for r in rows))
    return Manifest(**{**m, "ranges": [tuple(r) for r in m["ranges"]]})


def _write_manifest(spark: SparkSession, path: str, m: Manifest) -> None:
    spark.createDataFrame([(json.dumps(m.__dict__),)], "value string").coalesce(1).write.text(f"{path}/manifests/{m.version}")


def _cuts(x: DataFrame, key: str, lows: list[int], rows_a_range: int) -> list[int]:
    """lows and the keys at which ranges of over twice rows_a_range are cut into shares. One number for each range and
    one for each cut come to the driver."""
    at = range_of(F.col(key), lows).alias("_at")
    sizes = {r._at: r.n for r in x.groupBy(at).agg(F.count("*").alias("n")).collect()}
    large = {k: -(-n // rows_a_range) for k, n in sizes.items() if n > 2 * rows_a_range}
    if not large:
        return lows
    shares = max(large.values())
    found = x.withColumn("_at", range_of(F.col(key), lows)).where(F.col("_at").isin(list(large))).groupBy("_at").agg(F.percentile_approx(key, [k / shares for k in range(1, shares)], 100 * shares).alias("q"))
    more = {q for r in found.collect() for k, q in enumerate(r.q, 1) if k * large[r._at] // shares != (k - 1) * large[r._at] // shares}
    return sorted({*lows, *more})


def _write(x: DataFrame, path: str, version: int, key: str, lows: list[int]) -> dict[int, int]:
    """Rows by range, written to a version's folders, a task for each range."""
    low = F.element_at(F.lit(lows), range_of(F.col(key), lows) + 1)
    folder = f"{path}/data/version={version}"
    x.withColumn("low", low).repartition("low").write.mode("overwrite").partitionBy("low").parquet(folder)
    return {r.low: r.n for r in x.sparkSession.read.parquet(folder).groupBy(F.col("low").cast("long").alias("low")).agg(F.count("*").alias("n")).collect()} if any(n.startswith("low=") for n in _folders(x.sparkSession, folder)) else {}


def create(df: DataFrame, path: str, key: str, rows_a_range: int = 1_000_000, source: dict | None = None) -> Manifest:
    """Version 0 of a table with a row or more for each key, a long that isn't null. Fails where there is a table."""
    spark = df.sparkSession
    if versions(spark, path):
        raise ValueError(f"{path} has versions")
    x = shared.saved(df, "whole")
    lows = _cuts(x, key, [LOWEST], rows_a_range)
    rows = _write(x, path, 0, key, lows)
    m = Manifest(0, key, rows_a_range, df.schema.json(), source or {}, [(low, 0, rows.get(low, 0)) for low in lows])
    _write_manifest(spark, path, m)
    return m


def read(spark: SparkSession, path: str, version: int | None = None, least: int | None = None, most: int | None = None) -> DataFrame:
    """A version's rows, of the ranges that can hold keys from least to most."""
    m = manifest(spark, path, version)
    x = _ranges(spark, path, m, [k for k in range(len(m.ranges)) if (most is None or m.lows[k] <= most) and (least is None or k + 1 == len(m.ranges) or m.lows[k + 1] > least)])
    for test in ([F.col(m.key) >= least] if least is not None else []) + ([F.col(m.key) <= most] if most is not None else []):
        x = x.where(test)
    return x


def _ranges(spark: SparkSession, path: str, m: Manifest, which: list[int]) -> DataFrame:
    schema = StructType.fromJson(json.loads(m.schema))
    paths = [f"{path}/data/version={m.ranges[k][1]}/low={m.ranges[k][0]}" for k in which if m.ranges[k][2]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def refresh(spark: SparkSession, path: str, stale: DataFrame, rows: DataFrame, source: dict | None = None) -> Manifest:
    """The next version: rows of the keys in stale (its column key) are replaced by rows, which may have fewer or more
    keys of them, or none; other keys of rows are ignored. No stale keys give a version that only notes the source.

    Only ranges with a stale key are read and written, by one task each; one that grows beyond twice its share is cut.
    """
    m = manifest(spark, path)
    keys = shared.saved(stale.select(F.col(m.key).cast("long").alias(m.key)).where(F.col(m.key).isNotNull()).distinct(), "stale")
    hit = sorted(r[0] for r in keys.select(range_of(F.col(m.key), m.lows)).distinct().collect())
    version = m.version + 1
    kept = {low: (low, v, n) for low, v, n in m.ranges}
    if hit:
        schema = StructType.fromJson(json.loads(m.schema))
        new = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)).join(keys, m.key, "left_semi")
        merged = shared.saved(_ranges(spark, path, m, hit).join(keys, m.key, "left_anti").select(*schema.names).unionByName(new), "merged")
        lows = _cuts(merged, m.key, m.lows, m.rows_a_range)
        written = _write(merged, path, version, m.key, lows)
        touched = {m.lows[k] for k in hit} | (set(lows) - set(m.lows))
        kept |= {low: (low, version, written.get(low, 0)) for low in touched}
    out = Manifest(version, m.key, m.rows_a_range, m.schema, {**m.source, **(source or {})}, [kept[low] for low in sorted(kept)])
    _write_manifest(spark, path, out)
    return out
