"""What the corpus operators share: shared-folder tables, shipping of this package, word splitting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()
_own_dir: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python functions can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(), f"{PACKAGE.name}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, f"{PACKAGE.name}/{p.relative_to(PACKAGE)}")
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a temporary one where that is unset (tests)."""
    sc = spark.sparkContext
    if d := sc.getConf().get("spark.checkpoint.dir", None):
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own_dir:
        own = tempfile.mkdtemp(prefix="axonlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _own_dir[sc.applicationId] = f"file://{own}"
    return _own_dir[sc.applicationId]


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/axonlake-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clean(spark: SparkSession) -> None:
    """Delete the tables that this application has saved; results that still read them can't be computed any more."""
    _delete(spark, _tables(spark))


def forget(df: DataFrame) -> None:
    """Delete the table that saved() made, if df is one; what still reads it can't be computed any more."""
    if path := getattr(df, "_saved_in", None):
        _delete(df.sparkSession, path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to a table in the shared folder and read back: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{_tables(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}.parquet")
    out = spark.read.schema(df.schema).parquet(f"{path}/{name}.parquet")
    out._saved_in = path
    return out


def saved_alone(df: DataFrame, name: str) -> DataFrame:
    """saved(), with the shuffle files that the write has made deleted once the table stands: nothing reads them again,
    and they are as large as what was shuffled."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return saved(df, name)
    finally:
        conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that df has no column of, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n in taken:
            n += "_"
        out.append(n)
        taken.add(n)
    return out


def id_key() -> Column:
    """The doc_id as a join key; null ones share the smallest long, so they count as one document."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def n_packs(docs: DataFrame, pack_bytes: int) -> int:
    """How many packs of about pack_bytes of text the table makes; at least the number of shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // pack_bytes))


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text with A-Z in lower case, as UTF-8. bytes.split() and lower() are ASCII-only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(from, to) runs of texts of about size bytes; a longer text is a run of its own."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield at, to
        at = to
