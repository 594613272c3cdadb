"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset a temporary folder, which only a local master can use."""
    sc = spark.sparkContext
    if d := sc.getConf().get("spark.checkpoint.dir", None):
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = tempfile.mkdtemp(prefix="axonlake-")
        atexit.register(shutil.rmtree, _own[sc.applicationId], ignore_errors=True)
    return f"file://{_own[sc.applicationId]}"


def _tables(spark: SparkSession) -> str:
    return f"{folder(spark)}/axonlake-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete the tables that this application has saved; what still reads them can't be computed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: computed once, whatever reads it, and safe from lost executors."""
    path = f"{_tables(df.sparkSession)}/{uuid.uuid4().hex}/{name}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
