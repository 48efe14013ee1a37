"""Places in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session on one machine (as
    in tests) gets a folder of its own, and one on a cluster an error: executors don't see the driver's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def _found(spark: SparkSession, path: str):
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(sc._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for what this session writes; whatever is there when the driver ends goes then, since
    tables that the session has returned may read it until then."""
    path, fs = _found(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    fs.deleteOnExit(path)
    return str(path)


def remove(spark: SparkSession, path: str) -> None:
    found, fs = _found(spark, path)
    fs.delete(found, True)


def settled(df: DataFrame, name: str = "rows") -> DataFrame:
    """df as a table in the shared folder: computed once, however often it is read, and its plan ends there. A lost executor
    costs the read of its files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
