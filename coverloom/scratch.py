"""Cut points: tables written in the folder that spark.checkpoint.dir names, which all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of cut points. Where spark.checkpoint.dir is unset, a temporary one if all runs on this machine; on a cluster that raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="coverloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one; it goes when the driver ends."""
    name = f"{shared_dir(spark)}/plan/{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)  # only what is there can be marked
    return name


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write df and read it back: the plan starts anew and a lost executor loses nothing."""
    path = f"{folder(df.sparkSession)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows (counted), else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
