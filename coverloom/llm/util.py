"""Shared helpers: tables, scratch tables in the cluster's shared folder, size-checked broadcasts, code shipping."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lists of the scratch paths that are made while `collecting` is active, the innermost last.
_collected: list[list[str]] = []


def ship(name: str) -> None:
    """Pickle the functions of module `name` by value, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary one if all runs on this machine; on a cluster that raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="coverloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver ends, or before by `delete`."""
    folder = f"{shared_dir(spark)}/coverloom/{uuid.uuid4().hex}"
    path, fs = _path(spark, folder)
    fs.mkdirs(path)
    fs.deleteOnExit(path)  # only what is there can be marked
    for made in _collected[-1:]:
        made.append(folder)
    return f"{folder}/{label}"


@contextmanager
def collecting():
    """The folders of the scratch paths that are made within, as a list."""
    _collected.append([])
    try:
        yield _collected[-1]
    finally:
        _collected.pop()


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that no later step reads."""
    for t in tables:
        delete(t.sparkSession, [t._scratch.rpartition("/")[0]])


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more; it waits for the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, names: list[str]) -> None:
    """Delete these folders of scratch paths. Only for callers whose results that read them have been written elsewhere."""
    for name in names:
        path, fs = _path(spark, name)
        fs.delete(path, True)


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def bounded(df: DataFrame, limit: int) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows (counted), else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def arrow_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Bound the bytes of an Arrow batch sent to Python workers, however long the texts are. The session's setting is only ever lowered."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > size:
        spark.conf.set(key, str(size))


def let(value: Column, body) -> Column:
    """body(value), with value computed once: bound to a lambda variable, so that no optimizer rule copies it into inner lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ship(__name__)
