"""Sharding: size-tiered compaction of immutable shards under a versioned manifest.

Arrivals are written once, as small shards: each writing task turns what it has read into files of about `small_bytes` bytes
of text, by the mean size of the arrivals' rows. A shard's tier is how often its size can be multiplied by `fanout` before
it reaches the target; shards of one tier are similar in size and are packed into runs of about the target size, and a run
of two shards or more is merged into one file by one task. A lone shard stays as it is.

The manifest lists the live files of a version with their tiers and rows. It is one file that is written as a draft and then
published under its version's name by an operation that fails if the name is taken: a hard link on a local file system, a
rename without overwriting elsewhere (which HDFS does at once; an object store needs a file system that does so, too). Of two
writers of one version exactly one wins. The other one's append is committed on top of the newer version; its compaction is,
too, if all shards that it has merged are still live, and else raises Conflict, with the data as the newer version has it.
Readers of older versions keep their files.

Defined cases: an empty table gives a manifest without files; nulls in any column and extra columns of any name are stored as
they are; repeated rows are all stored; a row of any size is stored whole.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from coverloom.llm.util import bounded

TARGET_BYTES, FANOUT, SMALL_BYTES = 128 << 20, 4, 4 << 20
#: Rows of a plan (one for each shard) that may be broadcast.
PLAN_ROWS = 20_000
MANIFEST = "file string, bytes long, rows long, tier int, version long"


class Conflict(RuntimeError):
    """Another writer has committed the version."""


def free_name(taken, wish: str) -> str:
    """A column name like `wish` that no name in `taken` equals in any case."""
    lower = {x.lower() for x in taken}
    while wish.lower() in lower:
        wish += "_"
    return wish


class Store:
    """Shards of one table under a root folder; all data goes through Spark's readers and writers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.conf)

    def _names(self, folder: str) -> list[str]:
        fs, at = self._fs(), self._path(folder)
        return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []

    def version(self) -> int:
        """The newest committed version, 0 if none."""
        return max([0, *(int(x[1:9]) for x in self._names("manifest") if x.startswith("v"))])

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/v{version:08d}.parquet")

    def publish(self, draft: str, version: int) -> None:
        """Give the draft its version's name, or raise Conflict if that is taken, even if it is taken just now."""
        self._fs().mkdirs(self._path("manifest"))
        old, new = self._path(draft), self._path(f"manifest/v{version:08d}.parquet")
        if self._fs().getUri().getScheme() == "file":
            try:
                os.link(unquote(urlparse(old.toUri().toString()).path), unquote(urlparse(new.toUri().toString()).path))
            except FileExistsError:
                raise Conflict(f"version {version} is there already") from None
            return
        hadoop = self.jvm.org.apache.hadoop.fs
        plain = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:
            hadoop.FileContext.getFileContext(new.toUri(), self.conf).rename(old, new, plain)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise Conflict(f"version {version} is there already") from None
            raise

    def draft(self, files: DataFrame, version: int) -> str:
        """Write the manifest of a version without committing it; its place."""
        folder = f"drafts/{uuid.uuid4().hex}"
        files.withColumn("version", F.lit(version).cast("long")).select("file", "bytes", "rows", "tier", "version").coalesce(1).write.parquet(f"{self.root}/{folder}")
        parts = [x for x in self._names(folder) if x.endswith(".parquet") and not x.startswith((".", "_"))]
        assert len(parts) == 1, "one task writes one file"
        return f"{folder}/{parts[0]}"

    def commit(self, files: DataFrame, base: int) -> int:
        """Write and publish the version after base."""
        self.publish(self.draft(files, base + 1), base + 1)
        return base + 1

    def _sized(self, folder: str, target: int, fanout: int, schema) -> DataFrame:
        """Files of a folder with bytes, rows and tier, by their footers and metadata columns alone."""
        rows = self.spark.read.schema(T.StructType([])).parquet(f"{self.root}/{folder}")
        meta = rows.metadataColumn("_metadata")
        sized = rows.select(meta["file_path"].alias("file"), meta["file_size"].alias("bytes")).groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))
        tier = F.greatest(F.lit(0), F.floor(F.log(F.lit(target) / F.greatest(F.col("bytes"), F.lit(1))) / F.log(F.lit(float(fanout)))))
        return sized.withColumn("tier", tier.cast("int"))

    def append(self, arrivals: DataFrame, small_bytes: int = SMALL_BYTES, target: int = TARGET_BYTES, fanout: int = FANOUT) -> int:
        """Store arrivals as small shards and commit a version with them, after any that others have committed meanwhile."""
        folder = f"data/{uuid.uuid4().hex}"
        texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in arrivals.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        size = sum(texts, F.lit(8 * len(arrivals.columns))).cast("long")
        mean = arrivals.agg(F.avg(size)).first()[0]
        rows = max(1, int(small_bytes / mean)) if mean else 1
        arrivals.write.option("maxRecordsPerFile", rows).option("compression", "zstd").parquet(f"{self.root}/{folder}")
        sized = self._sized(folder, target, fanout, arrivals.schema)
        while True:
            base = self.version()
            try:
                return self.commit(self.manifest(base).drop("version").unionByName(sized), base)
            except Conflict:
                continue

    def plan(self, files: DataFrame, target: int = TARGET_BYTES, fanout: int = FANOUT) -> DataFrame:
        """file -> run (from 0 on) for the shards to merge. Each tier is packed in file order, in slices of some thousand shards, so that no task sees all shards; the runs alone are numbered in one."""
        slices = max(1, files.count() // 10_000)
        w = W.partitionBy("tier", "_slice").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
        packed = files.where("tier > 0").withColumn("_slice", F.pmod(F.xxhash64("file"), F.lit(slices)))
        packed = packed.withColumn("_n", F.floor(F.coalesce(F.sum("bytes").over(w), F.lit(0)) / target))
        named = packed.select("file", F.concat_ws("-", "tier", "_slice", "_n").alias("_name"), F.count(F.lit(1)).over(W.partitionBy("tier", "_slice", "_n")).alias("_k")).where("_k > 1")
        runs = named.select("_name").distinct().select("_name", (F.row_number().over(W.orderBy("_name")) - 1).alias("run"))
        return named.join(runs, "_name").select("file", "run")

    def compact(self, schema, target: int = TARGET_BYTES, fanout: int = FANOUT) -> int:
        """Merge runs of similar shards into files of about the target size and commit the version without the merged shards. Returns the version in force."""
        base = self.version()
        planned = self.plan(self.manifest(base), target, fanout).collect()  # one row for each shard, as the reader needs their paths
        if not planned:
            return base
        folder, runs = f"data/{uuid.uuid4().hex}", 1 + max(r["run"] for r in planned)
        plan = self.spark.createDataFrame(planned, "file string, run int")
        rows = self._rows([r["file"] for r in planned], schema)
        mine, own = rows.columns[-1], rows.columns[:-1]
        file, run = free_name(rows.columns, "file"), free_name([*rows.columns, "file"], "run")
        merged = rows.join(bounded(plan.toDF(file, run), PLAN_ROWS), F.col(f"`{mine}`.file") == F.col(file))
        merged.repartitionById(runs, F.col(run)).select(*[F.col(f"`{c}`") for c in own]).write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        sized = self._sized(folder, target, fanout, schema)
        while True:
            files = self.manifest(base).drop("version")
            if files.join(plan, "file", "left_semi").count() < len(planned):
                raise Conflict("another writer has merged the same shards")
            try:
                return self.commit(files.join(plan, "file", "left_anti").unionByName(sized), base)
            except Conflict:
                base = self.version()

    def _rows(self, paths: list[str], schema) -> DataFrame:
        """The rows of the files at `paths`, and as the last column their file (struct of file and size)."""
        mine = free_name(schema.names, "shard")
        columns = [F.col(f"`{c}`") for c in schema.names]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField(mine, T.StructType.fromDDL("file string, bytes long"))]))
        rows = self.spark.read.schema(schema).parquet(*paths)
        meta = rows.metadataColumn("_metadata")
        return rows.select(*columns, F.struct(meta["file_path"].alias("file"), meta["file_size"].alias("bytes")).alias(mine))

    def read(self, schema, version: int | None = None, with_file: bool = False) -> DataFrame:
        """Rows of a version, of whose files alone the reader is told; with_file: also a last column, `shard` unless that is taken, with the row's file and its bytes."""
        rows = self._rows([r["file"] for r in self.manifest(version).select("file").collect()], schema)  # one row for each live file
        return rows if with_file else rows.drop(rows.columns[-1])
