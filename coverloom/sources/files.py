"""Readers and writers of the text formats, always with explicit schemas. Paths go to Spark's readers, so any store works."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from coverloom import schemas
from coverloom.scratch import cut, small


def tsv(spark: SparkSession, path: str | list[str], schema: str, header: bool = True, sep: str = "\t") -> DataFrame:
    """One or many files (lists, folders and globs work), each with its own header."""
    return spark.read.schema(schema).option("sep", sep).option("header", str(header).lower()).option("enforceSchema", "true").csv(path)


def otu_tables(spark: SparkSession, path) -> DataFrame:
    return tsv(spark, path, schemas.OTU)


def appraised(spark: SparkSession, path) -> DataFrame:
    return tsv(spark, path, schemas.APPRAISED)


def query_hits(spark: SparkSession, path) -> DataFrame:
    return tsv(spark, path, schemas.QUERY_HITS)


def distances(spark: SparkSession, path) -> DataFrame:
    """Given pairwise distances, with commas."""
    return tsv(spark, path, schemas.DISTANCES, sep=",").select("query_name", "match_name", "jaccard")


def read_size(spark: SparkSession, path) -> DataFrame:
    """Without a header, with commas."""
    return tsv(spark, path, schemas.READ_SIZE, header=False, sep=",")


def edges(spark: SparkSession, path) -> DataFrame:
    from coverloom.operators.edges import from_text

    return from_text(tsv(spark, path, schemas.EDGES_TEXT))


def clusters(spark: SparkSession, path) -> DataFrame:
    return tsv(spark, path, schemas.CLUSTERS)


def name_list(spark: SparkSession, path) -> list[str]:
    """One value a line; a list without any is an error. For lists of samples that a user types, not for data."""
    out = [r["value"].strip() for r in spark.read.text(path).where(F.trim("value") != "").collect()]
    if not out:
        raise ValueError(f"no values in {path}")
    return out


def _lines_of(spark: SparkSession, paths: dict[str, str], name: str) -> DataFrame:
    """Lines of all files in one scan: (the file's name in `paths`, value, start of the split, a number that counts on within a split)."""
    if not paths:
        return schemas.empty(spark, f"{name} string, value string, block bigint, at bigint")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = {}
    for key, path in paths.items():
        p = jvm.org.apache.hadoop.fs.Path(path)
        where[p.getFileSystem(conf).makeQualified(p).toUri().getPath()] = key
    if len(where) < len(paths):
        raise ValueError("a file is given twice")
    names = small(spark.createDataFrame([(k, v) for k, v in where.items()], f"_path string, {name} string"))
    rows = spark.read.text(list(paths.values()))
    meta = rows.metadataColumn("_metadata")
    rows = rows.select("value", meta["file_path"].alias("_file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"))
    # the path behind scheme and host, with its escapes undone; a plus sign is no space here
    path = F.url_decode(F.replace(F.regexp_replace("_file", "^[A-Za-z0-9+.-]+:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    return rows.withColumn("_path", path).join(names, "_path").select(name, "value", "block", "at")


def numbered_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(sample, line_no from 1, value) of text or gzip files, one for each sample, in one scan. A line's number is its place in its split and the lines of the file's splits before it; one row for each split is gathered."""
    rows = _lines_of(spark, paths, "sample")
    splits = cut(rows.groupBy("sample", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "splits")
    before = F.coalesce(F.sum("n").over(W.partitionBy("sample").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(small(splits.withColumn("before", before).drop("n")), ["sample", "block"])
    return placed.select("sample", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "value")


def fasta(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(bin, value): lines of FASTA files under their bins' names."""
    return _lines_of(spark, paths, "bin").select("bin", "value")


#: Where a run's assembly and its recovered bins lie in the folder of a coassembly.
RESULTS = {"assembled": "assemble/assembly/final_contigs.fasta", "recovered": "recover/bins/bin_info.tsv"}


def runs(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(dir, coassembly, assembled, recovered) of finished and unfinished runs: each coassembly of a run folder's clusters, and whether its results are there, be they files, empty ones or folders of files.

    Folders of a local or mounted file system, which executors reach as they reach the clusters in it, are looked into by the tasks that
    read the clusters: no name reaches the driver. In other stores the results of a folder are listed with one pattern each on the
    driver, at most two names for each coassembly of a plan. No file is opened. Spark's file sources wouldn't do, as they pass
    over empty files. A file of a coassembly that the clusters don't have is left out. A folder without its clusters is an error,
    one that is given twice too. What is there is looked up once, at the call.
    """
    if not folders:
        raise ValueError("no folder of a run")
    seen = [_qualified(spark, x)[1] for x in folders]
    if len(set(seen)) < len(seen):
        raise ValueError("a folder is given twice")
    planned = {x: clusters(spark, f"{x.rstrip('/')}/coassemble/target/elusive_clusters.tsv").select(F.lit(x).alias("dir"), "coassembly") for x in folders}
    local = [_looked_up(own, at) for x, own in planned.items() if (at := _mounted(spark, x))]
    listed = {x: own for x, own in planned.items() if not _mounted(spark, x)}
    return cut(reduce(DataFrame.unionByName, local + ([_listed(spark, listed)] if listed else [])), "runs")


def _qualified(spark: SparkSession, path: str):
    """The path's store, and the whole path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p).toString()


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path for Python, if its store is a local or mounted file system."""
    fs, whole = _qualified(spark, path)
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(whole).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _looked_up(planned: DataFrame, root: str) -> DataFrame:
    """planned with its results in the run folder `root`, looked up by tasks."""
    results = dict(RESULTS)

    def look(batches):
        from os.path import exists

        for rows in batches:
            named = [x if isinstance(x, str) and x not in ("", ".", "..") and "/" not in x else None for x in rows["coassembly"]]
            for what, name in results.items():
                rows[what] = [x is not None and exists(f"{root}/coassemble/coassemble/{x}/{name}") for x in named]
            yield rows

    return planned.mapInPandas(look, "dir string, coassembly string, assembled boolean, recovered boolean")


def _listed(spark: SparkSession, planned: dict[str, DataFrame]) -> DataFrame:
    """The clusters of each folder with their results, listed on the driver."""
    hadoop, there = spark.sparkContext._jvm.org.apache.hadoop.fs, []
    for folder in planned:
        fs, _ = _qualified(spark, folder)
        literal = re.sub(r"([\\{}\[\]*?])", r"\\\1", folder.rstrip("/"))
        for what, name in RESULTS.items():
            for found in fs.globStatus(hadoop.Path(f"{literal}/coassemble/coassemble/*/{name}")) or []:
                own = found.getPath()
                for _ in name.split("/"):
                    own = own.getParent()
                there.append((folder, own.getName(), what))
    flags = spark.createDataFrame(there, "dir string, coassembly string, what string")
    flags = flags.groupBy("dir", "coassembly").agg(*[F.bool_or(F.col("what") == x).alias(x) for x in RESULTS])
    return reduce(DataFrame.unionByName, planned.values()).join(flags, ["dir", "coassembly"], "left").fillna(False, list(RESULTS))


def empty_files(names: DataFrame, root: str) -> None:
    """Make an empty file for each `name` (a path below root) and its folders: by tasks in a local or mounted file system, else one by one."""
    spark = names.sparkSession
    at = _mounted(spark, root)
    if at is None:
        fs, whole = _qualified(spark, root)
        for r in names.toLocalIterator():
            fs.createNewFile(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{whole}/{r['name']}"))
        return

    def make(rows):
        import os

        for r in rows:
            path = f"{at}/{r['name']}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            open(path, "ab").close()

    names.select("name").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).foreachPartition(make)


def write_lines(df: DataFrame, path: str, name: str, *order) -> dict[str, str]:
    """Write the column value as one text file for each value of the column `name`, lines in the given order; name -> file."""
    df.repartition(name).sortWithinPartitions(name, *order).select(name, "value").write.partitionBy(name).text(path)
    spark = df.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs, found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), {}
    for part in fs.listStatus(root):
        key, eq, value = part.getPath().getName().partition("=")
        if eq and key == name:
            found |= {value: x.getPath().toString() for x in fs.listStatus(part.getPath()) if x.getPath().getName().startswith("part-")}
    return found


def write_tsv(df: DataFrame, path: str, header: bool = True, sep: str = "\t", one_file: bool = False) -> None:
    """A folder of text files, one if asked for (small results)."""
    flat = df.select(*[F.array_join(c.name, ",").alias(c.name) if isinstance(c.dataType, T.ArrayType) else F.col(f"`{c.name}`") for c in df.schema])
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").option("sep", sep).option("header", str(header).lower()).option("emptyValue", "").csv(path)


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).parquet(path)


def hashed_folder(sample: str, depth: int = 2, chars: int = 2) -> str:
    """Sub-folders for very many samples: the name's first letters in groups."""
    return "/".join([*(sample[i * chars : (i + 1) * chars] for i in range(depth) if sample[i * chars : (i + 1) * chars]), sample])
