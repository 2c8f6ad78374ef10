"""Edges: sample sets that share targets with enough coverage together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.text import id_list, sample_key
from coverloom.operators import blocks
from coverloom.scratch import cut

EDGE = ["style", "cluster_size", "samples", "target_ids"]


def _ids(distinct: bool = False) -> Column:
    """The sorted array of targets; its order is that of the ids as strings."""
    x = F.collect_set("target") if distinct else F.collect_list("target")
    return F.array_sort(x)


def pairs(targets: DataFrame, min_coverage: float = 10, hot: int = blocks.HOT, block: int = blocks.BLOCK) -> DataFrame:
    """`match` edges: unordered sample pairs whose coverages of a target sum to over min_coverage. An equi-join on the target with the order of samples as residual, never a nested loop; rows that don't reach the minimum even with their target's largest coverage stay out of it. Targets of over `hot` rows are joined by pairs of blocks."""
    t = cut(targets.select("target", "sample", "coverage"), "targets")  # read again and again
    most = t.groupBy("target").agg(F.max("coverage").alias("most"), F.min("sample").alias("x"), F.max("sample").alias("y")).where("x <> y").select("target", "most")
    near = t.join(most, "target").where(F.col("coverage") + F.col("most") > min_coverage).drop("most")
    few, many = blocks.split(near, t, hot)
    a, b = few.alias("a"), few.alias("b")
    both = a.join(b, F.col("a.target") == F.col("b.target")).where("a.sample < b.sample").where(F.col("a.coverage") + F.col("b.coverage") > min_coverage)
    both = both.select("a.target", F.col("a.sample").alias("s1"), F.col("b.sample").alias("s2"))
    if many is not None:
        both = both.unionByName(blocks.match(many, min_coverage, block))
    got = both.groupBy("s1", "s2").agg(_ids().alias("target_ids"))
    return got.select(F.lit("match").alias("style"), F.lit(2).alias("cluster_size"), F.array("s1", "s2").alias("samples"), "target_ids")


def pools(targets: DataFrame, min_coverage: float = 10, largest: int = 3) -> DataFrame:
    """`pool` edges for N = 3 to largest: all samples with coverage over min_coverage / N of a target, if N or more. Combinations are not enumerated."""
    sizes = F.explode(F.sequence(F.lit(3), F.lit(largest)))
    rows = targets.select("target", "sample", "coverage", sizes.alias("cluster_size")).where(F.col("coverage") > F.lit(float(min_coverage)) / F.col("cluster_size"))
    per = rows.groupBy("target", "cluster_size").agg(F.array_sort(F.collect_list("sample")).alias("samples")).where(F.size("samples") >= F.col("cluster_size"))
    return per.groupBy("cluster_size", "samples").agg(_ids().alias("target_ids")).select(F.lit("pool").alias("style"), "cluster_size", "samples", "target_ids")


def multi(targets: DataFrame, min_coverage: float = 10, largest: int = 2) -> DataFrame:
    out = pairs(targets, min_coverage)
    return out.unionByName(pools(targets, min_coverage, largest)) if largest > 2 else out


def _directional(shared: DataFrame) -> DataFrame:
    got = shared.groupBy("source", "dest").agg(_ids(True).alias("target_ids"))
    return got.select(F.lit("directional").alias("style"), F.lit(2).alias("cluster_size"), F.array("source", "dest").alias("samples"), "target_ids")


def _singleton(own: DataFrame) -> DataFrame:
    got = own.groupBy("source").agg(_ids(True).alias("target_ids"))
    return got.select(F.lit("singleton").alias("style"), F.lit(1).alias("cluster_size"), F.array("source").alias("samples"), "target_ids")


def single(targets: DataFrame, min_coverage: float = 10, hot: int = blocks.HOT, block: int = blocks.BLOCK) -> DataFrame:
    """One-sample mode: `directional` edges from covered sources to samples with the same target, `singleton` edges of targets seen in one sample. Targets of over `hot` rows are joined by pairs of blocks."""
    source = targets.where(F.col("coverage") > min_coverage).select(F.col("sample").alias("source"), "target").distinct()
    dest = targets.select(F.col("sample").alias("dest"), "target").distinct()
    lone = dest.groupBy("target").agg(F.countDistinct("dest").alias("n")).where("n = 1").select("target")
    few, many = blocks.split(targets.select("target", "sample", "coverage"), targets, hot)
    if many is None:
        shared = source.join(dest, "target").where("source <> dest")
    else:
        covered = few.where(F.col("coverage") > min_coverage).select("target", F.col("sample").alias("source")).distinct()
        shared = covered.join(few.select("target", F.col("sample").alias("dest")).distinct(), "target").where("source <> dest")
        shared = shared.unionByName(blocks.directed(many, min_coverage, block))
    return _directional(shared).unionByName(_singleton(source.join(lone, "target", "left_semi")))


def preclustered(preclusters: DataFrame, targets: DataFrame, min_coverage: float = 10) -> DataFrame:
    """`match` edges of given sample sets: targets that every member has, with over min_coverage together."""
    sets = preclusters.select("samples").distinct().withColumn("cluster_size", F.size("samples"))
    rows = sets.select("samples", "cluster_size", F.explode("samples").alias("sample")).join(targets.select("sample", "target", "coverage"), "sample")
    per = rows.groupBy("samples", "cluster_size", "target").agg(F.sum("coverage").alias("c"), F.count(F.lit(1)).alias("n"))
    per = per.where((F.col("n") == F.col("cluster_size")) & (F.col("c") > min_coverage))
    return per.groupBy("samples", "cluster_size").agg(_ids().alias("target_ids")).select(F.lit("match").alias("style"), "cluster_size", "samples", "target_ids")


def preclustered_single(preclusters: DataFrame, targets: DataFrame, samples: DataFrame | None = None, min_coverage: float = 10) -> DataFrame:
    """One-sample mode within given pairs. Singletons are the covered targets that no neighbour shares."""
    pair = preclusters.select(F.get("samples", F.lit(0)).alias("source"), F.get("samples", F.lit(1)).alias("dest"))
    both = pair.unionByName(pair.select(F.col("dest").alias("source"), F.col("source").alias("dest")))
    source = targets.where(F.col("coverage") > min_coverage).select(F.col("sample").alias("source"), "target").distinct()
    if samples is not None:
        source = source.join(samples.select(F.col("sample").alias("source")).distinct(), "source", "left_semi")
    shared = both.join(source, "source").join(targets.select(F.col("sample").alias("dest"), "target"), ["dest", "target"])
    own = source.join(shared.select("source", "target"), ["source", "target"], "left_anti")
    return _directional(shared).unionByName(_singleton(own))


def to_text(edges: DataFrame) -> DataFrame:
    """Edges with comma lists for samples and target ids; directional edges keep their order, others are sorted."""
    samples = F.when(F.col("style") == "directional", F.array_join("samples", ",")).otherwise(sample_key(F.col("samples")))
    return edges.select("style", F.col("cluster_size").cast("int").alias("cluster_size"), samples.alias("samples"), id_list(F.col("target_ids")).alias("target_ids"))


def from_text(edges: DataFrame) -> DataFrame:
    return edges.select("style", F.col("cluster_size").cast("int").alias("cluster_size"), F.split("samples", ",").alias("samples"), F.split("target_ids", ",").cast("array<bigint>").alias("target_ids"))


def unused_samples(samples: DataFrame, edges: DataFrame) -> DataFrame:
    """Samples that no edge has."""
    used = edges.select(F.explode("samples").alias("sample")).distinct()
    return samples.select("sample").distinct().join(used, "sample", "left_anti")
