"""Reference genomes of each sample, and bins by quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reference_bins(binned: DataFrame, unbinned: DataFrame, min_appraised: float = 0.1, trim: float = 0.1) -> DataFrame:
    """(sample, genome): genomes whose mean coverage over the sample's genes, a share `trim` cut off at either end, is over 0; none for samples with less than min_appraised of their hits binned.

    Genes where a genome is missing count 0. They are counted, not made: of n sorted values the first n - k are zeros.
    """
    hits = lambda t, name: t.groupBy("sample").agg(F.sum("num_hits").alias(name))
    share = hits(binned, "b").join(hits(unbinned, "u"), "sample", "full").fillna(0, ["b", "u"])
    enough = share.where((F.col("b") + F.col("u") > 0) & (F.col("b") >= min_appraised * (F.col("b") + F.col("u")))).select("sample")
    each = binned.join(enough, "sample", "left_semi").select("sample", "gene", F.explode(F.transform(F.split("found_in", ","), lambda g: F.regexp_replace(g, "_protein$", ""))).alias("genome"), "coverage")
    cover = each.groupBy("sample", "gene", "genome").agg(F.sum("coverage").alias("coverage"))
    genes = cover.groupBy("sample").agg(F.countDistinct("gene").alias("n"))
    lists = cover.groupBy("sample", "genome").agg(F.array_sort(F.collect_list("coverage")).alias("c")).join(genes, "sample")
    full = F.concat(F.array_repeat(F.lit(0.0), F.col("n").cast("int") - F.size("c")), F.col("c"))
    cut = F.floor(F.col("n") * trim).cast("int")
    kept = F.slice(full, cut + 1, F.greatest(F.col("n").cast("int") - 2 * cut, F.lit(0)))
    mean = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(kept), F.lit(0))
    return lists.select("sample", "genome", mean.alias("mean")).where("mean > 0").select("sample", "genome")


def good_bins(bins: DataFrame, min_completeness: float = 70, max_contamination: float = 10) -> DataFrame:
    """Bins of enough quality; the numbers may be text, and what is no number fails."""
    number = lambda c: F.col(c).cast("string").try_cast("double")
    return bins.where((number("Completeness") >= min_completeness) & (number("Contamination") <= max_contamination))


def recovered_bins(infos: DataFrame, root: str, dest: str, prefix: str = "recovered", iteration: str | None = None) -> DataFrame:
    """infos: (coassembly, index from 0, Name). Adds binner, bin_source, new_name and bin_dest."""
    first = f"{prefix}_it{iteration}_" if iteration else f"{prefix}_"
    name = F.concat(F.lit(first), "coassembly", F.lit("."), (F.col("index") + 1).cast("string"))
    binner = F.regexp_extract("Name", r"^([^_.]+)_", 1)
    source = F.concat(F.lit(f"{root}/"), "coassembly", F.lit("/recover/bins/final_bins/"), "Name", F.lit(".fna"))
    out = infos.select("coassembly", "Name", F.when(binner != "", binner).alias("binner"), source.alias("bin_source"), name.alias("new_name"))
    return out.withColumn("bin_dest", F.concat(F.lit(f"{dest}/bins/"), "new_name", F.lit(".fna")))


def prefixed_fasta(lines: DataFrame) -> DataFrame:
    """lines: (bin, value). Header lines get the bin's name in front."""
    return lines.withColumn("value", F.when(F.col("value").startswith(">"), F.concat(F.lit(">"), "bin", F.lit("~"), F.substring("value", 2, 1_000_000_000))).otherwise(F.col("value")))


def reconcile_assemblies(samples: DataFrame, prior: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing, extra): samples without a prior assembly, and assemblies without a sample."""
    both = samples.select(F.col("sample").alias("name"), F.lit(True).alias("has")).join(prior.select("name", "assembly"), "name", "full")
    return both.where("assembly is null").select("name"), both.where("has is null").select("name")


def representatives(clusters: DataFrame) -> int:
    """Runs of equal consecutive representatives; clusters: (i, representative)."""
    return uniq_runs(clusters).first()["clusters"]


def uniq_runs(rows: DataFrame) -> DataFrame:
    """One row (clusters): how many rows differ from the one before; rows: (i, representative), i counting on without gaps. A self-join on the place takes the part of a global window."""
    before = rows.select((F.col("i") + 1).alias("i"), F.col("representative").alias("before"), F.lit(True).alias("some"))
    changed = rows.join(before, "i", "left").where(F.col("some").isNull() | ~F.col("representative").eqNullSafe(F.col("before")))
    return changed.agg(F.count(F.lit(1)).alias("clusters"))
