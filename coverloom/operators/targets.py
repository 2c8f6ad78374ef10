"""Target ids and their weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions.index import numbered
from coverloom.scratch import small


def chosen(unbinned: DataFrame, samples: DataFrame | list[str] | None = None, taxa: str | None = None) -> DataFrame:
    """Rows of the taxa (a regular expression of alternations and literals) and samples of interest; None: all."""
    out = unbinned.where(F.col("taxonomy").rlike(taxa)) if taxa else unbinned
    if samples is None:
        return out
    if isinstance(samples, DataFrame):
        return out.join(samples.select("sample").distinct(), "sample", "left_semi")
    return out.where(F.col("sample").isin(*samples))


def dense(unbinned: DataFrame, samples=None, taxa: str | None = None, row_index: str | None = None) -> DataFrame:
    """With target: distinct (gene, sequence) counted from 0 in order of first appearance by row_index, or in their own order."""
    rows = chosen(unbinned, samples, taxa)
    order = F.min(row_index) if row_index else F.lit(0)
    keys = rows.groupBy("gene", "sequence").agg(order.alias("_o"))
    ids = numbered(keys, "target", "_o", "gene", "sequence").drop("_o")
    out = rows.join(ids, ["gene", "sequence"])
    return out.drop(row_index) if row_index else out


def hashed(unbinned: DataFrame, samples=None, taxa: str | None = None) -> DataFrame:
    """With target: a non-negative 63-bit hash of (gene, sequence); no pass over the keys is needed."""
    return chosen(unbinned, samples, taxa).withColumn("target", F.xxhash64("gene", "sequence").bitwiseAND(F.lit((1 << 63) - 1)))


def abundance_weights(unbinned: DataFrame, binned: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """(gene, sequence, weight): mean over the samples that have the gene of the sequence's share of the gene's coverage.

    A sample without the sequence adds nothing to the sum and one to the count, so rows that are seen meet their sample's total, and
    the count of samples is one number for each gene. A sequence that stands in a sample more than once counts once more for each row.
    """
    cols = ["gene", "sample", "sequence", "coverage"]
    totals = binned.select(*cols).unionByName(unbinned.select(*cols))
    if samples:
        totals = totals.where(F.col("sample").isin(*samples))
    totals = totals.groupBy("sample", "gene").agg(F.sum("coverage").alias("total")).where("total is not null")
    have = totals.groupBy("gene").agg(F.count("total").alias("have"))  # reads the totals, so that both take one shuffle
    seen = unbinned.where("sequence is not null").groupBy("sample", "gene", "sequence").agg(F.sum("coverage").alias("c"), (F.count(F.lit(1)) - 1).alias("again"))
    share = seen.join(totals, ["sample", "gene"]).groupBy("gene", "sequence").agg(F.sum(F.col("c") / F.col("total")).alias("share"), F.sum("again").alias("again"))
    return share.join(have, "gene").select("gene", "sequence", (F.col("share") / (F.col("have") + F.col("again"))).alias("weight")).where("weight > 0")


def target_weights(targets: DataFrame, weights: DataFrame) -> DataFrame:
    """(target, weight)."""
    return targets.select("gene", "sequence", "target").distinct().join(weights, ["gene", "sequence"]).select("target", "weight")


def sample_filter(names: list[str], spark) -> DataFrame:
    """A list of samples as a table, broadcast if it is small."""
    return small(spark.createDataFrame([(n,) for n in names], "sample string"))
