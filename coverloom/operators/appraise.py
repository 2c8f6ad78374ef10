"""Known or novel: splitting observations into binned and unbinned ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["gene", "sample", "sequence"]
OTU = [*KEY, "num_hits", "coverage", "taxonomy"]
#: Fixed value: the marker left out of genome-free runs.
BAD_MARKER = "S3.18.EIF_2_alpha"


def by_query(query: DataFrame, otu: DataFrame, identity: float = 0.86, window: int = 60) -> tuple[DataFrame, DataFrame]:
    """(binned, unbinned). A sequence is binned if a genome's is at most (1 - identity) * window away; an empty query leaves both empty."""
    near = query.select(F.col("marker").alias("gene"), F.col("query_name").alias("sample"), F.col("query_sequence").alias("sequence"), "divergence", F.col("sample").alias("found_in"))
    listed = F.array_join(F.array_sort(F.collect_list("found_in")), ",")
    appraised = near.join(otu.select(*OTU), KEY).groupBy(*OTU, "divergence").agg(listed.alias("found_in"))
    appraised = appraised.withColumn("binned", F.col("divergence") <= (1 - identity) * window)
    binned = appraised.where("binned").select(*OTU, "found_in")
    if query.isEmpty():
        return binned, otu.select(*OTU, F.lit(None).cast("string").alias("found_in")).where(F.lit(False))
    left = otu.select(*OTU).join(appraised.select(*OTU, "binned"), OTU, "left")
    return binned, left.where(~F.coalesce("binned", F.lit(False))).select(*OTU, F.lit(None).cast("string").alias("found_in"))


def by_query_per_sample(query: DataFrame, otu: DataFrame, identity: float = 0.86, window: int = 60) -> tuple[DataFrame, DataFrame]:
    """As by_query over many samples' tables at once: the rule for an empty query holds for each sample."""
    some = otu.join(query.select(F.col("query_name").alias("sample")).distinct(), "sample", "left_semi")
    return by_query(query, some, identity, window)


def no_genomes(otu: DataFrame, bad_marker: str = BAD_MARKER) -> tuple[DataFrame, DataFrame]:
    """Without genomes all is unbinned, and binned is an empty table of the same columns."""
    unbinned = otu.withColumn("found_in", F.lit("")).where(F.col("gene") != bad_marker)
    return unbinned.where(F.lit(False)), unbinned


def drop_marker(table: DataFrame, bad_marker: str = BAD_MARKER) -> DataFrame:
    """Rows whose tab-joined line doesn't hold the marker anywhere."""
    return table.where(~F.concat_ws("\t", *table.columns).contains(bad_marker))


def update(binned: DataFrame, newly_binned: DataFrame) -> DataFrame:
    """The earlier binned rows and those that new genomes have taken from the unbinned."""
    return binned.unionByName(newly_binned)


def combine(*tables: DataFrame) -> DataFrame:
    """UNION ALL of tables with one schema."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def rename_samples(otu: DataFrame) -> DataFrame:
    """Samples by the last part of their path."""
    return otu.withColumn("sample", F.element_at(F.split("sample", "/"), -1))
