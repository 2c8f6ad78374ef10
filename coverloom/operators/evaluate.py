"""How many targets were recovered: matched and novel hits, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.functions.text import strip_both, strip_mate
from coverloom.scratch import cut

NONE = "None"
HIT = ["coassembly", "gene", "sequence", "genome", "target", "found_in", "source_samples", "source_num_hits", "source_coverage", "taxonomy"]


def split_name(df: DataFrame, column: str = "sample") -> DataFrame:
    """With coassembly and genome: the first two parts of a name parted by -, or a compiled name's part before the last dot and the number behind it."""
    bits = F.split(column, "-")
    compiled = F.col(column).rlike(r"^[^-]*coassembly_\d+\.\d+$")
    name = F.when(compiled, F.regexp_extract(column, r"(coassembly_\d+)\.\d+$", 1)).otherwise(F.get(bits, F.lit(0)))
    genome = F.when(compiled, F.regexp_extract(column, r"\.(\d+)$", 1)).otherwise(F.get(bits, F.lit(1)))
    return df.withColumns({"coassembly": name, "genome": genome})


def _named(df: DataFrame, sample: str, known: DataFrame) -> DataFrame:
    """df with `sample` kept where it is an assembled sample, else without a mate mark."""
    k = known.select(F.col("samples").alias("_k")).distinct()
    return df.join(k, F.col(sample) == F.col("_k"), "left").withColumn(sample, F.when(F.col("_k").isNotNull(), F.col(sample)).otherwise(strip_mate(F.col(sample)))).drop("_k")


def haystack(targets: DataFrame, binned: DataFrame, clusters: DataFrame, edges: DataFrame, compat: bool = True) -> DataFrame:
    """What could be found: per coassembly the targets of its edges and all other sequences of its samples.

    edges: text form (samples and target_ids as comma lists); clusters: samples as a comma list. compat: names of non-targets lose a trailing _1 and .1 in any case.
    """
    members = clusters.select("coassembly", F.explode(F.split("samples", ",")).alias("samples"))
    e = edges.select(F.col("samples").alias("edge"), "cluster_size", "target_ids", F.explode(F.split("samples", ",")).alias("samples"))
    met = _named(e, "samples", members).join(members, "samples")
    whole = met.groupBy("edge", "coassembly").agg(F.min("target_ids").alias("target_ids"), F.count(F.lit(1)).alias("n"), F.min("cluster_size").alias("cluster_size"), F.collect_set("samples").alias("samples"))
    whole = whole.where(F.col("n") == F.col("cluster_size"))
    links = whole.select("coassembly", "samples", F.explode(F.split("target_ids", ",")).alias("target")).select("coassembly", "target", F.explode("samples").alias("source")).distinct()
    rows = targets.select("gene", "sequence", "taxonomy", "num_hits", "coverage", F.col("target").cast("string").alias("target"), F.col("sample").alias("source"))
    sought = _named(rows, "source", members).join(links, ["target", "source"]).groupBy("gene", "sequence", "coassembly", "taxonomy", "target").agg(
        F.array_join(F.array_sort(F.collect_list("source")), ",").alias("source_samples"), F.sum("num_hits").alias("source_num_hits"), F.sum("coverage").alias("source_coverage")
    )
    sought = sought.withColumn("found_in", F.lit(None).cast("string"))
    cols = ["sample", "gene", "sequence", "taxonomy", "found_in", "num_hits", "coverage"]
    rest = targets.join(sought.select("gene", "sequence").distinct(), ["gene", "sequence"], "left_anti").withColumn("found_in", F.lit(None).cast("string"))
    other = binned.select(*cols, F.lit(None).cast("string").alias("target")).unionByName(rest.select(*cols, F.lit(NONE).alias("target")))
    other = other.withColumn("sample", strip_both(F.col("sample"))) if compat else _named(other, "sample", members)
    first = F.min_by(F.struct("taxonomy", "found_in", "target"), F.struct(F.col("target").isNotNull(), "sample", "taxonomy", "found_in"))
    other = other.join(members, F.col("sample") == F.col("samples")).groupBy("gene", "sequence", "coassembly").agg(
        first.alias("f"), F.array_join(F.array_sort(F.collect_set("sample")), ",").alias("source_samples"), F.sum("num_hits").alias("source_num_hits"), F.sum("coverage").alias("source_coverage")
    )
    other = other.select("gene", "sequence", "coassembly", "f.taxonomy", "f.found_in", "f.target", "source_samples", "source_num_hits", "source_coverage")
    return sought.unionByName(other)


def combined(recovered: DataFrame, hay: DataFrame) -> DataFrame:
    """Recovered sequences against the haystack, for coassemblies that recovered something; rows have a genome or a target."""
    own = split_name(recovered).select("coassembly", "gene", "sequence", "genome", F.col("taxonomy").alias("t"))
    some = own.select("coassembly").distinct()
    both = own.join(hay, ["coassembly", "gene", "sequence"], "full").join(some, "coassembly", "left_semi")
    return both.withColumn("taxonomy", F.coalesce("t", "taxonomy")).where("genome is not null or target is not null").select(*HIT)


def _known(df: DataFrame) -> DataFrame:
    return df.withColumn("target", F.when(F.col("target") != NONE, F.col("target")))


def matched(all_hits: DataFrame) -> DataFrame:
    return _known(all_hits.where("target is not null or found_in is not null or source_samples is not null"))


def novel(all_hits: DataFrame) -> DataFrame:
    return all_hits.where("target is null and found_in is null and source_samples is null")


def summary(all_hits: DataFrame, bins: DataFrame) -> DataFrame:
    """Match and nonmatch counts of six statistics for each coassembly, with totals and percent; bins: (name)."""
    all_hits = cut(all_hits, "hits")  # read by five aggregations
    status = lambda ok: F.when(ok, F.lit("match")).otherwise(F.lit("nonmatch")).alias("status")
    sought = matched(all_hits).where("target is not null").withColumn("status", status(F.col("genome").isNotNull()))
    base = sought.groupBy("coassembly", "status").agg(F.countDistinct("sequence").alias("sequences"), F.countDistinct("genome").alias("bins"), F.countDistinct("taxonomy").alias("taxonomy"))
    found = _known(all_hits.where("genome is not null"))
    kinds = {
        "nontarget_bin_sequences": F.col("found_in").isNotNull(),
        "nontarget_unbin_sequences": F.col("target").isNull() & F.col("found_in").isNull() & F.col("source_samples").isNotNull(),
        "novel_sequences": F.col("target").isNull() & F.col("found_in").isNull() & F.col("source_samples").isNull(),
    }
    for name, ok in kinds.items():
        base = base.join(found.groupBy("coassembly", status(ok)).agg(F.count(F.lit(1)).alias(name)), ["coassembly", "status"], "full")
    names = ["sequences", "bins", "taxonomy", *kinds]
    long = base.fillna(0, names).unpivot(["coassembly", "status"], names, "statistic", "value")
    n = split_name(bins, "name").groupBy("coassembly").agg(F.count(F.lit(1)).alias("n"))
    hit = long.where("statistic = 'bins' and status = 'match'").select("coassembly", "value")
    rest = n.join(hit, "coassembly", "left").select("coassembly", F.lit("nonmatch").alias("status"), F.lit("bins").alias("statistic"), (F.col("n") - F.col("value")).alias("value"))
    wide = long.where("statistic <> 'bins' or status <> 'nonmatch'").unionByName(rest).groupBy("coassembly", "statistic").pivot("status", ["match", "nonmatch"]).agg(F.first("value"))
    within = F.when(F.col("statistic").isin("sequences", "taxonomy"), F.lit("targets")).otherwise(F.lit("recovery"))
    total = F.col("match") + F.col("nonmatch")
    percent = F.round(F.when(total != 0, F.col("match") / total * 100), 2)
    return wide.select("coassembly", "statistic", within.alias("within"), "match", "nonmatch", total.alias("total"), percent.alias("match_percent"))


def ordered_summary(s: DataFrame) -> DataFrame:
    return s.orderBy(F.asc("coassembly"), F.desc("within"), F.asc("statistic"))


def evaluate(targets: DataFrame, binned: DataFrame, clusters: DataFrame, edges: DataFrame, recovered: DataFrame, bins: DataFrame, compat: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, novel, summary). Without recovered sequences all three are empty."""
    hits = combined(recovered, haystack(targets, binned, clusters, edges, compat))
    if recovered.isEmpty():
        bins = bins.where(F.lit(False))
    return matched(hits), novel(hits), summary(hits, bins)


def by_rank(matches: DataFrame, rank: int) -> DataFrame:
    """(group, recovered, missed) of targets by a rank of the taxonomy, counted from 0 (root)."""
    own = matches.where("target is not null").withColumn("group", F.get(F.split("taxonomy", "; "), F.lit(rank)))
    return own.groupBy("group").agg(F.count("genome").alias("recovered"), F.count_if(F.col("genome").isNull()).alias("missed"))


def by_gene(matches: DataFrame) -> DataFrame:
    """(gene, gene_number, recovered, missed) of targets; the number stands behind the first dot."""
    own = matches.where("target is not null").groupBy("gene").agg(F.count("genome").alias("recovered"), F.count_if(F.col("genome").isNull()).alias("missed"))
    return own.withColumn("gene_number", F.get(F.split("gene", r"\."), F.lit(1)).try_cast("int"))


def wide_table(stats: DataFrame, clusters: DataFrame) -> DataFrame:
    """One row for each coassembly: its size and the matches of each statistic in columns."""
    names = ["sequences", "bins", "nontarget_bin_sequences", "nontarget_unbin_sequences", "novel_sequences"]
    wide = stats.groupBy("coassembly").pivot("statistic", names).agg(F.first("match"))
    return clusters.select("coassembly", "length", (F.col("total_size") / 1e9).alias("total_size")).join(wide, "coassembly", "left")
