"""Summaries, commands and operational filters over the chosen clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.scratch import small


def coassembly_summary(clusters: DataFrame, read_size: DataFrame | None = None) -> DataFrame:
    """The clusters' columns, with unmapped_size if sizes of the reads that are left are given."""
    cols = ["coassembly", "samples", "length", "total_targets", "total_size"]
    if read_size is None:
        return clusters.select(*cols)
    each = clusters.select(*cols, F.explode(F.split("samples", ",")).alias("sample")).join(read_size, "sample", "left")
    return each.groupBy(*cols).agg(F.coalesce(F.sum("read_size"), F.lit(0)).cast("bigint").alias("unmapped_size"))


def length_histogram(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("length").agg(F.count(F.lit(1)).alias("clusters"))


def drop_single_ended(clusters: DataFrame, single_ended: list[str]) -> DataFrame:
    """Clusters without single-ended samples; such samples leave the recovery lists, which are sorted. Raises if no cluster is left."""
    bad = F.array(*[F.lit(s) for s in single_ended]).cast("array<string>")
    kept = clusters.where(~F.arrays_overlap(F.split("samples", ","), bad)) if single_ended else clusters
    if kept.isEmpty() and not clusters.isEmpty():
        raise ValueError("single-ended reads in all coassemblies")
    return kept.withColumn("recover_samples", F.array_join(F.array_sort(F.array_except(F.split("recover_samples", ","), bad)), ","))


def subset(clusters: DataFrame, names: list[str]) -> DataFrame:
    return clusters.where(F.col("coassembly").isin(*names))


def recovery_samples(clusters: DataFrame) -> DataFrame:
    """Distinct samples to fetch for recovery."""
    return clusters.select(F.explode(F.split("recover_samples", ",")).alias("sample")).distinct()


def exclusions(*lists: DataFrame) -> DataFrame:
    """Sample sets of all lists, each once: earlier iterations', the last run's and the user's."""
    out = lists[0].select("samples")
    for x in lists[1:]:
        out = out.unionByName(x.select("samples"))
    return out.distinct()


def suggested_before(new: DataFrame, old: DataFrame) -> DataFrame:
    """New coassemblies whose samples an old plan had."""
    return new.select("coassembly", "samples").join(old.select("samples").distinct(), "samples", "left_semi")


def _files(samples: str, reads: DataFrame, column: str) -> DataFrame:
    """(coassembly, column): the files of a comma list of samples, in its order, joined by spaces; a sample without a file stands for itself."""
    return lambda clusters: (
        clusters.select("coassembly", F.posexplode(F.split(samples, ",")).alias("p", "sample"))
        .join(small(reads.select("sample", F.col(column).alias("f"))), "sample", "left")
        .groupBy("coassembly")
        .agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce("f", "sample").alias("f")))).alias("x"))
        .select("coassembly", F.array_join(F.transform("x", lambda v: v.getField("f")), " ").alias(f"{samples}_{column}"))
    )


#: Fixed value: the external assembler's program.
ASSEMBLER = "aviary"


def commands(clusters: DataFrame, reads: DataFrame, out: str, assemble_threads: int = 64, assemble_memory: int = 500, recover_threads: int = 32, recover_memory: int = 250, fast: bool = False, program: str = ASSEMBLER) -> DataFrame:
    """(coassembly, assemble, recover): shell commands of the external assembler; reads: (sample, r1, r2). The trailing space is part of the format."""
    t = clusters.select("coassembly", "samples", "recover_samples")
    for samples in ("samples", "recover_samples"):
        for column in ("r1", "r2"):
            t = t.join(_files(samples, reads, column)(clusters), "coassembly")

    def text(*x: str | Column) -> Column:
        return F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])

    name = F.col("coassembly")
    assemble = text(f"{program} assemble --coassemble -1 ", F.col("samples_r1"), " -2 ", F.col("samples_r2"), f" --output {out}/coassemble/", name, f"/assemble -n {assemble_threads} -t {assemble_threads} -m {assemble_memory} --skip-qc &> {out}/coassemble/logs/", name, "_assemble.log ")
    quick = " --binning-only --refinery-max-iterations 0" if fast else ""
    recover = text(f"{program} recover --assembly {out}/coassemble/", name, "/assemble/assembly/final_contigs.fasta -1 ", F.col("recover_samples_r1"), " -2 ", F.col("recover_samples_r2"), f" --output {out}/coassemble/", name, f"/recover{quick} -n {recover_threads} -t {recover_threads} -m {recover_memory} --skip-qc &> {out}/coassemble/logs/", name, "_recover.log ")
    return t.select("coassembly", assemble.alias("assemble"), recover.alias("recover"))


def completion(done: DataFrame) -> DataFrame:
    """done: (dir, coassembly, assembled, recovered). Counts for each folder and, named by the number of folders, over all."""
    n = lambda c: F.count_if(F.col(c)).alias(c)
    per = done.groupBy("dir").agg(F.count(F.lit(1)).alias("total"), n("assembled"), n("recovered")).withColumn("incomplete", F.col("total") - F.col("recovered"))
    whole = per.agg(F.count(F.lit(1)).cast("string").alias("dir"), *[F.sum(c).alias(c) for c in ("total", "assembled", "recovered", "incomplete")])
    return per.unionByName(whole)


def incomplete(done: DataFrame) -> DataFrame:
    return done.where(~F.col("recovered"))
