"""Read files as tables of numbered lines: base pairs, interleaving, mates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def base_pairs(lines: DataFrame) -> DataFrame:
    """(sample, read_size) from (sample, line_no from 1, value): the lengths of the second of every four lines."""
    own = lines.where(F.col("line_no") % 4 == 2)
    return own.groupBy("sample").agg(F.coalesce(F.sum(F.length("value")), F.lit(0)).cast("bigint").alias("read_size"))


def headers(lines: DataFrame) -> DataFrame:
    """(sample, read, number from 1) of the first of every four lines; `read` is trimmed."""
    own = lines.where(F.col("line_no") % 4 == 1)
    return own.select("sample", F.trim("value").alias("read"), ((F.col("line_no") + 3) / 4).cast("bigint").alias("number"))


def ends(reads: DataFrame, first: int, last: int) -> DataFrame:
    """The first and the last pairs of reads of each sample, each read once."""
    n = reads.groupBy("sample").agg(F.max("number").alias("n"))
    return reads.join(n, "sample").where((F.col("number") <= 2 * first) | (F.col("number") > F.col("n") - 2 * last)).drop("n")


def odd_pairs(reads: DataFrame) -> DataFrame:
    """(sample, index, first, second) of neighbours whose headers differ behind the first word; a pair with a read missing is left out."""
    rest = reads.select("sample", F.floor((F.col("number") + 1) / 2).cast("bigint").alias("index"), (F.col("number") % 2).alias("r"), F.regexp_extract("read", r"^[^ ]*(.*)", 1).alias("h"))
    pair = rest.groupBy("sample", "index").agg(F.max(F.when(F.col("r") == 1, F.col("h"))).alias("first"), F.max(F.when(F.col("r") == 0, F.col("h"))).alias("second"))
    return pair.where("first <> second")


def interleaved(reads: DataFrame, totals: DataFrame) -> DataFrame:
    """(sample, interleaved, reason); totals: (sample, n), all reads of a file."""
    seen = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("k"))
    odd = odd_pairs(reads).groupBy("sample").agg(F.count(F.lit(1)).alias("bad"))
    t = totals.join(seen, "sample", "left").join(odd, "sample", "left").fillna(0, ["k", "bad"])
    reason = (
        F.when(F.col("n") == 0, F.lit("Empty file"))
        .when(F.col("n") % 2 == 1, F.lit("Odd readcount"))
        .when(F.col("bad") > 0, F.concat(F.lit("Consecutive reads do not match ("), F.col("bad").cast("string"), F.lit("/"), F.floor(F.col("k") / 2).cast("string"), F.lit(")")))
        .otherwise(F.lit("Duplicate read names in consecutive reads with even readcount"))
    )
    return t.select("sample", ((F.col("n") > 0) & (F.col("n") % 2 == 0) & (F.col("bad") == 0)).alias("interleaved"), reason.alias("reason"))


def deinterleave(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of the first and of the second mates of interleaved files."""
    odd = F.floor((F.col("line_no") - 1) / 4) % 2
    return lines.where(odd == 0), lines.where(odd == 1)


def renumbered(mates: DataFrame) -> DataFrame:
    """Lines that deinterleave has taken out, counted on without the gaps of four."""
    return mates.withColumn("line_no", (F.floor((F.col("line_no") - 1) / 8) * 4 + (F.col("line_no") - 1) % 4 + 1).cast("bigint"))


#: Endings of read and contig files, and what is cut from the end of what a pair's names share.
ENDINGS, MATE_MARK = (".fna", ".fq", ".fastq", ".fasta", ".fa"), "_R|\\."


def file_name(path: str) -> str:
    """A file's name without folder, compression and type."""
    name = path.rsplit("/", 1)[-1].removesuffix(".gz")
    return next((name.removesuffix(e) for e in ENDINGS if name.endswith(e)), name)


def joint_name(forward: str, reverse: str) -> str:
    """What the names of a pair of files begin with, without the mark of the mate."""
    a, b = (x.rsplit("/", 1)[-1] for x in (forward, reverse))
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:same].rstrip(MATE_MARK)


def sample_names(files: list[str]) -> dict[str, str]:
    """Sample name -> file, for files without mates. Two files of one name are an error."""
    return {name: f for name, f, _ in _named([(file_name(f), f, "") for f in files])}


def mates(forward: list[str], reverse: list[str], keep_order: bool = False) -> list[tuple[str, str, str]]:
    """(sample, forward file, reverse file); the lists are sorted, or else paired up as they stand. Two pairs of one name are an error."""
    if len(forward) != len(reverse):
        raise ValueError("as many forward as reverse files are needed")
    pairs = zip(forward, reverse) if keep_order else zip(sorted(forward), sorted(reverse))
    return _named([(joint_name(f, r), f, r) for f, r in pairs])


def _named(rows: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    seen: set[str] = set()
    for name, *_ in rows:
        if name in seen:
            raise ValueError(f"duplicate sample name {name}")
        seen.add(name)
    return rows


def named_files(files: DataFrame) -> DataFrame:
    """files: (forward, reverse), reverse null for files without mates. Adds the sample's name, as file_name and joint_name give it."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    a, b = base("forward"), base("reverse")
    alone = F.regexp_replace(F.regexp_replace(a, r"\.gz$", ""), r"(\.fna|\.fq|\.fastq|\.fasta|\.fa)$", "")
    same = F.filter(F.sequence(F.lit(1), F.least(F.length(a), F.length(b))), lambda i: F.left(a, i) == F.left(b, i))
    return files.withColumn("sample", F.when(F.col("reverse").isNull(), alone).otherwise(F.regexp_replace(F.left(a, F.size(same)), r"[_R|\\.]+$", "")))
