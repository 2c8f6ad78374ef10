"""Pairs of samples under a target that very many samples have, by pairs of blocks.

The list of such a target is sorted by falling coverage and cut into blocks of equal length. A pair of blocks is a key of its own
in a join, so no task has more than two blocks of a target, and pairs of blocks whose largest coverages don't reach the minimum
together are never made. Other targets are no concern of this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.index import numbered
from coverloom.scratch import cut, small

#: Rows of a target beyond which its pairs are made by blocks.
HOT = 5_000
#: Rows of a block; a pair of blocks makes at most its square of pairs.
BLOCK = 1_000


def split(rows: DataFrame, counted: DataFrame, hot: int) -> tuple[DataFrame, DataFrame | None]:
    """rows of the targets that `counted` has at most `hot` times, and of the others; None and all of rows if there are no others."""
    many = counted.groupBy("target").count().where((F.col("count") > hot) & F.col("target").isNotNull()).select("target")
    if many.isEmpty():
        return rows, None
    many = small(cut(many, "hot"))
    return rows.join(many, "target", "left_anti"), rows.join(many, "target", "left_semi")


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """rows (target, sample, coverage) with their block and `tops`, the largest coverage of each of the target's blocks."""
    at = numbered(rows, "_at", "target", F.desc("coverage"), "sample")
    first = at.groupBy("target").agg(F.min("_at").alias("_from"))
    at = at.join(small(first), "target").withColumn("block", F.expr(f"cast((_at - _from) div {block} as int)")).drop("_at", "_from")
    most = at.groupBy("target", "block").agg(F.max("coverage").alias("most"))
    tops = most.groupBy("target").agg(F.transform(F.array_sort(F.collect_list(F.struct("block", "most"))), lambda x: x.getField("most")).alias("tops"))
    return at.join(small(tops, 1_000), "target")


def _others(meets) -> Column:
    """The blocks of a row's target that `meets` (of a block's largest coverage) is true of."""
    return F.filter(F.sequence(F.lit(0), F.size("tops") - 1), lambda x: meets(F.get("tops", x)))


def match(rows: DataFrame, min_coverage: float, block: int = BLOCK) -> DataFrame:
    """(target, s1, s2) of sample pairs whose coverages of a target sum to over min_coverage."""
    at = cut(_blocked(rows.where("sample is not null and coverage is not null"), block), "blocks")
    own = F.get("tops", F.col("block"))
    at = at.withColumn("other", F.explode(_others(lambda m: own + m > min_coverage)))
    a = at.where("block <= other").select("target", F.col("block").alias("l"), F.col("other").alias("r"), F.col("sample").alias("a"), F.col("coverage").alias("ca"))
    b = at.where("other <= block").select("target", F.col("other").alias("l"), F.col("block").alias("r"), F.col("sample").alias("b"), F.col("coverage").alias("cb"))
    both = a.join(b, ["target", "l", "r"]).where(F.col("ca") + F.col("cb") > min_coverage).where("a < b or (l < r and a > b)")
    return both.select("target", F.least("a", "b").alias("s1"), F.greatest("a", "b").alias("s2"))


def directed(rows: DataFrame, min_coverage: float, block: int = BLOCK) -> DataFrame:
    """(target, source, dest) of different samples of a target whose source has over min_coverage of it. Blocks without a source are only met as destinations."""
    each = rows.where("sample is not null").groupBy("target", "sample").agg(F.max("coverage").alias("coverage"))
    at = cut(_blocked(each, block), "blocks")
    source = at.where(F.col("coverage") > min_coverage).select("target", F.col("sample").alias("source"), F.col("block").alias("l"), F.explode(F.sequence(F.lit(0), F.size("tops") - 1)).alias("r"))
    dest = at.select("target", F.col("sample").alias("dest"), F.col("block").alias("r"), F.explode(_others(lambda m: m > min_coverage)).alias("l"))
    return source.join(dest, ["target", "l", "r"]).where("source <> dest").select("target", "source", "dest")
