"""Connected components of an edge table by alternating large-star and small-star steps, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.util import materialize


def _stars(e: DataFrame) -> bool:
    """Whether edges (u, v), v < u, are stars: each u has one v, and no v is a u. Then v is the least node of its component."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("leaf").alias("l"), F.max("root").alias("r")).where("l > 1 or (l = 1 and r = 1)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the least node that edges reach, for every node that isn't its own root. Node columns may be any orderable type. Each round writes the edges anew, so a lost executor costs one round."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(e, "edges")
    for _ in range(max_rounds):
        if _stars(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = materialize(small, "edges")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
