"""Numbering rows in a total order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coverloom.scratch import cut


def numbered(df: DataFrame, name: str, *order) -> DataFrame:
    """df with column `name` counting rows from 0 in the given order, which must be total. Rows are range-partitioned and sorted; only the row counts of the partitions are gathered."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut(placed.withColumns({"_p": F.shiftright(at, 33), "_i": at.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # one row for each partition
    first = counts.withColumn("_first", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return placed.join(F.broadcast(first), "_p").withColumn(name, F.col("_first") + F.col("_i")).drop("_p", "_i", "_first")
