"""Observation tables as they arrive: a file stream appended to Parquet, and running totals per sample and gene."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coverloom import schemas


def arrivals(spark: SparkSession, folder: str, header: bool = True) -> DataFrame:
    """New tab-separated observation tables of a folder."""
    return spark.readStream.schema(schemas.OTU).option("sep", "\t").option("header", str(header).lower()).csv(folder)


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now, each file once, and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def gene_totals(stream: DataFrame) -> DataFrame:
    """Hits and coverage of each sample and gene so far."""
    return stream.groupBy("sample", "gene").agg(F.sum("num_hits").alias("num_hits"), F.sum("coverage").alias("coverage"))
