"""New acquisitions as a stream: phases that arrive as files are appended, and the running noise of each interferogram is
kept by an aggregation with state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "ps_id long, ifg_id long, phi double, seen timestamp"


def phase_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).parquet(folder).withWatermark("seen", "1 day")


def running_noise(stream: DataFrame) -> DataFrame:
    return stream.groupBy("ifg_id").agg(F.degrees(F.sqrt(F.avg(F.col("phi") * F.col("phi")))).alias("std_deg"), F.count("*").alias("n"))


def append_epochs(stream: DataFrame, table: str, checkpoint: str):
    """Starts the query that appends what arrives to a table of the dataset, once for each row."""
    return stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
