"""An extension, without a counterpart in the batch tools: control-point files counted as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.operators.gcp import parse_lines


def stream_gcp(spark: SparkSession, path: str, late: str = "1 hour") -> DataFrame:
    """Points per file and minute of arrival, from new files under ``path``; files later than ``late`` don't count."""
    lines = spark.readStream.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("at"), F.lit(0).alias("line_no"), F.col("value").alias("line"))
    points = parse_lines(lines).where("kind = 'point'").withWatermark("at", late)
    return points.groupBy("file", F.window("at", "1 minute").alias("minute")).agg(F.count("*").alias("points"))
