"""Raw market snapshots: JSON files that each hold an array of coin records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.schemas import SNAPSHOT_RAW


def read_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Records of all files below ``path`` with the name of their file."""
    raw = spark.read.schema(SNAPSHOT_RAW).option("multiLine", multi_line).json(path)
    return raw.select("*", F.col("_metadata.file_name").alias("ingested_file"))


def stream_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same records, each file once, as files arrive."""
    raw = spark.readStream.schema(SNAPSHOT_RAW).option("multiLine", multi_line).json(path)
    return raw.select("*", F.col("_metadata.file_name").alias("ingested_file"))
