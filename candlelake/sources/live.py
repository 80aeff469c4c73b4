"""Live candle messages and the buffer table of closed candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.schemas import LIVE_BUFFER


def stream_messages(spark: SparkSession, source: str = "text", **options: str) -> DataFrame:
    """Messages as one string column ``value``: landed text files, or Kafka where its package is there."""
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_buffer(spark: SparkSession, path: str) -> DataFrame:
    """The headerless buffer of closed candles."""
    return spark.read.schema(LIVE_BUFFER).csv(path)


def stream_buffer(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(LIVE_BUFFER).csv(path)
