"""Metadata documents: JSON objects keyed by pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.schemas import METADATA


def read_documents(spark: SparkSession, path: str, record: str = METADATA, multi_line: bool = True) -> DataFrame:
    """``(pair, record)`` for each entry of each document; a corrupt document adds nothing.

    A document is a file, or a line of one where not ``multi_line``.
    """
    keyed = f"map<string, struct<{record}>>"
    documents = spark.read.text(path, wholetext=multi_line)
    return documents.select(F.explode(F.from_json("value", keyed)).alias("pair", "record"))
