"""Stored tables of the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.schemas import FEATURES, KLINE
from candlelake.session import settle


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one with its schema when nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_silver(spark: SparkSession, root: str, coins: Sequence[str] | None = None) -> DataFrame:
    """The clean candle table; naming coins prunes the scan to their partitions."""
    table = spark.read.parquet(root)
    if coins is not None:
        table = table.where(F.col("coin_id").isin(list(coins)))
    return table


def read_candles(spark: SparkSession, root: str, coins: Sequence[str] | None = None,
                 empty: str = KLINE) -> DataFrame:
    """Candles without the partition helper; with the ``empty`` schema when nothing is stored yet."""
    try:
        table = read_silver(spark, root, coins)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], empty)
    return table.drop("month")


def read_features(spark: SparkSession, root: str, coins: Sequence[str] | None = None) -> DataFrame:
    """The feature table; no row may be left of it when all series are short."""
    return read_candles(spark, root, coins, FEATURES)


def stored_months(spark: SparkSession, root: str) -> DataFrame:
    """``coin_id``, ``month`` and ``written_at`` (of the newest file) of a table, from the listing of its files."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "coin_id string, month string, written_at timestamp")
    return files.groupBy("coin_id", "month").agg(F.max("modificationTime").alias("written_at"))


def read_months(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """The rows of a table that belong to the coins and months in ``wanted``, and no others' files.

    ``wanted`` must be a written table (``settle``): the earliest month prunes the scan when it is planned, and
    below the broadcast threshold the pairs themselves prune it when it runs, so one coin's old months do not
    open those of the others.
    """
    earliest = wanted.agg(F.min("month")).first()[0] or ""
    table = spark.read.parquet(root).where(F.col("month") >= earliest)
    return table.join(wanted.where(F.col("month") >= earliest).select("coin_id", "month"), ["coin_id", "month"], "left_semi")


def read_newest(spark: SparkSession, root: str, k: int) -> DataFrame:
    """The rows of a table of unique candles that can be among the newest ``k`` of their coin.

    Whole months are kept, as many as each coin needs: the numbers of rows come from the files' footers, without
    reading a column, and only those months' files are read, whenever the other coins end.
    """
    counts = spark.read.parquet(root).groupBy("coin_id", "month").agg(F.count(F.lit(1)).alias("n"))
    newer = Window.partitionBy("coin_id").orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0))).where(F.col("newer") < k)
    return read_months(spark, root, settle(needed.select("coin_id", "month"), "newest-months")).drop("month")


def stored_coins(spark: SparkSession, root: str) -> DataFrame:
    """Coins that have data, from the listing of the files: one row per file, none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    return files.select("coin_id").distinct()


def discover_assets(spark: SparkSession, root: str) -> DataFrame:
    """Coins that have data, in order."""
    return stored_coins(spark, root).orderBy("coin_id")
