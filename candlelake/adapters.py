"""The driver's tables in the roles of the lake: price series, candles, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series

PRICES = Series("coin_id", "source_updated_at", ("event_id",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """``events`` as price snapshots: one coin per event type (or user)."""
    return table(spark, sf_dir, "events").select(
        F.col(key).cast("string").alias("coin_id"),
        F.col("ts").alias("source_updated_at"),
        F.col("value").alias("current_price"),
        "event_id",
    )


def candles(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    """``events`` as candles: first, highest, lowest and last value of each interval that has events."""
    events = table(spark, sf_dir, "events")
    order = F.struct("ts", "event_id")
    bars = events.groupBy(F.col("event_type").alias("coin_id"), F.window("ts", interval).alias("_w")).agg(
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", order).alias("close"),
        F.sum("value").alias("volume"),
        F.sum(F.col("value") * F.col("value")).alias("quote_asset_vol"),
        F.count(F.lit(1)).alias("trades"),
    )
    return bars.select(
        "coin_id", F.col("_w.start").alias("source_updated_at"),
        "open", "high", "low", "close", "volume", "quote_asset_vol", "trades",
    )


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as raw market records; odd parts have no maximum supply."""
    part = table(spark, sf_dir, "part")
    none = F.lit(None)
    supply = F.col("p_size").cast("double")
    return part.select(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("id"),
        F.lower("p_brand").alias("symbol"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("current_price"),
        (F.col("p_retailprice") * supply).alias("market_cap"),
        F.col("p_size").alias("market_cap_rank"),
        none.cast("double").alias("fully_diluted_valuation"),
        (supply * 1000).alias("total_volume"),
        (F.col("p_retailprice") * 1.5).alias("high_24h"),
        (F.col("p_retailprice") * 0.5).alias("low_24h"),
        none.cast("double").alias("price_change_percentage_24h"),
        supply.alias("circulating_supply"),
        supply.alias("total_supply"),
        F.when(F.col("p_partkey") % 2 == 0, supply * 2).alias("max_supply"),
        (F.col("p_retailprice") * 2).alias("ath"),
        F.lit(-50.0).alias("ath_change_percentage"),
        F.lit("2021-11-10T00:00:00Z").cast("timestamp").alias("ath_date"),
        F.lit("2023-10-27T10:00:00Z").cast("timestamp").alias("last_updated"),
    )
