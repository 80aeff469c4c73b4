"""Coin metadata: extraction, lookup of provider ids, upsert, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.operators.dedup import keep_last
from candlelake.schemas import PROVIDER_IDS
from candlelake.session import settle


def id_map(spark: SparkSession) -> DataFrame:
    """Tracked pairs and their provider ids; a fixed table of a few dozen rows."""
    return spark.createDataFrame(list(PROVIDER_IDS.items()), "symbol string, provider_id string")


def with_provider_id(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Each pair with its provider id, NULL when it has none."""
    return pairs.join(ids, "symbol", "left")


def unmapped(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    return pairs.join(ids, "symbol", "left_anti")


def still_needed(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """Pairs whose stored metadata is absent or has no description."""
    done = stored.where(F.col("description") != "")
    return pairs.join(done.select("symbol").distinct(), "symbol", "left_anti")


def extract(records: DataFrame, symbol: str = "pair", record: str = "record") -> DataFrame:
    """The kept fields of provider records, with the defaults for missing ones."""
    r = F.col(record)
    empty = F.lit("")
    return records.select(
        F.col(symbol).alias("pair"),
        r["id"].alias("id"),
        r["symbol"].alias("symbol"),
        r["name"].alias("name"),
        F.coalesce(r["description"]["en"], empty).alias("description"),
        F.coalesce(r["categories"], F.array().cast("array<string>")).alias("categories"),
        F.coalesce(r["image"]["large"], empty).alias("image"),
        r["genesis_date"].alias("genesis_date"),
        F.coalesce(F.get(r["links"]["homepage"], F.lit(0)), empty).alias("homepage"),
    )


def upsert(stored: DataFrame, fetched: DataFrame, key: str = "pair", version: str = "fetched_at") -> DataFrame:
    """Stored and fetched records, the newest one for each pair."""
    return keep_last(stored.unionByName(fetched), [key], [version])


def enrich(prices: DataFrame, metadata: DataFrame, on: str = "coin_id") -> DataFrame:
    """Prices with their coin's metadata; coins without any keep NULLs.

    Metadata is settled first: with a known size it is broadcast while it is small, and
    past that the join is shuffled.
    """
    return prices.join(settle(metadata, "metadata"), on, "left")
