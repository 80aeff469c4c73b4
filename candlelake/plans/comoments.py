"""Correlation by increment: co-moments of filled hourly prices, stored per block of hours.

A block is ``BLOCK_HOURS`` hours. Stored are, per block and asset, the number of hours, the mean, the squared
deviations and the last price, and per block and pair the co-moment, all centred on the block's own means, so
nothing is lost to large prices. Blocks merge exactly: the co-moment of the whole is the sum of theirs plus
that of their means. An hour without a price takes the last one before it, also from an earlier block; an
asset that began later has its first price in all blocks before, where it does not move and needs no row.

New hours add a block or replace the last one; a late hour replaces its block and those after it, since
what they fill in may come from it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.operators.correlation import BLOCK_HOURS, TILE_ASSETS, both_ways, tiled_products
from candlelake.session import settle
from candlelake.sources.tables import read_or_empty

ASSETS = "asset string, n bigint, mean double, m2 double, last double, first_hour bigint, first double, hour_block bigint"
PAIRS = "c1 string, c2 string, co double, hour_block bigint"
HOUR_US = 3_600_000_000


def _filled(hourly: DataFrame, known: DataFrame, first_hour: int, last_hour: int) -> DataFrame:
    """``asset``, ``hour_no``, ``price`` for every hour from ``first_hour`` to ``last_hour``.

    ``hourly`` has the prices there are, ``known`` the last one before ``first_hour`` of each asset that has one.
    """
    rows = hourly.select("asset", "hour_no", "price").unionByName(
        known.select("asset", F.lit(first_hour - 1).cast("bigint").alias("hour_no"), F.col("last").alias("price")))
    w = Window.partitionBy("asset").orderBy("hour_no")
    start = F.when(F.row_number().over(w) == 1, F.lit(first_hour)).otherwise(F.col("hour_no"))
    end = F.coalesce(F.lead("hour_no").over(w) - 1, F.lit(last_hour))
    spans = rows.withColumns({"_start": F.greatest(start, F.lit(first_hour)).cast("bigint"), "_end": end.cast("bigint")})
    return spans.where("_start <= _end").select("asset", F.explode(F.sequence("_start", "_end")).alias("hour_no"), "price")


def refresh_comoments(hourly: DataFrame, root: str, key: str = "coin_id", hour: str = "hour",
                      price: str = "current_price", tile_assets: int = TILE_ASSETS) -> None:
    """Replace the stored blocks from the first hour of ``hourly`` on.

    ``hourly`` has one price per asset and hour, unfilled, and all of them from the start of a block on.
    """
    spark = hourly.sparkSession
    rows = settle(hourly.where(F.col(price).isNotNull()).select(
        F.col(key).cast("string").alias("asset"), F.col(price).alias("price"),
        F.floor(F.unix_micros(F.col(hour).cast("timestamp")) / HOUR_US).cast("bigint").alias("hour_no")), "hourly")
    low, high = rows.agg(F.min("hour_no"), F.max("hour_no")).first()
    if low is None:
        return
    stored = read_or_empty(spark, f"{root}/assets", ASSETS).where(F.col("hour_block") < low // BLOCK_HOURS)
    started = not stored.isEmpty()
    low = low // BLOCK_HOURS * BLOCK_HOURS if started else low        # the table begins with its first price
    known = settle(stored.groupBy("asset").agg(F.max_by("last", "hour_block").alias("last")), "known-prices")
    filled = settle(_filled(rows, known, low, high).withColumn(
        "hour_block", F.floor(F.col("hour_no") / BLOCK_HOURS).cast("bigint")), "filled")
    began = rows.groupBy("asset").agg(F.min("hour_no").alias("first_hour"), F.min_by("price", "hour_no").alias("first"))
    assets = filled.groupBy("hour_block", "asset").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean"),
        F.coalesce(F.var_pop("price") * F.count(F.lit(1)), F.lit(0.0)).alias("m2"), F.max_by("price", "hour_no").alias("last"))
    assets = settle(assets.join(began, "asset", "left"), "block-assets")
    n_tiles = max(1, math.ceil(assets.select("asset").distinct().count() / tile_assets))
    tile = F.pmod(F.xxhash64("asset"), F.lit(n_tiles)).cast("int")
    z = filled.join(assets.select("hour_block", "asset", "mean"), ["hour_block", "asset"]).select(
        "asset", tile.alias("tile"), (F.col("price") - F.col("mean")).alias("z"), "hour_no", "hour_block")
    pairs = tiled_products(z, n_tiles).select("c1", "c2", F.col("part").alias("co"), "hour_block")
    for name, df in (("pairs", pairs), ("assets", assets)):
        df.hint("rebalance", "hour_block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "hour_block").parquet(f"{root}/{name}")


def correlations(spark: SparkSession, root: str, tile_assets: int = TILE_ASSETS) -> DataFrame:
    """``(c1, c2, corr)`` for all pairs, from the stored blocks; NULL where a price never moves."""
    assets = settle(read_or_empty(spark, f"{root}/assets", ASSETS), "block-assets")
    names = settle(assets.groupBy("asset").agg(F.min_by("first", "first_hour").alias("first")), "assets")
    n_assets = names.count()
    n_tiles = max(1, math.ceil(n_assets / tile_assets))
    # one row per block and asset: blocks before an asset began hold its first price
    hours = assets.groupBy("hour_block").agg(F.max("n").alias("hours"))
    low, high = assets.agg(F.min("hour_block"), F.max("hour_block")).first()
    rows = names.withColumn("hour_block", F.explode(F.sequence(F.lit(low or 0).cast("bigint"), F.lit(high or 0).cast("bigint"))))
    rows = rows.join(hours, "hour_block").join(assets.select("hour_block", "asset", "mean", "m2"), ["hour_block", "asset"], "left")
    rows = rows.select("hour_block", "asset", "hours", F.coalesce("mean", "first").alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
    rows = settle(rows, "block-means")
    n = F.sum("hours")
    centre = rows.groupBy("asset").agg((F.sum(F.col("hours") * F.col("mean")) / n).alias("centre"))
    rows = settle(rows.join(centre, "asset").withColumn("apart", F.col("mean") - F.col("centre")), "block-means")
    spread = settle(rows.groupBy("asset").agg(
        F.sqrt(F.sum(F.col("m2") + F.col("hours") * F.col("apart") * F.col("apart"))).alias("spread")), "spread")
    # NaN stands for "no deviation", as in the whole run
    unit = F.when(F.col("spread") > 0, F.sqrt("hours") * F.col("apart") / F.col("spread")).otherwise(F.lit(float("nan")))
    tile = F.pmod(F.xxhash64("asset"), F.lit(n_tiles)).cast("int")
    z = rows.join(spread, "asset").select("asset", tile.alias("tile"), unit.alias("z"), F.col("hour_block").alias("hour_no"),
                                          F.floor(F.col("hour_block") / BLOCK_HOURS).cast("bigint").alias("hour_block"))
    between = tiled_products(z, n_tiles).groupBy("c1", "c2", "t1", "t2").agg(F.sum("part").alias("between"))
    inside = read_or_empty(spark, f"{root}/pairs", PAIRS)
    # a stored pair may have the other order, where the number of tiles was another: the pair names the order
    ordered = F.array_sort(F.array("c1", "c2"))
    inside = inside.groupBy(F.get(ordered, F.lit(0)).alias("a"), F.get(ordered, F.lit(1)).alias("b"), "hour_block").agg(
        F.max("co").alias("co")).groupBy("a", "b").agg(F.sum("co").alias("co"))
    s1, s2 = (spread.select(F.col("asset").alias(c), F.col("spread").alias(f"s_{c}")) for c in ("c1", "c2"))
    pairs = between.withColumns({"a": F.least("c1", "c2"), "b": F.greatest("c1", "c2")}).join(inside, ["a", "b"], "left")
    pairs = pairs.join(s1, "c1").join(s2, "c2")
    within = F.try_divide(F.coalesce("co", F.lit(0.0)), F.col("s_c1") * F.col("s_c2"))
    upper = pairs.select("c1", "c2", "t1", "t2", (F.col("between") + F.coalesce(within, F.lit(0.0))).alias("dot"))
    return both_ways(upper).where(F.lit(n_assets > 1))
