"""Pearson correlation of every pair of assets, as a tiled matrix product.

The matrix is ``Z^T Z`` for the hour-by-asset matrix ``Z`` of standardized prices. Hours
are cut into blocks and assets into tiles; one task multiplies two tiles over one block of
hours, so pairs are formed inside numpy and only one partial sum per pair leaves it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.session import settle

TILE_ASSETS = 256
BLOCK_HOURS = 512


def _multiply(rows: pd.DataFrame) -> pd.DataFrame:
    """Partial products of the left and right tile over one block of hours."""
    hours, row = np.unique(rows["hour_no"].to_numpy(), return_inverse=True)
    sides = {}
    for name in ("left", "right"):
        at = (rows["side"] == name).to_numpy()
        assets, column = np.unique(rows["asset"].to_numpy()[at].astype(str), return_inverse=True)
        matrix = np.zeros((len(hours), len(assets)))
        matrix[row[at], column] = rows["z"].to_numpy(dtype=float)[at]
        sides[name] = assets, matrix
    (c1, left), (c2, right) = sides["left"], sides["right"]
    return pd.DataFrame({
        "c1": np.repeat(c1, len(c2)), "c2": np.tile(c2, len(c1)), "part": (left.T @ right).ravel(),
    })


def correlation_matrix(hourly: DataFrame, key: str = "coin_id", hour: str = "hour",
                       price: str = "current_price", tile_assets: int = TILE_ASSETS) -> DataFrame:
    """``(c1, c2, corr)`` for all pairs; NULL where a price never moves.

    ``hourly`` must hold one price per asset and hour. With a single asset there is nothing
    to compare and the result is empty.
    """
    stats = settle(
        hourly.groupBy(F.col(key).alias("asset")).agg(
            F.avg(price).alias("mean"), F.stddev_pop(price).alias("std"), F.count(price).alias("n"),
        ),
        "asset-stats",
    )
    n_assets = stats.count()
    n_tiles = max(1, math.ceil(n_assets / tile_assets))
    tiled = stats.withColumn("tile", F.pmod(F.xxhash64("asset"), F.lit(n_tiles)).cast("int"))
    # NaN stands for "no deviation": it carries through the product and leaves numpy as NULL.
    unit = F.when(F.col("std") > 0, (F.col(price) - F.col("mean")) / (F.col("std") * F.sqrt("n")))
    z = (
        hourly.join(tiled, F.col(key) == F.col("asset"))
        .select(
            "asset", "tile", F.coalesce(unit, F.lit(float("nan"))).alias("z"),
            F.floor(F.unix_micros(F.col(hour).cast("timestamp")) / 3_600_000_000).alias("hour_no"),
        )
        .withColumn("hour_block", F.floor(F.col("hour_no") / BLOCK_HOURS))
    )

    upper = tiled_products(z, n_tiles).groupBy("c1", "c2", "t1", "t2").agg(F.sum("part").alias("dot"))
    return both_ways(upper).where(F.lit(n_assets > 1))


def tiled_products(z: DataFrame, n_tiles: int) -> DataFrame:
    """``c1``, ``c2``, ``t1``, ``t2``, ``hour_block``, ``part``: products of all pairs of assets, summed over each block.

    ``z`` has ``asset``, ``tile``, ``z``, ``hour_no`` and ``hour_block``. Pairs of tiles come once, so of two assets in
    different tiles there is one order only.
    """
    def role(side: str, first: str, second: str, partners) -> DataFrame:
        return z.withColumn("_partner", F.explode(partners)).select(
            "hour_block", F.col(first).alias("t1"), F.col(second).alias("t2"),
            F.lit(side).alias("side"), "asset", "hour_no", "z",
        )

    left = role("left", "tile", "_partner", F.sequence("tile", F.lit(n_tiles - 1)))
    right = role("right", "_partner", "tile", F.sequence(F.lit(0), "tile"))
    return left.unionByName(right).groupBy("hour_block", "t1", "t2").applyInPandas(
        lambda rows: _multiply(rows).assign(t1=rows["t1"].iloc[0], t2=rows["t2"].iloc[0], hour_block=rows["hour_block"].iloc[0]),
        "c1 string, c2 string, part double, t1 int, t2 int, hour_block bigint",
    )


def both_ways(upper: DataFrame) -> DataFrame:
    """``(c1, c2, corr)`` in both orders from the sums ``dot`` of pairs of tiles."""
    here, there = F.struct("c1", "c2"), F.struct(F.col("c2").alias("c1"), F.col("c1").alias("c2"))
    pair = F.explode(F.when(F.col("t1") == F.col("t2"), F.array(here)).otherwise(F.array(here, there)))
    known = F.col("dot").isNotNull() & ~F.isnan("dot")
    corr = F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("dot"))))
    both = upper.select(pair.alias("p"), corr.alias("corr"))
    return both.select("p.c1", "p.c2", "corr")
