"""Correlations from stored blocks equal those of a whole run."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.operators.correlation import BLOCK_HOURS, correlation_matrix
from candlelake.plans import comoments, reporting

SERIES = Series("coin_id", "hour")
FIRST = 2_900 * BLOCK_HOURS + 100        # within a block


def hours(spark, n=1_300, seed=0):
    """Prices with missing hours: one coin that starts late, one that stops early, one that never moves, one huge."""
    rng = np.random.default_rng(seed)
    at = np.arange(n)
    base = np.cumsum(rng.normal(0, 1, n))
    coins = {"a": base + rng.normal(0, 3, n), "b": 1e7 - 2 * base + rng.normal(0, 9, n), "late": rng.normal(5, 1, n), "flat": np.full(n, 3.0),
             "stops": np.cumsum(rng.normal(0, 1, n))}
    keep = {"a": rng.random(n) < 0.6, "b": rng.random(n) < 0.9, "late": at > 700, "flat": rng.random(n) < 0.3, "stops": at < 350}
    rows = pd.concat([pd.DataFrame({"coin_id": c, "h": FIRST + at[keep[c]], "current_price": x[keep[c]]}) for c, x in coins.items()])
    rows = pd.concat([rows, pd.DataFrame({"coin_id": ["a"], "h": [FIRST + n], "current_price": [None]})])
    return spark.createDataFrame(rows.astype({"current_price": float})).select(
        "coin_id", F.timestamp_seconds(F.col("h") * 3_600).alias("hour"),
        F.when(~F.isnan("current_price"), F.col("current_price")).alias("current_price"))


def block(column="hour"):
    return F.floor(F.unix_micros(column) / 3_600_000_000 / BLOCK_HOURS)


def matrix(df):
    rows = df.collect()
    assert len({(r["c1"], r["c2"]) for r in rows}) == len(rows)
    return {(r["c1"], r["c2"]): r["corr"] for r in rows}


def assert_same(got, want):
    got, want = matrix(got), matrix(want)
    assert set(got) == set(want)
    for pair, value in want.items():
        assert (value is None) == (got[pair] is None), pair
        if value is not None:
            assert abs(value - got[pair]) < 1e-9, pair


def test_blocks_merge_to_the_whole(spark, tmp_path):
    root = str(tmp_path / "moments")
    df = hours(spark).cache()
    want = correlation_matrix(reporting.hourly_prices(df, SERIES))
    first = FIRST // BLOCK_HOURS
    cut = F.col("hour") < F.timestamp_seconds(F.lit((FIRST + 600) * 3_600))
    late = (F.col("coin_id") == "a") & (block() == first + 1)
    comoments.refresh_comoments(df.where(cut & ~late), root, tile_assets=2)
    assert_same(comoments.correlations(spark, root), correlation_matrix(reporting.hourly_prices(df.where(cut & ~late), SERIES)))
    kept = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet") if f"hour_block={first}/" in str(p)}
    comoments.refresh_comoments(df.where((block() >= first + 1) & ~late), root, tile_assets=3)
    comoments.refresh_comoments(df.where(block() >= first + 1), root)
    assert kept and all(p.stat().st_mtime_ns == t for p, t in kept.items())
    for tiles in (2, 256):
        assert_same(comoments.correlations(spark, root, tiles), want)


def test_nothing_and_one_asset(spark, tmp_path):
    df = hours(spark, 50)
    comoments.refresh_comoments(df.limit(0), str(tmp_path / "none"))
    assert comoments.correlations(spark, str(tmp_path / "none")).count() == 0
    comoments.refresh_comoments(df.where("coin_id = 'a'"), str(tmp_path / "one"))
    assert comoments.correlations(spark, str(tmp_path / "one")).count() == 0
