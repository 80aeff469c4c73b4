"""Windows over blocks give what windows over whole series give."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.functions import indicators as ind
from candlelake.operators.blocks import Series, cut
from candlelake.plans import features

SERIES = Series("coin_id", "source_updated_at", ("n",))


def frame(spark, hot=6_000, seed=1):
    """One coin with most rows, bursts within a millisecond, gaps of months, ties; and small coins."""
    rng = np.random.default_rng(seed)
    parts = []
    for coin, n in (("hot", hot), ("mid", 900), ("one", 1)):
        step = rng.choice([0, 1, 1_000, 60_000_000, 3_000_000_000_000], n, p=[0.2, 0.5, 0.2, 0.08, 0.02])
        us = 1_700_000_000_000_000 + np.cumsum(step)
        parts.append(pd.DataFrame({"coin_id": coin, "us": us, "n": np.arange(n), "close": rng.uniform(1, 100, n)}))
    pdf = pd.concat(parts)
    return spark.createDataFrame(pdf).select(
        "coin_id", F.timestamp_micros("us").alias("source_updated_at"), "n", "close"
    )


@pytest.mark.parametrize("block_rows,reach", [(1_000_000, 30), (300, 30), (64, 30), (30, 30)])
def test_positions_and_frames(spark, block_rows, reach):
    df = frame(spark)
    blocks = cut(df, SERIES, reach, block_rows)
    close = F.col("close")
    out = blocks.df.withColumns({
        "mean": ind.sma(close, reach, blocks.window), "diff": ind.difference(close, blocks.window), "p": blocks.pos,
    })
    got = blocks.merge(out).toPandas().sort_values(["coin_id", "source_updated_at", "n"]).reset_index(drop=True)
    want = df.toPandas().sort_values(["coin_id", "source_updated_at", "n"]).reset_index(drop=True)
    assert len(got) == len(want)
    by = want.groupby("coin_id")["close"]
    assert (got["p"] == want.groupby("coin_id").cumcount()).all()
    np.testing.assert_allclose(got["diff"], by.diff(), atol=1e-12)
    np.testing.assert_allclose(
        got["mean"], by.rolling(reach, min_periods=1).mean().reset_index(drop=True), rtol=1e-9)


def test_no_block_is_much_larger_than_asked(spark):
    blocks = cut(frame(spark), SERIES, 10, 200)
    sizes = blocks.df.groupBy("coin_id", "_block").count().toPandas()
    assert sizes["count"].max() <= 3 * 200
    assert sizes[sizes.coin_id == "hot"].shape[0] >= 6_000 / 200


def test_missing_times_and_keys_are_kept(spark):
    df = frame(spark, hot=500).unionByName(
        spark.sql("SELECT 'hot' AS coin_id, CAST(NULL AS timestamp) AS source_updated_at, n, 1.0D AS close "
                  "FROM VALUES (-1L), (-2L) t(n) UNION ALL SELECT NULL, timestamp'2024-01-01', 1L, 2.0D"))
    blocks = cut(df, SERIES, 5, 100)
    assert blocks.merge(blocks.df).count() == df.count()


@pytest.mark.parametrize("time", ["timestamp_micros(1700000000000000L)", "CAST(NULL AS timestamp)"])
@pytest.mark.parametrize("ties", [("n",), ()])
def test_ties_are_split_like_other_rows(spark, time, ties):
    """40,000 of 80,000 rows share a time, or have none."""
    df = spark.range(80_000).selectExpr(
        "'a' AS coin_id", "id % 1000 AS n", "CAST(id AS double) AS close",
        f"CASE WHEN id % 2 = 0 THEN {time} ELSE timestamp_micros(1600000000000000L + id * 1000000) END AS source_updated_at")
    blocks = cut(df, Series("coin_id", "source_updated_at", ties), 20, 1_024)
    sizes = blocks.df.groupBy("_block").count().toPandas()["count"]
    assert sizes.sum() <= 3 * 80_000 and sizes.max() <= 3 * 1_024
    got = blocks.merge(blocks.df.withColumn("p", blocks.pos)).toPandas()
    assert sorted(got["p"]) == list(range(80_000)) and got["close"].nunique() == 80_000
    if ties:
        want = got.sort_values(["source_updated_at", "n"], kind="stable", na_position="first")
        assert (want["p"].to_numpy()[np.lexsort((want["p"], want["n"], want["source_updated_at"].fillna(pd.Timestamp(0))))]
                == np.arange(80_000)).all()


def ema(x: pd.Series, n: int) -> pd.Series:
    """A span average seeded with the mean of its first n values."""
    x = x.copy()
    at = x.first_valid_index()
    seed = x.iloc[at:at + n].mean()
    x.iloc[:at + n - 1] = np.nan
    x.iloc[at + n - 1] = seed
    return x.ewm(span=n, adjust=False).mean()


def wilder(close: pd.Series, n: int = 14, adjust: bool = False) -> pd.Series:
    diff = close.diff()
    up, down = diff.clip(lower=0), (-diff).clip(lower=0)
    kw = {"alpha": 1 / n, "adjust": adjust, "min_periods": n}
    up, down = up.ewm(**kw).mean(), down.ewm(**kw).mean()
    return 100 * up / (up + down)


@pytest.mark.parametrize("block_rows", [15_000, 5_000, 1_900])
def test_recursive_averages_over_many_blocks(spark, block_rows):
    """45,000 rows, flat for 14,000 of them, so that whole blocks have no change at all."""
    rng = np.random.default_rng(3)
    n = 45_000
    close = np.exp(np.cumsum(rng.normal(0, 0.01, n))) * 100
    close[15_000:29_000] = close[15_000]
    close[29_500:29_990] = close[29_500]
    pdf = pd.DataFrame({"coin_id": "a", "us": np.arange(n) * 60_000_000, "close": close})
    df = spark.createDataFrame(pdf).select("coin_id", F.timestamp_micros("us").alias("source_updated_at"), "close")
    out = features.add_features(df, ["rsi", "macd"], block_rows=block_rows).toPandas()
    out = out.sort_values("source_updated_at").reset_index(drop=True)
    line = ema(pd.Series(close), 12) - ema(pd.Series(close), 26)
    signal = ema(line, 9)
    for name, want, tol in (("macd", line, 1e-9), ("macd_signal", signal, 1e-9), ("macd_hist", line - signal, 1e-9)):
        np.testing.assert_allclose(out[name], want, atol=tol)
    rsi = wilder(pd.Series(close))
    rsi[15_001:29_000] = rsi[15_000]      # the plain recursion fades to zero there; its ratio does not change
    np.testing.assert_allclose(out["rsi_14"], rsi, atol=1e-6)


def test_weighted_first_difference(spark):
    close = pd.Series(100 + np.sin(np.arange(300)) * 5)
    pdf = pd.DataFrame({"coin_id": "a", "us": np.arange(300) * 60_000_000, "close": close})
    df = spark.createDataFrame(pdf).select("coin_id", F.timestamp_micros("us").alias("source_updated_at"), "close")
    blocks = cut(df, features.CANDLES, features.REACH["rsi"])
    out = blocks.merge(features.add_wilder_rsi(blocks.df, blocks, weighted_first=True))
    got = out.toPandas().sort_values("source_updated_at")["rsi_14"].to_numpy()
    np.testing.assert_allclose(got, wilder(close, adjust=True), atol=1e-9)


def test_crosses_far_below_the_rounding_of_a_mean(spark):
    close = np.full(500, 1e6)
    close[250] += 0.0001      # a price step of 1e-10
    pdf = pd.DataFrame({"coin_id": "a", "us": np.arange(500) * 60_000_000, "close": close, "n": np.arange(500)})
    df = spark.createDataFrame(pdf).select("coin_id", F.timestamp_micros("us").alias("source_updated_at"), "close", "n")
    for block_rows in (None, 300):
        got = {(r["n"], r["cross"]) for r in features.crosses(df, block_rows=block_rows).collect()}
        assert got == {(250, "golden"), (300, "death")}


def copied(spark, hot):
    """Rows with copies: one row most of the table, a time with many rows, and a few repeats."""
    df = frame(spark, hot=2_000)
    times = spark.range(hot).select(F.lit("hot").alias("coin_id"), F.timestamp_micros(F.lit(1_700_000_000_000_000)).alias(
        "source_updated_at"), F.lit(-1).cast("bigint").alias("n"), F.lit(3.0).alias("close"))
    late = spark.range(700).select(F.lit("mid").alias("coin_id"), F.timestamp_micros(F.lit(1_800_000_000_000_000)).alias(
        "source_updated_at"), (F.col("id") % 300 + 10_000).alias("n"), (F.col("id") % 300 + 1.0).alias("close"))
    none = spark.range(500).select(F.lit("mid").alias("coin_id"), F.lit(None).cast("timestamp").alias("source_updated_at"),
                                   (F.col("id") % 4 + 20_000).alias("n"), F.lit(None).cast("double").alias("close"))
    return df.unionByName(df.where("n % 3 = 0")).unionByName(times).unionByName(late).unionByName(none)


@pytest.mark.parametrize("block_rows,reach", [(1_000_000, 20), (300, 20), (64, 20)])
def test_copies_are_dropped_inside_blocks(spark, block_rows, reach):
    df = copied(spark, 5_000)
    blocks = cut(df, SERIES, reach, block_rows, distinct=True)
    out = blocks.df.withColumns({"mean": ind.sma(F.col("close"), reach, blocks.window), "p": blocks.pos})
    got = blocks.merge(out).toPandas().sort_values(["coin_id", "p"]).reset_index(drop=True)
    want = df.toPandas().drop_duplicates().sort_values(["coin_id", "source_updated_at", "n"], na_position="first")
    want = want.reset_index(drop=True)
    assert len(got) == len(want)
    assert (got["n"] == want["n"]).all() and (got["p"] == want.groupby("coin_id").cumcount()).all()
    mean = want.groupby("coin_id")["close"].rolling(reach, min_periods=1).mean().reset_index(drop=True)
    np.testing.assert_allclose(got["mean"], mean, rtol=1e-9)
    sizes = blocks.df.groupBy("coin_id", "_block").count().toPandas()
    assert sizes["count"].max() <= max(3 * block_rows, 0)


def test_dropping_copies_takes_one_wide_shuffle(spark):
    df = frame(spark, hot=2_000)
    blocks = cut(df, SERIES, 20, 300, distinct=True)
    plan = blocks.df._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_block" in line]
    assert len(wide) == 1 and sum("Exchange hashpartitioning(coin_id" in line for line in plan.splitlines()) <= 3


def test_rows_that_differ_at_one_time_keep_one_order(spark):
    """No tie column tells these apart, so their hash does: every block has them in one order and none is lost."""
    df = spark.range(4_000).select(F.lit("c").alias("coin_id"), F.timestamp_seconds(F.col("id") % 40).alias("source_updated_at"),
                                   (F.col("id") % 2_000).cast("double").alias("close"))
    blocks = cut(df, Series("coin_id", "source_updated_at"), 10, 64, distinct=True)
    got = blocks.merge(blocks.df.withColumn("p", blocks.pos)).toPandas()
    assert sorted(got["close"]) == sorted(float(i) for i in range(2_000)) and sorted(got["p"]) == list(range(2_000))
