"""Indicator fixtures: rising, falling, flat, zigzag, a zero close, and short series."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from candlelake.plans import alerts, features, summary
from candlelake.schemas import SNAPSHOT


def candles(spark, closes, coin="c"):
    rows = [(coin, i, float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "coin_id string, i bigint, close double").select(
        "coin_id", F.timestamp_seconds(F.col("i") * 60).alias("source_updated_at"), "close")


SHAPES = {
    "rising": [100 + i for i in range(260)],
    "falling": [1000 - i for i in range(260)],
    "flat": [50] * 260,
    "zigzag": [100 + (i % 7) * (-1) ** i for i in range(260)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(spark, shape):
    rows = features.add_features(candles(spark, SHAPES[shape])).orderBy("source_updated_at").collect()
    assert len(rows) == 260
    last = rows[-1]
    assert rows[198]["sma_200"] is None and rows[199]["sma_200"] is not None
    assert rows[48]["sma_50"] is None and rows[49]["sma_50"] is not None
    assert last["bb_lower"] <= last["bb_mid"] <= last["bb_upper"]
    if shape == "rising":
        assert last["rsi_14"] == pytest.approx(100) and last["macd"] > 0
    if shape == "falling":
        assert last["rsi_14"] == pytest.approx(0, abs=1e-9) and last["macd"] < 0
    if shape == "flat":
        assert last["rsi_14"] is None and last["bb_percent"] is None and last["log_ret"] == 0
    if shape == "zigzag":
        assert all(0 <= r["rsi_14"] <= 100 for r in rows[14:])


def test_zero_close_has_no_log_return(spark):
    rows = features.add_features(candles(spark, [5, 0, 5, 6]), ["log_return"]).orderBy("source_updated_at").collect()
    assert [r["log_ret"] is None for r in rows] == [True, True, True, False]
    assert rows[3]["log_ret"] == pytest.approx(math.log(6 / 5))


def test_short_series_has_nothing_after_warm_up(spark):
    short = features.add_features(candles(spark, [100 + i % 5 for i in range(150)]))
    assert features.drop_warm_up(short).count() == 0
    full = features.add_features(candles(spark, [100 + i % 5 for i in range(210)]))
    assert features.drop_warm_up(full).count() == 11


def test_non_finite_values_are_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("inf"), 1.0), (float("nan"), 1.0), (None, 1.0)], "a double, b double")
    assert features.drop_warm_up(df).count() == 1


def snapshots(spark, prices, coin="bitcoin"):
    rows = [(coin, "btc", float(p), i) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "coin_id string, symbol string, current_price double, i int")
    at = F.timestamp_seconds(F.col("i") * 86_400 + 1_672_531_200)
    have = {"source_updated_at": at, "processed_at": at, "ingested_timestamp": at}
    df = df.withColumns(have)
    names = [part.strip().split(" ") for part in SNAPSHOT.split(",")]
    return df.select(*[
        F.col(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in names
    ])


def test_rising_snapshots(spark):
    out = summary.summarize(snapshots(spark, range(100, 115))).orderBy("source_updated_at").collect()
    last = out[-1]
    assert last["sma_7d"] == 111 and last["rsi_14d"] == 100 and last["signal"] == "SELL"
    assert out[0]["rsi_14d"] == 100 and out[0]["signal"] == "WAIT" and out[0]["volatility_7d"] is None


def test_pruning_keeps_indicators_of_the_full_history(spark):
    prices = [100 + (i * 37) % 23 for i in range(120)]
    kept = summary.summarize(snapshots(spark, prices), keep=20).orderBy("source_updated_at").collect()
    full = summary.full_history(snapshots(spark, prices)).orderBy("source_updated_at").collect()[-20:]
    pick = ["source_updated_at", "sma_7d", "rsi_14d", "volatility_7d", "signal"]
    assert [[r[c] for c in pick] for r in kept] == [[r[c] for c in pick] for r in full]


def test_a_third_of_all_rows_being_copies_changes_nothing(spark):
    plain = snapshots(spark, [100 + i % 9 for i in range(60)])
    newest = plain.orderBy(F.desc("source_updated_at")).limit(1)
    copies = newest.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(3_000)))).drop("x")
    a = summary.summarize(plain, keep=10).orderBy("source_updated_at").collect()
    b = summary.summarize(plain.unionByName(copies), keep=10).orderBy("source_updated_at").collect()
    assert a == b


def test_distinct_modes(spark):
    one = snapshots(spark, [1, 2, 3])
    again = one.withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 1 HOUR"))
    both = one.unionByName(again)
    assert summary.summarize(both).count() == 6
    assert summary.summarize(both, distinct="key").count() == 3


def test_empty_state_and_input(spark):
    empty = spark.createDataFrame([], SNAPSHOT)
    assert summary.summarize(empty).count() == 0
    assert summary.full_history(empty).count() == 0


def test_alert_payload(spark):
    import json

    out = summary.summarize(snapshots(spark, range(100, 115)))
    at = F.lit("2024-05-01T10:20:00Z").cast("timestamp")
    row = alerts.alert_rows(alerts.newest_alert(out), "symbol", at).collect()[0]
    embed = json.loads(row["payload"])["embeds"][0]
    assert embed["title"].endswith("SELL SIGNAL DETECTED: btc") and embed["color"] == 15548997
    assert [f["value"] for f in embed["fields"]] == ["$114.0000", "100.0", "2024-05-01 10:20 UTC"]
    assert alerts.newest_alert(summary.summarize(snapshots(spark, [5, 5]))).count() == 0
