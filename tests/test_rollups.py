"""Averages from stored summaries equal averages over rows."""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.plans import reporting, rollups

SERIES = Series("coin_id", "source_updated_at")


def prices(spark, days, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for coin, base in (("a", 1e6), ("b", 1e-3), ("c", 5.0)):
        for day in days:
            for second in rng.integers(0, 86_400, 40):
                price = None if rng.random() < 0.1 or coin == "c" and day == 1 else float(base * (1 + rng.normal(0, 1e-6)))
                rows.append((coin, int(day * 86_400 + second), price))
    return spark.createDataFrame(rows, "coin_id string, s long, current_price double").select(
        "coin_id", F.timestamp_seconds(F.col("s") + 1_706_659_200).alias("source_updated_at"), "current_price")


def assert_same(got, want):
    keys = ["coin_id", "period"]
    got, want = (df.toPandas().sort_values(keys).reset_index(drop=True) for df in (got, want))
    assert len(got) == len(want) and (got[[*keys, "n_rows"]] == want[[*keys, "n_rows"]]).all().all()
    np.testing.assert_allclose(got["avg_price"].astype(float), want["avg_price"].astype(float), rtol=1e-12)
    np.testing.assert_allclose(got["std_price"].astype(float), want["std_price"].astype(float), rtol=1e-6)


def test_averages_of_stored_summaries(spark, tmp_path):
    root = str(tmp_path / "rollup")
    assert rollups.averages(rollups.read_rollup(spark, root), "DAY").count() == 0
    df = prices(spark, range(4)).cache()      # 31 January to 3 February
    day = F.to_date("source_updated_at")
    rollups.refresh_rollup(df.where(day <= "2024-02-01"), root, SERIES)
    first = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    rollups.refresh_rollup(df.where(day > "2024-02-01"), root, SERIES)
    assert all(p.stat().st_mtime_ns == t for p, t in first.items())
    for period in ("DAY", "MONTH", "YEAR"):
        assert_same(rollups.averages(rollups.read_rollup(spark, root), period), reporting.period_average(df, period, SERIES))
    rollups.refresh_rollup(df.where(day > "2024-02-02"), root, SERIES)      # again: nothing counts twice
    late = rollups.read_rollup(spark, root, "2024-02-01")
    assert_same(rollups.averages(late, "MONTH"), reporting.period_average(df.where(day >= "2024-02-01"), "MONTH", SERIES))


def test_summaries_of_any_parts_merge(spark):
    df = prices(spark, range(3), 1).withColumn("part", F.pmod(F.hash("source_updated_at"), F.lit(5))).cache()
    parts = [rollups.hourly(df.where(F.col("part") == i), SERIES) for i in range(5)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    hours = rollups.merged(union, F.col("hour")).withColumnRenamed("period", "hour")
    assert_same(rollups.averages(hours, "DAY"), reporting.period_average(df, "DAY", SERIES))
