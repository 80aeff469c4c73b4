"""Scans that read what is needed, and audits that order nothing."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.operators.newest import _day_ranges, since_newest, top_rows
from candlelake.plans import quality
from candlelake.session import settle
from candlelake.sinks.tables import write_silver
from candlelake.sources import tables as stored

DAY = 86_400_000_000
SERIES = Series("coin_id", "source_updated_at")


def plain_continuity(rows, minutes):
    out = {}
    for coin in {c for c, _ in rows}:
        mine = [us for c, us in rows if c == coin]
        us = np.sort(np.array([x for x in mine if x is not None], np.int64))
        steps = np.diff(us)
        wide = np.flatnonzero(steps > minutes * 60_000_000)
        out[coin] = (len(mine), len(wide), steps.max() / 1e6 if len(steps) else None, us[wide[0] + 1] if len(wide) else None)
    return out


@pytest.mark.parametrize("bucket_rows", [4_096, 40, 3])
def test_continuity_equals_a_plain_lag(spark, bucket_rows):
    rng = np.random.default_rng(bucket_rows)
    rows = [("none", None)] * 3 + [("twice", 5)] * 2 + [("one", -7), (None, 1), ("few", None)]
    for coin, n in (("hot", 5_000), ("old", 800), ("few", 5)):
        step = rng.choice([0, 1, 60_000_000, 120_000_000, 120_000_001, 40 * DAY], n, p=[0.3, 0.2, 0.4, 0.05, 0.04, 0.01])
        start = -3 * DAY * 365 if coin == "old" else 1_700_000_000_000_000
        rows += [(coin, int(us)) for us in start + np.cumsum(step)]
    df = spark.createDataFrame(rows, "coin_id string, us long").select("coin_id", F.timestamp_micros("us").alias("source_updated_at"))
    got = quality.continuity(df, SERIES, 2, bucket_rows).withColumn("at", F.unix_micros("first_gap_at")).collect()
    assert {r["coin_id"]: (r["n_rows"], r["n_gaps"], r["max_step_seconds"], r["at"]) for r in got} == plain_continuity(rows, 2)


def test_continuity_has_no_window_over_rows(spark):
    df = spark.range(20_000).selectExpr("'a' AS coin_id", "timestamp_seconds(id * 60) AS source_updated_at")
    text = quality.continuity(df, SERIES)._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[[^\n]*", text)
    assert len(windows) == 2 and all("max(last" in w for w in windows)
    assert quality.continuity(df.limit(0), SERIES).count() == 0


def prices(spark, ends=("2020-02-01", "2024-01-01", "2024-01-02")):
    """Hourly prices of a year up to each end."""
    coins = ("stale", "fresh", "other")
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{c}' AS coin_id, timestamp'{end}' - make_interval(0, 0, 0, 0, CAST(id AS INT)) AS source_updated_at, CAST(id AS double) AS close "
        f"FROM range(8000)" for c, end in zip(coins, ends)))


def test_a_stale_coin_does_not_open_the_years_between(spark):
    df = settle(prices(spark).unionByName(spark.sql(
        "SELECT 'fresh' AS coin_id, CAST(NULL AS timestamp) AS source_updated_at, 0D AS close")), "prices")
    recent = since_newest(df, SERIES, 50)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = recent._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(Or\(.*?\))\], ReadSchema", text).group(1)
    assert "2020-0" in pushed and "2023-12" in pushed and pushed.count("LessThan(") == 1
    got = {(r["coin_id"], r["source_updated_at"]) for r in top_rows(recent, SERIES, 50).collect()}
    assert got == {(r["coin_id"], r["source_updated_at"]) for r in top_rows(df, SERIES, 50).collect()}


def test_day_ranges_join_the_nearest(spark):
    rows = [(24 * d, 24 * d + 30) for d in range(0, 400, 4)] + [(24 * 5_000, 24 * 5_000), (None, None)]
    cutoff = spark.createDataFrame(rows, "_from long, _last long")
    assert len(_day_ranges(cutoff, 1_000)) == 101
    found = _day_ranges(cutoff, 3)
    assert len(found) == 3 and found[0][0] == 0 and found[-1] == (5_000, 5_000)
    assert all(any(a <= low // 24 and high // 24 <= b for a, b in found) for low, high in rows[:-1])
    assert _day_ranges(cutoff.where("_from IS NULL")) == []


def test_newest_months_of_each_coin_alone_are_read(spark, tmp_path):
    """Files of months that no coin needs are no Parquet any more, but for the first, which tells the schema."""
    root = str(tmp_path / "silver")
    df = prices(spark)
    write_silver(df, root)
    want = {tuple(r) for r in top_rows(df, SERIES, 1_000).collect()}
    kept = {("stale", "2020-02"), ("stale", "2020-01"), ("stale", "2019-12"), ("fresh", "2024-01"), ("fresh", "2023-12"),
            ("fresh", "2023-11"), ("other", "2024-01"), ("other", "2023-12"), ("other", "2023-11")}
    counted = spark.read.parquet(root).groupBy("coin_id", "month").count().cache()      # footers are read for row counts
    counted.count()
    needed = settle(spark.createDataFrame(sorted(kept), "coin_id string, month string"))
    for path in sorted(Path(root).glob("coin_id=*/month=*/*.parquet"))[1:]:
        pair = (path.parent.parent.name[8:], path.parent.name[6:])
        if pair not in kept:
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
            path.write_bytes(b"x" * path.stat().st_size)
    got = {tuple(r) for r in top_rows(stored.read_months(spark, root, needed).drop("month"), SERIES, 1_000).collect()}
    assert got == want


def test_newest_candles_of_a_table(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = prices(spark)
    write_silver(df, root)
    for k in (1, 700, 100_000):
        found = stored.read_newest(spark, root, k)
        assert {tuple(r) for r in top_rows(found, SERIES, k).collect()} == {tuple(r) for r in top_rows(df, SERIES, k).collect()}
    assert stored.read_newest(spark, root, 1).count() < 3 * 800
