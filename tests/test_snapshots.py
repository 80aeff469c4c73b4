"""Snapshot cleaning, metadata, reports."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.functions import text
from candlelake.operators.blocks import Series
from candlelake.operators.correlation import correlation_matrix
from candlelake.plans import metadata, reporting, snapshots
from candlelake.schemas import PROVIDER_IDS, PROVIDER_RECORD, SNAPSHOT
from candlelake.sources import metadata as metadata_source
from candlelake.sources import snapshots as snapshot_source
from candlelake.sources.tables import read_or_empty

def record(name, symbol, price, total, most, **more):
    """A market record; the valuation is left out unless given."""
    return {"id": name, "symbol": symbol, "name": name.title(), "current_price": price, "market_cap": price * total,
            "market_cap_rank": 7, "total_volume": 1234.5, "high_24h": price + 1, "low_24h": price - 1,
            "price_change_percentage_24h": 0.4, "circulating_supply": total - 5, "total_supply": total,
            "max_supply": most, "ath": price * 3, "ath_change_percentage": -66.6, "ath_date": "2022-02-03T04:05:06Z",
            "last_updated": "2024-05-06T07:08:09Z", "ingested_timestamp": "2024-05-06T07:10:00Z", **more}


RECORDS = [record("alphacoin", "alp", 40, 250, 300, fully_diluted_valuation=11111), record("betacoin", "bet", 8, 600, None)]


def test_clean(spark, tmp_path):
    (tmp_path / "raw_prices_1.json").write_text(json.dumps(RECORDS + RECORDS[:1], indent=4))
    (tmp_path / "raw_prices_2.json").write_text(json.dumps([{"id": "alphacoin", "current_price": 40}]))
    out = snapshots.clean(snapshot_source.read_snapshots(spark, str(tmp_path)))
    rows = {(r["coin_id"], r["ingested_file"]): r for r in out.collect()}
    assert len(rows) == 3
    alpha, beta = rows["alphacoin", "raw_prices_1.json"], rows["betacoin", "raw_prices_1.json"]
    assert alpha["fully_diluted_valuation"] == 40 * 300 and beta["fully_diluted_valuation"] == 8 * 600
    assert beta["max_supply"] is None and alpha["current_price"] == 40
    assert rows["alphacoin", "raw_prices_2.json"]["fully_diluted_valuation"] is None
    assert set(out.columns) == {part.split()[0] for part in SNAPSHOT.split(", ")}


def test_no_input(spark, tmp_path):
    assert snapshots.clean(snapshot_source.read_snapshots(spark, str(tmp_path))).count() == 0
    empty = read_or_empty(spark, str(tmp_path / "none"), SNAPSHOT)
    assert empty.count() == 0 and len(empty.columns) == 21


def test_metadata(spark, tmp_path):
    full = {"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "links": {"homepage": ["https://a", ""]},
            "description": {"en": "text"}, "categories": ["x"], "image": {"large": "i"}, "genesis_date": "2009-01-03"}
    bare = {"id": "thing", "symbol": "t", "name": "Thing", "links": {"homepage": []}, "genesis_date": None}
    (tmp_path / "a.json").write_text(json.dumps({"BTCUSDT": full, "TUSDT": bare}, indent=4))
    (tmp_path / "b.json").write_text("{ not json")
    docs = metadata_source.read_documents(spark, str(tmp_path), PROVIDER_RECORD)
    rows = {r["pair"]: r for r in metadata.extract(docs).collect()}
    assert rows["BTCUSDT"]["homepage"] == "https://a" and rows["BTCUSDT"]["description"] == "text"
    bare_row = rows["TUSDT"]
    assert (bare_row["homepage"], bare_row["description"], bare_row["categories"], bare_row["image"]) == ("", "", [], "")
    stored = metadata.extract(docs).select(F.col("pair").alias("symbol"), "description")
    ids = metadata.id_map(spark)
    assert ids.count() == len(PROVIDER_IDS) == 59
    pairs = spark.createDataFrame([("BTCUSDT",), ("TUSDT",), ("NOUSDT",)], "symbol string")
    assert {r[0] for r in metadata.still_needed(pairs, stored).collect()} == {"TUSDT", "NOUSDT"}
    assert {r[0] for r in metadata.unmapped(pairs, ids).collect()} == {"TUSDT", "NOUSDT"}


@pytest.mark.parametrize("value,label", [
    (None, "N/A"), (float("nan"), "N/A"), (1.25e9, "$1.25B"), (5e8, "$500.00M"), (10500.0, "$10,500"), (0.4, "$0"),
    (1234.5e9, "$1234.50B"), (-5.0, "$-5"), (2.5, "$2"), (1e6, "$1.00M"),
])
def test_magnitude(spark, value, label):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(text.magnitude("x")).first()[0] == label


def test_rank_and_zone(spark):
    df = spark.createDataFrame([("3", 71.0), ("2.0", 29.9), ("x", 70.0), (None, None)], "r string, rsi double")
    got = [tuple(r) for r in df.select(text.rank_label("r"), text.rsi_zone("rsi")).collect()]
    assert got == [("#3", "Overbought > 70"), ("#2", "Oversold < 30"), ("N/A", "Neutral"), ("N/A", "Neutral")]


SERIES = Series("coin_id", "source_updated_at")


def price_frame(spark, n_coins=7, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n_coins):
        for _ in range(40):
            rows.append((f"c{c:02d}", int(rng.integers(0, 72 * 3600)), float(rng.uniform(1, 9)) if c else 4.0))
    df = spark.createDataFrame(rows, "coin_id string, s bigint, current_price double")
    return df.select("coin_id", F.timestamp_seconds(F.col("s") + 1_704_067_200).alias("source_updated_at"), "current_price")


def expected_hours(df) -> pd.DataFrame:
    pdf = df.toPandas()
    wide = pdf.pivot_table(index="source_updated_at", columns="coin_id", values="current_price")
    return wide.resample("h").mean().ffill().bfill()


def test_hourly_prices(spark):
    df = price_frame(spark)
    want = expected_hours(df)
    got = reporting.wide_prices(reporting.hourly_prices(df, SERIES), list(want.columns)).toPandas()
    got = got.sort_values("hour").set_index("hour")
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


@pytest.mark.parametrize("tile_assets", [256, 2])
def test_correlation(spark, tile_assets):
    df = price_frame(spark)
    want = expected_hours(df).corr()
    out = correlation_matrix(reporting.hourly_prices(df, SERIES), tile_assets=tile_assets).toPandas()
    got = out.pivot(index="c1", columns="c2", values="corr")
    assert out.shape[0] == 49
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(), atol=1e-12)
    assert got.loc["c00"].isna().all()        # its price never moves


def test_one_asset_has_no_correlation(spark):
    df = price_frame(spark, 1)
    assert correlation_matrix(reporting.hourly_prices(df, SERIES)).count() == 0


def test_reports(spark):
    df = price_frame(spark)
    assert [r[0] for r in reporting.assets(df).collect()] == [f"c{i:02d}" for i in range(7)]
    with pytest.raises(ValueError, match="source_updated_at"):
        reporting.require(df.drop("source_updated_at"), "source_updated_at")
    latest = reporting.latest_metrics(df, SERIES).collect()
    assert len(latest) == 7 and latest[0]["rank_label"] == "N/A" and latest[0]["signal"] == "WAIT"
    assert latest[0]["rsi_label"] == "50.0" and latest[0]["ath_label"] == "N/A"
    assert reporting.select_assets(df, ["C01"]).select("coin_id").distinct().count() == 1
    assert reporting.select_assets(df, ["all"]).count() == df.count()
