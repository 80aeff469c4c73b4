"""Archives, dedup, merge, stored tables."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from candlelake.functions.keys import clean_file_name, coin_key, epoch_to_time, symbol_of_path
from candlelake.plans import klines, manifest, quality
from candlelake.operators.blocks import Series
from candlelake.sinks import tables as sinks
from candlelake.sources import archives
from candlelake.sources import tables as stored

MS = 1_704_067_200_000      # 2024-01-01 00:00 UTC


def line(t, close=1.5, n=12):
    return ",".join(str(x) for x in [t, 1, 2, 0.5, close, 10, t + 59_999, 15.0, 7, 5, 7.5, 0][:n])


def keyed(key):
    return line(MS).replace(str(MS), key, 1)


def put(folder, name, text, member=None):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr(member or name.replace(".zip", ".csv"), text)


@pytest.fixture()
def lake(tmp_path):
    month, day = tmp_path / "monthly", tmp_path / "daily"
    btc = month / "btc"
    put(btc, "BTCUSDT-1m-2024-01.zip", "\n".join(line(MS + i * 60_000) for i in range(5)) + "\n")
    put(btc, "BTCUSDT-1m-2024-02.zip", line(MS + 4 * 60_000, close=9.0) + "\n\n" + line(MS + 5 * 60_000) + "\n")
    put(btc, "BTCUSDT-1m-2024-03.zip", line(MS, n=11))
    put(btc, "BTCUSDT-1m-2024-04.zip", "open_time," + line(MS, n=11) + "\n" + line(MS))
    put(btc, "BTCUSDT-1m-2024-05.zip", line(MS), member="other.csv")
    (btc / "BTCUSDT-1m-2024-06.zip").write_bytes(b"this is no archive")
    (btc / "BTCUSDT-1m-2024-07.zip").write_bytes(b"")
    micros = [(MS + i * 60_000) * 1000 for i in (5, 6)]
    put(day / "btc", "BTCUSDT-1m-2024-01-02.zip", "\n".join(line(t, close=7.0) for t in micros))
    put(day / "eth", "ETHUSDT-1m-2024-01-02.zip", line(MS))
    return str(month), str(day)


def test_scan_quarantine_and_merge(spark, lake):
    month, day = lake
    lines = archives.read_archives(spark, month)
    errors = {r["path"][-6:-4]: r["error"] for r in klines.quarantine(lines).collect()}
    assert set(errors) == {"03", "04", "05", "06", "07"} and "no bytes" in errors["07"]
    assert "12 columns" in errors["03"] and "numeric" in errors["04"] and "not a zip" in errors["06"]
    history = klines.history(lines)
    rows = {r["source_updated_at"].minute: r for r in history.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 5]
    assert rows[4]["close"] == 9.0 and rows[0]["trades"] == 7      # the later file wins
    daily = klines.type_lines(archives.read_archives(spark, day), source=klines.DAILY)
    merged = klines.gap_fill(history, daily)
    got = {(r["coin_id"], r["source_updated_at"].minute): r["close"] for r in merged.collect()}
    assert len(got) == 7 and got["btc", 5] == 7.0 and got["btc", 6] == 7.0       # no eth: it has no history
    again = klines.gap_fill(merged, daily)
    assert sorted(again.drop("processed_at").collect()) == sorted(merged.drop("processed_at").collect())


def test_one_minute_can_be_short_of_values(spark, tmp_path):
    put(tmp_path / "a", "AUSDT-1m-2024-01.zip", line(MS) + "\n" + f"{MS + 60_000},1,2\n")
    rows = klines.history(archives.read_archives(spark, str(tmp_path))).orderBy("source_updated_at").collect()
    assert [r["close"] for r in rows] == [1.5, None]


def test_keys_are_whole_numbers_or_the_file_is_rejected(spark, tmp_path):
    keys = [f"{MS}.0", f" {MS + 60_000}.", f"{(MS + 120_000) / 1e3:.3f}e3", str(MS + 180_000), f"+{MS + 240_000}"]
    put(tmp_path, "AUSDT-1m-2024-01.zip", "\r\n".join(keyed(k) for k in keys))
    put(tmp_path, "BUSDT-1m-2024-01.zip", line(MS) + "\n" + keyed(f"{MS}.5"))
    put(tmp_path, "CUSDT-1m-2024-01.zip", line(MS) + "\n" + keyed(""))
    put(tmp_path, "oddname.zip", line(MS))
    (tmp_path / "DUSDT-1m-2024-01.zip").write_bytes(b"")
    lines = archives.read_archives(spark, str(tmp_path))
    rows = klines.history(lines).collect()
    assert sorted((r["coin_id"], r["source_updated_at"].minute) for r in rows) == [("a", m) for m in range(5)]
    errors = {r["path"].rsplit("/", 1)[1]: r["error"] for r in klines.quarantine(lines).collect()}
    assert {k[0]: v.split(": ")[1] for k, v in errors.items()} == {
        "B": "first column is not numeric", "C": "first column is not numeric", "D": "no bytes", "o": "no pair in the name"}


def test_keys_that_are_no_time_reject_the_file(spark, tmp_path):
    """20 digits fit no bigint, and a 13-digit key above 9,223,372,036,854 is later than any time."""
    bad = ["99999999999999999999", "9223372036855", "-99999999999999", "9e18", "9223372036854776", "1e40"]
    good = [str(MS), f"{MS}000", "0", "9223372036854", "9223372036854775", "-1000", "0001704067200000"]
    for name, keys in (("B", bad), ("G", good)):
        for i, key in enumerate(keys):
            put(tmp_path / name, f"{name}{i}USDT-1m-2024-01.zip", line(MS).replace(str(MS), key, 1))
    errors = klines.quarantine(archives.read_archives(spark, str(tmp_path / "B"))).collect()
    assert len(errors) == len(bad) and all("out of range" in r["error"] for r in errors)
    lines = archives.read_archives(spark, str(tmp_path / "G"))
    assert klines.quarantine(lines).count() == 0
    rows = klines.history(lines).select(F.col("source_updated_at").isNull().alias("none")).collect()
    assert len(rows) == len(good) and not any(r["none"] for r in rows)


def test_a_long_member_comes_in_pieces(tmp_path):
    put(tmp_path, "AUSDT-1m-2024-01.zip", "\n".join(line(MS + i * 60_000) for i in range(300_000)))
    archive, member = archives._open(str(tmp_path / "AUSDT-1m-2024-01.zip"), (tmp_path / "AUSDT-1m-2024-01.zip").read_bytes())
    sizes = [len(p) for p in archives._pieces(archive, member)]
    assert sum(sizes) == 300_000 and max(sizes) < 200_000


def test_inventory_and_missing(spark, lake):
    month, _ = lake
    landed = archives.inventory(spark, month).where("error IS NULL")
    import datetime as dt

    symbols = spark.createDataFrame([("BTCUSDT",)], "symbol string")
    expected = manifest.monthly(symbols, dt.date(2024, 1, 1), dt.date(2024, 7, 1))
    lost = manifest.missing(expected, landed, ["file_name"]).collect()
    assert sorted(r["file_name"][-6:-4] for r in lost) == ["05", "06", "07"]
    assert manifest.daily(symbols, dt.date(2024, 1, 1)).count() == 0
    assert manifest.daily(symbols, dt.date(2024, 1, 31)).count() == 30
    assert manifest.monthly(symbols, last=dt.date(2026, 12, 1)).count() == 9 * 12 + 5
    assert manifest.last_full_month(dt.date(2024, 1, 31)) == dt.date(2023, 12, 1)


def candles(spark, rows):
    df = spark.createDataFrame(rows, "coin_id string, minute int, close double")
    t = F.timestamp_seconds(F.col("minute") * 60 + 1_704_067_200)
    return df.select("coin_id", t.alias("source_updated_at"), *[F.col("close").alias(c) for c in
                     ("open", "high", "low", "close", "volume", "quote_asset_vol")],
                     F.lit(1).cast("bigint").alias("trades"), t.alias("processed_at"))


def test_merge_rewrites_touched_months_only(spark, tmp_path):
    root = str(tmp_path / "silver")
    feb = 40 * 24 * 60
    sinks.write_silver(candles(spark, [("btc", 0, 1.0), ("btc", feb, 2.0), ("eth", 0, 3.0)]), root)
    before = {r[0] for r in spark.read.parquet(root).select("_metadata.file_path").distinct().collect()}
    sinks.merge_recent(root, candles(spark, [("btc", feb, 5.0), ("btc", feb + 1, 6.0), ("sol", 0, 9.0)]))
    after = {r[0] for r in spark.read.parquet(root).select("_metadata.file_path").distinct().collect()}
    assert len(before & after) == 2
    late = candles(spark, [("btc", feb, 7.0), ("btc", feb + 2, 8.0)])
    sinks.merge_recent(root, late, source=klines.LIVE)
    got = {(r["coin_id"], r["close"]) for r in stored.read_candles(spark, root).collect()}
    assert got == {("btc", 1.0), ("btc", 5.0), ("btc", 6.0), ("btc", 8.0), ("eth", 3.0)}
    sinks.append_new_coins(candles(spark, [("btc", 7, 8.0), ("sol", 0, 9.0)]), root)
    assert [r[0] for r in stored.discover_assets(spark, root).collect()] == ["btc", "eth", "sol"]
    assert stored.read_candles(spark, root, ["sol"]).count() == 1
    assert stored.read_candles(spark, str(tmp_path / "nothing")).count() == 0


def test_keys_and_times(spark):
    row = spark.range(1).select(
        coin_key(F.lit("BTCUSDT")).alias("a"), symbol_of_path(F.lit("file:/x/btc/BTCUSDT-1m-2024-01-02.zip")).alias("b"),
        epoch_to_time(F.lit(MS)).alias("c"), epoch_to_time(F.lit(MS * 1000)).alias("d"),
        clean_file_name(F.lit("raw_prices_1.json")).alias("e")).first()
    assert (row["a"], row["b"], row["e"]) == ("btc", "BTCUSDT", "clean_prices_1.parquet")
    assert row["c"] == row["d"]


def test_continuity(spark):
    df = candles(spark, [("a", m, 1.0) for m in (0, 1, 2, 3)] + [("b", m, 1.0) for m in (0, 1, 3, 4, 10)] + [("c", 0, 1.0)])
    out = {r["coin_id"]: r for r in quality.continuity(df, Series()).collect()}
    assert (out["a"]["n_gaps"], out["a"]["max_step_seconds"], out["a"]["first_gap_at"]) == (0, 60, None)
    assert (out["b"]["n_gaps"], out["b"]["max_step_seconds"], out["b"]["n_rows"]) == (1, 360, 5)
    assert out["b"]["first_gap_at"].minute == 10
    assert out["c"]["n_gaps"] == 0 and out["c"]["max_step_seconds"] is None


def test_outcomes(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("z",)], "coin_id string")
    df = candles(spark, [("a", m, 1.0) for m in range(5)] + [("b", 0, 1.0)])
    status = quality.outcomes(wanted, df, warm_up=5)
    assert {(r["coin_id"], r["status"]) for r in status.collect()} == {
        ("a", "ok"), ("b", "short history"), ("z", "no data")}
