"""The compacted live table equals the stream's rows, whatever happens to a compaction."""

from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from candlelake.sources import live
from candlelake.streaming import candles, compaction


def message(minute, coin="BTCUSDT", close=1.5):
    t = 1_704_067_200_000 + minute * 60_000
    return json.dumps({"k": {"s": coin, "t": t, "o": "1", "h": "2", "l": "0.5", "c": str(close), "v": "10", "x": True}})


def land(tmp_path, name, rows):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_text("\n".join(rows))


def stream(spark, tmp_path, checkpoint="ck", **trigger):
    rows = live.stream_messages(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    rows = candles.clean_candles(candles.closed_candles(rows))
    return compaction.append_batches(rows, str(tmp_path / "live"), str(tmp_path / checkpoint), **trigger)


def table(spark, root):
    return sorted((r["coin_id"], r["source_updated_at"].day, r["source_updated_at"].hour * 60 + r["source_updated_at"].minute, r["close"])
                  for r in compaction.read_compacted(spark, root).collect())


def files(root, part):
    return sorted(p for p in (Path(root) / part).rglob("*.parquet"))


def test_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "live")
    assert compaction.compact(spark, root) == -1 and compaction.remove_superseded(spark, root) == 0
    assert compaction.read_compacted(spark, root).count() == 0
    for i in range(6):      # batches overlap by ten minutes, and the later close counts; two coins, days 1 and 2
        land(tmp_path, f"{i}.txt", [message(m + 1_380 * (i > 3), coin, i) for m in range(i * 10, i * 10 + 20)
                                    for coin in ("BTCUSDT", "ETHUSDT")])
        time.sleep(0.01)
    stream(spark, tmp_path).awaitTermination()
    want = table(spark, root)
    assert len(want) == 2 * (50 + 30) and len(files(root, "arrivals")) >= 6

    # killed before the list is written: readers see what they saw, and nothing is doubled or lost when it is run again
    real = compaction.keep_last
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "coalesce", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            compaction.compact(spark, root)
    assert real is compaction.keep_last and files(root, "days") and not files(root, "list")
    assert table(spark, root) == want
    assert compaction.compact(spark, root) == 0
    assert table(spark, root) == want
    assert compaction.compact(spark, root) == 0      # the newest batch may still be written
    assert compaction.compact(spark, root, stopped=True) == 1
    assert compaction.compact(spark, root, stopped=True) == 1 and table(spark, root) == want

    # files are bounded by coins and days
    assert compaction.remove_superseded(spark, root) > 0
    assert len(files(root, "days")) == 4 and not files(root, "arrivals") and len(files(root, "list")) == 1
    assert table(spark, root) == want
    day_1 = {p for p in files(root, "days") if "day=2024-01-01" in str(p)}

    # a new checkpoint starts its batches from 0 again; only the days it touches are written anew
    (tmp_path / "in").rename(tmp_path / "old")
    land(tmp_path, "late.txt", [message(1_500, close=99), message(2_900, close=3)])
    stream(spark, tmp_path, "other").awaitTermination()
    assert compaction.compact(spark, root, stopped=True) == 2
    compaction.remove_superseded(spark, root)
    assert day_1 <= set(files(root, "days"))
    changed = [w for w in want if w[:3] != ("btc", 2, 60)] + [("btc", 2, 60, 99.0), ("btc", 3, 20, 3.0)]
    assert table(spark, root) == sorted(changed)


def test_a_stream_that_keeps_listening(spark, tmp_path):
    land(tmp_path, "a.txt", [message(0)])
    query = stream(spark, tmp_path, processingTime="200 milliseconds")
    try:
        for _ in range(300):
            if files(str(tmp_path / "live"), "arrivals"):
                break
            time.sleep(0.1)
        assert query.isActive
        land(tmp_path, "b.txt", [message(1), message(1, "ETHUSDT")])
        for _ in range(300):
            if compaction.read_compacted(spark, str(tmp_path / "live")).count() == 3:
                break
            time.sleep(0.1)
        assert query.isActive and compaction.read_compacted(spark, str(tmp_path / "live")).count() == 3
    finally:
        query.stop()


def test_rows_without_pair_or_time_are_set_aside(spark, tmp_path):
    land(tmp_path, "a.txt", [message(0), message(1).replace("1704067260000", "null"), message(2, "USDT"),
                             message(3).replace("1704067380000", "99999999999999999"), message(4, "x").replace('"x", "t"', '"", "t"')])
    buffer = candles.closed_candles(live.stream_messages(spark, "text", path=str(tmp_path / "in")))
    candles.append_rejected(candles.rejected_candles(buffer), str(tmp_path / "aside"), str(tmp_path / "ck")).awaitTermination()
    got = {r["reason"]: r["n"] for r in spark.read.json(str(tmp_path / "aside")).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert got == {"no time": 1, "no pair": 2, "time out of range": 1}
    candles.append_candles(candles.clean_candles(buffer), str(tmp_path / "out"), str(tmp_path / "ck2")).awaitTermination()
    assert candles.read_live(spark, str(tmp_path / "out")).count() == 1
