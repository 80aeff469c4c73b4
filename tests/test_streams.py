"""Streams give what the batch plans give, and survive a restart."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from candlelake.plans import snapshots, summary
from candlelake.sources import live
from candlelake.sources import snapshots as snapshot_source
from candlelake.streaming import candles, snapshots as snapshot_stream


def message(minute, closed=True, symbol="BTCUSDT"):
    t = 1_704_067_200_000 + minute * 60_000
    return json.dumps({"k": {"s": symbol, "t": t, "o": "1", "h": "2", "l": "0.5", "c": "1.5", "v": "10", "x": closed}})


def run_candles(spark, tmp_path):
    stream = live.stream_messages(spark, "text", path=str(tmp_path / "in"))
    rows = candles.clean_candles(candles.closed_candles(stream))
    candles.append_candles(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    return candles.read_live(spark, str(tmp_path / "out"))


def test_live_candles(spark, tmp_path):
    (tmp_path / "in").mkdir()
    first = [message(0), message(0), message(1, closed=False), '{"result":null,"id":1}', message(0, symbol="ETHUSDT"), "no json"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(first))
    rows = run_candles(spark, tmp_path).collect()
    assert sorted((r["coin_id"], r["close"], r["volume"]) for r in rows) == [("btc", 1.5, 10.0), ("eth", 1.5, 10.0)]
    # A restart goes on with new files only; a repeat from before it is still known.
    (tmp_path / "in" / "b.txt").write_text("\n".join([message(0), message(1)]))
    rows = run_candles(spark, tmp_path).collect()
    assert sorted((r["coin_id"], r["source_updated_at"].minute) for r in rows) == [("btc", 0), ("btc", 1), ("eth", 0)]


def test_a_feed_that_lags_loses_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, (symbol, days) in enumerate((("BTCUSDT", 1), ("BTCUSDT", 0), ("ETHUSDT", 0))):
        rows = [message(days * 1440 + minute, symbol=symbol) for minute in range(300)]
        (tmp_path / "in" / f"{n}.txt").write_text("\n".join(rows))
        out = run_candles(spark, tmp_path)
    assert {(r["coin_id"], r["count"]) for r in out.groupBy("coin_id").count().collect()} == {("btc", 600), ("eth", 300)}


def record(i, coin="bitcoin"):
    return {"id": coin, "symbol": coin[:3], "name": coin, "current_price": 100 + (i * 7) % 13,
            "last_updated": f"2024-01-{1 + i // 24:02d}T{i % 24:02d}:00:00Z", "ingested_timestamp": "2024-02-01T00:00:00Z"}


def test_state_equals_batch(spark, tmp_path):
    landed = tmp_path / "raw"
    landed.mkdir()
    clean_root, state_root, alerts = (str(tmp_path / n) for n in ("clean", "state", "alerts"))

    def run():
        files = snapshot_source.stream_snapshots(spark, str(landed))
        snapshot_stream.clean_arrivals(files, clean_root, str(tmp_path / "ck1")).awaitTermination()
        snapshot_stream.carry_state(
            snapshot_stream.stream_clean(spark, clean_root), state_root, str(tmp_path / "ck2"), keep=1_000, alerts=alerts,
        ).awaitTermination()

    for n, span in enumerate((range(0, 30), range(20, 60), range(60, 61))):
        rows = [record(i, c) for i in span for c in ("bitcoin", "ethereum")]
        (landed / f"raw_prices_{n}.json").write_text(json.dumps(rows))
        run()
    got = snapshot_stream.read_state(spark, state_root)
    everything = snapshots.clean(snapshot_source.read_snapshots(spark, str(landed)))
    want = summary.summarize(everything, keep=1_000, distinct="key")
    pick = ["coin_id", "source_updated_at", "current_price", "sma_7d", "rsi_14d", "volatility_7d", "signal"]
    assert sorted(got.select(*pick).na.fill(-1).collect()) == sorted(want.select(*pick).na.fill(-1).collect())
    sent = spark.read.text(alerts).where("value LIKE '%SIGNAL DETECTED%'").count()
    assert sent == summary.summarize(everything, keep=1_000, distinct="key").where("signal <> 'WAIT'").count()
    assert got.count() == 122 and got.where(F.col("analyzed_at").isNull()).count() == 0


def test_a_replayed_batch_gives_the_same_state(spark, tmp_path):
    """Running a batch again reads the same earlier version, so nothing is counted twice."""
    landed = tmp_path / "raw"
    landed.mkdir()
    clean_root, state_root = str(tmp_path / "clean"), str(tmp_path / "state")
    for n in range(2):
        (landed / f"raw_prices_{n}.json").write_text(json.dumps([record(i) for i in range(n * 10, n * 10 + 10)]))
        files = snapshot_source.stream_snapshots(spark, str(landed))
        snapshot_stream.clean_arrivals(files, clean_root, str(tmp_path / "ck1")).awaitTermination()
        snapshot_stream.carry_state(
            snapshot_stream.stream_clean(spark, clean_root), state_root, str(tmp_path / "ck2")).awaitTermination()
    before = snapshot_stream.read_state(spark, state_root).drop("analyzed_at").collect()
    # Forget that batch 1 was committed, as if the job had died just before.
    commit = tmp_path / "ck2" / "commits" / "1"
    commit.unlink()
    (tmp_path / "ck2" / "commits" / ".1.crc").unlink(missing_ok=True)
    snapshot_stream.carry_state(
        snapshot_stream.stream_clean(spark, clean_root), state_root, str(tmp_path / "ck2")).awaitTermination()
    after = snapshot_stream.read_state(spark, state_root).drop("analyzed_at").collect()
    assert sorted(before, key=str) == sorted(after, key=str) and len(after) == 20
    # A new checkpoint can start from the state of an old one.
    moved = str(tmp_path / "moved")
    snapshot_stream.carry_state(
        snapshot_stream.stream_clean(spark, clean_root), moved, str(tmp_path / "ck3"), keep=30,
        initial=snapshot_stream.read_state(spark, state_root)).awaitTermination()
    assert snapshot_stream.read_state(spark, moved).count() == 20


def test_a_batch_writes_only_the_state_of_its_coins(spark, tmp_path):
    landed = tmp_path / "raw"
    landed.mkdir()
    clean_root, root = str(tmp_path / "clean"), tmp_path / "state"
    coins = ["bitcoin", "ethereum", "solana", "ripple", "cardano"]

    def run(n, rows, **trigger):
        (landed / f"raw_prices_{n}.json").write_text(json.dumps(rows))
        files = snapshot_source.stream_snapshots(spark, str(landed))
        snapshot_stream.clean_arrivals(files, clean_root, str(tmp_path / "ck1")).awaitTermination()
        snapshot_stream.carry_state(snapshot_stream.stream_clean(spark, clean_root), str(root), str(tmp_path / "ck2"),
                                    keep=30).awaitTermination()

    def files():
        return {p: p.stat().st_mtime_ns for p in (root / "state").rglob("*.parquet")}

    run(0, [record(i, c) for i in range(20) for c in coins])
    first = files()
    for n in (1, 2, 3):
        run(n, [record(20 + 15 * n + i) for i in range(15)])
    kept = files()
    part = spark.range(1).select(snapshot_stream.part_of(F.lit("bitcoin"))).first()[0]
    others = {p for p in first if f"part={part}/" not in str(p)}
    assert others and all(kept[p] == first[p] for p in others)
    assert {p for p in kept if p not in first and f"part={part}/" not in str(p)} == set()
    # of the coin's own versions the newest two stay, and the lists of them
    assert len({p.parent.parent.name for p in kept if f"part={part}/" in str(p)}) == 2
    assert sorted(p.name for p in (root / "list").iterdir() if p.name.startswith("version")) == ["version=2", "version=3"]
    state = snapshot_stream.read_state(spark, str(root))
    assert {(r["coin_id"], r["count"]) for r in state.groupBy("coin_id").count().collect()} == {
        (c, 30 if c == "bitcoin" else 20) for c in coins}


def test_streams_of_snapshots_can_keep_listening(spark, tmp_path):
    import time

    landed = tmp_path / "raw"
    landed.mkdir()
    clean_root, root = str(tmp_path / "clean"), str(tmp_path / "state")
    (landed / "raw_prices_0.json").write_text(json.dumps([record(0)]))
    cleaning = snapshot_stream.clean_arrivals(snapshot_source.stream_snapshots(spark, str(landed)), clean_root,
                                              str(tmp_path / "ck1"), processingTime="300 milliseconds")
    carrying = None
    try:
        for n in (1, 2):
            for _ in range(600):
                if carrying is None and any((tmp_path / "clean").rglob("*.parquet")):
                    carrying = snapshot_stream.carry_state(snapshot_stream.stream_clean(spark, clean_root), root,
                                                           str(tmp_path / "ck2"), processingTime="300 milliseconds")
                if carrying is not None and snapshot_stream.read_state(spark, root).count() == n:
                    break
                time.sleep(0.1)
            assert snapshot_stream.read_state(spark, root).count() == n and cleaning.isActive and carrying.isActive
            (landed / f"raw_prices_{n}.json").write_text(json.dumps([record(n)]))
    finally:
        for query in (cleaning, carrying):
            if query is not None:
                query.stop()
