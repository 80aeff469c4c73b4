"""Features by increment equal those of a whole run."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlelake.plans import features, increments
from candlelake.sinks.features import changed_months, refresh_features
from candlelake.sinks.tables import merge_recent, overwrite_touched, write_silver
from candlelake.sources.tables import read_features

COLUMNS = ["rsi_14", "macd", "macd_signal", "macd_hist", "sma_50", "sma_200", "bb_lower", "bb_mid", "bb_upper", "bb_bandwidth",
           "bb_percent", "log_ret"]


def series(spark, seed, sizes=(("hot", 5_000), ("mid", 700), ("few", 150), ("late", 30)), step=4):
    """Prices some hours apart, with flat stretches: one over whole months, one from the very beginning."""
    rng = np.random.default_rng(seed)
    parts = []
    for coin, n in sizes:
        close = np.exp(np.cumsum(rng.normal(0, 0.02, n))) * 50
        if coin == "hot":
            close[n // 4:n // 2] = close[n // 4]
        if coin == "mid":
            close[:300] = 7.0
        hours = step * np.arange(n) + (20_000 if coin == "late" else 0)
        parts.append(pd.DataFrame({"coin_id": coin, "hours": hours, "close": close}))
    return spark.createDataFrame(pd.concat(parts)).select(
        "coin_id", F.timestamp_micros(F.col("hours") * 3_600_000_000 + 1_577_836_800_000_000).alias("source_updated_at"),
        "close", (F.col("close") * 2).alias("volume"))


def table(df):
    return df.toPandas().sort_values(["coin_id", "source_updated_at"]).reset_index(drop=True)


def assert_same(got, want):
    got, want = table(got), table(want)
    assert len(got) == len(want) and (got["coin_id"] == want["coin_id"]).all()
    assert (got["source_updated_at"] == want["source_updated_at"]).all()
    for c in [*COLUMNS, "close", "volume"]:
        np.testing.assert_allclose(got[c], want[c], rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("seed,block_rows", [(1, None), (2, 2_500)])
def test_random_cuts_equal_the_whole_run(spark, seed, block_rows):
    """The series continued at random months from states, each part by itself."""
    df = series(spark, seed).cache()
    want = features.add_features(df)
    months = sorted(r[0] for r in df.select(increments.month_of()).distinct().collect())
    rng = np.random.default_rng(seed)
    cuts = [*sorted(rng.choice(months[1:], 3, replace=False).tolist()), "9999"]
    before, parts, low = spark.createDataFrame([], increments.STATE), [], ""
    for high in cuts:
        month = increments.month_of()
        part = df.where((month >= low) & (month < high))
        rich = increments.continue_features(part, before, block_rows).cache()
        parts.append(rich.drop("averages"))
        after = increments.states_after(rich, before).collect()
        known = {r["coin_id"]: r for r in sorted([*before.collect(), *after], key=lambda r: r["month"])}
        before, low = spark.createDataFrame([tuple(r[c] for c in ("coin_id", "month", "n_rows", "tail", "averages"))
                                             for r in known.values()], increments.STATE), high
    got = parts[0]
    for p in parts[1:]:
        got = got.unionByName(p)
    assert_same(got, want)
    assert {r["coin_id"]: r["n_rows"] for r in before.collect()} == {"hot": 5_000, "mid": 700, "few": 150, "late": 30}
    assert all(len(r["tail"]) == min(r["n_rows"], increments.TAIL) for r in before.collect())


def roots(tmp_path):
    return (f"{tmp_path}/{name}" for name in ("silver", "gold", "states"))


def test_refresh_reads_only_new_months_and_repairs_late_ones(spark, tmp_path):
    silver, gold, states = roots(tmp_path)
    df = series(spark, 5, (("hot", 1_400), ("mid", 1_200)), 3).cache()
    late = (F.col("coin_id") == "mid") & F.col("source_updated_at").between("2020-02-10", "2020-02-12")
    early = F.col("source_updated_at") < "2020-05-11"
    write_silver(df.where(early & ~late), silver)
    refresh_features(spark, silver, gold, states)
    assert changed_months(spark, silver, states).isEmpty()
    refresh_features(spark, silver, gold, states)

    # months before the state that is gone on from are not opened: their files are no Parquet any more
    saved = {}
    for path in Path(silver).glob("coin_id=*/month=2020-0[2-4]/*.parquet"):
        saved[path] = path.read_bytes()
        times = path.stat()
        path.write_bytes(b"x" * len(saved[path]))
        os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert len(saved) == 6
    new = df.where(~early)
    july = spark.read.parquet(silver).where("month = '2020-05'").drop("month")
    overwrite_touched(_held(july.unionByName(new)), silver)
    assert {r["month"] for r in changed_months(spark, silver, states).collect()} >= {"2020-05", "2020-06"}
    refresh_features(spark, silver, gold, states)
    want = features.drop_warm_up(features.add_features(df.where(~late)))
    assert_same(read_features(spark, gold), want)

    for path, data in saved.items():
        times = path.stat()
        path.write_bytes(data)
        os.utime(path, ns=(times.st_atime_ns, times.st_mtime_ns))
    merge_recent(silver, df.where(late))
    assert [tuple(r) for r in changed_months(spark, silver, states).collect()] == [("mid", "2020-02")]
    refresh_features(spark, silver, gold, states)
    assert_same(read_features(spark, gold), features.drop_warm_up(features.add_features(df)))


def _held(df):
    """The rows of ``df`` in memory, so that the files they come from can be replaced."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def test_a_killed_run_is_worked_out_again(spark, tmp_path, monkeypatch):
    from candlelake.sinks import features as sink

    silver, gold, states = roots(tmp_path)
    df = series(spark, 6, (("mid", 900),), 2)
    write_silver(df, silver)

    def killed(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "states_after", killed)
        with pytest.raises(RuntimeError):
            refresh_features(spark, silver, gold, states)
    assert changed_months(spark, silver, states).count() == 3
    refresh_features(spark, silver, gold, states)
    assert_same(read_features(spark, gold), features.drop_warm_up(features.add_features(df)))


def test_empty_candles_give_nothing(spark):
    none = series(spark, 1).limit(0)
    rich = increments.continue_features(none, spark.createDataFrame([], increments.STATE))
    assert rich.count() == 0 and increments.states_after(rich, spark.createDataFrame([], increments.STATE)).count() == 0
