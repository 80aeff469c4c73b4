"""The shape of the plans: what is pushed down, how often rows are shuffled and sorted."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from candlelake.adapters import PRICES, candles, prices
from candlelake.operators.blocks import Series
from candlelake.operators.dedup import keep_last
from candlelake.operators.newest import since_newest
from candlelake.plans import features, summary
from candlelake.session import settle
from candlelake.sinks import tables as sinks
from candlelake.sources import tables as stored

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_prunes_the_scan_and_limits_before_the_shuffle(spark):
    text = plan(summary.summarize(prices(spark, SF_DIR), PRICES, keep=1))
    assert re.search(r"PushedFilters: \[Or\(GreaterThanOrEqual\(ts,", text)
    assert re.search(r"WindowGroupLimit.*row_number\(\), 15, Partial", text)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_all_features_share_one_shuffle_and_two_sorts(spark):
    table = settle(candles(spark, SF_DIR))
    text = plan(features.add_features(table))
    over_blocks = [line for line in text.splitlines() if "_block" in line]
    assert sum("Exchange hashpartitioning" in line for line in over_blocks) == 1
    assert sum("Sort [" in line for line in over_blocks) == 2
    assert "Python" not in text and "Pandas" not in text


def test_keep_last_sends_one_row_per_key_and_task(spark):
    text = plan(keep_last(prices(spark, SF_DIR), ["coin_id"], ["source_updated_at"]))
    assert re.search(r"WindowGroupLimit.*row_number\(\), 1, Partial", text)


def test_asset_scan_is_pruned_to_its_partitions(spark, tmp_path):
    sinks.write_silver(candles(spark, SF_DIR), str(tmp_path / "silver"))
    text = plan(stored.read_silver(spark, str(tmp_path / "silver"), ["click"]).select("close"))
    assert re.search(r"PartitionFilters: \[.*coin_id.*click", text) and "ReadSchema: struct<close:double>" in text


@pytest.mark.parametrize("name", ["price_correlation", "missing_archives", "hourly_matrix", "archive_inventory",
                                  "monthly_manifest", "signal_full_history", "metadata_enrich"])
def test_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_newest_rows_keep_short_series_whole(spark):
    df = spark.sql("""
        SELECT 'long' AS coin_id, timestamp_seconds(id * 90) AS source_updated_at, id FROM range(5000)
        UNION ALL SELECT 'short', timestamp_seconds(id * 90), id FROM range(3)
        UNION ALL SELECT 'short', CAST(NULL AS timestamp), -1L
        UNION ALL SELECT 'before 1970', timestamp_seconds(-100000 - id * 7), id FROM range(4000)""")
    series = Series("coin_id", "source_updated_at", ("id",))
    for k in (1, 4, 40):
        got = since_newest(df, series, k).groupBy("coin_id").count().collect()
        n = {r["coin_id"]: r["count"] for r in got}
        assert n["short"] == 4 if k > 3 else n["short"] >= k
        assert k <= n["long"] <= k + 80
        assert k <= n["before 1970"]
    newest = since_newest(df, series, 40).where("coin_id = 'long'").agg(F.max("id"), F.min("id")).first()
    assert newest[0] == 4999 and newest[1] <= 4960
