"""Keeps the stored feature table up to date with the stored candles, month by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.plans.features import drop_warm_up
from candlelake.plans.increments import STATE, continue_features, states_after
from candlelake.session import settle
from candlelake.sinks.tables import LAYOUT, overwrite_touched
from candlelake.sources.tables import read_months, stored_months


def changed_months(spark: SparkSession, silver: str, states: str) -> DataFrame:
    """Coins and months whose candles were written after their state, or that have no state, from file listings."""
    done = stored_months(spark, states).withColumnRenamed("written_at", "done_at")
    stale = F.col("done_at").isNull() | (F.col("written_at") >= F.col("done_at"))
    return stored_months(spark, silver).join(done, LAYOUT, "left").where(stale).select(*LAYOUT)


def _states_before(spark: SparkSession, states: str, first: DataFrame) -> DataFrame:
    """One state per coin in ``first``: the newest of a month before ``from_month``."""
    known = stored_months(spark, states).join(first, "coin_id").where(F.col("month") < F.col("from_month"))
    newest = settle(known.groupBy("coin_id").agg(F.max("month").alias("month")), "newest-states")
    if newest.isEmpty():
        return spark.createDataFrame([], STATE)
    return settle(read_months(spark, states, newest), "states-before")


def refresh_features(spark: SparkSession, silver: str, gold: str, states: str, changed: DataFrame | None = None,
                     block_rows: int | None = None) -> None:
    """Bring the feature table ``gold`` and its ``states`` up to date with the candles in ``silver``.

    ``changed`` are coins and months with new candles; without it they are found by the times of the files.
    Read are the candles from each coin's first changed month on, and one state per coin. Those months are
    replaced, the states last: a run that was killed leaves months without a newer state, and the next one
    works them out again. The first run, without any state, works out everything.
    """
    changed = settle(changed_months(spark, silver, states) if changed is None else changed, "changed-months")
    if changed.isEmpty():
        return
    first = changed.groupBy("coin_id").agg(F.min("month").alias("from_month"))
    wanted = stored_months(spark, silver).join(first, "coin_id").where(F.col("month") >= F.col("from_month"))
    candles = read_months(spark, silver, settle(wanted.select(*LAYOUT), "wanted-months")).drop("month")
    before = _states_before(spark, states, first)
    rich = settle(continue_features(candles, before, block_rows), "features")
    overwrite_touched(drop_warm_up(rich.drop("averages")), gold)
    (
        states_after(rich, before).hint("rebalance", *LAYOUT).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).parquet(states)
    )
