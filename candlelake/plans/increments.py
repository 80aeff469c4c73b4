"""The feature table by increment: new months are worked out from a small stored state, not from all history.

A state is one row per coin and month, as of that month's last candle: how many candles the series has, its
newest ``TAIL`` closes, and the recursive averages, which are gain and loss as of the last change, the fast
and the slow average, and the signal line. Finite frames need no more than the closes, and the averages go
on from the stored ones, so a month's features depend on the month's candles and the state before it only.

A late or corrected candle changes its own month and all later ones of its coin; those are worked out again,
from the state of the month before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.operators.newest import ranked_rows
from candlelake.plans.features import CARRY, OLD, TAIL, add_features

AVERAGES = "struct<gain: double, loss: double, still: bigint, fast: double, slow: double, signal: double>"
STATE = (f"coin_id string, month string, n_rows bigint, tail array<struct<source_updated_at: timestamp, close: double>>, "
         f"averages {AVERAGES}")


def month_of(ts: str = "source_updated_at") -> Column:
    return F.date_format(ts, "yyyy-MM")


def _last_averages() -> Column:
    change = F.col("_change")
    return F.struct(
        change["gain"].alias("gain"), change["loss"].alias("loss"), (F.col("_pos") - change["at"]).alias("still"),
        F.col("_fast").alias("fast"), F.col("_slow").alias("slow"), F.col("macd_signal").alias("signal"))


def _goes_on() -> Column:
    """Whether a state holds only the end of its series, so that its averages are needed; a series with no more
    closes than ``TAIL`` is kept whole and worked out from its beginning."""
    return F.col("n_rows") > TAIL


def with_tails(candles: DataFrame, before: DataFrame) -> DataFrame:
    """``candles`` and, in front of each coin's, the closes of its state; with ``OLD``, ``CARRY`` and ``_stored``.

    ``OLD`` marks stored closes of series that go on, ``_stored`` all stored closes.
    """
    tails = before.select("coin_id", "n_rows", F.size("tail").alias("_size"), "averages", F.posexplode("tail").alias("_at", "_row"))
    last = _goes_on() & (F.col("_at") == F.col("_size") - 1)
    tails = tails.select("coin_id", "_row.*", F.lit(True).alias("_stored"), _goes_on().alias(OLD),
                         F.when(last, F.col("averages")).alias(CARRY))
    time = candles.schema["source_updated_at"].dataType
    tails = tails.withColumn("source_updated_at", F.col("source_updated_at").cast(time))
    new = candles.withColumns({"_stored": F.lit(False), OLD: F.lit(False), CARRY: F.lit(None).cast(AVERAGES)})
    return new.unionByName(tails, allowMissingColumns=True)


def continue_features(candles: DataFrame, before: DataFrame, block_rows: int | None = None) -> DataFrame:
    """All features of ``candles``, whose coins go on from the states ``before`` (at most one row per coin).

    Every candle must be later than its coin's state. Besides the features there are ``averages`` after each candle.
    """
    rich = add_features(with_tails(candles, before), block_rows=block_rows, averages=_last_averages())
    return rich.where(~F.col("_stored")).drop("_stored", OLD, CARRY)


def states_after(rich: DataFrame, before: DataFrame) -> DataFrame:
    """The states at the end of each coin and month of ``rich``, the result of ``continue_features``.

    Closes are ranked per coin and month before the shuffle, so a task sends at most ``TAIL`` of them; the
    window over months holds one row per coin and month.
    """
    ts = "source_updated_at"
    rows = rich.withColumn("month", month_of())
    ends = rows.groupBy("coin_id", "month").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("averages", ts).alias("averages"))
    key = rows.withColumn("_coin_month", F.struct("coin_id", "month"))
    newest = ranked_rows(key.select("_coin_month", ts, "close"), Series("_coin_month", ts), TAIL)
    tails = newest.groupBy("_coin_month").agg(F.sort_array(F.collect_list(F.struct(F.col(ts).cast("timestamp").alias(ts), "close"))).alias("tail"))
    months = ends.join(tails.select("_coin_month.*", "tail"), ["coin_id", "month"])
    months = months.unionByName(before.select("coin_id", F.lit("").alias("month"), F.col("n_rows").alias("n"), "averages", "tail"))
    by_coin = Window.partitionBy("coin_id").orderBy("month")
    # every month has a candle, so this many months hold more closes than a tail
    closes = F.flatten(F.collect_list("tail").over(by_coin.rowsBetween(1 - TAIL, 0)))
    total = F.sum("n").over(by_coin.rowsBetween(Window.unboundedPreceding, 0))
    found = months.withColumns({"n_rows": total, "closes": closes}).where(F.col("month") != "")
    keep = F.least(F.size("closes"), F.lit(TAIL))
    return found.select("coin_id", "month", "n_rows", F.slice("closes", F.size("closes") - keep + 1, keep).alias("tail"), "averages")
