"""The feature table: candles with momentum, trend, volatility and return columns.

Every step maps a DataFrame to a DataFrame that keeps the candle columns, so steps can be
chosen by name and further ones added to ``STEPS``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions import indicators as ind
from candlelake.operators.blocks import Blocks, Series, cut
from candlelake.operators.ewm import carried, memory_rows, recursive_sum, seeded
from candlelake.operators.pace import deviations, paced, paced_window, rolling_mean, rolling_sum

CANDLES = Series("coin_id", "source_updated_at")

# Periods of the momentum and trend indicators.
RSI_ROWS = 14
# A state (``plans.increments``) keeps this many closes. Helper columns of series that go on from one: rows
# before the new ones, and on the last of them the averages up to there.
TAIL = ind.SLOW_SMA
OLD, CARRY = "_old", "_carry"
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9


def _span(n: int) -> float:
    return 2.0 / (n + 1)


def usable(candles: DataFrame) -> DataFrame:
    """Candles with a finite close."""
    return candles.where(ind.finite(F.col("close")).isNotNull())


def add_sma(df: DataFrame, blocks: Blocks) -> DataFrame:
    return rolling_mean(paced(df), blocks, F.col("close"), (ind.FAST_SMA, ind.SLOW_SMA), "sma")


def add_bands(df: DataFrame, blocks: Blocks, ddof: int = 0) -> DataFrame:
    close = F.col("close")
    df = deviations(df, blocks.window, close, ind.BAND_ROWS, ddof)
    return df.withColumns(ind.bands(close, F.col("_mean"), F.col("_std"))).drop("_mean", "_std")


def add_log_return(df: DataFrame, blocks: Blocks) -> DataFrame:
    return df.withColumn("log_ret", ind.log_return(F.col("close"), blocks.window))


def add_wilder_rsi(df: DataFrame, blocks: Blocks, n: int = RSI_ROWS, weighted_first: bool = False) -> DataFrame:
    """RSI over Wilder averages of gains and losses, NULL until ``n`` differences exist.

    The averages start as the first difference; with ``weighted_first`` it has the same
    weight as any other. A row without a change fades both averages alike and has the RSI of
    the row before it, so only rows with a change are worked out, and the rest repeat them.
    What happened before a block is carried into it; where no series has a second block and none
    goes on from a state, there is nothing to carry. ``_change`` stays: the averages as of the
    last change and its position.
    """
    alpha = 1.0 / n
    diff = F.col("_diff")
    share = alpha if weighted_first else 1.0
    own = blocks.owned & F.col("_diff").isNotNull() & (~F.col(OLD) if CARRY in blocks.inputs else F.lit(True))

    def moves(rows: DataFrame, order: WindowSpec) -> DataFrame:
        return rows.withColumn("_diff", ind.difference(F.col("close"), order)).withColumns({
            name: F.when(own, seeded(move(diff), move(diff) * share, 1, alpha)).otherwise(0.0)
            for name, move in (("_gain", ind.gain), ("_loss", ind.loss))})

    before = None
    if not blocks.single:
        before = carried(moves(blocks.df, blocks.window).where(blocks.owned), blocks, ["_gain", "_loss"], alpha, blocks.start)
    elif blocks.start is not None:
        before = blocks.start.select("_key", F.lit(0).cast("bigint").alias("_to"), F.col("_at").alias("_since"),
                                     F.col("_gain").alias("_from__gain"), F.col("_loss").alias("_from__loss"))
    df = moves(paced(df), paced_window(blocks))
    df = recursive_sum(df, blocks, {"_up": (F.col("_gain"), alpha), "_down": (F.col("_loss"), alpha)})
    up, down, arrived = F.col("_up"), F.col("_down"), None
    if before is not None:
        df = df.join(before, F.col(blocks.series.key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_to")), "left")
        fade = F.coalesce(F.exp((F.col("_since") - F.col("_pos")).cast("double") * -math.log1p(-alpha)), F.lit(0.0))
        up += F.coalesce("_from__gain", F.lit(0.0)) * fade
        down += F.coalesce("_from__loss", F.lit(0.0)) * fade
        arrived = F.when(F.col("_since").isNotNull(), F.struct(
            F.col("_since").alias("at"), F.col("_from__gain").alias("gain"), F.col("_from__loss").alias("loss")))
    so_far = paced_window(blocks).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_moved", F.when(own & (diff != 0), F.struct(
        F.col("_pos").alias("at"), up.alias("gain"), down.alias("loss"))))
    change = F.last("_moved", ignorenulls=True).over(so_far)
    df = df.withColumn("_change", change if arrived is None else F.coalesce(change, arrived))
    change = F.col("_change")
    rsi = F.when(blocks.pos >= n, F.try_divide(100 * change["gain"], change["gain"] + change["loss"]))
    return df.withColumn(f"rsi_{n}", rsi).drop(
        "_diff", "_gain", "_loss", "_up", "_down", "_moved", *(before.columns if before is not None else []))


def add_macd(df: DataFrame, blocks: Blocks, fast: int = MACD_FAST, slow: int = MACD_SLOW,
             signal: int = MACD_SIGNAL) -> DataFrame:
    """MACD line, its signal line and their difference; each average starts as a plain mean.

    A series that goes on from a state starts from its averages instead. ``_fast`` and ``_slow`` stay.
    """
    close, w = F.col("close"), paced_window(blocks)

    def started(name: str, u: Column) -> Column:
        if CARRY not in blocks.inputs:
            return u
        return F.when(F.col(CARRY)[name].isNotNull(), F.col(CARRY)[name]).when(F.col(OLD), 0.0).otherwise(u)

    df = paced(df).withColumns({"_seed_fast": ind.sma(close, fast, w), "_seed_slow": ind.sma(close, slow, w)})
    df = recursive_sum(df, blocks, {
        "_fast": (started("fast", seeded(close, F.col("_seed_fast"), fast - 1, _span(fast))), _span(fast)),
        "_slow": (started("slow", seeded(close, F.col("_seed_slow"), slow - 1, _span(slow))), _span(slow)),
    })
    line_start = slow - 1
    signal_start = line_start + signal - 1
    df = df.withColumn("macd", F.when(blocks.pos >= line_start, F.col("_fast") - F.col("_slow")))
    df = df.withColumn("_seed_line", ind.sma(F.col("macd"), signal, w))
    df = recursive_sum(df, blocks, {
        "_signal": (
            started("signal", seeded(F.col("macd"), F.col("_seed_line"), signal_start, _span(signal))), _span(signal),
        ),
    })
    df = df.withColumn("macd_signal", F.when(blocks.pos >= signal_start, F.col("_signal")))
    df = df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return df.drop("_seed_fast", "_seed_slow", "_seed_line", "_signal")


# The short frames come first: they share the order in which the blocks arrive.
STEPS: dict[str, Callable[[DataFrame, Blocks], DataFrame]] = {
    "bands": add_bands,
    "log_return": add_log_return,
    "sma": add_sma,
    "rsi": add_wilder_rsi,
    "macd": add_macd,
}

# How many earlier rows each step can still feel.
REACH = {
    "sma": ind.FEATURE_REACH,
    "bands": ind.BAND_ROWS,
    "log_return": 1,
    "rsi": 1,
    "macd": memory_rows(_span(MACD_SLOW)) + memory_rows(_span(MACD_SIGNAL)),
}


def add_features(candles: DataFrame, steps: Sequence[str] = tuple(STEPS), series: Series = CANDLES,
                 block_rows: int | None = None, averages: Column | None = None) -> DataFrame:
    """Append the chosen indicators to candles that have a close; one wide shuffle for all of them.

    ``averages`` is one more column of the result, made from what the steps leave: ``_change``, ``_fast``, ``_slow``.
    """
    blocks = cut(usable(candles), series, max(REACH[s] for s in steps), block_rows)
    if CARRY in candles.columns:      # stored closes come first, so the row with the averages is the one at TAIL - 1
        carry = F.col(CARRY)
        blocks = replace(blocks, start=candles.where(carry["gain"].isNotNull()).select(
            F.col(series.key).alias("_key"), (TAIL - 1 - carry["still"]).alias("_at"),
            carry["gain"].alias("_gain"), carry["loss"].alias("_loss")))
    df = blocks.df
    for name in STEPS:
        if name in steps:
            df = STEPS[name](df, blocks)
    return blocks.merge(df if averages is None else df.withColumn("averages", averages))


def _without_infinities(features: DataFrame) -> DataFrame:
    doubles = [f.name for f in features.schema.fields if f.dataType.simpleString() == "double"]
    return features.withColumns({c: ind.finite(F.col(c)) for c in doubles})


def drop_warm_up(features: DataFrame) -> DataFrame:
    """Drop each row that lacks any value, NaN and infinities counting as missing."""
    return _without_infinities(features).na.drop()


def warm_up_counts(features: DataFrame, key: str = "coin_id") -> DataFrame:
    """Rows per coin, and how many of them the warm-up drop leaves and takes."""
    rows = _without_infinities(features)
    complete = reduce(and_, [F.col(c).isNotNull() for c in rows.columns])
    n = F.count(F.lit(1))
    return rows.groupBy(key).agg(
        n.alias("rows_before"), F.count_if(complete).alias("rows_after"),
        (n - F.count_if(complete)).alias("rows_dropped"),
    )


def crosses(candles: DataFrame, series: Series = CANDLES, block_rows: int | None = None) -> DataFrame:
    """Rows where the 50-row mean crosses the 200-row mean.

    Sums are exact to ten decimal places of a price, and multiplied instead of divided.
    """
    fast, slow = ind.FAST_SMA, ind.SLOW_SMA
    blocks = cut(usable(candles), series, ind.FEATURE_REACH, block_rows)
    df = rolling_sum(paced(blocks.df), blocks, F.col("close").cast(ind.EXACT), (fast, slow), "_sum")
    means = F.col(f"_sum_{fast}") * F.lit(slow), F.col(f"_sum_{slow}") * F.lit(fast)
    df = df.withColumn("cross", ind.cross(*means, paced_window(blocks)))
    return blocks.merge(df).where(F.col("cross").isNotNull())
