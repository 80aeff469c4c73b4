"""Indicators with finite frames, as window columns.

``w`` is any window ordered by time: over a whole bounded series, or over a block of one
(``operators.blocks``). ``pos`` is the row's 0-based position in its series. Each function
names how many earlier rows it needs; a block must reach at least that far back.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Periods of the market summary and of the feature table.
SMA_ROWS = 7
RSI_ROWS = 14
VOLATILITY_ROWS = 7
BAND_ROWS = 20
BAND_WIDTH = 2.0
FAST_SMA = 50
SLOW_SMA = 200

EXACT = "decimal(28,10)"        # prices as sums need them where the sign of a difference decides

SUMMARY_REACH = RSI_ROWS        # 13 rows of differences, and one more for the first difference
FEATURE_REACH = SLOW_SMA + 1    # the rows of the slow average, and one more for the cross


def _last(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, 0)


def difference(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def sma(x: Column, n: int, w: WindowSpec) -> Column:
    """Mean of the last ``n`` rows, of fewer at the head of the series."""
    return F.avg(x).over(_last(w, n))


def volatility(diff: Column, n: int, w: WindowSpec) -> Column:
    """Sample deviation of the last ``n`` differences."""
    return F.stddev_samp(diff).over(_last(w, n))


def gain(diff: Column) -> Column:
    return F.when(diff > 0, diff).otherwise(F.lit(0.0))


def loss(diff: Column) -> Column:
    return F.when(diff < 0, -diff).otherwise(F.lit(0.0))


def simple_rsi(diff: Column, n: int, w: WindowSpec) -> Column:
    """RSI over plain means of the last ``n`` rows; 100 when nothing was lost."""
    up = F.avg(gain(diff)).over(_last(w, n))
    down = F.avg(loss(diff)).over(_last(w, n))
    return F.when(down == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.try_divide(up, down)))


def signal(price: Column, average: Column, rsi: Column) -> Column:
    return (
        F.when((price < average) & (rsi < 30), "BUY")
        .when((price > average) & (rsi > 70), "SELL")
        .otherwise("WAIT")
    )


def bands(x: Column, mean: Column, std: Column, width: float = BAND_WIDTH) -> dict[str, Column]:
    """Bollinger bands: lower, middle, upper, bandwidth in percent of the middle, and %B."""
    spread = std * width
    return {
        "bb_lower": mean - spread,
        "bb_mid": mean,
        "bb_upper": mean + spread,
        "bb_bandwidth": F.try_divide(100 * (2 * spread), mean),
        "bb_percent": F.try_divide(x - (mean - spread), 2 * spread),
    }


def log_return(x: Column, w: WindowSpec) -> Column:
    """``ln(x / previous x)``; NULL where that is not a finite number."""
    return F.ln(F.try_divide(x, F.lag(x).over(w)))


def finite(x: Column) -> Column:
    """NULL in place of NaN and the infinities."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def cross(fast: Column, slow: Column, w: WindowSpec) -> Column:
    """``golden`` where the fast average rises above the slow one, ``death`` where it falls below.

    Equal is not above, so both should be exact.
    """
    above = fast > slow
    was_above = F.lag(above).over(w)
    return F.when(above & ~was_above, "golden").when(~above & was_above, "death")
