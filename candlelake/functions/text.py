"""Report labels. ``format_number`` rounds the exact binary value, half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(value: Column | str, digits: int, grouping: bool = True) -> Column:
    """A number with ``digits`` decimals, with or without thousands separators."""
    text = F.format_number(_col(value), digits)
    return text if grouping else F.replace(text, F.lit(","), F.lit(""))


def money(value: Column | str, digits: int) -> Column:
    return F.concat(F.lit("$"), fixed(value, digits))


def magnitude(value: Column | str) -> Column:
    """``$1.25B``, ``$500.00M`` or ``$10,500``; ``N/A`` when missing."""
    v = _col(value)
    billions = F.concat(F.lit("$"), fixed(v / 1e9, 2, grouping=False), F.lit("B"))
    millions = F.concat(F.lit("$"), fixed(v / 1e6, 2, grouping=False), F.lit("M"))
    return (
        F.when(v.isNull() | F.isnan(v.cast("double")), MISSING)
        .when(v >= 1e9, billions)
        .when(v >= 1e6, millions)
        .otherwise(money(v, 0))
    )


def rank_label(rank: Column | str) -> Column:
    """``#3``; ``N/A`` when the rank is missing or not a number."""
    number = _col(rank).cast("string").try_cast("double").try_cast("bigint")
    return F.coalesce(F.concat(F.lit("#"), number.cast("string")), F.lit(MISSING))


def ath_distance(price: Column | str, ath: Column | str) -> Column:
    """Percent below the all-time high; NULL when there is no positive high."""
    p, a = _col(price), _col(ath)
    return F.when(a > 0, (p - a) / a * 100)


def rsi_zone(rsi: Column | str) -> Column:
    """Zone of an RSI; a missing one counts as 50."""
    value = F.coalesce(_col(rsi), F.lit(50.0))
    return F.when(value > 70, "Overbought > 70").when(value < 30, "Oversold < 30").otherwise("Neutral")
