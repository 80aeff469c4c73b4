"""Which archives should exist, and which are missing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.keys import coin_key

# First month of the archive, and the candle interval.
FIRST_MONTH = dt.date(2017, 8, 1)
INTERVAL = "1m"


def _expected(symbols: DataFrame, periods: Column, pattern: str, interval: str) -> DataFrame:
    days = symbols.select("symbol", F.explode(periods).alias("period"))
    name = F.format_string("%s-%s-%s.zip", "symbol", F.lit(interval), F.date_format("period", pattern))
    return days.select("symbol", coin_key("symbol").alias("coin_id"), "period", name.alias("file_name"))


def last_full_month(today: dt.date) -> dt.date:
    return (today.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def monthly(symbols: DataFrame, first: dt.date = FIRST_MONTH, last: dt.date | None = None,
            interval: str = INTERVAL) -> DataFrame:
    """One archive per symbol and month, by default up to the last full one."""
    last = last or last_full_month(dt.date.today())
    months = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH"))
    return _expected(symbols, months, "yyyy-MM", interval)


def daily(symbols: DataFrame, today: dt.date, interval: str = INTERVAL) -> DataFrame:
    """One archive per symbol and day, from the first of this month to yesterday."""
    first, last = today.replace(day=1), today - dt.timedelta(days=1)
    if last < first:
        return _expected(symbols, F.array().cast("array<date>"), "yyyy-MM-dd", interval)
    return daily_between(symbols, first, last, interval)


def daily_between(symbols: DataFrame, first: dt.date, last: dt.date, interval: str = INTERVAL) -> DataFrame:
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return _expected(symbols, days, "yyyy-MM-dd", interval)


def missing(expected: DataFrame, landed: DataFrame, on: list[str]) -> DataFrame:
    """Expected items that have not landed as a valid file."""
    return expected.join(landed.select(*on).distinct(), on, "left_anti")
