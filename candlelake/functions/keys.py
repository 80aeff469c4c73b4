"""Keys and times derived from raw fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The quote currency in a pair's name, the largest 13-digit epoch, and the last time (in
# microseconds, year 2262) and minus it the first one (1677) that count as such.
QUOTE = "USDT"
LARGEST_MILLIS = 9_999_999_999_999
LARGEST_TIME = 9_223_372_036_854_775


def coin_key(symbol: Column | str) -> Column:
    """``BTCUSDT`` to ``btc``."""
    text = F.col(symbol) if isinstance(symbol, str) else symbol
    return F.lower(F.replace(text, F.lit(QUOTE), F.lit("")))


def symbol_of_path(path: Column | str) -> Column:
    """The pair named at the start of an archive file, ``.../BTCUSDT-1m-2024-01.zip``."""
    text = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(text, r"([^/]+?)-\w+-\d{4}-\d{2}(?:-\d{2})?\.zip$", 1)


def epoch_to_time(epoch: Column | str) -> Column:
    """Epoch of 13 digits or fewer is in milliseconds, a longer one in microseconds; NULL before 1677 and after 2262."""
    number = F.col(epoch) if isinstance(epoch, str) else epoch
    micros = (number > LARGEST_MILLIS) & (number <= LARGEST_TIME)
    millis = number.between(-(LARGEST_TIME // 1_000), LARGEST_TIME // 1_000)
    return F.when(micros, F.timestamp_micros(number)).when(millis, F.timestamp_millis(number))


def number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def whole_number(text: Column) -> Column:
    """A whole number however it is written, ``5``, ``5.0`` or ``5e0``; NULL where there is a fraction."""
    exact = F.trim(text).try_cast("decimal(38,9)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def clean_file_name(raw: Column | str) -> Column:
    """Name of the clean file that a raw snapshot file becomes."""
    text = F.col(raw) if isinstance(raw, str) else raw
    text = F.replace(text, F.lit("raw_"), F.lit("clean_"))
    return F.replace(text, F.lit(".json"), F.lit(".parquet"))
