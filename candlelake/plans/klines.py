"""Candle cleaning: typed rows from archives, keep-last dedup, gap-fill merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.keys import coin_key, epoch_to_time, number, symbol_of_path, whole_number
from candlelake.operators.dedup import keep_last
from candlelake.schemas import KLINE_COLUMNS, KLINE_FIELDS
from candlelake.session import settle

# Later sources win: live candles, then the stored history, then the published daily files.
LIVE, MASTER, DAILY = 0, 1, 2

ORDER = ["_source", "_file", "_line"]
KEYS = ["coin_id", "source_updated_at"]


def quarantine(lines: DataFrame) -> DataFrame:
    """Rejected files and why; each adds no rows to the clean table."""
    return lines.where(F.col("error").isNotNull()).select("path", "error")


def type_lines(lines: DataFrame, processed_at: Column | None = None, source: int = MASTER) -> DataFrame:
    """Candles from the text fields of good files, with the columns that decide which copy is last."""
    texts = lines.where(F.col("error").isNull()).withColumn("_fields", F.split("line", ","))
    whole = {"open_time_ms", "close_time_ms", "trades"}
    fields = texts.select("path", "line_no", *[
        (whole_number if name in whole else number)(F.get("_fields", F.lit(i))).alias(name)
        for i, name in enumerate(KLINE_FIELDS)
    ])
    now = F.current_timestamp() if processed_at is None else processed_at
    return fields.select(
        coin_key(symbol_of_path("path")).alias("coin_id"),
        epoch_to_time("open_time_ms").alias("source_updated_at"),
        "open", "high", "low", "close", "volume", "quote_asset_vol", "trades",
        now.alias("processed_at"),
        F.lit(source).alias("_source"),
        F.element_at(F.split("path", "/"), -1).alias("_file"),
        F.col("line_no").alias("_line"),
    )


def _ranked(df: DataFrame, source: int) -> DataFrame:
    """Rows of a stored table: unique already, so the source alone ranks them."""
    if "_source" in df.columns:
        return df
    return df.withColumns({"_source": F.lit(source), "_file": F.lit(""), "_line": F.lit(0).cast("bigint")})


def history(lines: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The clean history of a set of archives: the last copy of each coin and time."""
    typed = type_lines(lines, processed_at, MASTER)
    return keep_last(typed, KEYS, ORDER).select(*KLINE_COLUMNS)


def gap_fill(master: DataFrame, recent: DataFrame, require_history: bool = True,
             recent_source: int = DAILY) -> DataFrame:
    """History and recent rows in one table; the later source wins where both have a time.

    Coins that have no history yet are left out unless ``require_history`` is off.
    """
    recent = _ranked(recent, recent_source)
    if require_history:
        known = settle(master.select("coin_id").distinct(), "known-coins")
        recent = recent.join(known, "coin_id", "left_semi")
    both = _ranked(master, MASTER).unionByName(recent)
    return keep_last(both, KEYS, ORDER).select(*master.columns)


def live_candles(buffer: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Candles of the live buffer in the shape of the clean table."""
    now = F.current_timestamp() if processed_at is None else processed_at
    return buffer.select(
        coin_key("symbol").alias("coin_id"),
        epoch_to_time("open_time_ms").alias("source_updated_at"),
        "open", "high", "low", "close", "volume",
        F.lit(None).cast("double").alias("quote_asset_vol"),
        F.lit(None).cast("bigint").alias("trades"),
        now.alias("processed_at"),
    )
