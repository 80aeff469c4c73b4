"""Audits: missing intervals in a series, and the outcome of a feature run per coin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.functions.indicators import SLOW_SMA
from candlelake.operators.blocks import COARSE_BITS, Series, bucketed, cut
from candlelake.session import settle

# Fixed value: a longer step than this is a gap in one-minute candles.
GAP_MINUTES = 2
BUCKET_ROWS = 4_096        # rows of a time bucket whose times are collected


def time_steps(df: DataFrame, series: Series, block_rows: int | None = None) -> DataFrame:
    """Each distinct time, its number of rows ``n``, and the microseconds since the time before it.

    Rows of one time are no step apart, so they are counted before anything is ordered.
    """
    plain = Series(series.key, series.ts)
    times = settle(df.groupBy(series.key, series.ts).agg(F.count(F.lit(1)).alias("n")), "times")
    blocks = cut(times, plain, 1, block_rows)
    micros = F.unix_micros(F.col(series.ts).cast("timestamp"))
    return blocks.merge(blocks.df.withColumn("step_us", micros - F.lag(micros).over(blocks.window)))


def _summaries(rows: DataFrame, key: str, threshold_us: int) -> DataFrame:
    """One row per time bucket: what its own rows say, with first and last time for merging.

    A bucket's times are collected as a set, so copies shrink on the map side; buckets are of bounded size.
    """
    buckets = rows.groupBy(key, "_bits", "_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count("_us").alias("timed"), F.sort_array(F.collect_set("_us")).alias("t"))
    buckets = buckets.withColumn("steps", F.zip_with(
        F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))),
        lambda later, earlier: later - earlier))
    after = F.filter(F.zip_with("steps", F.slice("t", 2, F.size("steps")), lambda s, at: F.when(s > threshold_us, at)),
                     lambda at: at.isNotNull())
    return buckets.select(
        key, F.shiftright(F.get("t", F.lit(0)), COARSE_BITS).alias("_coarse"), "n", (F.col("timed") > F.size("t")).alias("repeats"),
        F.get("t", F.lit(0)).alias("first"), F.try_element_at("t", F.lit(-1)).alias("last"), F.array_max("steps").alias("longest"),
        F.size(after).cast("bigint").alias("gaps"), F.get(after, F.lit(0)).alias("first_gap"))


def _merged(summaries: DataFrame, by: list[str], threshold_us: int) -> DataFrame:
    """Summaries of neighbouring stretches of a series as one per ``by``: the steps between them count too."""
    before = F.max("last").over(Window.partitionBy(*by).orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    rows = summaries.withColumn("step", F.col("first") - before)
    gap = F.col("step") > threshold_us
    return rows.groupBy(*by).agg(
        F.sum("n").alias("n"), F.max("repeats").alias("repeats"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max(F.greatest("longest", "step")).alias("longest"), (F.sum("gaps") + F.count_if(gap)).alias("gaps"),
        F.min(F.least("first_gap", F.when(gap, F.col("first")))).alias("first_gap"))


def continuity(df: DataFrame, series: Series, threshold_minutes: int = GAP_MINUTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per series: rows, number of gaps, longest step, and the first time that follows a gap.

    A step of exactly the threshold is not a gap. Rows are never ordered as a series: times meet in small
    buckets, and buckets are merged in order, first within about 38 hours, then over the series.
    """
    limit = threshold_minutes * 60_000_000
    found = _summaries(bucketed(df, series, bucket_rows), series.key, limit)
    found = _merged(_merged(found, [series.key, "_coarse"], limit), [series.key], limit)
    at = F.timestamp_micros("first_gap").cast(df.schema[series.ts].dataType)
    return found.select(
        series.key, F.col("n").alias("n_rows"), F.col("gaps").alias("n_gaps"),
        (F.coalesce("longest", F.when(F.col("repeats"), 0)) / 1e6).alias("max_step_seconds"), at.alias("first_gap_at"))


def outcomes(wanted: DataFrame, candles: DataFrame, key: str = "coin_id", warm_up: int = SLOW_SMA) -> DataFrame:
    """Per wanted coin: ``ok``, ``short history`` (nothing left after the warm-up) or ``no data``."""
    counts = candles.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    status = F.when(n == 0, "no data").when(n < warm_up, "short history").otherwise("ok")
    return wanted.select(key).distinct().join(counts, key, "left").select(
        key, n.alias("n_rows"), status.alias("status")
    )


def outcome_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n_coins"))
