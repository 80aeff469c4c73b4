"""The newest rows of each series, without sorting or shuffling the older ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.session import settle

HOUR = 3_600_000_000
RANGES = 32             # ranges of days that prune a scan
MINUTE = 60_000_000


def _day_ranges(cutoff: DataFrame, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of days that hold all hours from ``_from`` to ``_last`` of every series, in order.

    Where there would be more than ``most``, those with the least between them are joined. All windows here
    are over days, one row each, however many series there are.
    """
    days = cutoff.where(F.col("_from").isNotNull()).groupBy(F.floor(F.col("_from") / 24).alias("low")).agg(
        F.floor(F.max("_last") / 24).alias("high"))
    order = Window.orderBy("low")
    gap = F.col("low") - F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("gap", gap)
    wide = F.row_number().over(Window.orderBy(F.desc_nulls_last("gap"), "low")) < most
    days = days.withColumn("cut", F.when((F.col("gap") > 1) & wide, 1).otherwise(0))
    found = days.withColumn("range", F.sum("cut").over(order)).groupBy("range").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).orderBy("low")
    return [(r["low"], r["high"]) for r in found.collect()]


def since_newest(df: DataFrame, series: Series, k: int) -> DataFrame:
    """Rows that can be among the newest ``k`` of their series, copies included.

    Each minute that has rows holds at least one distinct time, so the hours that hold the
    newest ``k`` such minutes hold at least ``k`` distinct times. The minutes of an hour are
    marked as bits of one number: the pass reads two columns and shuffles one row per
    series and hour. The wide rows are then only filtered.
    """
    us = F.unix_micros(F.col(series.ts).cast("timestamp"))
    hour = F.floor(us / HOUR)
    timed = df.select(series.key, hour.alias("_hour"), F.floor(F.pmod(us, F.lit(HOUR)) / MINUTE).alias("_minute"))
    marks = timed.groupBy(series.key, "_hour").agg(
        F.expr("bit_or(shiftleft(1L, CAST(_minute AS INT)))").alias("_marks")
    )
    newest_first = Window.partitionBy(series.key).orderBy(F.desc("_hour")).rowsBetween(Window.unboundedPreceding, 0)
    counted = marks.withColumn("_minutes", F.sum(F.bit_count("_marks")).over(newest_first))
    full = F.max(F.when(F.col("_minutes") >= k, F.col("_hour")))
    cutoff = settle(
        counted.groupBy(F.col(series.key).alias("_key")).agg(
            F.coalesce(full, F.min("_hour")).alias("_from"), full.isNull().alias("_short"), F.max("_hour").alias("_last"),
        ),
        "cutoff",
    )
    # Constant ranges of days prune the scan itself: the years between a series that ended and the others are no part.
    ranges = _day_ranges(cutoff)
    if ranges:
        kind, ts = df.schema[series.ts].dataType, F.col(series.ts)

        def day(number: int) -> Column:
            return F.timestamp_micros(F.lit(number * 24 * HOUR)).cast(kind)

        inside = (ts >= day(ranges[-1][0])) | ts.isNull()
        for low, high in ranges[:-1]:
            inside = inside | ((ts >= day(low)) & (ts < day(high + 1)))
        df = df.where(inside)
    same = F.col(series.key).eqNullSafe(F.col("_key"))
    # A series with fewer minutes than k is kept whole, rows without a time included.
    recent = (hour >= F.col("_from")) | (F.col("_short") & hour.isNull())
    return df.join(cutoff, same).where(recent).drop("_key", "_from", "_short", "_last")


def ranked_rows(df: DataFrame, series: Series, k: int) -> DataFrame:
    """Exactly the newest ``k`` rows per series with their ``_rank``, the newest being 1.

    The rank filter is applied on both sides of the shuffle, so each task sends at most
    ``k`` rows of a series, however hot that series is.
    """
    conf, name = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(name)) < k:      # above it Spark would send whole series through the shuffle
        conf.set(name, str(k))
    w = Window.partitionBy(series.key).orderBy(*[F.desc(c) for c in (series.ts, *series.ties)])
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)


def top_rows(df: DataFrame, series: Series, k: int) -> DataFrame:
    return ranked_rows(df, series, k).drop("_rank")


def latest_row(df: DataFrame, series: Series) -> DataFrame:
    """The last row of each series by time."""
    return top_rows(df, series, 1)
