"""Stored roll-ups of prices: counts, means and squared deviations by hour, merged to any longer period.

A summary of a set of prices is ``n_rows``, ``n`` (prices that are there), ``mean`` and ``m2``, the sum of
squared distances from the mean. Summaries of parts merge to that of the whole: the mean by counts, and
``m2`` as the parts' sum plus the distances of the parts' means, without the loss of digits that sums of
squares have. The table has one partition per day, and a refresh replaces only the days it is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.operators.blocks import Series
from candlelake.sources.tables import read_or_empty

SUMMARY = "n_rows bigint, n bigint, mean double, m2 double"


def hourly(df: DataFrame, series: Series, price: str = "current_price") -> DataFrame:
    """One summary per asset and hour; rows without a price count in ``n_rows`` only."""
    hour = F.date_trunc("HOUR", F.col(series.ts).cast("timestamp"))
    return df.groupBy(series.key, hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(price).alias("n"), F.avg(price).alias("mean"),
        F.coalesce(F.var_pop(price) * F.count(price), F.lit(0.0)).alias("m2"))


def merged(summaries: DataFrame, period: Column, key: str = "coin_id") -> DataFrame:
    """Summaries per asset and ``period``, from those of any parts of it; a window holds the parts of one period."""
    parts = summaries.withColumn("period", period)
    whole = Window.partitionBy(key, "period")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), F.sum("n").over(whole))
    apart = F.col("mean") - F.col("whole_mean")
    return parts.withColumn("whole_mean", mean).groupBy(key, "period").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.first("whole_mean").alias("mean"),
        F.sum(F.col("m2") + F.coalesce(F.col("n") * apart * apart, F.lit(0.0))).alias("m2"))


def averages(summaries: DataFrame, period: str, key: str = "coin_id") -> DataFrame:
    """Mean and sample deviation per asset and day, month or other period, from hourly summaries."""
    rows = merged(summaries, F.date_trunc(period, F.col("hour")), key)
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return rows.select(key, "period", F.col("mean").alias("avg_price"), deviation.alias("std_price"), "n_rows")


def refresh_rollup(df: DataFrame, root: str, series: Series, price: str = "current_price") -> None:
    """Replace the stored summaries of the days in ``df``, which has all rows of these days; no other day is touched."""
    rows = hourly(df, series, price).withColumn("day", F.date_format("hour", "yyyy-MM-dd"))
    (
        rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("day").parquet(root)
    )


def read_rollup(spark: SparkSession, root: str, first_day: str | None = None, key: str = "coin_id") -> DataFrame:
    """The stored summaries, from ``first_day`` on; earlier days' files are not read."""
    table = read_or_empty(spark, root, f"{key} string, hour timestamp, {SUMMARY}, day string")
    return (table if first_day is None else table.where(F.col("day") >= first_day)).drop("day")
