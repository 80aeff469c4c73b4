"""Report tables: latest metrics, hourly prices, averages per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.functions import text
from candlelake.operators.blocks import Series
from candlelake.operators.newest import latest_row, since_newest


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail before planning when a column is missing."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing column(s): {', '.join(absent)}")
    return df


def name_column(df: DataFrame) -> str:
    """Assets are picked by symbol where there is one, else by coin id."""
    return "symbol" if "symbol" in df.columns else "coin_id"


def assets(df: DataFrame, column: str | None = None) -> DataFrame:
    """The assets of a table, sorted."""
    c = column or name_column(df)
    return df.select(c).distinct().orderBy(c)


def select_assets(df: DataFrame, names: Sequence[str], column: str = "coin_id") -> DataFrame:
    """Rows of the named assets; ``all`` selects everything."""
    if "all" in names:
        return df
    return df.where(F.col(column).isin([n.lower() for n in names]))


def asset_history(df: DataFrame, name: str, ts: str = "source_updated_at") -> DataFrame:
    """One asset's rows, newest first."""
    require(df, ts)
    return df.where(F.col(name_column(df)) == name).orderBy(F.desc(ts))


def latest_metrics(summary: DataFrame, series: Series) -> DataFrame:
    """The header figures of each asset's latest row.

    Figures a summary does not have count as the defaults: signal WAIT, RSI 50, volatility 0.
    """
    require(summary, series.ts, "current_price")
    latest = latest_row(since_newest(summary, series, 1), series)
    have = set(latest.columns)

    def get(name: str, default: Column) -> Column:
        return F.col(name) if name in have else default

    ath = get("ath", F.lit(None).cast("double"))
    rsi = get("rsi_14d", F.lit(50.0))
    down = text.ath_distance("current_price", ath)
    return latest.select(
        series.key, series.ts,
        text.rank_label(get("market_cap_rank", F.lit(None).cast("int"))).alias("rank_label"),
        text.money("current_price", 4).alias("price_label"),
        F.when(ath > 0, text.money(ath, 2)).otherwise(text.MISSING).alias("ath_label"),
        down.alias("ath_distance"),
        F.when(ath > 0, F.concat(text.fixed(down, 1, grouping=False), F.lit("%"))).alias("ath_distance_label"),
        get("signal", F.lit("WAIT")).alias("signal"),
        text.fixed(F.coalesce(rsi, F.lit(50.0)), 1, grouping=False).alias("rsi_label"),
        text.rsi_zone(rsi).alias("rsi_zone"),
        text.fixed(get("volatility_7d", F.lit(0.0)), 2, grouping=False).alias("volatility_label"),
        text.magnitude(get("market_cap", F.lit(0.0))).alias("market_cap_label"),
        text.magnitude(get("fully_diluted_valuation", F.lit(0.0))).alias("fdv_label"),
    )


def mean_prices(df: DataFrame, series: Series, price: str = "current_price") -> DataFrame:
    """Mean price per time and asset."""
    return df.groupBy(series.ts, series.key).agg(F.avg(price).alias(price))


def hourly_prices(df: DataFrame, series: Series, price: str = "current_price") -> DataFrame:
    """Mean price per hour and asset over all hours from the first to the last of the table.

    An hour without a price takes the one before it, and at the head of a series the first
    one after it. Each hourly mean is stretched to the next hour that has one, so no grid of
    hours has to be joined. A window holds one row per hour of an asset, which the calendar
    bounds.
    """
    priced = df.where(F.col(price).isNotNull())
    hour = F.date_trunc("HOUR", F.col(series.ts).cast("timestamp"))
    hourly = (
        mean_prices(priced, series, price)
        .groupBy(F.col(series.key), hour.alias("hour")).agg(F.avg(price).alias(price))
    )
    first, last = priced.agg(F.unix_micros(F.min(hour)), F.unix_micros(F.max(hour))).first()
    w = Window.partitionBy(series.key).orderBy("hour")
    one = F.expr("INTERVAL 1 HOUR")
    is_first = F.row_number().over(w) == 1
    start = F.when(is_first, F.timestamp_micros(F.lit(first))).otherwise(F.col("hour"))
    end = F.coalesce(F.lead("hour").over(w) - one, F.timestamp_micros(F.lit(last)))
    return (
        hourly.withColumns({"_start": start, "_end": end})
        .select(series.key, F.explode(F.sequence("_start", "_end", one)).alias("hour"), price)
    )


def names(hourly: DataFrame, most: int, key: str = "coin_id") -> list[str]:
    """The assets of a table, sorted; an error where there are more than ``most``."""
    found = [r[key] for r in hourly.select(key).distinct().orderBy(key).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} assets")
    return found


def wide_prices(hourly: DataFrame, names: Sequence[str], key: str = "coin_id",
                price: str = "current_price") -> DataFrame:
    """One column per named asset."""
    return hourly.groupBy("hour").pivot(key, list(names)).agg(F.first(price))


def period_average(df: DataFrame, period: str, series: Series, price: str = "current_price") -> DataFrame:
    """Mean and sample deviation of prices per asset and day, month or other period."""
    start = F.date_trunc(period, F.col(series.ts).cast("timestamp"))
    return df.groupBy(series.key, start.alias("period")).agg(
        F.avg(price).alias("avg_price"),
        F.stddev_samp(price).alias("std_price"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def retain(df: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows not older than ``days`` days."""
    at = F.current_timestamp() if now is None else now
    return df.where(F.col(ts).cast("timestamp") >= at - F.make_dt_interval(F.lit(days)))
