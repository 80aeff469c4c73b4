"""Alert rows for active signals, and their message payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions import text
from candlelake.operators.blocks import Series
from candlelake.operators.newest import latest_row
from candlelake.plans.summary import SNAPSHOTS

# Side colours and wording of the message.
BUY_COLOR = 5763719
SELL_COLOR = 15548997
TITLE = "🚨 %s SIGNAL DETECTED: %s"
TIME_FORMAT = "yyyy-MM-dd HH:mm 'UTC'"


def active(summary: DataFrame) -> DataFrame:
    """Rows whose signal asks for action."""
    return summary.where(F.col("signal") != "WAIT")


def newest_row(summary: DataFrame, series: Series = SNAPSHOTS) -> DataFrame:
    """The newest row over all coins; ties go to the first coin."""
    return summary.orderBy(F.desc(series.ts), F.asc(series.key), *[F.desc(t) for t in series.ties]).limit(1)


def newest_alert(summary: DataFrame, series: Series = SNAPSHOTS) -> DataFrame:
    """The newest row over all coins, if its signal is active."""
    return active(newest_row(summary, series))


def alerts_per_coin(summary: DataFrame, series: Series = SNAPSHOTS) -> DataFrame:
    """The latest row of each coin, where its signal is active."""
    return active(latest_row(summary, series))


def payload(name: Column, price: Column, rsi: Column, signal: Column, at: Column,
            sender: str = "Market alerts") -> Column:
    """The message as JSON text."""
    def field(label: str, value: Column, inline: bool) -> Column:
        return F.struct(F.lit(label).alias("name"), value.alias("value"), F.lit(inline).alias("inline"))

    embed = F.struct(
        F.format_string(TITLE, signal, name).alias("title"),
        F.when(signal == "BUY", BUY_COLOR).otherwise(SELL_COLOR).alias("color"),
        F.array(
            field("Price", text.money(price, 4), True),
            field("RSI (14d)", text.fixed(rsi, 1, grouping=False), True),
            field("Time", F.date_format(at, TIME_FORMAT), False),
        ).alias("fields"),
    )
    return F.to_json(F.struct(F.lit(sender).alias("username"), F.array(embed).alias("embeds")))


def alert_rows(alerts: DataFrame, name: str = "symbol", at: Column | None = None) -> DataFrame:
    """Alerts with the payload a notifier sends."""
    time = F.current_timestamp() if at is None else at
    message = payload(F.col(name), F.col("current_price"), F.col("rsi_14d"), F.col("signal"), time)
    return alerts.withColumn("payload", message)
