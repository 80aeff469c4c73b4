"""Writers of the lake's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.plans.klines import DAILY, gap_fill
from candlelake.session import settle
from candlelake.sources.tables import stored_coins

LAYOUT = ["coin_id", "month"]
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _laid_out(df: DataFrame, ts: str = "source_updated_at") -> DataFrame:
    """Rows by coin and month, in time order.

    The rebalance hint lets adaptive execution split a coin that is too large for one
    writer and merge small ones.
    """
    by_month = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    return by_month.hint("rebalance", *LAYOUT).sortWithinPartitions(*LAYOUT, ts)


def write_silver(df: DataFrame, root: str, mode: str = "errorifexists", ts: str = "source_updated_at") -> None:
    """Candles, or features, as snappy Parquet partitioned by coin and month."""
    (
        _laid_out(df, ts).write.mode(mode).partitionBy(*LAYOUT)
        .option("compression", "snappy").parquet(root)
    )


write_features = write_silver


def overwrite_touched(df: DataFrame, root: str, ts: str = "source_updated_at") -> None:
    """Replace only the coin-months that ``df`` has rows for."""
    (
        _laid_out(df, ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT).option("compression", "snappy").parquet(root)
    )


def merge_recent(root: str, recent: DataFrame, require_history: bool = True, source: int = DAILY) -> None:
    """Fill recent rows into the stored table, reading and rewriting only the months they touch.

    ``source`` says which side wins where both have a time: published daily files replace
    stored rows, live candles do not. Recent rows without a time are left out.
    """
    spark = recent.sparkSession
    # A row without a time belongs to no month, and replacing its partition would lose what is stored there.
    recent = recent.where(F.col("source_updated_at").isNotNull())
    stored = spark.read.parquet(root)
    if require_history:
        known = settle(stored_coins(spark, root), "known-coins")
        recent = recent.join(known, "coin_id", "left_semi")
    month = F.date_format("source_updated_at", "yyyy-MM").alias("month")
    touched = settle(recent.select("coin_id", month).distinct(), "touched")
    # One value per calendar month: enough to prune the scan when the query is planned.
    months = [row["month"] for row in touched.select("month").distinct().collect()]
    master = stored.where(F.col("month").isin(months)).join(touched, LAYOUT, "left_semi").drop("month")
    overwrite_touched(gap_fill(master, recent, require_history=False, recent_source=source), root)


def append_new_coins(df: DataFrame, root: str) -> None:
    """Write only coins that are not stored yet."""
    stored = settle(stored_coins(df.sparkSession, root), "known-coins")
    write_silver(df.join(stored, "coin_id", "left_anti"), root, mode="append")


def write_snapshots(df: DataFrame, root: str, mode: str = "append") -> None:
    """Clean snapshots as snappy Parquet, one partition per capture day."""
    (
        df.withColumn("ingest_date", F.to_date("ingested_timestamp"))
        .write.mode(mode).partitionBy("ingest_date").option("compression", "snappy").parquet(root)
    )


def write_raw_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Raw records as JSON lines, NULLs left out, times to the microsecond."""
    df.write.mode(mode).option("timestampFormat", JSON_TIME).json(path)


def write_metadata(df: DataFrame, path: str, mode: str = "overwrite", key: str = "pair") -> None:
    """Metadata records as JSON documents keyed by pair, one per line; ``read_documents`` reads them back."""
    record = F.struct(*[c for c in df.columns if c != key])
    document = F.to_json(F.create_map(key, record), {"ignoreNullFields": "false"})
    df.where(F.col(key).isNotNull()).select(document.alias("value")).write.mode(mode).text(path)


def write_alerts(alerts: DataFrame, path: str, mode: str = "append") -> None:
    """Alert payloads for a notifier, one JSON message per line."""
    alerts.select(F.col("payload").alias("value")).write.mode(mode).text(path)
