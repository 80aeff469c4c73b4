"""Cleaning of market snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.schemas import SNAPSHOT_COLUMNS


def stamp(records: DataFrame, captured_at: Column) -> DataFrame:
    """The capture time on every record of one fetch."""
    return records.withColumn("ingested_timestamp", captured_at)


def safe_fdv(price: Column, max_supply: Column, total_supply: Column) -> Column:
    """Fully diluted valuation from the maximum supply, or from the total when there is none."""
    return price * F.coalesce(max_supply, total_supply)


def clean(raw: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Renamed, deduplicated snapshots with the valuation worked out again.

    Rows are made distinct before the processing time is added, so that it cannot tell
    copies apart.
    """
    fdv = safe_fdv(F.col("current_price"), F.col("max_supply"), F.col("total_supply"))
    named = raw.withColumns({"fully_diluted_valuation": fdv, "coin_id": F.col("id")})
    lineage = [F.col("last_updated").alias("source_updated_at"), "ingested_timestamp"]
    if "ingested_file" in raw.columns:
        lineage.append("ingested_file")
    rows = named.select(*SNAPSHOT_COLUMNS, *lineage).distinct()
    return rows.withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at)
