"""Duplicate removal and its counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the last in ``order``.

    The rank filter is applied before the shuffle too, so a key with many copies sends at
    most one row per map task.
    """
    last_first = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*last_first)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def dedup_metrics(df: DataFrame, group: str, keys: Sequence[str]) -> DataFrame:
    """Rows before, rows after and rows dropped when ``keys`` are made unique, per ``group``."""
    per_key = df.groupBy(group, *[k for k in keys if k != group]).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(group).agg(
        F.sum("_n").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.sum("_n") - F.count(F.lit(1))).alias("rows_dropped"),
    )
