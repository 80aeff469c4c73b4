"""Frames that cost little per row, over nested chunks of a block.

A sliding frame aggregates all its rows again for every row. Sums over chunks, and lags,
avoid that. The short chunks divide the long ones and all windows here follow the same
order, so one sort of a block serves every one of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.operators.blocks import Blocks

LONG, SHORT = 2_600, 200
PACES = (LONG, SHORT)


def _name(size: int) -> str:
    return f"_chunk_{size}"


def paced(df: DataFrame) -> DataFrame:
    """Add the chunk numbers that the windows below sort by; once, so that the sort is shared."""
    if _name(LONG) in df.columns:
        return df
    return df.withColumns({_name(n): F.floor(F.col("_pos") / n) for n in PACES})


def paced_window(blocks: Blocks) -> WindowSpec:
    """The rows of a block in series order."""
    return Window.partitionBy(blocks.series.key, "_block").orderBy(*map(_name, PACES), "_pos")


def chunk_window(blocks: Blocks, size: int) -> WindowSpec:
    """The rows of one chunk in series order."""
    at = PACES.index(size) + 1
    return Window.partitionBy(blocks.series.key, "_block", *map(_name, PACES[:at])).orderBy(
        *map(_name, PACES[at:]), "_pos"
    )


def chunks_back(blocks: Blocks, steps: int) -> WindowSpec:
    """The whole long chunk that lies ``steps`` chunks back."""
    return Window.partitionBy(blocks.series.key, "_block").orderBy(_name(LONG)).rangeBetween(-steps, -steps)


def rolling_sum(df: DataFrame, blocks: Blocks, x: Column, sizes: Sequence[int], prefix: str) -> DataFrame:
    """Add ``<prefix>_<n>`` for each ``n``: the sum of the last ``n`` rows, NULL until there are ``n``.

    With a running sum over chunks of ``SHORT`` rows, the last ``n`` are either the
    difference of two running sums, or the running sum so far and the end of the chunk
    before, which is that chunk's total less its running sum ``n`` rows ago. A block must
    reach back ``n`` rows, and ``x`` must not be NULL.
    """
    if max(sizes) > SHORT:
        raise ValueError(f"rolling sums go up to {SHORT} rows")
    chunk, order = chunk_window(blocks, SHORT), paced_window(blocks)
    df = df.withColumns({
        "_run": F.sum(x).over(chunk.rowsBetween(Window.unboundedPreceding, 0)),
        "_total": F.sum(x).over(chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    }).withColumn("_rest", F.col("_total") - F.col("_run"))
    sums = {}
    for n in sizes:
        same_chunk = blocks.pos % SHORT >= n
        run_then, rest_then = (F.coalesce(F.lag(c, n).over(order), F.lit(0)) for c in ("_run", "_rest"))
        last = F.col("_run") + F.when(same_chunk, -run_then).otherwise(rest_then)
        sums[f"{prefix}_{n}"] = F.when(blocks.pos >= n - 1, last)
    return df.withColumns(sums).drop("_run", "_total", "_rest")


def rolling_mean(df: DataFrame, blocks: Blocks, x: Column, sizes: Sequence[int], prefix: str) -> DataFrame:
    """As ``rolling_sum``, divided by the number of rows."""
    df = rolling_sum(df, blocks, x, sizes, prefix)
    return df.withColumns({f"{prefix}_{n}": F.col(f"{prefix}_{n}") / n for n in sizes})


def deviations(df: DataFrame, w: WindowSpec, x: Column, n: int, ddof: int = 0) -> DataFrame:
    """Add ``_mean`` and ``_std`` of the last ``n`` rows; NULL where there are fewer.

    The earlier rows come in as lags, relative to the current one: the arithmetic is plain
    columns, and a price that does not move has a deviation of exactly zero.
    """
    lags = {f"_back_{i}": F.lag(x, i).over(w) - x for i in range(1, n)}
    df = df.withColumns(lags)
    back = [F.col(c) for c in lags]
    df = df.withColumn("_shift", reduce(add, back) / n)
    shift = F.col("_shift")
    squares = reduce(add, [(b - shift) * (b - shift) for b in back], shift * shift)
    return df.withColumns({"_mean": x + shift, "_std": F.sqrt(squares / (n - ddof))}).drop("_shift", *lags)
