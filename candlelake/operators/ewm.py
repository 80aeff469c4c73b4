"""Recursive averages ``y[t] = q * y[t-1] + u[t]`` as window sums.

Written out, ``y[t]`` is the sum of ``q^(t-i) * u[i]`` over all earlier rows. With
``j`` the row's place in a chunk of ``CHUNK`` rows and ``s = u * q^-j``:

* the rows of the own chunk add ``q^j`` times a running sum of ``s``;
* the chunk ``m`` steps back adds ``q^(CHUNK*m + j)`` times that chunk's total of ``s``.

The weight of a far chunk underflows to zero in double arithmetic after a few steps, so
looking back that far is exact to the last bit that a double can hold.

What lies before a block comes in one of two ways. An average of values that all have weight is
the same to the last bit once a block reaches back ``memory_rows``. A ratio of two averages is
different: in a flat stretch both fade, without end, and their ratio stays. ``carried`` gives each
block the two averages as they were at the last row that changed them, however long ago that was.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.blocks import Blocks
from candlelake.operators.pace import LONG, chunk_window, chunks_back
from candlelake.session import settle

CHUNK = LONG
UNDERFLOW = 745.0       # exp(-745) is the smallest positive double
OVERFLOW = 600.0        # leaves room for prices and sums below exp(709)
FORGOTTEN = 120.0       # exp(-120) is 1e-52: no bit of a sum, even if old values are 1e36 times the new ones


def memory_rows(alpha: float) -> int:
    """Rows after which an old value changes no bit of an average."""
    return math.ceil(FORGOTTEN / -math.log1p(-alpha))


def _decay(alpha: float) -> float:
    rate = -math.log1p(-alpha)
    if CHUNK * rate > OVERFLOW:
        raise ValueError(f"alpha {alpha} is too large for chunks of {CHUNK} rows")
    return rate


def recursive_sum(df: DataFrame, blocks: Blocks, inputs: dict[str, tuple[Column, float]]) -> DataFrame:
    """Add ``y`` for each ``name: (u, alpha)`` to paced rows; all share one sort of each block."""
    place = (F.col("_pos") % CHUNK).cast("double")
    own = chunk_window(blocks, CHUNK).rowsBetween(Window.unboundedPreceding, 0)

    scaled = {
        f"_s_{name}": u * F.exp(place * _decay(alpha)) for name, (u, alpha) in inputs.items()
    }
    df = df.withColumns(scaled)
    results = {}
    for name, (_, alpha) in inputs.items():
        rate = _decay(alpha)
        s = F.col(f"_s_{name}")
        total = F.sum(s).over(own)
        step = CHUNK * rate
        # A chunk's total, brought to its last row, fades by one step for each further chunk.
        for back in range(1, math.floor(UNDERFLOW / step) + 2):
            # Two factors: a total can be so large that one tiny factor would lose it.
            there = F.coalesce(F.sum(s).over(chunks_back(blocks, back)), F.lit(0.0))
            total += there * math.exp(-step) * math.exp(-step * (back - 1))
        results[name] = total * F.exp(place * -rate)
    return df.withColumns(results).drop(*scaled)


def carried(df: DataFrame, blocks: Blocks, inputs: Sequence[str], alpha: float, start: DataFrame | None = None) -> DataFrame:
    """``_key``, ``_to``, ``_since`` and one ``_from_<input>`` each: what block ``_to`` knows of all before it.

    ``df`` holds only rows that their block owns. A row counts where an input is not zero; ``_since`` is
    the last such position before the block and ``_from_<input>`` the decayed sum up to that row, NULL
    where there is none. Each block becomes one row, relative to its own last counting row, so nothing
    fades however long the series stands still. A window then holds one row per block of a series.
    ``start`` has what was known before the first rows: ``_key``, ``_at`` (a position, below zero where it
    lies before them) and the inputs' sums.
    """
    rate = _decay(alpha)
    counts = reduce(or_, [F.col(c) != 0 for c in inputs])
    rows = df.select(F.col(blocks.series.key).alias("_key"), "_block", "_pos", *inputs)
    rows = rows.withColumn("_at", F.max(F.when(counts, F.col("_pos"))).over(Window.partitionBy("_key", "_block")))
    weight = F.exp((F.col("_pos") - F.col("_at")).cast("double") * rate)
    own = rows.groupBy("_key", "_block", "_at").agg(*[F.sum(F.when(counts, F.col(c) * weight)).alias(c) for c in inputs])
    if start is not None:
        own = own.unionByName(start.select("_key", F.lit(-1).cast("bigint").alias("_block"), "_at", *inputs))

    def upto(near: Column, c: str) -> Column:
        def add(total: Column, x: Column) -> Column:
            return total + x[c] * F.exp((x["_at"] - F.col("_at")).cast("double") * rate)

        return F.aggregate(near, F.lit(0.0), add)

    # Blocks hold block_rows each, so a sum from further back has no weight in a newer one.
    back = math.ceil(UNDERFLOW / (rate * blocks.block_rows)) + 1
    by_block = Window.partitionBy("_key").orderBy("_block")
    known = F.when(F.col("_at").isNotNull(), F.struct("_at", *inputs))
    near = own.withColumn("_near", F.collect_list(known).over(by_block.rowsBetween(-back, 0)))
    state = F.when(F.col("_at").isNotNull(), F.struct(F.col("_at"), *[upto(F.col("_near"), c).alias(c) for c in inputs]))
    before = F.last("_state", ignorenulls=True).over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    out = near.withColumn("_state", state).withColumn("_before", before)
    return settle(out.select("_key", F.col("_block").alias("_to"), F.col("_before._at").alias("_since"), *[
        F.col("_before")[c].alias(f"_from_{c}") for c in inputs]), "carried")


def seeded(x: Column, seed: Column, seed_pos: int, alpha: float) -> Column:
    """The inputs ``u`` of an average that starts as ``seed`` at ``seed_pos``."""
    pos = F.col("_pos")
    return F.when(pos < seed_pos, F.lit(0.0)).when(pos == seed_pos, seed).otherwise(x * alpha)
