"""Ordered series cut into row blocks, so that no window task holds a whole series.

``Window.partitionBy("coin_id")`` puts all rows of a coin into one task. When one coin
holds a third of a large table that task never ends. Here a series is cut into blocks of
about ``block_rows`` rows, and each block also gets the ``reach`` rows before it, which is
all that a finite frame can look back on. Windows then run per (series, block) and the
borrowed rows are dropped again. Results are the same as over the whole series.

The cut needs each row's position in its series. A histogram, rows per series and time
bucket, gives the position of every bucket's first row, so only one wide shuffle is needed:
the one to (series, block). Buckets are powers of two of microseconds wide; one that holds
more rows than a block is halved until its parts do not, so dense stretches of a series get
narrow buckets and the rest stays coarse.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.session import settle

MAX_BLOCK_ROWS = 500_000
MIN_BLOCK_ROWS = 1_024
COARSE_BITS = 37        # first buckets are 2^37 microseconds wide, about 38 hours


@dataclass(frozen=True)
class Series:
    """Which columns name a series and in which (total) order its rows follow."""

    key: str = "coin_id"
    ts: str = "source_updated_at"
    ties: Sequence[str] = field(default_factory=tuple)

    def window(self, *extra_keys: str) -> WindowSpec:
        return Window.partitionBy(self.key, *extra_keys).orderBy(self.ts, *self.ties)


@dataclass(frozen=True)
class Blocks:
    """Rows placed in blocks. ``_pos`` is the 0-based position within the whole series.

    Helper columns start with an underscore; ``inputs`` are the columns that are none.
    """

    df: DataFrame
    series: Series
    block_rows: int
    inputs: frozenset[str]
    tied: bool = False
    single: bool = False        # no series has more than one block
    start: DataFrame | None = None        # of series that go on from a state: their averages before the new rows

    @property
    def window(self) -> WindowSpec:
        return _ordered(self.series, self.tied)

    @property
    def pos(self) -> Column:
        return F.col("_pos")

    @property
    def owned(self) -> Column:
        """False for rows that are only borrowed from the blocks before."""
        return F.floor(F.col("_pos") / self.block_rows) == F.col("_block")

    def merge(self, df: DataFrame) -> DataFrame:
        """Keep each row in the block that owns it and drop the helper columns."""
        kept = [c for c in df.columns if c in self.inputs or not c.startswith("_")]
        return df.where(self.owned).select(*kept)


def _ordered(series: Series, tied: bool) -> WindowSpec:
    """The rows of a block in series order; ``_tie`` settles what time and tie columns leave open."""
    return Window.partitionBy(series.key, "_block").orderBy(series.ts, *series.ties, *(["_tie"] if tied else []))


def _place_tied(rows: DataFrame, series: Series) -> DataFrame:
    """Exact positions ``_at`` of rows that share a time, or have none, in buckets that begin at ``_first``.

    Such rows are dealt by range, time and tie columns, so a time with most of the rows fills many tasks;
    counts per task then say where each task's rows begin.
    """
    order = [series.key, "_us", *series.ties, "_own"]
    own = settle(rows.withColumn("_own", F.monotonically_increasing_id()), "tied")
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mark", F.monotonically_increasing_id())
    dealt = settle(dealt, "tied").withColumns({
        "_task": F.expr("shiftright(_mark, 33)"), "_line": F.expr("_mark & 8589934591L")})
    tasks = dealt.groupBy(F.col(series.key).alias("_tied_key"), F.col("_us").alias("_tied_us"),
                          F.col("_task").alias("_tied_task")).agg(
        F.count(F.lit(1)).alias("_here"), F.min("_line").alias("_top"))
    earlier = Window.partitionBy("_tied_key", "_tied_us").orderBy("_tied_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = settle(tasks.withColumn("_earlier", F.coalesce(F.sum("_here").over(earlier), F.lit(0))), "tied-tasks")
    same = (F.col("_tied_task") == F.col("_task")) & F.col("_tied_key").eqNullSafe(F.col(series.key)) & F.col(
        "_tied_us").eqNullSafe(F.col("_us"))
    return dealt.join(tasks, same).withColumn("_at", F.col("_first") + F.col("_earlier") + F.col("_line") - F.col("_top")).drop(
        "_own", "_mark", "_task", "_line", "_tied_key", "_tied_us", "_tied_task", "_here", "_top", "_earlier")


def _same(series: Series) -> Column:
    """Join condition on the bucket of a row; a missing key or time is a bucket of its own."""
    return (
        F.col(series.key).eqNullSafe(F.col("_key"))
        & F.col("_bucket").eqNullSafe(F.col("_key_bucket"))
        & (F.col("_bits") == F.col("_key_bits"))
    )


def _as_key(series: Series) -> list[Column]:
    return [
        F.col(series.key).alias("_key"), F.col("_bucket").alias("_key_bucket"), F.col("_bits").alias("_key_bits"),
    ]


def _bucketed(df: DataFrame, bits: Column) -> DataFrame:
    return df.withColumn("_bits", bits).withColumn("_bucket", F.expr("shiftright(_us, _bits)"))


def _halve_dense(rows: DataFrame, counts: DataFrame, series: Series, block_rows: int) -> DataFrame:
    """Narrower buckets for the rows of buckets that hold more than a block."""
    dense = counts.where((F.col("_n") > block_rows) & (F.col("_bits") > 0) & F.col("_bucket").isNotNull())
    # About eight buckets to a block: the one across a block's end is what two blocks share.
    halvings = F.ceil(F.log2(F.col("_n") * 8 / block_rows)).cast("int")
    finer = dense.select(*_as_key(series), F.greatest(F.lit(0), F.col("_bits") - halvings).alias("_finer"))
    joined = rows.join(finer, _same(series), "left").drop("_key", "_key_bucket", "_key_bits")
    return _bucketed(joined, F.coalesce("_finer", "_bits")).drop("_finer")


def bucketed(df: DataFrame, series: Series, most: int) -> DataFrame:
    """The series key of each row of ``df`` with ``_us``, ``_bits`` and ``_bucket``: its time, and its time bucket.

    No bucket has more than ``most`` rows, unless they all share one time or have none. One column pair of
    ``df`` is read for each level of buckets.
    """
    rows = _bucketed(df.select(series.key, F.unix_micros(F.col(series.ts).cast("timestamp")).alias("_us")), F.lit(COARSE_BITS))
    while True:
        counts = settle(rows.groupBy(series.key, "_bits", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "histogram")
        widest = counts.where((F.col("_bits") > 0) & F.col("_bucket").isNotNull()).agg(F.max("_n")).first()[0]
        if (widest or 0) <= most:
            return rows
        rows = _halve_dense(rows, counts, series, most)


def _without_copies(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal rows once, in the tasks where the blocks already are: no other shuffle."""
    return rows.dropDuplicates([*columns, "_block"])


def cut(df: DataFrame, series: Series, reach: int, block_rows: int | None = None, distinct: bool = False) -> Blocks:
    """Place the rows of ``df`` in blocks that each know the ``reach`` rows before them.

    ``df`` is read once for each level of buckets, two columns only, and once whole.

    With ``distinct`` equal rows count, and are kept, once. They share a series and a time, so they meet in
    their block, and only hashes of rows (96 bits, next to their bucket) are shuffled to count them. Buckets
    where more than half of the rows are copies lose these before the shuffle, whatever one row's copies are.
    """
    inputs = df.columns
    tally = [F.count(F.lit(1)).alias("_n")]
    if distinct:
        tally = [F.count_distinct(F.xxhash64(*inputs), F.hash(*inputs)).alias("_n"), F.count(F.lit(1)).alias("_rows")]
    rows = _bucketed(
        df.withColumn("_us", F.unix_micros(F.col(series.ts).cast("timestamp"))), F.lit(COARSE_BITS)
    )
    while True:
        counts = settle(rows.groupBy(series.key, "_bits", "_bucket").agg(*tally), "histogram")
        can_halve = (F.col("_bits") > 0) & F.col("_bucket").isNotNull()
        sizes = counts.groupBy(series.key).agg(
            F.sum("_n").alias("_size"), F.max(F.when(can_halve, F.col("_n"))).alias("_wide"),
            F.max(F.when(~can_halve, F.col("_n"))).alias("_ties"))
        total, longest, widest, ties = sizes.agg(F.sum("_size"), F.max("_size"), F.max("_wide"), F.max("_ties")).first()
        if block_rows is None:
            # A few blocks per core, but large against what each block borrows.
            parallelism = df.sparkSession.sparkContext.defaultParallelism
            share = math.ceil((total or 0) / (4 * parallelism))
            block_rows = max(MIN_BLOCK_ROWS, 8 * reach, min(MAX_BLOCK_ROWS, share))
        if (widest or 0) <= block_rows:
            break
        rows = _halve_dense(rows, counts, series, block_rows)

    start = F.expr("shiftleft(_bucket, _bits)")
    before = Window.partitionBy(series.key).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(before), F.lit(0))
    size = F.sum("_n").over(Window.partitionBy(series.key))
    copied = F.col("_rows") > 2 * F.col("_n") if distinct else F.lit(False)
    spans = counts.withColumns({"_first": first, "_size": size}).select(
        *_as_key(series), "_first", "_size", (~can_halve & (F.col("_n") > block_rows)).alias("_stuck"),
        copied.alias("_copied"), F.floor(F.col("_first") / block_rows).alias("_lo"),
        F.least(
            F.floor((F.col("_first") + F.col("_n") - 1 + reach) / block_rows),
            F.floor((F.col("_size") - 1) / block_rows),
        ).alias("_hi"),
    )
    tied = (ties or 0) > block_rows
    crowded = distinct and not counts.where(copied).isEmpty()
    spanned = rows.join(settle(spans, "spans") if tied or crowded else spans, _same(series)).drop(
        "_key", "_key_bucket", "_key_bits")
    if crowded or (distinct and tied):
        alone = F.col("_copied") | F.col("_stuck")
        spanned = spanned.where(~alone).unionByName(spanned.where(alone).distinct())
    # Rows that differ, at one time and with equal tie columns, follow in one order in all blocks.
    tie = F.xxhash64(*inputs) if distinct else F.lit(0).cast("bigint")
    placed = spanned.withColumn("_tie", tie) if distinct else spanned
    if tied:      # rows of one time that fill more than a block: each knows its own place
        at = _place_tied(spanned.where("_stuck"), series)
        last = F.floor((F.col("_size") - 1) / block_rows)
        at = at.withColumns({
            "_first": F.col("_at"), "_tie": F.col("_at"), "_lo": F.floor(F.col("_at") / block_rows),
            "_hi": F.least(F.floor((F.col("_at") + reach) / block_rows), last)}).drop("_at")
        placed = spanned.where("NOT _stuck").withColumn("_tie", tie).unionByName(at)
    placed = placed.drop("_size", "_stuck", "_copied").withColumn("_block", F.explode(F.sequence("_lo", "_hi")))
    if distinct and not counts.where("_rows > _n").isEmpty():
        placed = _without_copies(placed.repartition(series.key, "_block"), inputs)
    tied = tied or distinct
    w = _ordered(series, tied)
    placed = placed.withColumn("_pos", F.first("_first").over(w) + F.row_number().over(w) - 1)
    return Blocks(placed, series, block_rows, frozenset(inputs), tied, (longest or 0) <= block_rows)
