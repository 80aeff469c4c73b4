"""The market summary: state merged with new snapshots, indicators, signal, newest rows per coin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions import indicators as ind
from candlelake.operators.blocks import Series, cut
from candlelake.operators.dedup import keep_last
from candlelake.operators.newest import ranked_rows, since_newest

# Fixed value: rows per coin that the state keeps.
STATE_ROWS = 500

SNAPSHOTS = Series("coin_id", "source_updated_at", ("ingested_file", "processed_at"))


def combine(history: DataFrame | None, new: DataFrame) -> DataFrame:
    """History and new snapshots in one table; columns only the history has are left behind."""
    if history is None:
        return new
    return history.select(new.columns).unionByName(new)


def _with_indicators(rows: DataFrame, w: WindowSpec) -> DataFrame:
    price, diff = F.col("current_price"), F.col("_diff")
    return (
        rows.withColumn("_diff", ind.difference(price, w))
        .withColumns({
            "sma_7d": ind.sma(price, ind.SMA_ROWS, w),
            "rsi_14d": ind.simple_rsi(diff, ind.RSI_ROWS, w),
            "volatility_7d": ind.volatility(diff, ind.VOLATILITY_ROWS, w),
        })
        .withColumn("signal", ind.signal(price, F.col("sma_7d"), F.col("rsi_14d")))
        .drop("_diff")
    )


def summarize(snapshots: DataFrame, series: Series = SNAPSHOTS, keep: int = STATE_ROWS,
              distinct: str = "row", analyzed_at: Column | None = None, prune: bool = True) -> DataFrame:
    """Distinct snapshots, indicators, signal, and the newest ``keep`` rows of each coin.

    A kept row depends on at most ``SUMMARY_REACH`` rows before it, so older rows are left
    out before anything is shuffled or sorted, and a coin's window holds no more than
    ``keep + SUMMARY_REACH`` rows however long its history is.

    ``distinct="row"`` collapses equal rows only; ``"key"`` keeps one row per coin and time.
    Without ``prune`` the pass that finds where the newest rows begin is left out, for input that
    has little more than these: the result is the same, and no table is written on the way.
    """
    need = keep + ind.SUMMARY_REACH
    recent = since_newest(snapshots, series, need) if prune else snapshots
    if distinct == "key":
        recent = keep_last(recent, [series.key, series.ts], list(series.ties) or [series.ts])
    else:
        recent = recent.distinct()
    scored = _with_indicators(ranked_rows(recent, series, need), series.window())
    kept = scored.where(F.col("_rank") <= keep).drop("_rank")
    if analyzed_at is not None:
        kept = kept.withColumn("analyzed_at", analyzed_at)
    return kept


def newest_first(summary: DataFrame, ts: str = "source_updated_at", key: str = "coin_id") -> DataFrame:
    """Output order of the summary."""
    return summary.orderBy(F.desc(ts), F.asc(key))


def full_history(snapshots: DataFrame, series: Series = SNAPSHOTS, block_rows: int | None = None) -> DataFrame:
    """Indicators and signal for every distinct row of every coin, with nothing pruned."""
    blocks = cut(snapshots, series, ind.SUMMARY_REACH, block_rows, distinct=True)
    return blocks.merge(_with_indicators(blocks.df, blocks.window))


def update_state(state: DataFrame | None, new: DataFrame, series: Series = SNAPSHOTS,
                 keep: int = STATE_ROWS, columns: Sequence[str] | None = None,
                 analyzed_at: Column | None = None) -> DataFrame:
    """The next state: indicators are worked out again from the pruned state plus the new rows."""
    rows = new.select(*columns) if columns else new
    return summarize(combine(state, rows), series, keep, analyzed_at=analyzed_at)
