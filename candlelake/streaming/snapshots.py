"""Snapshot files as they arrive: clean them, then carry the summary state forward."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.plans.alerts import active, alert_rows
from candlelake.plans.snapshots import clean
from candlelake.plans.summary import SNAPSHOTS, STATE_ROWS, combine, summarize
from candlelake.schemas import SNAPSHOT, SNAPSHOT_COLUMNS, SUMMARY, SUMMARY_COLUMNS
from candlelake.sinks.tables import write_alerts
from candlelake.sources.tables import read_or_empty

PARTS = 64        # parts of the state, by coin
LINEAGE = ["source_updated_at", "ingested_file", "processed_at"]


def clean_arrivals(raw: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Clean each arriving file once.

    ``trigger`` is passed on to the stream, ``processingTime="1 minute"`` for one that keeps listening;
    by default it uses all landed input and ends.

    A batch owns one folder and replaces it when it is run again, and no file is too late:
    backfills of old captures are cleaned like any other.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        clean(batch).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return (
        raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_clean(spark: SparkSession, root: str) -> DataFrame:
    """Clean snapshots as they are written; the folders' ``batch`` is declared, as there may be no folder yet."""
    return spark.readStream.schema(f"{SNAPSHOT}, batch bigint").parquet(root).drop("batch")


def part_of(coin: Column | str) -> Column:
    """The part of the state that a coin belongs to."""
    return F.pmod(F.xxhash64(coin), F.lit(PARTS)).cast("int")


def _list(spark: SparkSession, root: str, version: int | None = None) -> dict[int, int]:
    """The version of each part as of a finished batch, the newest one by default; at most ``PARTS`` entries."""
    rows = read_or_empty(spark, f"{root}/list", "part int, at bigint, version bigint")
    last = rows.agg(F.max("version")).first()[0] if version is None else version
    return {r["part"]: r["at"] for r in rows.where(F.col("version") == F.lit(last)).collect()}


def _rows(spark: SparkSession, root: str, listed: dict[int, int]) -> DataFrame:
    """The rows of these versions of these parts; no other file is read."""
    table = read_or_empty(spark, f"{root}/state", f"{SUMMARY}, version bigint, part int")
    wanted = [(F.col("version") == at) & (F.col("part") == part) for part, at in sorted(listed.items())]
    return table.where(reduce(or_, wanted, F.lit(False))).select(*SUMMARY_COLUMNS)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The state of the last finished batch."""
    return _rows(spark, root, _list(spark, root))


def _remove(spark: SparkSession, root: str, paths: list[str]) -> None:
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(context._jsc.hadoopConfiguration())
    for path in paths:
        fs.delete(hadoop(f"{root}/{path}"), True)


def carry_state(snapshots: DataFrame, root: str, checkpoint: str, keep: int = STATE_ROWS,
                distinct: str = "key", alerts: str | None = None,
                initial: DataFrame | None = None, **trigger) -> StreamingQuery:
    """Merge each batch of snapshots into the summary state.

    ``initial`` is the state a new checkpoint starts from, none for a fresh one. ``trigger`` is as in ``clean_arrivals``.

    The state is kept in parts by coin, and a batch writes only the parts of its coins, as a version of its
    own, then a list of the version that each part now has: one small file, there as a whole or not at all.
    A batch that is run again starts from the list before it and gives the same. Versions that neither the
    newest list nor the one before it names are deleted. One query owns the state, so updates cannot
    overtake each other.
    """
    columns = [*SNAPSHOT_COLUMNS, *LINEAGE]

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _list(spark, root, batch_id - 1)
        touched = {r["part"] for r in batch.select(part_of("coin_id").alias("part")).distinct().collect()}
        if batch_id == 0 and initial is not None:
            state, touched = initial, set(range(PARTS))
        else:
            state = _rows(spark, root, {p: at for p, at in before.items() if p in touched})
        rows = combine(state, batch.select(*columns))
        # The state is pruned already, and a job without end must not leave a table behind for each batch.
        new = summarize(rows, SNAPSHOTS, keep, distinct, F.current_timestamp(), prune=False)
        new = new.select(*SUMMARY_COLUMNS).withColumn("part", part_of("coin_id"))
        (
            new.write.mode("overwrite").partitionBy("part").option("compression", "snappy")
            .parquet(f"{root}/state/version={batch_id}")
        )
        after = {**before, **{p: batch_id for p in touched}}
        rows = spark.createDataFrame(sorted(after.items()), "part int, at bigint")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/list/version={batch_id}")
        if alerts:
            stored = _rows(spark, root, {p: batch_id for p in touched})
            fresh = stored.join(batch.select("coin_id", "source_updated_at").distinct(),
                                ["coin_id", "source_updated_at"], "left_semi")
            write_alerts(alert_rows(active(fresh)), f"{alerts}/batch={batch_id}", mode="overwrite")
        old = _list(spark, root, batch_id - 2)
        gone = [f"state/version={at}/part={p}" for p, at in old.items() if at not in (before.get(p), after.get(p))]
        _remove(spark, root, [*gone, f"list/version={batch_id - 2}"])

    return (
        snapshots.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
