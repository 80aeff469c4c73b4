"""The live table in few files: batches as they arrive, compacted by day, and a list of what is finished.

    arrivals/run=<stream>/batch=<n>/      the rows of one batch, which owns its folder
    days/segment=<v>/day=<d>/coin_id=<c>/ the candles of a day, each coin and time once
    list/version=<v>/                     the segment of each day, and the last finished batch of each stream

A compaction takes the finished batches, merges them with the segments of the days they touch into a new
segment, and last writes the next version of the list, a single file that is there as a whole or not at all.
Until then readers go by the version before, and a compaction that was killed is simply run again. Readers
take the listed segments and the batches that are not finished.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.operators.dedup import keep_last
from candlelake.plans.klines import KEYS
from candlelake.schemas import KLINE
from candlelake.session import settle
from candlelake.sources.tables import read_or_empty

LAST = ["processed_at", "close", "volume"]
LIST = "day string, segment bigint, run string, upto bigint, version bigint"
ARRIVALS = f"{KLINE}, run string, batch bigint"
SEGMENTS = f"{KLINE}, segment bigint, day string"


def append_batches(candles: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each batch of live candles to a folder of its own; a batch that is run again replaces it.

    The folder's name has the stream's id, which the checkpoint keeps, so a new checkpoint never meets the
    batches of an old one. ``trigger`` is as in ``append_candles``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        text = batch.sparkSession.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
        batch.write.mode("overwrite").parquet(f"{root}/arrivals/run={json.loads(text)['id']}/batch={batch_id}")

    return (
        candles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _listed(spark: SparkSession, root: str) -> tuple[int, DataFrame]:
    """The newest version, -1 without any, and its rows."""
    rows = read_or_empty(spark, f"{root}/list", LIST)
    version = rows.agg(F.max("version")).first()[0]
    return (-1 if version is None else version), rows.where(F.col("version") == F.lit(version))


def _finished(listed: DataFrame) -> Column:
    """Whether an arrival is in a segment; one pair of numbers for each checkpoint there ever was."""
    runs = listed.where("run IS NOT NULL").select("run", "upto").collect()
    return reduce(or_, [(F.col("run") == r["run"]) & (F.col("batch") <= r["upto"]) for r in runs], F.lit(False))


def _segments(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """The rows of the listed segments, and of no others' files."""
    table = read_or_empty(spark, f"{root}/days", SEGMENTS)
    return table.join(listed.where("day IS NOT NULL").select("segment", "day"), ["segment", "day"], "left_semi")


def _newest_batches(spark: SparkSession, root: str) -> dict[str, int]:
    """The newest batch of each stream, from the names of the folders."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{root}/arrivals")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["run"]: r["b"] for r in files.groupBy("run").agg(F.max("batch").alias("b")).collect()}


def read_compacted(spark: SparkSession, root: str) -> DataFrame:
    """The live table with one row per coin and time, the one that arrived last."""
    _, listed = _listed(spark, root)
    tail = read_or_empty(spark, f"{root}/arrivals", ARRIVALS).where(~_finished(listed)).drop("run", "batch")
    return keep_last(_segments(spark, root, settle(listed, "listed")).select(*tail.columns).unionByName(tail), KEYS, LAST)


def compact(spark: SparkSession, root: str, stopped: bool = False) -> int:
    """Compact the finished batches; the version that readers then go by.

    A batch is finished once its stream has begun another one; ``stopped`` says that no stream is running, so
    that all are. Days without new rows are not read. To run it again does no harm.
    """
    version, listed = _listed(spark, root)
    listed = settle(listed, "listed")
    upto = {run: newest if stopped else newest - 1 for run, newest in _newest_batches(spark, root).items()}
    due = reduce(or_, [(F.col("run") == run) & (F.col("batch") <= last) for run, last in upto.items()], F.lit(False))
    new = read_or_empty(spark, f"{root}/arrivals", ARRIVALS).where(due & ~_finished(listed)).drop("run", "batch")
    new = new.withColumn("day", F.date_format("source_updated_at", "yyyy-MM-dd"))
    touched = settle(new.select("day").distinct(), "touched-days")
    if touched.isEmpty():
        return version
    version += 1
    old = _segments(spark, root, settle(listed.join(touched, "day"), "old-segments")).select(*new.columns)
    days = ["day", "coin_id"]
    (
        keep_last(old.unionByName(new), KEYS, LAST).hint("rebalance", *days).sortWithinPartitions(*days, "source_updated_at")
        .write.mode("overwrite").partitionBy(*days).parquet(f"{root}/days/segment={version}")
    )
    known = {r["run"]: r["upto"] for r in listed.where("run IS NOT NULL").collect()}
    done = {run: max(known.get(run, -1), upto.get(run, -1)) for run in {*known, *upto}}
    runs = spark.createDataFrame(sorted(done.items()), "run string, upto bigint")
    segments = listed.where("day IS NOT NULL").join(touched, "day", "left_anti").select("day", "segment").unionByName(
        touched.withColumn("segment", F.lit(version).cast("bigint")))
    following = segments.unionByName(runs, allowMissingColumns=True)
    following.coalesce(1).write.mode("overwrite").parquet(f"{root}/list/version={version}")
    return version


def remove_superseded(spark: SparkSession, root: str) -> int:
    """Delete batches and segments that the newest list does not need; how many folders went.

    To be run when no reader still goes by an older version.
    """
    version, listed = _listed(spark, root)
    if version < 0:
        return 0
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(root).getFileSystem(context._jsc.hadoopConfiguration())

    def folders(path: str) -> list[str]:
        return [f.getPath().getName() for f in fs.listStatus(hadoop(path))] if fs.exists(hadoop(path)) else []

    needed = {f"segment={r['segment']}" for r in listed.where("day IS NOT NULL").select("segment").distinct().collect()}
    gone = [f"days/{name}" for name in folders(f"{root}/days") if name.startswith("segment=") and name not in needed]
    for r in listed.where("run IS NOT NULL").collect():
        run = f"arrivals/run={r['run']}"
        gone += [f"{run}/{name}" for name in folders(f"{root}/{run}")
                 if name.startswith("batch=") and int(name[6:]) <= r["upto"]]
    gone += [f"list/{name}" for name in folders(f"{root}/list") if name.startswith("version=") and int(name[8:]) < version]
    for name in gone:
        fs.delete(hadoop(f"{root}/{name}"), True)
    return len(gone)
