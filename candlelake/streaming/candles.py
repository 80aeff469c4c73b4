"""Live candles: parse, keep closed ones, append. No state: copies are removed where the table is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlelake.functions.keys import coin_key, epoch_to_time
from candlelake.operators.dedup import keep_last
from candlelake.plans.klines import KEYS, live_candles
from candlelake.schemas import CANDLE_EVENT


def closed_candles(messages: DataFrame) -> DataFrame:
    """Buffer rows of the messages that carry a closed candle; prices are text on the wire."""
    k = F.col("m.k")
    return (
        messages.select(F.from_json("value", CANDLE_EVENT).alias("m")).where(k["x"])
        .select(
            k["s"].alias("symbol"), k["t"].alias("open_time_ms"),
            *[k[short].try_cast("double").alias(name) for short, name in
              {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}.items()],
        )
    )


def clean_candles(buffer: DataFrame) -> DataFrame:
    """Candles in the clean table's shape, however late they come; without a pair or a time there is no candle."""
    return live_candles(buffer).where(F.col("source_updated_at").isNotNull() & (F.col("coin_id") != ""))


def rejected_candles(buffer: DataFrame) -> DataFrame:
    """The buffer rows that ``clean_candles`` leaves out, with the reason, for a stream or table beside the candles."""
    reason = F.when(F.coalesce(coin_key("symbol"), F.lit("")) == "", "no pair").when(
        F.col("open_time_ms").isNull(), "no time").when(epoch_to_time("open_time_ms").isNull(), "time out of range")
    return buffer.withColumn("reason", reason).where(F.col("reason").isNotNull())


def append_rejected(rejected: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write rejected rows aside as JSON lines; ``trigger`` as in ``append_candles``."""
    return (
        rejected.writeStream.format("json").outputMode("append").option("path", root).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def append_candles(candles: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to the live table; a restart goes on from the checkpoint.

    ``trigger`` is passed on to the stream, ``processingTime="1 minute"`` for one that keeps listening;
    by default it uses all landed input and ends.
    """
    return (
        candles.writeStream.format("parquet").outputMode("append").partitionBy("coin_id")
        .option("path", root).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_live(spark: SparkSession, root: str) -> DataFrame:
    """The live table with one row per coin and time, the one that arrived last."""
    return keep_last(spark.read.parquet(root), KEYS, ["processed_at", "close", "volume"])
