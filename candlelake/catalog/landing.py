"""The driver's tables landed in the file formats that the sources read.

Archives, JSON documents and messages are written by Spark tasks below the shared folder,
so the readers and streams have input that grows with the tables.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake import adapters
from candlelake.session import shared_path

DOCUMENT_RECORDS = 2_000


def _write_archive(rows: pd.DataFrame) -> pd.DataFrame:
    """One archive from the lines of one symbol and period."""
    path = rows["path"].iloc[0]
    member = path.rsplit("/", 1)[-1].removesuffix(".zip") + ".csv"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(member, "\n".join(rows.sort_values("at")["line"]) + "\n")
    system, target = fs.FileSystem.from_uri(path)
    system.create_dir(target.rsplit("/", 1)[0])
    with system.open_output_stream(target) as out:
        out.write(buffer.getvalue())
    return pd.DataFrame({"path": [path], "n": [len(rows)]})


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system Spark reads it from, for the writers in the tasks."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toUri().toString()


def symbol_of(coin: Column) -> Column:
    return F.concat(F.upper(coin), F.lit("USDT"))


def land_archives(candles: DataFrame, folder: str, pattern: str, micros: bool, columns: int = 12) -> None:
    """Candles as one zip per symbol and period (``yyyy-MM`` or ``yyyy-MM-dd``)."""
    at = F.unix_micros(F.col("source_updated_at").cast("timestamp"))
    scale = 1 if micros else 1_000
    epoch = F.floor(at / scale)
    close_time = F.floor((at + 3_599_000_000) / scale)
    fields = [
        epoch, "open", "high", "low", "close", "volume", close_time, "quote_asset_vol", "trades",
        F.col("volume") / 2, F.col("quote_asset_vol") / 2, F.lit(0),
    ]
    symbol = symbol_of(F.col("coin_id"))
    name = F.concat(
        F.lit(f"{_qualified(candles.sparkSession, folder)}/"), "coin_id", F.lit("/"), symbol, F.lit("-1h-"),
        F.date_format("source_updated_at", pattern), F.lit(".zip"),
    )
    lines = candles.select(name.alias("path"), at.alias("at"), F.concat_ws(",", *fields[:columns]).alias("line"))
    written = lines.groupBy("path").applyInPandas(_write_archive, "path string, n bigint")
    written.write.format("noop").mode("overwrite").save()


def history_and_recent(spark: SparkSession, sf_dir: str, without: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Candles to the 20th as history, perhaps without one coin, and from the 18th on as recent, with other closes."""
    bars = adapters.candles(spark, sf_dir)
    day = F.dayofmonth("source_updated_at")
    history = bars.where(day <= 20) if without is None else bars.where((day <= 20) & (F.col("coin_id") != without))
    recent = bars.where(day >= 18).withColumn("close", F.col("close") + 1)
    return history, recent


def archives(spark: SparkSession, sf_dir: str) -> str:
    """Monthly archives in milliseconds, daily ones in microseconds, and one bad file per symbol."""
    root = shared_path(spark, "archives")
    history, recent = history_and_recent(spark, sf_dir)
    land_archives(history, f"{root}/historical_monthly", "yyyy-MM", micros=False)
    land_archives(recent, f"{root}/recent_daily", "yyyy-MM-dd", micros=True)
    older = history.withColumn("source_updated_at", F.add_months("source_updated_at", -1).cast("timestamp"))
    land_archives(older, f"{root}/historical_monthly", "yyyy-MM", micros=False, columns=11)
    return root


def _land_documents(records: DataFrame, number: Column, document: Column, path: str) -> None:
    """One file per group of records; the groups have a fixed size."""
    numbered = records.withColumn("doc", F.floor(number / DOCUMENT_RECORDS))
    numbered.groupBy("doc").agg(document.alias("value")).write.partitionBy("doc").text(path)


def snapshot_files(spark: SparkSession, sf_dir: str) -> str:
    """Market records as JSON arrays, each file with its capture time."""
    path = shared_path(spark, "raw-snapshots")
    raw = adapters.raw_snapshots(spark, sf_dir)
    raw = raw.withColumn("ingested_timestamp", F.lit("2023-10-27T10:05:00Z").cast("timestamp"))
    number = F.split_part("id", F.lit("-"), F.lit(2)).cast("bigint")
    _land_documents(raw, number, F.to_json(F.collect_list(F.struct(*raw.columns))), path)
    return path


def provider_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as full provider records; some lack a homepage, a description or categories."""
    s = adapters.table(spark, sf_dir, "supplier")
    rich = F.col("s_acctbal") >= 0
    record = F.struct(
        F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("id"),
        F.concat(F.lit("s"), "s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
        F.struct(F.when(rich, F.array(F.concat(F.lit("https://example.org/"), "s_suppkey")))
                 .otherwise(F.array().cast("array<string>")).alias("homepage")).alias("links"),
        F.struct(F.when(rich, F.concat(F.lit("about "), "s_name")).alias("en")).alias("description"),
        F.when(F.col("s_nationkey") < 12, F.array(F.lit("layer-1"), F.col("s_nationkey").cast("string")))
        .alias("categories"),
        F.struct(F.concat(F.lit("img-"), "s_suppkey").alias("large")).alias("image"),
        F.lit(None).cast("string").alias("genesis_date"),
    )
    return s.select("s_suppkey", "s_acctbal", F.concat(F.lit("S"), "s_suppkey", F.lit("USDT")).alias("pair"),
                    record.alias("record"))


def metadata_files(spark: SparkSession, sf_dir: str) -> str:
    """Provider records as JSON objects keyed by pair."""
    path = shared_path(spark, "metadata")
    records = provider_records(spark, sf_dir)
    document = F.to_json(F.map_from_entries(F.collect_list(F.struct("pair", "record"))))
    _land_documents(records, F.col("s_suppkey"), document, path)
    return path


def messages(spark: SparkSession, sf_dir: str) -> str:
    """Hourly candles as live messages: each closed twice, each open once, and control replies."""
    path = shared_path(spark, "messages")
    bars = adapters.candles(spark, sf_dir)

    def message(closed: bool) -> Column:
        t = F.floor(F.unix_micros(F.col("source_updated_at").cast("timestamp")) / 1_000)
        text = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
        return F.to_json(F.struct(F.struct(
            symbol_of(F.col("coin_id")).alias("s"), t.alias("t"),
            *[F.col(name).cast("string").alias(short) for short, name in text.items()],
            F.lit(closed).alias("x"),
        ).alias("k")))

    reply = F.lit('{"result":null,"id":1}')
    rows = bars.select(F.explode(F.array(message(False), message(True), message(True), reply)).alias("value"))
    rows.write.text(path)
    return path
