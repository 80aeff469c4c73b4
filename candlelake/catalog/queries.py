"""The registered queries: each runs a plan of the lake over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake import adapters
from candlelake.adapters import PRICES, candles, prices, table
from candlelake.catalog import landing
from candlelake.functions import text
from candlelake.functions.keys import epoch_to_time
from candlelake.operators.blocks import Series
from candlelake.operators.correlation import BLOCK_HOURS, correlation_matrix
from candlelake.operators.dedup import dedup_metrics, keep_last
from candlelake.operators.newest import top_rows
from candlelake.plans import alerts, comoments, features, klines, manifest, metadata, quality, reporting, rollups, snapshots, summary
from candlelake.schemas import FEATURE_COLUMNS, PROVIDER_RECORD
from candlelake.session import settle, shared_path, use_utc
from candlelake.sinks import tables as sinks
from candlelake.sinks.features import refresh_features
from candlelake.sources import archives, live
from candlelake.sources import metadata as metadata_source
from candlelake.sources import snapshots as snapshot_source
from candlelake.sources import tables as stored
from candlelake.streaming import candles as candle_stream
from candlelake.streaming import compaction
from candlelake.streaming import snapshots as snapshot_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONE_KEY = Series("coin_id", "source_updated_at")
NEW_FROM, OLD_TO = dt.datetime(2024, 1, 19), dt.datetime(2024, 1, 20)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles to some places, times without a zone: what both engines print alike."""
    chosen = df.select(*columns) if columns else df
    out: list[Column] = []
    for f in chosen.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, places)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return chosen.select(*out)


def _ntz(value: dt.datetime) -> Column:
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Price history and new prices; one day is in both."""
    p = prices(spark, sf_dir)
    return p.where(F.col("source_updated_at") < _ntz(OLD_TO)), p.where(F.col("source_updated_at") >= _ntz(NEW_FROM))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summarize(summary.combine(*_split(spark, sf_dir)), PRICES)


SCORED = ["coin_id", "source_updated_at", "current_price", "sma_7d", "rsi_14d", "volatility_7d", "signal"]


@query
def signal_summary(spark, sf_dir):
    return rounded(summary.newest_first(_summary(spark, sf_dir)), *SCORED)


@query
def signal_full_history(spark, sf_dir):
    return rounded(summary.full_history(prices(spark, sf_dir), PRICES), *SCORED)


@query
def summary_state(spark, sf_dir):
    old, new = _split(spark, sf_dir)
    state = settle(summary.update_state(None, old, PRICES), "state")
    return rounded(summary.update_state(state, new, PRICES), *SCORED)


@query
def summary_distinct_by_key(spark, sf_dir):
    old, new = _split(spark, sf_dir)
    copies = summary.combine(old, new.withColumn("event_id", F.col("event_id") + 1_000_000_000))
    return rounded(summary.summarize(copies, PRICES, distinct="key"), *SCORED)


@query
def volatility_7(spark, sf_dir):
    by_user = prices(spark, sf_dir, "user_id")
    return rounded(summary.full_history(by_user, PRICES), "coin_id", "source_updated_at", "volatility_7d")


@query
def active_alerts(spark, sf_dir):
    active = alerts.active(summary.full_history(prices(spark, sf_dir), PRICES))
    rows = alerts.alert_rows(active, "coin_id", F.col("source_updated_at"))
    return rounded(rows, "coin_id", "source_updated_at", "signal", "payload")


@query
def newest_signal(spark, sf_dir):
    return rounded(alerts.newest_row(_summary(spark, sf_dir), PRICES), *SCORED)


@query
def alerts_per_user(spark, sf_dir):
    """The newest row of each user that asks for action."""
    by_user = alerts.active(summary.summarize(prices(spark, sf_dir, "user_id"), PRICES))
    return rounded(alerts.alerts_per_coin(by_user, PRICES), *SCORED)


@query
def snapshot_clean(spark, sf_dir):
    raw = snapshots.stamp(adapters.raw_snapshots(spark, sf_dir), F.lit("2023-10-27T10:05:00Z").cast("timestamp"))
    return rounded(snapshots.clean(raw.unionByName(raw)).drop("processed_at"))


@query
def snapshot_json_scan(spark, sf_dir):
    raw = snapshot_source.read_snapshots(spark, landing.snapshot_files(spark, sf_dir))
    return rounded(snapshots.clean(raw).drop("processed_at", "ingested_file"))


@query
def snapshot_table(spark, sf_dir):
    raw = snapshots.stamp(
        adapters.raw_snapshots(spark, sf_dir),
        F.expr("timestamp'2023-10-27 10:05:00Z' + make_dt_interval(market_cap_rank)"),
    )
    raw_path, clean_path = shared_path(spark, "raw-json"), shared_path(spark, "clean")
    sinks.write_raw_json(raw, raw_path)
    read = snapshot_source.read_snapshots(spark, raw_path, multi_line=False)
    sinks.write_snapshots(snapshots.clean(read), clean_path)
    return rounded(spark.read.parquet(clean_path).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("fully_diluted_valuation").alias("sum_fdv"),
    ).withColumn("ingest_date", F.col("ingest_date").cast("string")))


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query
def keep_last_dedup(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, *LINE_ORDER)
    return rounded(keep_last(lines, keys, LINE_ORDER))


@query
def dedup_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedup_metrics(lines, "l_returnflag", ["l_orderkey", "l_linenumber"])


KLINE_OUT = ["coin_id", "source_updated_at", "open", "high", "low", "close", "volume", "quote_asset_vol", "trades"]


@query
def gap_fill_merge(spark, sf_dir):
    history, recent = landing.history_and_recent(spark, sf_dir, without="error")
    return rounded(klines.gap_fill(history, recent), *KLINE_OUT)


@query
def silver_merge(spark, sf_dir):
    history, recent = landing.history_and_recent(spark, sf_dir)
    root = shared_path(spark, "silver")
    sinks.write_silver(history, root)
    sinks.merge_recent(root, recent)
    return rounded(stored.read_candles(spark, root), *KLINE_OUT)


@query
def silver_append_new_coins(spark, sf_dir):
    history, recent = landing.history_and_recent(spark, sf_dir, without="error")
    root = shared_path(spark, "silver")
    sinks.write_silver(history, root)
    sinks.append_new_coins(recent, root)
    return rounded(stored.read_candles(spark, root), *KLINE_OUT)


@query
def silver_asset_scan(spark, sf_dir):
    root = shared_path(spark, "silver")
    sinks.write_silver(candles(spark, sf_dir), root)
    chosen = reporting.select_assets(stored.read_candles(spark, root), ["CLICK", "view"])
    return rounded(chosen, *KLINE_OUT)


@query
def asset_list(spark, sf_dir):
    root = shared_path(spark, "silver")
    sinks.write_silver(candles(spark, sf_dir), root)
    return stored.discover_assets(spark, root)


@query
def live_gap_fill(spark, sf_dir):
    """Live candles fill the hours the history lacks and replace none of it."""
    history, recent = landing.history_and_recent(spark, sf_dir, without="error")
    return rounded(klines.gap_fill(history, recent, recent_source=klines.LIVE), *KLINE_OUT)


@query
def epoch_units(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.floor(micros / 1000)).otherwise(micros).alias("epoch"),
    )
    return rounded(raw.select("event_id", epoch_to_time("epoch").alias("at")))


@query
def continuity_audit(spark, sf_dir):
    return rounded(quality.continuity(prices(spark, sf_dir), PRICES, 60))


@query
def continuity_by_user(spark, sf_dir):
    return rounded(quality.continuity(prices(spark, sf_dir, "user_id"), PRICES, 24 * 60))


@query
def missing_metadata(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("symbol"), "source")
    done = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("symbol"), F.when(F.col("quality") == 1, "good").otherwise("").alias("description"),
    )
    return metadata.still_needed(pairs, done)


def _days(events: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last day that has events."""
    return tuple(events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first())


@query
def missing_archives(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    symbol = F.concat(F.lit("U"), F.col("user_id"), F.lit("USDT")).alias("symbol")
    landed = events.select(symbol, F.to_date("ts").alias("period"))
    expected = manifest.daily_between(events.select(symbol).distinct(), *_days(events))
    rows = manifest.missing(expected, landed, ["symbol", "period"])
    return rows.select("symbol", "coin_id", F.col("period").cast("string").alias("period"), "file_name")


@query
def monthly_manifest(spark, sf_dir):
    types = table(spark, sf_dir, "events").select(landing.symbol_of(F.col("event_type")).alias("symbol")).distinct()
    return manifest.monthly(types, last=dt.date(2026, 12, 1)).select("coin_id", "file_name")


@query
def hourly_candles(spark, sf_dir):
    return rounded(candles(spark, sf_dir), *KLINE_OUT)


def _settled_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(candles(spark, sf_dir), "candles")


@query
def finite_features(spark, sf_dir):
    steps = ["sma", "bands", "log_return"]
    out = features.add_features(_settled_candles(spark, sf_dir), steps)
    return rounded(out, "coin_id", "source_updated_at", "sma_50", "sma_200", "bb_lower", "bb_mid", "bb_upper",
                   "bb_bandwidth", "bb_percent", "log_ret")


def _as_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the close of its own candle."""
    return prices(spark, sf_dir).withColumnRenamed("current_price", "close")


@query
def price_features(spark, sf_dir):
    out = features.add_features(_as_closes(spark, sf_dir), ["sma", "bands", "log_return"], PRICES)
    return rounded(out, "coin_id", "source_updated_at", "sma_50", "sma_200", "bb_lower", "bb_mid", "bb_upper",
                   "log_ret")


@query
def golden_cross(spark, sf_dir):
    return rounded(features.crosses(_as_closes(spark, sf_dir), PRICES), "coin_id", "source_updated_at", "cross")


@query
def wilder_rsi(spark, sf_dir):
    out = features.add_features(_settled_candles(spark, sf_dir), ["rsi"])
    return rounded(out, "coin_id", "source_updated_at", "rsi_14")


@query
def macd(spark, sf_dir):
    out = features.add_features(_settled_candles(spark, sf_dir), ["macd"])
    return rounded(out, "coin_id", "source_updated_at", "macd", "macd_signal", "macd_hist")


@query
def feature_table(spark, sf_dir):
    """Silver scan, all features, warm-up drop, partitioned write, read back."""
    silver, gold = shared_path(spark, "silver"), shared_path(spark, "gold")
    sinks.write_silver(candles(spark, sf_dir), silver)
    rich = features.add_features(stored.read_candles(spark, silver))
    sinks.write_features(features.drop_warm_up(rich), gold)
    return rounded(stored.read_features(spark, gold), "coin_id", "source_updated_at", "close", *FEATURE_COLUMNS)


def _stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles, six hours apart, so that the 30 days of events become half a year."""
    bars, start = candles(spark, sf_dir), 1_704_067_200_000_000        # 2024-01-01
    us = F.unix_micros(F.col("source_updated_at").cast("timestamp"))
    apart = F.timestamp_micros(start + 6 * (us - start)).cast(bars.schema["source_updated_at"].dataType)
    return settle(bars.withColumn("source_updated_at", apart), "stretched")


@query
def feature_increments(spark, sf_dir):
    """The feature table in three runs: some months, the months after them, and a day that comes late."""
    silver, gold, states = (shared_path(spark, name) for name in ("silver", "gold", "states"))
    bars, ts = _stretched(spark, sf_dir), F.col("source_updated_at")
    late = (ts >= _ntz(dt.datetime(2024, 2, 10))) & (ts < _ntz(dt.datetime(2024, 2, 11)))
    early = ts < _ntz(dt.datetime(2024, 4, 20))
    sinks.write_silver(bars.where(early & ~late), silver)
    refresh_features(spark, silver, gold, states)
    for more in (bars.where(~early), bars.where(late)):
        sinks.merge_recent(silver, more)
        refresh_features(spark, silver, gold, states)
    return rounded(stored.read_features(spark, gold), "coin_id", "source_updated_at", "close", *FEATURE_COLUMNS)


@query
def newest_candles(spark, sf_dir):
    """The 100 newest candles of each coin, one of which ended months before the others."""
    silver, bars = shared_path(spark, "silver"), _stretched(spark, sf_dir)
    ended = (F.col("coin_id") == "error") & (F.col("source_updated_at") >= _ntz(dt.datetime(2024, 2, 20)))
    sinks.write_silver(bars.where(~ended), silver)
    return rounded(top_rows(stored.read_newest(spark, silver, 100), ONE_KEY, 100), *KLINE_OUT)


@query
def warm_up_drops(spark, sf_dir):
    rich = features.add_features(_settled_candles(spark, sf_dir), ["sma", "bands", "log_return"])
    return features.warm_up_counts(rich)


@query
def latest_metrics(spark, sf_dir):
    p = prices(spark, sf_dir)
    highs = p.groupBy("coin_id").agg(F.max("current_price").alias("ath"), F.count(F.lit(1)).alias("n"))
    rich = _summary(spark, sf_dir).join(highs, "coin_id").withColumns({
        "market_cap": F.col("current_price") * 1_000_000, "fully_diluted_valuation": F.col("ath") * 10_000_000,
        "market_cap_rank": F.col("n").cast("int"),
    })
    return rounded(reporting.latest_metrics(rich, PRICES))


@query
def report_labels(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    size = F.col("o_totalprice") * F.col("o_custkey")
    return o.select(
        "o_orderkey", text.magnitude(size).alias("size_label"), text.money("o_totalprice", 4).alias("price_label"),
        text.rank_label(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("rank_label"),
        text.rank_label("o_orderstatus").alias("no_rank"),
        text.rsi_zone(F.col("o_totalprice") / 3000).alias("zone"),
    )


@query
def hourly_matrix(spark, sf_dir):
    return rounded(reporting.hourly_prices(prices(spark, sf_dir), PRICES), places=9)


@query
def hourly_matrix_wide(spark, sf_dir):
    hourly = reporting.hourly_prices(prices(spark, sf_dir), PRICES)
    names = reporting.names(hourly, most=100)
    return rounded(reporting.wide_prices(hourly, names), places=9)


@query
def price_correlation(spark, sf_dir):
    hourly = settle(reporting.hourly_prices(prices(spark, sf_dir), PRICES), "hourly")
    return rounded(correlation_matrix(hourly))


@query
def correlation_increments(spark, sf_dir):
    """The correlation of all pairs from stored blocks of hours, of which the last ones came in a second run."""
    p, root = prices(spark, sf_dir), shared_path(spark, "comoments")
    hour = F.date_trunc("HOUR", F.col("source_updated_at").cast("timestamp"))
    hourly = settle(reporting.mean_prices(p, PRICES).groupBy("coin_id", hour.alias("hour")).agg(
        F.avg("current_price").alias("current_price")), "hourly-means")
    block = F.floor(F.unix_micros("hour") / 3_600_000_000 / BLOCK_HOURS)
    later = hourly.agg(F.max(block)).first()[0]
    comoments.refresh_comoments(hourly.where(F.col("hour") < _ntz(OLD_TO)), root)
    comoments.refresh_comoments(hourly.where(block >= F.lit(later)), root)
    return rounded(comoments.correlations(spark, root))


@query
def user_correlation(spark, sf_dir):
    """The pairs of the 50 users with most prices: a bounded choice out of a key that grows."""
    by_user = prices(spark, sf_dir, "user_id")
    most = settle(by_user.groupBy("coin_id").count().orderBy(F.desc("count"), F.col("coin_id").cast("bigint")).limit(50)
                  .select("coin_id"), "chosen")
    hourly = settle(reporting.hourly_prices(by_user.join(most, "coin_id", "left_semi"), PRICES), "hourly")
    return rounded(correlation_matrix(hourly))


@query
def daily_average(spark, sf_dir):
    return rounded(reporting.period_average(prices(spark, sf_dir), "DAY", PRICES))


@query
def monthly_average(spark, sf_dir):
    return rounded(reporting.period_average(prices(spark, sf_dir, "user_id"), "MONTH", PRICES))


@query
def rollup_averages(spark, sf_dir):
    """Daily and monthly averages from stored hourly summaries, whose last days came in a second run."""
    root, rows = shared_path(spark, "rollup"), prices(spark, sf_dir)
    ts = F.col("source_updated_at")
    rollups.refresh_rollup(rows.where(ts < _ntz(OLD_TO - dt.timedelta(hours=3))), root, PRICES)
    rollups.refresh_rollup(rows.where(ts >= _ntz(NEW_FROM)), root, PRICES)
    stored_rows = rollups.read_rollup(spark, root)
    both = [rollups.averages(stored_rows, grain).withColumn("grain", F.lit(grain.lower())) for grain in ("DAY", "MONTH")]
    return rounded(both[0].unionByName(both[1]), places=9)      # means of 2^k prices are exact ties at the sixth place


@query
def retention(spark, sf_dir):
    kept = reporting.retain(table(spark, sf_dir, "events"), "ts", 10, F.lit("2024-01-25T12:00:00Z").cast("timestamp"))
    return rounded(kept, "event_id", "ts")


@query
def asset_history(spark, sf_dir):
    return rounded(reporting.asset_history(prices(spark, sf_dir), "purchase"), "source_updated_at", "current_price")


@query
def job_outcomes(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("coin_id"))
    rows = prices(spark, sf_dir, "user_id")
    return quality.outcome_counts(quality.outcomes(wanted, rows, warm_up=65))


@query
def metadata_lookup(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("symbol"), "lang")
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("symbol"), F.col("quality").alias("provider_id"))
    return metadata.with_provider_id(pairs, ids)


@query
def metadata_unmapped(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("symbol"), "lang")
    return metadata.unmapped(pairs, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("symbol")))


@query
def metadata_documents(spark, sf_dir):
    path = landing.metadata_files(spark, sf_dir)
    kept = metadata.extract(metadata_source.read_documents(spark, path, PROVIDER_RECORD))
    return kept.withColumn("categories", F.concat_ws("|", "categories"))


@query
def metadata_stored(spark, sf_dir):
    """Records are written as stored documents and read back."""
    path = shared_path(spark, "metadata")
    sinks.write_metadata(metadata.extract(landing.provider_records(spark, sf_dir)), path)
    kept = metadata_source.read_documents(spark, path, multi_line=False).select("pair", "record.*")
    return kept.withColumn("categories", F.concat_ws("|", "categories"))


@query
def metadata_upsert(spark, sf_dir):
    stored_rows = metadata.extract(landing.provider_records(spark, sf_dir)).withColumn("fetched_at", F.lit(1))
    fetched = metadata.extract(
        landing.provider_records(spark, sf_dir).where(F.col("s_acctbal") < 0)
    ).withColumns({"description": F.lit("fetched again"), "fetched_at": F.lit(2)})
    return metadata.upsert(stored_rows, fetched).select("pair", "id", "description", "fetched_at")


@query
def metadata_enrich(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    about = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"), F.col("r_name").alias("category"),
    )
    rows = metadata.enrich(table(spark, sf_dir, "customer"), about, "c_nationkey")
    return rounded(rows, "c_custkey", "c_acctbal", "name", "category")


@query
def json_props(spark, sf_dir):
    props = F.from_json("props", "k bigint").alias("p")
    parsed = table(spark, sf_dir, "events").select(props, "value")
    return rounded(parsed.groupBy(F.col("p.k").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


@query
def archive_scan(spark, sf_dir):
    """Zip archives: history in milliseconds, recent days in microseconds, recent rows winning."""
    root = landing.archives(spark, sf_dir)
    now = F.lit("2024-02-01T00:00:00Z").cast("timestamp")
    history = klines.history(archives.read_archives(spark, f"{root}/historical_monthly"), now)
    recent = klines.type_lines(archives.read_archives(spark, f"{root}/recent_daily"), now, klines.DAILY)
    return rounded(klines.gap_fill(settle(history, "history"), recent), *KLINE_OUT)


@query
def archive_quarantine(spark, sf_dir):
    root = landing.archives(spark, sf_dir)
    bad = klines.quarantine(archives.read_archives(spark, root))
    return bad.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "error")


@query
def archive_inventory(spark, sf_dir):
    """Expected daily archives that have not landed as valid files."""
    root = landing.archives(spark, sf_dir)
    landed = archives.inventory(spark, f"{root}/recent_daily").where(F.col("error").isNull())
    types = table(spark, sf_dir, "events").select(landing.symbol_of(F.col("event_type")).alias("symbol")).distinct()
    first, last = _days(table(spark, sf_dir, "events"))      # daily files cover the last days only
    expected = manifest.daily_between(types, first, last, "1h")
    return manifest.missing(expected, landed, ["file_name"]).select("coin_id", "file_name")


def _stream_to_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = live.stream_messages(spark, "text", path=landing.messages(spark, sf_dir))
    buffer = candle_stream.closed_candles(messages)
    root = shared_path(spark, "live")
    candle_stream.append_candles(
        candle_stream.clean_candles(buffer), root, shared_path(spark, "live-checkpoint")).awaitTermination()
    return candle_stream.read_live(spark, root)


@query
def stream_candles(spark, sf_dir):
    return rounded(_stream_to_buffer(spark, sf_dir), "coin_id", "source_updated_at", "open", "high", "low",
                   "close", "volume")


@query
def live_compaction(spark, sf_dir):
    """Live candles in batches of a few files, compacted while the stream is between two runs and after it."""
    path, root, checkpoint = landing.messages(spark, sf_dir), shared_path(spark, "live"), shared_path(spark, "live-checkpoint")
    for last in (False, True):
        messages = live.stream_messages(spark, "text", path=path, maxFilesPerTrigger="2")
        rows = candle_stream.clean_candles(candle_stream.closed_candles(messages))
        compaction.append_batches(rows, root, checkpoint).awaitTermination()
        compaction.compact(spark, root, stopped=last)
    return rounded(compaction.read_compacted(spark, root), "coin_id", "source_updated_at", "open", "high", "low",
                   "close", "volume")


@query
def live_rejected(spark, sf_dir):
    """Buffer rows without a pair or a time, set aside with the reason."""
    e = F.col("event_id")
    t = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000)
    buffer = table(spark, sf_dir, "events").select(
        F.when(e % 89 == 0, "USDT").otherwise(landing.symbol_of(F.col("event_type"))).alias("symbol"),
        F.when(e % 83 == 0, F.lit(99_999_999_999_999_999)).when(e % 97 != 0, t).alias("open_time_ms"),
        *[F.col("value").alias(name) for name in ("open", "high", "low", "close", "volume")])
    return candle_stream.rejected_candles(buffer).groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def live_table_merge(spark, sf_dir):
    """The streamed candles fill the stored history's gaps."""
    history, _ = landing.history_and_recent(spark, sf_dir)
    root = shared_path(spark, "silver")
    sinks.write_silver(history.withColumn("processed_at", F.current_timestamp()), root)
    sinks.merge_recent(root, _stream_to_buffer(spark, sf_dir), source=klines.LIVE)
    return rounded(stored.read_candles(spark, root), *KLINE_OUT)


@query
def live_buffer_scan(spark, sf_dir):
    """The CSV buffer of closed candles, in the clean table's shape."""
    bars = candles(spark, sf_dir)
    path = shared_path(spark, "buffer")
    t = F.floor(F.unix_micros(F.col("source_updated_at").cast("timestamp")) / 1_000)
    bars.select(landing.symbol_of(F.col("coin_id")), t, "open", "high", "low", "close", "volume").write.csv(path)
    return rounded(klines.live_candles(live.read_buffer(spark, path)), "coin_id", "source_updated_at", "open",
                   "high", "low", "close", "volume")


@query
def stream_state(spark, sf_dir):
    """Snapshot files are cleaned as they arrive, and the clean rows carried into the state."""
    raw = prices(spark, sf_dir).select(
        F.col("coin_id").alias("id"), F.col("coin_id").alias("symbol"), "current_price",
        F.col("source_updated_at").cast("timestamp").alias("last_updated"),
        F.lit("2024-02-01T00:00:00Z").cast("timestamp").alias("ingested_timestamp"),
    )
    landed, clean_root = shared_path(spark, "arrivals"), shared_path(spark, "clean")
    state_root = shared_path(spark, "state")
    clean_checkpoint, state_checkpoint = shared_path(spark, "checkpoint"), shared_path(spark, "checkpoint")
    first, second = F.lit("2024-01-19T00:00:00Z"), F.lit("2024-01-20T00:00:00Z")
    for arriving in (raw.where(F.col("last_updated") < second), raw.where(F.col("last_updated") >= first)):
        sinks.write_raw_json(arriving, landed)
        files = snapshot_source.stream_snapshots(spark, landed, multi_line=False)
        snapshot_stream.clean_arrivals(files, clean_root, clean_checkpoint).awaitTermination()
        clean = snapshot_stream.stream_clean(spark, clean_root)
        snapshot_stream.carry_state(clean, state_root, state_checkpoint).awaitTermination()
    return rounded(snapshot_stream.read_state(spark, state_root), *SCORED)
