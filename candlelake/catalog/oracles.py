"""The registered queries in plain SQL over the same tables, for comparison in DuckDB."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def prices(key: str = "event_type", where: str = "true") -> str:
    return (f"SELECT CAST({key} AS VARCHAR) AS coin_id, ts AS source_updated_at, value AS current_price, event_id "
            f"FROM events WHERE {where}")


BEFORE, AFTER = "ts < TIMESTAMP '2024-01-20'", "ts >= TIMESTAMP '2024-01-19'"

CANDLES = """
  SELECT event_type AS coin_id, date_trunc('hour', ts) AS source_updated_at,
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, sum(value) AS volume,
         sum(value * value) AS quote_asset_vol, count(*) AS trades
  FROM events GROUP BY ALL"""

KLINE_OUT = """coin_id, source_updated_at, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
  round(close, 6) AS close, round(volume, 6) AS volume, round(quote_asset_vol, 6) AS quote_asset_vol, trades"""


def scored(rows: str, tag: str = "", distinct: bool = True) -> str:
    """CTEs that end in ``f<tag>``: indicators and signal over ``rows``."""
    w = "OVER (PARTITION BY coin_id ORDER BY source_updated_at, event_id"
    d = "DISTINCT" if distinct else ""
    return f"""
  d{tag} AS (SELECT {d} * FROM ({rows})),
  p{tag} AS (SELECT *, current_price - lag(current_price) {w}) AS diff FROM d{tag}),
  r{tag} AS (SELECT *,
      avg(current_price) {w} ROWS 6 PRECEDING) AS sma_7d,
      avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) {w} ROWS 13 PRECEDING) AS gain,
      avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) {w} ROWS 13 PRECEDING) AS loss,
      stddev_samp(diff) {w} ROWS 6 PRECEDING) AS volatility_7d
    FROM p{tag}),
  q{tag} AS (SELECT *, CASE WHEN loss = 0 THEN 100.0 ELSE 100 - 100 / (1 + gain / nullif(loss, 0)) END AS rsi_14d
    FROM r{tag}),
  f{tag} AS (SELECT *, CASE WHEN current_price < sma_7d AND rsi_14d < 30 THEN 'BUY'
      WHEN current_price > sma_7d AND rsi_14d > 70 THEN 'SELL' ELSE 'WAIT' END AS signal FROM q{tag})"""


def newest(source: str, n: int = 500) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER "
            f"(PARTITION BY coin_id ORDER BY source_updated_at DESC, event_id DESC) <= {n}")


SCORED = """coin_id, source_updated_at, round(current_price, 6) AS current_price, round(sma_7d, 6) AS sma_7d,
  round(rsi_14d, 6) AS rsi_14d, round(volatility_7d, 6) AS volatility_7d, signal"""

UNION = f"{prices(where=BEFORE)} UNION ALL {prices(where=AFTER)}"

ORACLES["signal_summary"] = f"WITH {scored(UNION)} SELECT {SCORED} FROM ({newest('f')})"
ORACLES["signal_full_history"] = f"WITH {scored(prices())} SELECT {SCORED} FROM f"

_BASE = "coin_id, source_updated_at, current_price, event_id"
_FOLD = f"""WITH {scored(prices(where=BEFORE), '1')},
  s1 AS ({newest('f1')}),
  {scored(f"SELECT {_BASE} FROM s1 UNION ALL {prices(where=AFTER)}", '2')}
  SELECT {SCORED} FROM ({newest('f2')})"""
ORACLES["summary_state"] = _FOLD
ORACLES["stream_state"] = _FOLD

ORACLES["summary_distinct_by_key"] = f"""WITH u AS ({prices(where=BEFORE)} UNION ALL
    SELECT coin_id, source_updated_at, current_price, event_id + 1000000000 FROM ({prices(where=AFTER)})),
  {scored('''SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY coin_id, source_updated_at
     ORDER BY event_id DESC) = 1''')} SELECT {SCORED} FROM ({newest('f')})"""

ORACLES["volatility_7"] = f"""WITH {scored(prices('user_id'))}
  SELECT coin_id, source_updated_at, round(volatility_7d, 6) AS volatility_7d FROM f"""

ORACLES["active_alerts"] = f"""WITH {scored(prices())}
  SELECT coin_id, source_updated_at, signal,
    '{{"username":"Market alerts","embeds":[{{"title":"🚨 ' || signal || ' SIGNAL DETECTED: ' || coin_id
    || '","color":' || CASE WHEN signal = 'BUY' THEN '5763719' ELSE '15548997' END
    || ',"fields":[{{"name":"Price","value":"$' || format('{{:,.4f}}', current_price)
    || '","inline":true}},{{"name":"RSI (14d)","value":"' || format('{{:.1f}}', rsi_14d)
    || '","inline":true}},{{"name":"Time","value":"' || strftime(source_updated_at, '%Y-%m-%d %H:%M UTC')
    || '","inline":false}}]}}]}}' AS payload
  FROM f WHERE signal <> 'WAIT'"""

ORACLES["newest_signal"] = f"""WITH {scored(UNION)} SELECT {SCORED} FROM f
  ORDER BY f.source_updated_at DESC, coin_id, event_id DESC LIMIT 1"""

ORACLES["alerts_per_user"] = f"""WITH {scored(prices('user_id'))},
  kept AS ({newest('f', 500)}), a AS (SELECT * FROM kept WHERE signal <> 'WAIT')
  SELECT {SCORED} FROM ({newest('a', 1)})"""

_SNAPSHOT = """SELECT DISTINCT 'part-' || p_partkey AS coin_id, lower(p_brand) AS symbol, p_name AS name,
    round(p_retailprice, 6) AS current_price, round(p_retailprice * p_size, 6) AS market_cap,
    p_size AS market_cap_rank,
    round(CASE WHEN p_partkey % 2 = 0 THEN p_retailprice * (p_size * 2) ELSE p_retailprice * p_size END, 6)
      AS fully_diluted_valuation,
    p_size * 1000.0::DOUBLE AS total_volume, round(p_retailprice * 1.5::DOUBLE, 6) AS high_24h,
    round(p_retailprice * 0.5::DOUBLE, 6) AS low_24h, CAST(NULL AS DOUBLE) AS price_change_percentage_24h,
    p_size::DOUBLE AS circulating_supply, p_size::DOUBLE AS total_supply,
    CASE WHEN p_partkey % 2 = 0 THEN p_size * 2.0::DOUBLE END AS max_supply,
    round(p_retailprice * 2, 6) AS ath, -50.0::DOUBLE AS ath_change_percentage,
    TIMESTAMP '2021-11-10 00:00:00' AS ath_date, TIMESTAMP '2023-10-27 10:00:00' AS source_updated_at,
    TIMESTAMP '2023-10-27 10:05:00' AS ingested_timestamp FROM part"""
ORACLES["snapshot_clean"] = _SNAPSHOT
ORACLES["snapshot_json_scan"] = _SNAPSHOT
ORACLES["snapshot_table"] = """SELECT strftime(TIMESTAMP '2023-10-27 10:05:00' + to_days(p_size), '%Y-%m-%d') AS ingest_date,
    count(*) AS n_rows,
    round(sum(CASE WHEN p_partkey % 2 = 0 THEN p_retailprice * (p_size * 2) ELSE p_retailprice * p_size END), 6) AS sum_fdv
  FROM part GROUP BY 1"""

ORACLES["keep_last_dedup"] = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
    round(l_extendedprice, 6) AS l_extendedprice, round(l_quantity, 6) AS l_quantity,
    round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC) = 1"""
ORACLES["dedup_counts"] = """SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
    CAST(sum(n) - count(*) AS BIGINT) AS rows_dropped
  FROM (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1"""

_ALL_SIDES = f"""c AS ({CANDLES}),
  h AS (SELECT * FROM c WHERE day(source_updated_at) <= 20),
  n AS (SELECT * REPLACE (close + 1 AS close) FROM c WHERE day(source_updated_at) >= 18)"""
_SIDES = _ALL_SIDES.replace("<= 20)", "<= 20 AND coin_id <> 'error')")
for _name, _both in (("gap_fill_merge", _SIDES), ("silver_merge", _ALL_SIDES), ("archive_scan", _ALL_SIDES)):
    ORACLES[_name] = f"""WITH {_both} SELECT {KLINE_OUT} FROM (
    SELECT h.* FROM h ANTI JOIN n USING (coin_id, source_updated_at)
    UNION ALL SELECT * FROM n WHERE coin_id IN (SELECT coin_id FROM h))"""
ORACLES["live_gap_fill"] = f"""WITH {_SIDES} SELECT {KLINE_OUT} FROM (
    SELECT * FROM h UNION ALL
    SELECT n.* FROM n ANTI JOIN h USING (coin_id, source_updated_at) WHERE coin_id IN (SELECT coin_id FROM h))"""
ORACLES["live_table_merge"] = f"""WITH {_ALL_SIDES}, live AS (SELECT * REPLACE (NULL AS quote_asset_vol, NULL AS trades) FROM c)
  SELECT {KLINE_OUT} FROM (SELECT * FROM h UNION ALL
    SELECT live.* FROM live ANTI JOIN h USING (coin_id, source_updated_at) WHERE coin_id IN (SELECT coin_id FROM h))"""
ORACLES["silver_append_new_coins"] = f"""WITH {_SIDES} SELECT {KLINE_OUT} FROM (
    SELECT * FROM h UNION ALL SELECT * FROM n WHERE coin_id NOT IN (SELECT coin_id FROM h))"""
ORACLES["silver_asset_scan"] = f"SELECT {KLINE_OUT} FROM ({CANDLES}) WHERE coin_id IN ('click', 'view')"
ORACLES["hourly_candles"] = f"SELECT {KLINE_OUT} FROM ({CANDLES})"
ORACLES["asset_list"] = "SELECT DISTINCT event_type AS coin_id FROM events ORDER BY 1"

_LIVE = f"""SELECT coin_id, source_updated_at, round(open, 6) AS open, round(high, 6) AS high,
  round(low, 6) AS low, round(close, 6) AS close, round(volume, 6) AS volume FROM ({CANDLES})"""
ORACLES["stream_candles"] = _LIVE
ORACLES["live_buffer_scan"] = _LIVE
ORACLES["live_compaction"] = _LIVE
ORACLES["live_rejected"] = """WITH b AS (SELECT CASE WHEN event_id % 89 = 0 THEN 'USDT' ELSE upper(event_type) || 'USDT' END AS symbol,
    CASE WHEN event_id % 89 = 0 THEN 'no pair' WHEN event_id % 83 = 0 THEN 'time out of range'
      WHEN event_id % 97 = 0 THEN 'no time' END AS reason FROM events)
  SELECT symbol, reason, count(*) AS n_rows FROM b WHERE reason IS NOT NULL GROUP BY ALL"""

ORACLES["epoch_units"] = """SELECT event_id,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) ELSE ts END AS at FROM events"""


def continuity(key: str, minutes: int) -> str:
    return f"""WITH s AS (SELECT CAST({key} AS VARCHAR) AS coin_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER
      (PARTITION BY {key} ORDER BY ts) AS step FROM events)
  SELECT coin_id, count(*) AS n_rows, count(*) FILTER (step > {minutes * 60_000_000}) AS n_gaps,
    round(max(step) / 1e6, 6) AS max_step_seconds,
    min(ts) FILTER (step > {minutes * 60_000_000}) AS first_gap_at FROM s GROUP BY coin_id"""


ORACLES["continuity_audit"] = continuity("event_type", 60)
ORACLES["continuity_by_user"] = continuity("user_id", 24 * 60)

ORACLES["missing_metadata"] = """SELECT doc_id AS symbol, source FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""
ORACLES["missing_archives"] = """WITH u AS (SELECT DISTINCT user_id FROM events),
  d AS (SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS DATE) AS period),
  landed AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS period FROM events)
  SELECT 'U' || user_id || 'USDT' AS symbol, 'u' || user_id AS coin_id, CAST(period AS VARCHAR) AS period,
    'U' || user_id || 'USDT-1m-' || period || '.zip' AS file_name
  FROM (SELECT * FROM u CROSS JOIN d) e ANTI JOIN landed USING (user_id, period)"""
ORACLES["monthly_manifest"] = """WITH t AS (SELECT DISTINCT event_type FROM events),
  m AS (SELECT unnest(generate_series(DATE '2017-08-01', DATE '2026-12-01', INTERVAL 1 MONTH)) AS period)
  SELECT event_type AS coin_id, upper(event_type) || 'USDT-1m-' || strftime(period, '%Y-%m') || '.zip' AS file_name
  FROM t CROSS JOIN m"""
ORACLES["archive_inventory"] = f"""WITH t AS (SELECT DISTINCT event_type AS coin_id FROM events),
  d AS (SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS DATE) AS period),
  landed AS (SELECT DISTINCT coin_id, CAST(source_updated_at AS DATE) AS period FROM ({CANDLES})
    WHERE day(source_updated_at) >= 18)
  SELECT coin_id, upper(coin_id) || 'USDT-1h-' || period || '.zip' AS file_name
  FROM (SELECT * FROM t CROSS JOIN d) e ANTI JOIN landed USING (coin_id, period)"""
ORACLES["archive_quarantine"] = """SELECT DISTINCT upper(event_type) || 'USDT-1h-2023-12.zip' AS file_name,
  'ValueError: not 12 columns' AS error FROM events WHERE day(ts) <= 20"""


def finite(rows: str, order: str) -> str:
    """CTE ``t``: finite-frame indicators of ``close``."""
    w = f"OVER (PARTITION BY coin_id ORDER BY {order}"
    return f"""t AS (SELECT *,
      row_number() {w}) - 1 AS pos,
      avg(close) {w} ROWS 49 PRECEDING) AS a50, avg(close) {w} ROWS 199 PRECEDING) AS a200,
      avg(close) {w} ROWS 19 PRECEDING) AS mid, stddev_pop(close) {w} ROWS 19 PRECEDING) AS sd,
      lag(close) {w}) AS before
    FROM ({rows})),
  v AS (SELECT *, CASE WHEN pos >= 49 THEN a50 END AS sma_50, CASE WHEN pos >= 199 THEN a200 END AS sma_200,
      CASE WHEN pos >= 19 THEN mid - 2 * sd END AS bb_lower, CASE WHEN pos >= 19 THEN mid END AS bb_mid,
      CASE WHEN pos >= 19 THEN mid + 2 * sd END AS bb_upper,
      CASE WHEN pos >= 19 THEN 100 * (4 * sd) / nullif(mid, 0) END AS bb_bandwidth,
      CASE WHEN pos >= 19 THEN (close - (mid - 2 * sd)) / nullif(4 * sd, 0) END AS bb_percent,
      CASE WHEN close > 0 AND before > 0 THEN ln(close / before) END AS log_ret
    FROM t)"""


FINITE_OUT = """round(sma_50, 6) AS sma_50, round(sma_200, 6) AS sma_200, round(bb_lower, 6) AS bb_lower,
  round(bb_mid, 6) AS bb_mid, round(bb_upper, 6) AS bb_upper, round(bb_bandwidth, 6) AS bb_bandwidth,
  round(bb_percent, 6) AS bb_percent, round(log_ret, 6) AS log_ret"""
_CLOSES = "SELECT coin_id, source_updated_at, current_price AS close, event_id FROM (" + prices() + ")"
_BY_TIME, _BY_EVENT = "source_updated_at", "source_updated_at, event_id"

ORACLES["finite_features"] = f"""WITH {finite(CANDLES, _BY_TIME)}
  SELECT coin_id, source_updated_at, {FINITE_OUT} FROM v"""
ORACLES["warm_up_drops"] = f"""WITH {finite(CANDLES, _BY_TIME)}, z AS (SELECT coin_id, sma_50 IS NOT NULL
    AND sma_200 IS NOT NULL AND bb_lower IS NOT NULL AND bb_bandwidth IS NOT NULL AND bb_percent IS NOT NULL
    AND log_ret IS NOT NULL AS complete FROM v)
  SELECT coin_id, count(*) AS rows_before, count(*) FILTER (complete) AS rows_after,
    count(*) FILTER (NOT complete) AS rows_dropped FROM z GROUP BY coin_id"""
ORACLES["price_features"] = f"""WITH {finite(_CLOSES, _BY_EVENT)}
  SELECT coin_id, source_updated_at, round(sma_50, 6) AS sma_50, round(sma_200, 6) AS sma_200,
    round(bb_lower, 6) AS bb_lower, round(bb_mid, 6) AS bb_mid, round(bb_upper, 6) AS bb_upper,
    round(log_ret, 6) AS log_ret FROM v"""
ORACLES["golden_cross"] = f"""WITH c AS (SELECT *, CAST(close AS DECIMAL(28, 10)) AS p FROM ({_CLOSES})),
  v AS (SELECT *, row_number() OVER w AS n, sum(p) OVER (w ROWS 49 PRECEDING) AS s50,
      sum(p) OVER (w ROWS 199 PRECEDING) AS s200
    FROM c WINDOW w AS (PARTITION BY coin_id ORDER BY source_updated_at, event_id)),
  o AS (SELECT *, CASE WHEN n >= 200 THEN 4 * s50 > s200 END AS above FROM v),
  x AS (SELECT *, lag(above) OVER (PARTITION BY coin_id ORDER BY source_updated_at, event_id) AS was FROM o),
  y AS (SELECT *, CASE WHEN above AND NOT was THEN 'golden' WHEN NOT above AND was THEN 'death' END AS "cross" FROM x)
  SELECT coin_id, source_updated_at, "cross" FROM y WHERE "cross" IS NOT NULL"""

_SERIES = f"""c AS ({CANDLES}),
  s AS (SELECT coin_id, source_updated_at, close,
      row_number() OVER w - 1 AS pos, close - lag(close) OVER w AS diff,
      avg(close) OVER (w ROWS 11 PRECEDING) AS a12, avg(close) OVER (w ROWS 25 PRECEDING) AS a26
    FROM c WINDOW w AS (PARTITION BY coin_id ORDER BY source_updated_at)),
  rs AS (SELECT coin_id, pos, greatest(diff, 0) AS g, greatest(-diff, 0) AS l FROM s WHERE pos = 1
    UNION ALL SELECT s.coin_id, s.pos, rs.g * 13 / 14 + greatest(diff, 0) / 14, rs.l * 13 / 14 + greatest(-diff, 0) / 14
    FROM rs JOIN s ON s.coin_id = rs.coin_id AND s.pos = rs.pos + 1),
  fa AS (SELECT coin_id, pos, a12 AS y FROM s WHERE pos = 11
    UNION ALL SELECT s.coin_id, s.pos, fa.y * 11 / 13 + s.close * 2 / 13
    FROM fa JOIN s ON s.coin_id = fa.coin_id AND s.pos = fa.pos + 1),
  sl AS (SELECT coin_id, pos, a26 AS y FROM s WHERE pos = 25
    UNION ALL SELECT s.coin_id, s.pos, sl.y * 25 / 27 + s.close * 2 / 27
    FROM sl JOIN s ON s.coin_id = sl.coin_id AND s.pos = sl.pos + 1),
  li AS (SELECT coin_id, pos, fa.y - sl.y AS macd FROM fa JOIN sl USING (coin_id, pos)),
  ls AS (SELECT *, avg(macd) OVER (PARTITION BY coin_id ORDER BY pos ROWS 8 PRECEDING) AS a9 FROM li),
  si AS (SELECT coin_id, pos, a9 AS y FROM ls WHERE pos = 33
    UNION ALL SELECT ls.coin_id, ls.pos, si.y * 8 / 10 + ls.macd * 2 / 10
    FROM si JOIN ls ON ls.coin_id = si.coin_id AND ls.pos = si.pos + 1),
  e AS (SELECT s.coin_id, s.source_updated_at, s.close,
      CASE WHEN s.pos >= 14 THEN 100 * g / nullif(g + l, 0) END AS rsi_14,
      macd, si.y AS macd_signal, macd - si.y AS macd_hist
    FROM s LEFT JOIN rs USING (coin_id, pos) LEFT JOIN li USING (coin_id, pos) LEFT JOIN si USING (coin_id, pos))"""
ORACLES["wilder_rsi"] = f"""WITH RECURSIVE {_SERIES}
  SELECT coin_id, source_updated_at, round(rsi_14, 6) AS rsi_14 FROM e"""
ORACLES["macd"] = f"""WITH RECURSIVE {_SERIES}
  SELECT coin_id, source_updated_at, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal,
    round(macd_hist, 6) AS macd_hist FROM e"""
ORACLES["feature_table"] = f"""WITH RECURSIVE {_SERIES}, {finite('SELECT * FROM c', _BY_TIME)}
  SELECT coin_id, source_updated_at, round(v.close, 6) AS close, round(rsi_14, 6) AS rsi_14, round(macd, 6) AS macd,
    round(macd_hist, 6) AS macd_hist, round(macd_signal, 6) AS macd_signal, {FINITE_OUT}
  FROM v JOIN e USING (coin_id, source_updated_at)
  WHERE rsi_14 IS NOT NULL AND macd_signal IS NOT NULL AND sma_200 IS NOT NULL AND bb_percent IS NOT NULL
    AND bb_bandwidth IS NOT NULL AND log_ret IS NOT NULL"""

# The stored table with each hour six hours apart: indicators depend on the order of candles only.
_APART = "TIMESTAMP '2024-01-01' + 6 * (source_updated_at - TIMESTAMP '2024-01-01')"
ORACLES["feature_increments"] = (f"SELECT * REPLACE ({_APART} AS source_updated_at) "
                                 f"FROM ({ORACLES['feature_table']})")
ORACLES["newest_candles"] = f"""WITH c AS (SELECT * REPLACE ({_APART} AS source_updated_at) FROM ({CANDLES}))
  SELECT {KLINE_OUT} FROM c WHERE coin_id <> 'error' OR source_updated_at < TIMESTAMP '2024-02-20'
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY source_updated_at DESC) <= 100"""


def magnitude(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN 'N/A' WHEN {x} >= 1e9 THEN '$' || format('{{:.2f}}', {x} / 1e9) || 'B'
    WHEN {x} >= 1e6 THEN '$' || format('{{:.2f}}', {x} / 1e6) || 'M' ELSE '$' || format('{{:,.0f}}', {x}) END"""


ORACLES["latest_metrics"] = f"""WITH {scored(UNION)}, a AS (SELECT event_type AS coin_id, max(value) AS ath,
    count(*) AS n FROM events GROUP BY 1),
  x AS (SELECT *, (current_price - ath) / ath * 100 AS down, current_price * 1000000 AS cap, ath * 10000000 AS fdv
    FROM ({newest('f', 1)}) JOIN a USING (coin_id))
  SELECT coin_id, source_updated_at, '#' || n AS rank_label, '$' || format('{{:,.4f}}', current_price) AS price_label,
    '$' || format('{{:,.2f}}', ath) AS ath_label, round(down, 6) AS ath_distance,
    format('{{:.1f}}', down) || '%' AS ath_distance_label, signal, format('{{:.1f}}', rsi_14d) AS rsi_label,
    CASE WHEN rsi_14d > 70 THEN 'Overbought > 70' WHEN rsi_14d < 30 THEN 'Oversold < 30' ELSE 'Neutral' END AS rsi_zone,
    format('{{:.2f}}', volatility_7d) AS volatility_label,
    {magnitude('cap')} AS market_cap_label, {magnitude('fdv')} AS fdv_label FROM x"""
ORACLES["report_labels"] = f"""SELECT o_orderkey, {magnitude('(o_totalprice * o_custkey)')} AS size_label,
    '$' || format('{{:,.4f}}', o_totalprice) AS price_label,
    coalesce('#' || CAST(CAST(trunc(TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE)) AS BIGINT) AS VARCHAR), 'N/A')
      AS rank_label,
    'N/A' AS no_rank,
    CASE WHEN o_totalprice / 3000 > 70 THEN 'Overbought > 70' WHEN o_totalprice / 3000 < 30 THEN 'Oversold < 30'
      ELSE 'Neutral' END AS zone FROM orders"""


def hourly(key: str) -> str:
    """CTE ``m``: hourly means over the whole grid, filled forward and then backward."""
    return f"""p AS ({prices(key)}),
  a AS (SELECT coin_id, source_updated_at, avg(current_price) AS x FROM p GROUP BY 1, 2),
  b AS (SELECT coin_id, date_trunc('hour', source_updated_at) AS hour, avg(x) AS x FROM a GROUP BY 1, 2),
  g AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM b),
  k AS (SELECT DISTINCT coin_id FROM b),
  j AS (SELECT coin_id, hour, x FROM (SELECT * FROM k CROSS JOIN g) LEFT JOIN b USING (coin_id, hour)),
  ff AS (SELECT coin_id, hour, last_value(x IGNORE NULLS) OVER (PARTITION BY coin_id ORDER BY hour) AS x FROM j),
  m AS (SELECT coin_id, hour, coalesce(x, first_value(x IGNORE NULLS) OVER (PARTITION BY coin_id ORDER BY hour
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS current_price FROM ff)"""


# Means of 2^k prices end in a 5 just past the sixth place, so they are compared to nine.
ORACLES["hourly_matrix"] = f"""WITH {hourly('event_type')}
  SELECT coin_id, hour, round(current_price, 9) AS current_price FROM m"""
ORACLES["hourly_matrix_wide"] = f"WITH {hourly('event_type')} SELECT hour, " + ", ".join(
    f"round(max(current_price) FILTER (coin_id = '{c}'), 9) AS {c}"
    for c in ("click", "error", "purchase", "signup", "view")) + " FROM m GROUP BY hour"


def correlation(key: str) -> str:
    return f"""WITH {hourly(key)},
  c AS (SELECT l.coin_id AS c1, r.coin_id AS c2, corr(l.current_price, r.current_price) AS x,
      min(l.current_price) < max(l.current_price) AND min(r.current_price) < max(r.current_price) AS moves
    FROM m l JOIN m r USING (hour) GROUP BY 1, 2)
  SELECT c1, c2, CASE WHEN moves THEN round(x, 6) END AS corr FROM c"""


ORACLES["price_correlation"] = correlation("event_type")
ORACLES["correlation_increments"] = ORACLES["price_correlation"]
ORACLES["user_correlation"] = correlation("user_id").replace(
    "WHERE true", "WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)")


def period_average(key: str, period: str, places: int = 6) -> str:
    return f"""SELECT CAST({key} AS VARCHAR) AS coin_id, date_trunc('{period}', ts)::TIMESTAMP AS period,
    round(avg(value), {places}) AS avg_price, round(stddev_samp(value), {places}) AS std_price, count(*) AS n_rows
  FROM events GROUP BY 1, 2"""


ORACLES["daily_average"] = period_average("event_type", "day")
ORACLES["monthly_average"] = period_average("user_id", "month")
ORACLES["rollup_averages"] = " UNION ALL ".join(
    f"SELECT *, '{grain}' AS grain FROM ({period_average('event_type', grain, 9)})" for grain in ("day", "month"))
ORACLES["retention"] = "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'"
ORACLES["asset_history"] = """SELECT ts AS source_updated_at, round(value, 6) AS current_price FROM events
  WHERE event_type = 'purchase' ORDER BY ts DESC"""
ORACLES["job_outcomes"] = """WITH n AS (SELECT c_custkey, count(user_id) AS n FROM customer
    LEFT JOIN events ON user_id = c_custkey GROUP BY 1)
  SELECT CASE WHEN n = 0 THEN 'no data' WHEN n < 65 THEN 'short history' ELSE 'ok' END AS status, count(*) AS n_coins
  FROM n GROUP BY 1"""
ORACLES["metadata_lookup"] = """SELECT doc_id AS symbol, lang, quality AS provider_id
  FROM documents LEFT JOIN labels USING (doc_id)"""
ORACLES["metadata_unmapped"] = "SELECT doc_id AS symbol, lang FROM documents ANTI JOIN labels USING (doc_id)"
ORACLES["metadata_documents"] = """SELECT 'S' || s_suppkey || 'USDT' AS pair, lower(replace(s_name, '#', '-')) AS id,
    's' || s_suppkey AS symbol, s_name AS name,
    CASE WHEN s_acctbal >= 0 THEN 'about ' || s_name ELSE '' END AS description,
    CASE WHEN s_nationkey < 12 THEN 'layer-1|' || s_nationkey ELSE '' END AS categories,
    'img-' || s_suppkey AS image, CAST(NULL AS VARCHAR) AS genesis_date,
    CASE WHEN s_acctbal >= 0 THEN 'https://example.org/' || s_suppkey ELSE '' END AS homepage FROM supplier"""
ORACLES["metadata_stored"] = ORACLES["metadata_documents"]
ORACLES["metadata_upsert"] = """SELECT 'S' || s_suppkey || 'USDT' AS pair, lower(replace(s_name, '#', '-')) AS id,
    CASE WHEN s_acctbal >= 0 THEN 'about ' || s_name ELSE 'fetched again' END AS description,
    CASE WHEN s_acctbal >= 0 THEN 1 ELSE 2 END AS fetched_at FROM supplier"""
ORACLES["metadata_enrich"] = """SELECT c_custkey, round(c_acctbal, 6) AS c_acctbal, n_name AS name, r_name AS category
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""
ORACLES["json_props"] = """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 6) AS total
  FROM events GROUP BY 1"""
