"""Table schemas, as DDL text, and the fixed values the market feeds impose."""

from __future__ import annotations

# Field order of a headerless candle archive.
KLINE_FIELDS = [
    "open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms",
    "quote_asset_vol", "trades", "taker_buy_base", "taker_buy_quote", "ignore",
]

KLINE_COLUMNS = [
    "coin_id", "source_updated_at", "open", "high", "low", "close", "volume",
    "quote_asset_vol", "trades", "processed_at",
]

# Snapshot fields kept in the clean table and in the summary state.
SNAPSHOT_COLUMNS = [
    "coin_id", "symbol", "name", "current_price", "market_cap", "market_cap_rank",
    "fully_diluted_valuation", "total_volume", "high_24h", "low_24h",
    "price_change_percentage_24h", "circulating_supply", "total_supply", "max_supply",
    "ath", "ath_change_percentage", "ath_date",
]

# Tracked pairs and the id each has at the metadata provider.
PROVIDER_IDS = {
    "BTCUSDT": "bitcoin", "ETHUSDT": "ethereum", "BNBUSDT": "binancecoin", "SOLUSDT": "solana",
    "XRPUSDT": "ripple", "ADAUSDT": "cardano", "TRXUSDT": "tron", "LTCUSDT": "litecoin",
    "BCHUSDT": "bitcoin-cash", "DOTUSDT": "polkadot", "ATOMUSDT": "cosmos",
    "ETCUSDT": "ethereum-classic", "VETUSDT": "vechain",
    "ARBUSDT": "arbitrum", "MATICUSDT": "matic-network", "OPUSDT": "optimism",
    "STRKUSDT": "starknet", "IMXUSDT": "immutable-x", "MNTUSDT": "mantle",
    "FETUSDT": "fetch-ai", "RENDERUSDT": "render-token", "TAOUSDT": "bittensor",
    "NEARUSDT": "near", "GRTUSDT": "the-graph", "WLDUSDT": "worldcoin-wld", "ARKMUSDT": "arkham",
    "UNIUSDT": "uniswap", "AAVEUSDT": "aave", "MKRUSDT": "maker", "LDOUSDT": "lido-dao",
    "RUNEUSDT": "thorchain", "JUPUSDT": "jupiter-exchange-solana", "ENAUSDT": "ethena-labs",
    "PENDLEUSDT": "pendle", "INJUSDT": "injective-protocol", "ONDOUSDT": "ondo-finance",
    "AVAXUSDT": "avalanche-2", "SUIUSDT": "sui", "SEIUSDT": "sei-network", "APTUSDT": "aptos",
    "KASUSDT": "kaspa", "HBARUSDT": "hedera-hashgraph", "FTMUSDT": "fantom", "TIAUSDT": "celestia",
    "GALAUSDT": "gala", "AXSUSDT": "axie-infinity", "SANDUSDT": "the-sandbox",
    "MANAUSDT": "decentraland", "BEAMXUSDT": "beam-2",
    "FILUSDT": "filecoin", "ARUSDT": "arweave", "PYTHUSDT": "pyth-network", "LINKUSDT": "chainlink",
    "DOGEUSDT": "dogecoin", "SHIBUSDT": "shiba-inu", "PEPEUSDT": "pepe",
    "WIFUSDT": "dogwifcoin", "BONKUSDT": "bonk", "FLOKIUSDT": "floki",
}


# What the archive reader hands over: the lines of good files, or one error row per bad file.
ARCHIVE_LINES = "path string, line_no bigint, line string, error string"

KLINE = (
    "coin_id string, source_updated_at timestamp, open double, high double, low double, "
    "close double, volume double, quote_asset_vol double, trades bigint, processed_at timestamp"
)

FEATURE_COLUMNS = [
    "rsi_14", "macd", "macd_hist", "macd_signal", "bb_lower", "bb_mid", "bb_upper",
    "bb_bandwidth", "bb_percent", "sma_50", "sma_200", "log_ret",
]

FEATURES = ", ".join([KLINE, *[f"{name} double" for name in FEATURE_COLUMNS]])

SNAPSHOT_RAW = (
    "id string, symbol string, name string, current_price double, market_cap double, "
    "market_cap_rank int, fully_diluted_valuation double, total_volume double, high_24h double, "
    "low_24h double, price_change_percentage_24h double, circulating_supply double, "
    "total_supply double, max_supply double, ath double, ath_change_percentage double, "
    "ath_date timestamp, last_updated timestamp, ingested_timestamp timestamp"
)

_SNAPSHOT_BODY = (
    "coin_id string, symbol string, name string, current_price double, market_cap double, "
    "market_cap_rank int, fully_diluted_valuation double, total_volume double, high_24h double, "
    "low_24h double, price_change_percentage_24h double, circulating_supply double, "
    "total_supply double, max_supply double, ath double, ath_change_percentage double, "
    "ath_date timestamp, "
)

SNAPSHOT = (
    _SNAPSHOT_BODY + "source_updated_at timestamp, ingested_timestamp timestamp, "
    "ingested_file string, processed_at timestamp"
)

SUMMARY = (
    _SNAPSHOT_BODY + "sma_7d double, rsi_14d double, volatility_7d double, signal string, "
    "source_updated_at timestamp, ingested_file string, processed_at timestamp, "
    "analyzed_at timestamp"
)

METADATA = (
    "id string, symbol string, name string, description string, categories array<string>, "
    "image string, genesis_date string, homepage string"
)

SUMMARY_COLUMNS = [
    *SNAPSHOT_COLUMNS, "sma_7d", "rsi_14d", "volatility_7d", "signal", "source_updated_at",
    "ingested_file", "processed_at", "analyzed_at",
]

# A provider's full coin record; only the fields the lake keeps are declared.
PROVIDER_RECORD = (
    "id string, symbol string, name string, links struct<homepage: array<string>>, "
    "description struct<en: string>, categories array<string>, image struct<large: string>, "
    "genesis_date string"
)

CANDLE_EVENT = (
    "k struct<s: string, t: bigint, o: string, h: string, l: string, c: string, v: string, x: boolean>"
)

LIVE_BUFFER = (
    "symbol string, open_time_ms bigint, open double, high double, low double, close double, volume double"
)
