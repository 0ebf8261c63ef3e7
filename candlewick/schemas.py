"""Table schemas and the candle-interval enumeration."""

from __future__ import annotations

from pyspark.sql import types as T

# Prices and volumes. One digit short of Spark's maximum, so that the
# difference of two values still fits decimal(38,18) without losing scale.
AMOUNT = T.DecimalType(37, 18)
AMOUNT_SQL = "decimal(37,18)"

# The candle intervals and their lengths in seconds.
INTERVAL_SECONDS = {
    "1m": 60,
    "5m": 300,
    "15m": 900,
    "1h": 3600,
    "4h": 14400,
    "1d": 86400,
    "1w": 604800,
}
INTERVALS = tuple(INTERVAL_SECONDS)
DEFAULT_INTERVAL = "5m"

# Candle length as an expression; a minute for a name outside the enumeration.
INTERVAL_SECONDS_SQL = (
    "(case interval "
    + " ".join(f"when '{name}' then {seconds}" for name, seconds in INTERVAL_SECONDS.items())
    + " else 60 end)"
)

# The label sets of the regime columns.
TREND_REGIMES = ("bullish", "bearish", "ranging")
MOMENTUM_REGIMES = ("strengthening", "weakening", "neutral")
VOLATILITY_REGIMES = ("extreme", "elevated", "normal")


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in fields])


TICKER = _table(
    ("event_id", T.StringType()),
    ("source", T.StringType()),
    ("symbol", T.StringType()),
    ("event_time", T.TimestampType()),
    ("ingest_time", T.TimestampType()),
    ("last_price", AMOUNT),
    ("price_change_24h", AMOUNT),
    ("price_change_pct_24h", AMOUNT),
    ("volume_24h", AMOUNT),
    ("quote_volume_24h", AMOUNT),
    ("open_price_24h", AMOUNT),
    ("high_price_24h", AMOUNT),
    ("low_price_24h", AMOUNT),
    ("trade_count_24h", T.LongType()),
    ("raw_payload", T.StringType()),
)

KLINE = _table(
    ("event_id", T.StringType()),
    ("source", T.StringType()),
    ("symbol", T.StringType()),
    ("interval", T.StringType()),
    ("open_time", T.TimestampType()),
    ("close_time", T.TimestampType()),
    ("open_price", AMOUNT),
    ("high_price", AMOUNT),
    ("low_price", AMOUNT),
    ("close_price", AMOUNT),
    ("volume", AMOUNT),
    ("quote_asset_volume", AMOUNT),
    ("trade_count", T.LongType()),
    ("is_closed", T.BooleanType()),
    ("ingest_time", T.TimestampType()),
    ("raw_payload", T.StringType()),
)

TABLES = {"ticker": TICKER, "kline": KLINE}

_TEXT, _TIME, _REAL = T.StringType(), T.TimestampType(), T.DoubleType()

OHLCV = T.StructType(
    [
        *[T.StructField(name, _TEXT) for name in ("event_id", "source", "symbol", "interval")],
        T.StructField("candle_time", _TIME),
        *[
            T.StructField(name, AMOUNT)
            for name in ("open", "high", "low", "close", "volume", "quote_asset_volume")
        ],
        T.StructField("trade_count", T.LongType()),
        T.StructField("is_closed", T.BooleanType()),
        T.StructField("ingest_time", _TIME),
        *[
            T.StructField(name, _REAL)
            for name in (
                "sma_20", "sma_50", "ema_20", "ema_50", "volume_ma_20",
                "rsi_14", "atr_14", "candle_range_pct",
            )
        ],
        T.StructField("rolling_high_20", AMOUNT),
        T.StructField("rolling_low_20", AMOUNT),
        T.StructField("trend_regime", _TEXT),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("symbol", _TEXT),
        T.StructField("interval", _TEXT),
        T.StructField("as_of_time", _TIME),
        T.StructField("last_price", AMOUNT),
        T.StructField("price_change_pct_24h_exchange", AMOUNT),
        *[
            T.StructField(f"price_change_pct_{lag}", _REAL)
            for lag in ("5m", "15m", "1h", "4h", "24h", "1w")
        ],
        T.StructField("volume_24h", AMOUNT),
        T.StructField("quote_volume_24h", AMOUNT),
        T.StructField("intraday_volatility", _REAL),
        *[
            T.StructField(name, _TEXT)
            for name in ("trend_regime", "momentum_regime", "volatility_regime")
        ],
        T.StructField("breakout_flag", T.BooleanType()),
        T.StructField("pullback_flag", T.BooleanType()),
        *[
            T.StructField(name, _REAL)
            for name in (
                "distance_to_resistance_pct", "distance_to_support_pct", "rsi_14", "atr_14",
                "volume_ma_20", "sma_20", "sma_50", "ema_20", "ema_50",
            )
        ],
        T.StructField("signal_strength_score", T.IntegerType()),
    ]
)

OHLCV_COLUMNS = tuple(OHLCV.names)
SNAPSHOT_COLUMNS = tuple(SNAPSHOT.names)


def parse_intervals(text: str | None) -> tuple[str, ...]:
    """Split a comma-separated interval list, dropping blanks and rejecting unknown names."""
    if text is None:
        return (DEFAULT_INTERVAL,)
    names = tuple(part.strip() for part in text.split(",") if part.strip())
    if not names:
        raise ValueError("At least one candle interval is required.")
    unknown = sorted(set(names).difference(INTERVALS))
    if unknown:
        raise ValueError("Unsupported candle intervals: " + ", ".join(unknown))
    return names
