"""Registered queries: one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from candlewick.functions.columns import choose
from candlewick.operators import indicators as ind, quality
from candlewick.operators.normalize import normalize_klines, normalize_ticker, rejects
from candlewick.operators.staging import closed_candles, stg_klines, stg_ticker
from candlewick.operators.upsert import latest_by_key
from candlewick.operators.validate import clean_rows, invalid_rows, validate
from candlewick.plans import panels, snapshot as snap
from candlewick.plans.ohlcv import ohlcv_indicators
from candlewick.schemas import AMOUNT, KLINE, OHLCV_COLUMNS, TICKER
from candlewick.session import configure
from candlewick.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    _QUERIES[build.__name__.rstrip("_")] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def report(df: DataFrame, rounded: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Engine-neutral output: decimals as double, instants as UTC wall time, ``rounded`` to 8 places."""
    texts = []
    for field in df.schema:
        if field.name in drop:
            continue
        text = field.name
        if isinstance(field.dataType, T.DecimalType):
            text = f"cast({text} as double)"
        elif isinstance(field.dataType, T.TimestampType):
            text = f"cast({text} as timestamp_ntz)"
        if field.name in rounded:
            text = f"round({text}, 8)"
        texts.append(f"{text} as {field.name}")
    return df.selectExpr(*texts)


def _klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_klines(testdata.candles(spark, sf_dir))


def _ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_ticker(testdata.tickers(spark, sf_dir))


def _closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_candles(_klines(spark, sf_dir))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed(spark, sf_dir).selectExpr(
        "event_id", "symbol", "interval", "close_time as candle_time", "close_price as close"
    )


def _ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv_indicators(_klines(spark, sf_dir))


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.market_snapshot(
        _ohlcv(spark, sf_dir), _ticker(spark, sf_dir), _history(spark, sf_dir)
    )


# --- staging -----------------------------------------------------------------------


@query
def stg_klines_(spark, sf_dir):
    return report(_klines(spark, sf_dir), drop=["raw_payload"])


@query
def stg_ticker_(spark, sf_dir):
    return report(_ticker(spark, sf_dir), drop=["raw_payload"])


@query
def closed_candles_(spark, sf_dir):
    return report(_closed(spark, sf_dir), drop=["raw_payload"])


# --- indicators --------------------------------------------------------------------


@query
def rolling_averages(spark, sf_dir):
    out = ind.rolling_averages(_closed(spark, sf_dir))
    names = ["sma_20", "sma_50", "volume_ma_20"]
    return report(out.select("event_id", "row_num", "previous_close", *names), rounded=names)


@query
def rolling_extremes(spark, sf_dir):
    out = ind.rolling_extremes(_closed(spark, sf_dir))
    return report(out.select("event_id", "rolling_high_20", "rolling_low_20"))


@query
def ema(spark, sf_dir):
    out = ind.ema(_closed(spark, sf_dir)).select("event_id", "ema_20", "ema_50")
    return report(out, rounded=["ema_20", "ema_50"])


@query
def ema_after_fall(spark, sf_dir):
    """Averages of closes that fall by sixteen digits in the middle of the month, as logarithms, which
    show the relative precision."""
    plain = "cast(close_price as decimal(18,2))"
    fallen = f"cast(if(day(close_time) < 16, {plain} * 10000000000bd, {plain} * 0.000001bd) as {AMOUNT.simpleString()})"
    candles = choose(_closed(spark, sf_dir), KLINE.names, {"close_price": fallen})
    names = ["ema_20", "ema_50"]
    return ind.ema(candles).selectExpr("event_id", *[f"round(ln(nullif({n}, 0d)), 8) as ln_{n}" for n in names])


@query
def true_range_atr(spark, sf_dir):
    out = ind.true_range_atr(_closed(spark, sf_dir)).select("event_id", "true_range", "atr_14")
    return report(out, rounded=["atr_14"])


@query
def rsi(spark, sf_dir):
    names = ["avg_gain_14", "avg_loss_14", "rsi_14"]
    out = ind.relative_strength(_closed(spark, sf_dir)).select("event_id", "gain", "loss", *names)
    return report(out, rounded=names)


@query
def candle_range(spark, sf_dir):
    out = ind.candle_range(_closed(spark, sf_dir)).select("event_id", "candle_range_pct")
    return report(out, rounded=["candle_range_pct"])


# --- marts -------------------------------------------------------------------------

_MART_ROUNDED = [
    "sma_20", "sma_50", "ema_20", "ema_50", "volume_ma_20", "rsi_14", "atr_14", "candle_range_pct",
]
_SNAPSHOT_ROUNDED = snap.RETURN_COLUMNS + [
    "intraday_volatility", "distance_to_resistance_pct", "distance_to_support_pct",
    "rsi_14", "atr_14", "volume_ma_20", "sma_20", "sma_50", "ema_20", "ema_50",
]


@query
def ohlcv_indicators_(spark, sf_dir):
    return report(_ohlcv(spark, sf_dir), rounded=_MART_ROUNDED)


@query
def asof_returns(spark, sf_dir):
    """Every third candle has a second one at the same time, whose later id counts."""
    history = _history(spark, sf_dir)
    again = history.filter("pmod(unix_seconds(candle_time), 900) = 299 or interval != '5m'")
    history = history.unionByName(choose(again, history.columns, {"event_id": "concat(event_id, '-2')", "close": "close + 1"}))
    candles = _closed(spark, sf_dir).selectExpr(
        "event_id", "symbol", "interval", "close_time as as_of_time", "close_price as close"
    )
    latest = snap.newest_rows(candles, snap.SERIES, "as_of_time", 1)
    out = snap.asof_returns(latest, history).selectExpr(
        "symbol", "interval", "as_of_time", "close as last_price", *snap.RETURN_COLUMNS
    )
    return report(out, rounded=snap.RETURN_COLUMNS)


@query
def latest_ticker(spark, sf_dir):
    return report(snap.latest_ticker(_ticker(spark, sf_dir)), drop=["raw_payload"])


@query
def atr_baseline(spark, sf_dir):
    out = snap.atr_baseline(_ohlcv(spark, sf_dir))
    return report(out, rounded=["atr_14", "atr_rolling_avg_20", "intraday_volatility"])


@query
def market_snapshot(spark, sf_dir):
    return report(_snapshot(spark, sf_dir), rounded=_SNAPSHOT_ROUNDED)


# --- events: normalization, validation, upsert -------------------------------------

_INGEST = "timestamp'2024-02-01 00:00:00'"
_TICKER_AMOUNTS = [f.name for f in TICKER if f.dataType == AMOUNT]
_KLINE_AMOUNTS = [f.name for f in KLINE if f.dataType == AMOUNT]


def _payload(events: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Normalized events with fields read back from their payload."""
    opened = events.selectExpr("*", "parse_json(payload) as _p")
    return opened.selectExpr(
        "event_id", "event_type", "source", "symbol",
        "cast(cast(event_time as timestamp) as timestamp_ntz) as event_time",
        "cast(cast(ingest_time as timestamp) as timestamp_ntz) as ingest_time",
        *[f"variant_get(_p, '$.{name}', '{kind}') as {name}" for name, kind in fields.items()],
    )


@query
def normalize_ticker_(spark, sf_dir):
    events = normalize_ticker(testdata.raw_ticker_json(spark, sf_dir), "testdata", _INGEST)
    return _payload(events, {**dict.fromkeys(_TICKER_AMOUNTS, "double"), "trade_count_24h": "bigint"})


@query
def normalize_klines_(spark, sf_dir):
    events = normalize_klines(testdata.raw_klines_json(spark, sf_dir), "testdata", _INGEST)
    out = _payload(
        events,
        {
            "interval": "string", "open_time": "timestamp", "close_time": "timestamp",
            **dict.fromkeys(_KLINE_AMOUNTS, "double"),
            "trade_count": "bigint", "is_closed": "boolean",
        },
    )
    return report(out)


def _validated(spark, sf_dir, event_type):
    dirty = testdata.dirty_ticker_events if event_type == "ticker" else testdata.dirty_kline_events
    return validate(dirty(spark, sf_dir), event_type, keep=["key"])


def _checked(validated: DataFrame) -> DataFrame:
    """All rows: key and reason, and the typed columns where the row is valid."""
    names = [c for c in validated.columns if c not in ("key", "reason", "value")]
    return report(
        validated.selectExpr("key", "reason", *[f"if(reason is null, {n}, null) as {n}" for n in names])
    )


@query
def validate_ticker(spark, sf_dir):
    return _checked(_validated(spark, sf_dir, "ticker"))


@query
def validate_kline(spark, sf_dir):
    return _checked(_validated(spark, sf_dir, "kline"))


@query
def dead_letter(spark, sf_dir):
    rejected = [
        invalid_rows(_validated(spark, sf_dir, kind), keep=["key"]).selectExpr(
            f"'{kind}' as event_type", "key", "reason"
        )
        for kind in ("ticker", "kline")
    ]
    return rejected[0].unionByName(rejected[1])


@query
def normalize_rejects(spark, sf_dir):
    """What the quarantine holds, counted by reason."""
    quarantined = [
        normalize_ticker(testdata.dirty_ticker_json(spark, sf_dir), "testdata", _INGEST, on_error="quarantine"),
        normalize_klines(testdata.dirty_klines_json(spark, sf_dir), "testdata", _INGEST, on_error="quarantine"),
    ]
    counted = [
        rejects(events).groupBy("reason").agg(F.count("*").alias("n"), F.count("payload").alias("n_payloads"))
        .selectExpr(f"'{kind}' as event_type", "*")
        for kind, events in zip(("ticker", "kline"), quarantined)
    ]
    return counted[0].unionByName(counted[1])


@query
def upsert_latest(spark, sf_dir):
    return report(latest_by_key(testdata.versions(spark, sf_dir)), drop=["raw_payload"])


@query
def landed_refetch(spark, sf_dir):
    """Responses fetched twice, the later fetch first: the candles it gave last."""
    events = normalize_klines(testdata.refetched_klines_json(spark, sf_dir), "testdata")
    records = events.selectExpr("payload as value", "version", "0L as batch_id")
    rows = validate(records, "kline", keep=["version", "batch_id"])
    newest = latest_by_key(clean_rows(rows, "kline", keep=["version", "batch_id"]))
    return report(newest, drop=["raw_payload", "batch_id"])


# --- panels ------------------------------------------------------------------------


@query
def panel_snapshot(spark, sf_dir):
    names = [c for c in panels.SNAPSHOT_PANEL if c in _SNAPSHOT_ROUNDED]
    return report(panels.panel_snapshot(_snapshot(spark, sf_dir)), rounded=names)


@query
def panel_trend_vs_ema(spark, sf_dir):
    return panels.panel_trend_vs_ema(_ohlcv(spark, sf_dir))


@query
def panel_rsi_bands(spark, sf_dir):
    return report(panels.panel_rsi_bands(_ohlcv(spark, sf_dir)), rounded=["rsi_14"])


@query
def panel_ema_distance(spark, sf_dir):
    return panels.panel_ema_distance(_ohlcv(spark, sf_dir))


@query
def panel_volume_spike(spark, sf_dir):
    return panels.panel_volume_spike(_ohlcv(spark, sf_dir))


@query
def panel_returns_long(spark, sf_dir):
    out = panels.panel_returns_long(_snapshot(spark, sf_dir), intervals=None)
    return report(out, rounded=["return_pct"])


# --- quality -----------------------------------------------------------------------

_AS_OF = "timestamp'2024-01-31 00:10:00'"


def _defective(spark, sf_dir):
    raw_ticker = testdata.defective_tickers(spark, sf_dir)
    raw_kline = testdata.defective_klines(spark, sf_dir)
    return {
        "raw_ticker": raw_ticker,
        "raw_kline": raw_kline,
        "stg_ticker": stg_ticker(raw_ticker),
        "stg_klines": stg_klines(raw_kline),
    }


def _relabelled(spark, sf_dir):
    """The candle mart with some labels that are not accepted."""
    return choose(
        _ohlcv(spark, sf_dir),
        OHLCV_COLUMNS,
        {
            "interval": "if(hour(candle_time) = 4, '2m', interval)",
            "trend_regime": "case hour(candle_time) when 5 then 'sideways' when 6 then null"
            " else trend_regime end",
        },
    )


@query
def dq_not_null(spark, sf_dir):
    tables = {**_defective(spark, sf_dir), "ohlcv": _relabelled(spark, sf_dir)}
    return quality.union(
        [quality.count_failures(df, name, quality.NOT_NULL[name]) for name, df in tables.items()]
    )


@query
def dq_unique(spark, sf_dir):
    tables = _defective(spark, sf_dir)
    return quality.union([quality.count_duplicates(df, name) for name, df in tables.items()])


@query
def dq_accepted_values(spark, sf_dir):
    tables = {"ohlcv": _relabelled(spark, sf_dir), "snapshot": _snapshot(spark, sf_dir)}
    return quality.union(
        [quality.count_failures(df, name, quality.ACCEPTED[name]) for name, df in tables.items()]
    )


@query
def dq_freshness(spark, sf_dir):
    raw = {"raw_ticker": testdata.tickers(spark, sf_dir), "raw_kline": testdata.candles(spark, sf_dir)}
    return report(quality.union([quality.freshness(df, name, _AS_OF) for name, df in raw.items()]))


@query
def dq_ticker_assert(spark, sf_dir):
    bad = quality.assert_rows(testdata.defective_tickers(spark, sf_dir), quality.TICKER_ASSERTION)
    return report(bad, drop=["raw_payload"])


@query
def dq_kline_assert(spark, sf_dir):
    mart = choose(
        _ohlcv(spark, sf_dir),
        OHLCV_COLUMNS,
        {
            "high": "if(hour(candle_time) = 7, 0, high)",
            "rsi_14": "if(hour(candle_time) = 8, rsi_14 + 100, rsi_14)",
            "atr_14": "if(hour(candle_time) = 9, -1d, atr_14)",
            "volume": "if(hour(candle_time) = 10, -volume, volume)",
        },
    )
    return report(quality.assert_rows(mart, quality.CANDLE_ASSERTION), rounded=_MART_ROUNDED)


def _panel_checks(spark, sf_dir):
    mart = _ohlcv(spark, sf_dir)
    return [
        quality.nonempty(panels.panel_snapshot(_snapshot(spark, sf_dir)), "panel_snapshot"),
        quality.nonempty(panels.panel_trend_vs_ema(mart), "panel_trend_vs_ema"),
        quality.nonempty(panels.panel_rsi_bands(mart), "panel_rsi_bands"),
    ]


@query
def dq_panels_nonempty(spark, sf_dir):
    return quality.union(_panel_checks(spark, sf_dir))


@query
def dq_suite(spark, sf_dir):
    tables = {
        **_defective(spark, sf_dir),
        "ohlcv": _relabelled(spark, sf_dir),
        "snapshot": _snapshot(spark, sf_dir),
    }
    return quality.suite(tables, _AS_OF)
