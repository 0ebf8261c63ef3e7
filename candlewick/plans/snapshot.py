"""The snapshot mart: the newest candle of every series, put in context."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.columns import add, choose, join_per_key, pct_of
from candlewick.operators.blocks import Stage
from candlewick.schemas import SNAPSHOT_COLUMNS

SERIES = ["symbol", "interval"]

# The look-back distances of the returns, by output suffix.
LAGS = {
    "5m": "INTERVAL 5 MINUTES",
    "15m": "INTERVAL 15 MINUTES",
    "1h": "INTERVAL 1 HOUR",
    "4h": "INTERVAL 4 HOURS",
    "24h": "INTERVAL 1 DAY",
    "1w": "INTERVAL 7 DAYS",
}
RETURN_COLUMNS = [f"price_change_pct_{name}" for name in LAGS]
ATR_BASELINE_ROWS = 20

MOMENTUM_REGIME = """
    case when rsi_14 >= 60 then 'strengthening'
         when rsi_14 <= 40 then 'weakening'
         else 'neutral' end"""
VOLATILITY_REGIME = """
    case when atr_14 > coalesce(atr_rolling_avg_20, atr_14) * 1.5d then 'extreme'
         when atr_14 > coalesce(atr_rolling_avg_20, atr_14) * 1.1d then 'elevated'
         else 'normal' end"""
INTRADAY_VOLATILITY = pct_of("atr_14", "close")
BREAKOUT = "(close >= rolling_high_20)"
PULLBACK = "(cast(close as double) > ema_50 and cast(close as double) <= ema_20)"
SIGNAL_STRENGTH = f"""
    case trend_regime when 'bullish' then 40 when 'bearish' then 25 else 10 end
    + case when rsi_14 between 55 and 70 then 20 when rsi_14 between 45 and 55 then 10 else 5 end
    + if({BREAKOUT}, 20, 0) + if({PULLBACK}, 20, 0)"""

_RETURNS = {
    f"price_change_pct_{name}": pct_of(
        f"(cast(close as double) - cast(close_{name}_ago as double))", f"close_{name}_ago"
    )
    for name in LAGS
}


def newest_rows(df: DataFrame, keys: list[str], time: str, count: int) -> DataFrame:
    """The newest ``count`` rows per key, numbered from the newest in ``reverse_row_num``.

    Spark limits each map task to ``count`` rows per key ahead of the shuffle
    (WindowGroupLimit), so a key with most of the rows costs no more than others.
    """
    newest = f"over (partition by {', '.join(keys)} order by {time} desc, event_id desc)"
    return add(df, {"reverse_row_num": f"row_number() {newest}"}).filter(
        f"reverse_row_num <= {count}"
    )


def latest_ticker(ticker: DataFrame) -> DataFrame:
    return newest_rows(ticker, ["symbol"], "event_time", 1).drop("reverse_row_num")


def latest_candles(ohlcv: DataFrame) -> DataFrame:
    """Newest mart row per series with the mean of its last 20 ``atr_14``."""
    recent = newest_rows(ohlcv, SERIES, "candle_time", ATR_BASELINE_ROWS)
    whole = (
        f"over (partition by {', '.join(SERIES)} order by candle_time desc, event_id desc"
        " rows between current row and unbounded following)"
    )
    return (
        add(recent, {"atr_rolling_avg_20": f"avg(atr_14) {whole}"})
        .filter("reverse_row_num = 1")
        .drop("reverse_row_num")
    )


def newest_times(history: DataFrame) -> DataFrame:
    """``as_of_time`` per series: the time of its newest candle."""
    return history.groupBy(*SERIES).agg(F.max("candle_time").alias("as_of_time"))


def asof_closes(targets: DataFrame, history: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Per series of ``targets`` (symbol, interval, as_of_time): the close of the newest
    candle at least each lag older, as ``close_<lag>_ago``. Of candles at the same time the last by
    ``event_id`` counts, or the largest close where the history has no ids. Null where there is none; a
    series without any is left out.

    Two passes over the history (event_id, symbol, interval, candle_time, close): the times looked up,
    as aggregates of fixed width that all lags share and tasks combine without sorting; then the few rows at
    these times, of which the last is taken.
    """
    times = {
        f"_at_{name}": f"max(if(candle_time <= as_of_time - {lag}, candle_time, null))" for name, lag in LAGS.items()
    }
    found = (
        join_per_key(history.select(*SERIES, "candle_time"), targets.select(*SERIES, "as_of_time"), SERIES)
        .filter(f"candle_time <= as_of_time - {LAGS['5m']}")
        .groupBy(*SERIES)
        .agg(*[F.expr(text).alias(name) for name, text in times.items()])
    )
    if stage is not None:
        found = stage(found, "lookup_times")
    last = "event_id" if "event_id" in history.columns else "close"
    closes = {f"close_{name}_ago": f"max_by(_close, if(candle_time = _at_{name}, _last, null))" for name in LAGS}
    candidates = history.selectExpr(*SERIES, "candle_time", "close as _close", f"{last} as _last")
    return (
        join_per_key(candidates, found, SERIES)
        .filter(f"candle_time in ({', '.join(times)})")
        .groupBy(*SERIES)
        .agg(*[F.expr(text).alias(name) for name, text in closes.items()])
    )


def with_asof_closes(
    latest: DataFrame, history: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """The newest row of each series with the closes the returns compare to."""
    targets = newest_times(history)
    if stage is not None:
        targets = stage(targets, "newest_times")
    return latest.join(asof_closes(targets, history, stage), SERIES, "left")


def asof_returns(latest: DataFrame, history: DataFrame) -> DataFrame:
    """Returns over each lag for the newest rows (symbol, interval, close, ...) of ``history``."""
    return add(with_asof_closes(latest, history), _RETURNS)


def atr_baseline(ohlcv: DataFrame) -> DataFrame:
    """Newest ATR per series against its 20-row mean."""
    return latest_candles(ohlcv).selectExpr(
        *SERIES,
        "candle_time as as_of_time",
        "atr_14",
        "atr_rolling_avg_20",
        f"{INTRADAY_VOLATILITY} as intraday_volatility",
        f"{VOLATILITY_REGIME} as volatility_regime",
    )


def market_snapshot(
    ohlcv: DataFrame,
    ticker: DataFrame,
    history: DataFrame | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Build the snapshot mart.

    ``history`` (event_id, symbol, interval, candle_time, close) serves the as-of lookups;
    it defaults to ``ohlcv`` and can be the plain closed candles where the mart
    is not stored, to keep the windows out of that branch. ``stage`` stores the
    newest times, for the lookups' join to be planned on their size.
    """
    latest = add(latest_candles(ohlcv), {"as_of_time": "candle_time"})
    exchange = latest_ticker(ticker).selectExpr(
        "symbol",
        "price_change_pct_24h as price_change_pct_24h_exchange",
        "volume_24h",
        "quote_volume_24h",
    )
    history = ohlcv if history is None else history
    placed = with_asof_closes(latest, history, stage).join(exchange, "symbol")
    return choose(
        placed,
        SNAPSHOT_COLUMNS,
        {
            **_RETURNS,
            "last_price": "close",
            "intraday_volatility": INTRADAY_VOLATILITY,
            "momentum_regime": MOMENTUM_REGIME,
            "volatility_regime": VOLATILITY_REGIME,
            "breakout_flag": BREAKOUT,
            "pullback_flag": PULLBACK,
            "distance_to_resistance_pct": pct_of("(rolling_high_20 - close)", "close"),
            "distance_to_support_pct": pct_of("(close - rolling_low_20)", "close"),
            "signal_strength_score": SIGNAL_STRENGTH,
        },
    )
