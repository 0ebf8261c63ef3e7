"""Dashboard panels over the two marts.

A panel takes the candle intervals to show (``None`` for all) and the zone of
its local times. With several intervals or symbols the rows mix in time order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from candlewick.functions.columns import add, choose, pct_of
from candlewick.operators.staging import in_intervals
from candlewick.schemas import DEFAULT_INTERVAL

REPORT_ZONE = "Asia/Ho_Chi_Minh"
DEFAULT_INTERVALS = (DEFAULT_INTERVAL,)
LINE_ROWS = 120
BAR_ROWS = 48

# The RSI bands, the volume baseline and the columns on display.
OVERSOLD, OVERBOUGHT, BASELINE_RATIO = 30.0, 70.0, 1.0
SNAPSHOT_PANEL = (
    "symbol", "as_of_time", "interval", "last_price",
    "price_change_pct_5m", "price_change_pct_15m", "price_change_pct_1h",
    "price_change_pct_4h", "price_change_pct_24h", "price_change_pct_1w",
    "volume_24h", "intraday_volatility",
    "trend_regime", "momentum_regime", "volatility_regime",
    "signal_strength_score", "breakout_flag", "pullback_flag",
)
TIMEFRAMES = {
    "5m": "price_change_pct_5m",
    "15m": "price_change_pct_15m",
    "1h": "price_change_pct_1h",
    "4h": "price_change_pct_4h",
    "1d": "price_change_pct_24h",
    "1w": "price_change_pct_1w",
}


def local_time(column: str, zone: str) -> str:
    return f"convert_timezone('UTC', '{zone}', cast({column} as timestamp_ntz))"


def _recent(df: DataFrame, rows: int) -> DataFrame:
    """The newest ``rows`` candles, oldest first."""
    return df.orderBy("candle_time", "event_id", ascending=False).limit(rows).orderBy(
        "candle_time", "event_id"
    )


def panel_snapshot(
    snapshot: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS, tz: str = REPORT_ZONE
) -> DataFrame:
    return choose(
        in_intervals(snapshot, intervals), SNAPSHOT_PANEL, {"as_of_time": local_time("as_of_time", tz)}
    )


def panel_trend_vs_ema(
    ohlcv: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS, tz: str = REPORT_ZONE
) -> DataFrame:
    """Close and fast EMA of the newest candles, in percent above the oldest candle on show.

    The oldest candle is found by an aggregate and enters as a scalar subquery;
    an unpartitioned window would bring all candles to one task.
    """
    shown = in_intervals(ohlcv, intervals)
    indexed = shown.sparkSession.sql(
        """
        select candle_time, event_id,
               (cast(close as double) / nullif(cast(
                    (select min_by(close, struct(candle_time, event_id)) from {shown}) as double), 0d) - 1) * 100
                 as indexed_close_pct,
               (ema_20 / nullif(
                    (select min_by(ema_20, struct(candle_time, event_id)) from {shown}), 0d) - 1) * 100
                 as indexed_ema_pct
        from {shown}
        """,
        shown=shown,
    )
    return _recent(indexed, LINE_ROWS).selectExpr(
        f"{local_time('candle_time', tz)} as candle_time",
        "round(indexed_close_pct, 4) as close_change_pct",
        "round(indexed_ema_pct, 4) as ema_change_pct",
    )


def panel_rsi_bands(
    ohlcv: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS, tz: str = REPORT_ZONE
) -> DataFrame:
    return _recent(
        in_intervals(ohlcv, intervals).select("candle_time", "event_id", "rsi_14"), LINE_ROWS
    ).selectExpr(
        f"{local_time('candle_time', tz)} as candle_time",
        "rsi_14",
        f"{OVERSOLD}d as oversold_band",
        f"{OVERBOUGHT}d as overbought_band",
    )


def panel_ema_distance(
    ohlcv: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS, tz: str = REPORT_ZONE
) -> DataFrame:
    distance = pct_of("(cast(close as double) - ema_20)", "ema_20")
    rows = in_intervals(ohlcv, intervals).selectExpr(
        "candle_time", "event_id", f"{distance} as distance_to_ema_pct", "candle_range_pct"
    )
    return _recent(rows, LINE_ROWS).selectExpr(
        f"{local_time('candle_time', tz)} as candle_time",
        "round(distance_to_ema_pct, 4) as distance_to_ema_pct",
        "round(candle_range_pct, 4) as candle_range_pct",
    )


def panel_volume_spike(
    ohlcv: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS, tz: str = REPORT_ZONE
) -> DataFrame:
    rows = in_intervals(ohlcv, intervals).selectExpr(
        "candle_time",
        "event_id",
        "cast(volume as double) / nullif(volume_ma_20, 0d) as volume_spike_ratio",
    )
    return _recent(rows, BAR_ROWS).selectExpr(
        f"{local_time('candle_time', tz)} as candle_time",
        "round(volume_spike_ratio, 4) as volume_spike_ratio",
        f"{BASELINE_RATIO}d as baseline_ratio",
    )


def panel_returns_long(
    snapshot: DataFrame, intervals: Sequence[str] | None = DEFAULT_INTERVALS
) -> DataFrame:
    """One row per snapshot row and timeframe, from a single scan."""
    wide = in_intervals(snapshot, intervals)
    pairs = ", ".join(f"'{label}', {column}" for label, column in TIMEFRAMES.items())
    return wide.selectExpr(f"stack({len(TIMEFRAMES)}, {pairs}) as (timeframe, return_pct)")
