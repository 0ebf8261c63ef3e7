"""The candle mart: one row per closed candle with its indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlewick.functions.columns import choose
from candlewick.operators import indicators as ind
from candlewick.operators.staging import closed_candles
from candlewick.schemas import OHLCV_COLUMNS

EMA_SPANS = {"ema_20": 20, "ema_50": 50}

_EXPRESSIONS = {
    "candle_time": "close_time",
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
    "candle_range_pct": ind.CANDLE_RANGE_PCT,
}


def ohlcv_indicators(klines: DataFrame, **layout) -> DataFrame:
    """Build the mart from staged candles in one pass of windows over ordered blocks.

    ``layout`` is passed to ``OrderedBlocks.cut``: block sizes, and ``stage``.
    """
    candles = closed_candles(klines).drop("open_time", "raw_payload")
    blocks = ind.candle_blocks(
        candles,
        ind.ema_halo(list(EMA_SPANS.values())),
        ["close_price", "high_price", "low_price", "volume"],
        **layout,
    )
    blocks = blocks.add({"_value": "cast(close_price as double)"})
    blocks = blocks.add(
        {
            **ind.position_columns(blocks),
            **ind.extreme_columns(blocks),
        }
    )
    # Segments as long as the longest frame serve the averages of both kinds.
    rows, segments = ind.ema_segment(list(EMA_SPANS.values()))
    blocks = blocks.segmented(rows, segments)
    blocks = blocks.add(ind.movement_columns()).drop(["previous_close"])
    blocks = blocks.pack(["high_price", "low_price", "rolling_high_20", "rolling_low_20"])
    averages = {**ind.PRICE_AVERAGES, **ind.MOVEMENT_AVERAGES}
    blocks = ind.with_averages(blocks, averages, rows, sides={"_close_side": "sma_20"})
    blocks = blocks.add({"rsi_14": ind.RSI_14})
    blocks = ind.with_ema(blocks, EMA_SPANS).add({"trend_regime": ind.TREND_REGIME})
    return choose(blocks.owned(), OHLCV_COLUMNS, _EXPRESSIONS)
