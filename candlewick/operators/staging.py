"""Staging projections over the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.columns import choose
from candlewick.schemas import KLINE, TICKER


def stg_ticker(raw: DataFrame) -> DataFrame:
    return choose(raw, TICKER.names, {"symbol": "upper(symbol)"})


def stg_klines(raw: DataFrame) -> DataFrame:
    return choose(raw, KLINE.names, {"symbol": "upper(symbol)"})


def closed_candles(klines: DataFrame) -> DataFrame:
    """Candles that had ended when they were read; a live candle is left out."""
    return klines.filter("close_time <= ingest_time")


def in_intervals(df: DataFrame, intervals: Sequence[str] | None) -> DataFrame:
    """Keep the given candle intervals; ``None`` or an empty list keeps all."""
    return df.filter(F.col("interval").isin(*intervals)) if intervals else df
