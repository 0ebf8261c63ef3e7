"""Random candle series for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from candlewick.schemas import INTERVAL_SECONDS, KLINE

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def candle_rows(symbol: str, interval: str, closes, at=None, seed: int = 0) -> list[tuple]:
    """Kline rows with the given closes; ``at`` are the numbers of their time slots."""
    rng = np.random.default_rng(seed)
    step = timedelta(seconds=INTERVAL_SECONDS[interval])
    rows, last = [], closes[0]
    for n, close in enumerate(closes):
        opened = START + step * int(n if at is None else at[n])
        spread = float(rng.integers(0, 300)) / 100
        high, low = max(last, close) + spread, min(last, close) - spread
        volume = float(rng.integers(1, 10000)) / 100
        cents = [Decimal(f"{value:.2f}") for value in (last, high, low, close, volume, volume * close)]
        rows.append(
            (
                f"kline-{symbol}-{interval}-{int(opened.timestamp() * 1000)}", "test", symbol, interval,
                opened, opened + step - timedelta(milliseconds=1), *cents, int(rng.integers(1, 50)), True,
                opened + step + timedelta(seconds=5), "{}",
            )
        )
        last = close
    return rows


def random_closes(count: int, seed: int = 0):
    rng = np.random.default_rng(seed)
    return np.round(500 + np.cumsum(rng.normal(0, 2, count)), 2).clip(10).tolist()


def gappy_slots(count: int, seed: int = 0):
    """Slot numbers with runs of missing candles, short and very long."""
    rng = np.random.default_rng(seed)
    steps = rng.choice([1, 1, 1, 1, 2, 40, 5000], count, p=[0.2, 0.2, 0.2, 0.2, 0.1, 0.08, 0.02])
    return np.cumsum(steps)


def candles(spark: SparkSession, *series: list[tuple], shuffle: int | None = 1) -> DataFrame:
    rows = [row for part in series for row in part]
    if shuffle is not None:
        np.random.default_rng(shuffle).shuffle(order := np.arange(len(rows)))
        rows = [rows[i] for i in order]
    return spark.createDataFrame(rows, KLINE)


def to_pandas(df: DataFrame, *order: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)
