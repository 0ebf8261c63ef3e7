"""Rebuild of the marts from the raw tables.

Late and out-of-order candles change every later value of a series, so both
marts are rebuilt in full. The candle mart is stored first: the snapshot reads
the stored rows, and lost executors cost no recomputation of the windows. The
small tables that rows are joined with are stored as well, so that Spark knows
their size and broadcasts those that fit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import quality
from candlewick.operators.blocks import Stage
from candlewick.operators.staging import stg_klines, stg_ticker
from candlewick.plans.ohlcv import ohlcv_indicators
from candlewick.plans.snapshot import market_snapshot
from candlewick.schemas import OHLCV, SNAPSHOT
from candlewick.session import configure
from candlewick.sources.tables import RawTable, read_ends, read_mart, remove, write_mart


@dataclass(frozen=True)
class Warehouse:
    """The directories of one deployment, below a path all executors can reach."""

    path: str

    @property
    def tickers(self) -> RawTable:
        return RawTable(f"{self.path}/raw_ticker", "ticker")

    @property
    def klines(self) -> RawTable:
        return RawTable(f"{self.path}/raw_kline", "kline")

    def ohlcv(self, spark: SparkSession) -> DataFrame:
        return read_mart(spark, f"{self.path}/ohlcv", OHLCV)

    def recent(self, spark: SparkSession, rows: int, intervals: Sequence[str] | None = None) -> DataFrame:
        """The candle mart as far as a panel of the ``rows`` newest candles needs it."""
        return read_ends(spark, f"{self.path}/ohlcv", OHLCV, rows, intervals)

    def snapshot(self, spark: SparkSession) -> DataFrame:
        return read_mart(spark, f"{self.path}/snapshot", SNAPSHOT)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """All tables by the names the quality rules use."""
        raw_ticker, raw_kline = self.tickers.read(spark), self.klines.read(spark)
        return {
            "raw_ticker": raw_ticker,
            "raw_kline": raw_kline,
            "stg_ticker": stg_ticker(raw_ticker),
            "stg_klines": stg_klines(raw_kline),
            "ohlcv": self.ohlcv(spark),
            "snapshot": self.snapshot(spark),
        }

    def check(self, spark: SparkSession, as_of: str = "current_timestamp()") -> tuple[DataFrame, int]:
        """The failed checks and the exit code of the run."""
        return quality.run_suite(self.tables(spark), as_of)


def stage_in(spark: SparkSession, path: str) -> Stage:
    """Store small derived tables below ``path``."""

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    return stage


def rebuild_marts(spark: SparkSession, warehouse: Warehouse) -> None:
    configure(spark)
    # A folder of its own: rebuilds that overlap do not read each other's tables.
    staging = f"{warehouse.path}/staging/{uuid.uuid4().hex}"
    stage = stage_in(spark, staging)
    # The marts read the candles twice; resolve their versions once.
    warehouse.klines.settle(spark)
    warehouse.tickers.settle(spark)
    klines = stg_klines(warehouse.klines.read(spark))
    write_mart(ohlcv_indicators(klines, stage=stage), f"{warehouse.path}/ohlcv", time="candle_time")
    ticker = stg_ticker(warehouse.tickers.read(spark))
    snapshot = market_snapshot(warehouse.ohlcv(spark), ticker, stage=stage)
    write_mart(snapshot, f"{warehouse.path}/snapshot")
    remove(spark, staging)
