"""Landed exchange responses: one file per response.

``fetched_at`` is the time the response was fetched, which the events carry as ``ingest_time``: a candle
that was open when it was fetched stays open however late it is read. It is the name of a
``fetched_at=<time>`` directory where responses are landed in such directories (``dated``), which a copy
keeps, else the modification time of the file, which a copy or a restore may change.

Ticker responses are JSON objects. Candle responses are JSON arrays below
``symbol=<symbol>/interval=<interval>/`` directories, so that one scan reads
all intervals and an interval list prunes directories. The directories of the time come last.

The ``stream_`` forms give each file once to a query with a checkpoint. A file counts as the same one by
its path: responses are landed under names of their own, and never changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators.staging import in_intervals
from candlewick.schemas import parse_intervals

_MODIFIED = "_metadata.file_modification_time"
_TICKER = ()
_KLINE = ("symbol", "interval")
# A file that is restored with its old time is still a new one.
_ANY_AGE = "36500d"


def _responses(reader, path: str, keys: Sequence[str], dated: bool) -> DataFrame:
    # A given schema: Spark would infer a directory ``interval=1d`` as the number 1.
    names = ["value", *keys, *(["fetched_at"] if dated else [])]
    found = reader.schema(", ".join(f"{name} string" for name in names)).text(path, wholetext=True)
    fetched = f"coalesce(try_cast(fetched_at as timestamp), {_MODIFIED})" if dated else _MODIFIED
    return found.selectExpr("value", *keys, f"{fetched} as fetched_at")


def _chosen(found: DataFrame, intervals: str | Sequence[str] | None) -> DataFrame:
    return in_intervals(found, parse_intervals(intervals) if isinstance(intervals, str) else intervals)


def read_ticker_responses(spark: SparkSession, path: str, dated: bool = False) -> DataFrame:
    return _responses(spark.read, path, _TICKER, dated)


def read_kline_responses(
    spark: SparkSession, path: str, intervals: str | Sequence[str] | None = None, dated: bool = False
) -> DataFrame:
    """Candle responses as (value, symbol, interval, fetched_at); ``intervals`` is a list or its text form."""
    return _chosen(_responses(spark.read, path, _KLINE, dated), intervals)


def _stream(spark: SparkSession, max_files: int | None):
    reader = spark.readStream.option("maxFileAge", _ANY_AGE)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def stream_ticker_responses(
    spark: SparkSession, path: str, dated: bool = False, max_files: int | None = None
) -> DataFrame:
    return _responses(_stream(spark, max_files), path, _TICKER, dated)


def stream_kline_responses(
    spark: SparkSession, path: str, intervals: str | Sequence[str] | None = None, dated: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    return _chosen(_responses(_stream(spark, max_files), path, _KLINE, dated), intervals)
