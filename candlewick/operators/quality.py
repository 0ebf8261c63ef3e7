"""Data-quality checks.

A rule names a table's column and a predicate that holds for failing rows. All
rules of a table are counted in one aggregation; uniqueness needs a grouping
of its own. A suite is the union of the checks of all tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from candlewick.schemas import INTERVALS, MOMENTUM_REGIMES, TREND_REGIMES, VOLATILITY_REGIMES

RESULT_COLUMNS = ("table_name", "check_name", "column_name", "failing_rows", "status")


@dataclass(frozen=True)
class Rule:
    check: str
    column: str
    fails: str


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", column, f"{column} is null") for column in columns]


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    """Null passes; that is for ``not_null`` to report."""
    listed = ", ".join(f"'{value}'" for value in values)
    return Rule("accepted_values", column, f"{column} not in ({listed})")


# Rows no stored ticker or finished candle may show.
TICKER_ASSERTION = """
    trim(symbol) = '' or last_price <= 0 or volume_24h < 0 or quote_volume_24h < 0
    or trade_count_24h < 0 or high_price_24h < low_price_24h"""
CANDLE_ASSERTION = """
    open <= 0 or high <= 0 or low <= 0 or close <= 0 or high < low
    or volume < 0 or quote_asset_volume < 0
    or rsi_14 < 0 or rsi_14 > 100 or atr_14 < 0"""

# The rules of each table of the model.
NOT_NULL = {
    "raw_ticker": not_null("event_id", "symbol", "event_time", "last_price"),
    "raw_kline": not_null("event_id", "symbol", "interval", "open_time", "close_price"),
    "stg_ticker": not_null("event_id", "symbol", "last_price", "ingest_time"),
    "stg_klines": not_null("event_id", "symbol", "interval", "open_time", "close_price"),
    "ohlcv": not_null("event_id", "symbol", "interval", "candle_time", "close", "trend_regime"),
    "snapshot": not_null(
        "symbol", "interval", "as_of_time", "last_price",
        "trend_regime", "momentum_regime", "volatility_regime",
    ),
}
ACCEPTED = {
    "ohlcv": [accepted_values("interval", INTERVALS), accepted_values("trend_regime", TREND_REGIMES)],
    "snapshot": [
        accepted_values("trend_regime", TREND_REGIMES),
        accepted_values("momentum_regime", MOMENTUM_REGIMES),
        accepted_values("volatility_regime", VOLATILITY_REGIMES),
    ],
}
ASSERTIONS = {
    "raw_ticker": [Rule("assertion", "ticker_values", TICKER_ASSERTION)],
    "ohlcv": [Rule("assertion", "candle_values", CANDLE_ASSERTION)],
}
UNIQUE = ("raw_ticker", "raw_kline", "stg_ticker", "stg_klines", "ohlcv")
FRESHNESS = ("raw_ticker", "raw_kline")
WARN_AFTER_SECONDS = 30 * 60
ERROR_AFTER_SECONDS = 24 * 60 * 60


def count_failures(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Failing rows of each rule, from one pass over ``df``."""
    counted = df.agg(
        *[F.expr(f"count_if({rule.fails})").alias(f"_{i}") for i, rule in enumerate(rules)]
    )
    entries = ", ".join(
        f"struct('{rule.check}' as check_name, '{rule.column}' as column_name, _{i} as failing_rows)"
        for i, rule in enumerate(rules)
    )
    return _with_status(
        counted.selectExpr(f"'{table}' as table_name", f"inline(array({entries}))")
    )


def duplicates(df: DataFrame, column: str = "event_id") -> DataFrame:
    """Values of ``column`` that occur more than once; nulls do not count."""
    return df.filter(f"{column} is not null").groupBy(column).count().filter("count > 1")


def count_duplicates(df: DataFrame, table: str, column: str = "event_id") -> DataFrame:
    counted = duplicates(df, column).agg(F.count("*").alias("failing_rows"))
    return _with_status(
        counted.selectExpr(
            f"'{table}' as table_name", "'unique' as check_name", f"'{column}' as column_name", "failing_rows"
        )
    )


def freshness(df: DataFrame, table: str, as_of: str = "current_timestamp()") -> DataFrame:
    """Age of the newest ``ingest_time`` at the timestamp expression ``as_of``."""
    newest = df.agg(F.max("ingest_time").alias("newest"))
    aged = newest.selectExpr("newest", f"unix_seconds({as_of}) - unix_seconds(newest) as age_seconds")
    return aged.selectExpr(
        f"'{table}' as table_name",
        "newest",
        "age_seconds",
        f"""case when coalesce(age_seconds, {ERROR_AFTER_SECONDS + 1}) > {ERROR_AFTER_SECONDS} then 'error'
            when age_seconds > {WARN_AFTER_SECONDS} then 'warn' else 'pass' end as status""",
    )


def freshness_check(df: DataFrame, table: str, as_of: str = "current_timestamp()") -> DataFrame:
    """``freshness`` in the layout of the other checks."""
    return freshness(df, table, as_of).selectExpr(
        "table_name",
        "'freshness' as check_name",
        "'ingest_time' as column_name",
        "cast(if(status = 'pass', 0, 1) as bigint) as failing_rows",
        "status",
    )


def assert_rows(df: DataFrame, fails: str) -> DataFrame:
    """The rows that break an assertion."""
    return df.filter(fails)


def nonempty(panel: DataFrame, name: str) -> DataFrame:
    """Whether a panel returns any row."""
    found = panel.limit(1).agg(F.count("*").alias("found"))
    return found.selectExpr(
        f"'{name}' as table_name",
        "'nonempty' as check_name",
        "'*' as column_name",
        "cast(if(found = 0, 1, 0) as bigint) as failing_rows",
        "if(found = 0, 'error', 'pass') as status",
    )


def _with_status(counted: DataFrame) -> DataFrame:
    return counted.selectExpr(
        "table_name", "check_name", "column_name", "failing_rows",
        "if(failing_rows > 0, 'error', 'pass') as status",
    )


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def suite(tables: dict[str, DataFrame], as_of: str = "current_timestamp()") -> DataFrame:
    """Every check of every given table: one row each, in ``RESULT_COLUMNS``."""
    frames = []
    for name, df in tables.items():
        rules = NOT_NULL.get(name, []) + ACCEPTED.get(name, []) + ASSERTIONS.get(name, [])
        if rules:
            frames.append(count_failures(df, name, rules))
        if name in UNIQUE:
            frames.append(count_duplicates(df, name))
        if name in FRESHNESS:
            frames.append(freshness_check(df, name, as_of))
    return union(frames)


def failures(results: DataFrame) -> DataFrame:
    return results.filter("status = 'error'")


def run_suite(tables: dict[str, DataFrame], as_of: str = "current_timestamp()") -> tuple[DataFrame, int]:
    """The failed checks (one small row each) and the exit code of the run.

    Every check runs once; its row is held, so that looking at the rows does not run it again.
    """
    results = suite(tables, as_of)
    rows = failures(results).collect()
    return results.sparkSession.createDataFrame(rows, results.schema), int(bool(rows))
