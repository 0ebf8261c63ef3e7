"""Physical plans: what is read, what is shuffled, and that no task gets a whole series."""

import re

import pytest

import __spark_entry__ as contract
from candlewick.operators import indicators as ind
from candlewick.operators.staging import stg_klines
from candlewick.operators.upsert import latest_by_key
from candlewick.operators.validate import invalid_rows, validate
from candlewick.plans import panels
from candlewick.plans.ohlcv import ohlcv_indicators
from candlewick.plans.rebuild import stage_in
from candlewick.plans.snapshot import asof_closes, latest_candles, latest_ticker, newest_times
from candlewick.schemas import KLINE, OHLCV, TICKER
from candlewick.sources.tables import read_mart, write_mart
from tests.series import candle_rows, candles, random_closes

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans"))
    frame = candles(spark, candle_rows("AAA", "5m", random_closes(300)), candle_rows("AAA", "1h", random_closes(50)))
    frame.write.parquet(f"{path}/kline")
    klines = spark.read.schema(KLINE).parquet(f"{path}/kline")
    write_mart(ohlcv_indicators(stg_klines(klines)), f"{path}/ohlcv")
    spark.createDataFrame([], TICKER).write.parquet(f"{path}/ticker")
    return {
        "kline": klines,
        "ohlcv": read_mart(spark, f"{path}/ohlcv", OHLCV),
        "ticker": spark.read.schema(TICKER).parquet(f"{path}/ticker"),
    }


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_query_uses_a_product_or_a_row_at_a_time_function(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in text
    # Every read is of the event table, and only of the columns in use.
    scans = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert scans and all("props" not in scan and "user_id" not in scan for scan in scans)


def test_indicator_windows_run_per_block(stored):
    text = plan(ohlcv_indicators(stg_klines(stored["kline"])))
    keys = set(re.findall(r"hashpartitioning\(([^)]*), \d+\)", text))
    series = [k for k in keys if re.fullmatch(r"symbol#\d+, interval#\d+", k)]
    # Only the totals of 4096 cells each are ordered per whole series.
    assert len(series) == 1
    assert any("_block" in k for k in keys)
    blocks = text.count("_block#") and re.findall(r"hashpartitioning\([^)]*_block[^)]*\)", text)
    assert len(set(blocks)) == 1


def test_candle_windows_share_one_shuffle_of_the_rows(stored):
    text = tree(ind.rolling_averages(stg_klines(stored["kline"])))
    below = text.split("Window")[0]
    assert "Exchange" not in below


def test_stored_positions_spare_a_shuffle_of_the_rows(spark, stored, tmp_path):
    klines = stg_klines(stored["kline"])
    text = plan(ohlcv_indicators(klines, stage=stage_in(spark, str(tmp_path))))
    assert "SortMergeJoin" not in text
    # Nothing but the one shuffle into blocks.
    assert re.findall(r"hashpartitioning\(([a-z_]+)#\d+, ([a-z_]+)#\d+, ([a-z_]+)#", text) == [
        ("symbol", "interval", "_block")
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(ohlcv_indicators(klines, stage=stage_in(spark, str(tmp_path))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" not in large


def test_counting_scan_is_narrow(stored):
    text = plan(ohlcv_indicators(stg_klines(stored["kline"])))
    scans = re.findall(r"ReadSchema: struct<(.*)>", text)
    narrow = [s for s in scans if len(s.split(",")) == 4]
    assert narrow and all("price" not in s for s in narrow)


def test_closed_candle_filter_is_ahead_of_the_windows(stored):
    text = tree(ohlcv_indicators(stg_klines(stored["kline"])))
    assert text.rindex("Filter") > text.rindex("Window")


def test_interval_filter_prunes_directories(stored):
    text = plan(panels.panel_rsi_bands(stored["ohlcv"]))
    assert re.search(r"PartitionFilters: \[.*interval.* = 5m", text)
    assert "TakeOrderedAndProject" in text
    scan = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {c.split(":")[0] for c in scan.split(",")} == {"event_id", "candle_time", "rsi_14"}


def test_newest_rows_are_limited_before_the_shuffle(stored):
    for df in (
        latest_candles(stored["ohlcv"]),
        latest_ticker(stored["ticker"]),
        latest_by_key(stored["kline"].selectExpr("*", "1 as batch_id", "1 as log_position")),
    ):
        text = tree(df)
        assert text.count("WindowGroupLimit") == 2
        partial = text[text.rindex("Exchange"):]
        assert "WindowGroupLimit" in partial


def test_asof_lookup_combines_before_the_shuffle(stored):
    """The newest times, the times looked up, the rows at these times: one narrow scan each. Only the last,
    a handful of rows a series, are sorted, as their ids decide among equal times."""
    history = stored["ohlcv"]
    text = plan(asof_closes(newest_times(history), history))
    scans = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert sorted(s.count(":") for s in scans) == [2, 2, 4]
    assert "partial_max(" in text and "partial_max_by" in text
    times = plan(asof_closes(newest_times(history), history.drop("event_id")))
    assert "SortAggregate" not in times
    assert text.split("\n\n")[0].count("SortAggregate") == 2


def test_hot_series_is_split_where_the_newest_times_are_not_broadcast(spark):
    history = spark.sql(
        "select if(id % 3 = 0, 'HOT', concat('S', id % 500)) symbol, '5m' `interval`, "
        "timestamp_seconds(id * 300) candle_time, cast(id as decimal(37,18)) close from range(0, 120000, 1, 8)"
    )
    expected = sorted(asof_closes(newest_times(history), history).collect())
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = asof_closes(newest_times(history), history)
        assert sorted(df.collect()) == expected
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_verdict_filter_stays_above_the_parsing(stored, spark):
    text = plan(invalid_rows(validate(spark.sql("select cast(id as string) as value from range(3)"), "kline")))
    assert text.lower().count("parsejson") <= 2
