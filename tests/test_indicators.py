"""Indicators against plain windows and sequential loops, with blocks small enough to matter."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from candlewick.operators import indicators as ind
from candlewick.operators.blocks import OrderedBlocks, cell_positions
from candlewick.operators.staging import closed_candles, stg_klines
from candlewick.plans.ohlcv import ohlcv_indicators
from candlewick.plans.rebuild import stage_in
from candlewick.schemas import OHLCV
from tests.series import candle_rows, candles, gappy_slots, random_closes, to_pandas

SMALL = dict(block_rows=128, cell_rows=16, super_cells=4)


@pytest.fixture(scope="module")
def frame(spark):
    count = 1700
    df = candles(
        spark,
        candle_rows("AAA", "5m", random_closes(count, 1), seed=1),
        candle_rows("AAA", "1h", random_closes(400, 2), gappy_slots(400, 2), seed=2),
        candle_rows("BBB", "1d", random_closes(3, 3), seed=3),
        candle_rows("CCC", "1m", [42.5] * 1500, seed=4),
    )
    return df.cache()


def per_series(frame):
    pdf = to_pandas(frame, "symbol", "interval", "close_time")
    for c in ("open_price", "high_price", "low_price", "close_price", "volume"):
        pdf[c] = pdf[c].astype(float)
    return pdf, pdf.groupby(["symbol", "interval"], sort=False)


def mean(group, size):
    return group.rolling(size, min_periods=1).mean().reset_index(level=[0, 1], drop=True)


def test_rolling_averages(spark, frame):
    pdf, groups = per_series(frame)
    out = to_pandas(ind.rolling_averages(frame, **SMALL), "symbol", "interval", "close_time")
    assert len(out) == len(pdf)
    assert (out.row_num == groups.cumcount() + 1).all()
    assert out.previous_close.isna().sum() == 4
    for name, (column, size) in ind.PRICE_AVERAGES.items():
        np.testing.assert_allclose(out[name], mean(groups[column], size), rtol=1e-12)


def test_averages_equal_a_plain_window_bit_for_bit(spark, frame):
    w = Window.partitionBy("symbol", "interval").orderBy("close_time", "event_id").rowsBetween(-49, 0)
    plain = frame.select(
        "event_id", (F.sum("close_price").over(w).cast("double") / F.count("*").over(w)).alias("sma_50")
    )
    blocked = ind.rolling_averages(frame, **SMALL).select("event_id", "sma_50")
    assert plain.exceptAll(blocked).isEmpty() and blocked.exceptAll(plain).isEmpty()


def test_rolling_extremes(spark, frame):
    pdf, groups = per_series(frame)
    out = to_pandas(ind.rolling_extremes(frame, **SMALL), "symbol", "interval", "close_time")
    highs = groups.high_price.rolling(20, min_periods=1).max().reset_index(level=[0, 1], drop=True)
    lows = groups.low_price.rolling(20, min_periods=1).min().reset_index(level=[0, 1], drop=True)
    assert (out.rolling_high_20.astype(float) == highs).all()
    assert (out.rolling_low_20.astype(float) == lows).all()


def movements(pdf, groups):
    before = groups.close_price.shift().fillna(pdf.close_price)
    up = (pdf.close_price - before).clip(lower=0)
    down = (before - pdf.close_price).clip(lower=0)
    tr = np.maximum.reduce(
        [pdf.high_price - pdf.low_price, (pdf.high_price - before).abs(), (pdf.low_price - before).abs()]
    )
    keys = [pdf.symbol, pdf.interval]
    again = lambda s: mean(pd.Series(s).groupby(keys, sort=False), 14)
    return again(tr), again(up), again(down)


def test_atr_and_rsi(spark, frame):
    pdf, groups = per_series(frame)
    atr, up, down = movements(pdf, groups)
    out = to_pandas(ind.true_range_atr(frame, **SMALL), "symbol", "interval", "close_time")
    np.testing.assert_allclose(out.atr_14, atr, rtol=1e-9, atol=1e-9)
    out = to_pandas(ind.relative_strength(frame, **SMALL), "symbol", "interval", "close_time")
    np.testing.assert_allclose(out.avg_gain_14, up, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(out.avg_loss_14, down, rtol=1e-9, atol=1e-9)
    expected = np.where(
        out.avg_loss_14 == 0, np.where(out.avg_gain_14 > 0, 100.0, 50.0),
        100 - 100 / (1 + out.avg_gain_14 / out.avg_loss_14.replace(0, np.nan)),
    )
    np.testing.assert_allclose(out.rsi_14, expected, rtol=1e-12)
    assert out.rsi_14.between(0, 100).all()
    assert (out.groupby(["symbol", "interval"]).rsi_14.first() == 50).all()
    assert (out[out.symbol == "CCC"].rsi_14 == 50).all()


@pytest.mark.parametrize("layout", [SMALL, {}, dict(block_rows=1000)])
def test_ema_equals_the_recursion(spark, frame, layout):
    pdf, groups = per_series(frame)
    out = to_pandas(ind.ema(frame, (20, 50), **layout), "symbol", "interval", "close_time")
    for span in (20, 50):
        loop = groups.close_price.transform(lambda s: s.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(out[f"ema_{span}"], loop, rtol=0, atol=2e-11)
    flat = out[out.symbol == "CCC"]
    assert (flat.ema_20 == 42.5).all() and (flat.ema_50 == 42.5).all()


def amounts(spark, closes, volume=None):
    """Candles of one series with exactly these closes (texts), and volumes."""
    rows = candle_rows("AAA", "5m", [1.0] * len(closes))
    exact = [Decimal(c) for c in closes]
    return candles(spark, [(*r[:9], e, r[10] if volume is None else volume, *r[11:]) for r, e in zip(rows, exact)])


def loop_ema(values, span):
    e, out = values[0], []
    for x in values:
        e = x * (2 / (span + 1)) + e * (1 - 2 / (span + 1))
        out.append(e)
    return np.array(out)


@pytest.mark.parametrize("layout", [SMALL, {}, dict(block_rows=1000)])
@pytest.mark.parametrize("low", ["0.000001", "0.000000000000000001"])
def test_ema_after_a_fall_keeps_its_digits(spark, layout, low):
    rng = np.random.default_rng(4)
    high = [f"{x:.2f}" for x in 1e12 + rng.normal(0, 1e9, 700)]
    closes = [*high, *[low] * 1300, *high[:300], *[low] * 400, *[f"{x:.6f}" for x in rng.uniform(1e-6, 3, 300)]]
    out = to_pandas(ind.ema(amounts(spark, closes), (20, 50), **layout), "close_time")
    values = [float(Decimal(c)) for c in closes]
    for span in (20, 50):
        np.testing.assert_allclose(out[f"ema_{span}"], loop_ema(values, span), rtol=1e-12)


@pytest.mark.parametrize("span", [2, 3, 9, 200, 3000])
def test_ema_of_other_spans_after_a_fall(spark, span):
    closes = [*["1000000000000"] * 60, *["0.000001"] * 900, "7", *["0.25", "0.5"] * 100]
    out = to_pandas(ind.ema(amounts(spark, closes), (span,), block_rows=200, cell_rows=16), "close_time")
    np.testing.assert_allclose(out[f"ema_{span}"], loop_ema([float(c) for c in closes], span), rtol=1e-12)


def test_large_volumes_equal_a_plain_window_bit_for_bit(spark):
    frame = amounts(spark, [f"{1 + i % 7}.{i:06d}" for i in range(20_000)], Decimal("1000000000000000.123456789012345678"))
    w = Window.partitionBy("symbol", "interval").orderBy("close_time", "event_id").rowsBetween(-19, 0)
    plain = frame.select("event_id", (F.sum("volume").over(w).cast("double") / F.count("*").over(w)).alias("volume_ma_20"))
    blocked = ind.rolling_averages(frame).select("event_id", "volume_ma_20")
    assert plain.exceptAll(blocked).isEmpty() and blocked.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("span", [2, 3, 9, 200])
def test_ema_of_other_spans(spark, frame, span):
    pdf, groups = per_series(frame)
    out = to_pandas(ind.ema(frame, (span,), **SMALL), "symbol", "interval", "close_time")
    loop = groups.close_price.transform(lambda s: s.ewm(span=span, adjust=False).mean())
    np.testing.assert_allclose(out[f"ema_{span}"], loop, rtol=0, atol=5e-11)


def test_ema_rejects_spans_it_cannot_join(spark, frame):
    with pytest.raises(ValueError, match="separate calls"):
        ind.ema(frame, (2, 200))
    with pytest.raises(ValueError, match="at least 2"):
        ind.ema(frame, (1,))


def test_candle_range(spark):
    df = spark.sql(
        "select cast(o as decimal(37,18)) open_price, cast(12 as decimal(37,18)) high_price, "
        "cast(9 as decimal(37,18)) low_price from values (10), (0) as t(o)"
    )
    assert [r.candle_range_pct for r in ind.candle_range(df).collect()] == [30.0, None]


def test_mart_does_not_depend_on_layout_or_input_order(spark, frame):
    whole = ohlcv_indicators(stg_klines(frame))
    assert [(f.name, f.dataType) for f in whole.schema] == [(f.name, f.dataType) for f in OHLCV]
    parts = ohlcv_indicators(stg_klines(frame.orderBy(F.rand(3))), **SMALL)
    a, b = to_pandas(whole, "event_id"), to_pandas(parts, "event_id")
    for name in OHLCV.names:
        if name in ("ema_20", "ema_50"):
            np.testing.assert_allclose(a[name], b[name], rtol=0, atol=2e-11)
        else:
            assert a[name].equals(b[name]), name
    assert ((a.low <= a.close) & (a.close <= a.high)).all()
    flat = a[a.symbol == "CCC"]
    assert (flat.trend_regime == "ranging").all()


def test_trend_regime(spark):
    rows = spark.sql(
        f"select {ind.TREND_REGIME} as r from values "
        "(2d, 1d, 1), (1d, 2d, -1), (2d, 1d, -1), (2d, 1d, 0), (1d, 1d, 1) "
        "as t(ema_20, ema_50, _close_side)"
    ).collect()
    assert [r.r for r in rows] == ["bullish", "bearish", "ranging", "ranging", "ranging"]


def test_rsi_of_a_plain_ratio_is_plain(spark):
    """Gains of 3 and losses of 2 make exactly 60."""
    closes = [10.0, 10.1, 10.3, 10.2, 10.1]
    out = to_pandas(ind.relative_strength(candles(spark, candle_rows("AAA", "5m", closes))), "close_time")
    assert out.rsi_14.iloc[-1] == 60


@pytest.mark.parametrize("level", [0.07, 42.5, 1234.56, 99.99])
def test_close_on_its_mean_is_no_trend(spark, level):
    """A rise, then more equal closes than the mean covers: neither above nor below, exactly."""
    rise = [round(level * n / 40, 2) for n in range(1, 40)]
    out = to_pandas(ohlcv_indicators(candles(spark, candle_rows("AAA", "5m", rise + [level] * 45))), "candle_time")
    late = out.tail(25)
    assert (late.ema_20 > late.ema_50).all()
    assert (late.trend_regime == "ranging").all()
    assert (out.trend_regime[25:45] == "bullish").all()


def test_live_candles_and_symbol_case(spark):
    rows = candle_rows("abc", "5m", [1.0, 2.0, 3.0]) + candle_rows("ABC", "5m", [4.0], at=[3])
    live = rows[-1][:-2] + (rows[-1][4], "{}")
    out = ohlcv_indicators(stg_klines(candles(spark, [*rows[:-1], live])))
    got = to_pandas(out, "candle_time")
    assert list(got.symbol) == ["ABC"] * 3
    assert list(got.sma_20) == [1.0, 1.5, 2.0]
    assert closed_candles(stg_klines(candles(spark, [live]))).isEmpty()


def test_cell_positions_count_all_rows_before_a_cell(spark):
    cells = spark.sql("select 'k' as k, cast(floor(id * id / 40) as bigint) as _cell from range(300)")
    got = cell_positions(cells, ["k"], 7).orderBy("_cell").toPandas()
    assert (got._ahead == got._n.cumsum() - got._n).all()
    assert got._n.sum() == 300


def test_blocks_own_each_row_once_and_carry_the_halo(spark, frame):
    halo = 50
    blocks = OrderedBlocks.cut(
        frame, ind.SERIES, "close_time", "event_id", ind.INTERVAL_SECONDS_SQL, halo, **SMALL
    )
    rows = blocks.add({"n": f"row_number() {blocks.over()}", "row_num": blocks.row_num()}).rows
    pdf = rows.select("symbol", "interval", "event_id", "_block", "_owned", "n", "row_num").toPandas()
    owned = pdf[pdf._owned]
    assert len(owned) == frame.count() and owned.event_id.is_unique
    # Of the rows ahead in the series, a block holds the last 50 or all.
    assert (owned.n - 1 >= np.minimum(owned.row_num - 1, halo)).all()
    assert pdf.groupby(["symbol", "interval", "_block"]).size().max() <= 128 + halo + 2 * 16


def crowded(spark, equal, others):
    """Many candles at one time, between others; ids tell their order."""
    rows = candle_rows("AAA", "5m", random_closes(equal + others, 8), [0] * equal + list(range(1, others + 1)))
    return candles(spark, [(f"{i:07d}", *r[1:]) for i, r in enumerate(rows)], candle_rows("BBB", "5m", random_closes(300, 9)))


@pytest.mark.parametrize("staged", [False, True])
@pytest.mark.parametrize("layout", [SMALL, dict(block_rows=300, cell_rows=7, super_cells=3)])
def test_many_candles_at_one_time(spark, tmp_path, staged, layout):
    frame = crowded(spark, 3000, 500)
    stage = {"stage": stage_in(spark, str(tmp_path))} if staged else {}
    w = Window.partitionBy("symbol", "interval").orderBy("close_time", "event_id")
    plain = frame.select(
        "event_id", F.row_number().over(w).cast("long").alias("row_num"), F.lag("close_price").over(w).alias("previous_close"),
        (F.sum("close_price").over(w.rowsBetween(-49, 0)).cast("double") / F.count("*").over(w.rowsBetween(-49, 0))).alias("sma_50"),
    )
    blocked = ind.rolling_averages(frame, **layout, **stage).select(*plain.columns)
    assert plain.exceptAll(blocked).isEmpty() and blocked.exceptAll(plain).isEmpty()
    blocks = OrderedBlocks.cut(frame, ind.SERIES, "close_time", "event_id", ind.INTERVAL_SECONDS_SQL, 50, **layout, **stage)
    sizes = [r["count"] for r in blocks.rows.groupBy("symbol", "interval", "_block").count().collect()]
    if staged:
        assert max(sizes) < 3 * layout["block_rows"]
        assert blocks.rows.filter("_owned").groupBy("symbol", "interval", "_block").count().count() > 3000 // layout["block_rows"]
    else:
        assert sum(sizes) < 3 * frame.count()


@pytest.mark.parametrize("staged", [False, True])
def test_copies_of_400_000_candles_at_one_time(spark, tmp_path, staged):
    frame = spark.range(400_100).selectExpr(
        "'AAA' as symbol", "'5m' as interval", "timestamp_seconds(if(id < 400000, 0, id) * 300) as close_time",
        "lpad(id, 8, '0') as event_id", "id as close_price",
    )
    stage = {"stage": stage_in(spark, str(tmp_path))} if staged else {}
    blocks = OrderedBlocks.cut(frame, ind.SERIES, "close_time", "event_id", "300", 51, ["close_price"], **stage)
    assert blocks.rows.count() <= 2 * 400_100
    if staged:
        assert blocks.rows.groupBy("_block").count().agg(F.max("count")).first()[0] < 30_000
        placed = blocks.add({"n": blocks.row_num()}).rows.filter("_owned")
        assert placed.filter("n != close_price + 1").isEmpty() and placed.count() == 400_100
