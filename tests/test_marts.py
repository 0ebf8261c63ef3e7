"""Snapshot, panels and quality checks on small tables with known answers."""

from datetime import timedelta

import pytest

from candlewick.operators import quality
from candlewick.operators.staging import stg_klines
from candlewick.plans import panels, snapshot as snap
from candlewick.plans.ohlcv import ohlcv_indicators
from candlewick.schemas import SNAPSHOT, TICKER
from tests.series import START, candle_rows, candles, random_closes, to_pandas


def ticker_frame(spark, *rows):
    """Rows of (symbol, minutes, last price, change in percent)."""
    out = []
    for n, (symbol, minutes, price, change) in enumerate(rows):
        at = START + timedelta(minutes=minutes)
        out.append((f"t{n}", "test", symbol, at, at) + (price,) + (0, change) + (5,) * 5 + (1, "{}"))
    names = ", ".join(TICKER.names)
    frame = spark.createDataFrame(out, TICKER.names)
    return frame.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) {f.name}" for f in TICKER])


@pytest.fixture(scope="module")
def mart(spark):
    df = candles(
        spark,
        candle_rows("AAA", "5m", random_closes(900, 5), seed=5),
        candle_rows("AAA", "1d", random_closes(3, 6), seed=6),
        candle_rows("BBB", "5m", random_closes(40, 7), at=[3 * i for i in range(40)], seed=7),
        candle_rows("CCC", "5m", [7.0] * 30, seed=8),
    )
    return ohlcv_indicators(stg_klines(df)).cache()


@pytest.fixture(scope="module")
def snapshot(spark, mart):
    ticker = ticker_frame(spark, ("AAA", 1, 1, 1), ("AAA", 3, 1, 3), ("AAA", 2, 1, 2), ("BBB", 1, 1, 9))
    return snap.market_snapshot(mart, ticker).cache()


def test_snapshot_layout(snapshot):
    assert [(f.name, f.dataType) for f in snapshot.schema] == [(f.name, f.dataType) for f in SNAPSHOT]
    # CCC has no ticker.
    assert sorted((r.symbol, r.interval) for r in snapshot.collect()) == [
        ("AAA", "1d"), ("AAA", "5m"), ("BBB", "5m")
    ]


def test_newest_ticker_by_event_time(snapshot):
    got = {r.symbol: int(r.price_change_pct_24h_exchange) for r in snapshot.collect()}
    assert got == {"AAA": 3, "BBB": 9}


def test_returns_use_the_newest_candle_old_enough(mart, snapshot):
    pdf = to_pandas(mart, "candle_time")
    lags = {"5m": 5, "15m": 15, "1h": 60, "4h": 240, "24h": 1440, "1w": 10080}
    for row in snapshot.collect():
        mine = pdf[(pdf.symbol == row.symbol) & (pdf.interval == row.interval)]
        now = mine.iloc[-1]
        assert row.last_price == now.close
        for name, minutes in lags.items():
            old = mine[mine.candle_time <= now.candle_time - timedelta(minutes=minutes)]
            got = row[f"price_change_pct_{name}"]
            if old.empty:
                assert got is None
            else:
                base = float(old.iloc[-1].close)
                assert got == pytest.approx((float(now.close) - base) / base * 100, rel=1e-12)


def test_snapshot_metrics(mart, snapshot):
    pdf = to_pandas(mart, "candle_time")
    for row in snapshot.collect():
        mine = pdf[(pdf.symbol == row.symbol) & (pdf.interval == row.interval)]
        now, close = mine.iloc[-1], float(mine.iloc[-1].close)
        usual = mine.atr_14.tail(20).mean()
        assert row.intraday_volatility == pytest.approx(now.atr_14 / close * 100)
        level = "extreme" if now.atr_14 > usual * 1.5 else "elevated" if now.atr_14 > usual * 1.1 else "normal"
        assert row.volatility_regime == level
        assert row.breakout_flag == (now.close >= now.rolling_high_20)
        assert row.pullback_flag == (now.ema_50 < close <= now.ema_20)
        assert row.distance_to_resistance_pct == pytest.approx((float(now.rolling_high_20) - close) / close * 100)
        assert row.distance_to_support_pct == pytest.approx((close - float(now.rolling_low_20)) / close * 100)
        assert 15 <= row.signal_strength_score <= 100


@pytest.mark.parametrize(
    "trend, rsi, close, high, fast, slow, score",
    [
        ("bullish", 60.0, 10, 10, 9.0, 8.0, 80),
        ("bullish", 55.0, 9, 10, 9.5, 8.0, 80),
        ("bearish", 50.0, 9, 10, 8.0, 9.5, 35),
        ("ranging", 80.0, 9, 10, 8.0, 9.5, 15),
        ("ranging", 45.0, 9, 10, 9.0, 8.5, 40),
    ],
)
def test_signal_strength(spark, trend, rsi, close, high, fast, slow, score):
    row = spark.sql(
        f"select {snap.SIGNAL_STRENGTH} as s, {snap.MOMENTUM_REGIME} as m from (select '{trend}' trend_regime,"
        f" {rsi}d rsi_14, {close} close, {high} rolling_high_20, {fast}d ema_20, {slow}d ema_50)"
    ).first()
    assert row.s == score
    assert row.m == ("strengthening" if rsi >= 60 else "weakening" if rsi <= 40 else "neutral")


def test_zero_prices_give_null(spark):
    history = spark.sql(
        "select 'A' symbol, '5m' `interval`, candle_time, cast(close as decimal(37,18)) close from values "
        "(timestamp'2026-01-01 10:00:00', 3), (timestamp'2026-01-01 09:55:00', 0) as t(candle_time, close)"
    )
    latest = history.filter("close = 3")
    row = snap.asof_returns(latest, history).first()
    assert row.close_5m_ago == 0 and row.price_change_pct_5m is None
    assert row.close_15m_ago is None and row.price_change_pct_15m is None


# --- panels ------------------------------------------------------------------------


def test_panel_snapshot_shows_local_time(spark, snapshot):
    shown = panels.panel_snapshot(snapshot)
    assert tuple(shown.columns) == panels.SNAPSHOT_PANEL
    source = {r.symbol: r for r in snapshot.filter("interval = '5m'").collect()}
    rows = shown.collect()
    assert len(rows) == 2
    for row in rows:
        assert row.as_of_time - source[row.symbol].as_of_time == timedelta(hours=7)
    assert panels.panel_snapshot(snapshot, None).count() == 3
    assert panels.panel_snapshot(snapshot, ["1d", "1w"], "UTC").count() == 1


def test_trend_panel_starts_from_the_oldest_candle(mart):
    only = mart.filter("symbol = 'AAA'")
    pdf = to_pandas(only.filter("interval = '5m'"), "candle_time")
    rows = panels.panel_trend_vs_ema(only, tz="UTC").collect()
    assert len(rows) == panels.LINE_ROWS
    assert [r.candle_time for r in rows] == sorted(r.candle_time for r in rows)
    base, last = pdf.iloc[0], pdf.iloc[-1]
    assert rows[-1].close_change_pct == pytest.approx((float(last.close) / float(base.close) - 1) * 100, abs=5.1e-5)
    assert rows[-1].ema_change_pct == pytest.approx((last.ema_20 / base.ema_20 - 1) * 100, abs=5.1e-5)


def test_line_and_bar_panels(mart):
    pdf = to_pandas(mart.filter("symbol = 'AAA' and interval = '5m'"), "candle_time")
    only, last = mart.filter("symbol = 'AAA'"), pdf.iloc[-1]
    bands = panels.panel_rsi_bands(only, tz="UTC").collect()
    assert (len(bands), bands[-1].rsi_14) == (120, last.rsi_14)
    assert (bands[0].oversold_band, bands[0].overbought_band) == (30.0, 70.0)
    distance = panels.panel_ema_distance(only, tz="UTC").collect()
    assert distance[-1].distance_to_ema_pct == pytest.approx((float(last.close) - last.ema_20) / last.ema_20 * 100, abs=5.1e-5)
    spikes = panels.panel_volume_spike(only, tz="UTC").collect()
    assert len(spikes) == panels.BAR_ROWS
    assert spikes[-1].volume_spike_ratio == pytest.approx(float(last.volume) / last.volume_ma_20, abs=5.1e-5)


def test_returns_panel_labels(snapshot):
    rows = panels.panel_returns_long(snapshot, ["1d"]).collect()
    wide = snapshot.filter("interval = '1d'").first()
    assert [r.timeframe for r in rows] == ["5m", "15m", "1h", "4h", "1d", "1w"]
    assert [r.return_pct for r in rows] == [wide[c] for c in snap.RETURN_COLUMNS]


# --- quality -----------------------------------------------------------------------


def results(frame):
    return {(r.check_name, r.column_name): (r.failing_rows, r.status) for r in frame.collect()}


def test_rules(spark):
    df = spark.sql("select * from values ('a', 'x'), ('a', null), (null, 'z'), (null, 'y') as t(event_id, label)")
    rules = quality.not_null("event_id", "label") + [quality.accepted_values("label", ["x", "y"])]
    assert results(quality.count_failures(df, "t", rules)) == {
        ("not_null", "event_id"): (2, "error"),
        ("not_null", "label"): (1, "error"),
        ("accepted_values", "label"): (1, "error"),
    }
    assert [tuple(r) for r in quality.duplicates(df).collect()] == [("a", 2)]
    assert results(quality.count_duplicates(df, "t")) == {("unique", "event_id"): (1, "error")}


@pytest.mark.parametrize("minutes, status", [(0, "pass"), (30, "pass"), (31, "warn"), (1440, "warn"), (1441, "error")])
def test_freshness(spark, minutes, status):
    df = spark.sql("select timestamp'2026-01-01 00:00:00' as ingest_time")
    as_of = f"(timestamp'2026-01-01 00:00:00' + interval {minutes} minutes)"
    assert quality.freshness(df, "t", as_of).first().status == status
    assert quality.freshness(df.limit(0), "t", as_of).first().status == "error"


def test_assertions(spark, mart):
    good = ticker_frame(spark, ("AAA", 1, 1, 1))
    assert quality.assert_rows(good, quality.TICKER_ASSERTION).isEmpty()
    for name, value in (("symbol", "' '"), ("last_price", "0"), ("volume_24h", "-1"), ("trade_count_24h", "-1"), ("low_price_24h", "6")):
        bad = good.selectExpr(*[f"{value} as {name}" if c == name else c for c in good.columns])
        assert quality.assert_rows(bad, quality.TICKER_ASSERTION).count() == 1
    assert quality.assert_rows(mart, quality.CANDLE_ASSERTION).isEmpty()
    for name, value in (("open", "0"), ("high", "low - 1"), ("rsi_14", "101d"), ("atr_14", "-1d"), ("volume", "-1")):
        bad = mart.limit(5).selectExpr(*[f"{value} as {name}" if c == name else c for c in mart.columns])
        assert quality.assert_rows(bad, quality.CANDLE_ASSERTION).count() == 5


def test_nonempty(spark, mart):
    assert quality.nonempty(mart, "p").first().status == "pass"
    assert quality.nonempty(mart.filter("symbol = 'no'"), "p").first().status == "error"


def test_suite_of_sound_tables(spark, mart, snapshot):
    assert quality.run_suite({"ohlcv": mart, "snapshot": snapshot})[1] == 0
    broken = mart.selectExpr("* except (trend_regime)", "'up' as trend_regime")
    failed, code = quality.run_suite({"ohlcv": broken})
    assert code == 1 and failed.count() > 0 and set(failed.select("status").distinct().collect()[0]) == {"error"}
