import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException

from candlewick.operators.normalize import dump_events, normalize_klines, normalize_ticker
from candlewick.schemas import INTERVALS, parse_intervals
from tests.samples import KLINE_ROW, OPEN_MS, STEP_MS, TICKER_RESPONSE

INGEST = "timestamp'2025-06-11 05:00:00'"


def responses(spark, *values):
    return spark.createDataFrame([(json.dumps(v),) for v in values], "value string")


def kline_responses(spark, *values, symbol="abcusd", interval="5m"):
    return responses(spark, *values).selectExpr("value", f"'{symbol}' symbol", f"'{interval}' as `interval`")


def test_ticker_response_becomes_an_event(spark):
    event = normalize_ticker(responses(spark, TICKER_RESPONSE), "exchange", INGEST).first()
    assert event.event_id == f"ticker-ABCUSD-{OPEN_MS + STEP_MS}"
    assert (event.event_type, event.source, event.symbol) == ("ticker", "exchange", "ABCUSD")
    at = datetime.fromtimestamp((OPEN_MS + STEP_MS) // 1000, tz=timezone.utc)
    assert datetime.fromisoformat(event.event_time) == at
    payload = json.loads(event.payload)
    assert payload["last_price"] == TICKER_RESPONSE["lastPrice"]
    assert payload["price_change_pct_24h"] == TICKER_RESPONSE["priceChangePercent"]
    assert payload["trade_count_24h"] == TICKER_RESPONSE["count"]
    assert payload["raw_payload"] == TICKER_RESPONSE
    assert len(payload) == 16


def test_kline_rows_become_events(spark):
    later = [KLINE_ROW[0] + STEP_MS, *KLINE_ROW[1:]]
    out = normalize_klines(kline_responses(spark, [KLINE_ROW, later]), "exchange", INGEST)
    rows = {r.event_id: r for r in out.collect()}
    assert sorted(rows) == [f"kline-ABCUSD-5m-{OPEN_MS}", f"kline-ABCUSD-5m-{OPEN_MS + STEP_MS}"]
    payload = json.loads(rows[f"kline-ABCUSD-5m-{OPEN_MS}"].payload)
    assert payload["close_price"] == KLINE_ROW[4]
    assert payload["quote_asset_volume"] == KLINE_ROW[7]
    assert payload["trade_count"] == KLINE_ROW[8]
    assert payload["is_closed"] is True
    assert payload["event_time"] == payload["close_time"]
    assert payload["raw_payload"] == KLINE_ROW
    assert len(payload) == 18


@pytest.mark.parametrize(
    "change, error",
    [
        ({"symbol": None}, "Missing required field: symbol."),
        ({"symbol": "  "}, "Missing required field: symbol."),
        ({"closeTime": "soon"}, "Invalid timestamp field: closeTime."),
        ({"lastPrice": "abc"}, "Invalid decimal field: lastPrice."),
        ({"priceChange": None}, "Invalid decimal field: priceChange."),
        ({"count": "many"}, "Invalid integer field: count."),
    ],
)
def test_unreadable_ticker(spark, change, error):
    bad = responses(spark, {**TICKER_RESPONSE, **change})
    kept = normalize_ticker(bad, "exchange", INGEST, on_error="quarantine").first()
    assert kept.error == error
    assert kept.payload is None
    with pytest.raises(PySparkException, match=error):
        normalize_ticker(bad, "exchange", INGEST).collect()


def test_ticker_without_symbol_is_rejected(spark):
    bad = responses(spark, {"closeTime": OPEN_MS, "lastPrice": "1"})
    kept = normalize_ticker(bad, "exchange", INGEST, on_error="quarantine").first()
    assert kept.error == "Missing required field: symbol."


@pytest.mark.parametrize(
    "response, error",
    [
        ([["too short"]], "Invalid kline payload shape."),
        ([{"not": "a list"}], "Invalid kline payload shape."),
        ({"code": -1}, "Kline response is not a list."),
        ([[KLINE_ROW[0], "x", *KLINE_ROW[2:]]], "Invalid decimal field: open_price."),
        ([["x", *KLINE_ROW[1:]]], "Invalid timestamp field: open_time."),
    ],
)
def test_unreadable_klines(spark, response, error):
    bad = kline_responses(spark, response)
    assert normalize_klines(bad, "exchange", INGEST, on_error="quarantine").first().error == error
    with pytest.raises(PySparkException, match=error):
        normalize_klines(bad, "exchange", INGEST).count()


def test_empty_kline_response_has_no_events(spark):
    assert normalize_klines(kline_responses(spark, []), "exchange", INGEST).count() == 0


def test_dump_nests_the_payload(spark):
    text = dump_events(normalize_ticker(responses(spark, TICKER_RESPONSE), "exchange", INGEST)).first()[0]
    dumped = json.loads(text)
    assert dumped["payload"]["raw_payload"] == TICKER_RESPONSE
    assert "\n" in text


def test_interval_list():
    assert parse_intervals("1m,5m, 15m,1h,4h,,1d,1w") == INTERVALS
    assert parse_intervals(None) == ("5m",)
    with pytest.raises(ValueError, match="Unsupported candle intervals: 2m, 3m"):
        parse_intervals("3m,2m,5m")
    with pytest.raises(ValueError, match="At least one"):
        parse_intervals(" , ")
