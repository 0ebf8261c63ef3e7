import json
from decimal import Decimal

import pytest

from candlewick.operators.validate import clean_rows, invalid_rows, validate
from candlewick.schemas import TABLES
from tests.samples import KLINE_EVENT, TICKER_EVENT, event, without

TYPED_T = "Ticker payload contains invalid typed values."
TYPED_K = "Kline payload contains invalid typed values."


def check(spark, kind, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")
    return {r.n: r for r in validate(frame, kind, keep=["n"]).collect()}


def test_clean_events_fill_the_table_columns(spark):
    for kind, base in (("ticker", TICKER_EVENT), ("kline", KLINE_EVENT)):
        frame = spark.createDataFrame([(event(base, symbol=" abcusd\t"),)], "value string")
        clean = clean_rows(validate(frame, kind), kind)
        assert [f.dataType for f in clean.schema] == [f.dataType for f in TABLES[kind]]
        assert clean.columns == TABLES[kind].names
        row = clean.first()
        assert row.symbol == "ABCUSD"
        assert json.loads(row.raw_payload)["event_id"] == row.event_id
        price = row.last_price if kind == "ticker" else row.close_price
        assert price == Decimal("4.0625")


REJECTED_TICKERS = [
    (event(TICKER_EVENT, event_type="kline"), "Unexpected event_type 'kline'. Expected 'ticker'."),
    (event(TICKER_EVENT, event_type=None), "Unexpected event_type 'none'. Expected 'ticker'."),
    (without(TICKER_EVENT, "event_type"), "Unexpected event_type 'missing'. Expected 'ticker'."),
    (event(TICKER_EVENT, symbol="  "), "Missing required ticker fields: symbol"),
    (without(TICKER_EVENT, "source", "volume_24h"), "Missing required ticker fields: source, volume_24h"),
    (event(TICKER_EVENT, last_price=None, symbol=""), "Missing required ticker fields: symbol, last_price"),
    (event(TICKER_EVENT, last_price="-1"), "Ticker payload contains negative values."),
    (event(TICKER_EVENT, last_price="NaN"), TYPED_T),
    (event(TICKER_EVENT, last_price="Infinity"), TYPED_T),
    (event(TICKER_EVENT, last_price=True), TYPED_T),
    (event(TICKER_EVENT, event_time="10:00"), TYPED_T),
    (event(TICKER_EVENT, event_time="2026"), TYPED_T),
    (event(TICKER_EVENT, event_time="2026-02-30T00:00:00Z"), TYPED_T),
    (event(TICKER_EVENT, trade_count_24h="12.0"), TYPED_T),
    (event(TICKER_EVENT, high_price_24h="1", low_price_24h="2"),
     "Ticker high_price_24h is lower than low_price_24h."),
    (event(TICKER_EVENT, trade_count_24h=-1), "Ticker trade_count_24h must be zero or greater."),
    (event(TICKER_EVENT, last_price="-1", trade_count_24h=-1), "Ticker payload contains negative values."),
    ('{"event_type": "ticker"', "Malformed JSON."),
    ("", "Malformed JSON."),
]


def test_ticker_reasons(spark):
    out = check(spark, "ticker", *[value for value, _ in REJECTED_TICKERS])
    assert [out[i].reason for i in range(len(out))] == [reason for _, reason in REJECTED_TICKERS]


ACCEPTED_TICKERS = [
    event(TICKER_EVENT, event_type=" Ticker "),
    event(TICKER_EVENT, last_price=3.875),
    event(TICKER_EVENT, last_price="1e5"),
    event(TICKER_EVENT, last_price=" 12.5 "),
    event(TICKER_EVENT, trade_count_24h=12.7),
    event(TICKER_EVENT, trade_count_24h=True),
    event(TICKER_EVENT, trade_count_24h=" 7 "),
    event(TICKER_EVENT, event_time="2025-06-11T07:55:00Z"),
    event(TICKER_EVENT, event_time="2025-06-11T07:55:00.123456+07:00"),
    event(TICKER_EVENT, event_time="2025-06-11 07:55"),
    event(TICKER_EVENT, event_time="20250611T075500"),
    event(TICKER_EVENT, event_time="2025-06-11"),
    event(TICKER_EVENT, price_change_24h="-5"),
]


def test_accepted_ticker_forms(spark):
    out = check(spark, "ticker", *ACCEPTED_TICKERS)
    assert [out[i].reason for i in range(len(out))] == [None] * len(ACCEPTED_TICKERS)
    assert [out[i].trade_count_24h for i in (4, 5, 6)] == [12, 1, 7]
    assert out[2].last_price == Decimal(100000)
    assert str(out[8].event_time) == "2025-06-11 00:55:00.123456"
    assert str(out[10].event_time) == "2025-06-11 07:55:00"


REJECTED_KLINES = [
    (event(TICKER_EVENT), "Unexpected event_type 'ticker'. Expected 'kline'."),
    (without(KLINE_EVENT, "interval"), "Missing required kline fields: interval"),
    (event(KLINE_EVENT, close_price="x"), TYPED_K),
    (event(KLINE_EVENT, open_time="2025-06-11T05:00:00Z"), "Kline close_time is earlier than open_time."),
    (event(KLINE_EVENT, open_time="2025-06-11T05:00:00Z", volume="-1"),
     "Kline close_time is earlier than open_time."),
    (event(KLINE_EVENT, volume="-1"), "Kline payload contains negative values."),
    (event(KLINE_EVENT, high_price="3.5"), "Kline high_price is inconsistent with candle values."),
    (event(KLINE_EVENT, low_price="4.2"), "Kline low_price is inconsistent with candle values."),
    (event(KLINE_EVENT, trade_count=-1), "Kline trade_count must be zero or greater."),
]


def test_kline_reasons(spark):
    out = check(spark, "kline", *[value for value, _ in REJECTED_KLINES])
    assert [out[i].reason for i in range(len(out))] == [reason for _, reason in REJECTED_KLINES]


@pytest.mark.parametrize(
    "given, truth",
    [(True, True), (False, False), ("false", True), (0, False), (1, True), (0.0, False), ([], False), ([0], True), ({}, False)],
)
def test_is_closed_truth(spark, given, truth):
    row = check(spark, "kline", event(KLINE_EVENT, is_closed=given))[0]
    assert (row.reason, row.is_closed) == (None, truth)


def test_values_that_are_not_objects_are_dropped(spark):
    values = ["[1, 2]", "5", '"text"', "null", "true", event(TICKER_EVENT)]
    assert list(check(spark, "ticker", *values)) == [5]


def test_split_keeps_every_object(spark):
    values = [value for value, _ in REJECTED_TICKERS] + ACCEPTED_TICKERS
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    validated = validate(frame, "ticker")
    assert clean_rows(validated, "ticker").count() == len(ACCEPTED_TICKERS)
    rejected = {(r.reason, r.payload) for r in invalid_rows(validated).collect()}
    assert rejected == {(reason, value) for value, reason in REJECTED_TICKERS}
