"""Inputs shared by the tests, made up here: an instrument that trades around 4 a piece."""

import json
from datetime import datetime, timezone

SYMBOL = "ABCUSD"
OPEN = datetime(2025, 6, 11, 4, 30, tzinfo=timezone.utc)
STEP_MS = 300_000
OPEN_MS = int(OPEN.timestamp()) * 1000
CLOSE_MS = OPEN_MS + STEP_MS - 1

TICKER_RESPONSE = {
    "symbol": SYMBOL,
    "closeTime": OPEN_MS + STEP_MS,
    "lastPrice": "4.0625",
    "priceChange": "0.3125",
    "priceChangePercent": "8.333",
    "volume": "5200.5",
    "quoteVolume": "20802.00",
    "openPrice": "3.7500",
    "highPrice": "4.5000",
    "lowPrice": "3.5000",
    "count": 611,
}

KLINE_ROW = [
    OPEN_MS, "3.9000", "4.2500", "3.8750", "4.0625", "18.75",
    CLOSE_MS, "75.0390625", 37, "9.5", "38.000", "unused",
]

TICKER_EVENT = {
    "event_type": "ticker",
    "event_id": f"ticker-{SYMBOL}-1",
    "source": "exchange",
    "symbol": SYMBOL,
    "event_time": "2025-06-11T04:35:00+00:00",
    "ingest_time": "2025-06-11T04:35:09+00:00",
    "last_price": "4.0625",
    "price_change_24h": "-0.4375",
    "price_change_pct_24h": "-9.722",
    "volume_24h": "640",
    "quote_volume_24h": "2624",
    "open_price_24h": "4.5",
    "high_price_24h": "4.75",
    "low_price_24h": "3.25",
    "trade_count_24h": 83,
}

KLINE_EVENT = {
    "event_type": "kline",
    "event_id": f"kline-{SYMBOL}-5m-1",
    "source": "exchange",
    "symbol": SYMBOL,
    "interval": "5m",
    "open_time": "2025-06-11T04:30:00+00:00",
    "close_time": "2025-06-11T04:34:59.999000+00:00",
    "ingest_time": "2025-06-11T04:35:09+00:00",
    "open_price": "3.9",
    "high_price": "4.25",
    "low_price": "3.875",
    "close_price": "4.0625",
    "volume": "18.75",
    "quote_asset_volume": "75.0390625",
    "trade_count": 37,
    "is_closed": True,
}


def event(base: dict, **changes) -> str:
    return json.dumps({**base, **changes})


def without(base: dict, *names: str) -> str:
    return json.dumps({k: v for k, v in base.items() if k not in names})
