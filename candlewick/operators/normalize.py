"""Exchange responses to events: envelope columns and a JSON payload.

Input is one landed response per row in ``value``. A response, or a candle in
it, that cannot be read fails the job (``on_error="fail"``) or is kept with its
``error`` and its raw text in ``value`` (``on_error="quarantine"``).

Every event carries a ``version``: when its response was fetched, and its position in the
response, as a text that sorts in this order. Of two versions of an event the larger one counts,
however the log, its files or its partitions order them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from candlewick.functions.columns import add, choose
from candlewick.functions.payload import epoch_millis, field, iso, number, stripped

ENVELOPE = ("event_id", "event_type", "source", "symbol", "event_time", "ingest_time", "payload")

# Payload column -> name in the exchange's ticker object.
_TICKER_AMOUNTS = {
    "last_price": "lastPrice",
    "price_change_24h": "priceChange",
    "price_change_pct_24h": "priceChangePercent",
    "volume_24h": "volume",
    "quote_volume_24h": "quoteVolume",
    "open_price_24h": "openPrice",
    "high_price_24h": "highPrice",
    "low_price_24h": "lowPrice",
}
# Payload column -> position in the exchange's candle array.
_KLINE_AMOUNTS = {
    "open_price": 1,
    "high_price": 2,
    "low_price": 3,
    "close_price": 4,
    "volume": 5,
    "quote_asset_volume": 7,
}
_KLINE_MIN_FIELDS = 11


def _ingest(responses: DataFrame, given: str | None) -> tuple[str, list[str]]:
    """The expression of the ingest time, and the columns it needs."""
    kept = [c for c in ("fetched_at",) if c in responses.columns]
    return given or (kept[0] if kept else "current_timestamp()"), kept


def _version(ingest_time: str, position: str) -> str:
    return f"concat(date_format({ingest_time}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '#', lpad({position}, 10, '0'))"


def normalize_ticker(
    responses: DataFrame,
    source_name: str,
    ingest_time: str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Events from 24-hour ticker responses; ``ingest_time`` is a timestamp expression, by default
    the response's ``fetched_at``, or the time of the job where that column is missing."""
    ingest_time, kept = _ingest(responses, ingest_time)
    parsed = add(responses.select("value", *kept), {"_raw": "try_parse_json(value)"})
    read = add(
        parsed,
        {
            "symbol": stripped(field("_raw", "$.symbol")),
            "_time_ms": field("_raw", "$.closeTime", "bigint"),
            "trade_count_24h": field("_raw", "$.count", "bigint"),
            **{
                name: stripped(field("_raw", f"$.{key}")) for name, key in _TICKER_AMOUNTS.items()
            },
        },
    )
    read = add(read, {"_time": epoch_millis("_time_ms")})
    error = _first_error(
        {
            "Malformed JSON.": "_raw is null",
            "Missing required field: symbol.": "coalesce(symbol, '') = ''",
            "Invalid timestamp field: closeTime.": "_time is null",
            **{
                f"Invalid decimal field: {key}.": f"{number(name)} is null"
                for name, key in _TICKER_AMOUNTS.items()
            },
            "Invalid integer field: count.": "trade_count_24h is null",
        }
    )
    payload = {
        "event_id": "concat_ws('-', 'ticker', symbol, _time_ms)",
        "event_type": "'ticker'",
        "source": _text(source_name),
        "symbol": "symbol",
        "event_time": iso("_time"),
        "ingest_time": iso(ingest_time),
        **{name: name for name in _TICKER_AMOUNTS},
        "trade_count_24h": "trade_count_24h",
        "raw_payload": "_raw",
    }
    return _events(add(read, {"error": error}), payload, _version(ingest_time, "'0'"), on_error)


def normalize_klines(
    responses: DataFrame,
    source_name: str,
    ingest_time: str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Events from candle responses: ``value`` (array of arrays), ``symbol`` and ``interval``;
    ``ingest_time`` as for tickers."""
    ingest_time, kept = _ingest(responses, ingest_time)
    parsed = add(
        responses.selectExpr(
            "value", f"upper({stripped('symbol')}) as symbol", f"{stripped('interval')} as interval", *kept
        ),
        {"_list": "try_variant_get(try_parse_json(value), '$', 'array<variant>')"},
    )
    items = parsed.selectExpr("*", "posexplode_outer(_list) as (_position, _raw)")
    read = add(
        items,
        {
            "_fields": "size(try_variant_get(_raw, '$', 'array<variant>'))",
            "_open_ms": field("_raw", "$[0]", "bigint"),
            "_close_ms": field("_raw", "$[6]", "bigint"),
            "trade_count": field("_raw", "$[8]", "bigint"),
            **{
                name: stripped(field("_raw", f"$[{at}]")) for name, at in _KLINE_AMOUNTS.items()
            },
        },
    )
    read = add(
        read, {"open_time": epoch_millis("_open_ms"), "close_time": epoch_millis("_close_ms")}
    ).filter("_list is null or size(_list) > 0")
    error = _first_error(
        {
            "Kline response is not a list.": "_list is null",
            "Invalid kline payload shape.": f"coalesce(_fields, 0) < {_KLINE_MIN_FIELDS}",
            "Missing required field: symbol.": "coalesce(symbol, '') = ''",
            "Invalid timestamp field: close_time.": "close_time is null",
            "Invalid timestamp field: open_time.": "open_time is null",
            **{
                f"Invalid decimal field: {name}.": f"{number(name)} is null"
                for name in _KLINE_AMOUNTS
            },
            "Invalid integer field: trade_count.": "trade_count is null",
        }
    )
    payload = {
        "event_id": "concat_ws('-', 'kline', symbol, interval, _open_ms)",
        "event_type": "'kline'",
        "source": _text(source_name),
        "symbol": "symbol",
        "interval": "interval",
        "event_time": iso("close_time"),
        "ingest_time": iso(ingest_time),
        "open_time": iso("open_time"),
        "close_time": iso("close_time"),
        **{name: name for name in _KLINE_AMOUNTS},
        "trade_count": "trade_count",
        "is_closed": "true",
        "raw_payload": "_raw",
    }
    read = add(read, {"error": error})
    # A rejected candle is kept alone, not with the whole response.
    read = choose(read, read.columns, {"value": "if(_list is null, value, coalesce(to_json(_raw), 'null'))"})
    return _events(read, payload, _version(ingest_time, "cast(_position as string)"), on_error)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _first_error(rules: Mapping[str, str]) -> str:
    whens = " ".join(f"when {test} then {_text(message)}" for message, test in rules.items())
    return f"case {whens} end"


def _events(read: DataFrame, payload: Mapping[str, str], version: str, on_error: str) -> DataFrame:
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be 'fail' or 'quarantine', not {on_error!r}.")
    if on_error == "fail":
        read = read.filter("if(error is null, true, raise_error(error))")
    fields = ", ".join(f"'{name}', {text}" for name, text in payload.items())
    envelope = [f"{payload[name]} as {name}" for name in ENVELOPE[:-1]]
    events = read.selectExpr(
        *envelope,
        f"if(error is null, to_json(named_struct({fields})), null) as payload",
        f"{version} as version",
        "error",
        "value",
    )
    return events.drop("error", "value") if on_error == "fail" else events


def rejects(events: DataFrame) -> DataFrame:
    """Quarantined responses and candles: the reason and the raw text."""
    return events.filter("error is not null").selectExpr("error as reason", "value as payload")


def dump_events(events: DataFrame) -> DataFrame:
    """Each event as one JSON text, with the payload as a nested object."""
    nested = events.selectExpr(*ENVELOPE[:-1], "try_parse_json(payload) as payload")
    return nested.selectExpr("to_json(struct(*), map('pretty', 'true')) as value")
