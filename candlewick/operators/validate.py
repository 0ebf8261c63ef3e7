"""Validation of logged events: an ordered chain of rules, the first failing one names the reason.

Events are JSON texts in ``value``. Text that does not parse is invalid; JSON
that is not an object is dropped. Numbers are taken from numbers or text,
times from ISO-8601 text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T

from candlewick.functions.columns import add, choose
from candlewick.functions.payload import amount, field, instant, is_object, stripped
from candlewick.schemas import AMOUNT, TABLES, TICKER

# The required fields of each event type, in reporting order.
REQUIRED = {
    "ticker": tuple(name for name in TICKER.names if name != "raw_payload"),
    "kline": (
        "event_id", "source", "symbol", "interval", "open_time", "close_time",
        "open_price", "high_price", "low_price", "close_price", "volume",
        "quote_asset_volume", "trade_count", "is_closed", "ingest_time",
    ),
}

# Reason texts with the condition each one reports, in order.
_TYPED_RULES = {
    "ticker": {
        "Ticker payload contains negative values.": "least(last_price, open_price_24h, high_price_24h,"
        " low_price_24h, volume_24h, quote_volume_24h) < 0",
        "Ticker high_price_24h is lower than low_price_24h.": "high_price_24h < low_price_24h",
        "Ticker trade_count_24h must be zero or greater.": "trade_count_24h < 0",
    },
    "kline": {
        "Kline close_time is earlier than open_time.": "close_time < open_time",
        "Kline payload contains negative values.": "least(open_price, high_price, low_price,"
        " close_price, volume, quote_asset_volume) < 0",
        "Kline high_price is inconsistent with candle values.": "high_price < greatest(open_price,"
        " close_price, low_price)",
        "Kline low_price is inconsistent with candle values.": "low_price > least(open_price,"
        " close_price, high_price)",
        "Kline trade_count must be zero or greater.": "trade_count < 0",
    },
}
MALFORMED = "Malformed JSON."


def _typed(name: str, kind: T.DataType) -> str:
    text = f"_{name}"
    if kind == AMOUNT:
        return amount(text)
    if isinstance(kind, T.LongType):
        return field("_event", f"$.{name}", "bigint")
    if isinstance(kind, T.TimestampType):
        return instant(text)
    if isinstance(kind, T.BooleanType):
        return _truth(name)
    return f"upper({text})" if name == "symbol" else text


def _truth(name: str) -> str:
    """Truth of a JSON value: false for false, zero and empty containers, else true."""
    kind = f"schema_of_variant({field('_event', f'$.{name}', 'variant')})"
    return (
        f"case when {kind} = 'BOOLEAN' then {field('_event', f'$.{name}', 'boolean')}"
        f" when {kind} = 'STRING' then true"
        f" when {kind} like 'ARRAY%' or {kind} like 'OBJECT%' then _{name} not in ('[]', '{{}}')"
        f" else coalesce({field('_event', f'$.{name}', 'double')} != 0, true) end"
    )


def _type_rule(event_type: str) -> str:
    shown = (
        "case when is_variant_null(try_variant_get(_event, '$.event_type', 'variant')) then 'none'"
        " when coalesce(_event_type, '') = '' then 'missing' else _event_type end"
    )
    return (
        f"when coalesce(_event_type, '') != '{event_type}' then"
        f" concat('Unexpected event_type \\'', {shown}, '\\'. Expected \\'{event_type}\\'.')"
    )


def validate(
    events: DataFrame, event_type: str, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """The typed columns of ``event_type``, ``reason`` (null if valid), ``value`` and ``keep``."""
    table = TABLES[event_type]
    required = REQUIRED[event_type]
    parsed = add(
        events.selectExpr(*keep, f"{value} as value"), {"_event": "try_parse_json(value)"}
    )
    # Fields are stripped once; a time is read as it stands.
    times = {f.name for f in table if isinstance(f.dataType, T.TimestampType)}
    texts = {"_event_type": f"lower({stripped(field('_event', '$.event_type'))})"}
    for name in required:
        text = field("_event", f"$.{name}")
        texts[f"_{name}"] = text if name in times else stripped(text)
    typed = {f.name: _typed(f.name, f.dataType) for f in table if f.name != "raw_payload"}
    rows = add(add(parsed, texts), typed)

    absent = ", ".join(
        f"if(coalesce({stripped(f'_{name}') if name in times else f'_{name}'}, '') = '', '{name}', null)"
        for name in required
    )
    names = [f.name for f in table if not isinstance(f.dataType, (T.StringType, T.BooleanType))]
    untyped = " or ".join(f"{name} is null" for name in names)
    label = event_type.capitalize()
    rules = [
        f"when _event is null then '{MALFORMED}'",
        _type_rule(event_type),
        f"when _missing != '' then concat('Missing required {event_type} fields: ', _missing)",
        f"when {untyped} then '{label} payload contains invalid typed values.'",
        *[f"when {test} then '{reason}'" for reason, test in _TYPED_RULES[event_type].items()],
    ]
    rows = add(rows, {"_missing": f"concat_ws(', ', {absent})"})
    # The verdict comes out of a generator: a filter on it stays above, instead
    # of being pushed down with every expression behind it written out again.
    verdict = (
        f"struct(case {' '.join(rules)} end as reason,"
        f" _event is not null and not {is_object('value')} as _dropped)"
    )
    rows = rows.selectExpr("*", f"inline(array({verdict}))").filter("not _dropped")
    return choose(rows, [*keep, *typed, "reason", "value"])


def clean_rows(validated: DataFrame, event_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Valid rows in the layout of the table; the whole event is the raw payload."""
    return choose(
        validated.filter("reason is null"),
        [*TABLES[event_type].names, *keep],
        {"raw_payload": "value"},
    )


def invalid_rows(validated: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rejected rows: the reason and the event as it came."""
    return validated.filter("reason is not null").selectExpr(*keep, "reason", "value as payload")
