"""Market tables derived from the ``events`` test table.

An adapter, not an operator: it turns the generic event stream into candles
and tickers, so that the operators can be checked on the given data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.functions.columns import add, choose, join_per_key
from candlewick.schemas import KLINE, TICKER

SOURCE_NAME = "testdata"

# Candle intervals in use: length and offset of their buckets from the epoch in
# seconds (weeks start on Monday). Each length is a multiple of the first one.
BUCKETS = {
    "5m": (300, 0),
    "1h": (3600, 0),
    "4h": (14400, 0),
    "1d": (86400, 0),
    "1w": (604800, 345600),
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "cast(ts as timestamp) as ts",
        "upper(event_type) as symbol",
        "cast(value as decimal(18,2)) as value",
    )


def _bucket(seconds: str, interval: str) -> str:
    width, offset = BUCKETS[interval]
    return f"floor(({seconds} - {offset}) / {width}) * {width} + {offset}"


def _fine_candles(source: DataFrame) -> DataFrame:
    # (ts, event_id) as one number: a fixed-width ordering keeps min_by/max_by
    # in the hash aggregate, where a struct would force a sort.
    placed = add(
        source,
        {
            "bucket": _bucket("unix_seconds(ts)", "5m"),
            "at": "cast(cast(unix_micros(ts) as decimal(19,0)) * 10000000000000000000 + event_id"
            " as decimal(38,0))",
        },
    )
    return placed.sparkSession.sql(
        """
        select symbol, bucket,
               min_by(value, at) as open_price, max(value) as high_price, min(value) as low_price,
               max_by(value, at) as close_price, sum(value) as volume,
               sum(value * value) as quote_asset_volume, count(*) as trade_count
        from {ticks} group by symbol, bucket
        """,
        ticks=placed,
    )


def candles(
    spark: SparkSession, sf_dir: str, intervals: Sequence[str] = tuple(BUCKETS)
) -> DataFrame:
    """Candles of the intervals per event type, with the columns of the kline table.

    The coarse candles roll up the five-minute ones, so the raw events are
    aggregated once. The newest candle per symbol and interval is still open:
    its ingest time is its open time.
    """
    source = events(spark, sf_dir)
    coarser = ", ".join(
        f"struct('{name}' as interval, {BUCKETS[name][0]}L as width, {_bucket('bucket', name)} as open_s)"
        for name in intervals
    )
    rolled = spark.sql(
        """
        select symbol, interval, open_s, open_s + width as end_s,
               min_by(open_price, bucket) as open_price, max(high_price) as high_price,
               min(low_price) as low_price, max_by(close_price, bucket) as close_price,
               sum(volume) as volume, sum(quote_asset_volume) as quote_asset_volume,
               sum(trade_count) as trade_count
        from {fine} group by symbol, interval, width, open_s
        """,
        fine=_fine_candles(source).selectExpr("*", f"inline(array({coarser}))"),
    )
    newest = source.groupBy("symbol").agg(F.max("ts").alias("newest_ts"))
    placed = join_per_key(rolled, newest, ["symbol"])
    columns = {
        "event_id": "concat_ws('-', 'kline', symbol, interval, open_s * 1000)",
        "source": f"'{SOURCE_NAME}'",
        "open_time": "timestamp_seconds(open_s)",
        "close_time": "timestamp_millis(end_s * 1000 - 1)",
        "is_closed": "true",
        "ingest_time": "if(newest_ts < timestamp_seconds(end_s), timestamp_seconds(open_s),"
        " timestamp_millis(end_s * 1000 + 4999))",
        "raw_payload": "'{}'",
    }
    return _typed(placed, KLINE, columns)


def _typed(df: DataFrame, schema, columns: dict[str, str]) -> DataFrame:
    return choose(
        df,
        schema.names,
        {f.name: f"cast({columns.get(f.name, f.name)} as {f.dataType.simpleString()})" for f in schema},
    )


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 24-hour ticker per one-hour candle, with the columns of the ticker table.

    The trailing day is a range frame over a regular clock, so a month of a
    symbol forms a window partition, together with the 23 hours ahead of it.
    """
    month, halo = 32 * 86400, 23 * 3600
    hourly = add(candles(spark, sf_dir, ["1h"]), {"at": "unix_seconds(open_time)"})
    hourly = hourly.selectExpr(
        "*",
        f"floor(at / {month}) as home",
        f"explode(sequence(floor(at / {month}), floor((at + {halo}) / {month}))) as part",
    )
    day = (
        "over (partition by symbol, part order by at"
        f" range between {halo} preceding and current row)"
    )
    trailing = add(
        hourly,
        {
            "last_price": "close_price",
            "open_price_24h": f"first(open_price) {day}",
            "high_price_24h": f"max(high_price) {day}",
            "low_price_24h": f"min(low_price) {day}",
            "volume_24h": f"sum(volume) {day}",
            "quote_volume_24h": f"sum(quote_asset_volume) {day}",
            "trade_count_24h": f"sum(trade_count) {day}",
        },
    ).filter("part = home")
    change = "(last_price - open_price_24h)"
    columns = {
        "event_id": "concat_ws('-', 'ticker', symbol, unix_millis(close_time))",
        "event_time": "close_time",
        "ingest_time": "close_time + interval 5 seconds",
        "price_change_24h": change,
        "price_change_pct_24h": f"round(cast({change} as double)"
        " / nullif(cast(open_price_24h as double), 0d) * 100, 4)",
    }
    return _typed(trailing, TICKER, columns)


# --- raw responses -----------------------------------------------------------------

RESPONSE_CANDLES = 500


def raw_ticker_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed ticker responses: one JSON object per row in ``value``."""
    return tickers(spark, sf_dir).selectExpr(
        """to_json(named_struct(
            'symbol', symbol, 'closeTime', unix_millis(event_time),
            'lastPrice', cast(last_price as string),
            'priceChange', cast(price_change_24h as string),
            'priceChangePercent', cast(price_change_pct_24h as string),
            'volume', cast(volume_24h as string), 'quoteVolume', cast(quote_volume_24h as string),
            'openPrice', cast(open_price_24h as string), 'highPrice', cast(high_price_24h as string),
            'lowPrice', cast(low_price_24h as string), 'count', trade_count_24h)) as value"""
    )


_KLINE_ITEM = """concat('[', unix_millis(open_time), ',"', open_price, '","', high_price, '","', low_price,
            '","', close_price, '","', volume, '",', unix_millis(close_time), ',"',
            quote_asset_volume, '",', trade_count, ',"0","0","0"]')"""
_WIDTH = "(unix_seconds(close_time) + 1 - unix_seconds(open_time))"
_SLOT = f"floor(unix_seconds(open_time) / {_WIDTH})"


def _kline_responses(items: DataFrame) -> DataFrame:
    """Responses of (symbol, interval, response, nr, item), with the items in the order of their numbers."""
    listed = "transform(array_sort(collect_list(struct(nr, item))), i -> i.item)"
    return items.groupBy("symbol", "interval", "response").agg(
        F.expr(f"concat('[', concat_ws(',', {listed}), ']')").alias("value")
    ).drop("response")


def _kline_items(rows: DataFrame, item: str = _KLINE_ITEM) -> DataFrame:
    return rows.selectExpr(
        "symbol",
        "interval",
        f"floor(unix_seconds(open_time) / ({_WIDTH} * {RESPONSE_CANDLES})) as response",
        "unix_millis(open_time) as nr",
        f"{item} as item",
    )


def raw_klines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed candle responses: a JSON array of at most 500 candles per row."""
    return _kline_responses(_kline_items(candles(spark, sf_dir)))


def refetched_klines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses fetched twice, with ``fetched_at``. The first time every close is one higher, the
    second time every candle comes twice in its response, first with its close two higher."""
    rows = candles(spark, sf_dir)
    higher = [rows.withColumn("close_price", F.expr(f"cast(close_price + {n} as {KLINE['close_price'].dataType.simpleString()})")) for n in (1, 2)]
    first = _kline_responses(_kline_items(higher[0]))
    again = _kline_items(higher[1]).unionByName(_kline_items(rows).withColumn("nr", F.expr("nr + 1")))
    fetched = "timestamp'2024-02-0{} 00:00:00' as fetched_at"
    return (
        _kline_responses(again).selectExpr("*", fetched.format(2))
        .unionByName(first.selectExpr("*", fetched.format(1)))
    )


# --- responses that cannot be read -------------------------------------------------


def dirty_ticker_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed ticker responses with one defect per slot of eight hours."""
    slot = "pmod(floor((unix_seconds(event_time) + 1) / 3600), 8)"
    return tickers(spark, sf_dir).selectExpr(
        f"""case {slot} when 4 then '{{"symbol":' when 5 then '[]' else to_json(named_struct(
            'symbol', if({slot} = 0, ' ', symbol),
            'closeTime', if({slot} = 1, 'soon', cast(unix_millis(event_time) as string)),
            'lastPrice', if({slot} = 2, 'abc', cast(last_price as string)),
            'priceChange', cast(price_change_24h as string),
            'priceChangePercent', cast(price_change_pct_24h as string),
            'volume', cast(volume_24h as string), 'quoteVolume', cast(quote_volume_24h as string),
            'openPrice', cast(open_price_24h as string), 'highPrice', cast(high_price_24h as string),
            'lowPrice', cast(low_price_24h as string),
            'count', if({slot} = 3, 'many', cast(trade_count_24h as string)))) end as value"""
    )


def dirty_klines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed candle responses with one defect per slot of eight candles; those of weeks are no lists."""
    defect = f"pmod({_SLOT}, 8)"
    item = f"""case {defect} when 0 then '["short"]' when 1 then '{{"not":"a list"}}'
        when 2 then replace({_KLINE_ITEM}, concat('[', unix_millis(open_time)), '["soon"')
        when 3 then replace({_KLINE_ITEM}, concat(',"', open_price, '"'), ',"abc"')
        else {_KLINE_ITEM} end"""
    responses = _kline_responses(_kline_items(candles(spark, sf_dir), item))
    return responses.withColumn("value", F.expr("""if(interval = '1w', '{"code":-1}', value)"""))


# --- events with defects -----------------------------------------------------------

# One defect per slot of 16 consecutive buckets; slots not named are clean.
_TICKER_DEFECTS = {
    0: {"event_type": "'trade'"},
    1: {"symbol": "'  '"},
    2: {"source": "null", "volume_24h": "null"},
    3: {"last_price": "'-1'"},
    4: {"high_price_24h": "'1'", "low_price_24h": "'2'"},
    5: {"event_time": "'10:00'"},
    6: {"last_price": "'NaN'"},
    7: {"trade_count_24h": "'-1'"},
    11: {"event_type": "null"},
    12: {"trade_count_24h": "'12.0'"},
    13: {"symbol": "concat(' ', lower(symbol), '\\t')"},
    # Nineteen decimals do not fit an amount; zeros behind the eighteenth do, whatever the notation.
    14: {"last_price": "concat(last_price, '1')"},
    15: {"last_price": "concat(last_price, '0000')", "low_price_24h": "'0.00000000000000000100e0'"},
}
_KLINE_DEFECTS = {
    0: {"event_type": "'ticker'"},
    1: {"symbol": "'  '"},
    2: {"source": "null", "volume": "null"},
    3: {"close_price": "'-1'"},
    4: {"open_price": "'1.5'", "high_price": "'1'", "low_price": "'2'", "close_price": "'1.5'"},
    5: {"open_time": "'10:00'"},
    6: {"close_price": "'NaN'"},
    7: {"trade_count": "'-1'"},
    10: {"open_time": "'2030-01-01T00:00:00Z'"},
    11: {"open_price": "'5'", "high_price": "'9'", "low_price": "'5.5'", "close_price": "'6'"},
    12: {"is_closed": "'false'"},
    15: {"volume": "'12e-20'"},
}


def _dirty(df: DataFrame, schema, slot: str, defects: dict, event_type: str, extra: str) -> DataFrame:
    iso = "yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSSxxx"
    good = {"event_type": f"'{event_type}'"}
    for field in schema:
        if field.name == "raw_payload":
            continue
        kind = field.dataType.simpleString()
        good[field.name] = (
            f"date_format({field.name}, '{iso}')" if kind == "timestamp" else f"cast({field.name} as string)"
        )
    bad = {
        name: " ".join(f"when {n} then {changes[name]}" for n, changes in defects.items() if name in changes)
        for name in good
    }
    fields = ", ".join(
        f"'{name}', " + (f"case slot {bad[name]} else {text} end" if bad[name] else text)
        for name, text in good.items()
        if name != "is_closed" or not extra
    )
    return add(df, {"slot": f"pmod({slot}, 16)"}).selectExpr(
        "event_id as key",
        f"""case slot when 8 then '{{"event_type":' when 9 then '[1,2]'
            when 14 then replace(to_json(named_struct({fields})), '"event_type"', '"was":1,"event_type"')
            else to_json(named_struct({fields})) end as text""",
        "slot",
    )


def dirty_ticker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker events as logged (``key``, ``value``), with one defect per row."""
    events_ = _dirty(
        tickers(spark, sf_dir), TICKER, "floor((unix_seconds(event_time) + 1) / 3600)",
        _TICKER_DEFECTS, "ticker", "",
    )
    # An explicit null type, which a struct cannot write.
    return events_.selectExpr(
        "key", "if(slot = 10, replace(text, '\"event_type\":\"ticker\"', '\"event_type\":null'), text) as value"
    )


def dirty_kline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kline events as logged (``key``, ``value``), with one defect per row."""
    width = "unix_seconds(close_time) + 1 - unix_seconds(open_time)"
    events_ = _dirty(
        candles(spark, sf_dir), KLINE, f"floor(unix_seconds(open_time) / ({width}))",
        _KLINE_DEFECTS, "kline", "typed",
    )
    flag = "case slot when 12 then '\"false\"' when 13 then 'false' when 14 then '0' else 'true' end"
    return events_.selectExpr(
        "key",
        f"if(text like '{{%' and slot != 8, concat('{{\"is_closed\":', {flag}, ',', substr(text, 2)), text) as value",
    )


# --- versions and rows that break the quality rules --------------------------------


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candle as version 1, each rising one also as version 2 with a close one higher.

    By the candle's slot of four, the two are written in order, in reverse order within a batch, in
    reverse order of batches, or by a producer that gives no versions.
    """
    slot = f"pmod({_SLOT}, 4)"
    again = "filter(array(1L, 2L), v -> v = 1 or close_price > open_price)"
    numbered = candles(spark, sf_dir).selectExpr("*", f"explode({again}) as v")
    amount_type = KLINE["close_price"].dataType.simpleString()
    return choose(
        numbered,
        [*KLINE.names, "version", "batch_id", "log_position"],
        {
            "close_price": f"cast(close_price + (v - 1) as {amount_type})",
            "version": f"if({slot} = 3, null, concat('2024-02-0', v, 'T00:00:00.000000#0000000000'))",
            "batch_id": f"case {slot} when 0 then v when 2 then 3 - v else 1L end",
            "log_position": f"case {slot} when 1 then 10 - v when 3 then v else 0L end",
        },
    )


def defective_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickers of which some break a quality rule, by hour of the day."""
    hour = "hour(event_time)"
    return choose(
        tickers(spark, sf_dir),
        TICKER.names,
        {
            "event_id": f"if({hour} = 1, null, event_id)",
            "symbol": f"case {hour} when 2 then null when 3 then '  ' else symbol end",
            "last_price": f"case {hour} when 4 then null when 5 then 0 else last_price end",
            "ingest_time": f"if({hour} = 6, null, ingest_time)",
            "volume_24h": f"if({hour} = 7, -volume_24h - 1, volume_24h)",
            "trade_count_24h": f"if({hour} = 8, -1, trade_count_24h)",
            "high_price_24h": f"if({hour} = 9, low_price_24h - 1, high_price_24h)",
        },
    )


def defective_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of which some break a quality rule, by hour of the day; rising ones come twice."""
    hour = "hour(open_time)"
    return choose(
        versions(spark, sf_dir),
        KLINE.names,
        {
            "event_id": f"if({hour} = 1, null, event_id)",
            "symbol": f"if({hour} = 2, null, symbol)",
            "interval": f"case {hour} when 3 then null when 4 then '2m' else interval end",
            "open_time": f"if({hour} = 5, null, open_time)",
            "close_price": f"if({hour} = 6, null, close_price)",
        },
    )
