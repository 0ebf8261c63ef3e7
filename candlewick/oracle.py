"""DuckDB statements that define the expected result of each registered query.

They restate the semantics row by row (recursive averages, lateral as-of
lookups) over tables built from ``events`` inside the statement itself.
"""

from __future__ import annotations

_CANDLES = """
spans(interval, width, shift) as (
  values ('5m', 300, 0), ('1h', 3600, 0), ('4h', 14400, 0), ('1d', 86400, 0), ('1w', 604800, 345600)
),
ticks as (
  select upper(event_type) as symbol, ts, event_id, epoch_us(ts) // 1000000 as sec,
         cast(value as decimal(18,2)) as value
  from events
),
bucketed as (
  select t.*, s.interval, s.width,
         ((t.sec - s.shift) // s.width) * s.width + s.shift as open_s
  from ticks t cross join spans s
),
grouped as (
  select symbol, interval, width, open_s,
         arg_min(value, (ts, event_id)) as open_price,
         max(value) as high_price, min(value) as low_price,
         arg_max(value, (ts, event_id)) as close_price,
         sum(value) as volume,
         sum(cast(value * value as decimal(38,4))) as quote_asset_volume,
         cast(count(*) as bigint) as trade_count
  from bucketed group by all
),
candles as (
  select 'kline-' || symbol || '-' || interval || '-' || (open_s * 1000) as event_id,
         'testdata' as source, symbol, interval, width,
         make_timestamp(open_s * 1000000) as open_time,
         make_timestamp((open_s + width) * 1000000 - 1000) as close_time,
         open_price, high_price, low_price, close_price, volume, quote_asset_volume, trade_count,
         true as is_closed,
         case when open_s = max(open_s) over (partition by symbol, interval)
              then make_timestamp(open_s * 1000000)
              else make_timestamp((open_s + width) * 1000000 - 1000 + 5000000) end as ingest_time,
         open_s
  from grouped
)"""

_TICKER = """
ticker_base as (
  select symbol, close_time, open_time, close_price as last_price,
         first_value(open_price) over d as open_price_24h,
         max(high_price) over d as high_price_24h,
         min(low_price) over d as low_price_24h,
         sum(volume) over d as volume_24h,
         sum(quote_asset_volume) over d as quote_volume_24h,
         cast(sum(trade_count) over d as bigint) as trade_count_24h
  from candles where interval = '1h'
  window d as (partition by symbol order by open_time
               range between interval 23 hours preceding and current row)
),
ticker as (
  select 'ticker-' || symbol || '-' || epoch_ms(close_time) as event_id,
         'testdata' as source, symbol, close_time as event_time,
         close_time + interval 5 seconds as ingest_time,
         last_price, last_price - open_price_24h as price_change_24h,
         round(cast(last_price - open_price_24h as double)
               / nullif(cast(open_price_24h as double), 0) * 100, 4) as price_change_pct_24h,
         volume_24h, quote_volume_24h, open_price_24h, high_price_24h, low_price_24h,
         trade_count_24h
  from ticker_base
)"""

_CLOSED = """
closed as (select * from candles where close_time <= ingest_time)"""

_ORDERED = """
ordered as (
  select *,
         row_number() over w as row_num,
         lag(close_price) over w as previous_close,
         cast(sum(close_price) over (w rows between 19 preceding and current row) as double)
           / count(*) over (w rows between 19 preceding and current row) as sma_20,
         cast(sum(close_price) over (w rows between 49 preceding and current row) as double)
           / count(*) over (w rows between 49 preceding and current row) as sma_50,
         cast(sum(volume) over (w rows between 19 preceding and current row) as double)
           / count(*) over (w rows between 19 preceding and current row) as volume_ma_20,
         sum(close_price) over (w rows between 19 preceding and current row) as sum_20,
         count(*) over (w rows between 19 preceding and current row) as count_20,
         max(high_price) over (w rows between 19 preceding and current row) as rolling_high_20,
         min(low_price) over (w rows between 19 preceding and current row) as rolling_low_20
  from closed
  window w as (partition by symbol, interval order by close_time, event_id)
)"""

_EMA = """
ema(symbol, interval, row_num, ema_20, ema_50) as (
  select symbol, interval, row_num, cast(close_price as double), cast(close_price as double)
  from ordered where row_num = 1
  union all
  select o.symbol, o.interval, o.row_num,
         cast(o.close_price as double) * (cast(2 as double) / 21) + e.ema_20 * (1 - cast(2 as double) / 21),
         cast(o.close_price as double) * (cast(2 as double) / 51) + e.ema_50 * (1 - cast(2 as double) / 51)
  from ordered o join ema e
    on o.symbol = e.symbol and o.interval = e.interval and o.row_num = e.row_num + 1
)"""

_FALLEN = """
fallen as (
  select symbol, interval, event_id, row_number() over (partition by symbol, interval order by close_time, event_id) as row_num,
         cast(cast(close_price as decimal(18,2)) * case when day(close_time) < 16 then 10000000000 else 0.000001 end as double) as x
  from closed
),
fallen_ema(symbol, interval, row_num, event_id, e20, e50) as (
  select symbol, interval, row_num, event_id, x, x from fallen where row_num = 1
  union all
  select f.symbol, f.interval, f.row_num, f.event_id, f.x * (2.0::double / 21) + p.e20 * (19.0::double / 21),
         f.x * (2.0::double / 51) + p.e50 * (49.0::double / 51)
  from fallen_ema p join fallen f on f.symbol = p.symbol and f.interval = p.interval and f.row_num = p.row_num + 1
)"""

_MOVES = """
moves as (
  select *,
         greatest(high_price - low_price,
                  abs(high_price - coalesce(previous_close, close_price)),
                  abs(low_price - coalesce(previous_close, close_price))) as true_range,
         greatest(close_price - coalesce(previous_close, close_price), 0) as gain,
         greatest(coalesce(previous_close, close_price) - close_price, 0) as loss
  from ordered
),
means as (
  select *,
         cast(sum(true_range) over f as double) / count(*) over f as atr_14,
         cast(sum(gain) over f as double) as gain_sum, cast(sum(loss) over f as double) as loss_sum,
         cast(sum(gain) over f as double) / count(*) over f as avg_gain_14,
         cast(sum(loss) over f as double) / count(*) over f as avg_loss_14
  from moves
  window f as (partition by symbol, interval order by close_time, event_id
               rows between 13 preceding and current row)
),
strength as (
  select *,
         case when loss_sum = 0 and gain_sum > 0 then 100.0
              when loss_sum = 0 then 50.0
              else 100 - 100 / (1 + gain_sum / nullif(loss_sum, 0)) end as rsi_14,
         case when open_price <> 0
              then cast(high_price - low_price as double) / cast(open_price as double) * 100
              end as candle_range_pct
  from means
)"""

_MART = """
mart as (
  select s.event_id, s.source, s.symbol, s.interval, s.close_time as candle_time,
         cast(s.open_price as double) as open, cast(s.high_price as double) as high,
         cast(s.low_price as double) as low, cast(s.close_price as double) as close,
         cast(s.volume as double) as volume, cast(s.quote_asset_volume as double) as quote_asset_volume,
         s.trade_count, s.is_closed, s.ingest_time,
         s.sma_20, s.sma_50, e.ema_20, e.ema_50, s.volume_ma_20, s.rsi_14, s.atr_14, s.candle_range_pct,
         cast(s.rolling_high_20 as double) as rolling_high_20,
         cast(s.rolling_low_20 as double) as rolling_low_20,
         case when e.ema_20 > e.ema_50 and s.close_price * s.count_20 > s.sum_20 then 'bullish'
              when e.ema_20 < e.ema_50 and s.close_price * s.count_20 < s.sum_20 then 'bearish'
              else 'ranging' end as trend_regime
  from strength s join ema e using (symbol, interval, row_num)
)"""

_LAGS = (
    ("5m", "5 minutes"), ("15m", "15 minutes"), ("1h", "1 hour"),
    ("4h", "4 hours"), ("24h", "1 day"), ("1w", "7 days"),
)



def _latest(history: str) -> str:
    """The newest candle of each series, and the closes of ``history`` before it."""
    return """
latest as (
  select * from (
    select *, row_number() over (partition by symbol, interval order by close_time desc, event_id desc) as back
    from closed
  ) where back = 1
),
previous as (
  select l.symbol, l.interval, l.close_time as as_of_time, cast(l.close_price as double) as close,
""" + ",\n".join(
    f"         (select cast(h.close_price as double) from {history} h where h.symbol = l.symbol and h.interval = l.interval"
    f" and h.close_time <= l.close_time - interval {text} order by h.close_time desc, h.event_id desc limit 1) as close_{name}_ago"
    for name, text in _LAGS
) + """
  from latest l
)"""

# Candles with a second one at the same time.
_TIED = """
tied as (
  from closed
  union all
  select * replace (event_id || '-2' as event_id, close_price + 1 as close_price) from closed
  where (epoch_ms(close_time) // 1000) % 900 = 299 or interval <> '5m'
)"""

_PCT = ",\n".join(
    f"         round((close - close_{name}_ago) / nullif(close_{name}_ago, 0) * 100, 8) as price_change_pct_{name}"
    for name, _ in _LAGS
)

_LATEST_TICKER = """
latest_ticker as (
  select * exclude (back) from (
    select *, row_number() over (partition by symbol order by event_time desc, event_id desc) as back
    from ticker
  ) where back = 1
)"""

_BASELINE = """
baseline as (
  select * from (
    select *,
           avg(atr_14) over (partition by symbol, interval order by candle_time, event_id
                             rows between 19 preceding and current row) as atr_rolling_avg_20,
           row_number() over (partition by symbol, interval order by candle_time desc, event_id desc) as back
    from mart
  ) where back = 1
)"""

_SNAPSHOT = f"""
snapshot as (
  select b.symbol, b.interval, b.candle_time as as_of_time, b.close as last_price,
         cast(t.price_change_pct_24h as double) as price_change_pct_24h_exchange,
{_PCT.replace("(close -", "(a.close -")},
         cast(t.volume_24h as double) as volume_24h, cast(t.quote_volume_24h as double) as quote_volume_24h,
         b.atr_14 / nullif(b.close, 0) * 100 as intraday_volatility,
         b.trend_regime,
         case when b.rsi_14 >= 60 then 'strengthening' when b.rsi_14 <= 40 then 'weakening' else 'neutral' end
           as momentum_regime,
         case when b.atr_14 > coalesce(b.atr_rolling_avg_20, b.atr_14) * 1.5 then 'extreme'
              when b.atr_14 > coalesce(b.atr_rolling_avg_20, b.atr_14) * 1.1 then 'elevated'
              else 'normal' end as volatility_regime,
         b.close >= b.rolling_high_20 as breakout_flag,
         b.close > b.ema_50 and b.close <= b.ema_20 as pullback_flag,
         (b.rolling_high_20 - b.close) / nullif(b.close, 0) * 100 as distance_to_resistance_pct,
         (b.close - b.rolling_low_20) / nullif(b.close, 0) * 100 as distance_to_support_pct,
         b.rsi_14, b.atr_14, b.volume_ma_20, b.sma_20, b.sma_50, b.ema_20, b.ema_50,
         cast(case b.trend_regime when 'bullish' then 40 when 'bearish' then 25 else 10 end
              + case when b.rsi_14 between 55 and 70 then 20 when b.rsi_14 between 45 and 55 then 10 else 5 end
              + case when b.close >= b.rolling_high_20 then 20 else 0 end
              + case when b.close > b.ema_50 and b.close <= b.ema_20 then 20 else 0 end as integer)
           as signal_strength_score
  from baseline b
  join previous a using (symbol, interval)
  join latest_ticker t using (symbol)
)"""

_PARTS = {
    "candles": (_CANDLES, ()),
    "ticker": (_TICKER, ("candles",)),
    "closed": (_CLOSED, ("candles",)),
    "ordered": (_ORDERED, ("closed",)),
    "ema": (_EMA, ("ordered",)),
    "strength": (_MOVES, ("ordered",)),
    "mart": (_MART, ("strength", "ema")),
    "fallen": (_FALLEN, ("closed",)),
    "asof": (_latest("closed"), ("closed",)),
    "tied": (_TIED + "," + _latest("tied"), ("closed",)),
    "latest_ticker": (_LATEST_TICKER, ("ticker",)),
    "baseline": (_BASELINE, ("mart",)),
    "snapshot": (_SNAPSHOT, ("baseline", "asof", "latest_ticker")),
}


def _statement(needs: tuple[str, ...], select: str, extra: str = "") -> str:
    """``select`` below the table definitions it needs, in dependency order."""
    chosen: list[str] = []

    def add(name: str) -> None:
        text, below = _PARTS[name]
        for part in below:
            add(part)
        if text not in chosen:
            chosen.append(text)

    for name in needs:
        add(name)
    if extra:
        chosen.append(extra)
    return "with recursive " + ",".join(chosen) + "\n" + select


_KLINE_COLUMNS = """event_id, source, symbol, interval, open_time, close_time,
  cast(open_price as double) as open_price, cast(high_price as double) as high_price,
  cast(low_price as double) as low_price, cast(close_price as double) as close_price,
  cast(volume as double) as volume, cast(quote_asset_volume as double) as quote_asset_volume,
  trade_count, is_closed, ingest_time"""

_TICKER_COLUMNS = """event_id, source, symbol, event_time, ingest_time,
  cast(last_price as double) as last_price, cast(price_change_24h as double) as price_change_24h,
  price_change_pct_24h, cast(volume_24h as double) as volume_24h,
  cast(quote_volume_24h as double) as quote_volume_24h, cast(open_price_24h as double) as open_price_24h,
  cast(high_price_24h as double) as high_price_24h, cast(low_price_24h as double) as low_price_24h,
  trade_count_24h"""


def _rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 8) as {name}" for name in names)


# --- events with defects -----------------------------------------------------------

_TICKER_SLOTS = """
slotted as (
  select *, ((epoch_us(event_time) // 1000 + 1) // 3600000) % 16 as slot from ticker
),
judged as (
  select * replace (case when slot = 15 then 0.000000000000000001 else cast(low_price_24h as decimal(37,18)) end as low_price_24h), case slot
      when 0 then 'Unexpected event_type ''trade''. Expected ''ticker''.'
      when 1 then 'Missing required ticker fields: symbol'
      when 2 then 'Missing required ticker fields: source, volume_24h'
      when 3 then 'Ticker payload contains negative values.'
      when 4 then 'Ticker high_price_24h is lower than low_price_24h.'
      when 5 then 'Ticker payload contains invalid typed values.'
      when 6 then 'Ticker payload contains invalid typed values.'
      when 7 then 'Ticker trade_count_24h must be zero or greater.'
      when 8 then 'Malformed JSON.'
      when 10 then 'Unexpected event_type ''none''. Expected ''ticker''.'
      when 11 then 'Unexpected event_type ''missing''. Expected ''ticker''.'
      when 12 then 'Ticker payload contains invalid typed values.'
      when 14 then 'Ticker payload contains invalid typed values.' end as reason
  from slotted where slot <> 9
)"""

_KLINE_SLOTS = """
slotted as (select *, (open_s // width) % 16 as slot from candles),
judged as (
  select * replace (slot not in (13, 14) as is_closed), case slot
      when 0 then 'Unexpected event_type ''ticker''. Expected ''kline''.'
      when 1 then 'Missing required kline fields: symbol'
      when 2 then 'Missing required kline fields: source, volume'
      when 3 then 'Kline payload contains negative values.'
      when 4 then 'Kline high_price is inconsistent with candle values.'
      when 5 then 'Kline payload contains invalid typed values.'
      when 6 then 'Kline payload contains invalid typed values.'
      when 7 then 'Kline trade_count must be zero or greater.'
      when 8 then 'Malformed JSON.'
      when 10 then 'Kline close_time is earlier than open_time.'
      when 11 then 'Kline low_price is inconsistent with candle values.'
      when 15 then 'Kline payload contains invalid typed values.' end as reason
  from slotted where slot <> 9
)"""


def _judged(columns: str) -> str:
    """All rows with their reason; the typed columns only where there is none."""
    named = [part.strip().rpartition(" as ")[2] for part in columns.split(",")]
    fields = ", ".join(f"case when reason is null then {name} end as {name}" for name in named)
    return f"select event_id as key, reason, {fields} from (select {columns}, reason from judged)"


_VERSIONS = """
versions as (
  select c.* replace (close_price + (v - 1) as close_price), v,
         case when turn <> 3 then '2024-02-0' || v || 'T00:00:00.000000#0000000000' end as version,
         cast(case turn when 0 then v when 2 then 3 - v else 1 end as bigint) as batch_id,
         cast(case turn when 1 then 10 - v when 3 then v else 0 end as bigint) as log_position
  from (select *, (open_s // width) % 4 as turn from candles) c, (values (1), (2)) as numbers(v)
  where v = 1 or close_price > open_price
)"""

_BAD_TICKER = """
bad_ticker as (
  select * replace (
    case when hour(event_time) <> 1 then event_id end as event_id,
    case hour(event_time) when 2 then null when 3 then '  ' else symbol end as symbol,
    case hour(event_time) when 4 then null when 5 then 0 else last_price end as last_price,
    case when hour(event_time) <> 6 then ingest_time end as ingest_time,
    case when hour(event_time) = 7 then -volume_24h - 1 else volume_24h end as volume_24h,
    case when hour(event_time) = 8 then -1 else trade_count_24h end as trade_count_24h,
    case when hour(event_time) = 9 then low_price_24h - 1 else high_price_24h end as high_price_24h)
  from ticker
)"""

_BAD_KLINE = """
bad_kline as (
  select * replace (
    case when hour(open_time) <> 1 then event_id end as event_id,
    case when hour(open_time) <> 2 then symbol end as symbol,
    case hour(open_time) when 3 then null when 4 then '2m' else interval end as interval,
    case when hour(open_time) <> 5 then open_time end as open_time,
    case when hour(open_time) <> 6 then close_price end as close_price)
  from versions
)"""

_BAD_MART = """
bad_mart as (
  select * replace (
    case when hour(candle_time) = 4 then '2m' else interval end as interval,
    case hour(candle_time) when 5 then 'sideways' when 6 then null else trend_regime end as trend_regime)
  from mart
)"""

_TICKER_BREAKS = (
    "trim(symbol) = '' or last_price <= 0 or volume_24h < 0 or quote_volume_24h < 0 "
    "or trade_count_24h < 0 or high_price_24h < low_price_24h"
)
_CANDLE_BREAKS = (
    "open <= 0 or high <= 0 or low <= 0 or close <= 0 or high < low or volume < 0 "
    "or quote_asset_volume < 0 or rsi_14 < 0 or rsi_14 > 100 or atr_14 < 0"
)

_PARTS |= {
    "judged_ticker": (_TICKER_SLOTS, ("ticker",)),
    "judged_kline": (_KLINE_SLOTS, ("candles",)),
    "versions": (_VERSIONS, ("candles",)),
    "bad_ticker": (_BAD_TICKER, ("ticker",)),
    "bad_kline": (_BAD_KLINE, ("versions",)),
    "bad_mart": (_BAD_MART, ("mart",)),
}

_CHECKED_COLUMNS = {
    "raw_ticker": ("bad_ticker", ("event_id", "symbol", "event_time", "last_price")),
    "raw_kline": ("bad_kline", ("event_id", "symbol", "interval", "open_time", "close_price")),
    "stg_ticker": ("bad_ticker", ("event_id", "symbol", "last_price", "ingest_time")),
    "stg_klines": ("bad_kline", ("event_id", "symbol", "interval", "open_time", "close_price")),
    "ohlcv": ("bad_mart", ("event_id", "symbol", "interval", "candle_time", "close", "trend_regime")),
    "snapshot": ("snapshot", ("symbol", "interval", "as_of_time", "last_price",
                              "trend_regime", "momentum_regime", "volatility_regime")),
}
_LABELS = (
    ("ohlcv", "bad_mart", "interval", "'1m','5m','15m','1h','4h','1d','1w'"),
    ("ohlcv", "bad_mart", "trend_regime", "'bullish','bearish','ranging'"),
    ("snapshot", "snapshot", "trend_regime", "'bullish','bearish','ranging'"),
    ("snapshot", "snapshot", "momentum_regime", "'strengthening','weakening','neutral'"),
    ("snapshot", "snapshot", "volatility_regime", "'extreme','elevated','normal'"),
)


def _check(table: str, check: str, column: str, source: str, test: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"count(*) as failing_rows from {source} where {test}"
    )


def _not_null_checks(tables: tuple[str, ...]) -> list[str]:
    return [
        _check(table, "not_null", column, _CHECKED_COLUMNS[table][0], f"{column} is null")
        for table in tables
        for column in _CHECKED_COLUMNS[table][1]
    ]


def _unique_checks(tables: tuple[str, ...]) -> list[str]:
    return [
        _check(
            table, "unique", "event_id",
            f"(select event_id from {_CHECKED_COLUMNS[table][0]} where event_id is not null "
            "group by event_id having count(*) > 1)", "true",
        )
        for table in tables
    ]


def _label_checks() -> list[str]:
    return [
        _check(table, "accepted_values", column, source, f"{column} not in ({values})")
        for table, source, column, values in _LABELS
    ]


def _results(checks: list[str]) -> str:
    return (
        "select *, case when failing_rows > 0 then 'error' else 'pass' end as status from ("
        + " union all ".join(checks)
        + ")"
    )


_AGES = """
    select 'raw_ticker' as table_name, max(ingest_time) as newest from {ticker}
    union all select 'raw_kline', max(ingest_time) from {kline}"""


def _freshness(ticker: str, kline: str) -> str:
    ages = _AGES.format(ticker=ticker, kline=kline)
    return f"""
    select *, case when age_seconds > 86400 then 'error' when age_seconds > 1800 then 'warn' else 'pass' end as status
    from (select *, epoch_us(timestamp '2024-01-31 00:10:00') // 1000000 - epoch_us(newest) // 1000000 as age_seconds
          from ({ages}))"""


_LOCAL = "({} at time zone 'UTC') at time zone 'Asia/Ho_Chi_Minh'"
_RECENT = "where interval = '5m' order by candle_time desc, event_id desc limit"
_FIRST = "(select {} from mart where interval = '5m' order by candle_time, event_id limit 1)"


def statements() -> dict[str, str]:
    return {
        "stg_klines": _statement(("candles",), f"select {_KLINE_COLUMNS} from candles"),
        "stg_ticker": _statement(("ticker",), f"select {_TICKER_COLUMNS} from ticker"),
        "closed_candles": _statement(("closed",), f"select {_KLINE_COLUMNS} from closed"),
        "rolling_averages": _statement(
            ("ordered",),
            "select event_id, row_num, cast(previous_close as double) as previous_close, "
            + _rounded("sma_20", "sma_50", "volume_ma_20") + " from ordered",
        ),
        "rolling_extremes": _statement(
            ("ordered",),
            "select event_id, cast(rolling_high_20 as double) as rolling_high_20, "
            "cast(rolling_low_20 as double) as rolling_low_20 from ordered",
        ),
        "ema": _statement(
            ("ema",),
            "select o.event_id, round(e.ema_20, 8) as ema_20, round(e.ema_50, 8) as ema_50 "
            "from ordered o join ema e using (symbol, interval, row_num)",
        ),
        "true_range_atr": _statement(
            ("strength",),
            "select event_id, cast(true_range as double) as true_range, " + _rounded("atr_14") + " from strength",
        ),
        "rsi": _statement(
            ("strength",),
            "select event_id, cast(gain as double) as gain, cast(loss as double) as loss, "
            + _rounded("avg_gain_14", "avg_loss_14", "rsi_14") + " from strength",
        ),
        "candle_range": _statement(
            ("strength",), "select event_id, " + _rounded("candle_range_pct") + " from strength"
        ),
        "ohlcv_indicators": _statement(
            ("mart",),
            "select * replace (" + _rounded(
                "sma_20", "sma_50", "ema_20", "ema_50", "volume_ma_20", "rsi_14", "atr_14", "candle_range_pct"
            ) + ") from mart",
        ),
        "ema_after_fall": _statement(
            ("fallen",),
            "select event_id, " + ", ".join(f"case when e{n} > 0 then round(ln(e{n}), 8) end as ln_ema_{n}" for n in (20, 50))
            + " from fallen_ema",
        ),
        "asof_returns": _statement(
            ("tied",), f"select symbol, interval, as_of_time, close as last_price,\n{_PCT}\nfrom previous"
        ),
        "latest_ticker": _statement(("latest_ticker",), f"select {_TICKER_COLUMNS} from latest_ticker"),
        "atr_baseline": _statement(
            ("baseline",),
            "select symbol, interval, candle_time as as_of_time, "
            + _rounded("atr_14", "atr_rolling_avg_20")
            + ", round(atr_14 / nullif(close, 0) * 100, 8) as intraday_volatility, "
            "case when atr_14 > coalesce(atr_rolling_avg_20, atr_14) * 1.5 then 'extreme' "
            "when atr_14 > coalesce(atr_rolling_avg_20, atr_14) * 1.1 then 'elevated' else 'normal' end "
            "as volatility_regime from baseline",
        ),
        "market_snapshot": _statement(
            ("snapshot",),
            "select * replace (" + _rounded(
                "intraday_volatility", "distance_to_resistance_pct", "distance_to_support_pct",
                "rsi_14", "atr_14", "volume_ma_20", "sma_20", "sma_50", "ema_20", "ema_50",
            ) + ") from snapshot",
        ),
        "normalize_ticker": _statement(
            ("ticker",),
            "select event_id, 'ticker' as event_type, source, symbol, event_time, "
            "timestamp '2024-02-01 00:00:00' as ingest_time, "
            + _TICKER_COLUMNS.split("ingest_time,")[1] + " from ticker",
        ),
        "normalize_klines": _statement(
            ("candles",),
            "select 'kline' as event_type, close_time as event_time, "
            + _KLINE_COLUMNS.replace("ingest_time", "timestamp '2024-02-01 00:00:00' as ingest_time")
            + " from candles",
        ),
        "validate_ticker": _statement(("judged_ticker",), _judged(_TICKER_COLUMNS)),
        "validate_kline": _statement(("judged_kline",), _judged(_KLINE_COLUMNS)),
        "dead_letter": _statement(
            ("candles", "ticker"),
            "select 'ticker' as event_type, event_id as key, reason from judged_t where reason is not null "
            "union all select 'kline', event_id, reason from judged_k where reason is not null",
            _TICKER_SLOTS.replace("slotted", "slotted_t").replace("judged", "judged_t") + ","
            + _KLINE_SLOTS.replace("slotted", "slotted_k").replace("judged", "judged_k"),
        ),
        "upsert_latest": _statement(
            ("versions",),
            f"select {_KLINE_COLUMNS}, version, batch_id, log_position from versions "
            "qualify v = max(v) over (partition by event_id)",
        ),
        "landed_refetch": _statement(
            ("candles",),
            "select " + _KLINE_COLUMNS.replace("ingest_time", "timestamp '2024-02-02 00:00:00' as ingest_time")
            + ", '2024-02-02T00:00:00.000000#' || lpad(cast(2 * row_number() over (partition by symbol, interval, response "
            "order by open_s) - 1 as varchar), 10, '0') as version "
            "from (select *, open_s // (width * 500) as response from candles)",
        ),
        "normalize_rejects": _statement(
            ("candles", "ticker"),
            "select event_type, reason, count(*) as n, count(*) as n_payloads from spoiled where reason is not null group by all",
            """
spoiled as (
  select 'ticker' as event_type, case ((epoch_us(event_time) // 1000 + 1) // 3600000) % 8
      when 0 then 'Missing required field: symbol.' when 1 then 'Invalid timestamp field: closeTime.'
      when 2 then 'Invalid decimal field: lastPrice.' when 3 then 'Invalid integer field: count.'
      when 4 then 'Malformed JSON.' when 5 then 'Missing required field: symbol.' end as reason
  from ticker
  union all
  select 'kline', case (open_s // width) % 8 when 0 then 'Invalid kline payload shape.' when 1 then 'Invalid kline payload shape.'
      when 2 then 'Invalid timestamp field: open_time.' when 3 then 'Invalid decimal field: open_price.' end
  from candles where interval <> '1w'
  union all
  select distinct on (symbol, open_s // (width * 500)) 'kline', 'Kline response is not a list.' from candles where interval = '1w'
)""",
        ),
        "panel_snapshot": _statement(
            ("snapshot",),
            f"select symbol, {_LOCAL.format('as_of_time')} as as_of_time, interval, last_price, "
            "price_change_pct_5m, price_change_pct_15m, price_change_pct_1h, price_change_pct_4h, "
            "price_change_pct_24h, price_change_pct_1w, volume_24h, "
            "round(intraday_volatility, 8) as intraday_volatility, trend_regime, momentum_regime, "
            "volatility_regime, signal_strength_score, breakout_flag, pullback_flag "
            "from snapshot where interval = '5m'",
        ),
        "panel_trend_vs_ema": _statement(
            ("mart",),
            f"select {_LOCAL.format('candle_time')} as candle_time, "
            f"round((close / nullif({_FIRST.format('close')}, 0) - 1) * 100, 4) as close_change_pct, "
            f"round((ema_20 / nullif({_FIRST.format('ema_20')}, 0) - 1) * 100, 4) as ema_change_pct "
            f"from (select * from mart {_RECENT} 120)",
        ),
        "panel_rsi_bands": _statement(
            ("mart",),
            f"select {_LOCAL.format('candle_time')} as candle_time, round(rsi_14, 8) as rsi_14, "
            "cast(30 as double) as oversold_band, cast(70 as double) as overbought_band "
            f"from (select * from mart {_RECENT} 120)",
        ),
        "panel_ema_distance": _statement(
            ("mart",),
            f"select {_LOCAL.format('candle_time')} as candle_time, "
            "round((close - ema_20) / nullif(ema_20, 0) * 100, 4) as distance_to_ema_pct, "
            "round(candle_range_pct, 4) as candle_range_pct "
            f"from (select * from mart {_RECENT} 120)",
        ),
        "panel_volume_spike": _statement(
            ("mart",),
            f"select {_LOCAL.format('candle_time')} as candle_time, "
            "round(volume / nullif(volume_ma_20, 0), 4) as volume_spike_ratio, "
            f"cast(1 as double) as baseline_ratio from (select * from mart {_RECENT} 48)",
        ),
        "panel_returns_long": _statement(
            ("snapshot",),
            " union all ".join(
                f"select '{label}' as timeframe, price_change_pct_{name} as return_pct from snapshot"
                for label, name in (
                    ("5m", "5m"), ("15m", "15m"), ("1h", "1h"), ("4h", "4h"), ("1d", "24h"), ("1w", "1w")
                )
            ),
        ),
        "dq_not_null": _statement(
            ("bad_ticker", "bad_kline", "bad_mart"),
            _results(_not_null_checks(("raw_ticker", "raw_kline", "stg_ticker", "stg_klines", "ohlcv"))),
        ),
        "dq_unique": _statement(
            ("bad_ticker", "bad_kline"),
            _results(_unique_checks(("raw_ticker", "raw_kline", "stg_ticker", "stg_klines"))),
        ),
        "dq_accepted_values": _statement(("bad_mart", "snapshot"), _results(_label_checks())),
        "dq_freshness": _statement(("ticker",), _freshness("ticker", "candles")),
        "dq_ticker_assert": _statement(
            ("bad_ticker",), f"select {_TICKER_COLUMNS} from bad_ticker where {_TICKER_BREAKS}"
        ),
        "dq_kline_assert": _statement(
            ("mart",),
            "select * replace (" + _rounded(
                "sma_20", "sma_50", "ema_20", "ema_50", "volume_ma_20", "rsi_14", "atr_14", "candle_range_pct"
            ) + f") from worse where {_CANDLE_BREAKS}",
            """
worse as (
  select * replace (
    case when hour(candle_time) = 7 then 0 else high end as high,
    case when hour(candle_time) = 8 then rsi_14 + 100 else rsi_14 end as rsi_14,
    case when hour(candle_time) = 9 then -1 else atr_14 end as atr_14,
    case when hour(candle_time) = 10 then -volume else volume end as volume)
  from mart
)""",
        ),
        "dq_panels_nonempty": _statement(
            ("mart",),
            "select name as table_name, 'nonempty' as check_name, '*' as column_name, "
            "cast(case when found then 0 else 1 end as bigint) as failing_rows, "
            "case when found then 'pass' else 'error' end as status "
            "from (select unnest(['panel_snapshot', 'panel_trend_vs_ema', 'panel_rsi_bands']) as name, "
            "(select count(*) > 0 from mart where interval = '5m') as found)",
        ),
        "dq_suite": _statement(
            ("bad_ticker", "bad_kline", "bad_mart", "snapshot"),
            _results(
                _not_null_checks(tuple(_CHECKED_COLUMNS))
                + _label_checks()
                + _unique_checks(("raw_ticker", "raw_kline", "stg_ticker", "stg_klines", "ohlcv"))
                + [
                    _check("raw_ticker", "assertion", "ticker_values", "bad_ticker", _TICKER_BREAKS),
                    _check("ohlcv", "assertion", "candle_values", "bad_mart", _CANDLE_BREAKS),
                ]
            )
            + " union all select table_name, 'freshness', 'ingest_time', "
            "cast(case when status = 'pass' then 0 else 1 end as bigint), status "
            f"from ({_freshness('bad_ticker', 'bad_kline')})",
        ),
    }
