"""Technical indicators over candle series.

Every operator takes closed candles (``KLINE`` columns) and adds columns. A
row's value uses all rows it has: early rows average over a partial frame.

Rolling averages are exact: decimal sums that start anew once a segment, so that a
frame is the end of one segment and the beginning of the next; one conversion to
double and one division by the row count. The cost per row does not depend on the
frame length, and no sum holds more than one segment.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from candlewick.functions.columns import add, pct_of
from candlewick.operators.blocks import OrderedBlocks
from candlewick.schemas import AMOUNT_SQL, INTERVAL_SECONDS_SQL

SERIES = ("symbol", "interval")

# name: (column, rows)
PRICE_AVERAGES = {
    "sma_20": ("close_price", 20),
    "sma_50": ("close_price", 50),
    "volume_ma_20": ("volume", 20),
}
MOVEMENT_AVERAGES = {
    "atr_14": ("true_range", 14),
    "avg_gain_14": ("gain", 14),
    "avg_loss_14": ("loss", 14),
}

# --- row-wise metrics --------------------------------------------------------------

_BASE_CLOSE = "coalesce(previous_close, close_price)"
_NOTHING = f"cast(0 as {AMOUNT_SQL})"

TRUE_RANGE = (
    f"greatest(high_price - low_price, abs(high_price - {_BASE_CLOSE}), abs(low_price - {_BASE_CLOSE}))"
)
GAIN = f"greatest(close_price - {_BASE_CLOSE}, {_NOTHING})"
LOSS = f"greatest({_BASE_CLOSE} - close_price, {_NOTHING})"
CANDLE_RANGE_PCT = pct_of("(high_price - low_price)", "open_price")
# Of the totals: they are exact, and so the level is where their ratio is plain.
RSI_14 = """
    case when _total_avg_loss_14 = 0 and _total_avg_gain_14 > 0 then 100d
         when _total_avg_loss_14 = 0 then 50d
         else 100d - 100d / (1d + _total_avg_gain_14 / nullif(_total_avg_loss_14, 0d)) end"""
# ``_close_side`` is the side of ``sma_20`` the close is on.
TREND_REGIME = """
    case when ema_20 > ema_50 and _close_side > 0 then 'bullish'
         when ema_20 < ema_50 and _close_side < 0 then 'bearish'
         else 'ranging' end"""


def candle_range(candles: DataFrame) -> DataFrame:
    """Height of each candle in percent of its open; null for a zero open."""
    return add(candles, {"candle_range_pct": CANDLE_RANGE_PCT})


# --- windows -----------------------------------------------------------------------
# Functions named *_columns give the expressions of one step over a block; steps
# that do not depend on each other are added together and share a window.


def candle_blocks(
    candles: DataFrame, halo_rows: int, loose: Sequence[str], **layout
) -> OrderedBlocks:
    return OrderedBlocks.cut(
        candles, SERIES, "close_time", "event_id", INTERVAL_SECONDS_SQL, halo_rows, loose, **layout
    )


def position_columns(blocks: OrderedBlocks) -> dict[str, str]:
    return {"row_num": blocks.row_num(), "previous_close": f"lag(close_price) {blocks.over()}"}


# Frame of the rows of a block ahead of the current one.
EARLIER = "rows between unbounded preceding and 1 preceding"


def extreme_columns(blocks: OrderedBlocks, size: int = 20) -> dict[str, str]:
    frame = blocks.over(f"rows between {size - 1} preceding and current row")
    return {
        f"rolling_high_{size}": f"max(high_price) {frame}",
        f"rolling_low_{size}": f"min(low_price) {frame}",
    }


def movement_columns() -> dict[str, str]:
    """True range, gain and loss; the first row of a series moves by nothing."""
    return {
        "true_range": f"cast({TRUE_RANGE} as {AMOUNT_SQL})",
        "gain": f"cast({GAIN} as {AMOUNT_SQL})",
        "loss": f"cast({LOSS} as {AMOUNT_SQL})",
    }


def with_averages(
    blocks: OrderedBlocks,
    averages: Mapping[str, tuple[str, int]],
    rows: int,
    sides: Mapping[str, str] | None = None,
) -> OrderedBlocks:
    """Add ``name: average of column over the last n rows`` for ``name: (column, n)``,
    and the sum behind it in double as ``_total_<name>``.

    ``sides`` adds ``name: 1, 0 or -1`` as the column is above, equal to or below
    the given average. It compares exactly, which the rounded average cannot: in
    double, twenty times 0.07 divided by twenty is less than 0.07.
    Needs ``row_num``, segments of ``rows`` rows, n at least, and a halo of n - 1 rows or
    more. Packs the columns.
    """
    columns = sorted({column for column, _ in averages.values()})
    sizes = sorted({size for _, size in averages.values()})
    if sizes[-1] > rows:
        raise ValueError("A frame cannot be longer than a segment.")
    in_segment = blocks.so_far(["_span", "_segment"])
    running = {f"_run_{c}": f"cast(sum({c}) {in_segment} as {AMOUNT_SQL})" for c in columns}
    blocks = blocks.add(running).pack(columns)
    sums = {
        f"_sums_{size}": "struct("
        + ", ".join(f"_run_{c}" for c in columns if (c, size) in averages.values())
        + ")"
        for size in sizes
    }
    whole = f"if(_k = {rows - 1}, struct({', '.join(running)}), null)"
    blocks = blocks.add({**sums, "_ended": whole}).drop(list(running))
    before = {f"_before_{n}": f"lag(_sums_{n}, {n}) {blocks.over()}" for n in sizes}
    last = {"_last": f"last(_ended, true) {blocks.over(EARLIER)}"}
    totals = {name: _frame_total(f"_run_{c}", n) for name, (c, n) in averages.items()}
    sums_in_double = {f"_total_{name}": f"cast({total} as double)" for name, total in totals.items()}
    means = {
        name: f"_total_{name} / least(row_num, {n})" for name, (_, n) in averages.items()
    }
    places = {
        side: _side(f"{blocks.packs[-1]}.{averages[name][0]}", totals[name], averages[name][1])
        for side, name in (sides or {}).items()
    }
    blocks = blocks.add({**before, **last}).add({**sums_in_double, **places})
    return blocks.add(means).drop([*sums, *before, "_ended", "_last"])


def _frame_total(run: str, n: int) -> str:
    """The sum of the last n rows: of this segment alone, or with the end of the one before."""
    ahead = f"cast(_last.{run} - _before_{n}.{run} as {AMOUNT_SQL})"
    return (
        f"if(_k >= {n}, _sums_{n}.{run} - _before_{n}.{run}, "
        f"_sums_{n}.{run} + coalesce({ahead}, {_NOTHING}))"
    )


def _side(value: str, total: str, size: int) -> str:
    """Sign of ``value * rows - total``; the product of a narrower decimal is exact."""
    product = f"try_cast({value} as decimal(35,18)) * cast(least(row_num, {size}) as decimal(2,0))"
    rounded = f"cast({value} as double) * least(row_num, {size}) - cast({total} as double)"
    return (
        f"case when {product} > {total} then 1 when {product} < {total} then -1"
        f" when {product} = {total} then 0 else cast(sign({rounded}) as int) end"
    )


def rolling_averages(candles: DataFrame, **layout) -> DataFrame:
    """Row number, previous close, 20- and 50-row close averages, 20-row volume average."""
    rows = _longest(PRICE_AVERAGES)
    blocks = candle_blocks(candles, rows, ["close_price", "volume"], **layout)
    blocks = blocks.add(position_columns(blocks)).segmented(rows, 1)
    return with_averages(blocks, PRICE_AVERAGES, rows).owned()


def _longest(averages: Mapping[str, tuple[str, int]]) -> int:
    return max(size for _, size in averages.values())


def rolling_extremes(candles: DataFrame, size: int = 20, **layout) -> DataFrame:
    blocks = candle_blocks(candles, size, ["high_price", "low_price"], **layout)
    return blocks.add(extreme_columns(blocks, size)).owned()


def _movement_averages(candles: DataFrame, names: Sequence[str], layout: dict) -> OrderedBlocks:
    # One halo row more than the frame, for the previous close of its first row.
    wanted = {name: MOVEMENT_AVERAGES[name] for name in names}
    rows = _longest(wanted)
    blocks = candle_blocks(candles, rows + 2, ["close_price", "high_price", "low_price"], **layout)
    blocks = blocks.add(position_columns(blocks)).segmented(rows, 1).add(movement_columns())
    return with_averages(blocks, wanted, rows)


def true_range_atr(candles: DataFrame, **layout) -> DataFrame:
    return _movement_averages(candles, ["atr_14"], layout).owned()


def relative_strength(candles: DataFrame, **layout) -> DataFrame:
    blocks = _movement_averages(candles, ["avg_gain_14", "avg_loss_14"], layout)
    return blocks.add({"rsi_14": RSI_14}).owned()


# --- exponential averages ----------------------------------------------------------


# The digits of an amount and those of a double: a value this much smaller than another adds nothing to it.
RESOLVED = 1e-54


def _decay(span: int) -> float:
    if span < 2:
        raise ValueError("An exponential average needs a span of at least 2.")
    return (span - 1) / (span + 1)


def memory_rows(span: int) -> int:
    """Rows after which the weight of older values falls below ``RESOLVED``."""
    return math.ceil(math.log(RESOLVED) / math.log(_decay(span)))


def ema_segment(spans: Sequence[int]) -> tuple[int, int]:
    """Rows of a segment, over which weights stay within a factor of 150, and segments of a span, which covers the memory."""
    fastest = -math.log(_decay(min(spans)))
    rows = max(1, int(math.log(150) / fastest))
    segments = math.ceil(memory_rows(max(spans)) / rows)
    if rows * segments * fastest > 600:  # weights of a span are doubles
        raise ValueError("Spans this far apart need separate calls.")
    return rows, segments


def ema_halo(spans: Sequence[int]) -> int:
    return memory_rows(max(spans)) + 1


def with_ema(blocks: OrderedBlocks, spans: Mapping[str, int]) -> OrderedBlocks:
    """Add ``name: exponential average`` of ``_value``, a double, for each ``name: span``.

    The recursion ``e = a*x + d*e'`` with ``d = (span-1)/(span+1)`` and ``a = 1 - d``, seeded with the first
    value, takes a value ``e'`` ahead of n rows to ``d^n * e' + (what the rows add)``. Such steps are composed in two
    levels. Within a segment of few rows, what they add is a running window sum of ``x * d^-k``, scaled back by
    ``d^k``; within a span of segments the same is done with the segments' ends. What came before a span
    enters through the end of the span before it, as a span outlasts the memory.

    Every segment is taken relative to its own first value, its centre. So a constant series stays exactly
    constant, and after a large fall the small values are not differences of large ones: the result keeps
    the relative precision of the recursion. What weighs less than ``RESOLVED`` counts as nothing.
    Needs the segments of ``ema_segment`` and a halo of ``ema_halo`` rows.
    """
    rows, segments = ema_segment(list(spans.values()))
    decay = {name: repr(_decay(span)) + "d" for name, span in spans.items()}
    weight = {name: repr(2 / (span + 1)) + "d" for name, span in spans.items()}
    span_so_far, span_earlier = blocks.so_far(["_span"]), blocks.over(EARLIER, ["_span"])

    blocks = blocks.add({"_centre": f"first(_value) {blocks.so_far(['_span', '_segment'])}"})
    in_segment = blocks.so_far(["_span", "_segment"])
    added = {
        f"_added_{name}": f"sum((_value - _centre) * {weight[name]} * pow({d}, -_k)) {in_segment}"
        for name, d in decay.items()
    }
    centres = {
        "_centre_before": f"lag(_centre, {rows}) {blocks.over(within=['_span'])}",
        "_first": f"first(_value) {span_so_far}",
    }
    local = {f"_local_{name}": f"_added_{name} * pow({d}, _k)" for name, d in decay.items()}
    # What a segment adds to the distance of the average from its centre; weighed for the sum over a span.
    steps = {
        f"_step_{name}": f"if(_k = {rows - 1}, (_local_{name} + coalesce(pow({d}, {rows}) * (_centre_before - _centre), 0d))"
        f" * pow({d}, -{rows} * _t), 0d)"
        for name, d in decay.items()
    }
    past = {f"_past_{name}": f"sum(_step_{name}) {span_earlier}" for name in spans}
    own = {
        f"_own_{name}": f"_centre + _local_{name} + if(_t = 0, 0d, pow({d}, _k + 1)"
        f" * (_centre_before + _past_{name} * pow({d}, {rows} * (_t - 1)) - _centre))"
        for name, d in decay.items()
    }
    carry = {
        f"_carry_{name}": f"last(if(_k = {rows - 1} and _t = {segments - 1}, _own_{name}, null), true) {blocks.over(EARLIER)}"
        for name in spans
    }
    total = {
        name: f"_own_{name} + coalesce(pow({d}, {rows} * _t + _k + 1) * (_carry_{name} - _first), 0d)"
        for name, d in decay.items()
    }
    blocks = blocks.add({**added, **centres}).add(local).add(steps).add(past)
    return blocks.add(own).add(carry).add(total)


def ema(candles: DataFrame, spans: Sequence[int] = (20, 50), **layout) -> DataFrame:
    """Candles with ``ema_<span>`` of the close for each span."""
    blocks = candle_blocks(candles, ema_halo(spans), ["close_price"], **layout)
    blocks = blocks.add({"_value": "cast(close_price as double)"}).pack(["close_price"])
    blocks = blocks.segmented(*ema_segment(spans))
    return with_ema(blocks, {f"ema_{span}": span for span in spans}).owned()
