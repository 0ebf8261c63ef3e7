"""Ordered blocks: row windows over a long series without one task per series.

``partition by keys order by time`` sends a whole series to one task, which
fails once a single key holds a large share of the rows. All windows of this
engine look back a bounded number of rows (exactly, or to the limit of double
precision for exponential averages), so a series can be cut into blocks:

1. Count the rows per (keys, time cell). Partial aggregation makes this a
   narrow scan plus a shuffle of the counts only.
2. Turn the counts into the position of each cell in its series, with a prefix
   sum in two levels, so no window there spans a series cell by cell.
3. Attach the positions to the rows. A cell goes to the block its position
   falls in and, where it holds some of the last ``halo_rows`` rows ahead of a
   later block that owns rows, to that block as well.
4. Run the windows per (keys, block) and keep the rows a block owns.

The positions are counts, not times, so gaps in a series do not matter.

A job can store the positions ahead of the join (``stage``): Spark then knows
their size when it plans, broadcasts them if they are small enough and spares
the rows the shuffle of step 3. It can then also see whether a cell has more rows than a block, as
many rows at one time make it. Such cells are split by (time, tie): a sample of their keys
gives the boundaries, a count of the rows between them the positions. Without stored positions such a cell makes
its block as large as it is, and goes to at most two others.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.columns import add

# Stores a small derived table under a name and returns the stored table.
Stage = Callable[[DataFrame, str], DataFrame]

CELL_ROWS = 512
SUPER_CELLS = 4096
BLOCK_ROWS = 16384


def cell_positions(cells: DataFrame, keys: Sequence[str], super_cells: int) -> DataFrame:
    """Per (keys, _cell): its row count ``_n`` and ``_ahead``, the rows of the series before it."""
    names = ", ".join(keys)
    counts = cells.groupBy(*keys, "_cell").count()
    counts = counts.selectExpr(*keys, "_cell", "count as _n", f"coalesce(floor(_cell / {super_cells}), 0L) as _super")
    totals = counts.groupBy(*keys, "_super").sum("_n").selectExpr(
        *keys,
        "_super",
        f"sum(`sum(_n)`) over (partition by {names} order by _super) - `sum(_n)` as _before",
    )
    inside = f"sum(_n) over (partition by {names}, _super order by _cell) - _n"
    return (
        counts.selectExpr("*", f"{inside} as _inside")
        .join(totals, [*keys, "_super"])
        .selectExpr(*keys, "_cell", "_n", "_before + _inside as _ahead")
    )


# Boundaries of a split cell at most, and keys sampled for each.
MOST_SPLITS = 4095
SAMPLED = 8


def split_cells(
    celled: DataFrame, positions: DataFrame, keys: Sequence[str], time: str, tie: str, block_rows: int, stage: Stage
) -> tuple[DataFrame, DataFrame]:
    """Rows and positions by (keys, _cell, _sub): cells with more rows than a block are cut into parts of about a quarter block.

    A cell of so many rows that it takes more than ``MOST_SPLITS`` boundaries has larger parts. Rows equal in time
    and tie stay together.
    """
    names = [*keys, "_cell"]
    large = stage(positions.filter(f"_n > {block_rows}"), "large_cells")
    inside = celled.select(*names, time, tie).join(large, names)
    wanted = f"least({MOST_SPLITS}, ceil(4 * _n / {block_rows}))"
    every = f"greatest(1, floor(_n / ({SAMPLED} * {wanted})))"
    sample = inside.filter(f"pmod(xxhash64({time}, {tie}), {every}) = 0").selectExpr(*names, f"struct({time}, {tie}) as _key", "_n")
    listed = sample.groupBy(*names).agg(F.expr("array_sort(collect_set(_key))").alias("_keys"), F.first("_n").alias("_n"))
    # Evenly spaced keys of the sample.
    spaced = f"transform(sequence(1, least({wanted}, size(_keys))), i -> _keys[cast(floor((i - 1) * size(_keys) / least({wanted}, size(_keys))) as int)])"
    splits = stage(listed.selectExpr(*names, f"{spaced} as _splits"), "splits")

    steps = ", ".join(str(1 << bit) for bit in reversed(range(MOST_SPLITS.bit_length())))
    number = (
        f"aggregate(array({steps}), 0, (at, step) -> if(at + step <= size(_splits)"
        f" and get(_splits, at + step - 1) <= struct({time}, {tie}), at + step, at))"
    )
    sub = f"if(_splits is null, 0, {number}) as _sub"
    parts = inside.drop("_n", "_ahead").join(splits, names).selectExpr(*names, sub).groupBy(*names, "_sub").count()
    before = f"sum(count) over (partition by {', '.join(names)} order by _sub) - count"
    placed = parts.join(large, names).selectExpr(*names, "_sub", "count as _n", f"_ahead + {before} as _ahead")
    whole = positions.filter(f"_n <= {block_rows}").selectExpr(*names, "0 as _sub", "_n", "_ahead")
    rows = celled.join(splits, names, "left").selectExpr("* except (_splits)", sub)
    return rows, stage(whole.unionByName(placed), "split_positions")


class OrderedBlocks:
    """Rows of many series, cut into overlapping ordered blocks.

    ``rows`` carries ``_block``, ``_owned`` and ``_ahead``. Columns the windows do
    not touch travel packed in a struct, which a window copies as it is; loose
    wide decimals would be decoded and encoded again by every window.
    """

    def __init__(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        columns: Sequence[str],
        packs: Sequence[str] = (),
    ):
        self.rows = rows
        self.keys = list(keys)
        self.order = list(order)
        self.columns = list(columns)
        self.packs = list(packs)

    @classmethod
    def cut(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        time: str,
        tie: str,
        step_seconds: str,
        halo_rows: int,
        loose: Sequence[str] = (),
        block_rows: int = BLOCK_ROWS,
        cell_rows: int = CELL_ROWS,
        super_cells: int = SUPER_CELLS,
        stage: Stage | None = None,
    ) -> "OrderedBlocks":
        """Cut ``df`` by ``time``; ``step_seconds`` is the usual distance of two rows.

        The windows may use the keys, ``time``, ``tie`` and the ``loose`` columns.
        """
        # Never null, so that joins on it infer no filters: both uses of the
        # counts then stay the same plan, and Spark runs it once.
        cell = f"coalesce(floor(unix_micros({time}) / ({step_seconds} * {cell_rows * 1_000_000}L)), 0L)"
        celled = add(df, {"_cell": cell})
        positions = cell_positions(celled.select(*keys, "_cell"), keys, super_cells)
        names = [*keys, "_cell"]
        if stage is not None:
            positions = stage(positions, "positions")
            if not positions.filter(f"_n > {block_rows}").isEmpty():
                celled, positions = split_cells(celled, positions, keys, time, tie, block_rows, stage)
                names = [*names, "_sub"]
        # The block of the cell, and those that begin within the halo behind it. Blocks between own no rows.
        home, behind = f"floor(_ahead / {block_rows})", f"floor((_ahead + _n) / {block_rows})"
        last = f"floor((_ahead + _n + {halo_rows - 1}L) / {block_rows})"
        later = f"if({last} > {home}, sequence(greatest({home} + 1, {behind}), {last}), array())"
        positions = positions.selectExpr(*names, "_ahead", f"concat(array({home}), {later}) as _blocks")
        rows = celled.join(positions, names).selectExpr(
            f"* except ({', '.join(names[len(keys):])}, _blocks)", "_blocks[0] as _home", "explode(_blocks) as _block"
        )
        rows = rows.selectExpr("* except (_home)", "_block = _home as _owned")
        blocks = cls(rows, keys, [time, tie], df.columns)
        return blocks.pack([c for c in df.columns if c not in (*keys, time, tie, *loose)])

    def over(self, frame: str = "", within: Sequence[str] = ()) -> str:
        """Window clause of a block (``within``: of a part of it), optionally with a row frame."""
        # A column that is equal throughout a part orders nothing in it; named twice, it would cost a sort of its own.
        keys = ", ".join([*self.keys, "_block", *within])
        order = ", ".join(c for c in self.order if c not in within)
        return f"over (partition by {keys} order by {order} {frame})"

    def so_far(self, within: Sequence[str] = ()) -> str:
        """Window clause from the first row of a block to the current one."""
        return self.over("rows between unbounded preceding and current row", within)

    def row_num(self) -> str:
        """Position of a row in its whole series, from 1."""
        return f"first(_ahead) {self.so_far()} + row_number() {self.over()}"

    def _with(self, rows: DataFrame, **changes: list[str]) -> "OrderedBlocks":
        state = {"order": self.order, "packs": self.packs, **changes}
        return OrderedBlocks(rows, self.keys, state["order"], self.columns, state["packs"])

    def add(self, columns: Mapping[str, str]) -> "OrderedBlocks":
        return self._with(add(self.rows, columns))

    def drop(self, names: Sequence[str]) -> "OrderedBlocks":
        return self._with(self.rows.drop(*names))

    def pack(self, names: Sequence[str]) -> "OrderedBlocks":
        """Put columns that no later window uses into a struct."""
        if not names:
            return self
        pack, listed = f"_pack{len(self.packs)}", ", ".join(names)
        rows = self.rows.selectExpr(f"* except ({listed})", f"struct({listed}) as {pack}")
        return self._with(rows, packs=[*self.packs, pack])

    def ordered_first_by(self, column: str) -> "OrderedBlocks":
        """The same row order, stated with a leading column that never decreases along it."""
        return self._with(self.rows, order=[column, *self.order])

    def segmented(self, rows: int, span: int) -> "OrderedBlocks":
        """Number the rows of a block (``_j``), its segments of ``rows`` rows and its spans of ``span`` segments.

        Adds ``_segment`` and ``_span``, a row's offset ``_k`` in its segment, and ``_t``, the segment's in its span.
        Windows over blocks, spans and segments then share one sort.
        """
        numbered = self.add({"_j": f"row_number() {self.over()} - 1"}).add(
            {"_segment": f"floor(_j / {rows})", "_span": f"floor(_j / {rows * span})", "_k": f"cast(_j % {rows} as int)"}
        )
        numbered = numbered.add({"_t": f"cast(_segment - _span * {span} as int)"})
        return numbered.ordered_first_by("_segment").ordered_first_by("_span")

    def owned(self) -> DataFrame:
        """The input rows, each once, with the columns added since the cut.

        Added columns whose names start with an underscore are left out.
        """
        rows = self.rows.filter("_owned").selectExpr("*", *[f"{pack}.*" for pack in self.packs])
        added = [c for c in rows.columns if c not in self.columns and not c.startswith("_")]
        return rows.select(*self.columns, *added)
