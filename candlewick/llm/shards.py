"""Minimax contiguous partition of documents into shards. DataFrame functions only.

Equal texts form a group that no shard may split. Groups are ordered by their smallest
doc_id, and the ordered groups are cut into ``shards`` runs so that the largest run has as
few bytes as possible: a binary search finds the smallest capacity for which cutting
greedily (each shard takes groups while they fit) needs no more than ``shards`` runs. Within this
capacity each run then ends at the known group end nearest to an equal share of the bytes that are left, as long as
the rest still fits; the known ends are some ``CELLS`` or more, those of the greedy runs and the last ones among them.

Greedy cutting asks for the last group that ends at or below some number of bytes. The
driver answers from a summary of at most ``CELLS`` cells of the byte line (least and greatest
group end of each), which gives a lower and an upper answer where a cell is not resolved.
Each round narrows the capacity with the summary, then asks Spark for finer cells where it
was undecided, until the capacity is exact. What the driver holds is bounded by ``CELLS``.

Defined results: a null text has no bytes and forms one group with other null texts; null
doc_ids come first; repeated rows are kept and numbered; only with fewer groups than shards
do some (the last ones) stay empty; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import looked_up, part_offsets, positioned, stored, table

SHARDS = 40
ROW_BYTES = 16
CELLS = 1 << 14


class _Line:
    """Group ends on the byte line, known by cells of width 1 << bits: start -> (least end, greatest end)."""

    def __init__(self, total: int, largest: int):
        self.total, self.largest = total, largest
        self.cells: dict[int, tuple[int, int, int]] = {}  # cell start -> (width, least, greatest)
        self.starts: list[int] = []

    def replace(self, old: list[int], new: list[tuple[int, int, int, int]]) -> None:
        for start in old:
            self.cells.pop(start, None)
        self.cells.update({start: (width, least, most) for start, width, least, most in new})
        self.starts = sorted(self.cells)

    def ends(self) -> set[int]:
        """All group ends known exactly."""
        return {end for _, least, most in self.cells.values() for end in (least, most)}

    def last_end(self, at: int) -> tuple[int, int, int | None]:
        """Bounds on the greatest group end at or below ``at``, and the cell to refine if they differ."""
        i = bisect_right(self.starts, at) - 1
        while i >= 0:
            start = self.starts[i]
            width, least, most = self.cells[start]
            if at >= most:
                return most, most, None
            if at >= least:
                return least, min(at, most), start
            i -= 1
        return 0, 0, None

    def cuts(self, capacity: int, shards: int, upper: bool) -> tuple[list[int], list[int]]:
        """Ends of the greedy runs by the lower or the upper answers, and the cells they left open."""
        ends, open_cells, position = [], [], 0
        for _ in range(shards):
            low, high, cell = self.last_end(position + capacity)
            if cell is not None:
                open_cells.append(cell)
            position = high if upper else low
            ends.append(position)
        return ends, open_cells


def spread_cuts(known: set[int], last: list[int], capacity: int, shards: int) -> list[int]:
    """Ends of runs of at most ``capacity``, near equal, chosen among the ``known`` group ends.

    ``known`` holds the ends of some feasible runs and the ``last`` ends (descending, up to ``shards`` of them).
    """
    ends = sorted(known - {0})
    total = ends[-1]
    # least[k]: the first end from which k runs reach the total.
    least = [total]
    for _ in range(shards):
        least.append(0 if least[-1] <= capacity else ends[bisect_left(ends, least[-1] - capacity)])
    cuts, position = [], 0
    for left in range(shards, 0, -1):
        if position < total:
            following = ends[bisect_right(ends, position)]
            low = max(least[left - 1], following)
            # Every later run finds a group of its own while there are as many.
            high = ends[bisect_right(ends, position + capacity) - 1]
            high = max(low, min(high, last[left - 1] if left <= len(last) else following))
            share = position + (total - position) // left
            at = bisect_left(ends, share)
            near = min(ends[max(at - 1, 0) : at + 1], key=lambda e: abs(e - share))
            position = min(max(near, low), high)
        cuts.append(position)
    return cuts


def _smallest(low: int, high: int, holds) -> int:
    """The smallest number in low..high for which ``holds`` (monotone, true at high)."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def capacity_and_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """Ends of the runs for the smallest capacity; ``ends`` has the column ``end`` (bytes up to and with each group)."""
    line = _Line(total, largest)
    width = 1
    while -(-total // width) >= CELLS:
        width *= 2
    line.replace([], _summarised(ends, width))
    least, most = max(largest, -(-total // shards)), total
    while True:
        # Feasible for sure by the lower answers, possibly feasible by the upper ones.
        sure = _smallest(least, most, lambda c: line.cuts(c, shards, upper=False)[0][-1] >= total)
        maybe = _smallest(least, sure, lambda c: line.cuts(c, shards, upper=True)[0][-1] >= total)
        found, open_cells = line.cuts(sure, shards, upper=False)
        if sure == maybe and not open_cells:
            last = [r["end"] for r in ends.orderBy(F.desc("end")).limit(shards).collect()]
            return spread_cuts({*found, *last, *line.ends()}, last, sure, shards)
        least, most = maybe, sure
        wanted = {c for probe in {sure, maybe, sure - 1} if probe >= least for up in (False, True) for c in line.cuts(probe, shards, up)[1]}
        wanted |= _between(line, least, most, shards)
        finer = max(1, CELLS // max(len(wanted), 1))
        rows = []
        by_width: dict[int, list[int]] = {}
        for start in wanted:
            by_width.setdefault(line.cells[start][0], []).append(start)
        for old_width, starts in by_width.items():
            new_width = old_width
            while new_width > 1 and old_width // new_width < finer:
                new_width //= 2
            spark = ends.sparkSession
            chosen = spark.createDataFrame([(s // old_width,) for s in starts], "cell long")
            inside = ends.withColumn("cell", F.floor(F.col("end") / F.lit(old_width)).cast("long")).join(chosen, "cell", "left_semi")
            rows += _summarised(inside, new_width)
        line.replace(list(wanted), rows)


def _between(line: _Line, least: int, most: int, shards: int) -> set[int]:
    """Unresolved cells that some capacity in least..most may ask for, as many as keep the summary bounded."""
    wanted: set[int] = set()
    low, _ = line.cuts(least, shards, upper=False)
    high, _ = line.cuts(most, shards, upper=True)
    for a, b in zip([0, *low], [0, *high]):
        first = bisect_right(line.starts, a + least) - 1
        last = bisect_right(line.starts, b + most)
        for start in line.starts[max(first, 0) : last]:
            if len(wanted) >= CELLS // 4:
                return wanted
            width, small, large = line.cells[start]
            if small < large:
                wanted.add(start)
    return wanted


def _summarised(ends: DataFrame, width: int) -> list[tuple[int, int, int, int]]:
    cell = (F.col("end") - F.pmod(F.col("end"), F.lit(width))).alias("start")
    found = ends.groupBy(cell).agg(F.min("end").alias("least"), F.max("end").alias("most")).collect()
    return [(r["start"], width, r["least"], r["most"]) for r in found]


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row; slots count from 0 in a shard, by group and doc_id."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES
    bytes_ = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long"),
            size.cast("long").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.lit(b"")).alias("text_key"),
        ),
        "rows",
    )
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first"))
    placed = positioned(groups, ["first", "text_key"], F.col("bytes"), "groups")
    placed = stored(placed.select("text_key", (F.col("before") + F.col("bytes")).alias("end"), "bytes"), "ends")
    total, largest = placed.agg(F.max("end"), F.max("bytes")).first()
    cuts = capacity_and_cuts(placed.select("end"), total, largest, shards) if total else []
    # A group goes to the first run that ends at or after it.
    shard = F.size(F.filter(F.lit(cuts[:-1] or [0]).cast("array<bigint>"), lambda c: c < F.col("end")))
    of_group = placed.select("text_key", "end", (shard if cuts[:-1] else F.lit(0)).alias("shard"))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "end", "doc_id", "copy"]
    laid = stored(
        rows.join(of_group, "text_key")
        .drop("text_key")
        .withColumn("copy", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .withColumn("_part", F.spark_partition_id()),
        "laid",
    )
    overall = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + looked_up(
        part_offsets(laid, F.count("*")), F.col("_part")
    )
    sizes = {r["shard"]: r["n"] for r in laid.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    opening = [sum(sizes.get(s, 0) for s in range(shard)) for shard in range(shards)]
    return laid.select(
        "doc_id", "size", "text_crc32", "shard", (overall - 1 - looked_up(opening, F.col("shard"))).alias("slot")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the shard and slot of every document, sizes near equal."""
    return sharded(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
