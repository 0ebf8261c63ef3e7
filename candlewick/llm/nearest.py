"""Exact top-k search by inner product with vector-approximation files.

Each component x counts as floor(256 * x). The file keeps, for every distinct vector, the
number of the cell (of ``CELLS`` equal ones over the component's range) that each component
falls in. A query scans the cells block by block and gets a lower and an upper bound of each
score; a vector whose upper bound stays below the k-th best lower bound is out. The exact
vectors of the rest are read in the order of their bounds, in two passes: the k with the best
bounds fix a k-th exact score, and only vectors whose bound reaches it are read after that.
Nothing that could be among the first k, ties included, is left out.

Equal vectors are searched once: a class keeps its k + 1 smallest distinct ids and how often each occurs (k + 1
at most), as no other member can be among the first k of any query.

Vectors of very different magnitude have files of their own, so that a few large ones do not coarsen the cells of the
others. Components are longs; scores that a long might not hold are summed as decimals. A
component or an answer's score that does not fit a long is an error (as in the statement below), never a wrapped number.

Queries and vectors meet as blocks of ``QUERY_BLOCK`` and ``BLOCK`` vectors of the same length, never as rows. Every task scans a part of
the cells for a part of the queries, without a shuffle, and goes on with the k-th best lower bounds it has met. The cells are scanned in
rounds, a few of their files first, and the bounds found so far hold for those that follow. What a vector length and scale have in
common stands beside each block of cells, so the driver gets no rows.

Defined results: vectors that are null, empty, or hold null or non-finite components take no
part; all others do. A row without vec_id is a candidate, after all ids among equal scores, and never a query. Vectors of
another length than the query's are not compared with it. A repeated vec_id stays a row of its own
as candidate, but is never an answer to the query of its own id; a query id repeated with
another vector is a second query under the same id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import SMALL_ROW_GROUPS, dropped, mapped, stored, table

CELLS = 64
BLOCK = 4096
QUERY_BLOCK = 2048
ROUNDS = 64, 8, 1  # in each, one of so many files of cells, without those scanned before
_TILE = 512  # queries whose scores are held at once
_HELD = 1 << 19  # bounds held by a task


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with integer components, of the vectors that take part."""
    wide = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = wide.filter((F.size("e") > 0) & sound)
    too_large = F.raise_error(F.lit("floor(256 * x) of a component does not fit a long")).cast("long")
    whole = lambda x: F.when(F.abs(x * 256) < 2.0**63, F.floor(x * 256)).otherwise(too_large)
    return kept.select("vec_id", F.transform("e", whole).alias("v"))


def _largest(v: str) -> Column:
    return F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))


def _scale(v: str) -> Column:
    """0 up to 2^24, one more for each 8 bits."""
    return F.greatest(F.lit(0), F.ceil((F.log2(F.greatest(_largest(v), F.lit(1.0))) - 24) / 8)).cast("int")


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(length, scale, [matrix and the other columns]) in blocks of ``size`` vectors of equal length and scale."""
    waiting: dict[tuple[int, int], list[list[np.ndarray]]] = {}
    for batch in batches:
        kinds = np.stack((pc.list_value_length(batch["v"]).to_numpy(), batch["scale"].to_numpy()))
        for length, scale in np.unique(kinds, axis=1).T.tolist():
            own = pa.array(np.flatnonzero((kinds[0] == length) & (kinds[1] == scale)))
            columns = [c.take(own).to_numpy() for n, c in zip(batch.schema.names, batch.columns) if n not in ("v", "scale")]
            parts = waiting.setdefault((length, scale), [])
            parts.append([batch["v"].take(own).flatten().to_numpy().reshape(-1, length), *columns])
            if sum(len(p[0]) for p in parts) >= size:
                whole = [np.concatenate(x) for x in zip(*parts)]
                last = len(whole[0]) // size * size
                for at in range(0, last, size):
                    yield length, scale, [x[at : at + size] for x in whole]
                waiting[length, scale] = [[x[last:] for x in whole]]
    for (length, scale), parts in waiting.items():
        whole = [np.concatenate(x) for x in zip(*parts)]
        if len(whole[0]):
            yield length, scale, whole


def _narrow(rows: np.ndarray) -> bytes:
    """Integers in as few bytes as hold them all."""
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= rows.min() and rows.max() <= np.iinfo(kind).max:
            return rows.astype(kind).tobytes()
    return rows.tobytes()


def _wide(body: bytes, length: int, vectors: int) -> np.ndarray:
    return np.frombuffer(body, f"i{len(body) // (length * vectors)}").reshape(-1, length).astype(np.int64)


_BLOCK_SCHEMA = "length int, scale int, block long, body binary, keys binary"


def _blocks(vectors: DataFrame, size: int, more: str = "") -> DataFrame:
    """Vectors (key, v, scale) as packed blocks of integers; ``more`` names a column of doubles that is packed, too."""
    names = ["key", more] if more else ["key"]
    schema = pa.schema([("length", pa.int32()), ("scale", pa.int32()), ("block", pa.int64()), ("body", pa.binary()), ("keys", pa.binary())])
    schema = schema.append(pa.field(more, pa.binary())) if more else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for length, scale, (rows, *columns) in _packed(batches, size):
            values = [length, scale, number, _narrow(rows), *(x.tobytes() for x in columns)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, values))], schema=schema)
            number += 1

    return mapped(vectors.select("v", "scale", *names), run, _BLOCK_SCHEMA + (f", {more} binary" if more else ""))


def _grid(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell width of each component; differences of longs as unsigned ones."""
    return low, (high.view(np.uint64) - low.view(np.uint64)) // np.uint64(CELLS) + np.uint64(1)


def _cells(blocks: DataFrame) -> DataFrame:
    """Blocks of cell numbers from blocks of integers; ``low`` and ``high`` of their length and scale go with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for row in batch.to_pylist():
                low, width = _grid(np.array(row["low"], np.int64), np.array(row["high"], np.int64))
                rows = _wide(row["body"], row["length"], len(row["keys"]) // 8)
                bodies.append(((rows.view(np.uint64) - low.view(np.uint64)) // width).astype(np.uint8).tobytes())
            yield batch.set_column(batch.schema.names.index("body"), "body", pa.array(bodies, pa.binary()))

    return mapped(blocks, run, _BLOCK_SCHEMA + ", low array<long>, high array<long>")


def _component_ranges(classes: DataFrame) -> DataFrame:
    """(length, scale, low, high): least and greatest value of each component, combined within tasks before the shuffle."""
    each = classes.select(F.size("v").alias("length"), "scale", F.posexplode("v").alias("at", "x"))
    ends = each.groupBy("length", "scale", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    in_order = F.sort_array(F.collect_list(F.struct("at", "low", "high")))
    return ends.groupBy("length", "scale").agg(in_order.alias("r")).select("length", "scale", F.col("r.low").alias("low"), F.col("r.high").alias("high"))


def _met(queries: DataFrame, cells: DataFrame) -> DataFrame:
    """Every block of queries with every block of cells of its length, as the exact search asks for it."""
    q = queries.withColumnsRenamed({"length": "q_length", "block": "q_block", "body": "q_body", "keys": "q_keys"}).drop("scale")
    # Not an equality, by which Spark would shuffle both sides to one task a length: parts of the two stored tables meet in place.
    return q.join(cells.drop("block"), F.expr("q_length <= length and q_length >= length"))


class _Best:
    """Of a block of queries, the vectors met that can be among the first ``k``; ``bars`` are lower bounds of the k-th scores, where known."""

    def __init__(self, keys: np.ndarray, bars: np.ndarray, k: int) -> None:
        self.keys, self.bars, self.k = keys, bars.copy(), k
        self.tops = np.full((len(keys), k if k <= BLOCK else 0), -np.inf)  # the k best lower bounds met, ascending
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = self.tops.size

    def meet(self, queries: np.ndarray, middle: np.ndarray, reach: np.ndarray, keys: np.ndarray) -> None:
        """``queries @ middle.T`` are the scores, each right within the query's ``reach``."""
        for at in range(0, len(queries), _TILE):
            tile = slice(at, at + _TILE)
            score, bar = queries[tile] @ middle.T, self.bars[tile]
            fresh = np.flatnonzero(np.isneginf(bar))
            if len(fresh) and self.k <= len(keys):
                bar[fresh] = np.partition(score[fresh], len(keys) - self.k, axis=1)[:, len(keys) - self.k] - reach[tile][fresh]
            least = bar - reach[tile]
            rounded = least.astype(score.dtype)
            rounded = np.where(rounded > least, np.nextafter(rounded, score.dtype.type(-np.inf)), rounded)
            hits = np.flatnonzero(score >= rounded[:, None])
            q, c = np.divmod(hits, len(keys))
            value = score.ravel()[hits].astype(np.float64)
            q += at
            self.parts.append((q, keys[c], value - reach[q], value + reach[q]))
            self.size += len(q)
            self._raise(q, value - reach[q])

    def _raise(self, q: np.ndarray, lower: np.ndarray) -> None:
        """The bars after ``lower`` bounds of the queries numbered ``q``, which ascend."""
        if not self.tops.size:
            return
        better = lower > self.tops[q, 0]
        q, lower = q[better], lower[better]
        if not len(q):
            return
        order = np.lexsort((-lower, q))
        q, lower = q[order], lower[order]
        own, first, of = np.unique(q, return_index=True, return_inverse=True)
        place = np.arange(len(q)) - first[of]
        best = place < self.k
        met = np.full((len(own), self.k), -np.inf)
        met[of[best], place[best]] = lower[best]
        self.tops[own] = np.sort(np.concatenate((self.tops[own], met), axis=1), axis=1)[:, -self.k :]
        self.bars[own] = np.maximum(self.bars[own], self.tops[own, 0])

    def rows(self) -> pa.RecordBatch:
        """(q, key, lower, upper) of those not excluded, which are then no longer held."""
        q, keys, lower, upper = (np.concatenate(x) for x in zip(*self.parts))
        left = np.flatnonzero(upper >= self.bars[q])
        self.parts, self.size = [], self.tops.size
        columns = (self.keys[q[left]], keys[left], lower[left] / 2, upper[left] / 2)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["q", "key", "lower", "upper"])


def _scan(pairs: DataFrame, k: int) -> DataFrame:
    """For each query the vectors that can be among its first ``k``: (q, key, lower, upper)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                length = row["length"]
                keys, q_keys = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["q_keys"], np.int64)
                high = np.array(row["high"], np.float64)
                low, width = (x.astype(np.float64) for x in _grid(*(np.array(row[n], np.int64) for n in ("low", "high"))))
                queries = _wide(row["q_body"], length, len(q_keys)).astype(np.float64)
                # All values are integers (twice the cell's middle), exact in doubles up to 2^53; what lies beyond, and a
                # last cell that reaches past the greatest value, is covered by the slack.
                middle = 2.0 * low + width * (2.0 * np.frombuffer(row["body"], np.uint8).reshape(-1, length) + 1) - 1
                most = max(2.0 * np.abs(low).max(), 2.0 * np.abs(high).max(), np.abs(middle).max())
                largest = np.abs(queries).max()
                slack = (1e-12 + 1e-15 * length) * (largest * most * length)
                reach = np.abs(queries) @ (width - 1.0) + slack
                if largest * most * length < 2.0**24:  # exact in floats, too
                    queries, middle = queries.astype(np.float32), middle.astype(np.float32)
                best = held.get(row["q_block"])
                if best is None:
                    best = held[row["q_block"]] = _Best(q_keys, 2 * np.frombuffer(row["bar"], np.float64), k)
                best.meet(queries, middle, reach, keys)
                if sum(b.size for b in held.values()) > _HELD:
                    yield from (b.rows() for b in held.values() if b.parts)
                    held = {row["q_block"]: best}
        yield from (b.rows() for b in held.values() if b.parts)

    return mapped(pairs, run, "q long, key long, lower double, upper double")


def _bars(found: DataFrame, k: int) -> DataFrame:
    """(q, bar, n): the k-th best lower bound of each query, or the last one of ``n`` where there are fewer."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))
    return found.withColumn("n", rank).filter(F.col("n") <= k).groupBy("q").agg(F.min("lower").alias("bar"), F.count("*").alias("n"))


_SCORE = "decimal(38,0)"


def _exact(wanted: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact scores of (q, key) pairs: reads the full vectors of both sides."""
    left, right = vectors.select(F.col("key").alias("q"), F.col("v").alias("qv")), vectors.select("key", "v")
    narrow = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x).cast(_SCORE)
    exact = F.zip_with("qv", "v", lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(_SCORE))
    exact = F.aggregate(exact, F.lit(0).cast(_SCORE), lambda s, x: (s + x).cast(_SCORE))
    score = F.when(_largest("qv") * _largest("v") * F.size("v") < 2.0**62, narrow).otherwise(exact)
    return wanted.select("q", "key").join(right, "key").join(left, "q").select("q", "key", score.alias("score"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` best rows of each query row (``is_query`` over vec_id): query_id, rank, vec_id, score."""
    rows = prepared(vectors).withColumn("hash", F.xxhash64("v"))
    by_vector = Window.partitionBy("hash", "v").orderBy(F.asc_nulls_last("vec_id"))
    # k + 1 smallest distinct ids of each class, each with its copies; counted inside every task before the shuffle.
    ids = rows.groupBy("hash", "v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    ids = ids.withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= k + 1)
    classes = stored(
        ids.groupBy("hash", "v").agg(F.sort_array(F.collect_list(F.struct(F.isnull("vec_id").alias("no_id"), "vec_id", "copies"))).alias("ids"))
        .withColumns({"key": F.monotonically_increasing_id(), "scale": _scale("v")}),
        "classes",
    )
    asked = rows.filter(is_query & F.col("vec_id").isNotNull()).select("vec_id", "hash", "v").join(classes.select("hash", "v", "key"), ["hash", "v"])
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("q")).distinct(), "asked")

    # A query's own id may fill as many classes as it has vectors.
    vectors_of_id = asked.groupBy("query_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    deep = k + vectors_of_id

    ranges = stored(_component_ranges(classes), "ranges")
    blocks = _blocks(classes, BLOCK).join(ranges, ["length", "scale"])
    cells = stored(_cells(blocks.select("length", "scale", "block", "body", "keys", "low", "high")), "cells", SMALL_ROW_GROUPS)
    query_classes = classes.join(asked.select(F.col("q").alias("key")).distinct(), "key", "left_semi").select("key", "v", "scale")
    query_classes = stored(query_classes.repartition(F.floor(F.col("key") / 8)), "query_classes")

    number, unknown = F.shiftright("block", 32), F.lit(float("-inf"))  # whole files, so that a task scans as long in each round
    before, rounds = F.lit(False), []
    # Parts of queries times files of cells are the tasks of a round: their number follows the input, not its square.
    files = 1 + (cells.agg(F.max(number)).first()[0] or 0)
    parts = 1 + 2 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")) // files
    for each in ROUNDS:
        now = F.pmod(number, F.lit(each)) == 0
        part, before = cells.filter(now & ~before), before | now
        if rounds and part.isEmpty():
            continue
        barred = query_classes.withColumn("bar", unknown)
        if rounds:
            known = _bars(functools.reduce(DataFrame.unionByName, rounds), deep).filter(F.col("n") == deep)
            barred = query_classes.join(known.select(F.col("q").alias("key"), "bar"), "key", "left").withColumn("bar", F.coalesce("bar", unknown))
        queries = stored(_blocks(barred, QUERY_BLOCK, "bar"), "queries", SMALL_ROW_GROUPS)
        rounds.append(stored(_scan(_met(queries.coalesce(parts), part), deep), "found"))
        dropped(queries)
    dropped(cells, query_classes)

    # The bound of the last class needed over all blocks; the classes of a query's own id take part, so more than k.
    found = functools.reduce(DataFrame.unionByName, rounds)
    bar = _bars(found, deep)
    left = found.join(bar, "q").filter((F.col("n") < deep) | (F.col("upper") >= F.col("bar"))).select("q", "key", "upper")
    upper_rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("upper"), "key"))
    left = stored(left.withColumn("n", upper_rank), "left")
    dropped(*rounds)

    first = stored(_exact(left.filter(F.col("n") <= deep), classes), "first")
    least = first.groupBy("q").agg(F.min("score").alias("least"), F.count("*").alias("read"))
    more = left.filter(F.col("n") > deep).join(least, "q").filter((F.col("read") < deep) | (F.col("upper") >= F.col("least")))
    scored = first.unionByName(_exact(more, classes))

    # These best classes of each query class hold the k best rows of each of its query rows.
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0]))
    tops = scored.join(classes.select("key", "ids"), "key").withColumn("n", best).filter(F.col("n") <= deep)
    listed = tops.select("q", "score", F.explode("ids").alias("id")).select("q", "score", "id.*")
    few = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    listed = listed.withColumn("n", few).filter(F.col("n") <= deep).drop("n")
    answers = asked.join(listed, "q").filter(~F.col("vec_id").eqNullSafe(F.col("query_id")))
    answers = answers.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the five best of every vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


#: The same by brute force.
ORACLE = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as c
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select vec_id as query_id, c as qc from v where vec_id % 50 = 0),
s as (
  select query_id, vec_id,
         cast(list_inner_product(cast(qc as double[]), cast(c as double[])) as bigint) as score
  from q join v on vec_id is distinct from query_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id nulls last) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
