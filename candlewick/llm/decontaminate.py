"""Benchmark decontamination with suffix arrays of the training text.

Every shard of documents (about ``SHARD_WORDS`` words of one task's rows) builds the
suffix array of its words. Each suffix of each benchmark item is then binary-searched in
it, word by word, which gives its longest verbatim match and all places of it. A document
word is hit if it stands inside an occurrence of a window: ``window`` consecutive words of
an item, or the whole of an item with fewer.

Words are numbered by the benchmark's own vocabulary; a word outside it ends every match, so
the array holds only suffixes that begin with a run of known words as long as the shortest window.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass over
the documents a block, so nothing sent grows with it. A document stays in one shard.

Defined results: null and empty texts have no words and no hits; an item without words has
no window; items with the same window are all listed; repeated item_ids count once; the
words of an item without id are hit but it is not listed. Repeated document rows are judged
row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import mapped, table

SHARD_WORDS = 1 << 20
BLOCK_BYTES = 8 << 20

# Bytes of words: digits, letters (A-Z as a-z) and everything outside ASCII; the rest separates.
_TO_WORDS = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 or chr(b).isdigit() else 32 for b in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Benchmark:
    """A block of benchmark items: numbered words, all suffixes, and which suffixes begin a window."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        texts = [(item, split_words(text)) for item, text in items]
        rows = [(item, [self.number.setdefault(w, len(self.number) + 1) for w in words]) for item, words in texts if words]
        self.shortest = min((min(window, len(words)) for _, words in rows), default=window)
        lengths = [len(words) for _, words in rows]
        self.words = np.array([w for _, words in rows for w in [*words, -1]], np.int64)
        # Of each suffix: where it begins, its length, its item's row, and the words its window takes (0: none begins here).
        starts = np.cumsum([0, *[n + 1 for n in lengths]])[:-1]
        self.at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)] or [np.zeros(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), lengths)
        self.left = np.concatenate([np.arange(n, 0, -1) for n in lengths] or [np.zeros(0, np.int64)]).astype(np.int64)
        whole = np.repeat(np.array(lengths, np.int64), lengths)
        needs = np.minimum(whole, window)
        self.needs = np.where((self.left >= needs) & ((whole >= window) | (self.left == whole)), needs, 0)
        self.items = [item for item, _ in rows]
        self.longest = max(lengths, default=0)


def suffix_array(codes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the suffixes of ``codes`` that begin there, compared over ``depth`` codes.

    Prefix doubling: after the round for h, ``rank`` orders all positions by their first h codes.
    ``codes`` ends with a 0, and a suffix counts up to its first 0.
    """
    live = np.flatnonzero(codes)
    rank = codes.astype(np.int64)
    h = 1
    while h < depth and len(live):
        behind = np.minimum(live + h, len(codes) - 1)
        key = rank[live] * (len(codes) + codes.max() + 2) + rank[behind]
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.concatenate(([1], (key[1:] != key[:-1]).astype(np.int64)))
        rank = np.zeros_like(rank)
        rank[live[order]] = np.cumsum(fresh)
        if fresh.all():
            break
        h *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def search(codes: np.ndarray, array: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each benchmark suffix: length of its longest match in the array, and the
    range of array entries that match all words of its window (empty without a window)."""
    n = len(bench.at)
    longest = np.zeros(n, np.int64)
    first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.arange(n)
    low, high = np.zeros(n, np.int64), np.full(n, len(array), np.int64)
    for depth in range(bench.longest):
        active = active[bench.left[active] > depth]
        if not len(active):
            break
        want = bench.words[bench.at[active] + depth]
        bounds = []
        for beyond in (False, True):
            a, b = low[active].copy(), high[active].copy()
            while (open_ := a < b).any():
                middle = (a + b) >> 1
                there = codes[np.minimum(array[np.minimum(middle, len(array) - 1)] + depth, len(codes) - 1)]
                right = ((there <= want) if beyond else (there < want)) & open_
                a, b = np.where(right, middle + 1, a), np.where(right | ~open_, b, middle)
            bounds.append(a)
        low[active], high[active] = bounds
        found = bounds[0] < bounds[1]
        active = active[found]
        longest[active] = depth + 1
        done = active[bench.needs[active] == depth + 1]
        first[done], last[done] = low[done], high[done]
    return longest, first, last


class _Shard:
    """Documents waiting for their common suffix array."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.codes: list[np.ndarray] = []
        self.words = 0

    def add(self, doc_id: int | None, text: str | None, bench: Benchmark) -> None:
        words = split_words(text)
        get = bench.number.get
        self.ids.append(doc_id)
        self.codes.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        self.words += len(words)

    def indexed(self, bench: Benchmark):
        lengths = np.array([len(c) for c in self.codes], np.int64)
        codes = np.concatenate([x for c in self.codes for x in (c, [0])]).astype(np.int64)
        begin = np.cumsum(lengths + 1) - lengths - 1
        # Words to the next unknown one; only long enough runs can hold a window.
        stops = np.flatnonzero(codes == 0)
        run = stops[np.searchsorted(stops, np.arange(len(codes)))] - np.arange(len(codes))
        whole_run = run + np.arange(len(codes)) - np.concatenate(([-1], stops))[np.searchsorted(stops, np.arange(len(codes)))] - 1
        codes[whole_run < bench.shortest] = 0
        starts = np.flatnonzero((codes != 0) & (run >= bench.shortest))
        return lengths, begin, codes, suffix_array(codes, starts, bench.longest)


def _hits(shard: _Shard, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, list[list[int]], list[list[list[int]]]]:
    """Per document: words, hit words, rows of the benchmark with occurring windows, hit ranges."""
    lengths, begin, codes, array = shard.indexed(bench)
    n = len(lengths)
    hit = np.zeros(n, np.int64)
    rows: list[list[int]] = [[] for _ in range(n)]
    ranges: list[list[list[int]]] = [[] for _ in range(n)]
    if not len(array) or not len(bench.at):
        return lengths, hit, rows, ranges
    _, first, last = search(codes, array, bench)
    windows = np.flatnonzero(last > first)
    # Equal windows share a range of the array: expand each range once, and list its items per document.
    keys = np.stack([first[windows], last[windows], bench.needs[windows]], 1)
    distinct, owner = np.unique(keys, axis=0, return_inverse=True)
    owner = owner.reshape(-1)
    cover = np.zeros(len(codes) + 1, np.int64)
    seen = []
    for k, (a, b, words) in enumerate(distinct):
        places = array[a:b]
        np.add.at(cover, places, 1)
        np.add.at(cover, places + words, -1)
        documents = np.unique(np.searchsorted(begin, places, side="right") - 1)
        seen.append(documents)
    covered = np.cumsum(cover[:-1]) > 0
    hit += np.add.reduceat(covered, begin) if n else 0
    of_owner: list[set[int]] = [set() for _ in distinct]
    for window, k in zip(windows, owner):
        of_owner[k].add(int(bench.row[window]))
    gathered: dict[int, set[int]] = {}
    for documents, items in zip(seen, of_owner):
        for d in documents.tolist():
            gathered.setdefault(d, set()).update(items)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        d = int(np.searchsorted(begin, a, side="right") - 1)
        ranges[d].append([a - int(begin[d]), b - int(begin[d])])
    for d, found in gathered.items():
        rows[d] = sorted(found)
    return lengths, hit, rows, ranges


_RESULT = "doc_id long, row long, n_words long, n_hit long, items array<string>, ranges array<array<long>>"


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark in blocks of bounded size, each item in one of them."""
    items = benchmark.select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for b in range(max(n, 1)):
        yield [(r["item_id"], r["text"]) for r in items.filter(block == b).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (their ids, as sorted strings), ranges (hit words, from-to)."""
    blocks = list(_blocks(benchmark))
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if len(blocks) == 1:
        return _against(rows, blocks[0], window).drop("row")
    # More than one block: a document's rows are put together again; a copy of a row stays apart by its hash and number.
    from functools import reduce

    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    parts = reduce(DataFrame.unionByName, [_against(keyed, block, window) for block in blocks])
    joined = parts.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("ranges"))).alias("ranges"),
    )
    merged = F.aggregate(
        "ranges",
        F.array().cast("array<array<long>>"),
        lambda done, r: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)[1] >= r[0]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.array(F.element_at(done, -1)[0], F.greatest(F.element_at(done, -1)[1], r[1]))),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )
    joined = joined.withColumn("ranges", merged)
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return joined.select("doc_id", "n_words", hit.alias("n_hit"), "items", "ranges")


def _against(rows: DataFrame, items: list[tuple[int | None, str | None]], window: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(sent.value, window)

        def finish(shard: _Shard, keys: list[int]) -> pa.RecordBatch:
            lengths, hit, found, ranges = _hits(shard, bench)
            items = [sorted({str(bench.items[r]) for r in row if bench.items[r] is not None}) for row in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(shard.ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(lengths), pa.array(hit),
                 pa.array(items, pa.list_(pa.string())), pa.array(ranges, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "row", "n_words", "n_hit", "items", "ranges"],
            )

        shard, keys = _Shard(), []
        for batch in batches:
            row_keys = batch["row"].to_pylist() if "row" in batch.schema.names else [0] * batch.num_rows
            for doc_id, text, key in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), row_keys):
                shard.add(doc_id, text, bench)
                keys.append(key)
                if shard.words >= SHARD_WORDS:
                    yield finish(shard, keys)
                    shard, keys = _Shard(), []
        if keys:
            yield finish(shard, keys)

    return mapped(rows, run, _RESULT)


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without a hit word; one pass for each block of the benchmark."""

    def against(rows: DataFrame, items: list[tuple[int | None, str | None]]) -> DataFrame:
        sent = rows.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(sent.value, window)

            def finish(shard: _Shard, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                clean, at = _hits(shard, bench)[1] == 0, 0
                for batch in held:
                    yield batch.filter(pa.array(clean[at : at + batch.num_rows]))
                    at += batch.num_rows

            shard, held = _Shard(), []
            for batch in batches:
                held.append(batch)
                for text in batch["text"].to_pylist():
                    shard.add(None, text, bench)
                if shard.words >= SHARD_WORDS:
                    yield from finish(shard, held)
                    shard, held = _Shard(), []
            if shard.ids:
                yield from finish(shard, held)

        return rows.mapInArrow(run, rows.schema)

    for block in _blocks(benchmark):
        docs = against(docs, block)
    return docs


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each suffix of each item and each shard with a match: (item_id, position, n_words, doc_id, at).

    ``n_words`` is the longest match in the shard and (doc_id, at) a place of it; the
    longest overall is the maximum over the shards.
    """
    blocks = list(_blocks(benchmark))
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def matched(items):
        sent = rows.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(sent.value, 1)
            bench.needs = np.zeros_like(bench.needs)

            def finish(shard: _Shard) -> pa.RecordBatch:
                _, begin, codes, array = shard.indexed(bench)
                longest, _, _ = search(codes, array, bench)
                suffixes = np.flatnonzero(longest)
                bench.needs[suffixes] = longest[suffixes]
                _, first, _ = search(codes, array, bench)
                bench.needs[:] = 0
                place = array[first[suffixes]] if len(array) else suffixes
                doc = np.searchsorted(begin, place, side="right") - 1
                opening = np.concatenate(([0], np.flatnonzero(np.diff(bench.row)) + 1)) if len(bench.row) else np.zeros(1, np.int64)
                position = np.arange(len(bench.row)) - opening[bench.row] if len(bench.row) else bench.row
                return pa.RecordBatch.from_arrays(
                    [pa.array([bench.items[r] for r in bench.row[suffixes]], pa.int64()), pa.array(position[suffixes], pa.int64()),
                     pa.array(longest[suffixes], pa.int64()), pa.array([shard.ids[d] for d in doc], pa.int64()),
                     pa.array(place - begin[doc], pa.int64())],
                    ["item_id", "position", "n_words", "doc_id", "at"],
                )

            shard = _Shard()
            for batch in batches:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    shard.add(doc_id, text, bench)
                    if shard.words >= SHARD_WORDS:
                        yield finish(shard)
                        shard = _Shard()
            if shard.ids:
                yield finish(shard)

        return mapped(rows, run, "item_id long, position long, n_words long, doc_id long, at long")

    from functools import reduce

    return reduce(DataFrame.unionByName, [matched(block) for block in blocks])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: per document its words, hit words and the items whose windows occur in it."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
