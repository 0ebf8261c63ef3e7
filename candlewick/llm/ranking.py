"""Ranked lexical search with per-term geometric blocking.

Every document is a sparse vector of term impacts, (10^9 tf) div (1000 tf + 8 m); its score for an item is the
inner product with the weights of the item's terms. The index has, for each term, the list of documents that
hold it, divided into blocks of documents that are alike (clustered around some of the list's documents by a
short random projection of the vectors), and for each block its summary: the largest impact of every term
over the block's documents. The product of an item's weights with a summary bounds the score of
each document of the block, so a block is skipped only if that bound is below the item's k-th best score so far. Lists
are visited in falling order of what they can add; once all lists left cannot reach that score together, the
search of the segment ends. Nothing is approximate: clustering decides the work, not the result.

The index is made of segments of at most ``SEGMENT`` documents and about ``SEGMENT_POSTINGS`` postings; no list is gathered
over all documents, and a term that all documents hold is divided like any other. A task searches its segments one
after another, keeps the best k of each item across them, and returns only those.

Items come in blocks whose terms fit ``BLOCK_TERMS``; each block is one pass that indexes the block's terms only. So what
is sent to tasks is bounded, whatever the number of items, and the index leaves out terms nobody asks for.

Defined results: null and empty texts have no terms; such documents are not counted and never found, such items have no
rows. Repeated rows are documents of their own, also under one doc_id; a null doc_id comes after all others among
equal scores. Every row of items is an item of its own, also under a repeated or null item_id. Empty tables give no
rows. Terms that no document holds add nothing. Texts are read in pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import SMALL_ROW_GROUPS, mapped, positioned, stored, table
from candlewick.llm.words import pieces

BLOCK_TERMS = 1 << 17
SEGMENT = 2048
SEGMENT_POSTINGS = 1 << 18
#: Documents of a block of a list; lists of fewer than ``SUMMED`` are cheaper to score than to bound, and have no summary.
BLOCK = 256
SUMMED = 64
PROJECTION = 32

# Bytes of terms as themselves (A-Z lowered); all others are spaces.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def term_counts(text: str | None) -> Counter[bytes]:
    """Occurrences of each term of a text, in UTF-8."""
    found: Counter[bytes] = Counter()
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(_TERMS)):
        found.update(piece.split())
    return found


# --- counting ------------------------------------------------------------------------


def _numbered_items(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, block) of the items that have terms; a block's terms are bounded, but for a single long item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(t.decode() for t in term_counts(x)) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = mapped(rows, run, "item_id long, terms array<string>").filter(F.size("terms") > 0)
    found = stored(found.withColumn("item", F.monotonically_increasing_id()), "items")
    placed = positioned(found, ["item"], F.size("terms"), "items")
    return stored(placed.withColumn("block", F.floor(F.col("before") / BLOCK_TERMS)).drop("before"), "items")


_COUNTED = "doc_id long, length long, terms array<int>, tf array<long>"


def counted(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """Documents with terms: the number of all their terms, and the counts of those in the vocabulary (term -> number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            ids, lengths, terms, tf = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                counts = term_counts(text)
                if counts:
                    known = [t for t in counts if t in number]
                    ids.append(doc_id)
                    lengths.append(counts.total())
                    terms.append([number[t] for t in known])
                    tf.append([counts[t] for t in known])
            columns = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, run, _COUNTED)


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int

    def norm(self, length: int) -> int:
        """A document's m."""
        return 100 - 90 + 90 * length * self.documents // self.terms

    def weight(self, holding: int) -> int:
        """Of a term that so many documents hold."""
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * holding + 1)))


# --- index ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Segment:
    """Vectors of some documents (rows of ``starts`` into ``terms`` and ``impacts``) and the blocks of their lists.

    Blocks are in the order of their list's term, ``block_term``; block b has the rows
    ``members[member_starts[b]:member_starts[b + 1]]`` and a summary in ``summary_terms``, ``summary_impacts``.
    """

    ids: np.ndarray
    no_id: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    impacts: np.ndarray
    block_term: np.ndarray
    member_starts: np.ndarray
    members: np.ndarray
    summary_starts: np.ndarray
    summary_terms: np.ndarray
    summary_impacts: np.ndarray


_KINDS = {
    "ids": np.int64, "no_id": np.bool_, "starts": np.int64, "terms": np.int32, "impacts": np.int32, "block_term": np.int32,
    "member_starts": np.int64, "members": np.int32, "summary_starts": np.int64, "summary_terms": np.int32, "summary_impacts": np.int32,
}
_SEGMENT = ", ".join(f"{name} binary" for name in _KINDS)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of each pair, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def segment(ids: list, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> Segment:
    """Index some documents."""
    lengths = np.diff(starts)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    directions = np.random.default_rng(5).choice(np.array([-1.0, 1.0], np.float32), (4096, PROJECTION))
    points = np.zeros((len(lengths), PROJECTION), np.float32)
    held = np.flatnonzero(lengths)
    points[held] = np.add.reduceat(impacts[:, None].astype(np.float32) * directions[terms % 4096], starts[held])
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)

    by_term = np.argsort(terms, kind="stable")
    listed = rows[by_term]
    used, first, sizes = np.unique(terms[by_term], return_index=True, return_counts=True)
    members, block_sizes, block_terms = [], [], []
    for term, at, size in zip(used.tolist(), first.tolist(), sizes.tolist()):
        some = listed[at : at + size]
        if size > BLOCK:
            centres = points[some[:: BLOCK]]
            some = some[np.argsort((points[some] @ centres.T).argmax(1), kind="stable")]
        # Clusters one after another, cut into blocks of equal size.
        cuts = np.full(-(-size // BLOCK), BLOCK)
        cuts[-1] = size - BLOCK * (len(cuts) - 1)
        members.append(some)
        block_sizes.append(cuts)
        block_terms.append(np.full(len(cuts), term))
    members, block_sizes = np.concatenate(members), np.concatenate(block_sizes)
    member_starts = np.concatenate([[0], np.cumsum(block_sizes)])
    summed = np.repeat(sizes, -(-sizes // BLOCK)) >= SUMMED

    # Summaries: the maxima of a block in one array over all terms, of which the entries above zero are kept.
    largest = np.zeros(int(terms.max()) + 1, np.int64)
    summary_terms, summary_impacts = [], []
    for b, (at, size) in enumerate(zip(member_starts.tolist(), block_sizes.tolist())):
        held = np.zeros(0, np.int64)
        if summed[b]:
            some = members[at : at + size]
            own = _ranges(starts[some], lengths[some])
            np.maximum.at(largest, terms[own], impacts[own])
            held = np.flatnonzero(largest)
        summary_terms.append(held)
        summary_impacts.append(largest[held])
        largest[held] = 0
    return Segment(
        np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids]), starts, terms, impacts,
        np.concatenate(block_terms), member_starts, members,
        np.concatenate([[0], np.cumsum([len(t) for t in summary_terms])]), np.concatenate(summary_terms), np.concatenate(summary_impacts),
    )


def index(docs: DataFrame, statistics: Statistics) -> DataFrame:
    """Segments of counted documents, a row each; made where the documents lie, without a shuffle."""

    def made(ids: list, terms: list, impacts: list) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
        s = segment(ids, starts, np.concatenate(terms), np.concatenate(impacts))
        return pa.RecordBatch.from_arrays(
            [pa.array([np.asarray(getattr(s, name)).astype(kind).tobytes()], pa.binary()) for name, kind in _KINDS.items()], list(_KINDS)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        terms: list[np.ndarray] = []
        impacts: list[np.ndarray] = []
        postings = 0
        for batch in batches:
            for doc_id, length, held, tf in zip(*(batch[c].to_pylist() for c in ("doc_id", "length", "terms", "tf"))):
                tf = np.array(tf, np.int64)
                ids.append(doc_id)
                terms.append(np.array(held, np.int64))
                impacts.append(1_000_000_000 * tf // (1000 * tf + 8 * statistics.norm(length)))
                postings += len(held)
                if len(ids) >= SEGMENT or postings >= SEGMENT_POSTINGS:
                    yield made(ids, terms, impacts)
                    ids, terms, impacts, postings = [], [], [], 0
        if ids:
            yield made(ids, terms, impacts)

    return mapped(docs.filter(F.size("terms") > 0).select("doc_id", "length", "terms", "tf"), run, _SEGMENT)


# --- search --------------------------------------------------------------------------


class Best:
    """The k best documents found so far for one item: by score, null ids last, by id."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)
        self.ids = np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """Documents that score less are out; those without a score always are."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar
        if not good.any():
            return
        scores, no_id, ids = np.append(self.scores, scores[good]), np.append(self.no_id, no_id[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, no_id, -scores))[: self.k]
        self.scores, self.no_id, self.ids = scores[order], no_id[order], ids[order]


def _products(weights: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of ``weights`` with some sparse rows."""
    lengths = starts[rows + 1] - starts[rows]
    at = _ranges(starts[rows], lengths)
    sums = np.concatenate([[0], np.cumsum(weights[terms[at]] * impacts[at])])
    ends = np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths]


def largest(s: Segment, width: int) -> np.ndarray:
    """The largest impact of each term in a segment."""
    out = np.zeros(width, np.int64)
    np.maximum.at(out, s.terms, s.impacts)
    return out


def search(s: Segment, most: np.ndarray, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Put the best documents of a segment for one item into ``best``. ``weights`` has the item's weights, zero
    elsewhere; ``most`` the largest impact of each term."""
    # Block ranges of the lists of the item's terms, and the most each list can add to a score.
    begin, end = np.searchsorted(s.block_term, terms), np.searchsorted(s.block_term, terms, side="right")
    there = end > begin
    terms, begin, end = terms[there], begin[there], end[there]
    if not len(terms):
        return
    blocks = _ranges(begin, end - begin)
    bounds = _products(weights, s.summary_starts, s.summary_terms, s.summary_impacts, blocks)
    bounds[s.summary_starts[blocks + 1] == s.summary_starts[blocks]] = np.iinfo(np.int64).max
    list_starts = np.cumsum(end - begin) - (end - begin)
    own = most[terms] * weights[terms]
    seen = np.zeros(len(s.ids), bool)
    left = int(own.sum())
    for at in np.argsort(-own, kind="stable").tolist():
        if left < best.bar:
            return
        left -= int(own[at])
        those = slice(list_starts[at], list_starts[at] + end[at] - begin[at])
        order = np.argsort(-bounds[those], kind="stable")
        # A few blocks at first, more at a time as the bar rises.
        done, step = 0, 1
        while done < len(order):
            some = order[done : done + step]
            some = some[bounds[those][some] >= best.bar]
            if not len(some):
                break
            done, step = done + step, step * 2
            chosen = blocks[those][some]
            rows = s.members[_ranges(s.member_starts[chosen], s.member_starts[chosen + 1] - s.member_starts[chosen])]
            rows = rows[~seen[rows]]
            if len(rows):
                seen[rows] = True
                best.add(_products(weights, s.starts, s.terms, s.impacts, rows), s.no_id[rows], s.ids[rows])


@dataclass(frozen=True)
class Items:
    """Items of one block: their numbers, and the terms and weights of each. Bounded by the terms of a block."""

    numbers: list[int]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    width: int


def searched(segments: DataFrame, items: Broadcast, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each item over the segments of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Items = items.value
        best = [Best(k) for _ in asked.numbers]
        weights = np.zeros(asked.width, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):  # arrays over the batch's own memory
                s = Segment(*(np.frombuffer(batch[name][row].as_buffer(), kind) for name, kind in _KINDS.items()))
                most = largest(s, asked.width)
                for terms, own, found in zip(asked.terms, asked.weights, best):
                    weights[terms] = own
                    search(s, most, terms, weights, found)
                    weights[terms] = 0
        for number, found in zip(asked.numbers, best):
            if len(found.ids):
                ids = pa.array(found.ids, pa.int64(), mask=found.no_id)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number)), ids, pa.array(found.scores)], ["item", "doc_id", "score"])

    return mapped(segments, run, "item long, doc_id long, score long")


def _ranked_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = sorted(items.select("item", "terms").collect())
    names = sorted({t for _, terms in rows for t in terms})
    number = {t.encode(): n for n, t in enumerate(names)}
    documents = stored(counted(docs, spark.sparkContext.broadcast(number)), "counted")
    total = documents.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    statistics = Statistics(*total)
    holding = dict(documents.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weight = np.array([statistics.weight(holding.get(n, 0)) if statistics.documents else 0 for n in range(len(names))], np.int64)
    terms = [np.array([number[t.encode()] for t in terms], np.int64) for _, terms in rows]
    asked = Items([n for n, _ in rows], terms, [weight[t] for t in terms], len(names))
    segments = stored(index(documents, statistics), "segments", {**SMALL_ROW_GROUPS, "compression": "zstd"})
    return searched(segments, spark.sparkContext.broadcast(asked), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score."""
    numbered = _numbered_items(items)
    # As many numbers as passes over the documents.
    blocks = sorted(r["block"] for r in numbered.select("block").distinct().collect())
    found = [stored(_ranked_block(docs, numbered.filter(F.col("block") == b), k), "found") for b in blocks]
    if not found:
        return numbered.select("item_id", F.lit(1).alias("rank"), F.col("item").alias("doc_id"), F.col("item").alias("score")).limit(0)
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = all_found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the ten best documents of each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same by scoring every document that holds a term.
ORACLE = r"""
with split(kind, id, row, ts) as (
  select 'd', doc_id, row_number() over (), regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') from documents
  union all
  select 'i', item_id, row_number() over (), regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') from benchmark),
d as (select id as doc_id, row, ts, cast(len(ts) as bigint) as n from split where kind = 'd' and len(ts) > 0),
totals as (select count(*) as docs, cast(sum(n) as bigint) as terms from d),
postings as (select row, term, count(*) as tf from (select row, unnest(ts) as term from d) group by row, term),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from postings, totals group by term, docs),
asked as (select distinct id as item_id, row as item, unnest(ts) as term from split where kind = 'i'),
scored as (
  select item, item_id, row, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) as bigint) as score
  from asked join weights using (term) join postings using (term) join d using (row), totals
  group by item, item_id, row),
ranks as (
  select item_id, cast(row_number() over (partition by item order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
  from scored join d using (row) where score > 0)
select item_id, rank, doc_id, score from ranks where rank <= 10
"""
