"""Quality classifier by supervised subword embeddings.

A document is the average of vectors learned for its features: its words as they are written (case and
punctuation kept, both tell prose from junk), pairs of adjacent words (a word that follows itself is one
feature, whatever the word), and the 3 to 5 letter pieces of each word with its ends marked. Features are hashed into ``BUCKETS`` vectors of ``WIDTH`` numbers. A softmax over two
outputs gives the score. Vectors and output weights are learned together by stochastic gradient
descent, one document a step, the rate falling to zero.

``fit`` takes a bounded sample of labelled documents (``FIT_EACH`` rows a label, the first by hash of doc_id) to
the driver as feature counts; scoring covers all rows and whole texts. The sample is balanced, so 0.5 divides
the labels at equal odds. As the outputs are linear in the average, tasks score with one number a
bucket, and find the buckets of a whole text with array operations on its code points.

Defined results: a text without words, null or empty, has the score of the output biases alone. A feature
no fitted document holds counts as zero. Without labels of both kinds the score is 0.5 for every text. Labelled
rows without doc_id, or with a label other than 0 and 1, are left out; a doc_id labelled twice is fitted
twice. Repeated documents are scored each. A null doc_id is not held out. Texts are read in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import mapped, table
from candlewick.llm.words import text_pieces

FIT_EACH = 1000
BUCKETS = 1 << 17
WIDTH = 8
EPOCHS = 8
RATE = 0.5
PIECE_LETTERS = (3, 4, 5)

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64
)
#: The feature of a word that follows itself, whatever the word.
_ITSELF = 1


def _buckets(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _ODD[0]
    return (hashes >> np.uint64(40)) % np.uint64(BUCKETS)


def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all words, pairs and pieces of words of a text, with repeats, a piece of the text at a time."""
    last = None
    for piece in text_pieces(text or ""):
        words = " ".join(piece.split())
        if not words:
            continue
        # A space marks the ends of a word: a piece of a word may begin and end with one, and holds none inside.
        codes = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        space = codes == 32
        letters = (codes + np.uint64(1)) * _ODD[3]
        letters ^= letters >> np.uint64(31)
        spaces = np.cumsum(space)
        found = []
        window = letters[:-1] * _ODD[0] + letters[1:] * _ODD[1]
        for n in range(3, max(PIECE_LETTERS) + 1):
            window = window[:-1] + letters[n - 1 :] * _ODD[n - 1]
            if n in PIECE_LETTERS and len(window):
                found.append(window[spaces[n - 2 : len(spaces) - 1] == spaces[: len(window)]])
        starts = np.flatnonzero(space)
        place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
        powers = np.multiply.accumulate(np.full(place.max() + 1, _ODD[4]))
        hashes = np.add.reduceat((letters * powers[place])[:-1], starts[:-1])
        found.append(hashes)
        if last is not None:
            hashes = np.append(last, hashes)
        pairs = hashes[:-1] * _ODD[1] + (hashes[1:] ^ _ODD[2])
        found.append(np.where(hashes[:-1] == hashes[1:], np.uint64(_ITSELF), pairs))
        last = hashes[-1]
        yield _buckets(np.concatenate(found))


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text in rising order, and how often it holds each."""
    counts = np.zeros(BUCKETS, np.int64)
    for found in features(text):
        counts += np.bincount(found.astype(np.int64), minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass(frozen=True)
class Model:
    """Log-odds of label 1: ``bias`` plus the mean of ``weights`` over a text's features."""

    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may use: crc32 of doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(labels: DataFrame) -> DataFrame:
    """The rows a fit may use."""
    return labels.filter(~held_out(F.col("doc_id")))


def fit(docs: DataFrame, labels: DataFrame, each: int = FIT_EACH) -> Model:
    """A model from at most ``each`` labelled rows of either label, whole texts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = None
    for label in (0, 1):  # a bounded list of ids and labels, taken without moving other rows
        some = known.filter((F.col("quality") == label) & F.col("doc_id").isNotNull())
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        chosen = some if chosen is None else chosen.unionByName(some)
    sample = docs.sparkSession.createDataFrame(chosen.collect(), "doc_id long, quality int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, label, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "quality", "text"))):
                features, counts = bag(text)
                packed = [{"doc_id": i, "quality": label, "features": features.astype(np.int32).tobytes(), "counts": counts.astype(np.float32).tobytes()}]
                yield pa.RecordBatch.from_pylist(packed, schema=_arrow_bag)

    gathered = mapped(rows.select("doc_id", "quality", "text"), bags, "doc_id long, quality int, features binary, counts binary").toArrow()
    gathered = gathered.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    features = [np.frombuffer(b, np.int32) for b in gathered["features"].to_pylist()]
    counts = [np.frombuffer(b, np.float32) for b in gathered["counts"].to_pylist()]
    return train(features, counts, gathered["quality"].to_numpy())


_arrow_bag = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("features", pa.binary()), ("counts", pa.binary())])


def train(features: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Stochastic gradient descent on the log-likelihood of the labels under the softmax."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS), 0.0)
    rng = np.random.default_rng(seed)
    vectors = np.zeros((BUCKETS, WIDTH))  # what no document holds stays zero
    outputs = rng.normal(0, 1, (2, WIDTH))
    biases = np.zeros(2)
    shares = [c.astype(float) / c.sum() if len(c) else c.astype(float) for c in counts]
    steps, step = epochs * len(labels), 0
    for _ in range(epochs):
        for at in rng.permutation(len(labels)):
            now = rate * (1 - step / steps)
            step += 1
            used, share = features[at], shares[at]
            average = share @ vectors[used]
            logits = outputs @ average + biases
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[at]] -= 1  # the gradient of the loss by the logits
            # Shares are small numbers; a document's features move together by one rate.
            vectors[used] -= np.outer(share / share.max() if len(share) else share, now * (p @ outputs))
            outputs -= now * np.outer(p, average)
            biases -= now * 0.1 * p
    return Model(vectors @ (outputs[1] - outputs[0]), float(biases[1] - biases[0]))


def _log_odds(text: str | None, model: Model) -> float:
    total, number = 0.0, 0
    for found in features(text):
        total += float(model.weights[found].sum())
        number += len(found)
    return model.bias + (total / number if number else 0.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = np.array([_log_odds(t, sent.value) for t in batch["text"].to_pylist()], float)
            scores = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, run, "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: score and decision of every document; fitted without the held-out labels."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, labelled(table(spark, sf_dir, "labels")))
    return scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
