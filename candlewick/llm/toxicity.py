"""Toxicity by multiple-instance learning.

Only documents are labelled, so a document is a bag of sentences: each sentence has a
probability by logistic regression over its hashed word features, and the document's is
their noisy-or, 1 - prod(1 - p). The weights are fitted to the document labels through the
noisy-or, so the model learns which sentences make a document toxic and can point at them.

``fit`` takes a bounded sample of labelled documents (``FIT_POSITIVE`` and ``FIT_NEGATIVE``
rows, the first by hash of doc_id); the driver gets their features that toxic and clean documents hold at different rates. Scoring covers all rows and whole texts.

Defined results: null and empty texts have no sentence and score 0. A table without labels
of both kinds gives a model that scores every text 0. Labelled rows without doc_id or label
are left out; a doc_id labelled twice is fitted twice. Repeated documents are scored each. ``held_out`` is null
for a null doc_id, which no label can refer to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import mapped, stored, table

FIT_POSITIVE = 1500
FIT_NEGATIVE = 3000
BUCKETS = 1 << 18
#: Documents that hold a feature with a weight, at least.
LEAST = 4

_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?\n]+|$)")
_WORD = re.compile(r"\w+")

#: Words remembered per Python worker; the memory is emptied when it is full.
REMEMBERED = 400_000


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Ranges of the sentences that hold a word: they end at . ! ? or a line end."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if _WORD.search(m.group())]


def features(word: str) -> list[int]:
    """Buckets of a lower-case word and of its beginnings of four and five letters."""
    parts = {f"={word}", f"^{word[:4]}", f"^{word[:5]}"}
    return [xxhash.xxh32_intdigest(p) % BUCKETS for p in sorted(parts)]


def _bag(text: str) -> list[list[int]]:
    """Feature buckets of each sentence."""
    lowered = text.lower()
    return [
        sorted({f for w in set(_WORD.findall(lowered, a, b)) for f in features(w)}) for a, b in sentences(lowered)
    ]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, positive: int = FIT_POSITIVE, negative: int = FIT_NEGATIVE) -> Model:
    """A model from at most ``positive`` + ``negative`` labelled documents, whole texts."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).filter("doc_id is not null and toxic in (0, 1)")
    of_label = [known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for toxic, n in ((1, positive), (0, negative))]
    # Stored, so that the size of this short list is known where it is joined.
    sample = stored(of_label[0].unionByName(of_label[1]), "sample")
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], pa.array([_bag(t or "") for t in batch["text"].to_pylist()], pa.list_(pa.list_(pa.int32())))],
                ["doc_id", "toxic", "bag"],
            )

    schema = "doc_id long, toxic int, bag array<array<int>>"
    found = stored(mapped(rows.select("doc_id", "text", "toxic"), bags, schema), "bags")
    telling = _telling_of(found)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[[f for f in sentence if telling[f]] for sentence in bag] for bag in batch["bag"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(kept, pa.list_(pa.list_(pa.int32())))], ["doc_id", "toxic", "bag"])

    # The driver gets every sentence, with those of its features that can have a weight.
    gathered = mapped(found, told, schema).toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])
    return train(gathered["bag"].combine_chunks(), gathered["toxic"].to_numpy().astype(float))


def _telling(documents: np.ndarray, of_toxic: np.ndarray, n: int, toxic: float, least: int) -> np.ndarray:
    """Which features at least ``least`` of ``n`` documents hold, toxic and clean ones at clearly different rates; ``toxic`` is the share of toxic ones."""
    expected = documents * toxic
    spread = np.sqrt(np.maximum(expected * (1 - toxic) * (1 - documents / n), 1e-9))
    return (documents >= least) & (np.abs(of_toxic - expected) >= 2.5 * spread)


def _telling_of(bags: DataFrame) -> np.ndarray:
    """``_telling`` of the stored bags, whose features are counted by Spark; the driver gets two numbers a bucket."""
    of_label = {r["toxic"]: r["count"] for r in bags.groupBy("toxic").count().collect()}
    if len(of_label) < 2:
        return np.zeros(BUCKETS, bool)
    held = bags.select("toxic", F.explode(F.array_distinct(F.flatten("bag"))).alias("feature"))
    counts = held.groupBy("feature").agg(F.count("*").alias("n"), F.sum("toxic").alias("of_toxic")).filter(F.col("n") >= LEAST).toArrow()
    documents, of_toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS)
    at = counts["feature"].to_numpy()
    documents[at], of_toxic[at] = counts["n"].to_numpy(), counts["of_toxic"].to_numpy()
    n = sum(of_label.values())
    return _telling(documents, of_toxic, n, of_label[1] / n, LEAST)


def train(
    bags: pa.ListArray, labels: np.ndarray, epochs: int = 300, rate: float = 0.1, sparsity: float = 3e-4, least: int = LEAST
) -> Model:
    """Proximal Adam on the log-likelihood of the document labels under noisy-or, all documents at each step.

    Only features that at least ``least`` documents hold, and that toxic and clean documents
    hold at clearly different rates, can have a weight; ``sparsity`` is the price of one, which
    keeps words that merely stand in some toxic documents at zero.
    """
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS), -np.inf)
    per_bag = bags.value_lengths().to_numpy().astype(np.int64)
    flat = bags.flatten()
    per_sentence, words = flat.value_lengths().to_numpy().astype(np.int64), flat.flatten().to_numpy().astype(np.int64)
    sentence = np.repeat(np.arange(len(per_sentence)), per_sentence)
    bag = np.repeat(np.arange(len(per_bag)), per_bag)
    pairs = np.unique(bag[sentence] * BUCKETS + words)
    documents = np.bincount(pairs % BUCKETS, minlength=BUCKETS)
    of_toxic = np.bincount(pairs % BUCKETS, labels[pairs // BUCKETS], BUCKETS)
    often = _telling(documents, of_toxic, len(labels), labels.mean(), least)[words]
    sentence, words = sentence[often], words[often]
    used, column = np.unique(words, return_inverse=True)
    w, b = np.zeros(len(used)), -5.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for epoch in range(1, epochs + 1):
        logit = np.bincount(sentence, w[column], len(per_sentence)) + b
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        clean = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-9)), len(per_bag))  # log of the chance of no toxic sentence
        toxic = -np.expm1(clean)
        # d log-likelihood / d logit: -p for a clean document, p (1 - P) / P for a toxic one.
        share = np.where(labels == 1, np.exp(clean) / np.maximum(toxic, 1e-9), -1.0)
        slope = p * share[bag] / len(labels)
        gradient = np.append(np.bincount(column, slope[sentence], len(used)), slope.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = rate / (np.sqrt(v / (1 - 0.999**epoch)) + 1e-6)
        move = step * m / (1 - 0.9**epoch)
        w = w + move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - step[:-1] * sparsity, 0)
        b = b + move[-1]
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(weights, float(b))


class _Weights(dict):
    """Weight of a lower-case word, remembered."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = weight = float(self.model.weights[sorted(set(features(word)))].sum())
        return weight


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, sentences): the sentences whose own probability is at least 0.5, as (from, to, probability)
    in characters of the text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = _Weights(sent.value), sent.value.bias
        for batch in batches:
            scores, places = [], []
            for text in batch["text"].to_pylist():
                score, found = _score(text or "", weights, bias)
                scores.append(score)
                places.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64()), pa.array(places, _PLACES)], ["doc_id", "score", "sentences"]
            )

    schema = "doc_id long, score double, sentences array<struct<start: long, stop: long, p: double>>"
    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = _Weights(sent.value), sent.value.bias
        for batch in batches:
            yield batch.filter(pa.array([_score(t or "", weights, bias)[0] < 0.5 for t in batch["text"].to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_PLACES = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))


def _score(text: str, weights: _Weights, bias: float) -> tuple[float, list[dict]]:
    # Lower-casing may change the length of a text; then ranges are taken sentence by sentence.
    spans = [(m.start(), m.end(), m.group()) for m in _SENTENCE.finditer(text)]
    words = [set(_WORD.findall(s.lower())) for _, _, s in spans]
    kept = [i for i, w in enumerate(words) if w]
    if not kept:
        return 0.0, []
    logits = np.array([sum(sorted(map(weights.__getitem__, words[i]))) for i in kept]) + bias
    p = np.where(np.isneginf(logits), 0.0, 1 / (1 + np.exp(-np.clip(logits, -30, 30))))
    places = [
        {"start": spans[kept[i]][0], "stop": spans[kept[i]][1], "p": float(p[i])} for i in np.flatnonzero(p >= 0.5)
    ]
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), places


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may use: crc32 of doc_id as text divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled(labels: DataFrame) -> DataFrame:
    """The rows a fit may use."""
    return labels.filter(~held_out(F.col("doc_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: score and decision of every document; fitted without the held-out labels."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, labelled(table(spark, sf_dir, "labels")))
    return scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
