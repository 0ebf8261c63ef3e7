"""Grouping of spelling variants: words that one inserted, deleted or replaced letter turns into each other.

Words are counted over whole texts. Every word is then a vector of letter counts. For two words one edit
apart the squared distance of these vectors is 1 (a letter more) or 2 (a letter replaced), so only
pairs at distance at most two are verified letter by letter. The distances of two blocks of words are one
Gram matrix, |a|^2 + |b|^2 - 2 a.b, a NumPy product of the blocks.

Blocks hold words of one length, further divided by how many of their letters fall into each of ``GROUPS``
letter groups. An edit changes one of these counts by one (then the length differs by one as well), or moves
one letter from a group to another, or changes none. So a block meets itself, the blocks with one letter
more in one group, and those with one letter moved; no other block can hold a near word. Blocks have about
``BLOCK`` words at most, larger ones are divided by hash and meet in pairs of parts.

Of a pair of blocks a task returns one row a word (how many near words, the best of them), never the pairs.

Defined results: null and empty texts have no words. A null doc_id counts as an empty text in the
letter drop. Repeated rows count each. Words are compared in code-point order where counts tie.
An empty table gives no rows. Texts are read in pieces, so a long one needs no more memory than a piece and its words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import mapped, stored, table
from candlewick.llm.words import pieces

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: One (document, word) pair in so many loses a letter.
DROP = 97
GROUPS = 6
BLOCK = 1024
#: Counts held by a task before they are handed on.
HELD = 200_000

# Latin-1 byte -> itself as a letter (A-Z lowered), or a space. Characters beyond Latin-1 are encoded as "?", no letter.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
# Number of a letter in the count vectors, and its group; frequent letters are dealt to different groups.
_NUMBER = np.array([c - 97 if 97 <= c <= 122 else c - 0xC0 + 26 if c >= 0xC0 else 0 for c in range(256)], np.int64)
_ALPHABET = 26 + 64
_FREQUENT_FIRST = "etaoinshrdlcumwfgypbvkjxqz"
_GROUP = np.array([_FREQUENT_FIRST.index(chr(c)) % GROUPS if 97 <= c <= 122 else c % GROUPS for c in range(256)], np.int64)


def _counted(doc_id: int | None, text: str, drop: int) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences) of a text, after the letter drop; words that are too short are left out."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    runs: Counter[bytes] = Counter()
    for piece in pieces(text.encode("latin-1", "replace").translate(_LETTERS)):
        runs.update(piece.split())
    for run, n in runs.items():
        if len(run) < LEAST_LETTERS:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % drop == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        yield run, n


def word_counts(docs: DataFrame, drop: int = DROP) -> DataFrame:
    """(word, n): occurrences over all texts. Tasks and Spark's partial sums combine before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                for word, n in _counted(doc_id, text or "", drop):
                    held[word] += n
                if len(held) > HELD:
                    yield _sums(held)
                    held.clear()
        yield _sums(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _sums(held: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
    )


def cell_of(word: str) -> str:
    """The number of letters in each group, the name of the word's block."""
    return ".".join(map(str, np.bincount(_GROUP[np.frombuffer(word.encode("latin-1"), np.uint8)], minlength=GROUPS)))


def neighbours(cell: str) -> Iterator[str]:
    """The cell itself, those with a letter more, and those with a letter moved to an earlier group.

    Every two cells that can hold near words are met from one side.
    """
    counts = [int(c) for c in cell.split(".")]
    yield cell
    for i in range(GROUPS):
        counts[i] += 1
        yield ".".join(map(str, counts))
        for j in range(i + 1, GROUPS):
            if counts[j]:
                counts[j] -= 1
                yield ".".join(map(str, counts))
                counts[j] += 1
        counts[i] -= 1


def _celled(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pa.array([cell_of(w) for w in batch["word"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], cells], ["word", "n", "cell"])

    return mapped(words.select("word", "n"), run, "word string, n long, cell string")


_BLOCK = "cell string, sub long, length int, codes binary, counts binary"


def _blocks(words: DataFrame) -> DataFrame:
    """Words (word, n, cell) as packed blocks: the letters of all words, and their counts."""
    sizes = words.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / BLOCK)
    subs = words.join(sizes, "cell").withColumn("sub", F.pmod(F.xxhash64("word"), parts))
    listed = subs.repartition("cell", "sub").groupBy("cell", "sub").agg(F.collect_list(F.struct("word", "n")).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                words = [w["word"].encode("latin-1") for w in row["words"]]
                counts = np.array([w["n"] for w in row["words"]], np.int64)
                rows.append(
                    {"cell": row["cell"], "sub": row["sub"], "length": len(words[0]), "codes": b"".join(words), "counts": counts.tobytes()}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow_block)

    return mapped(listed, run, _BLOCK)


_arrow_block = pa.schema(
    [("cell", pa.string()), ("sub", pa.int64()), ("length", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())]
)


def _targeted(blocks: DataFrame) -> DataFrame:
    """Each block once for every cell that it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = [list(neighbours(c)) for c in batch["cell"].to_pylist()]
            index = pa.array(np.repeat(np.arange(len(met)), [len(m) for m in met]))
            columns = [batch[name].take(index) for name in ("cell", "sub", "length", "codes", "counts")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for m in met for c in m], pa.string()), *columns],
                ["target", "own", "own_sub", "own_length", "own_codes", "own_counts"],
            )

    return mapped(blocks, run, "target string, own string, own_sub long, own_length int, own_codes binary, own_counts binary")


def letter_counts(codes: np.ndarray) -> np.ndarray:
    n = len(codes)
    at = np.arange(n)[:, None] * _ALPHABET + _NUMBER[codes]
    return np.bincount(at.ravel(), minlength=n * _ALPHABET).reshape(n, _ALPHABET).astype(np.float32)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all rows of two blocks of letter counts, exact: single precision holds the terms of words of up to 2,000 letters."""
    if max(a[0].sum(), b[0].sum()) > 2000:
        a, b = a.astype(np.float64), b.astype(np.float64)
    gram = a @ b.T
    gram *= -2
    gram += (a * a).sum(1)[:, None]
    gram += (b * b).sum(1)[None, :]
    return gram


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words in equal rows differ by one edit; words of ``b`` are as long as those of ``a`` or one letter longer."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(1) == 1
    # Equal up to some place, and equal from there with b shifted by one.
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= length


def _near_pairs(a: np.ndarray, b: np.ndarray, b_letters: np.ndarray, same: slice) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near words of ``a`` and ``b``, whose letter counts are given. The rows ``same`` of ``a`` are
    ``b`` itself; of these each pair is found once."""
    i, j = np.nonzero(squared_distances(letter_counts(a), b_letters) <= 2)
    new = (i < same.start) | (i >= same.stop) | (i - same.start < j)
    i, j = i[new], j[new]
    near = np.concatenate([one_edit(a[i[k : k + 65536]], b[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
    return i[near], j[near]


def _best(of: np.ndarray, partners: np.ndarray, codes: np.ndarray, p_codes: np.ndarray, p_counts: np.ndarray) -> Iterator[tuple]:
    """(word, near words, best one's count, best one) of each word in ``of``."""
    # Words of one length order by their letters.
    used, partners = np.unique(partners, return_inverse=True)
    order = np.lexsort((*p_codes[used].T[::-1], -p_counts[used]))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    by = np.argsort(of, kind="stable")
    rows, first, n = np.unique(of[by], return_index=True, return_counts=True)
    best = used[order[np.minimum.reduceat(place[partners[by]], first)]]
    for row, count, partner in zip(rows.tolist(), n.tolist(), best.tolist()):
        yield codes[row].tobytes().decode("latin-1"), count, int(p_counts[partner]), p_codes[partner].tobytes().decode("latin-1")


def _gathered(rows: list[dict], target: tuple) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """Own blocks of one length put together, in bounded numbers of words: letters, counts, the rows that are the target's own."""
    by_length: dict[int, list[dict]] = {}
    for row in rows:
        by_length.setdefault(row["own_length"], []).append(row)
    for length, some in by_length.items():
        codes, counts, n, same = [], [], 0, slice(0, 0)
        for row in some:
            codes.append(row["own_codes"])
            counts.append(row["own_counts"])
            words = len(row["own_counts"]) // 8
            if (row["own"], row["own_sub"]) == target:
                same = slice(n, n + words)
            n += words
            if n >= 4 * BLOCK or row is some[-1]:
                yield np.frombuffer(b"".join(codes), np.uint8).reshape(-1, length), np.frombuffer(b"".join(counts), np.int64), same
                codes, counts, n, same = [], [], 0, slice(0, 0)


def _scan(pairs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            groups: dict[tuple, list[dict]] = {}
            for row in batch.to_pylist():
                groups.setdefault((row["target"], row["sub"]), []).append(row)
            for target, rows in groups.items():
                b = np.frombuffer(rows[0]["codes"], np.uint8).reshape(-1, rows[0]["length"])
                b_counts, b_letters = np.frombuffer(rows[0]["counts"], np.int64), letter_counts(b)
                for a, a_counts, same in _gathered(rows, target):
                    i, j = _near_pairs(a, b, b_letters, same)
                    if len(i):
                        found += _best(i, j, a, b, b_counts)
                        found += _best(j, i, b, a, a_counts)
            columns = list(zip(*found)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "near", "best_n", "best"])

    return mapped(pairs, run, "word string, near long, best_n long, best string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word that has a near one; ``best`` is the most frequent near word, the least of equals."""
    blocks = stored(_blocks(stored(_celled(words), "celled")), "blocks")
    met = _targeted(blocks).join(blocks.withColumnRenamed("cell", "target"), "target")
    met = met.filter((F.col("own") != F.col("target")) | (F.col("own_sub") <= F.col("sub")))
    # Neighbours in the order of the rows share the Gram matrix of their target.
    found = _scan(met.sortWithinPartitions("target", "sub"))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    each = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    return each.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of the chain of forms.

    Every round doubles the length of the known steps. A form occurs at least twice as often as its word, so
    chains are no longer than the binary logarithm of the largest count, and rounds few.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "steps")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, drop: int = DROP) -> DataFrame:
    """Every word of at least ``least_count`` occurrences with its form, the root of its form, and their counts."""
    words = stored(word_counts(docs, drop).filter(F.col("n") >= least_count), "words")
    all_words = words.join(near_words(words), "word", "left")
    form = F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best"))
    formed = stored(all_words.withColumns({"form": form, "form_n": F.when(form.isNotNull(), F.col("best_n"))}), "formed")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the words of all documents with their forms and roots."""
    return variants(table(spark, sf_dir, "documents"))
