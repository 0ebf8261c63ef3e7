"""Token-id files: documents as ids in blocks of the adaptive range coder.

``write`` encodes each text, appends an end id and stores the ids of all documents in
ascending order of doc_id. Storage is Parquet (so that Spark's writer commits whole files
and lost executors are replayed); a row is one block of ``rangecoder`` with the ids and
lengths of the documents it holds, and can be decoded alone. A document longer than a block
continues in the next one. ``read`` gives back the documents' pieces with their ids.

Defined results: a null or empty text is its end id alone. Repeated doc_ids stay separate
documents, ordered by text (null first). Null doc_ids come first. An empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.bpe import vocabulary
from candlewick.llm.common import looked_up, mapped, part_offsets, shared_folder, table
from candlewick.llm.rangecoder import BLOCK, decode_block, encode_block

#: Words remembered per Python worker; the memory is emptied when it is full.
REMEMBERED = 600_000

BLOCK_SCHEMA = (
    "part int, block int, doc_ids array<long>, docs array<long>, pieces array<long>, lengths array<long>, ids binary"
)
PIECE_SCHEMA = "part int, doc long, piece long, doc_id long, ids array<long>"

_TOKENIZERS: dict[str, _Words] = {}


class _Words:
    """Ids of texts by the tokenizers library, which sees each distinct word once.

    A text is cut at blanks and line ends. That gives the ids of the whole text where the
    vocabulary drops white space, as its pre-tokenizer then ends every word there;
    ``drops_white_space`` tells so, and other vocabularies see whole texts. New words go to the library
    in lines, a ``MARK`` between two of them, whose id tells where a word's ids end.
    """

    def __init__(self, vocabulary_text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = self.tokenizer.get_vocab_size(with_added_tokens=True)
        probe = ["a", "b.c", "Ab", "1"]
        self.drops_white_space = self._library([" ".join(probe), "\n".join(probe), " \n "]) == [
            [i for ids in self._library(probe) for i in ids]
        ] * 2 + [[]]
        mark = self._library([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # ids of all words, and where each one's begin

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        parts, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for first in range(0, len(words), _LINE):
            line = words[first : first + _LINE]
            if self.mark is not None:
                ids = np.array(self._library([_BETWEEN.join(line)])[0], np.uint32)
                marks = np.flatnonzero(ids == self.mark)
                if len(marks) == len(line) - 1:  # else the words have marks of their own
                    parts.append(np.delete(ids, marks))
                    sizes.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
                    continue
            each = self._library(line)
            parts.append(np.fromiter(chain.from_iterable(each), np.uint32))
            sizes.append(np.array([len(ids) for ids in each], np.int64))
        return np.concatenate(parts), np.concatenate(sizes)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.drops_white_space:
            return [np.array(ids, np.uint32) for ids in self._library(texts)]
        if len(self.known) > REMEMBERED:
            self._forget()
        return [ids for part in _in_parts(texts) for ids in self._encode(part)]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        before = len(self.known)
        words = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        if len(self.known) > before:
            ids, sizes = self._ids_of(list(islice(self.known, before, None)))
            self.at = np.concatenate((self.at, len(self.ids) + np.cumsum(sizes)))
            self.ids = np.concatenate((self.ids, ids))
        begins = self.at[words]
        sizes = self.at[words + 1] - begins
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(ends[-1]) + np.repeat(begins - ends + sizes, sizes)]
        return np.split(ids, ends[np.cumsum([len(words) for words in split])[:-1] - 1])


class _Numbers(dict):
    """Words by the order in which they came."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


#: Stands between words that the library sees together; U+0001 is no white space and no part of a word in texts.
MARK = "\x01"
_BETWEEN = f" {MARK} "
_LINE = 512


def _in_parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts of some ``_AT_ONCE`` characters together; a longer one is with those before it."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= _AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


_AT_ONCE = 1 << 20


def _words(vocabulary_text: str) -> _Words:
    if vocabulary_text not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[vocabulary_text] = _Words(vocabulary_text)
    return _TOKENIZERS[vocabulary_text]


def write(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int) -> str:
    """Write the ids of ``docs`` (doc_id, text) below ``folder``; returns the path of the files."""
    spark = docs.sparkSession
    text = vocabulary(vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        words, part = _words(text), TaskContext.get().partitionId()
        held: list[tuple] = []  # (doc_id, doc, piece, ids) of the block being filled
        size = block = doc = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, block
            ids = np.concatenate([h[3] for h in held])
            row = {
                "part": part, "block": block, "doc_ids": [h[0] for h in held], "docs": [h[1] for h in held],
                "pieces": [h[2] for h in held], "lengths": [len(h[3]) for h in held], "ids": encode_block(ids, words.alphabet),
            }
            held, size, block = [], 0, block + 1
            return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)

        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.encode(texts)):
                ids, piece = np.append(ids, np.uint32(end_id)), 0
                while len(ids):
                    now, ids = ids[: BLOCK - size], ids[BLOCK - size :]
                    held.append((doc_id, doc, piece, now))
                    size += len(now)
                    piece += 1
                    if size == BLOCK:
                        yield flush()
                doc += 1
        if held:
            yield flush()

    path = f"{folder}/ids"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(parts, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    mapped(ordered, run, BLOCK_SCHEMA).write.parquet(path)
    return path


_ARROW_BLOCK = pa.schema(
    [("part", pa.int32()), ("block", pa.int32())]
    + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "docs", "pieces", "lengths")]
    + [("ids", pa.binary())]
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_block(row["ids"])
            yield row, ids, np.cumsum([0, *row["lengths"]])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored pieces of documents with their ids; ``part`` and ``doc`` give the order, ``piece`` that of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, cuts in _pieces(batches):
            n = len(row["docs"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array(row["docs"], pa.int64()), pa.array(row["pieces"], pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(cuts.astype(np.int32), ids.astype(np.int64))],
                ["part", "doc", "piece", "doc_id", "ids"],
            )

    return mapped(spark.read.schema(BLOCK_SCHEMA).parquet(path), run, PIECE_SCHEMA)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document, from its decoded ids.

    ``start`` counts the ids of all documents before it. The checksums of a document's
    pieces are combined in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, cuts in _pieces(batches):
            n = len(row["docs"])
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
            # Only the ends of a block can belong to a document that has more pieces.
            shifts = [_power(4 * m) if i in (0, n - 1) else 0 for i, m in enumerate(row["lengths"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array(row["docs"], pa.int64()), pa.array(row["pieces"], pa.int64()),
                 pa.array(row["doc_ids"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array(shifts, pa.int64())],
                ["part", "doc", "piece", "doc_id", "n", "crc", "shift"],
            )

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    lengths = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    offsets = part_offsets(blocks.select(F.col("part").alias("_part"), lengths.alias("n")), F.sum("n"))
    pieces = mapped(blocks, run, "part int, doc long, piece long, doc_id long, n long, crc long, shift long")

    from pyspark.sql import Window

    before = Window.partitionBy("part").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("piece", "crc", "shift"))).alias("found"),
    )
    return whole.select(
        "doc_id",
        (F.coalesce(F.sum("n_tokens").over(before), F.lit(0)) + looked_up(offsets, F.col("part"))).alias("start"),
        "n_tokens",
        F.when(F.size("found") == 1, F.col("found")[0]["crc"]).otherwise(F.expr(_COMBINED)).alias("ids_crc32"),
    )


#: The checksum of ``found``, a document's pieces in order: as ``crc_of_pieces``, with the product bit by bit.
_PRODUCT = """aggregate(sequence(31, 0, -1), named_struct('p', 0L, 'b', x.shift), (s, bit) -> named_struct(
    'p', if(shiftright(crc, bit) & 1L = 1L, s.p ^ s.b, s.p),
    'b', if(s.b & 1L = 1L, shiftright(s.b, 1) ^ 3988292384L, shiftright(s.b, 1))), s -> s.p)"""
_COMBINED = f"aggregate(found, 0L, (crc, x) -> {_PRODUCT} ^ x.crc)"


def crc_of_pieces(pieces: list[tuple[int, int]]) -> int:
    """The crc32 of ids whose consecutive pieces have the given (crc32, number of 4-byte ids)."""
    crc = 0
    for own, n in pieces:
        crc = _times(crc, _power(4 * n)) ^ own
    return crc


def _power(n: int) -> int:
    """x^(8n), by repeated squaring: the factor that moves a crc32 on by n zero bytes."""
    power, factor = 0x80000000, 0x00800000  # x^0 and x^8, bits reversed
    while n:
        if n & 1:
            power = _times(power, factor)
        factor = _times(factor, factor)
        n >>= 1
    return power


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of crc32, bits reversed."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: start, length and checksum of each document's ids, read back from the files."""
    import uuid

    import public_tokenizers

    folder = f"{shared_folder(spark)}/candlewick/{uuid.uuid4().hex}"
    path = write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return digests(spark, path)
