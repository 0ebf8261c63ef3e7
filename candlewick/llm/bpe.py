"""Byte-level BPE by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can never be joined by
merges, so a text may be cut wherever such a pair stands. The pieces are encoded one by
one and their ids concatenated; equal pieces are encoded once per Python worker, and
those that are new in some text are merged together in numpy.

Defined results: a null or empty text has no ids and decodes to ''. Repeated rows and
repeated doc_ids are encoded row by row. Other columns are ignored. A piece of any length
is merged in O(n log n).
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers.pre_tokenizers import ByteLevel

from candlewick.llm.common import mapped, table

# The pre-tokenizer pattern of the byte-level format.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# A blank between two visible characters, and both sides of a line end between two visible
# characters, are cuts of the pattern above whatever stands around them. The blank is a forced
# boundary as well after a character whose last byte precedes it in no token. A text with
# anything else about white space is cut by the pattern alone.
_OTHER_SPACE = re.compile(r"[^\S \n]")

_NONE = 1 << 62
_SHORT = 48

#: Pieces remembered per Python worker; the memory is emptied when it is full.
REMEMBERED = 400_000
#: Characters of text whose words are looked up, and merged if they are new, together.
AT_ONCE = 1 << 20


@lru_cache(1)
def _unsettled() -> re.Pattern:
    """The code points without a class in Python's tables, among which the splitter's tables are the newer or the older ones."""
    none = [c for c in range(0x110000) if category(chr(c)) == "Cn"]
    first = [c for c, before in zip(none, [-1, *none]) if c != before + 1]
    last = [c for c, after in zip(none, [*none[1:], -1]) if c != after - 1]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(first, last)) + "]")


def byte_symbols() -> list[str]:
    """The printable character the byte-level format writes for each byte value."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library."""

    def __init__(self, text: str):
        spec = json.loads(text)
        byte_of = {symbol: value for value, symbol in enumerate(byte_symbols())}
        plain = {t: bytes(byte_of[c] for c in t) for t in spec["model"]["vocab"] if all(c in byte_of for c in t)}
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] or []}
        self.bytes_of = {ids[t]: b for t, b in plain.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.single = {b[0]: ids[t] for t, b in plain.items() if len(b) == 1}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.result = [ids[a + b] for a, b in merges]
        self.joined = np.zeros((256, 256), bool)  # byte pairs that stand inside a token
        for token in plain.values():
            self.joined[list(token[:-1]), list(token[1:])] = True
        kept = [chr(c) for c in range(0x2000) if self.joined[chr(c).encode()[-1], 32] and not chr(c).isspace()]
        after = "".join(kept) + ("\u2000-\U0010ffff" if kept else "")
        self.after = re.compile(f"[{after}] ") if after else None
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        # The same for arrays: pairs as one number, sorted; ranks and results by place and rank.
        self.stride = max(ids.values()) + 2
        self.single_ids = np.array([self.single.get(b, 0) for b in range(256)], np.int64)
        pairs = sorted((a * self.stride + b, rank) for (a, b), rank in self.rank.items())
        self.pair_keys, self.pair_ranks = np.array(pairs or [(-1, _NONE)], np.int64).T.copy()
        self.results = np.array(self.result, np.int64)
        self.byte_ranks = self._ranks(np.repeat(self.single_ids, 256), np.tile(self.single_ids, 256)).reshape(256, 256)
        self.symbols = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of) + 1)], pa.large_binary())
        self.inside = {bytes(pair) for pair in np.argwhere(self.joined).astype(np.uint8)}
        # Remembered words by number; their ids stand in ``ids`` from ``first`` on.
        self.known: dict[str, int] = {}
        self._forget()

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].as_py()

    def encode_all(self, texts: list[str]) -> pa.ListArray:
        """Ids of each text; words not remembered are merged together, a step of all of them at a time."""
        keys = [self._keys(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = list(set(chain.from_iterable(keys)).difference(self.known))
        if new:
            self._learn(new)
        ends = np.cumsum([0, *map(len, keys)])
        word = np.fromiter(map(self.known.__getitem__, chain.from_iterable(keys)), np.int64, ends[-1])
        first, count = self.first[word], self.count[word]
        # The first word of a text in words and lines has no line end before it.
        leading = ends[:-1][[bool(k) and k[0][0] == "\n" for k in keys]]
        first[leading] += 1
        count[leading] -= 1
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return pa.ListArray.from_arrays(pa.array(total[ends], pa.int32()), pa.array(ids, pa.int32()))

    def _forget(self) -> None:
        self.known.clear()
        self.first, self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _remember(self, words: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(count) - count))
        self.count, self.ids = np.concatenate((self.count, count)), np.concatenate((self.ids, ids.astype(np.int32)))

    def _keys(self, text: str) -> list[str]:
        """What ``text`` is looked up by: its words, the first ones of lines with a line end before them; of a text with unusual
        white space the pieces of the pattern after a tab, and special tokens after a vertical tab."""
        if not text:
            return []
        if not _OTHER_SPACE.search(text) and not (self.after and self.after.search(text)):
            lines = [line.split(" ") for line in text.split("\n")]
            if not any("" in line for line in lines):
                for line in lines:
                    line[0] = "\n" + line[0]
                return list(chain.from_iterable(lines))
        keys, at = [], 0
        for found in self.split_special.finditer(text):
            keys += ["\t" + w for w in self._split(text[at : found.start()])] + ["\v" + found.group()]
            at = found.end()
        return keys + ["\t" + w for w in self._split(text[at:])]

    def _split(self, piece: str) -> list[str]:
        """The words of the pattern; the library's own splitter decides about code points that the tables here do not know."""
        if piece.isascii() or not _unsettled().search(piece):
            return _WORDS.findall(piece)
        return [piece[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(piece)]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of ``words``, keys that are not known yet."""
        parts: list[str] = []
        counts: list[int] = []
        merged: list[str] = []
        special: dict[str, list[int]] = {}
        for word in words:
            mark = word[0]
            if mark == "\v":
                special[word] = [self.special[word[1:]]]
                continue
            before = len(parts)
            if mark == "\t":
                parts.append(word[1:])
            else:
                if mark == "\n":
                    parts.append("\n")
                    body = bare = word[1:]
                else:
                    body, bare = " " + word, word
                if bare.isalpha():
                    parts.append(body)
                elif bare[-1] in ",." and bare[:-1].isalpha():  # a letter and a punctuation mark are always parted
                    parts += (body[:-1], body[-1])
                elif self.split_special.search(body):
                    del parts[before:]
                    special[word] = [*([self.single[10]] if mark == "\n" else []), *self._encode_piece(body)]
                    continue
                else:
                    parts += self._split(body)
            merged.append(word)
            counts.append(len(parts) - before)
        if special:
            ids = list(special.values())
            self._remember(list(special), np.array(list(chain.from_iterable(ids)), np.int64), np.array([len(i) for i in ids]))
        if merged:
            ids, per_part = self.merged_all([w.encode() for w in parts])
            self._remember(merged, ids, np.add.reduceat(per_part, np.cumsum(counts) - counts))

    def merged_all(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty byte strings, one after the other, and their number for each.

        All are cut at forced boundaries first. Then each fragment makes its merge of lowest rank, the leftmost
        of equal ones, in each step, as in ``_merged``.
        """
        flat = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(lengths) - lengths
        cut = np.ones(len(flat), bool)
        np.logical_not(self.joined[flat[:-1], flat[1:]], out=cut[1:])
        cut[starts] = True
        at = np.flatnonzero(cut)
        size = np.diff(np.append(at, len(flat)))
        out = np.full(len(flat), -1, np.int64)
        out[at[size == 1]] = self.single_ids[flat[at[size == 1]]]
        low = 1
        for width in (6, 10, 16, _SHORT):
            of_width = (size > low) & (size <= width)
            self._merge_in_step(flat, at[of_width], size[of_width], width, out)
            low = width
        for start, n in zip(at[size > _SHORT].tolist(), size[size > _SHORT].tolist()):
            ids = self._merged(flat[start : start + n].tobytes())
            out[start : start + len(ids)] = ids
        there = out >= 0
        return out[there], np.add.reduceat(there, starts, dtype=np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.stride + right
        place = np.searchsorted(self.pair_keys, keys)
        place[place == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[place] == keys, self.pair_ranks[place], _NONE)

    def _merge_in_step(self, flat: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, out: np.ndarray) -> None:
        """Write the ids of the fragments of at most ``width`` bytes at ``at`` to ``out``, from the places where they begin."""
        none = self.stride - 1  # stands behind a fragment's last id
        columns = np.arange(width + 1)
        held = columns < size[:, None]
        values = flat[np.minimum(at[:, None] + columns, len(flat) - 1)]
        ids = np.where(held, self.single_ids[values], none)
        ranks = np.where(held[:, 1:], self.byte_ranks[values[:, :-1], values[:, 1:]], _NONE)
        ranks = np.concatenate((ranks, np.full((len(ranks), 1), _NONE)), axis=1)
        while len(at):
            where = ranks.argmin(axis=1)
            best = np.take_along_axis(ranks, where[:, None], 1)[:, 0]
            over = best == _NONE
            if over.any():
                done = ids[over]
                there = done != none
                out[(at[over][:, None] + columns)[there]] = done[there]
                left = ~over
                at, ids, ranks, where, best = at[left], ids[left], ranks[left], where[left], best[left]
                if not len(at):
                    break
            rows = np.arange(len(at))
            # The second id of the pair goes and what follows moves up; the last column is always empty.
            moved = np.minimum(columns + (columns > where[:, None]), width)
            ids, ranks = np.take_along_axis(ids, moved, 1), np.take_along_axis(ranks, moved, 1)
            joint = self.results[best]
            ids[rows, where] = joint
            ranks[rows, where] = self._ranks(joint, ids[rows, where + 1])
            inner = np.flatnonzero(where > 0)
            before = where[inner] - 1
            ranks[inner, before] = self._ranks(ids[inner, before], joint[inner])

    def _encode_piece(self, piece: str) -> list[int]:
        ids, at = [], 0
        for found in self.split_special.finditer(piece):
            ids += self._encode_plain(piece[at : found.start()])
            ids.append(self.special[found.group()])
            at = found.end()
        return ids + self._encode_plain(piece[at:])

    def _encode_plain(self, piece: str) -> list[int]:
        return [i for word in self._split(piece) for i in self._encode_word(word)]

    def _encode_word(self, word: str) -> list[int]:
        return [i for part in self.fragments(word.encode()) for i in self._merged(part)]

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut at every byte pair that no token holds."""
        inside = self.inside
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def _merged_short(self, ids: list[int]) -> list[int]:
        """The same merges by scanning for the lowest rank, which is faster on a few ids."""
        get, result = self.rank.get, self.result
        pairs = [get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != _NONE:
            at = pairs.index(best)
            ids[at : at + 2] = [result[best]]
            del pairs[at]
            if at:
                pairs[at - 1] = get((ids[at - 1], ids[at]), _NONE)
            if at < len(pairs):
                pairs[at] = get((ids[at], ids[at + 1]), _NONE)
        return ids

    def _merged(self, fragment: bytes) -> list[int]:
        """Merges in order of rank, leftmost first, over a doubly linked list."""
        ids: list[int | None] = [self.single[b] for b in fragment]
        n, rank = len(ids), self.rank
        if n <= _SHORT:
            return self._merged_short(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(rank[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in rank]
        heapq.heapify(waiting)
        while waiting:
            best, left, pair = heapq.heappop(waiting)
            right = after[left]
            if right >= n or (ids[left], ids[right]) != pair:
                continue
            ids[left], ids[right] = self.result[best], None
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for i in (before[left], left):
                if i >= 0 and after[i] < n and (found := rank.get(pair := (ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(waiting, (found, i, pair))
        return [i for i in ids if i is not None]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, rows: pa.ListArray) -> pa.Array:
        """The texts of lists of ids; null lists give ''."""
        taken = self.symbols.take(rows.flatten())
        if taken.null_count:
            raise KeyError("an id that the vocabulary does not have")
        ends = np.concatenate(([0], np.cumsum(rows.value_lengths().fill_null(0).to_numpy().astype(np.int64))))
        if not ends[-1]:
            return pa.array([""] * len(rows), pa.string())
        _, offsets, body = taken.buffers()
        offsets = np.frombuffer(offsets, np.int64)[taken.offset :][ends]
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), body])
        try:
            return texts.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # ids that split a character
            return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())


_LOADED: dict[str, Bpe] = {}


def loaded(text: str) -> Bpe:
    """The vocabulary of a file's text, built once per Python worker."""
    if text not in _LOADED:
        _LOADED.clear()
        _LOADED[text] = Bpe(text)
    return _LOADED[text]


def vocabulary(path: str) -> str:
    """The text of a vocabulary file (a few MB), read on the driver and sent along with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _ids(bpe: Bpe, texts: pa.Array) -> pa.ListArray:
    """The ids of a column of texts, some ``AT_ONCE`` characters at a time."""
    parts, waiting, size = [], [], 0

    def flush() -> None:
        parts.append(bpe.encode_all(waiting))
        waiting.clear()

    for text in texts:
        waiting.append(text.as_py() or "")
        size += len(waiting[-1])
        if size >= AT_ONCE:
            flush()
            size = 0
    flush()
    return pa.concat_arrays(parts)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``, with the vocabulary file at ``path``."""
    text = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(text)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], _ids(bpe, batch["text"])], ["doc_id", "ids"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to rows of (doc_id, ids); null ids give ''."""
    text = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(text)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], bpe.decode_all(batch["ids"])], ["doc_id", "ids", "decoded"])

    return mapped(ids.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) for each row of ``docs``: ``decoded(encoded(docs))`` in one pass through Python."""
    text = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(text)
        for batch in batches:
            ids = _ids(bpe, batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids, bpe.decode_all(ids)], ["doc_id", "ids", "decoded"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: digests of the ids and of the decoded text of each document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return round_trip(table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
