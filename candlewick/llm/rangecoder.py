"""Adaptive context-mixing range coder for token ids.

A block holds up to ``BLOCK`` ids, cut into lanes of ``STEPS`` consecutive ids. All lanes
of a block go forward together, one id a step, through one shared model that is reset at
the block's start and adapts after every step. For each id the model mixes

* order 2: the id last confirmed after the two ids before it,
* order 1: the id last confirmed after the one id before it,
* order 0: counts of all ids of the block so far,

with weights learnt from how often the two predictions held at their present confidence.
The mixture gives each id an interval of 2^28, which a 56-bit range coder narrows; the
carries of all lanes are settled once at the end. Encoder and decoder do the same integer
arithmetic, so decoding is exact.

Block layout (little-endian): magic, alphabet, ids, lanes as unsigned 32-bit numbers,
crc32 of the ids, crc32 of the rest; words per lane (16 bits each); the lanes' 16-bit words.
"""

from __future__ import annotations

import zlib

import numpy as np

# Fixed values of the format.
MAGIC = 0x31444354
BLOCK = 1 << 18
STEPS = 128
_TOTAL_BITS = 28
_RANGE_BITS = 56
_WORD = 16
_SCALE_BITS = 22  # order-0 counts are scaled to this total; the rest of the mixture keeps at least as much
_REFRESH = 8  # steps between two rebuilds of the order-0 table
_HASH_BITS = 18
_CONFIDENCE = 7

_TOTAL = 1 << _TOTAL_BITS
_LEAST_REST = 1 << _SCALE_BITS
_LOW_MASK = (1 << _RANGE_BITS) - 1
_RENORM = 1 << (_RANGE_BITS - _WORD)
_HEAD = np.dtype([(n, "<u4") for n in ("magic", "alphabet", "ids", "lanes", "ids_crc", "body_crc")])


class _Model:
    def __init__(self, alphabet: int, lanes: int):
        self.alphabet = alphabet
        self.gain = max(1, min(24, (_LEAST_REST - alphabet) // (BLOCK + 1)))
        self.counts = np.ones(alphabet, np.int64)
        self.last = np.full(lanes, alphabet, np.int64)
        self.tables = [
            (np.full(alphabet + 1, alphabet, np.int32), np.zeros(alphabet + 1, np.int8)),
            (np.full(1 << _HASH_BITS, alphabet, np.int32), np.zeros(1 << _HASH_BITS, np.int8)),
        ]
        self.slots = [self.last, np.zeros(lanes, np.int64)]
        self.held = np.ones((3, 2 * (_CONFIDENCE + 1) ** 2), np.int64)  # order 2 held, order 1 held, seen
        self.held[2] = 16
        self.step = 0

    def begin(self, n: int) -> None:
        """Predictions and weights for the next id of the first ``n`` lanes."""
        if self.step % _REFRESH == 0:
            sums = np.zeros(self.alphabet + 1, np.int64)
            np.cumsum(self.counts, out=sums[1:])
            # Every count keeps at least one part, as all counts together stay below the scale.
            self.sums = (sums * ((1 << 40) // int(sums[-1])) >> (40 - _SCALE_BITS)).astype(np.int32)
            self.sums[-1] = _LEAST_REST
        self.step += 1
        self.slots = [s[:n] for s in self.slots]
        (id1, sure1), (id2, sure2) = self.tables
        self.guess1, self.guess2 = id1[self.slots[0]], id2[self.slots[1]]
        self.sure1, self.sure2 = sure1[self.slots[0]], sure2[self.slots[1]]
        agree = self.guess1 == self.guess2
        self.state = (self.sure2.astype(np.int64) * (_CONFIDENCE + 1) + self.sure1) * 2 + agree
        share = (self.held[:2] * (_TOTAL - 2 * _LEAST_REST)) // self.held[2]
        weight2, weight1 = share[0][self.state], share[1][self.state]
        weight1[agree] = 0
        weight1[self.guess1 == self.alphabet] = 0
        weight2[self.guess2 == self.alphabet] = 0
        self.weight2, self.both = weight2, weight2 + weight1
        self.rest = _TOTAL - self.both

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low0, high0 = self.sums[ids].astype(np.int64), self.sums[ids + 1]
        start = (low0 * self.rest >> _SCALE_BITS) + self.both
        size = (high0 * self.rest >> _SCALE_BITS) + self.both - start
        hit1, hit2 = ids == self.guess1, ids == self.guess2
        hit1 &= ~hit2
        start = np.where(hit2, 0, np.where(hit1, self.weight2, start))
        size = np.where(hit2, self.weight2, np.where(hit1, self.both - self.weight2, size))
        return start, size

    def find(self, target: np.ndarray) -> np.ndarray:
        inside = np.maximum(target - self.both, 0)
        value = (((inside + 1) << _SCALE_BITS) - 1) // self.rest
        ids = np.searchsorted(self.sums, value.astype(np.int32), side="right") - 1
        return np.where(target < self.weight2, self.guess2, np.where(target < self.both, self.guess1, ids)).astype(np.int64)

    def learn(self, ids: np.ndarray) -> None:
        np.add.at(self.counts, ids, self.gain)
        hit1, hit2 = ids == self.guess1, ids == self.guess2
        size = self.held.shape[1]
        seen = np.bincount(self.state, minlength=size)
        self.held[0] += np.bincount(self.state[hit2], minlength=size)
        self.held[1] += np.bincount(self.state[hit1 & ~hit2], minlength=size)
        self.held[2] += seen
        for (guesses, sure), slot, guess, was, hit in zip(
            self.tables, self.slots, (self.guess1, self.guess2), (self.sure1, self.sure2), (hit1, hit2)
        ):
            sure[slot] = np.where(hit, np.minimum(was + 1, _CONFIDENCE), was >> 1)
            guesses[slot] = np.where(hit | (was > 1), guess, ids)
        mixed = (self.last[: len(ids)] * 0x9E3779B1 + ids * 0x85EBCA6B) & 0xFFFFFFFF
        self.last = ids
        self.slots = [ids, mixed >> (32 - _HASH_BITS)]


def _lanes(n: int) -> tuple[int, list[int]]:
    """Number of lanes, and how many of them have an id at each step (the last lane may be shorter)."""
    lanes = -(-n // STEPS)
    left = n - (lanes - 1) * STEPS
    return lanes, [lanes if step < left else lanes - 1 for step in range(STEPS if lanes > 1 else left)]


def encode_block(ids: np.ndarray, alphabet: int) -> bytes:
    """The block of up to ``BLOCK`` ids, each below ``alphabet`` (at most 2^21)."""
    ids = np.ascontiguousarray(ids, "<u4")
    if len(ids) > BLOCK or alphabet > 1 << 21 or (len(ids) and int(ids.max()) >= alphabet):
        raise ValueError("block too long or id outside the alphabet")
    n = len(ids)
    lanes, active = _lanes(n) if n else (0, [])
    grid = np.zeros(lanes * STEPS, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, STEPS).T)
    model = _Model(alphabet, lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << _RANGE_BITS, np.int64)
    words = np.zeros((lanes, 2 * STEPS + 2), np.int64)
    used = np.zeros(lanes, np.int64)
    rows = np.arange(lanes)
    for step, m in enumerate(active):
        now = grid[step, :m]
        model.begin(m)
        start, size = model.interval(now)
        model.learn(now)
        unit = span[:m] >> _TOTAL_BITS
        low[:m] += unit * start
        span[:m] = unit * size
        for _ in range(2):
            small = np.flatnonzero(span[:m] < _RENORM)
            if not len(small):
                break
            # The word may carry one more bit than it has; settled below.
            words[small, used[small]] += low[small] >> (_RANGE_BITS - _WORD)
            used[small] += 1
            low[small] = (low[small] << _WORD) & _LOW_MASK
            span[small] <<= _WORD
    if lanes:
        words[rows, used] += (low + _RENORM - 1) >> (_RANGE_BITS - _WORD)
        used += 1
        for column in range(words.shape[1] - 1, 0, -1):
            words[:, column - 1] += words[:, column] >> _WORD
        words &= 0xFFFF
    body = used.astype("<u2").tobytes() + words[np.arange(words.shape[1]) < used[:, None]].astype("<u2").tobytes()
    head = np.array([(MAGIC, alphabet, n, lanes, zlib.crc32(ids), zlib.crc32(body))], _HEAD)
    return head.tobytes() + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block as unsigned 32-bit numbers; raises ValueError if a checksum fails."""
    head = np.frombuffer(block, _HEAD, 1)[0]
    body = block[_HEAD.itemsize :]
    if int(head["magic"]) != MAGIC or zlib.crc32(body) != int(head["body_crc"]):
        raise ValueError("not a block, or a damaged one")
    alphabet, n, lanes = (int(head[k]) for k in ("alphabet", "ids", "lanes"))
    if not n:
        return np.zeros(0, "<u4")
    used = np.frombuffer(body, "<u2", lanes).astype(np.int64)
    stream = np.frombuffer(body, "<u2", offset=2 * lanes).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(used)[:-1]))
    end = at + used
    stream = np.concatenate((stream, [0]))
    code = np.zeros(lanes, np.int64)
    for _ in range(_RANGE_BITS // _WORD):  # 48 bits; the last 8 come with the half word below
        code = (code << _WORD) | np.where(at < end, stream[np.minimum(at, len(stream) - 1)], 0)
        at = at + 1
    return _decode(code, at, end, stream, alphabet, n, lanes, int(head["ids_crc"]))


def _decode(code, at, end, stream, alphabet, n, lanes, crc) -> np.ndarray:
    # The coder's state has 56 bits and words have 16: ``pending`` keeps the 8 bits between.
    following = np.where(at < end, stream[np.minimum(at, len(stream) - 1)], 0)
    code = (code << 8) | (following >> 8)
    pending = following & 0xFF
    at = at + 1
    span = np.full(lanes, 1 << _RANGE_BITS, np.int64)
    model = _Model(alphabet, lanes)
    _, active = _lanes(n)
    grid = np.zeros((STEPS, lanes), np.int64)
    for step, m in enumerate(active):
        model.begin(m)
        unit = span[:m] >> _TOTAL_BITS
        now = model.find(np.minimum(code[:m] // unit, _TOTAL - 1))
        start, size = model.interval(now)
        model.learn(now)
        grid[step, :m] = now
        code[:m] -= unit * start
        span[:m] = unit * size
        for _ in range(2):
            small = np.flatnonzero(span[:m] < _RENORM)
            if not len(small):
                break
            following = np.where(at[small] < end[small], stream[np.minimum(at[small], len(stream) - 1)], 0)
            code[small] = (code[small] << _WORD) | (pending[small] << 8) | (following >> 8)
            pending[small] = following & 0xFF
            at[small] += 1
            span[small] <<= _WORD
    ids = grid.T.reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids) != crc:
        raise ValueError("ids do not match their checksum")
    return ids
