"""Word shingles as 64-bit numbers, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words remembered per Python worker; the memory is emptied when it is full.
REMEMBERED = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    """A number for each word of ``text``: runs without ASCII white space, A-Z as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray, first: int, second: int) -> np.ndarray:
    """A one-to-one scattering of 64-bit numbers, chosen by two odd multipliers."""
    out = values ^ (values >> np.uint64(32))
    out *= np.uint64(first)
    out ^= out >> np.uint64(29)
    out *= np.uint64(second)
    out ^= out >> np.uint64(32)
    return out


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A number for every run of ``width`` words; the whole sequence as one if it is shorter, none without words."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for at in range(width):
        out = mixed(out + words[at : at + n], 0xD6E8FEB86659FD93, 0xCF1BBCDCBFA53E0B)
    return out
