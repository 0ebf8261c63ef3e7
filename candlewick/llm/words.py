"""Long texts in pieces, for use inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE = 1 << 20

_SPACE = re.compile(r"\s")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes that end at a space; a word longer than that stays whole."""
    at = 0
    while len(text) - at > size:
        end = text.find(b" ", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def text_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """As ``pieces``, of a string, cut at any white space."""
    at = 0
    while len(text) - at > size:
        end = _SPACE.search(text, at + size)
        if end is None:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:] if at else text
