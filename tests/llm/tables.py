"""Small awkward inputs: nulls, empty and long texts, repeated rows, clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, score string, line string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    base = words(rng, 120)
    near = base[:60] + ["changed"] + base[61:]
    passage = words(rng, 70)
    lines = [" ".join(words(rng, 12)) for _ in range(4)]
    varied = lines[0].split()
    rows: list[tuple[int | None, str | None]] = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (4, None), (5, ""), (6, "  \n \t "),
        (7, "one"), (8, "one"), (9, "One two"), (10, " ".join(words(rng, 30) + passage + words(rng, 30))),
        (11, " ".join(words(rng, 25) + passage + words(rng, 10))), (12, "\n".join(lines)),
        (13, "\n".join([lines[0], "", " ".join([*varied, "x"]), lines[2] + " ", "end"])),
        (14, "word " * 20_000 + "<|endoftext|> été 日本 😀 it's"), (15, "a b c  d\n\n\ne\x1cf"), (15, "same id, another text"),
        (None, "no id"), (None, None), (17, " ".join(base)), (17, " ".join(base)), (18, "x" * 5000),
    ]
    return rows


def documents(spark):
    return spark.createDataFrame([(i, t, "en", None, 1, "k", 3, "s", "l") for i, t in texts()], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
