"""Every operator on awkward rows, on empty tables, and against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.llm import bpe, decontaminate, lines, minhash, nearest, passages, rangecoder, rendering, shards, tokenfiles, toxicity
from candlewick.llm.common import dropped, stored
from tests.llm.tables import documents, empty, texts

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file


# 1


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("alphabet", [2, 300, 49408])
def test_blocks_round_trip(n, alphabet):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, alphabet, n), np.minimum(rng.zipf(1.3, n), alphabet) - 1, np.full(n, alphabet - 1)):
        assert (rangecoder.decode_block(rangecoder.encode_block(ids, alphabet)) == ids).all()


def test_damaged_block_is_noticed():
    block = bytearray(rangecoder.encode_block(np.arange(1000), 2000))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        rangecoder.decode_block(bytes(block))


def test_checksums_of_pieces():
    ids = np.arange(1000, dtype="<u4")
    pieces = [(zlib.crc32(ids[a:b]), b - a) for a, b in ((0, 3), (3, 3), (3, 700), (700, 1000))]
    assert tokenfiles.crc_of_pieces(pieces) == zlib.crc32(ids)


def test_new_words_go_to_the_library_together(monkeypatch):
    words = tokenfiles._Words(open(WORDS).read())
    rng = random.Random(4)
    some = [" ".join("".join(rng.choice("abcé.'1ſK") for _ in range(rng.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    some += ["", " \n ", "a\x01b \x01 c", "x <|endoftext|> y<|startoftext|>z", "\u0301a b\u0301 ÀÉ", "\x00 \x02 日本 😀", "a\tb\r\nc"]
    expected = words._library(some)
    library, lines = words._library, []
    monkeypatch.setattr(words, "_library", lambda texts: lines.extend(texts) or library(texts))
    for _ in "twice":
        assert [ids.tolist() for ids in words.encode(some)] == expected
    assert len(lines) < 600 < len(words.known)  # one call a line, one a word for the line that holds a mark
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 10)
    assert [ids.tolist() for ids in words.encode(some)] == expected


def test_token_files(spark, tmp_path, tokenizer, monkeypatch):
    path = tokenfiles.write(documents(spark), str(tmp_path / "full"), WORDS, end_id=2)
    rows = [tuple(r) for r in tokenfiles.digests(spark, path).collect()]
    library, expected, start = tokenizer(WORDS), [], 0
    for doc_id, text in sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, len(ids), zlib.crc32(ids)))
    assert Counter((d, n, c) for d, _, n, c in rows) == Counter(expected)
    for _, start_, n, _ in sorted(rows, key=lambda r: r[1]):
        assert start_ == start
        start += n
    read = tokenfiles.read(spark, path).orderBy("part", "doc", "piece").collect()
    assert sum(len(r.ids) for r in read) == start
    assert tokenfiles.digests(spark, tokenfiles.write(empty(spark), str(tmp_path / "none"), WORDS, 2)).count() == 0


# 2


def _contaminated(docs, bench, window=10):
    split = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    of = lambda t: tuple(split.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    windows = defaultdict(set)
    for item, text in bench:
        w = of(text)
        for at in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows[w[at : at + window]].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, items = of(text), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if w[at : at + n] in windows:
                    hit.update(range(at, at + n))
                    items |= {str(i) for i in windows[w[at : at + n]] if i is not None}
        out.append((doc_id, len(w), len(hit), tuple(sorted(items))))
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_contamination(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs = dict((i, t) for i, t in texts() if i is not None)
    passage = " ".join(docs[10].split()[35:75])
    bench = [(1, passage), (12, passage.upper() + "!"), (3, "One two"), (4, None), (5, "--"), (None, "same id another"), (3, "One two"), (7, "word " * 11)]
    table = spark.createDataFrame([(*b, "x") for b in bench], "item_id long, text string, doc_id string")
    found = decontaminate.contaminated(documents(spark), table).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == _contaminated(texts(), bench)
    clean = decontaminate.uncontaminated(documents(spark), table)
    assert clean.columns == documents(spark).columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in found if not r.n_hit)
    assert decontaminate.contaminated(empty(spark), table).count() == 0
    none = decontaminate.contaminated(documents(spark), table.limit(0)).collect()
    assert {r.n_hit for r in none} == {0} and len(none) == len(texts())


def test_longest_matches(spark):
    bench = spark.createDataFrame([(1, "b c d q"), (2, "zz")], "item_id long, text string")
    docs = spark.createDataFrame([(7, "a b c d e"), (8, "c d q")], "doc_id long, text string").coalesce(1)
    rows = {(r.item_id, r.position): r for r in decontaminate.longest_matches(docs, bench).collect()}
    assert rows[1, 0].n_words == 3 and (rows[1, 0].doc_id, rows[1, 0].at) == (7, 1)
    assert rows[1, 1].n_words == 3 and rows[1, 1].doc_id == 8
    assert (2, 0) not in rows


# 3


def _removed(rows):
    done, out = [], {}
    for doc_id, text in sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = []
        for n, line in enumerate(text.split("\n")):
            w = {x for x in re.split("[ \t\r]", line.lower()) if x}
            if not w:
                continue
            if any(9 * len(w & v) >= 4 * (len(w) + len(v)) for at, v in done if at < ((doc_id is not None, doc_id or 0), n)):
                gone.append(n)
            done.append((((doc_id is not None, doc_id or 0), n), w))
        out[doc_id, text] = gone
    return out


def test_lines(spark):
    expected = _removed(texts())
    found = {(r.doc_id, r.text): list(r.removed) for r in lines.removed_lines(documents(spark)).join(
        documents(spark).selectExpr("doc_id as d", "text", "xxhash64(text) as k"), F.expr("doc_id <=> d and text_key = k")).collect()}
    assert {k: v for k, v in found.items() if k[1] is not None} == expected
    cleaned = lines.cleaned(documents(spark))
    assert cleaned.columns == documents(spark).columns and cleaned.count() == len(texts())
    by_id = {r.doc_id: r.text for r in cleaned.collect()}
    assert by_id[4] is None and by_id[13] == "\nend" and by_id[8] == ""
    assert lines.cleaned(empty(spark)).count() == 0


def test_lines_of_infrequent_copies_and_two_texts_of_a_doc_id(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARE", 1)  # no line is frequent: copies meet in the join
    one = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(i, one + (" lambda" if i % 3 else "") + f"\nown line {i}") for i in range(12)]
    rows += [(20, one + " mu"), (20, one + " nu"), (21, one + " mu")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {(i, t): gone for (i, t), gone in _removed(rows).items()}
    keys = docs.selectExpr("doc_id as d", "text", "xxhash64(text) as k")
    found = lines.removed_lines(docs).join(keys, F.expr("doc_id = d and text_key = k")).collect()
    assert {(r.doc_id, r.text): list(r.removed) for r in found} == expected


def test_stored_tables_can_be_dropped(spark):
    kept, gone = (stored(spark.range(5).groupBy("id").count(), n) for n in ("kept", "gone"))
    file = gone.inputFiles()[0].removeprefix("file://")
    dropped(gone)
    assert kept.count() == 5 and not os.path.exists(file)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_lines_of_a_document_without_id(spark):
    one, other = ("alpha beta gamma delta epsilon zeta eta theta iota kappa", "ant bee cat dog elk fox gnu hen ibis jay")
    rows = [(None, one + "\n" + other + "\n" + other + " kid"), (1, one + " lambda\nelse"), (2, other.replace("jay", "jackal"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {i: gone for (i, _), gone in _removed(rows).items()}
    assert expected == {None: [2], 1: [0], 2: [0]}
    assert {r.doc_id: list(r.removed) for r in lines.removed_lines(docs).collect()} == expected


def test_lines_against_all_pairs(spark):
    rng = random.Random(3)
    common = ["".join(rng.choice("abcd") for _ in range(2)) for _ in range(30)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(6):
            line = rng.sample(common, rng.randint(1, 14))
            if rows and rng.random() < 0.5:
                line = rng.choice(rng.choice(rows)[1].split("\n")).split()
                line = [w if rng.random() > 0.1 else rng.choice(common) for w in line]
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {i: gone for (i, _), gone in _removed(rows).items()}
    assert {r.doc_id: list(r.removed) for r in lines.removed_lines(docs).collect()} == expected


@pytest.mark.parametrize("few, long_", [(1024, 64), (2, 3)])
def test_lines_of_large_groups_and_long_lines_against_all_pairs(spark, monkeypatch, few, long_):
    monkeypatch.setattr(lines, "FEW", few)
    monkeypatch.setattr(lines, "LONG", long_)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(4):
            line = rng.sample(vocabulary, rng.choice([5, 12, 60, 70, 150]))
            if rows and rng.random() < 0.6:
                line = rng.choice(rng.choice(rows)[1].split("\n")).split()
                line = [w if rng.random() > 0.07 else rng.choice(vocabulary) for w in line]
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {i: gone for (i, _), gone in _removed(rows).items()}
    assert sum(map(len, expected.values())) > 20
    assert {r.doc_id: list(r.removed) for r in lines.removed_lines(docs).collect()} == expected


def _shared_of_long_lines(spark):
    """The prefix words of 60 long lines that have few words in common."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.sample([f"w{j}" for j in range(3000)], 150))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines._lines(docs)
    frequent = found.limit(0).select("line_a", "line_b", F.struct("doc_id", "line_no").alias("kept"))
    return lines._shared(found, frequent, lines._ranks(docs))


def test_counters_of_words_are_in_no_plan(spark):
    assert len(_shared_of_long_lines(spark)._jdf.queryExecution().toString()) < lines.BUCKETS


def test_long_lines_that_share_few_words_are_no_candidates(spark):
    found = _shared_of_long_lines(spark).withColumns({"word": F.lit(1), "i": F.lit(0)}).dropDuplicates(["line_a"])  # as if the first word were the same
    x, y = found.alias("x"), found.alias("y")
    pairs = x.join(y, F.expr("x.word = y.word and x.line_a < y.line_a"))
    assert pairs.count() > 1000 and pairs.filter(lines._fits("x", "y")).count() == 0


# 4

PAGE = """<head><title>T</title><style>.x{display:none}</style></head><h1>Head &amp; <b>bold</b></h1><div>a  b
c<br>d</div><p>one<p>two <span hidden>no</span><i class="y x">no</i><ul><li>one<li>two<ul><li>in</ul></ul><ol start=3><li>x<li>y</ol>
<table><tr><th>Name<th>Qty<tr><td>apple<td>3</table><script>var t="</p>";</script> 3 < 4 <details><summary>S</summary>no</details>"""


def test_rendering():
    assert rendering.render(PAGE).split("\n") == [
        "Head & bold", "", "a b c", "d", "", "one", "", "two", "", "- one", "- two", "  - in", "", "3. x", "4. y", "",
        "Name   Qty", "apple  3", "", "3 < 4", "S",
    ]


@pytest.mark.parametrize("html, text", [(None, ""), ("", ""), ("<p", ""), ("plain", "plain"), ("<td>a</td>", "a"), ("</p></div>x", "x"),
                                        ("<pre>\n a\n  b</pre>", " a\n  b"), ("<div>" * 30_000 + "deep", "deep")])
def test_broken_pages(html, text):
    assert rendering.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<style>@media print{.m{display:none}}</style><p class=m>a", "a"), ("<style media=print>.m{display:none}</style><p class=m>a", "a"),
    ("<style>@media (max-width:600px){.m{display:none}} .n{display:none}</style><p class=m>a<p class=n>b", "a"),
    ("<style>@media screen and (min-width: 48em){.m{display:none}}</style><p class=m>a<p>b", "b"),
    ("<style>@media not print{.m{display:none}}</style><p class=m>a<p>b", "b"), ("<style>@media(orientation:portrait){p{display:none}}</style><p>a", "a"),
    ("<style>@keyframes k{from{visibility:hidden}} @font-face{x:y}.n{display:none}</style><p class=n>b</p>a", "a"),
    ("<style>.x{display:none}.x{display:block}</style><p class=x>a", "a"), ("<style>.x{display:block}.x{display:none}</style><p class=x>a", ""),
    ("<style>#i{display:block}.x{display:none}</style><p class=x id=i>a", "a"), ("<style>.x{display:none}</style><p class=x style='display:block'>a", "a"),
    ("<style>.x{display:none!important}</style><p class=x style='display:block'>a", ""),
    ("<style>.c{backface-visibility:hidden}</style><p class=c>a", "a"), ("<p style='-webkit-backface-visibility: hidden'>a", "a"),
    ("<style>/* .x{ */ .x{display:none} .y{content:'}'}</style><p class=x>a<p class=y>b", "b"),
    ("<p>a<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> b", "ax=1 b"),
    ("<svg><title>t</title><defs/><path d='m'/><style/><text>one</text><g><text>two</text></g><defs><text>no</text></defs></svg><p>c", "one\ntwo\n\nc"),
])
def test_only_what_is_hidden_on_the_screen_goes(html, text):
    assert rendering.render(html) == text


def test_stray_end_tags_and_long_cells():
    start = time.process_time()
    assert rendering.render("<b>" * 20_000 + "x" + "</i>" * 20_000 + "<li>" + "<div>" * 100 + "a<li>b") == "x\n- a\n- b"
    assert time.process_time() - start < 5
    page = "<table>" + "<tr><td>a<td>b" * 500 + f"<tr><td>{'c' * 200_000}<td>d</table>"
    assert 200_000 < len(rendering.render(page)) < 200_000 + 501 * 130


def test_pages(spark):
    pages = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, "t")], "page_id long, html string, text string")
    assert Counter(tuple(r) for r in rendering.extracted(pages).collect()) == Counter([(1, "a"), (1, "a"), (None, "")])
    assert rendering.extracted(pages.limit(0)).count() == 0


# 5


@pytest.mark.parametrize("n, least, most", [(60, 5, 9), (200, 10, 40), (300, 46, 1000), (46, 46, 99), (30, 46, 9)])
def test_compact_windows(n, least, most):
    values = np.random.default_rng(n).integers(1, most, n).astype(np.uint64)
    values[n // 3] = 0 if n > 50 else values[n // 3]
    expected = set()
    for c in np.flatnonzero(values):
        left, right = c, c
        while left and values[left - 1] > values[c]:
            left -= 1
        while right + 1 < n and values[right + 1] >= values[c]:
            right += 1
        if right - left + 1 >= least:
            expected.add((c, left, right))
    assert set(zip(*(x.tolist() for x in passages.compact_windows(values, least, n)))) == expected


@pytest.mark.parametrize("alphabet", [60, 300, 1 << 62])
def test_pairs_verified_together_as_one_by_one(alphabet):
    rng = np.random.default_rng(alphabet % 1009)
    pairs = []
    for n in range(200):
        a = rng.integers(0, alphabet, rng.integers(0, 300))
        b = np.concatenate((rng.integers(0, alphabet, rng.integers(0, 20)), a))
        for _ in range(n % 12):
            at, size = rng.integers(len(b) + 1), rng.integers(1, 25)
            b = np.concatenate((b[:at], rng.integers(0, alphabet, size), b[at + size * (n % 2) :]))
        pairs.append((np.concatenate((a, a)) if n % 5 == 0 else a, a.copy() if n % 7 == 0 else b))
    columns = [x for side in zip(*pairs) for x in (np.concatenate(side), np.cumsum([0, *map(len, side)]))]
    expected = {(k, *part) for k, (a, b) in enumerate(pairs) for part in passages.similar_parts(a, b)}
    assert set(zip(*(c.tolist() for c in passages.all_similar_parts(*columns)))) == expected and len(expected) > 50


def test_tokens_of_pairs_are_numbered_by_a_table():
    rng = np.random.default_rng(5)
    for n, alphabet in ((0, 1), (1, 1), (500, 3), (3000, 1 << 62), (3000, 40)):
        pair = np.sort(rng.integers(0, 20, n))
        values = rng.integers(-alphabet, alphabet, n)
        values[n // 2 :] = values[: n - n // 2]
        half = slice(0, n, 2)  # tokens that agree in every round of the table, each of another pair
        values[half] = (np.uint64(77) - pair[half].astype(np.uint64) * np.uint64(passages._BASE)).view(np.int64)
        codes = passages._codes(values, pair)
        assert ((codes >= 0) & (codes < max(n, 1))).all()
        assert (values[codes] == values).all() and (pair[codes] == pair).all()
        assert len(set(codes.tolist())) == len(set(zip(pair.tolist(), values.tolist())))


def test_tokens_and_seeds_of_many_texts_as_one_by_one():
    rng = random.Random(3)
    some = [" ".join(rng.choice("abcdefghij"[:k]) for _ in range(n)) for n, k in ((0, 1), (3, 2), (400, 1), (70, 2), (5, 9), (300, 9), (50, 4))]
    some = [None, *some, *texts_of_one_token(), None]
    found, at = passages.all_tokens(some)
    parts = [found[a:b] for a, b in zip(at, at[1:])]
    assert [p.tolist() for p in parts] == [passages.tokens(t).tolist() for t in some]
    parts = [p for p in parts if len(p) >= passages.LEAST]
    at = np.cumsum([0, *map(len, parts)])
    together = passages.seeds(np.concatenate(parts), at)
    assert together.tolist() == [int(c + b) for p, b in zip(parts, at) for c in passages.seeds(p)]
    of = np.searchsorted(at, together, side="right") - 1
    around = passages._surroundings(np.concatenate(parts), together, at[of], at[of + 1])
    assert around.tolist() == [n for p in parts for n in passages._surroundings(p, passages.seeds(p)).tolist()]


def texts_of_one_token():
    return ["a a a a a", "x " * 60, "x " * 60]


def test_passages(spark):
    rows = passages.repeated(documents(spark)).collect()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add(r.of_doc_id)
        assert r.stop - r.start >= 50 and r.similarity >= 0.8
    assert found[11] == {10} and 1 in found[2] and 1 in found[3] and 1 in found[17]
    assert set(found) == {2, 3, 11, 17}
    assert passages.repeated(empty(spark)).count() == 0


def _linked(rows):
    """The documents that share a passage with an earlier one, by brute force."""
    found = [(i, passages.tokens(t)) for i, t in sorted(rows)]
    return {i for n, (i, b) in enumerate(found) if any(passages.similar_parts(a, b) for _, a in found[:n])}


@pytest.mark.parametrize("few, block", [(16, 1024), (1, 4)])
def test_passages_of_interleaved_variants(spark, monkeypatch, few, block):
    monkeypatch.setattr(passages, "FEW", few)
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    rows = []
    for _ in range(40):
        one = [word() for _ in range(54)]
        other = [w if i not in (13, 26, 40) else word() for i, w in enumerate(one)]
        for variant in (one, other, one, other, other[:27] + one[27:]):
            rows.append((len(rows), " ".join([word() for _ in range(9)] + variant + [word() for _ in range(9)])))
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts_ = dict(rows)
    for r in found:  # both ends of a link are near copies
        a, b = (passages.tokens(" ".join(texts_[d].split()[x:y])) for d, x, y in ((r.of_doc_id, r.of_start, r.of_stop), (r.doc_id, r.start, r.stop)))
        assert r.of_doc_id < r.doc_id and len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    assert {r.doc_id for r in found} == _linked(rows) >= {n for n in range(200) if n % 5 in (2, 3)}


@pytest.mark.parametrize("few, block", [(16, 4096), (1, 4)])
def test_links_of_a_large_group_of_different_passages(spark, monkeypatch, few, block):
    monkeypatch.setattr(passages, "FEW", few)
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(13)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    one = [word() for _ in range(90)]
    around = lambda passage: " ".join([word() for _ in range(9)] + passage + [word() for _ in range(9)])
    rows = [(n, around(one[:30] + [word()] + one[31:])) for n in range(20)]
    # The more words are changed, the less is shared: what one shares with the first of these the next one shares, too.
    rows += [(n, around(one[:50] + [word() for _ in range(n - 20)] + one[n + 30 :])) for n in range(25, 20, -1)]
    pieces = {n: passages.tokens(t) for n, t in rows}
    expected = {(a, b) for b in pieces for a in pieces if a < b and passages.similar_parts(pieces[a], pieces[b])}
    assert len(expected) > 200
    # Copies in other surroundings are linked with the earliest, also where their document holds another kind before.
    rows += [(n, around(one[:30])) for n in range(30, 40)] + [(n, around(one)) for n in range(40, 60)] + [(60, around(one) + " " + around(one[:44] + [word()] + one[45:]))]
    found = {(r.of_doc_id, r.doc_id) for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert expected <= found and {(40, n) for n in range(41, 61)} <= found
    assert not any(n in pair for pair in found for n in range(30, 40))


def test_every_edited_passage_is_found(spark):
    rng = random.Random(12)
    word = lambda: f"w{rng.randint(0, 10**9)}"
    rows = []
    for n in range(400):
        one = [word() for _ in range(50)]
        at = rng.randint(22, 27)
        for i, variant in ((n, one), (1000 + n, one[:at] + [word()] + one[at + 1 :])):
            rows.append((i, " ".join([word() for _ in range(5)] + variant + [word() for _ in range(5)])))
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.of_doc_id, r.doc_id) for r in found} == {(n, 1000 + n) for n in range(400)}


# 6


@pytest.mark.parametrize("n", [1, 3, 7, 100])
def test_shards(spark, n):
    found = shards.sharded(documents(spark), n).collect()
    groups: dict = {}
    for doc_id, text in sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0)):
        groups.setdefault(text, []).append((doc_id, len((text or "").encode()) + 16))
    key = lambda t: (min((i is not None, i or 0) for i, _ in groups[t] if i is not None) if any(i is not None for i, _ in groups[t]) else (False, 0))
    sizes = [sum(s for _, s in groups[t]) for t in sorted(groups, key=key)]

    def runs(capacity):
        count, filled = 1, 0
        for size in sizes:
            if filled + size > capacity:
                count, filled = count + 1, 0
            filled += size
        return count

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if runs(c) <= n)
    total = Counter()
    slots = defaultdict(list)
    for r in found:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(found) == len(texts()) and max(total.values()) == best and set(total) <= set(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.sharded(empty(spark), n).count() == 0


def test_shards_with_a_coarse_summary(spark, monkeypatch):
    monkeypatch.setattr(shards, "CELLS", 64)
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 900) + str(i)) for i in range(500)]
    total = Counter()
    for r in shards.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 9).collect():
        total[r.shard] += r.size
    sizes = [len(t) + 16 for _, t in rows]

    def runs(capacity):
        count, filled = 1, 0
        for size in sizes:
            if filled + size > capacity:
                count, filled = count + 1, 0
            filled += size
        return count

    assert max(total.values()) == next(c for c in range(max(sizes), sum(sizes)) if runs(c) <= 9)


def test_shards_beside_a_large_group_are_near_equal(spark):
    rows = [(i, "y" * 3000) for i in range(300)] + [(1000 + i, f"{i:04d}" * 700) for i in range(600)]
    sizes = Counter()
    for r in shards.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect():
        sizes[r.shard] += r.size
    others = sorted(sizes.values())[:-1]
    assert len(sizes) == 40 and max(sizes.values()) == 300 * 3016 and others[-1] - others[0] <= 2 * 2816


def test_spread_cuts_keep_the_capacity_and_leave_no_shard_empty():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([rng.randint(1, 9), rng.randint(1, 60)]) for _ in range(rng.randint(1, 14))]
        ends, n = np.cumsum(sizes).tolist(), rng.randint(1, 8)

        def fits(capacity):
            count, filled = 1, 0
            for size in sizes:
                count, filled = (count + 1, size) if filled + size > capacity else (count, filled + size)
            return count <= n

        best = next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))
        cuts = shards.spread_cuts(set(ends), ends[::-1][:n], best, n)
        runs = np.diff([0, *cuts])
        assert set(cuts) <= set(ends) and cuts[-1] == ends[-1] and runs.max() == best
        assert np.count_nonzero(runs) == min(n, len(ends)), (sizes, n, cuts)


# 7


def _components(rows, width):
    sets: dict = {}  # by (doc_id, text): rows of one doc_id are one document
    for doc_id, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id, text] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(sets)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a[0]), root(b[0])))
                parent[high] = low
    return Counter((i, len(sets[i, t]), root(i)) for i, t in rows)


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies(spark, width):
    rows = [(i, t) for i, t in texts() if i is not None]
    rng = random.Random(5)
    base = " ".join(str(rng.randint(0, 999)) for _ in range(200)).split()
    for i in range(40):  # a group of near copies, most of them similar to some others only
        rows.append((100 + i, " ".join(w if rng.random() > 0.03 else f"v{i}" for w in base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.grouped(docs, width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == _components(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_components_across_rows_of_one_document(spark):
    a, b, c = ("".join(f" {x}{i}" for i in range(30)) for x in "abc")
    rows = [(14, a), (15, a), (15, b), (16, b), (15, c), (15, ""), (None, b), (20, c + " more"), (21, "x y z")]
    found = minhash.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        [(14, 14, True), *[(15, 14, False)] * 3, (15, 15, True), (16, 14, False), (None, 14, False), (20, 14, False), (21, 21, True)]
    )


def test_texts_without_a_copy_stay_whatever_their_id(spark):
    a, b, c = ("".join(f" {x}{i}" for i in range(30)) for x in "abc")
    rows = [(15, a, 1), (15, b, 2), (15, b, 3), (16, b, 4), (16, c, 5), (None, c, 6), (14, a + " z", 7), (17, None, 8), (17, None, 9), (18, c, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in kept.collect()) == [(0, " c0"), (14, " a0"), (15, " b0"), (16, " c0"), (17, ""), (17, "")]


def test_members_below_the_threshold_are_not_all_compared(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):  # each one is too far from the others; every tenth has a partner
        own = [w if rng.random() > 0.12 else f"v{i}.{n}" for n, w in enumerate(base)]
        rows.append((i, " ".join(own)))
        if i % 10 == 0:
            rows.append((100 + i, " ".join(own[:70] + ["x"] + own[71:])))
    compared = []
    monkeypatch.setattr(minhash, "measured", lambda pairs, sets, measured=minhash.measured: compared.append(pairs.count()) or measured(pairs, sets))
    found = minhash.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == _components(rows, 2)
    assert sum(compared) < 10 * len(rows), compared


def test_rounds_compare_all_members_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_FIRST", 1)
    rng = random.Random(6)
    rows = []
    for g in range(2):
        base = [str(rng.randint(0, 999)) for _ in range(150)]
        for i in range(8):  # a chain: each one is similar to its neighbours only
            base = [w if rng.random() > 0.04 else f"v{g}.{i}" for w in base]
            rows.append((100 * g + rng.randint(0, 10**6) * 1000 + i, " ".join(base)))
    found = minhash.grouped(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == _components(rows, 2)


def test_one_of_each_group_stays(spark):
    kept = minhash.deduplicated(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 15, 18]
    assert kept.filter("doc_id is null").count() == 2
    assert minhash.deduplicated(empty(spark)).count() == 0


# 8


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        parts = [" ".join(rng.choice(["calm", "tree", "house", "walk", "rain"]) for _ in range(8)) for _ in range(5)]
        if toxic:
            parts[rng.randrange(5)] += " vile" + rng.choice(["ness", "ly", "r"])
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(toxic), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels[:200], (None, 1, None), (5, None, None)], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all((found[i].score >= 0.5) == (i % 4 == 0) for i in range(300))
    text = dict(rows)[0]
    assert [("vile" in text[s.start : s.stop]) for s in found[0].sentences] == [True]
    awkward = toxicity.scored(documents(spark), model).collect()
    assert len(awkward) == len(texts()) and all(0 <= r.score <= 1 for r in awkward)
    assert {r.score for r in awkward if r.doc_id in (4, 5, 6)} == {0.0}
    accepted = toxicity.accepted(documents(spark), model)
    assert accepted.columns == documents(spark).columns
    nothing = toxicity.fit(docs, known.limit(0))
    assert {r.score for r in toxicity.scored(docs, nothing).collect()} == {0.0}
    assert toxicity.scored(empty(spark), model).count() == 0


def test_toxicity_is_fitted_from_telling_features_alone(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, f"word{rng.randrange(10**6)} seldom{i} and all. {'vile' if i % 3 == 0 else 'calm'} day") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    got = {}
    monkeypatch.setattr(toxicity, "train", lambda bags, of, train=toxicity.train: got.update(bags=bags.to_pylist(), labels=of) or train(bags, of))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    sent = {f for bag in got["bags"] for sentence in bag for f in sentence}
    assert sent == set(toxicity.features("vile")) | set(toxicity.features("calm"))
    assert [len(bag) for bag in got["bags"]] == [2] * 90
    whole = toxicity.train(pa.array([toxicity._bag(t) for _, t in rows], pa.list_(pa.list_(pa.int32()))), got["labels"])
    assert (whole.weights == model.weights).all() and whole.bias == model.bias


# 9


def test_nearest(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 0) for i in range(260)]
    rows += [(300 + i, rows[50][1], 0) for i in range(30)]  # equal vectors, some of them queries
    rows += [(400, None, 0), (450, [], 0), (500, [float("nan")] * 8, 0), (550, [0.5, None] * 4, 0), (600, [0.1, 0.2], 0), (601, [0.3, 0.4], 0)]
    rows += [(None, [0.9] * 8, 0), (None, [9.0] + [0.0] * 7, 0), (7, [0.9] * 8, 0), (None, rows[50][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key int")
    valid = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, a in valid:
        if q is not None and q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in valid if i != q and len(a) == len(b))[:5]
            expected += [(q, n, None if no_id else i, -s) for n, (s, no_id, i) in enumerate(scores, 1)]
    found = nearest.nearest(table, F.expr("vec_id % 50 = 0")).collect()
    assert Counter(tuple(r) for r in found) == Counter(expected) and any(r.vec_id is None for r in found)
    assert nearest.nearest(table.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("large, first", [(1e6, 200), (1e13, 201)])  # products of two of the second are beyond a long
def test_nearest_keeps_large_components_and_repeated_rows(spark, large, first):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1, 150)]
    rows += [(first + i, [rng.uniform(-1, 1) for _ in range(5)] + [large * (i - 2) * (1 if i < 4 else 0.5)]) for i in range(6)]
    rows += [(50, rows[8][1])] * 8 + [(300, [0.9] * 6)] * 7 + [(301, [0.9] * 6), (302, [0.9] * 6), (303, [0.9] * 6)]
    rows += [(100, [rng.uniform(-1, 1) for _ in range(6)]) for _ in range(3)]  # one id, several vectors
    valid = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    expected = set()
    for q, a in valid:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)[:5]
            expected.add((q, tuple((n, i, -s) for n, (s, i) in enumerate(scores, 1))))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in nearest.nearest(table, F.expr("vec_id % 50 = 0")).collect())
    assert found == sorted((q, *row) for q, answer in expected for row in answer)


@pytest.mark.parametrize("held", [50, 1 << 21])
def test_nearest_sends_no_rows_to_the_driver_and_keeps_few_bounds(spark, monkeypatch, held):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(2600)]
    rows += [(3000 + i, [rng.uniform(-1, 1) for _ in range(9 + i % 40)]) for i in range(200)]  # many lengths, a file each
    expected = []
    for q, a in rows:
        if q % 50 == 0:
            cells = [(i, [int(np.floor(256 * x)) for x in b]) for i, b in rows if len(a) == len(b)]
            own = dict(cells)[q]
            scores = sorted((-sum(x * y for x, y in zip(own, b)), i) for i, b in cells if i != q)[:5]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    tables, collected, collect, keep = {}, [], type(spark.range(0)).collect, nearest.stored
    monkeypatch.setattr(nearest, "BLOCK", 64)
    monkeypatch.setattr(nearest, "_HELD", held, raising=False)
    monkeypatch.setattr(nearest, "dropped", lambda *tables: None, raising=False)
    monkeypatch.setattr(nearest, "stored", lambda df, name, *options: tables.setdefault((name, len(tables)), keep(df, name, *options)))
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda df: (collected.append(found := collect(df)), found)[1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of cells
    try:
        result = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.expr("vec_id % 50 = 0"))
        assert all(len(found) <= 1 for found in collected)
        assert Counter(tuple(r) for r in collect(result)) == Counter(expected)
        bounds = sum(df.filter("lower > 0").count() for (name, _), df in tables.items() if name == "found")
        blocks = next(df for (name, _), df in tables.items() if name == "cells").filter("length = 8").count()
        assert blocks >= 40 and bounds < 52 * blocks * 6 / (2 if held > 50 else 1)  # six a query of every block, by blocks alone
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# 10


def test_bpe(spark, tokenizer):
    library = tokenizer(BYTES)
    rows = bpe.decoded(bpe.encoded(documents(spark), BYTES), BYTES).collect()
    ids = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows)
    expected = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in texts()]
    assert ids == Counter((i, tuple(x), library.decode(x, skip_special_tokens=False)) for i, x in expected)
    assert bpe.encoded(empty(spark), BYTES).count() == 0


def test_bpe_on_random_texts(tokenizer):
    library, own = tokenizer(BYTES), bpe.Bpe(bpe.vocabulary(BYTES))
    rng = random.Random(1)
    letters = " \n\tabcABC'sltd019.,!é à́日<|endoftext|>\x1c٠ǅ"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_forced_boundaries_keep_the_ids(tokenizer):
    own = bpe.Bpe(bpe.vocabulary(BYTES))
    word = ("ab" * 40 + "日本" * 30).encode()
    assert b"".join(own.fragments(word)) == word
    assert [i for part in own.fragments(word) for i in own._merged(part)] == own._merged(word)


def test_words_are_cut_as_the_library_cuts_them():
    from tokenizers.pre_tokenizers import ByteLevel

    library, own = ByteLevel(add_prefix_space=False, use_regex=True), bpe.Bpe(bpe.vocabulary(BYTES))
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    known = [c for c in every if not bpe._unsettled().match(c)]
    for group in (known, ["\U0001915a", "\U000e0fff", "\u0378"]):
        text = "\n".join(f"a{c}\u9031{c}1{c}! {c}" for c in group)
        assert own._split(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


def test_bpe_query(spark, tokenizer, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    library = tokenizer(BYTES)
    expected = Counter()
    for doc_id, text in texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        expected[doc_id, len(ids), *digests] += 1
    found = bpe.query(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(tuple(r) for r in found) == expected


def test_merging_in_step_and_forgetting(tokenizer, monkeypatch):
    library, own = tokenizer(BYTES), bpe.Bpe(bpe.vocabulary(BYTES))
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    rng = random.Random(8)
    rows = [" ".join("".join(rng.choice("abcdefinorst,.'9é日\u0378") for _ in range(rng.randint(1, 60))) for _ in range(30)) for _ in range(100)]
    rows += ["", "a  b", " a", "a\n\nb\tc<|endoftext|> d", "x<|endoftext|>y z", "1915\U0001915a"]
    for at in range(0, len(rows), 7):
        part = rows[at : at + 7]
        assert own.encode_all(part).to_pylist() == [library.encode(t, add_special_tokens=False).ids for t in part]
    split = pa.array([[own.single[0xE6]], None, [], own.encode("日本")], pa.list_(pa.int32()))
    assert own.decode_all(split).to_pylist() == ["\ufffd", "", "", "日本"]
