"""Spelling variants, the quality classifier and ranked search against brute force, on awkward rows and on empty tables."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from candlewick.llm import quality, ranking, registry, variants, words
from tests.llm.tables import documents, empty, texts
from tests.parity import differences, duck

SF_DIR = "/root/testdata/sf0.001"


def test_pieces_keep_the_words():
    text = " ".join("x" * (i % 17) for i in range(3000)) + "  " + "y" * 500
    for size in (1, 7, 100, 10**6):
        assert [w for p in words.pieces(text.encode(), size) for w in p.split()] == text.encode().split()
        assert [w for p in words.text_pieces(text.replace("x x", "x x"), size) for w in p.split()] == text.split()


# 11


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, least_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= 2 * n[w] else None for w, b in best.items()}
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=str)


def variant_rows():
    rng = random.Random(11)
    roots = ["".join(rng.choice("etaoén") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(400):
        some = []
        for word in rng.choices(roots, [1 / (k + 1) for k in range(60)], k=20):
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "e" + word[at:], word[:at] + "a" + word[at + 1 :]])
            some.append(rng.choice([word, word.upper(), word.title()]))
        rows.append((None if i % 50 == 0 else i // 2, rng.choice([" ", ", ", "\n", "日", "\xb5", "3"]).join(some)))
    rows += [(i, "ÀÉ×÷ßÿ ÀÉ×÷ßy " + "z" * 3000 + " " + "z" * 2999) for i in range(4)]
    return rows + texts()


@pytest.mark.parametrize("block", [variants.BLOCK, 8])
def test_variants(spark, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    rows = variant_rows()
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, word int")
    found = sorted((tuple(r) for r in variants.variants(table).collect()), key=str)
    expected = brute_variants(rows)
    assert found == expected and sum(r[1] is not None for r in found) > 50
    assert any(r[1] != r[2] for r in found if r[1])  # chains of forms


def test_every_edit_stays_between_neighbouring_cells():
    rng = random.Random(3)
    for _ in range(2000):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzàéÿ") for _ in range(rng.randint(5, 9)))
        at = rng.randrange(len(word))
        other = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("xqé") + word[at + 1 :]])
        a, b = variants.cell_of(word), variants.cell_of(other)
        met = (b in variants.neighbours(a)) + (a in variants.neighbours(b))
        assert met == (2 if a == b else 1)


def test_squared_distances_of_long_words_are_exact():
    codes = np.full((2, 70_000), ord("a"), np.uint8)
    codes[1, 0] = ord("b")
    counts = variants.letter_counts(codes)
    assert variants.squared_distances(counts, counts).tolist() == [[0, 2], [2, 0]]


def test_variants_of_awkward_and_empty_tables(spark):
    found = sorted((tuple(r) for r in variants.variants(documents(spark)).collect()), key=str)
    assert found == brute_variants(texts())
    assert variants.variants(empty(spark)).count() == 0


# 12


def quality_rows():
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        some = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))]
        good = i % 3 != 0
        if not good:
            some = [[w.upper() + "!!" for w in some], [w + rng.choice(["###", "%%"]) for w in some], some[:1] * len(some)][i % 9 // 3]
        rows.append((i, " ".join(some)))
        labels.append((i, int(good), "x"))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1, None), (5, None, None), (6, 7, None)], "doc_id long, quality int, text string")
    model = quality.fit(docs, quality.labelled(known))
    found = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = [(found[i] >= 0.5) == bool(labels[i][1]) for i in held]
    assert len(held) > 100 and sum(right) >= 0.98 * len(held)
    awkward = quality.scored(documents(spark), model).collect()
    assert Counter(r.doc_id for r in awkward) == Counter(i for i, _ in texts())
    assert all(0 <= r.score <= 1 for r in awkward)
    of_none = {r.score for r in awkward if r.doc_id in (4, 5, 6)}
    assert of_none == {1 / (1 + math.exp(-model.bias))}
    assert quality.scored(empty(spark), model).count() == 0
    nothing = quality.fit(docs, known.limit(0))
    assert {r.score for r in quality.scored(docs, nothing).collect()} == {0.5}


def test_quality_fit_uses_no_held_out_label(spark, tmp_path):
    rows, labels = quality_rows()
    spark.createDataFrame([*rows, (None, "no id")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q, _ in labels]
    results = []
    for name, known in (("a", [(i, q) for i, q, _ in labels]), ("b", turned)):
        spark.createDataFrame(known, "doc_id long, quality int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        results.append({r.doc_id: (r.held_out, r.score, r.predicted) for r in quality.query(spark, str(tmp_path)).collect()})
    assert results[0] == results[1]
    assert all(v[0] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) for i, v in results[0].items())
    assert all(v[2] == int(v[1] >= 0.5) for v in results[0].values())


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = "The  the cat,\nsat sat été 日本 \ud800 " * 40
    whole = quality.bag(text)
    monkeypatch.setattr(quality, "text_pieces", lambda t: words.text_pieces(t, 50))
    cut = quality.bag(text)
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert not len(quality.bag(None)[0]) and not len(quality.bag(" \n")[0])
    assert quality.bag("a")[1].sum() == 2  # the word, and its one piece
    assert quality.bag("ab cd ab")[1].max() >= 2


# 13


def brute_ranking(rows, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(i, Counter(split(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    number, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in docs:
            m = 100 - 90 + (90 * c.total() * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(split(text)) if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, n, i, -s) for n, (s, _, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def ranking_rows():
    rng = random.Random(13)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    draw = lambda n: " ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(150)], k=n))
    rows = [(i, draw(rng.randint(1, 60))) for i in range(500)]
    rows += [(600 + i, rows[7][1]) for i in range(40)] + [(None, rows[7][1]), (7, rows[7][1].upper()), (8, "_ - !")]
    items = [(i, draw(rng.randint(1, 25))) for i in range(40)]
    items += [(40, rows[7][1]), (40, rows[9][1]), (None, "a b"), (41, None), (42, ""), (43, "zzzz unheard"), (44, "the")]
    return rows + texts(), items


@pytest.mark.parametrize("sizes", [{}, {"SEGMENT": 50, "BLOCK": 4, "SUMMED": 4, "BLOCK_TERMS": 60}])
def test_ranking(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ranking, name, value)
    rows, items = ranking_rows()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, score int, item int")
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, score int, block int")
    found = sorted((tuple(r) for r in ranking.ranked(docs, asked).collect()), key=str)
    assert found == brute_ranking(rows, items)


def test_blocks_are_skipped_by_their_bounds(monkeypatch):
    """The search reads fewer documents than it has, and finds the same as reading all."""
    monkeypatch.setattr(ranking, "BLOCK", 16)
    monkeypatch.setattr(ranking, "SUMMED", 8)
    rng = np.random.default_rng(2)
    kinds = [rng.permutation(400)[:20] for _ in range(30)]
    vectors = [np.sort(rng.permutation(np.append(kinds[i % 30], rng.integers(0, 400, 3)))) for i in range(1500)]
    vectors = [np.unique(v) for v in vectors]
    impacts = [rng.integers(1, 1_000_000, len(v)) for v in vectors]
    starts = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
    s = ranking.segment(list(range(1500)), starts, np.concatenate(vectors), np.concatenate(impacts))
    for b in range(len(s.block_term)):
        rows = s.members[s.member_starts[b] : s.member_starts[b + 1]]
        own = slice(s.summary_starts[b], s.summary_starts[b + 1])
        most = Counter()
        for r in rows:
            assert s.block_term[b] in vectors[r]
            most |= Counter(dict(zip(vectors[r].tolist(), impacts[r].tolist())))
        assert own.start == own.stop or most == Counter(dict(zip(s.summary_terms[own].tolist(), s.summary_impacts[own].tolist())))
    weights = np.zeros(400, np.int64)
    terms = kinds[3][:6]
    weights[terms] = [500, 400, 300, 200, 100, 50]
    read = []
    products = ranking._products
    monkeypatch.setattr(ranking, "_products", lambda w, at, t, i, rows: read.append((at is s.starts) * len(rows)) or products(w, at, t, i, rows))
    best = ranking.Best(10)
    ranking.search(s, ranking.largest(s, 400), terms, weights, best)
    scores = np.array([int((weights[v] * i).sum()) for v, i in zip(vectors, impacts)])
    assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:10]
    assert sum(read) < 700


def test_ranking_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert ranking.ranked(empty(spark), items).count() == 0
    none = ranking.ranked(documents(spark), items.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranking_against_its_statement(spark):
    count, problem = differences(registry.queries()["op13_ranking"](spark, SF_DIR), duck(SF_DIR), registry.statements()["op13_ranking"])
    assert not problem and count > 0


def test_queries_return_the_columns_of_their_results(spark):
    schemas = {name: registry.queries()[name](spark, SF_DIR).dtypes for name in ("op11_variants", "op12_quality", "op13_ranking")}
    assert schemas["op11_variants"] == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert schemas["op12_quality"] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert schemas["op13_ranking"] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_variants_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in registry.queries()["op11_variants"](spark, SF_DIR).collect()), key=str)
    assert found == brute_variants(rows) and len(found) > 100
