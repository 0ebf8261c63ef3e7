"""Line deduplication by an exact set-similarity join. DataFrame functions only.

A line is its set of distinct lower-case words. Two lines match if the Jaccard similarity of
their sets is at least 4/5; a line goes if it matches an earlier one (by doc_id, then line
number), in its own document or another. Equal lines are found by their hash; the others by the join:

* the words of a line are put in order of rarity, and only a prefix of them can hold the
  first word that two matching lines share, so lines meet on prefix words alone;
* a pair is dropped if the lengths, the places of the shared word, or the parity of the words'
  hash bits (two sets differ in at least as many words as their parities do) exclude the similarity;
  lines of more than ``LONG`` words have two words of parity bits, as one would exclude few of them;
* the pairs left are verified on the full sets.

Rarity is counted over all texts in ``BUCKETS`` hashed counters, a fixed size, kept as a byte each
(steps of a third of an octave); any order gives the same result, a rough one only more pairs. The counters are one row of a
stored table: no plan holds them. The lines that
share a prefix word, one for each text of a line, are first compared with the earliest one of them; only lines
that match nothing earlier there are compared with all earlier ones, so variants of one line cost
one comparison each. (In groups of up to ``FEW`` lines all are compared that may not match the earliest one, in one shuffle for both sides,
and lines that go already are left out of the pairs: to look them up first costs more. Lines that may match the earliest one but
match none are compared with the others after that.) That second comparison takes the words in ``ROUNDS`` parts, one after the other, and each
job removes its shuffle files, which bounds the disk in use; intermediate tables are deleted when their last reader is done.

Copies of very frequent lines (at least one in ``SHARE`` lines; at most ``SHARE`` such lines
exist, which bounds the table that is broadcast) do not enter the join: the first one stands for them.

Defined results: null texts have no lines; blank lines are kept and match nothing; a document that
is repeated with its doc_id is treated as one and every copy is cleaned alike; rows that share a
doc_id but not the text are cleaned each, and none of them is earlier at the same line number. Null
doc_ids come first. Line ends are "\\n"; words are parted by blanks, tabs and carriage returns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candlewick.llm.common import dropped, stored, table

BUCKETS = 1 << 18
SHARE = 10_000
# Keys are a rank of 7 bits before 56 bits of the word's hash.
_HASH_BITS = 56
_CHUNK = 1 << 10
ROUNDS = 4
FEW = 1024
LONG = 64
_PACKED = {"compression": "zstd"}


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, line_a, line_b) of every line that is not blank."""
    exploded = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return exploded.withColumns(
        {"line_a": F.xxhash64("line"), "line_b": F.xxhash64(F.lit(1), "line")}
    ).filter(F.trim(_blanks(F.col("line"))) != "")


def _blanks(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))


def _words(line: Column) -> Column:
    """The distinct words of a line as hashes."""
    hashes = F.transform(F.split(_blanks(F.lower(line)), " "), lambda w: F.xxhash64(w))
    return F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit(""))))


def _ranks(docs: DataFrame) -> DataFrame:
    """(ranks): a printable character for each counter that grows with the count of its words; one row of ``BUCKETS`` bytes, whatever the input."""
    word = F.explode(F.split(F.replace(_blanks(F.lower("text")), F.lit("\n"), F.lit(" ")), " ")).alias("word")
    bucket = F.xxhash64("word").bitwiseAND(BUCKETS - 1)
    counts = docs.select(word).filter("word <> ''").groupBy(bucket.alias("id")).agg(F.count("*").alias("n"))
    level = F.least(F.lit(94), F.floor(3 * F.log2(1 + F.coalesce("n", F.lit(0))))).cast("int")
    chunk = F.floor(F.col("id") / _CHUNK)
    levels = docs.sparkSession.range(BUCKETS).join(counts, "id", "left").select("id", F.char(32 + level).alias("c"))
    joined = lambda entries: F.array_join(F.sort_array(F.collect_list(entries))["c"], "")
    chunks = levels.groupBy(chunk.alias("id")).agg(joined(F.struct("id", "c")).alias("c"))
    return stored(chunks.agg(joined(F.struct("id", "c")).cast("binary").alias("ranks")), "ranks")


def _keys(line: Column, ranks: Column) -> Column:
    """The words of a line in order of rarity, as numbers that sort by it."""

    def key(word: Column) -> Column:
        at = word.bitwiseAND(BUCKETS - 1).cast("int") + 1
        rank = F.ascii(F.substr(ranks, at, F.lit(1)).cast("string")) - 32
        return F.shiftleft(rank.cast("long"), _HASH_BITS).bitwiseOR(F.shiftrightunsigned(word, 64 - _HASH_BITS))

    return F.sort_array(F.transform(_words(line), key))


def _parity(keys: Column, of: Callable[[Column], Column] = lambda key: F.lit(1).cast("long")) -> Column:
    """For each of 64 hash values, whether an odd number of the words has it; ``of`` is 1 for words that count, 0 for others."""
    bit = lambda key: F.call_function("shiftleft", of(key), key.bitwiseAND(63).cast("int"))
    return F.aggregate(keys, F.lit(0).cast("long"), lambda bits, key: bits.bitwiseXOR(bit(key)))


def _upper(key: Column) -> Column:
    """One more hash bit of a word."""
    return F.shiftrightunsigned(key, 6).bitwiseAND(F.lit(1).cast("long"))


def _fits(x: str, y: str) -> Column:
    """Length, positional and parity filters for lines x and y that share the word at places x.i and y.i."""
    nx, ny, ix, iy = (F.col(f"{side}.{c}") for c in ("n", "i") for side in (x, y))
    lengths = 5 * F.least(nx, ny) >= 4 * F.greatest(nx, ny)
    # An overlap of o makes similarity 4/5 if 9 o >= 4 (nx + ny); this word and what follows it bound the overlap.
    all_, upper = (F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")) for c in ("parity", "upper"))
    of_long = F.bit_count(upper) + F.bit_count(all_.bitwiseXOR(upper))  # of the words with the bit, and of those without it
    differing = F.when(F.least(nx, ny) > LONG, of_long).otherwise(F.bit_count(all_))
    return lengths & (9 * F.least(nx - ix, ny - iy) >= 4 * (nx + ny)) & (9 * differing <= nx + ny)


def _shared(lines: DataFrame, frequent: DataFrame, ranks: DataFrame) -> DataFrame:
    """(word, doc_id, line_no, line_a, n, i, parity, upper, leader_a, led, size): the prefix words that different lines share.

    Of the copies of a line the earliest one stands for them; leader_a is the earliest of the ``size`` lines of a word, and led
    tells that a line may match it.
    """
    at_first = F.col("kept").isNull() | (F.struct("doc_id", "line_no") == F.col("kept"))
    single = lines.join(F.broadcast(frequent), ["line_a", "line_b"], "left").filter(at_first)
    ranked = single.withColumn("ranks", ranks.scalar())
    keyed = ranked.select("doc_id", "line_no", "line_a", _keys(F.col("line"), F.col("ranks")).alias("keys")).withColumn("n", F.size("keys"))
    upper = F.when(F.col("n") > LONG, _parity(F.col("keys"), _upper)).otherwise(0)
    keyed = keyed.withColumns({"parity": _parity(F.col("keys")), "upper": upper})
    prefix = F.expr("slice(keys, 1, n - (4 * n + 4) div 5 + 1)")
    postings = keyed.select("doc_id", "line_no", "line_a", "n", "parity", "upper", F.posexplode(prefix).alias("i", "word"))
    of_word = Window.partitionBy("word")
    copy = F.coalesce(F.lag("line_a").over(of_word.orderBy("line_a", "doc_id", "line_no")) == F.col("line_a"), F.lit(False))
    firsts = postings.withColumn("copy", copy).filter("not copy").drop("copy")
    entry = F.struct("doc_id", "line_no", "line_a", "n", "i", "parity", "upper")
    grouped = firsts.withColumns({"leader": F.min(entry).over(of_word), "size": F.count("*").over(of_word)}).filter("size > 1")
    led = (F.col("line_a") != F.col("leader.line_a")) & _fits("leader", "own")
    own = F.struct("n", "i", "parity", "upper")
    return grouped.withColumn("own", own).withColumns({"led": led, "leader_a": F.col("leader.line_a")}).drop("leader", "own")


def _verified(pairs: DataFrame, lines: DataFrame, classes: DataFrame) -> DataFrame:
    """The line_a of the later line of each pair (x, y) whose sets are similar; only their lines are read again."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("line_a")).distinct()
    at = classes.join(wanted, "line_a").select("line_a", "line_b", "first.doc_id", "first.line_no").alias("w")
    same = F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))
    for column in ("line_no", "line_a", "line_b"):
        same = same & (F.col(f"l.{column}") == F.col(f"w.{column}"))
    found = lines.alias("l").join(at, same, "left_semi").select("line_a", F.struct("doc_id", "line_no").alias("at"), _words(F.col("line")).alias("words"))
    sets = stored(found.dropDuplicates(["line_a"]), "sets", _PACKED)
    x, y = (sets.select(F.col("line_a").alias(s), F.col("at").alias(f"{s}_at"), F.col("words").alias(f"{s}_words")) for s in "xy")
    common = F.size(F.array_intersect("x_words", "y_words"))
    similar = (9 * common >= 4 * (F.size("x_words") + F.size("y_words"))) & (F.col("x_at") != F.col("y_at"))
    both = pairs.join(x, "x").join(y, "y").filter(similar)
    later = stored(both.select(F.when(F.col("x_at") < F.col("y_at"), F.col("y")).otherwise(F.col("x")).alias("line_a")).distinct(), "later")
    dropped(sets)
    return later


def _similar(lines: DataFrame, classes: DataFrame, frequent: DataFrame, ranks: DataFrame) -> DataFrame:
    """(line_a) of the lines that match an earlier one of another text."""
    shared = stored(_shared(lines, frequent, ranks), "shared", _PACKED)
    stars = stored(shared.filter("led").select(F.col("leader_a").alias("x"), F.col("line_a").alias("y")).distinct(), "stars", _PACKED)
    matched = _verified(stars, lines, classes)

    # Lines that go already need no second comparison; the leader has been compared with all.
    def earlier(x: DataFrame, y: DataFrame) -> DataFrame:
        before = F.struct("x.doc_id", "x.line_no") < F.struct("y.doc_id", "y.line_no")
        # Asked in this form, both sides keep the same columns and rows, and are one shuffle.
        waits = F.when(F.col("x.led").isNotNull(), ~F.col("y.led"))
        met = x.alias("x").join(y.alias("y"), F.col("x.word") == F.col("y.word")).filter(waits & before & _fits("x", "y"))
        return met.select(F.col("x.line_a").alias("x"), F.col("y.line_a").alias("y"))

    others = shared.filter("size > 2 and line_a <> leader_a").drop("leader_a")
    # Led lines that match no leader after all, compared as those that are not led.
    refused = others.filter((F.col("size") <= FEW) & F.col("led")).join(matched, "line_a", "left_anti")
    refused = stored(refused.drop("size").withColumn("led", F.lit(False)), "refused", _PACKED)
    parts = []
    for part in range(ROUNDS):
        here = F.pmod("word", F.lit(ROUNDS)) == part
        few, many = (others.filter(here & size).drop("size") for size in (F.col("size") <= FEW, F.col("size") > FEW))
        left = many.join(matched, "line_a", "left_anti").withColumn("led", F.lit(False))
        met = earlier(few, few).union(earlier(few, refused.filter(here))).union(earlier(many, left))
        parts.append(stored(met.distinct(), "rest", _PACKED))
    dropped(shared, refused)
    rest = functools.reduce(DataFrame.unionByName, parts).distinct().join(stars, ["x", "y"], "left_anti")
    rest = rest.join(matched, F.col("y") == F.col("line_a"), "left_anti")
    pairs = stored(rest, "pairs", _PACKED)
    dropped(stars, *parts)
    later = _verified(pairs, lines, classes)
    similar = stored(matched.union(later).distinct(), "similar")
    dropped(pairs, matched, later)
    return similar


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_lines, removed): for each distinct document, its lines and the numbers of those that go."""
    docs = docs.select("doc_id", "text")
    lines = _lines(docs)
    classes = lines.groupBy("line_a", "line_b").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("copies"))
    classes = stored(classes, "classes", _PACKED)
    total = classes.agg(F.sum("copies")).first()[0] or 0
    frequent = classes.filter(F.col("copies") * SHARE >= max(total, 1)).select("line_a", "line_b", F.col("first").alias("kept"))
    ranks = _ranks(docs)
    similar = _similar(lines, classes, frequent, ranks)
    dropped(ranks)

    # A copy that is not the first goes, and so does a first one that an earlier line matches.
    marked = classes.join(similar.withColumn("goes", F.lit(True)), "line_a", "left").filter("goes or copies > 1").drop("copies")
    numbered = lines.select("doc_id", "text_key", "line_no", "line_a", "line_b")
    judged = numbered.join(marked, ["line_a", "line_b"])
    goes = (F.struct("doc_id", "line_no") > F.col("first")) | F.col("goes")
    removed = judged.filter(goes).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    counted = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.size(F.split("text", "\n")).alias("n_lines"))
    same = F.col("c.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("c.text_key") == F.col("r.text_key"))
    return counted.alias("c").join(removed.alias("r"), same, "left").select(
        "c.doc_id", "c.text_key",
        F.greatest(F.coalesce("n_lines", F.lit(0)), F.lit(0)).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, the removed lines cut out of ``text``; a null text stays null."""
    found = removed_lines(docs).filter(F.size("removed") > 0).dropDuplicates(["doc_id", "text_key"])
    found = stored(found.select(F.col("doc_id").alias("_line_doc"), F.col("text_key").alias("_line_key"), F.col("removed").alias("_line_removed")), "removed")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_line_doc")) & (F.xxhash64("text") == F.col("_line_key"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(F.col("_line_removed"), i)), "\n")
    joined = docs.join(found, same, "left")
    text = F.when(F.col("_line_removed").isNull(), F.col("text")).otherwise(kept)
    return joined.withColumn("text", text).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: for each document the numbers of the lines that go."""
    found = removed_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")
