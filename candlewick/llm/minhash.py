"""Near-duplicate documents by circulant MinHash.

A document is its set of distinct word shingles. One permutation scatters the shingles over
the circle of 64-bit numbers; a second one, turned by k places, gives the k-th coordinate of
the signature as the least value over the set. Two permutations so make all coordinates.
Bands of coordinates select candidates, and a link needs Jaccard similarity of at least
``SIMILAR``/100 on the full sets.

Documents with equal sets form a class first, and the classes are the nodes of the graph. In each
bucket of a band, all members are compared with one hub, the member that shares most buckets
with others. After these links are joined to components, members outside the component of their bucket's hub are
compared with the members of other components next to them in the order of the bucket, and components are joined again. Near copies
so mostly find a partner early. Of the pairs of a bucket that are still in different components, those are compared that share one of the
rarest shingles of either: of similar sets, the part that is left out of both in order of rarity cannot hold all they share. So
no pair of similar sets is left out, and members that differ in shingles of their own do not meet. For members x and y and
the hub h, at most |x & h| + |y - h| elements are common, and a neighbour that this bound excludes is not
read. Nor are pairs whose sizes, the last bits of whose signatures, or, in the last step, whose shingles counted modulo 2 by their
last bits exclude the similarity.

With 24 bands of 4 coordinates a pair at similarity 0.8 is missed with probability 3e-6.

Defined results: null and empty texts have empty sets and are linked with nothing. Fewer words than a
shingle make one shingle. Rows that share a doc_id are one document: whatever one of their texts is linked with
is reached through it; a row without words stays alone under its doc_id. A row without doc_id
takes the component of its copies, or stays alone. ``deduplicated`` judges texts, not doc_ids: there, rows that
share a doc_id but not the set are two documents.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from candlewick.llm.common import mapped, stored, table
from candlewick.llm.components import components
from candlewick.llm.shingles import mixed, shingles, word_hashes

SIMILAR = 80
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
#: Unequal last bits of two signatures of similarity 0.8: 9.6 are expected of 96; 30 is 7 deviations more.
MOST_UNEQUAL = 30
_AT_ONCE = 1 << 15
_SALTS = 64
#: Places around a member whose members it is compared with first.
_FIRST = 1
#: Numbers of 64 bits that say, for each of their bits, whether an odd number of shingles has it.
_PARITIES = 4

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bits_a long, bits_b long"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of coordinates for each non-empty set."""
    out = np.empty((len(sets), COORDINATES), np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    at = 0
    while at < len(sets):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + _AT_ONCE, side="right")))
        scattered = mixed(np.concatenate(sets[at:stop]), 0x9FB21C651E98DF25, 0xD1342543DE82EF95)
        begins = (ends[at:stop] - base) - np.array([len(s) for s in sets[at:stop]])
        for k in range(COORDINATES):
            turned = mixed(scattered - np.uint64(k), 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
            out[at:stop, k] = np.minimum.reduceat(turned, begins)
        at = stop
    return out


def _bands(rows: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(rows), BANDS), np.uint64)
    keys += np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + rows[:, r::ROWS], 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15)
    return keys.view(np.int64)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Per document: number of shingles, 128 bits that name its set, band keys and signature bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(48, dtype=np.uint64)
        for batch in batches:
            sets = [np.unique(shingles(word_hashes(t), width)) for t in batch["text"].to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            names = np.zeros((len(sets), 2), np.int64)
            bits = np.zeros((len(sets), 2), np.int64)
            counts = np.zeros(len(sets), np.int64)
            keys = np.zeros((0, BANDS), np.int64)
            if full:
                rows = signatures([sets[i] for i in full])
                keys = _bands(rows)
                last = rows & np.uint64(1)
                bits[full, 0], bits[full, 1] = last[:, :48] @ weights, last[:, 48:] @ weights
                names[full] = [np.frombuffer(xxhash.xxh3_128_digest(sets[i]), np.int64) for i in full]
                counts[full] = BANDS
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1]),
                 pa.ListArray.from_arrays(offsets, keys.reshape(-1)), pa.array(bits[:, 0]), pa.array(bits[:, 1])],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "bits_a", "bits_b"],
            )

    return mapped(docs, run, _SIGNED)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the classes ``wanted`` (node, first, set_a, set_b); only texts of their first documents go to Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingles(word_hashes(t), width)) for t in batch["text"].to_pylist()]
            names = np.array([np.frombuffer(xxhash.xxh3_128_digest(s), np.int64) for s in sets], np.int64).reshape(-1, 2)
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names[:, 0]), pa.array(names[:, 1]), pa.ListArray.from_arrays(offsets, values)],
                ["first", "set_a", "set_b", "shingles"],
            )

    owners = stored(wanted.select(F.col("first").alias("doc_id")).distinct(), "owners")
    texts = docs.join(owners, "doc_id", "left_semi")
    found = mapped(texts.select("doc_id", "text"), run, "first long, set_a long, set_b long, shingles array<long>")
    # Rows that share a doc_id may have several sets, each a node of its own.
    return found.join(wanted, ["first", "set_a", "set_b"]).select("node", "shingles")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, similar) of the pairs (a, b) of nodes, by their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    both = both.select("a", "b", "common", (100 * F.col("common") >= SIMILAR * union).alias("similar"))
    return both.groupBy("a", "b").agg(F.max("common").alias("common"), F.max("similar").alias("similar"))  # of repeated rows


def _possible(a: str, b: str) -> Column:
    sizes = 100 * F.least(f"{a}.n", f"{b}.n") >= SIMILAR * F.greatest(f"{a}.n", f"{b}.n")
    unequal = sum(F.bit_count(F.col(f"{a}.{bits}").bitwiseXOR(F.col(f"{b}.{bits}"))) for bits in ("bits_a", "bits_b"))
    return sizes & (unequal <= MOST_UNEQUAL)


def _within_reach(a: str, b: str) -> Column:
    """Whether the overlaps with the hub of the bucket leave room for similarity; an overlap that was not measured is no bound."""
    least = SIMILAR * (F.col(f"{a}.m.n") + F.col(f"{b}.m.n"))
    most = [F.col(f"{x}.common") + F.col(f"{y}.m.n") - F.col(f"{y}.common") for x, y in ((a, b), (b, a))]
    return F.coalesce((100 + SIMILAR) * F.least(*most) >= least, F.lit(True))


def _buckets(heads: DataFrame) -> DataFrame:
    """(key, m, hub) of the members of all buckets of two or more; m and hub are (node, n, bits_a, bits_b)."""
    members = heads.select(F.explode("bands").alias("key"), "node")
    sizes = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(members.join(sizes, "key"), "shared")
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    info = F.struct("node", F.col("n_shingles").alias("n"), "bits_a", "bits_b")
    known = heads.join(weights, "node").select("node", "weight", info.alias("m"))
    weighed = members.select("key", "node").join(known, "node")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", "m")).alias("hub")).select("key", F.col("hub.m").alias("hub"))
    return stored(weighed.select("key", "m").join(hubs, "key"), "members")


def _ordered(members: DataFrame, found: DataFrame, overlaps: DataFrame) -> DataFrame:
    """The members (key, m, hub, common, size, at) of the buckets that hold several components, at their places 0 to size - 1."""
    placed = _with_components(members, found)
    several = placed.filter("component <> of_hub").select("key").distinct()
    ends = F.col("hub.node"), F.col("m.node")
    placed = members.join(several, "key", "left_semi").withColumns({"a": F.least(*ends), "b": F.greatest(*ends)})
    placed = placed.join(overlaps, ["a", "b"], "left").withColumn("salt", F.pmod(F.xxhash64("m.node"), F.lit(_SALTS)))
    common = F.when(F.col("a") == F.col("b"), F.col("m.n")).otherwise(F.col("common"))
    placed = stored(placed.select("key", "salt", "m", "hub", common.alias("common")), "placed")
    # Places are counted in two levels, so that a large bucket is not sorted in one task.
    whole = Window.partitionBy("key")
    counts = placed.groupBy("key", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(whole.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("key", "salt", before.alias("before"), F.sum("n").over(whole).alias("size"))
    within = F.row_number().over(Window.partitionBy("key", "salt").orderBy("m.node")) - 1
    return stored(placed.withColumn("within", within).join(counts, ["key", "salt"]).select(
        "key", "m", "hub", "common", "size", (F.col("before") + F.col("within")).alias("at")), "ordered")


def _with_components(members: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the component of each member, and that of its bucket's hub."""
    for name, node in (("component", "m.node"), ("of_hub", "hub.node")):
        known = found.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        members = members.join(known, F.col(node) == F.col("_node"), "left")
        members = members.withColumn(name, F.coalesce("_component", node)).drop("_node", "_component")
    return members


def _around(ordered: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of members up to ``_FIRST`` places apart in a bucket's circle, in different components, that may be similar."""
    now = stored(_with_components(ordered, found), "now")
    outside = now.filter("component <> of_hub and size > 1")
    distance = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(_FIRST).cast("long"), F.floor(F.col("size") / 2))))
    way = F.explode(F.array(F.lit(-1), F.lit(1)))
    x = outside.withColumn("distance", distance).withColumn("way", way)
    x = x.withColumn("other", F.pmod(F.col("at") + F.col("way") * F.col("distance"), F.col("size")))
    x, y = x.alias("x"), now.alias("y")
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.other") == F.col("y.at")))
    met = met.filter((F.col("x.component") != F.col("y.component")) & _possible("x.m", "y.m") & _within_reach("x", "y"))
    ends = F.col("x.m.node"), F.col("y.m.node")
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def _by_rarest(ordered: DataFrame, found: DataFrame, sets: DataFrame, heads: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a bucket, in different components, that may be similar and share a shingle of the rarest ones of both."""
    now = _with_components(ordered, found)
    several = now.filter("component <> of_hub").select("key").distinct()
    nodes = stored(now.join(several, "key", "left_semi").select("m.node", "component").distinct(), "nodes")
    shingle = sets.dropDuplicates(["node"]).join(nodes, "node").select("node", F.explode("shingles").alias("shingle"))
    shingle = stored(shingle, "shingles")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftrightunsigned(shingle, 8), 64) as int))")
    parity = [F.bit_xor(F.when(F.pmod("shingle", F.lit(_PARITIES)) == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"parity_{k}") for k in range(_PARITIES)]
    parities = shingle.groupBy("node").agg(*parity)
    counts = shingle.groupBy("shingle").agg(F.count("*").alias("count")).filter("count > 1")
    shared = shingle.join(counts, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("rare"))
    info = heads.select("node", F.col("n_shingles").alias("n"), "bits_a", "bits_b")
    known = shared.join(nodes, "node").join(info, "node").join(parities, "node").withColumn("own", F.col("n") - F.size("rare"))  # those of no other set come first
    # Two similar sets share SIMILAR/100 of the larger one, so more than either has after its first n - SIMILAR n / 100 + 1 shingles.
    first = known.withColumn("first", F.expr(f"n - ({SIMILAR} * n + 99) div 100 + 1 - own").cast("int")).filter("first > 0")
    entry = F.struct("node", "component", "n", "bits_a", "bits_b", *(f"parity_{k}" for k in range(_PARITIES))).alias("m")
    postings = first.select(entry, "own", F.posexplode(F.expr("slice(rare, 1, first)")).alias("place", "word"))
    postings = postings.select(F.col("word.shingle").alias("shingle"), "m", (F.col("m.n") - F.col("own") - F.col("place")).alias("left"))
    postings = stored(postings, "postings")
    x, y = postings.alias("x"), postings.alias("y")
    # Two sets differ in at least as many shingles as their parities do.
    differing = sum(F.bit_count(F.col(f"x.m.parity_{k}").bitwiseXOR(F.col(f"y.m.parity_{k}"))) for k in range(_PARITIES))
    near = (100 + SIMILAR) * differing <= (100 - SIMILAR) * (F.col("x.m.n") + F.col("y.m.n"))
    fits = (100 + SIMILAR) * F.least("x.left", "y.left") >= SIMILAR * (F.col("x.m.n") + F.col("y.m.n"))
    met = x.join(y, F.col("x.shingle") == F.col("y.shingle"))
    met = met.filter((F.col("x.m.node") < F.col("y.m.node")) & (F.col("x.m.component") != F.col("y.m.component")) & fits & near & _possible("x.m", "y.m"))
    met = stored(met.select(F.col("x.m.node").alias("a"), F.col("y.m.node").alias("b")).distinct(), "met")
    bands = [heads.select(F.col("node").alias(c), F.col("bands").alias(f"{c}_bands")) for c in "ab"]
    return met.join(bands[0], "a").join(bands[1], "b").filter(F.arrays_overlap("a_bands", "b_bands")).select("a", "b")


def linked(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows (doc_id, n_shingles, set_a, set_b, node, first); the classes (node, first, set_a, set_b) of equal sets, first
    being the smallest doc_id; and (node, component) of the classes that are linked with others."""
    rows = stored(signed(docs, width), "signed")
    worded = rows.filter("n_shingles > 0")
    classes = worded.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("first")).withColumn("node", F.monotonically_increasing_id())
    classes = stored(classes, "classes")
    named = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b"], "left")
    heads = worded.join(classes.withColumnRenamed("first", "doc_id"), ["set_a", "set_b", "doc_id"]).dropDuplicates(["node"])
    heads = stored(heads.select("node", "n_shingles", "bands", "bits_a", "bits_b"), "heads")
    members = _buckets(heads)
    wanted = stored(members.select(F.col("m.node").alias("node")).distinct().join(classes, "node"), "wanted")
    sets = stored(_sets(docs, wanted, width), "sets")

    ends = F.col("m.node"), F.col("hub.node")
    stars = members.filter(ends[0] != ends[1]).filter(_possible("m", "hub"))
    stars = stored(stars.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct(), "stars")
    overlaps = stored(measured(stars, sets), "overlaps")
    found = stored(components(overlaps.filter("similar").select("a", "b")), "components")

    ordered = _ordered(members, found, overlaps.select("a", "b", "common"))
    compared = stars
    for step in (_around, functools.partial(_by_rarest, sets=sets, heads=heads)):
        pairs = stored(step(ordered, found).join(compared, ["a", "b"], "left_anti"), "pairs")
        late = stored(measured(pairs, sets).filter("similar").select("a", "b"), "late")
        if not late.isEmpty():
            found = stored(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)), "components")
        compared = compared.unionByName(pairs)
    return named, classes, found


def grouped(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``; kept is the smallest doc_id of a component."""
    named, classes, found = linked(docs.select(F.col("doc_id").cast("long"), "text"), width)
    # Several sets under one doc_id belong together.
    known = named.filter("doc_id is not null and node is not null").select("doc_id", "node")
    ends = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high")).filter("a <> high").select("doc_id", "a")
    same = stored(known.join(ends, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b").distinct(), "same")
    if not same.isEmpty():
        found = stored(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(same)), "components")
    placed = found.join(classes.select("node", "first"), "node")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = placed.join(least, "component").select("node", "component_id")
    component = F.coalesce("component_id", "first", "doc_id")
    return named.join(of_node, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def deduplicated(docs: DataFrame, width: int = 5) -> DataFrame:
    """One row of each group of near copies, all columns: of the set with the smallest doc_id, the row of that doc_id.

    Rows without words or without doc_id stay. Of rows with the same doc_id and set the one with the smallest text stays.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    named, classes, found = linked(narrow, width)
    placed = found.join(classes.select("node", "first"), "node")
    heads = placed.groupBy("component").agg(F.min(F.struct("first", "node")).alias("head"))
    gone = placed.join(heads, "component").filter(F.col("node") != F.col("head.node")).select("node", F.lit(True).alias("gone"))
    judged = named.filter("doc_id is not null").join(gone, "node", "left")
    goes = F.coalesce("gone", F.lit(False)) | F.coalesce(F.col("doc_id") != F.col("first"), F.lit(False))
    again = F.when(F.max("n_shingles") > 0, F.count("*") - 1).otherwise(0).alias("again")
    judged = stored(judged.groupBy("doc_id", "set_a", "set_b").agg(F.max(goes).alias("goes"), again), "judged")
    by_doc = judged.groupBy("doc_id").agg(F.min("goes").alias("all_go"), F.max("goes").alias("some_go"), F.max("again").alias("again"))
    touched = stored(by_doc.filter("some_go or again > 0"), "touched")
    left = docs.alias("d").join(touched.alias("t"), F.col("d.doc_id").cast("long") == F.col("t.doc_id"), "left_anti")

    # Documents of which one text goes and another stays, or that are repeated: chosen by their sets.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long"), "text")
    packed = packed.join(touched.filter("not all_go"), "doc_id", "left_semi").select("doc_id", "text", "row")
    names = _named(packed, width).join(judged.filter("not goes"), ["doc_id", "set_a", "set_b"])
    wordless = names.filter("n_shingles = 0").select("row.*")
    one = names.filter("n_shingles > 0").groupBy("doc_id", "set_a", "set_b").agg(F.min_by("row", "text").alias("row")).select("row.*")
    return left.select(*(F.col(f"d.`{c}`") for c in docs.columns)).union(wordless).union(one)


def _named(packed: DataFrame, width: int) -> DataFrame:
    """Adds the size and the name of the set of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingles(word_hashes(t), width)) for t in batch["text"].to_pylist()]
            names = [np.frombuffer(xxhash.xxh3_128_digest(s), np.int64) if len(s) else np.zeros(2, np.int64) for s in sets]
            names = np.array(names, np.int64).reshape(-1, 2)
            columns = [*batch.columns, pa.array([len(s) for s in sets], pa.int64()), pa.array(names[:, 0]), pa.array(names[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_shingles", "set_a", "set_b"])

    added = T.StructType().add("n_shingles", "long").add("set_a", "long").add("set_b", "long")
    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, *added.fields]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: components of documents by sets of two-word shingles."""
    return grouped(table(spark, sf_dir, "documents"), width=2)
