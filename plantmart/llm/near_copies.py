"""Near-duplicates by SimHash, verified by the exact Jaccard similarity of word shingles; the rest by prefix filtering.

First come the links of op7's method (`simhash.py`), here over five-word shingles: fingerprints of 64 bits, found
within four bits through deletion-variant signatures. A text is compared with the nearest of
those that its fingerprint links it to; a link needs the similarity. Copies with a similarity of 0.8 differ by ten bits or so,
beyond any distance that such signatures can index. So what the fingerprints leave is found exactly, as follows.

The shingles of a text are a set of 64-bit hashes. All sets are put into one common order; two sets of n and
m shingles with similarity t or more have one in common among the first n - ceil(t n) + 1 of the one and the
first m - ceil(t m) + 1 of the other. Texts that share such a key are compared, so every pair in
question is, and a link needs the similarity itself; there is no loss of recall to be stated. The order
puts shingles last that a sample finds frequent. It decides on the work to do, not on the result. Sets of very
different sizes cannot be similar, so a key that several texts have is divided by classes of sizes; neighbouring
classes overlap.

Texts with equal sets are one node. In a first round each node that no fingerprint has linked to it is compared with one other only, the nearest of the
smallest nodes of its keys. That joins most groups with one comparison a node. Then only keys whose nodes are
still in several components go on: they compare eight of their nodes with the others, then 64, and so on to all, so a
crowd of near copies does not turn into all of its pairs.

Before whole sets are compared, their sketches are: parity bits, one for each group of hashes, as many as the set has
shingles or more. Of two lengths the longer sketch folds into the shorter. Two sketches never differ in more bits
than the sets do in shingles, so this drops only pairs without the similarity. The sets of what is left are made anew from the texts, which are read but not moved: a bitmap of fixed size tells the texts that may be
among those asked for, and what it lets through by chance goes in the join. Whole texts move once, for the result.

No step gathers a key: keys are counted by aggregates, and a key with many nodes is split by Spark in the joins. A
step's files are deleted when the next ones no longer need them.

Defined cases: words are folded and separated as for SimHash; texts shorter than a shingle are one
shingle; texts without a word, NULL among them, are copies of one another; repeated rows are one; rows without
a doc_id come last in their group; an extra column may have any name; texts of any length are read
whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays, simhash
from plantmart.llm.components import components
from plantmart.llm.storing import Steps

SIZE = 5
# Similarity in percent, so that the comparison is one of whole numbers.
PERCENT = 80
# Sampled counts of shingles are kept for this many groups of hashes.
SLOT_BITS = 20
SAMPLE = 16
# Nodes under one shingle that are compared pair by pair at once.
FEW = 32
# Bits of the map of texts whose sets are asked for: 1 MB.
TEXT_BITS = 23
# Words of 64 bits in the shortest sketch.
LEAST_WORDS = 8


def _sets(texts: pa.LargeBinaryArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted by hash, and how many lie before each text."""
    row, left, right, before = simhash.shingles(texts, size)
    hashes = arrays.word_hashes(row, left, right)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.concatenate(([0], np.cumsum(np.bincount(text[new], minlength=len(before) - 1))))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    """For each group of hashes how many doublings it lies above the mean, from a sample; of fixed size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for chunk in arrays.chunks(batches, most=simhash.SHINGLE_BYTES):
            total += np.bincount(_slot(_sets(chunk.column("text"), size)[0]), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["slot", "n"])

    steps = Steps(docs.sparkSession)
    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    sums = sample.mapInArrow(counted, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    sums = steps.store(sums, "near-sample")
    usual = max(8.0, 4 * (sums.agg(F.sum("n")).first()[0] or 0) / (1 << SLOT_BITS))
    level = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    # Less than an eighth of all slots can lie eight times above the mean.
    for r in sums.where(F.col("n") >= 2 * usual).toLocalIterator():
        level[r.slot] = int(np.log2(r.n / usual))
    steps.keep_only()
    return level


def _sketch(hashes: np.ndarray, before: np.ndarray) -> pa.Array:
    """Parities of the shingles of each text, by groups of hashes: a power of two of words of bits."""
    n = np.diff(before)
    words = LEAST_WORDS << np.ceil(np.log2(np.maximum(n / (64 * LEAST_WORDS), 1))).astype(np.int64)
    start = np.concatenate(([0], np.cumsum(words)))
    text = np.repeat(np.arange(len(n)), n)
    word = (hashes >> np.uint64(6)).astype(np.int64) & (words[text] - 1)
    bits = np.zeros(start[-1], dtype=np.uint64)
    np.bitwise_xor.at(bits, start[text] + word, np.uint64(1) << (hashes % np.uint64(64)))
    return pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(bits.view(np.int64)))


# Bits in which the sketches x and y differ; their words are numbered from zero.
_APART = """
aggregate(sequence(0, least(size(x), size(y)) - 1), 0, (total, i) -> total + bit_count(
  aggregate(sequence(i, size(x) - 1, least(size(x), size(y))), 0L, (word, j) -> word ^ x[j])
  ^ aggregate(sequence(i, size(y) - 1, least(size(x), size(y))), 0L, (word, j) -> word ^ y[j])))
"""


def _marked(docs: DataFrame, size: int, percent: int, level: np.ndarray) -> DataFrame:
    """doc_id, hash of the text, node, n (shingles), fingerprint, first (the shingles of the prefix) and the sketch of each row."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches, most=simhash.SHINGLE_BYTES):
            hashes, before = _sets(chunk.column("text"), size)
            n = np.diff(before)
            text = np.repeat(np.arange(len(n)), n)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(arrays.mix(hashes), dtype=np.uint64)))
            node = arrays.mix(sums[before[1:]] - sums[before[:-1]] + n.astype(np.uint64))
            ordered = hashes[np.lexsort((hashes, level[_slot(hashes)], text))]
            take = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
            taken = ordered[arrays.gathered(before[:-1], take)]
            offsets = np.concatenate(([0], np.cumsum(take))).astype(np.int32)
            first = pa.ListArray.from_arrays(pa.array(offsets), pa.array(taken.view(np.int64)))
            prints = pa.array(simhash.fingerprints_of(chunk.column("text"), size).view(np.int64))
            kept = [chunk.column("doc_id"), chunk.column("hash"), pa.array(node.view(np.int64)), pa.array(n), prints, first]
            names = ["doc_id", "hash", "node", "n", "fingerprint", "first", "sketch"]
            yield pa.RecordBatch.from_arrays([*kept, _sketch(hashes, before)], names)

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("hash"), "text")
    schema = "doc_id bigint, hash bigint, node bigint, n bigint, fingerprint bigint, first array<bigint>, sketch array<bigint>"
    return texts.mapInArrow(marked, schema)


def _text_map(rows: DataFrame) -> np.ndarray:
    """The bits of the hashes h1 of the rows: at most 2^TEXT_BITS, in pieces that Spark has merged."""
    # Spark numbers pieces and their first bit from one.
    slot = _text_slot() + 1
    pieces = rows.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("piece"))
    pieces = pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    flags = np.zeros((1 << TEXT_BITS) // 8, dtype=np.uint8)
    for r in pieces.toLocalIterator():
        at = (int(r.piece) - 1) * len(r.bits)
        flags[at : at + len(r.bits)] = np.frombuffer(r.bits, dtype=np.uint8)
    return flags


def _text_slot() -> Column:
    return F.pmod(F.col("h1"), F.lit(1 << TEXT_BITS))


def _sets_of(docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """node and its whole set of shingles; `rows` names one document (h1, h2) for each node.

    A document that is given twice gives its node twice, which does no harm to comparisons.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_text_map(rows))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = shared.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            asked = (flags[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0
            for chunk in arrays.chunks(iter([batch.filter(pa.array(asked))]), most=simhash.SHINGLE_BYTES):
                hashes, before = _sets(chunk.column("text"), size)
                found = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([chunk.column("h1"), chunk.column("h2"), found], ["h1", "h2", "shingles"])

    own = simhash.identity(F.col("doc_id"), F.xxhash64("text"))
    texts = docs.select(*[c.alias(name) for c, name in zip(own, ("h1", "h2"))], "text")
    found = texts.select(_text_slot().alias("slot"), "h1", "h2", "text").mapInArrow(whole, "h1 bigint, h2 bigint, shingles array<bigint>")
    return found.join(rows.hint("merge"), ["h1", "h2"]).select("node", "shingles")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets have the similarity. Spark splits an `a` in many pairs."""
    ones = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    others = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(others.hint("merge"), "b").join(ones.hint("merge"), "a")
    shared = F.size(F.array_intersect("x", "y")).cast("bigint")
    near = shared * 100 >= (F.size("x") + F.size("y") - shared) * percent
    return both.where(near).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _fingerprint_pairs(marked: DataFrame, steps: Steps) -> DataFrame:
    """Pairs (a, b) of nodes: each with the smallest of its fingerprint, and those of linked fingerprints."""
    prints = steps.store(marked.groupBy("node").agg(F.min("fingerprint").alias("fingerprint")), "near-prints")
    first = steps.store(prints.groupBy("fingerprint").agg(F.min("node").alias("first")), "near-firsts")
    alike = prints.join(first.hint("merge"), "fingerprint").where("node != first")
    found = steps.store(simhash.links(first.select("fingerprint")).distinct(), "near-simhash")
    ones = first.select(F.col("fingerprint").alias("u"), F.col("first").alias("a"))
    others = first.select(F.col("fingerprint").alias("v"), F.col("first").alias("b"))
    linked = found.join(ones.hint("merge"), "u").join(others.hint("merge"), "v")
    linked = linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = alike.select(F.col("first").alias("a"), F.col("node").alias("b")).unionByName(linked)
    return steps.store(pairs.distinct(), "near-candidates")


def _several(keyed: DataFrame) -> DataFrame:
    """(key, node, n) of the keys that several nodes have."""
    several = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi")
    return keyed.join(several.select("key").hint("merge"), "key")


def _live(marked: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """(key, node, n) of the keys that several nodes of like sizes have.

    A class holds sizes up to a little more than 100 / percent apart, so similar sets lie in one class or in
    neighbouring ones; each node stands in its own and in the next.
    """
    shared = steps.store(_several(marked.select(F.explode("first").alias("key"), "node", "n").distinct()), "near-shared")
    size = F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / F.lit(float(np.log(101 / percent))))
    classed = shared.withColumn("class", F.explode(F.array(size, size + 1)))
    return _several(classed.select(F.xxhash64("key", "class").alias("key"), "node", "n").distinct())


def _fit(percent: int):
    """Whether sets of n and m shingles can have the similarity."""
    return F.least("n", "m") * 100 >= F.greatest("n", "m") * percent


def _open(live: DataFrame, roots: DataFrame | None, steps: Steps) -> DataFrame:
    """Rows of the keys with nodes of several components: label, and of the key its count and smallest node."""
    labelled = live.withColumn("label", F.col("node"))
    if roots is not None:
        labelled = live.join(roots.hint("merge"), "node", "left")
        labelled = labelled.select("key", "node", "n", F.coalesce("root", "node").alias("label"))
        # Written, so that Spark can split the hot keys of the join.
        labelled = steps.store(labelled, "near-labelled")
    least = F.min(F.struct("node", "n", "label"))
    keys = labelled.groupBy("key").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("of"), least.alias("head")
    )
    head = [F.col(f"head.{c}").alias(name) for c, name in (("node", "a"), ("n", "m"), ("label", "a_label"))]
    keys = keys.where("lo != hi").select("key", "of", *head)
    return labelled.join(keys.hint("merge"), "key")


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """a, b and `apart` of the pairs whose sizes and sketches allow the similarity."""
    first = nodes.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x"))
    second = nodes.select(F.col("node").alias("b"), "n", F.col("sketch").alias("y"))
    both = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b").where(_fit(percent))
    both = both.select("a", "b", "n", "m", F.expr(_APART).alias("apart"))
    near = F.col("apart") * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
    return both.where(near).select("a", "b", "apart")


def _pairs(rows: DataFrame, leaders: int, percent: int) -> DataFrame:
    """Pairs (a, b) under a key, of which one is among the `leaders` or so of its nodes that a hash chooses."""
    chosen = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) * F.col("of") < (leaders << 20)
    head = {"node": "head", "label": "head_label", "n": "m"}
    heads = rows.where((F.col("of") <= FEW) | chosen).select("key", *[F.col(c).alias(name) for c, name in head.items()])
    pairs = rows.drop("m", "a_label").join(heads.hint("merge"), "key").where("head != node AND head_label != label").where(_fit(percent))
    return pairs.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()


def links(docs: DataFrame, marked: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame | None:
    """(node, root) of the nodes that are not the smallest of their component; None if there are none."""
    steps = Steps(docs.sparkSession)
    candidates = _fingerprint_pairs(marked, steps)
    steps.keep_only(candidates)
    live = steps.store(_live(marked, percent, steps), "near-live")
    steps.keep_only(candidates, live)
    if live.isEmpty():
        steps.keep_only()
        return None
    # One document of each node that shares a key.
    wanted = live.select("node").distinct()
    row = F.min(F.struct("doc_id", "hash")).alias("row")
    nodes = marked.groupBy("node").agg(row, *[F.min(c).alias(c) for c in ("n", "sketch")]).join(wanted.hint("merge"), "node")
    names = simhash.identity(F.col("row.doc_id"), F.col("row.hash"))
    named = [c.alias(name) for c, name in zip(names, ("h1", "h2"))]
    nodes = steps.store(nodes.select("node", *named, "n", "sketch"), "near-nodes")
    steps.keep_only(candidates, live, nodes)

    def linked(pairs: DataFrame, found: DataFrame | None) -> DataFrame | None:
        """The links found so far and those of the pairs that have the similarity."""
        pairs = steps.store(pairs.select("a", "b"), "near-pairs")
        if pairs.isEmpty():
            return found
        asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        rows = nodes.select("node", "h1", "h2").join(asked.hint("merge"), "node")
        sets = steps.store(_sets_of(docs, steps.store(rows, "near-asked"), size), "near-sets")
        similar = _similar(pairs, sets, percent)
        return steps.store(similar if found is None else found.unionByName(similar), "near-links")

    def rooted(found: DataFrame | None) -> DataFrame | None:
        if found is None or found.isEmpty():
            return None
        return components(found).select(F.col("u").alias("node"), F.col("v").alias("root"))

    def nearest(pairs: DataFrame) -> DataFrame:
        """Of the pairs that can have the similarity one for each `b`."""
        least = F.min(F.struct("apart", "a")).alias("nearest")
        return _near(pairs, nodes, percent).groupBy("b").agg(least).select("nearest.a", "b")

    found = linked(nearest(candidates), None)
    steps.keep_only(live, nodes, found)
    leaders, roots = 0, rooted(found)
    while True:
        open_rows = steps.store(_open(live, roots, steps), "near-open")
        if open_rows.isEmpty():
            steps.keep_only()
            return roots
        if leaders:
            pairs = _near(_pairs(open_rows, leaders, percent), nodes, percent)
        else:
            heads = open_rows.where("a_label != label").where(_fit(percent)).select("a", F.col("node").alias("b")).distinct()
            pairs = nearest(heads)
        more = linked(pairs, found)
        if more is not found:
            found, roots = more, rooted(more)
        if leaders:
            # All pairs of the other keys have been compared.
            rest = open_rows.where(F.col("of") > max(FEW, leaders)).select("key", "node", "n")
            live = steps.store(rest, "near-live")
        leaders = leaders * 8 or 8
        steps.keep_only(live, nodes, found)


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each group of near-duplicates: the one with the smallest doc_id.

    Groups are the components of all pairs with the similarity. Rows without a doc_id come last; rows with
    equal ids are told apart by a hash of the text.
    """
    steps = Steps(docs.sparkSession)
    marked = steps.store(_marked(docs, size, percent, _frequent(docs, size)), "near-marked")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    distinct = marked.groupBy("node").agg(F.min(row).alias("first"))
    roots = links(docs, marked, size, percent)
    if roots is not None:
        placed = distinct.join(roots.hint("merge"), "node", "left")
        distinct = placed.groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
    kept = steps.store(distinct.select("first.*"), "near-kept")
    steps.keep_only(kept)
    return simhash.only(docs, kept)
