"""Near-duplicates by SimHash, found through deletion-variant signatures.

A fingerprint has 64 bits, each the majority over the hashes of all shingles. Two fingerprints that differ
in at most four bits agree up to one bit in at least one of three segments. So every fingerprint is
indexed under its three segments, and under each segment with one of its bits left out (64 variants).
Equal keys bring together all pairs in question; each pair is verified on all 64 bits.

Copies with equal fingerprints are one node, and of the links under one key only a spanning forest is
kept: components stay whole, and a crowd of near copies does not turn into all of its pairs. Keys
with many fingerprints are split into blocks, and every pair of blocks is compared in a task of its
own, so no task holds more than two blocks however many fingerprints share a key.

Defined cases: texts without a word, NULL among them, have fingerprint zero and are linked like any other;
shorter texts than a shingle are one shingle; rows without a doc_id belong to components but give them
no id, and a component of such rows only has none; repeated rows are copies; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.components import components
from plantmart.llm.storing import stored, unused

SEED = 42
DISTANCE = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))
BLOCK = 4096
# Text that is hashed at a time: a shingle takes some hundred bytes while its bits are counted.
SHINGLE_BYTES = 1 << 20
# Capital letters A to Z become small ones; all other bytes stay.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32


def _shingle_bounds(first: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int):
    """Starts and ends of all shingles, and how many lie before each text."""
    n_words = np.diff(first)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    before = np.concatenate(([0], np.cumsum(counts)))
    inside = np.arange(before[-1]) - np.repeat(before[:-1], counts)
    at = np.repeat(first[:-1], counts) + inside
    last = at + np.repeat(np.minimum(n_words, size), counts) - 1
    return starts[at], ends[last], before


def shingles(texts: pa.LargeBinaryArray, size: int):
    """Folded words with one space after each, starts and ends of all shingles, and how many lie before each text."""
    data, offsets = arrays.text_bytes(texts)
    starts, ends, first = arrays.word_spans(data, offsets)
    # Words end to end with one space after each: a shingle is then one stretch of bytes.
    lengths = ends - starts
    new_starts = np.cumsum(lengths + 1) - (lengths + 1)
    row = np.full(int((lengths + 1).sum()), 0x20, dtype=np.uint8)
    gaps = np.zeros(len(row), dtype=bool)
    gaps[new_starts + lengths] = True
    row[~gaps] = _FOLDED[data[~arrays.IS_SPACE[data]]]
    return row, *_shingle_bounds(first, new_starts, new_starts + lengths, size)


def fingerprints_of(texts: pa.LargeBinaryArray, size: int) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    row, left, right, before = shingles(texts, size)
    whole, digest = row.tobytes(), xxhash.xxh64_intdigest
    found = [digest(whole[a:b], SEED) for a, b in zip(left.tolist(), right.tolist())]
    hashes = np.array(found, dtype=np.uint64)
    counts = np.diff(before)
    result = np.zeros(len(counts), dtype=np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, before[filled], axis=0, dtype=np.int32)
        majority = ones * 2 > counts[filled][:, None]
        result[filled] = np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, a hash of the text and the fingerprint (64 bits as a bigint) of each row."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches, most=SHINGLE_BYTES):
            found = fingerprints_of(chunk.column("text"), size).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("hash"), pa.array(found)],
                ["doc_id", "hash", "fingerprint"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("hash"), "text")
    return texts.mapInArrow(marked, "doc_id bigint, hash bigint, fingerprint bigint")


def _variants(fingerprint: Column) -> Column:
    """All keys of a fingerprint: which variant, and the segment with one bit or none left out."""
    keys = []
    for place, length in SEGMENTS:
        segment = F.shiftrightunsigned(fingerprint, place).bitwiseAND(F.lit((1 << length) - 1))
        for bit in (None, *range(length)):
            kept = segment if bit is None else segment.bitwiseAND(F.lit((1 << length) - 1 - (1 << bit)))
            keys.append(kept.bitwiseOR(F.lit(len(keys) << 22)))
    return F.array(*keys)


def forest(prints: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links that join all of `prints` which pairs within the distance join, and no more than needed."""
    label = np.arange(len(prints))
    left, right = [], []
    for k in range(len(prints)):
        others = np.flatnonzero(label != label[k])
        if not len(others):
            break
        near = others[np.bitwise_count(prints[others] ^ prints[k]) <= distance]
        if not len(near):
            continue
        joined, at = np.unique(label[near], return_index=True)
        left += [k] * len(at)
        right += near[at].tolist()
        label[np.isin(label, joined)] = label[k]
    return left, right


def _links(distance: int):
    """Links among the fingerprints of each run of equal keys; the input comes sorted by the keys."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns)]
            keep = arrays.last_run(columns[:-1])
            rest = [c[keep:] for c in columns]
            yield _linked_runs([c[:keep] for c in columns], distance)
        if rest is not None:
            yield _linked_runs(rest, distance)

    return linked


def _linked_runs(columns: list[np.ndarray], distance: int) -> pa.RecordBatch:
    prints = np.ascontiguousarray(columns[-1]).view(np.uint64)
    n = len(prints)
    lefts, rights = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    if n:
        start = np.ones(n, dtype=bool)
        start[1:] = np.any([k[1:] != k[:-1] for k in columns[:-1]], axis=0)
        starts = np.flatnonzero(start)
        sizes = np.diff(np.append(starts, n))
        pairs = starts[sizes == 2]
        pairs = pairs[np.bitwise_count(prints[pairs] ^ prints[pairs + 1]) <= distance]
        lefts.append(prints[pairs])
        rights.append(prints[pairs + 1])
        for a, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            run = prints[a : a + size]
            left, right = forest(run, distance)
            lefts.append(run[left])
            rights.append(run[right])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x).view(np.int64)) for x in (lefts, rights)], ["u", "v"]
    )


def links(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within `distance` of one another."""
    keyed = prints.select(F.explode(_variants(F.col("fingerprint"))).alias("key"), "fingerprint")
    of_key = Window.partitionBy("key").orderBy("fingerprint")
    counted = keyed.select(
        "key", "fingerprint",
        F.row_number().over(of_key).alias("place"),
        F.count("*").over(Window.partitionBy("key")).alias("n"),
    ).where("n > 1")
    compare = _links(distance)
    light = (
        counted.where(F.col("n") <= block).select("key", "fingerprint")
        .sortWithinPartitions("key", "fingerprint").mapInArrow(compare, "u bigint, v bigint")
    )
    half = block // 2
    own = F.floor((F.col("place") - 1) / half)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / half)))
    heavy = (
        counted.where(F.col("n") > block)
        .select("key", own.alias("own"), other.alias("other"), "fingerprint")
        .select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fingerprint")
        .repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "fingerprint")
        .mapInArrow(compare, "u bigint, v bigint")
    )
    return light.unionByName(heavy)


def _roots(distinct: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """The rows, which have one per fingerprint, with the smallest fingerprint of the component as `root`."""
    found = components(links(distinct.select("fingerprint"), distance, block)).withColumnRenamed("u", "fingerprint")
    joined = distinct.join(found, "fingerprint", "left")
    return joined.withColumn("root", F.coalesce("v", "fingerprint")).drop("v")


def groups(docs: DataFrame, size: int = 4, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id of each row; `docs` needs doc_id and text.

    component_id is the smallest doc_id that links lead to, the row's own included.
    """
    marked = stored(fingerprints(docs, size).select("doc_id", "fingerprint"), "simhash")
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    placed = stored(_roots(distinct, distance, block), "simhash-roots")
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = placed.join(ids, "root").select("fingerprint", "component_id")
    return marked.join(of_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, size: int = 4, distance: int = DISTANCE) -> DataFrame:
    """The documents, one of each group of near-duplicates: the one with the smallest doc_id.

    Rows without a doc_id come last; rows with equal ids are told apart by a hash of the text.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    marked = stored(fingerprints(docs, size), "simhash")
    distinct = marked.groupBy("fingerprint").agg(F.min(row).alias("first"))
    kept = _roots(distinct, distance).groupBy("root").agg(F.min("first").alias("kept")).select("kept.*")
    return only(docs, kept)


def identity(doc_id: Column, text_hash: Column) -> list[Column]:
    """Two hashes that tell documents apart: of the text, and of it with the id; neither is ever NULL."""
    return [text_hash, F.xxhash64(doc_id.cast("bigint"), text_hash)]


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Of the documents those that `kept` names by doc_id and hash of the text, each once."""
    columns = docs.columns
    own = [unused(c, columns) for c in ("own_hash", "own_id")]
    wanted = [unused(c, columns) for c in ("kept_hash", "kept_id")]
    place = unused("place", columns)
    marked = docs.withColumns(dict(zip(own, identity(docs["doc_id"], F.xxhash64(docs["text"])))))
    named = kept.select(*[c.alias(name) for c, name in zip(identity(kept["doc_id"], kept["hash"]), wanted)])
    same = (F.col(own[0]) == F.col(wanted[0])) & (F.col(own[1]) == F.col(wanted[1]))
    # What is kept grows with the documents, so it is merged with them and not broadcast. Rows that agree in
    # both hashes are one document given several times; the join brings them together.
    found = marked.join(named.hint("merge"), same)
    first = F.row_number().over(Window.partitionBy(*own).orderBy(own[0]))
    return found.withColumn(place, first).where(F.col(place) == 1).drop(*own, *wanted, place)
