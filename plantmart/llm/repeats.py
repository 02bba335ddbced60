"""Places where a stretch of a fixed number of symbols (bytes or words) occurs again.

Every stretch (window) has an anchor: the position of the smallest hash among its grams. The choice
depends on the window's content alone, so equal windows have equal anchors at equal distances. Windows
of one text with the same anchor follow one another and form a block.

Blocks are rows (key, context): the key is what all windows of the block share, the context all that they
cover. Rows with equal contexts have equal windows throughout, so their copies are settled at once. If
one key has several contexts, its blocks are contested: of every context one row is refined into smaller
blocks, down to single windows, where key and context coincide. Refining always compares the
first row of each context, so that no partner is lost and no pairs are formed.

Hot keys: before anything is shuffled, each task keeps one row per context and, if it has several
contexts, one row per key. A key that a third of all texts share then is one row per chunk of texts.
The shuffled rows are sorted and read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.storing import release, stored

# Rows without a doc_id take this one, so they come first and can be joined.
NO_ID = -(2**63)
TO_COMPARE, REPEATED, CONTESTED = 0, 1, 2


@dataclass(frozen=True)
class Windows:
    """Windows of `length` symbols with anchors of `gram` symbols, and how contested blocks are refined.

    `every`: all copies count as repeated, else all but the first by (doc_id, position).
    """

    length: int
    gram: int
    refine: tuple[int, ...]
    words: bool
    every: bool


class Symbols:
    """The symbols of a chunk of texts, where each text starts, and hashes of any range of them."""

    def __init__(self, texts: pa.LargeBinaryArray, words: bool):
        self.data, byte_offsets = arrays.text_bytes(texts)
        values = self.data.astype(np.uint64) + np.uint64(1)
        self.offsets = byte_offsets
        if words:
            self.starts, self.ends, self.offsets = arrays.word_spans(self.data, byte_offsets)
            values = arrays.range_hash(arrays.prefix_hash(values), self.starts, self.ends)
        self.prefix = arrays.prefix_hash(values)
        self.n = len(values)


@dataclass
class Rows:
    """Blocks: what they are compared by, whose they are, first window, windows, steps to the anchor."""

    key: np.ndarray
    context: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    lead: np.ndarray
    beacon: np.ndarray

    NAMES = ("key", "context", "doc", "row", "start", "n", "lead", "beacon")

    def columns(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def take(self, at: np.ndarray) -> Rows:
        return Rows(*(column[at] for column in self.columns()))


_SCHEMA = pa.schema(
    [
        ("kind", pa.int8()), ("key", pa.int64()), ("context", pa.int64()), ("doc", pa.int64()),
        ("row", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("lead", pa.int32()),
        ("beacon", pa.bool_()),
    ]
)
_SQL = (
    "kind tinyint, key bigint, context bigint, doc bigint, row bigint, start int, n int, lead int, beacon boolean"
)


def _batch(kind: int, rows: Rows) -> pa.RecordBatch:
    kinds = np.full(len(rows.key), kind, dtype=np.int8)
    return pa.RecordBatch.from_arrays(
        [pa.array(c).cast(f.type) for c, f in zip([kinds, *rows.columns()], _SCHEMA)], schema=_SCHEMA
    )


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def _compared(rows: Rows, every: bool) -> tuple[Rows, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by key, context and place: the rows without repeated places, and by row whether it
    is repeated, is the first of its context, is the first of its key, and whether the key is contested."""
    place = _changes(rows.key, rows.context, rows.doc, rows.row, rows.start)
    rows = rows.take(np.flatnonzero(place))
    new_key = _changes(rows.key)
    new_context = new_key | _changes(rows.context)
    if not len(new_key):
        empty = np.empty(0, dtype=bool)
        return rows, empty, empty, empty, empty
    size = np.bincount(of := np.cumsum(new_context) - 1)
    repeated = size[of] > 1 if every else ~new_context
    of_key = np.cumsum(new_key) - 1
    contexts = np.bincount(of_key, weights=new_context)
    lit = np.bincount(of_key, weights=rows.beacon)
    return rows, repeated, new_context, new_key, ((contexts > 1) | (lit > 0))[of_key]


def _collapsed(rows: Rows, every: bool) -> Iterator[pa.RecordBatch]:
    """What is settled within a task, and at most one row per key (or one context per key) to compare."""
    order = np.lexsort((rows.start, rows.row, rows.doc, rows.context, rows.key))
    rows, repeated, first, first_of_key, contested = _compared(rows.take(order), every)
    settled = rows.take(np.flatnonzero(repeated))
    yield _batch(REPEATED, _merged(settled))
    yield _batch(CONTESTED, _spread(rows.take(np.flatnonzero(first & contested))))
    sent = rows.take(np.flatnonzero(np.where(contested, first_of_key, first)))
    sent.beacon = contested[np.where(contested, first_of_key, first)]
    yield _batch(TO_COMPARE, sent)


def _spread(rows: Rows) -> Rows:
    """Rows that need no comparison are dealt by their document, not by their hot keys."""
    rows.key = arrays.mix(rows.doc.view(np.uint64)).view(np.int64)
    return rows


def _merged(rows: Rows) -> Rows:
    """Adjoining blocks of a text made one."""
    rows = rows.take(np.lexsort((rows.start, rows.row, rows.doc)))
    if not len(rows.key):
        return rows
    new = _changes(rows.doc, rows.row)
    new[1:] |= rows.start[1:] > rows.start[:-1] + rows.n[:-1]
    at = np.flatnonzero(new)
    ends = np.maximum.reduceat(rows.start + rows.n, at)
    rows = rows.take(at)
    rows.n = ends - rows.start
    return _spread(rows)


def _blocks(chunk: pa.RecordBatch, windows: Windows) -> Rows:
    """All blocks of the texts of a chunk."""
    symbols = Symbols(chunk.column("text"), windows.words)
    grams = arrays.window_hashes(symbols.prefix, windows.gram)
    anchors = arrays.window_minimum(grams, windows.length - windows.gram + 1)
    sizes = np.diff(symbols.offsets)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    starts = np.flatnonzero(text[: len(anchors)] == text[windows.length - 1 :][: len(anchors)])
    anchors = anchors[starts]
    new = _changes(anchors, starts - np.arange(len(starts)))
    at = np.flatnonzero(new)
    first, n = starts[at], np.diff(np.append(at, len(starts)))
    return _rows(chunk, symbols, windows, text[first], first, n, anchors[at], grams[anchors[at]])


def _rows(chunk, symbols, windows, text, first, n, anchor, key) -> Rows:
    lead = anchor - first
    context = arrays.range_hash(symbols.prefix, first, first + n - 1 + windows.length)
    context = arrays.mix(context + lead.astype(np.uint64) * arrays.BASE)
    return Rows(
        key.view(np.int64), context.view(np.int64),
        chunk.column("doc").to_numpy(zero_copy_only=False)[text],
        chunk.column("row").to_numpy(zero_copy_only=False)[text],
        first - symbols.offsets[text], n, lead, np.zeros(len(n), dtype=bool),
    )


def _refined(chunk: pa.RecordBatch, windows: Windows, size: int) -> Rows:
    """The listed blocks of each text cut into blocks of at most `size` windows, aligned to the anchor."""
    symbols = Symbols(chunk.column("text"), windows.words)
    lists = chunk.column("starts")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(chunk.num_rows), counts)
    start, n, lead = (
        chunk.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("starts", "ns", "leads")
    )
    start = start + symbols.offsets[text]
    least, most = (lead - (n - 1)) // size, lead // size
    cuts = most - least + 1
    part = arrays.gathered(least, cuts)
    text, start, n, anchor = (np.repeat(x, cuts) for x in (text, start, n, start + lead))
    high = anchor - part * size
    low = high - (size - 1)
    first, last = np.maximum(low, start), np.minimum(high, start + n - 1)
    key = arrays.range_hash(symbols.prefix, high, low + windows.length)
    key = arrays.mix(key + part.astype(np.uint64) * arrays.BASE)
    return _rows(chunk, symbols, windows, text, first, last - first + 1, anchor, key)


def _settle(every: bool):
    """Compares rows sorted by key, context and place; passes on what was settled before."""

    def runs(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        kinds, rows = columns[0], Rows(*columns[1:])
        for kind in (REPEATED, CONTESTED):
            if (kinds == kind).any():
                yield _batch(kind, rows.take(np.flatnonzero(kinds == kind)))
        open_rows = rows.take(np.flatnonzero(kinds == TO_COMPARE))
        found, repeated, first, _, contested = _compared(open_rows, every)
        yield _batch(REPEATED, _merged(found.take(np.flatnonzero(repeated))))
        yield _batch(CONTESTED, found.take(np.flatnonzero(first & contested & ~found.beacon)))

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns)]
            keep = arrays.last_run(columns[:2])
            rest = [c[keep:] for c in columns]
            yield from runs([c[:keep] for c in columns])
        if rest is not None:
            yield from runs(rest)

    return settled


def _compare(rows: DataFrame, windows: Windows, purpose: str) -> DataFrame:
    dealt = rows.repartition("key").sortWithinPartitions("kind", "key", "context", "doc", "row", "start")
    found = stored(dealt.mapInArrow(_settle(windows.every), _SQL).drop("key", "context", "beacon"), purpose)
    release(rows.sparkSession)
    return found


def keyed(docs: DataFrame) -> DataFrame:
    """doc (doc_id, or NO_ID), row (a hash that tells rows with equal ids apart), doc_id and text."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    return docs.select(doc.alias("doc"), F.xxhash64("text").alias("row"), F.col("doc_id").cast("bigint"), "text")


def repeated(docs: DataFrame, windows: Windows) -> DataFrame:
    """(doc, row, start, n): n repeated windows from `start` on, in symbols from the start of the text.

    `docs` is what keyed() gives. Rows that agree in doc_id and text are one document given twice.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            yield from _collapsed(_blocks(chunk, windows), windows.every)

    def refined(size: int):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in arrays.chunks(batches):
                yield from _collapsed(_refined(chunk, windows, size), windows.every)

        return cut

    found = _compare(docs.select("doc", "row", "text").mapInArrow(blocks, _SQL), windows, "repeats")
    results = found.where(F.col("kind") == REPEATED)
    for size in windows.refine:
        lists = (
            found.where(F.col("kind") == CONTESTED)
            .groupBy("doc", "row")
            .agg(F.collect_set(F.struct("start", "n", "lead")).alias("b"))
            .select("doc", "row", *(F.col(f"b.{c}").alias(f"{c}s") for c in ("start", "n", "lead")))
        )
        texts = docs.select("doc", "row", "text").join(lists.hint("merge"), ["doc", "row"])
        found = _compare(texts.mapInArrow(refined(size), _SQL), windows, "repeats")
        results = results.unionByName(found.where(F.col("kind") == REPEATED))
    return results.select("doc", "row", "start", "n")


def listed(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The documents, each with its repeated places as two lists (NULL without any)."""
    lists = (
        places.groupBy("doc", "row")
        .agg(F.collect_set(F.struct("start", "n")).alias("b"))
        .select("doc", "row", F.col("b.start").alias("starts"), F.col("b.n").alias("ns"))
    )
    return docs.join(lists.hint("merge"), ["doc", "row"], "left").select("doc_id", "text", "starts", "ns")


def marked(chunk: pa.RecordBatch, symbols: Symbols, length: int) -> np.ndarray:
    """Which symbols of the chunk lie in one of the listed windows."""
    counts = chunk.column("starts").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(chunk.num_rows), counts)
    start, n = (
        chunk.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("starts", "ns")
    )
    start = start + symbols.offsets[text]
    return arrays.covered(start, start + n - 1 + length, symbols.n)
