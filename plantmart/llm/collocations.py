"""Collocations: phrases of two to five words that occur more often than their parts would have it.

Phrases are counted in a suffix tree that is truncated at five words and built piece by piece, in three steps.

1. A first scan counts words, pairs and triples of words in a fixed number of slots, by hash. What lies in a slot
   below the least frequency is rare for certain, and so is every phrase with it inside. The slots come back as
   one bit each; their number is a parameter, so what is broadcast has a fixed size. Once they are full, nothing is
   ruled out any more: the next step moves more rows then, but finds the same.
2. A second scan gives the suffix that starts at each word: the words from there to the end of the piece, five at
   most, cut off where a pair or triple is ruled out. Equal suffixes of a block of texts become one
   with a count. They are dealt to groups by their prefix of two words, and there are so many groups that
   one takes its share of a memory budget; a prefix with more than its share is extended to the whole suffix.
   What a block has for a group travels as one packed row.
3. Each group, sorted, is its part of the tree: a node at depth d is a run of suffixes with equal first d words, and
   its frequency is the sum over the leaves below. Nodes of the least frequency or more are written down, those
   below an extended prefix in any case, and are summed over the groups.

Scores need the frequencies of a phrase's parts, which are nodes too, and come by joins. A phrase that some longer one
contains as often also occurs as often in one that is longer by a single word, so those are enough to drop it.

Defined cases: a NULL or empty text has no words, a NULL lang is `und`; rows count each by themselves, so repeated rows
count repeatedly, and doc_id is not used; words are told apart by 64-bit hashes of language and bytes; texts of any
length are read whole; with fewer phrases than asked for, all are returned; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.storing import release, stored

LONGEST = 5
LEAST = 100
TOP = 2000
# One bit for each slot is broadcast: 16 MB.
SLOT_BITS = 27
# Slots are summed in ranges of so many; an entry holds a slot of its range and a count of up to 2^14 - 1.
RANGE_BITS = 18
COUNT_BITS = 32 - RANGE_BITS
# A pair with more than this part of all that is counted is split.
SHARE = 1024
# Groups: one for so much of all that is counted, but so many at least.
GROUP_BITS = 22
LEAST_GROUPS = 256
# Suffixes of a group are combined again when there are so many.
COMBINE = 1 << 20
# Suffixes are combined within blocks of this many bytes of text.
BLOCK_BYTES = 16 << 20
SALTS = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\v\f\r")] = True
_APART = _BREAK.copy()
_APART[list(b" \t")] = True

_PARTS = [f"w{k}" for k in range(1, LONGEST + 1)]
_SUFFIXES = pa.schema(
    [*((c, pa.uint64()) for c in _PARTS), ("n", pa.int64()), ("lang", pa.string()), ("word", pa.string())]
)
_RANGES = pa.schema(
    [("part", pa.int64()), ("flags", pa.binary()), ("n", pa.int64())]
    + [(c, pa.list_(pa.int64())) for c in ("slot", "of")]
)
_NODES = "path array<bigint>, n bigint, lang string, word string"


class Words:
    """The words of a chunk of texts: hashes that tell languages apart, pieces and places in the bytes."""

    def __init__(self, chunk: pa.RecordBatch):
        data, offsets = arrays.text_bytes(chunk.column("text"))
        self.data = _LOWER[data]
        self.starts, self.ends = arrays.spans(~_APART[data], offsets[:-1])
        text = np.searchsorted(offsets, self.starts, "right") - 1
        self.pieces = np.cumsum(_BREAK[data])[self.starts] + text
        coded = pc.fill_null(chunk.column("lang").cast(pa.string()), "und").dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        self.lang = coded.indices.to_numpy()[text]
        seeds = np.array([_lang_hash(lang) for lang in self.langs], dtype=np.uint64)
        self.hashes = arrays.mix(arrays.word_hashes(self.data, self.starts, self.ends) ^ seeds[self.lang])
        # Zero stands for no word.
        self.hashes[self.hashes == 0] = 1

    def grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Hash of each pair and of each triple of neighbouring words, and whether it lies in one piece."""
        pairs = _pair(self.hashes[:-1], self.hashes[1:])
        triples = _pair(pairs[:-1], self.hashes[2:])
        return [(pairs, self.pieces[:-1] == self.pieces[1:]), (triples, self.pieces[:-2] == self.pieces[2:])]


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return arrays.mix(arrays.mix(left) + right)


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", "lang")


def _merged(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique_counts(np.concatenate(parts))


class Slots:
    """Which slots reach the least frequency, and which pairs take more than their share of all that is counted."""

    def __init__(self, bits: int, flags: bytes, crowded: np.ndarray, groups: int):
        self.bits, self.groups = bits, groups
        self.flags = np.frombuffer(flags, dtype=np.uint8)
        self.crowded = crowded

    def enough(self, hashes: np.ndarray) -> np.ndarray:
        slot = _slot(hashes, self.bits)
        return (self.flags[slot >> 3] << (slot & 7).astype(np.uint8)) & 0x80 != 0

    def hot(self, pairs: np.ndarray) -> np.ndarray:
        return np.isin(_slot(pairs, self.bits), self.crowded)


def _slots(docs: DataFrame, least: int, bits: int) -> tuple[int, bytes, np.ndarray, int]:
    """The arguments of Slots. The driver receives one bit a slot and at most a few thousand crowded slots."""
    part_bits = min(RANGE_BITS, bits)
    whole = (1 << COUNT_BITS) - 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> pa.RecordBatch:
            slot, n = _merged(found)
            entry = ((slot & ((1 << part_bits) - 1)) << COUNT_BITS | np.minimum(n, whole)).astype(np.uint32)
            part = slot >> part_bits
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, int)
            blobs = arrays.binaries(entry.view(np.uint8), np.append(first, len(part)) * 4, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(part[first]), blobs], ["part", "entries"])

        found, size = [], 0
        for chunk in arrays.chunks(batches):
            words = Words(chunk)
            found += [_slot(h, bits) for h in (words.hashes, *(gram[inside] for gram, inside in words.grams()))]
            size += len(words.data)
            if size >= BLOCK_BYTES:
                yield entries()
                found, size = [], 0
        if found:
            yield entries()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by part: a range of slots is complete when the next one begins."""
        now, total = None, np.zeros(1 << part_bits, dtype=np.int64)

        def range_of_slots() -> pa.RecordBatch:
            crowded = np.flatnonzero(total > least)
            crowded = crowded[np.argsort(-total[crowded])][: SHARE * 2]
            row = {"part": now, "flags": np.packbits(total >= least).tobytes(), "n": int(total.sum())}
            row |= {"slot": (crowded + (now << part_bits)).tolist(), "of": total[crowded].tolist()}
            return pa.RecordBatch.from_pylist([row], _RANGES)

        for batch in batches:
            for part, entries in zip(batch.column("part").to_pylist(), batch.column("entries")):
                if now is not None and part != now:
                    yield range_of_slots()
                    total[:] = 0
                now = part
                entry = np.frombuffer(entries.as_buffer(), dtype=np.uint32)
                total[entry >> COUNT_BITS] += entry & whole
        if now is not None:
            yield range_of_slots()
        arrays.give_back()

    blocks = _texts(docs).mapInArrow(counted, "part bigint, entries binary")
    ranges = blocks.repartition("part").sortWithinPartitions("part")
    schema = "part bigint, flags binary, n bigint, slot array<bigint>, of array<bigint>"
    flags = bytearray((1 << bits) // 8)
    ranges = stored(ranges.mapInArrow(summed, schema), "slots")
    size = (1 << part_bits) // 8
    for r in ranges.select("part", "flags").toLocalIterator():
        flags[r.part * size : (r.part + 1) * size] = r.flags
    total = ranges.agg(F.sum("n")).first()[0] or 0
    # No more than SHARE slots can hold so many.
    several = ranges.select(F.explode(F.arrays_zip("slot", "of")).alias("x")).where(F.col("x.of") * SHARE > total)
    crowded = np.array(sorted(r.slot for r in several.select("x.slot").collect()), dtype=np.int64)
    return bits, bytes(flags), crowded, max(LEAST_GROUPS, total >> GROUP_BITS)


def _suffixes_of(words: list[Words], slots: Slots, longest: int) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Suffixes of a block, cut off where they become rare, then its words, then its languages; with what deals them."""
    hashes = np.concatenate([w.hashes for w in words])
    often = slots.enough(hashes)
    # Whether the pair and the triple that start at a word may be frequent.
    frequent = []
    for which in range(2):
        flags = []
        for w in words:
            gram, inside = w.grams()[which]
            flags += [inside & slots.enough(gram), np.zeros(len(w.hashes) - len(gram), dtype=bool)]
        frequent.append(np.concatenate(flags) & often)
    pair, triple = frequent
    pair[:-1] &= often[1:]
    triple[:-1] &= pair[:-1] & pair[1:]
    start = np.flatnonzero(pair)
    path = arrays.mix(hashes[start])
    parts, alive = [hashes[start]], np.ones(len(start), dtype=bool)
    for k in range(1, LONGEST):
        if k >= longest:
            alive = np.zeros(len(start), dtype=bool)
        elif k > 1:
            alive &= triple[np.minimum(start + k - 2, len(hashes) - 1)]
        parts.append(np.where(alive, hashes[np.minimum(start + k, len(hashes) - 1)], np.uint64(0)))
        path = arrays.mix(path + parts[-1])
    path, first, n = np.unique(path, return_index=True, return_counts=True)
    parts = [p[first] for p in parts]
    deal = _pair(parts[0], parts[1])
    hot = slots.hot(deal)
    deal[hot] = path[hot]
    yield deal, _batch(parts, n, None, None)

    found, first, n = np.unique(hashes[often], return_index=True, return_counts=True)
    first = np.flatnonzero(often)[first]
    before = np.cumsum([0, *(len(w.hashes) for w in words)])
    of = np.searchsorted(before, first, "right") - 1
    for k, w in enumerate(words):
        mine = of == k
        at = first[mine] - before[k]
        lengths = w.ends[at] - w.starts[at]
        text = w.data[arrays.gathered(w.starts[at], lengths)]
        strings = arrays.binaries(text, np.concatenate(([0], np.cumsum(lengths))), pa.string())
        langs = pa.array(w.langs, pa.string()).take(pa.array(w.lang[at]))
        yield arrays.mix(found[mine]), _batch([found[mine]], n[mine], langs, strings)
        seeds = np.array([_lang_hash(lang) for lang in w.langs], dtype=np.uint64)
        yield seeds, _batch([seeds], np.bincount(w.lang, minlength=len(w.langs)), pa.array(w.langs, pa.string()), None)


def _batch(parts: list[np.ndarray], n: np.ndarray, langs, words) -> pa.RecordBatch:
    parts = [*parts, *[np.zeros(len(n), np.uint64)] * (LONGEST - len(parts))]
    none = pa.nulls(len(n), pa.string())
    columns = [*map(pa.array, parts), pa.array(n.astype(np.int64))]
    columns += [none if langs is None else langs, none if words is None else words]
    return pa.RecordBatch.from_arrays(columns, schema=_SUFFIXES)


def _packed(words: list[Words], slots: Slots, longest: int) -> pa.RecordBatch:
    """What a block has for each group, one row for a group."""
    deal, batches = zip(*_suffixes_of(words, slots, longest))
    group = (np.concatenate(deal) % np.uint64(slots.groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    rows = pa.concat_batches(batches).take(pa.array(order))
    found, first = np.unique(group[order], return_index=True)
    ends = np.append(first, len(order))
    blobs = [rows.slice(a, b - a).serialize().to_pybytes() for a, b in zip(ends, ends[1:])]
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(blobs, pa.binary())], ["group", "suffixes"])


def _suffixes(docs: DataFrame, shared, longest: int) -> DataFrame:
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(*shared.value)
        block, size = [], 0
        for chunk in arrays.chunks(batches):
            block.append(Words(chunk))
            size += len(block[-1].data)
            if size >= BLOCK_BYTES:
                yield _packed(block, slots, longest)
                block, size = [], 0
        if block:
            yield _packed(block, slots, longest)
        arrays.give_back()

    return _texts(docs).mapInArrow(suffixes, "group bigint, suffixes binary")


def _combined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Suffixes in order, each once."""
    rows = pa.concat_batches(batches)
    parts = [rows.column(c).to_numpy() for c in _PARTS]
    order = np.lexsort(parts[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([p[order][1:] != p[order][:-1] for p in parts], axis=0)
    start = np.flatnonzero(new)
    n = np.add.reduceat(rows.column("n").to_numpy()[order], start) if len(start) else np.empty(0, np.int64)
    rows = rows.take(pa.array(order[start]))
    return rows.set_column(rows.schema.get_field_index("n"), "n", pa.array(n))


def _nodes(rows: pa.RecordBatch, slots: Slots, least: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the subtrees of a group's suffixes."""
    if not rows.num_rows:
        return
    parts, n = [rows.column(c).to_numpy() for c in _PARTS], rows.column("n").to_numpy()
    split = slots.hot(_pair(parts[0], parts[1])) & (parts[1] != 0)
    language = rows.column("word").is_null().to_numpy(zero_copy_only=False) & (parts[1] == 0)
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for depth, part in enumerate(parts, 1):
        new[1:] |= part[1:] != part[:-1]
        if depth == 1:
            # Words are counted by rows of their own; suffixes that go on lie in other groups as well.
            new[1:] |= (parts[1][1:] == 0) != (parts[1][:-1] == 0)
        start = np.flatnonzero(new)
        total = np.add.reduceat(n, start)
        wanted = (parts[1] == 0) if depth == 1 else part != 0
        keep = wanted[start] & ((total >= least) | (language if depth == 1 else split)[start])
        start, total = start[keep], total[keep]
        paths = np.stack([p[start] for p in parts[:depth]], axis=1).ravel().view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * depth, pa.int32()), pa.array(paths))
        named = [rows.column(c).take(pa.array(start)) for c in ("lang", "word")]
        yield pa.RecordBatch.from_arrays([lists, pa.array(total), *named], ["path", "n", "lang", "word"])


def _subtrees(shared, least: int):
    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by group: one is complete when the next one begins."""
        slots = Slots(*shared.value)
        now, rows, size, most = None, [], 0, COMBINE
        for batch in batches:
            for group, blob in zip(batch.column("group").to_pylist(), batch.column("suffixes")):
                if now is not None and group != now:
                    yield from _nodes(_combined(rows), slots, least)
                    rows, size, most = [], 0, COMBINE
                now = group
                rows.append(pa.ipc.read_record_batch(blob.as_buffer(), _SUFFIXES))
                size += rows[-1].num_rows
                if size >= most:
                    rows = [_combined(rows)]
                    size = rows[0].num_rows
                    most = max(COMBINE, 2 * size)
        if rows:
            yield from _nodes(_combined(rows), slots, least)
        arrays.give_back()

    return subtrees


def frequent(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, slot_bits: int = SLOT_BITS
) -> DataFrame:
    """path (hashes of the words), n, lang and word of all phrases of up to `longest` words found `least` times or more.

    lang and word are given where the path is a single word. A row with a lang and no word has all words of the lang.
    """
    if not 2 <= longest <= LONGEST or least < 1:
        raise ValueError(f"phrases have 2 to {LONGEST} words and are found at least once")
    shared = docs.sparkSession.sparkContext.broadcast(_slots(docs, least, slot_bits))
    dealt = _suffixes(docs, shared, longest).repartition("group").sortWithinPartitions("group")
    parts = stored(dealt.mapInArrow(_subtrees(shared, least), _NODES), "subtrees")
    release(docs.sparkSession)
    named = [F.min(c).alias(c) for c in ("lang", "word")]
    nodes = parts.groupBy("path").agg(F.sum("n").alias("n"), *named)
    return nodes.where((F.col("n") >= least) | (F.col("lang").isNotNull() & F.col("word").isNull()))


def _key(path: Column) -> Column:
    return F.xxhash64(path)


def scored(nodes: DataFrame) -> DataFrame:
    """path, lang, a, n, its lowest-scoring cut (k, l, r, score) and `dropped` of each phrase of two words or more.

    `nodes` is what frequent() gives.
    """
    totals = nodes.where("lang IS NOT NULL AND word IS NULL").select("lang", F.col("n").alias("all_words"))
    parts = nodes.where("lang IS NULL OR word IS NOT NULL").select(_key(F.col("path")).alias("part"), "n", "lang")
    whole = nodes.where(F.size("path") > 1).select("path", F.col("n").alias("a"), F.size("path").alias("d"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("d") - 1)))
    cuts = cuts.withColumn("left", _key(F.slice("path", F.lit(1), F.col("k"))))
    cuts = cuts.withColumn("right", _key(F.slice("path", F.col("k") + 1, F.col("d") - F.col("k"))))
    left = parts.select(F.col("part").alias("left"), F.col("n").alias("l"), "lang").hint("merge")
    right = parts.select(F.col("part").alias("right"), F.col("n").alias("r")).hint("merge")
    # Spark splits hot parts of these joins, as both sides are dealt by the key.
    cuts = cuts.join(left, "left").join(right, "right")
    # The languages of the first words; a phrase of one language has words of that language only.
    found = cuts.groupBy("path", "a", "d").agg(
        F.max("lang").alias("lang"),
        F.collect_list(F.struct("k", "l", "r")).alias("cuts"),
    )
    found = found.join(totals, "lang").withColumnRenamed("all_words", "n")
    # Exact: up to 38 digits, and the quotient of whole numbers is cut off.
    best = F.expr(
        "array_min(transform(cuts, c -> named_struct('score', "
        "(CAST(a AS decimal(19, 0)) * CAST(n AS decimal(19, 0)) * CAST(1000 AS decimal(4, 0))) "
        "div (CAST(c.l AS decimal(19, 0)) * CAST(c.r AS decimal(19, 0))), 'k', c.k, 'l', c.l, 'r', c.r)))"
    )
    # The longer phrase contains these as often as they occur.
    covers = F.when(F.col("d") > 2, F.array_compact(F.array(
        F.when(F.exists("cuts", lambda c: (c.k == 1) & (c.r == F.col("a"))), _key(F.slice("path", F.lit(2), F.col("d") - 1))),
        F.when(F.exists("cuts", lambda c: (c.k == F.col("d") - 1) & (c.l == F.col("a"))), _key(F.slice("path", F.lit(1), F.col("d") - 1))),
    )))
    found = stored(found.select("path", "lang", "a", "n", best.alias("cut"), covers.alias("covers")), "phrases")
    gone = found.select(F.explode("covers").alias("gone")).distinct().withColumn("dropped", F.lit(True))
    marked = found.join(gone.hint("merge"), _key(F.col("path")) == F.col("gone"), "left")
    return marked.select("path", "lang", "a", "n", "cut.*", F.coalesce("dropped", F.lit(False)).alias("dropped"))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, slot_bits: int = SLOT_BITS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language, by score, frequency and phrase.

    `docs` needs text and lang.
    """
    nodes = stored(frequent(docs, least, longest, slot_bits), "nodes")
    kept = scored(nodes).where("NOT dropped").withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)))
    order = [F.desc("score"), F.desc("a")]
    # Ranked twice, so that the last ranking of a language meets a bounded number of rows besides ties.
    for key in (["lang", "salt"], ["lang"]):
        kept = kept.withColumn("rank", F.rank().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("rank") <= top)
    kept = stored(kept, "ranked")
    words = nodes.where("word IS NOT NULL").select(F.col("path")[0].alias("hash"), "word")
    spelled = kept.select("path", F.posexplode("path").alias("at", "hash")).join(words.hint("merge"), "hash")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ")
    spelled = spelled.groupBy("path").agg(phrase.alias("phrase"))
    last = Window.partitionBy("lang").orderBy(*order, "phrase")
    found = kept.drop("rank").join(spelled, "path").withColumn("rank", F.row_number().over(last))
    return found.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score"
    )
