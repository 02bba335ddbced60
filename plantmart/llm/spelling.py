"""Spelling variants: words of the corpus that are one edit from a more frequent one, by composed automata.

The vocabulary is an acceptor V, one edit is a transducer E, and the accepted pairs of V o E o V are the words
one edit apart. An edit of a word lies in its first or in its second half, and the other half is the same in
both words. So words are dealt by the half that stays: each such half is an initial state of the composition, and
its words form one acceptor of what is between. A half that too many words share is halved again, until its
words are few; the last step leaves one letter. A task takes some of these groups and

1. builds one minimal acceptor of their words: states with the same right language are one, found level by level
   from the ends by hashes of their arcs; every arc knows how many words come before it in its state, so
   that a path adds up to the number of its word;
2. composes it with E and with itself, breadth first: a triple is a state of each side and whether the edit
   has been made; arcs with the same letter go on together, one replaced or dropped letter makes the edit;
3. numbers the pairs by the two sums, and keeps for each word how many it is near to and the most frequent one.

A dropped letter of a run of equal letters is taken to be the last, so each pair comes up once.

Words and their counts come from whole texts. So that there are variants where a corpus has none of its own, a run of
letters loses one letter where a checksum of it and of the document's id says so.

Defined cases: a NULL text has no words; a NULL doc_id counts as an empty string in the checksum; rows count each by
themselves; words of any length are compared; of near words with equal counts the smallest in code-point order is
the form; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.storing import release, stored

# Words are counted within blocks of this many bytes before they are moved.
BLOCK_BYTES = 16 << 20
LEAST_LENGTH = 5
LEAST_COUNT = 3
# One run in so many loses a letter.
THINNED = 97
# A group of more words is halved again.
GROUP = 20_000
# Letters and ends of words in one acceptor.
SYMBOLS = 400_000
# Runs of more bytes take their checksum one by one.
LONG = 64
_CODE_BITS = 21

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
# The first byte of U+00C0 to U+00FF, and of nothing else.
_ACCENTED = 0xC3
_LETTER[_ACCENTED] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, carried on from the checksum `before` it."""
    order = np.argsort(-lengths, kind="stable")
    start, length = starts[order], lengths[order]
    state = ~before[order].astype(np.uint32)
    long = int(np.searchsorted(-length, -LONG, "left"))
    for k in range(long):
        text = data[start[k] : start[k] + length[k]].tobytes()
        state[k] = ~np.uint32(zlib.crc32(text, int(~state[k])))
    rest = length[long:]
    for at in range(int(rest[0]) if len(rest) else 0):
        alive = slice(long, long + int(np.searchsorted(-rest, -at, "left")))
        byte = data[start[alive] + at]
        state[alive] = _CRC[(state[alive] ^ byte) & np.uint32(0xFF)] ^ (state[alive] >> np.uint32(8))
    out = np.empty(len(state), dtype=np.uint32)
    out[order] = ~state
    return out


def _words(chunk: pa.RecordBatch, least: int, thinned: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words of a chunk end to end, and how many each has."""
    data, offsets = arrays.text_bytes(chunk.column("text"))
    inside = _LETTER[data]
    inside[1:] |= data[:-1] == _ACCENTED
    starts, ends = arrays.spans(inside, offsets[:-1])
    if not len(starts):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    data = _LOWER[data]
    lengths = ends - starts
    letters = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(letters, starts)
    points = np.searchsorted(letters, ends) - first
    names = chunk.column("doc_id").cast(pa.string()).fill_null("").to_pylist()
    prefixes = np.array([zlib.crc32(f"{name}:".encode()) for name in names], dtype=np.uint32)
    check = _checksums(data, starts, lengths, prefixes[np.searchsorted(offsets, starts, "right") - 1])
    hit = np.flatnonzero(check % thinned == 0)
    gone = letters[first[hit] + check[hit] % points[hit]]
    wide = data[gone] == _ACCENTED
    out = np.zeros(len(data), dtype=bool)
    out[gone] = True
    out[gone[wide] + 1] = True
    points[hit] -= 1
    lengths[hit] -= 1 + wide
    kept = points >= least
    inside &= ~out
    place = np.repeat(np.arange(len(starts)), lengths)
    return data[inside][kept[place]], lengths[kept]


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, thinned: int = THINNED
) -> DataFrame:
    """word and n of all words of `docs` (doc_id and text) that are long and frequent enough."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            coded = arrays.binaries(np.concatenate(found), offsets, pa.large_binary()).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            return pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n)], ["word", "n"])

        found, sizes, size = [], [], 0
        for chunk in arrays.chunks(batches):
            text, lengths = _words(chunk, least_length, thinned)
            found.append(text)
            sizes.append(lengths)
            size += len(text)
            if size >= BLOCK_BYTES:
                yield block()
                found, sizes, size = [], [], 0
        if size:
            yield block()
        arrays.give_back()

    texts = docs.select("doc_id", "text")
    words = texts.mapInArrow(counted, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Groups: words that agree before and after some letters


def _halved(frames: DataFrame) -> DataFrame:
    """Each word once with the edit in the first half of its `between`, once with it in the second.

    `r` is the length of `between` in the longer words of the group; in the shorter ones it is one less.
    """
    half = F.expr("r div 2").cast("int")
    cut = half - (F.length("between") < F.col("r")).cast("int")
    between = F.col("between")
    second = F.struct(
        (F.col("r") - half).alias("r"),
        F.concat("before", F.substr(between, F.lit(1), half)).alias("before"),
        F.substr(between, half + 1).alias("between"),
        F.col("after").alias("after"),
    )
    first = F.struct(
        half.alias("r"),
        F.col("before").alias("before"),
        F.substr(between, F.lit(1), cut).alias("between"),
        F.concat(F.substr(between, cut + 1), F.col("after")).alias("after"),
    )
    return frames.select("word", "n", F.explode(F.array(first, second)).alias("x")).select("word", "n", "x.*")


def _frames(words: DataFrame, most: int) -> DataFrame:
    """Words dealt to groups of at most `most` words (or of one letter)."""
    empty = F.lit("")
    length = F.length("word")
    whole = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("r"))
    frames = _halved(whole.select("*", empty.alias("before"), F.col("word").alias("between"), empty.alias("after")))
    group = ["r", "before", "after"]
    while True:
        crowded = frames.groupBy(*group).count().where((F.col("count") > most) & (F.col("r") > 1)).drop("count")
        crowded = stored(crowded, "crowded")
        if crowded.isEmpty():
            return frames
        crowded = crowded.hint("merge")
        rest = frames.join(crowded, group, "left_anti").select(*frames.columns)
        more = _halved(frames.join(crowded, group, "left_semi").select(*frames.columns))
        frames = stored(rest.unionByName(more), "frames")


# Acceptor and composition


class Acceptor:
    """A minimal acceptor of sorted words; each group has an initial state of its own."""

    def __init__(self, group: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
        """`codes` holds the letters of a word in a row, padded with zeros; `group` says where groups begin."""
        n, width = codes.shape
        new = np.empty((width + 1, n), dtype=bool)
        new[0] = group
        for depth in range(width):
            new[depth + 1] = new[depth]
            new[depth + 1, 1:] |= codes[1:, depth] != codes[:-1, depth]
        sizes, firsts, targets, letters = [], [], [], []
        self.final, self.words = np.empty(0, bool), np.empty(0, np.int64)
        known, known_state = np.empty(0, np.uint64), np.empty(0, np.int64)
        below: tuple[np.ndarray, np.ndarray] | None = None
        for depth in range(width, -1, -1):
            start = np.flatnonzero(new[depth] & (lengths >= depth))
            final = lengths[start] == depth
            words, sign = final.astype(np.int64), arrays.mix(final.astype(np.uint64) + np.uint64(1))
            arcs = np.zeros(len(start), dtype=np.int64)
            if below is not None and len(below[0]):
                child, state = below
                parent = np.searchsorted(start, child, "right") - 1
                letter = codes[child, depth]
                np.add.at(words, parent, self.words[state])
                arc = arrays.mix(arrays.mix(letter.astype(np.uint64)) + state.astype(np.uint64))
                np.add.at(sign, parent, arc)
                arcs += np.bincount(parent, minlength=len(start))
            found, first, which = np.unique(sign, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
            old = known[at] == found if len(known) else np.zeros(len(found), dtype=bool)
            state_of = np.empty(len(found), dtype=np.int64)
            state_of[old] = known_state[at[old]] if len(known) else 0
            fresh = np.flatnonzero(~old)
            state_of[fresh] = len(self.final) + np.arange(len(fresh))
            rows = first[fresh]
            self.final = np.concatenate((self.final, final[rows]))
            self.words = np.concatenate((self.words, words[rows]))
            sizes.append(arcs[rows])
            if below is not None and len(below[0]):
                mine = arrays.gathered(np.searchsorted(parent, rows), arcs[rows])
                targets.append(state[mine])
                letters.append(letter[mine])
            order = np.argsort(merged := np.concatenate((known, found[fresh])))
            known, known_state = merged[order], np.concatenate((known_state, state_of[fresh]))[order]
            below = start, state_of[which]
        firsts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        self.first = firsts
        self.target = np.concatenate([*targets, np.empty(0, np.int64)])
        self.letter = np.concatenate([*letters, np.empty(0, np.int64)]).astype(np.int64)
        of = np.repeat(np.arange(len(self.final)), np.diff(firsts))
        self.keys = of << _CODE_BITS | self.letter
        # Words of a state that come before those of an arc: its own end, and those of the arcs in front.
        through = np.concatenate(([0], np.cumsum(self.words[self.target])))
        self.before = through[:-1] - through[firsts[of]] + self.final[of]
        self.initial, self.base = below[1], below[0]

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the given states, and which of the given states each belongs to."""
        n = self.first[states + 1] - self.first[states]
        return arrays.gathered(self.first[states], n), np.repeat(np.arange(len(states)), n)

    def common(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of the left state and of the right one with the same letter, and the pair each belongs to."""
        swap = self.first[right + 1] - self.first[right] < self.first[left + 1] - self.first[left]
        few, many = np.where(swap, right, left), np.where(swap, left, right)
        arc, of = self.arcs(few)
        keys = many[of] << _CODE_BITS | self.letter[arc]
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        same = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        arc, at, of = arc[same], at[same], of[same]
        return np.where(swap[of], at, arc), np.where(swap[of], arc, at), of


def one_edit_pairs(
    acceptor: Acceptor, lengths: np.ndarray, longer: np.ndarray, following: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all accepted pairs of (acceptor o one edit o acceptor) within a group.

    `longer` is the length of the longer words of each word's group, `following` the letter that comes after
    (0 at the end of the word). Pairs of two shorter words are left to the group where they are the longer ones.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    none = np.empty(0, np.int64)
    state, word = acceptor.initial, acceptor.base
    left, right, a, b, barred, replaced = none, none, none, none, none, np.empty(0, bool)
    while len(state) or len(left):
        ends = acceptor.final[left] & acceptor.final[right]
        # The dropped letter must not be followed by an equal one; both replaced words must be the longer ones.
        ends &= (barred == 0) | (following[a] != barred)
        ends &= ~replaced | (lengths[a] == longer[a])
        found.append((a[ends], b[ends]))
        one, two, of = acceptor.common(left, right)
        goes = acceptor.letter[one] != barred[of]
        one, two, of = one[goes], two[goes], of[goes]
        after = [
            acceptor.target[one], acceptor.target[two], a[of] + acceptor.before[one], b[of] + acceptor.before[two],
            np.zeros(len(of), np.int64), replaced[of],
        ]
        arc, of = acceptor.arcs(state)
        # Letters replaced: each arc with those behind it.
        last = acceptor.first[state + 1][of]
        second = arrays.gathered(arc + 1, last - arc - 1)
        first = np.repeat(np.arange(len(arc)), last - arc - 1)
        here = word[of[first]]
        edits = [
            acceptor.target[arc[first]], acceptor.target[second], here + acceptor.before[arc[first]],
            here + acceptor.before[second], np.zeros(len(second), np.int64), np.ones(len(second), bool),
        ]
        # Letters dropped: the shorter word stays where it is.
        drops = [
            acceptor.target[arc], state[of], word[of] + acceptor.before[arc], word[of],
            acceptor.letter[arc], np.zeros(len(arc), bool),
        ]
        # A dropped letter is consumed by one side only, so that pair is compared at once.
        left, right, a, b, barred, replaced = (np.concatenate(x) for x in zip(after, edits, drops))
        state, word = acceptor.target[arc], word[of] + acceptor.before[arc]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none)


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data, _ = arrays.text_bytes(texts.cast(pa.large_binary()))
    flat = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.int32)
    codes = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    codes[row, arrays.gathered(np.zeros(len(lengths), np.int64), lengths)] = flat
    return codes, lengths


def _near(rows: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
    """word, n_near and the best near word (n, word) of the words of some whole groups."""
    codes, lengths = _codes(rows.column("between").combine_chunks())
    following, _ = _codes(pc.utf8_slice_codeunits(rows.column("after").combine_chunks(), 0, 1))
    following = following[:, 0] if following.shape[1] else np.zeros(len(lengths), np.int32)
    acceptor = Acceptor(begins, codes, lengths)
    a, b = one_edit_pairs(acceptor, lengths, rows.column("r").to_numpy().astype(np.int64), following.astype(np.int64))
    words = rows.column("word").combine_chunks()
    n = rows.column("n").to_numpy()
    rank = np.empty(len(n), dtype=np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(n))
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(a)))
    mine, best = pa.array(a[first]), pa.array(b[first])
    columns = [words.take(mine), pa.array(counts), pa.array(n[b[first]]), words.take(best)]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "near_n", "near"])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted frames: groups are taken together up to SYMBOLS, and never torn."""

    def begins_of(rows: pa.Table) -> np.ndarray:
        begins = np.ones(rows.num_rows, dtype=bool)
        if rows.num_rows > 1:
            same = None
            for c in ("r", "before", "after"):
                column = rows.column(c).combine_chunks()
                equal = pc.equal(column.slice(1), column.slice(0, len(column) - 1))
                same = equal if same is None else pc.and_(same, equal)
            begins[1:] = ~same.to_numpy(zero_copy_only=False)
        return begins

    def parts(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        """Composed parts of whole groups, then what is left."""
        nonlocal rest
        begins = begins_of(rows)
        starts = np.flatnonzero(begins)
        size = np.concatenate(([0], np.cumsum(rows.column("r").to_numpy().astype(np.int64) + 1)))
        at, whole = 0, starts if not last else np.append(starts, rows.num_rows)
        while True:
            # As many groups as fit, one at least; the last group may go on in the next batch.
            upto = whole[(whole > at) & (size[whole] - size[at] <= SYMBOLS)]
            upto = upto[-1] if len(upto) else (whole[whole > at][0] if (whole > at).any() else at)
            if upto == at or (not last and size[-1] - size[at] <= SYMBOLS):
                break
            yield _near(rows.slice(at, upto - at), begins[at:upto])
            at = upto
        rest = rows.slice(at)

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        yield from parts(table, last=False)
    if rest is not None and rest.num_rows:
        yield from parts(rest, last=True)
    arrays.give_back()


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """word, n, n_near and `best` (n and word of the near word that is the most frequent, NULL without one).

    `words` is what vocabulary() gives.
    """
    group = ["r", "before", "after"]
    dealt = _frames(words, most).repartition(*group).sortWithinPartitions(*group, "between")
    near = dealt.mapInArrow(_compose, "word string, n_near bigint, near_n bigint, near string")
    best = F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("word"))
    near = near.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("best"))
    alone = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast(near.schema["best"].dataType).alias("best"))
    found = alone.unionByName(near).groupBy("word")
    found = found.agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best.minus_n")).alias("n"), F.col("best.word").alias("word")))
    return found.withColumn("best", best)


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of all words with a form, by doubling. A form has twice the count, so paths are short."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further")).hint("merge")
        moved = stored(roots.join(further, "root", "left"), "roots")
        done = moved.where("further IS NOT NULL").isEmpty()
        if done:
            return roots
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    thinned: int = THINNED,
    most: int = GROUP,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of `docs`, which needs doc_id and text.

    The form is the most frequent near word if it is at least twice as frequent; the root follows forms to the last.
    """
    words = stored(vocabulary(docs, least_length, least_count, thinned), "vocabulary")
    release(docs.sparkSession)
    near = near_words(words, most)
    follows = F.col("best.n") >= 2 * F.col("n")
    near = near.select(
        "word", "n", "n_near", F.when(follows, F.col("best.word")).alias("form"), F.when(follows, F.col("best.n")).alias("form_n")
    )
    near = stored(near, "near-words")
    roots = _roots(near.where("form IS NOT NULL"))
    found = near.join(roots.hint("merge"), "word", "left")
    return found.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
