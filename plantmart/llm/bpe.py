"""Byte-level BPE: encoding by merge replay over a block of the corpus, and decoding.

The distinct words of a block of texts (pieces matched by the tokenizer's pattern) are laid out as one row of
byte tokens. An inverted index leads from the rank of a token pair to its positions in that row. Merges
are applied in the order of their ranks; each touches only its positions and their two neighbours, whose
new pairs join the index. Words are independent of one another, so a block gives the same tokens as the
whole corpus would, and blocks keep memory bounded.

Should a merge give rise to a pair of lower rank than its own (no trained vocabulary is known to do so),
the word is encoded anew pair by pair, so that the result is always that of the greedy rule.

Defined cases: a NULL or empty text has no tokens; a NULL list of tokens decodes to no bytes; an id that is
not in the vocabulary fails; rows are encoded one by one, so repeated rows get equal tokens.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.storing import in_small_batches

BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 256 << 10
# Of the Arrow batches that come from Spark.
BATCH_BYTES = 1 << 20
# Positions that enter the index of pairs at a time.
ENTERED = 1 << 18
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file with one base64 token and one rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


class Vocabulary:
    """Ranks of single bytes and of all token pairs that can merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.square = self.merged(np.repeat(self.single, 256), np.tile(self.single, 256))
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        self.known = np.zeros(size, dtype=bool)
        for token, rank in ranks.items():
            tokens[rank] = token
            self.known[rank] = True
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair merges to, or NONE."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def greedy(self, word: bytes) -> list[int]:
        """One word, always merging the leftmost pair of lowest rank."""
        tokens = [int(self.single[b]) for b in word]
        while len(tokens) > 1:
            found = self.merged(np.array(tokens[:-1]), np.array(tokens[1:])).tolist()
            least = min(found)
            if least == NONE:
                break
            at = found.index(least)
            tokens[at : at + 2] = [least]
        return tokens


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words end to end, and how many tokens lie before each word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    n = len(data)
    if not n:
        return np.empty(0, np.int32), np.zeros(len(words) + 1, np.int64)
    token = vocabulary.single[data]
    ends = np.cumsum(lengths)
    place = np.int32 if n <= NONE else np.int64
    after = np.arange(1, n + 1, dtype=place)
    after[ends[lengths > 0] - 1] = -1
    before = np.arange(-1, n - 1, dtype=place)
    before[(ends - lengths)[lengths > 0]] = -1
    rank = np.full(n, NONE, dtype=np.int32)
    rank[:-1] = vocabulary.square[(data[:-1].astype(np.uint16) << 8) | data[1:]]
    rank[after < 0] = NONE

    index: dict[int, list[np.ndarray]] = {}

    def enter(positions: np.ndarray, ranks: np.ndarray) -> list[int]:
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        fresh = []
        for a, b, r in zip(starts, [*starts[1:], len(ranks)], ranks[starts].tolist()):
            if r in index:
                index[r].append(positions[a:b])
            else:
                index[r] = [positions[a:b]]
                fresh.append(r)
        return fresh

    queue: list[int] = []
    for at in range(0, n, ENTERED):
        mergeable = (np.flatnonzero(rank[at : at + ENTERED] != NONE) + at).astype(place)
        if len(mergeable):
            queue += enter(mergeable, rank[mergeable])
    heapq.heapify(queue)
    dead = np.zeros(n, dtype=bool)
    odd: set[int] = set()
    while queue:
        r = heapq.heappop(queue)
        at = np.concatenate(parts) if len(parts := index.pop(r)) > 1 else parts[0]
        at = np.unique(at[(rank[at] == r) & ~dead[at]])
        if not len(at):
            continue
        # Of pairs that share a token, the leftmost merges, then the next one that is still whole.
        chained = np.zeros(len(at), dtype=bool)
        chained[1:] = after[at[:-1]] == at[1:]
        if chained.any():
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
        gone = after[at]
        dead[gone] = True
        token[at] = r
        following = after[gone]
        after[at] = following
        inner = following >= 0
        before[following[inner]] = at[inner]
        right = np.full(len(at), NONE, dtype=np.int32)
        right[inner] = vocabulary.merged(token[at[inner]], token[following[inner]])
        rank[at] = right
        rank[gone] = NONE
        left_at = before[at]
        left_at = left_at[left_at >= 0]
        left = vocabulary.merged(token[left_at], token[after[left_at]])
        rank[left_at] = left
        positions, ranks = np.concatenate((at, left_at)), np.concatenate((right, left))
        found = ranks != NONE
        if found.any():
            positions, ranks = positions[found], ranks[found]
            if (ranks <= r).any():
                odd.update(np.searchsorted(ends, positions[ranks <= r], "right").tolist())
            for fresh in enter(positions, ranks):
                heapq.heappush(queue, fresh)
    alive = np.flatnonzero(~dead)
    tokens, first = token[alive], np.searchsorted(alive, np.concatenate(([0], ends)))
    if not odd:
        return tokens, first
    parts = [
        np.array(vocabulary.greedy(word), dtype=np.int32) if k in odd else tokens[first[k] : first[k + 1]]
        for k, word in enumerate(words)
    ]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


class _Numbered(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    block, size = [], 0
    for chunk in arrays.chunks(batches, most=CHUNK_BYTES):
        # A copy, as a slice would keep the whole batch while the next one is read.
        block.append(chunk.take(pa.array(np.arange(chunk.num_rows))))
        size += chunk.column("text").nbytes
        del chunk
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _encoded_block(block: list[pa.RecordBatch], vocabulary: Vocabulary, split: regex.Pattern):
    """Token lists of the texts of each chunk of a block: values, and where each text's tokens start."""
    numbers = _Numbered()
    found: list[list[np.ndarray]] = []
    for chunk in block:
        found.append([])
        for text in chunk.column("text"):
            words = split.findall(text.as_buffer().to_pybytes().decode("utf-8", "replace"))
            found[-1].append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    words = [word.encode() for word in numbers]
    del numbers
    tokens, first = replay(words, vocabulary)
    del words
    lengths = np.diff(first)
    for mine in found:
        at = np.concatenate(mine)
        before = np.concatenate(([0], np.cumsum(lengths[at])))
        yield tokens[arrays.gathered(first[at], lengths[at])], before[np.cumsum([0, *map(len, mine)])]


def _decoded(vocabulary: Vocabulary, tokens: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes of each list of tokens."""
    tokens = tokens.astype(np.int64)
    if len(tokens) and not (
        0 <= tokens.min() and tokens.max() < len(vocabulary.known) and vocabulary.known[tokens].all()
    ):
        raise ValueError("an id is not in the vocabulary")
    lengths = vocabulary.lengths[tokens]
    data = vocabulary.bytes[arrays.gathered(vocabulary.starts[tokens], lengths)]
    return arrays.binaries(data, np.concatenate(([0], np.cumsum(lengths)))[offsets], pa.binary())


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False, carried: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id and tokens (an array of int) of every row of `docs`, which needs doc_id and text.

    Each match of `pattern` is encoded separately; there are no special tokens. With `decoded`, the tokens
    are decoded again in the same pass, into the column `decoded`. Columns named in `carried` come along.
    """
    shared = docs.sparkSession.sparkContext.broadcast((Vocabulary(ranks), pattern))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = shared.value[0], regex.compile(shared.value[1])
        for block in _blocks(batches):
            for chunk, (tokens, offsets) in zip(block, _encoded_block(block, vocabulary, split)):
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens))
                columns = {"doc_id": chunk.column("doc_id"), "tokens": lists}
                if decoded:
                    columns["decoded"] = _decoded(vocabulary, tokens, offsets)
                columns |= {c: chunk.column(c) for c in carried}
                yield pa.RecordBatch.from_pydict(columns)
                del tokens, offsets, lists, columns, chunk
            # What a block has freed is no use to the next one while the executor's other tasks need it.
            del block
            arrays.give_back()

    texts = docs.select(F.col("doc_id").cast("bigint"), "text", *carried)
    schema = "doc_id bigint, tokens array<int>" + (", decoded binary" if decoded else "")
    schema += "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    return in_small_batches(texts, BATCH_BYTES).mapInArrow(encoded, schema)


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The rows of (doc_id, tokens) with the bytes that the tokens stand for, as `decoded`."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(ranks))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            lists = batch.column("tokens")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            found = _decoded(vocabulary, tokens, np.concatenate(([0], np.cumsum(sizes))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, found], ["doc_id", "tokens", "decoded"]
            )

    return rows.select("doc_id", "tokens").mapInArrow(texts, "doc_id bigint, tokens array<int>, decoded binary")


def joined(tokens: Column) -> Column:
    """Decimal ids with commas between them."""
    return F.array_join(tokens.cast("array<string>"), ",")
