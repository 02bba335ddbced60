"""Token counts of a sentencepiece BPE model, by rank-synchronous merging in ragged arrays.

A block of texts is cut into pre-tokens: a run of spaces with the word behind it. No piece of such a model has a
space behind another character, so no merge crosses a cut (where a model has one, whole texts are the
pre-tokens). The distinct pre-tokens of the block lie end to end in one numpy array of symbols. In each round every
sequence merges its pair of lowest rank, all sequences at once; those without a mergeable pair are settled.
What survives is counted: a piece is one token, a character that is no piece one for each of its bytes.

A sequence merges all occurrences of its lowest rank in one round, the left one of two that overlap. That is what
one merge after the other would give, except where pieces share a rank or where a merge gives rise to a
pair of no higher rank. Then a sequence merges its leftmost pair only, or, if it is long, is merged
with a heap, pair by pair.

Defined cases: a NULL or empty text has no bytes and no tokens; strings of control or byte pieces inside a text are
ordinary text; rows are counted one by one, so repeated rows get equal counts; a text longer than a
block is a block of its own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays

BLOCK_BYTES = 8 << 20
NONE = np.int32(2**31 - 1)
SPACE = "▁"
# Sequences of more symbols are not merged one pair a round.
LONG = 64
_NORMAL, _KNOWN_TYPES = 1, (1, 2, 3, 6)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file whose texts need no normalising besides the leading space."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trainer, normal = model.trainer_spec, model.normalizer_spec
    plain = not normal.precompiled_charsmap and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
    if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not plain:
        raise ValueError(f"{path}: not a BPE model with byte fallback and plain text")
    if any(p.type not in _KNOWN_TYPES for p in model.pieces):
        raise ValueError(f"{path}: user-defined or unused pieces")
    return [(p.piece, p.score) for p in model.pieces if p.type == _NORMAL]


class Vocabulary:
    """Symbols, the tokens each counts, and ranks of all pairs of symbols that merge into a piece."""

    def __init__(self, pieces: list[tuple[str, float]]):
        known = dict(pieces)
        symbols = {piece: k for k, piece in enumerate(known)}
        for char in sorted({c for piece in known for c in piece} - set(known)):
            symbols[char] = len(symbols)
        # Four symbols stand for the other characters, by their bytes.
        self.other = len(symbols)
        self.weight = np.ones(self.other + 5, dtype=np.int64)
        self.weight[self.other :] = range(5)
        for symbol, k in symbols.items():
            if symbol not in known:
                self.weight[k] = len(symbol.encode())
        chars = sorted((ord(s), k) for s, k in symbols.items() if len(s) == 1)
        self.points = np.array([p for p, _ in chars], dtype=np.int32)
        self.of_point = np.array([k for _, k in chars], dtype=np.int32)
        levels = {score: k for k, score in enumerate(sorted(set(known.values()), reverse=True))}
        counts = np.bincount([levels[s] for s in known.values()])
        self.shared = counts > 1
        pairs = {}
        for piece, score in known.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (levels[score], symbols[piece])
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int32)
        self.splits = not any(a != SPACE and b == SPACE for piece in known for a, b in zip(piece, piece[1:]))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        return np.where(self.points[at] == points, self.of_point[at], self.other + width).astype(np.int32)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without one) and merged symbol of each pair."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), self.merged[at]

    def greedy(self, tokens: list[int]) -> int:
        """Tokens of one sequence, always merging the leftmost pair of lowest rank."""
        n = len(tokens)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue = []

        def enter(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (found := self.pairs.get(tokens[a] << 32 | tokens[b])):
                queue.append((found[0], a, b, tokens[a], tokens[b], found[1]))

        for k in range(n - 1):
            enter(k, k + 1)
        heapq.heapify(queue)
        fresh, queue = queue, []
        while fresh:
            _, a, b, left, right, merged = heapq.heappop(fresh)
            if tokens[a] != left or tokens[b] != right or after[a] != b:
                continue
            tokens[a], tokens[b] = merged, -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            enter(before[a], a)
            enter(a, after[a])
            for entry in queue:
                heapq.heappush(fresh, entry)
            queue.clear()
        return int(sum(self.weight[t] for t in tokens if t >= 0))


def surviving(tokens: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Tokens that each sequence of symbols comes to; sequences lie end to end and none is empty."""
    counts = np.zeros(len(lengths), dtype=np.int64)
    first, original = np.cumsum(lengths) - lengths, tokens
    sequence = np.arange(len(lengths))

    def settle(one: int) -> None:
        counts[one] = vocabulary.greedy(original[first[one] : first[one] + lengths[one]].tolist())

    size = lengths.copy()
    rank = np.full(len(tokens), NONE, dtype=np.int32)
    rank[:-1] = vocabulary.pair(tokens[:-1], tokens[1:])[0] if len(tokens) else rank[:-1]
    rank[np.cumsum(size) - 1] = NONE
    while len(sequence):
        start = np.cumsum(size) - size
        least = np.minimum.reduceat(rank, start)
        done = least == NONE
        counts[sequence[done]] = np.add.reduceat(vocabulary.weight[tokens], start)[done]
        tied = ~done
        tied[tied] = vocabulary.shared[least[tied]]
        for one in sequence[tied & (size > LONG)].tolist():
            settle(one)
        done |= tied & (size > LONG)
        if done.any():
            stays = np.repeat(~done, size)
            tokens, rank = tokens[stays], rank[stays]
            sequence, size, least, tied = sequence[~done], size[~done], least[~done], tied[~done]
            if not len(sequence):
                break
        of = np.repeat(np.arange(len(size)), size)
        at = np.flatnonzero(rank == least[of])
        if tied.any():
            leftmost = np.ones(len(at), dtype=bool)
            leftmost[1:] = of[at[1:]] != of[at[:-1]]
            at = at[leftmost | ~tied[of[at]]]
        chained = np.zeros(len(at), dtype=bool)
        chained[1:] = (at[1:] == at[:-1] + 1) & (of[at[1:]] == of[at[:-1]])
        if chained.any():
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0]
        tokens = tokens.copy()
        tokens[at] = vocabulary.pair(tokens[at], tokens[at + 1])[1]
        stays = np.ones(len(tokens), dtype=bool)
        stays[at + 1] = False
        moved = np.cumsum(stays) - 1
        merges = np.bincount(of[at], minlength=len(size))
        at, tokens, rank, of = moved[at], tokens[stays], rank[stays], of[stays]
        size = size - merges
        touched = np.zeros(len(tokens), dtype=bool)
        touched[at] = touched[at[at > 0] - 1] = True
        touched = np.flatnonzero(touched)
        inner = touched[touched + 1 < len(tokens)]
        inner = inner[of[inner] == of[inner + 1]]
        rank[touched] = NONE
        rank[inner] = vocabulary.pair(tokens[inner], tokens[inner + 1])[0]
        early = inner[(rank[inner] <= least[of[inner]]) & (merges[of[inner]] > 1)]
        if len(early):
            odd = np.unique(of[early])
            for one in sequence[odd].tolist():
                settle(one)
            keep = np.ones(len(size), dtype=bool)
            keep[odd] = False
            stays = np.repeat(keep, size)
            tokens, rank, sequence, size = tokens[stays], rank[stays], sequence[keep], size[keep]
    return counts


def _points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.int32)


def _pretokens(texts: pa.LargeBinaryArray, splits: bool) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of the texts, spaces in front, and how many lie before each text."""
    spaced = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
    spaced = pc.replace_substring(spaced, pattern=SPACE.encode(), replacement=b" ")
    data, offsets = arrays.text_bytes(spaced)
    starts = offsets[:-1]
    if splits:
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[starts] = True
        starts = np.flatnonzero(begins)
    return arrays.binaries(data, np.append(starts, len(data)), pa.large_binary()), np.searchsorted(starts, offsets)


def counted(texts: pa.LargeBinaryArray, vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each text of a block."""
    words, before = _pretokens(texts, vocabulary.splits)
    coded = words.dictionary_encode()
    data, offsets = arrays.text_bytes(coded.dictionary)
    lengths = np.diff(np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets])
    points = _points(data)
    points = np.where(points == 0x20, ord(SPACE), points).astype(np.int32)
    each = surviving(vocabulary.symbols(points), lengths, vocabulary)
    total = np.concatenate(([0], np.cumsum(each[coded.indices.to_numpy()])))[before]
    filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    return np.where(filled, np.diff(total), 0)


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]]) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row of `docs`, which needs doc_id and text.

    `pieces` is what read_pieces() gives. There are no begin, end or other added tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for block in arrays.chunks(batches, most=BLOCK_BYTES):
            texts = block.column("text")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            n_tokens = pa.array(counted(texts, vocabulary))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    return texts.mapInArrow(counts, "doc_id bigint, n_bytes bigint, n_tokens bigint")
