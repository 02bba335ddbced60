"""Numpy on Arrow batches: text bytes, word spans, hashes and window minima, without per-word Python.

Everything here works on one chunk of whole texts at a time, so memory follows the chunk size (or one
text, if that is longer) and never the table.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
# Positions that are told apart beside a 40-bit hash.
PLACES = 1 << 24
BASE = np.uint64(0x9E3779B97F4A7C15)
LENGTH_FACTOR = 0xD6E8FEB86659FD93
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Space, tab, line feed, vertical tab, form feed and carriage return separate words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[str, np.ndarray] = {}


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of at most `most` text bytes, or of a single longer text; NULL texts become empty."""
    yield from _slices(batches, column, most)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: an idle Python worker would keep it beside the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at).cast(pa.large_binary()), b"")
        batch = batch.set_column(at, column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        # Else it would stay until the next one has been read.
        del batch, texts


def text_bytes(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column end to end, and where each text starts (with the end as a last entry)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, starts_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last position of each run of true values; runs never cross a text."""
    n = len(inside)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = starts_text[(starts_text > 0) & (starts_text < n)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and how many words lie before each text."""
    starts, ends = spans(~IS_SPACE[data], offsets[:-1])
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that equal inputs and only those give equal outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, kind: str = "up") -> np.ndarray:
    """BASE (or its inverse, modulo 2^64) to the power of 0 to n."""
    known = _powers.get(kind)
    if known is None or len(known) <= n:
        steps = np.full(max(n + 1, CHUNK_BYTES + 2), BASE if kind == "up" else BASE_INVERSE, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= CHUNK_BYTES:
            _powers[kind] = known
    return known[: n + 1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of BASE, so that any range has a hash in two steps."""
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values.astype(np.uint64) * powers(len(values))[:-1], dtype=np.uint64, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end) over the values behind `prefix`."""
    raw = (prefix[ends] - prefix[starts]) * powers(len(prefix) - 1, "down")[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(LENGTH_FACTOR))


def window_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` values, as range_hash would give them."""
    count = len(prefix) - size
    if count <= 0:
        return np.empty(0, np.uint64)
    raw = (prefix[size:] - prefix[:count]) * powers(len(prefix) - 1, "down")[:count]
    return mix(raw + np.uint64(size * LENGTH_FACTOR % (1 << 64)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(data.astype(np.uint64) + np.uint64(1)), starts, ends)


def window_minimum(hashes: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest hash in each window of `width` hashes, the last of equal ones.

    Windows are those that start at 0 to len(hashes) - width. The first 40 bits of the hashes count. The
    choice depends on the window's content alone, not on where it stands or how long the rest is, so
    equal stretches of text choose equal positions.
    """
    n, step = len(hashes), PLACES - width + 1
    parts = [_least_places(hashes[at : at + PLACES], width) + at for at in range(0, n - width + 1, step)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    low = np.uint64(PLACES - 1)
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = len(hashes) - width + 1
    least = np.minimum(least[:count], least[width - size : width - size + count])
    return (low - (least & low)).astype(np.int64)


def last_run(keys: list[np.ndarray]) -> int:
    """Where the last run of equal keys begins."""
    n = len(keys[0])
    if not n:
        return 0
    differs = np.zeros(n, dtype=bool)
    for key in keys:
        differs |= key != key[-1]
    return int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in any of the ranges [start, end)."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change[: n + 1])[:n] > 0


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def binaries(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of byte strings (or of text) cut from `data` at the offsets."""
    large = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )
    return large.cast(kind)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch with the given columns, cast to the schema."""
    arrays = []
    for field in schema:
        value = columns[field.name]
        array = value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value)
        array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
        arrays.append(array if array.type == field.type else array.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
