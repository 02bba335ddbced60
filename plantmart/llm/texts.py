"""Words, lines, hashes and counts of a chunk of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from plantmart.llm import arrays

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
CLASSES = ("space", "lower", "upper", "digit", "stop", "symbol", "other", "wide")


def _class_table() -> np.ndarray:
    table = np.full(256, 6, dtype=np.uint8)
    table[arrays.IS_SPACE] = 0
    table[ord("a") : ord("z") + 1] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    table[list(b".,;:?'\"-()")] = 4
    table[list(SYMBOLS)] = 5
    table[0x80:] = 7
    return table


CLASS_OF = _class_table()


class Texts:
    """Words, hashes and counts of one chunk of texts."""

    def __init__(self, texts: pa.LargeBinaryArray):
        self.data, self.offsets = arrays.text_bytes(texts)
        self.starts, self.ends, self.first = arrays.word_spans(self.data, self.offsets)
        self.n = len(texts)
        self.n_words = np.diff(self.first)
        self.text_of_word = np.repeat(np.arange(self.n), self.n_words)
        prefix = arrays.prefix_hash(self.data.astype(np.uint64) + np.uint64(1))
        self.prefix = prefix
        self.words = arrays.range_hash(prefix, self.starts, self.ends)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many of the bytes are flagged in each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def classes(self) -> np.ndarray:
        kinds = CLASS_OF[self.data]
        return np.stack([self.per_text(kinds == k) for k in range(len(CLASSES))], axis=1)

    def word_chars(self) -> np.ndarray:
        return self.per_text(((self.data & 0xC0) != 0x80) & ~arrays.IS_SPACE[self.data])

    def symbols(self) -> np.ndarray:
        return self.per_text(CLASS_OF[self.data] == 5)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and texts of the lines with at least one word."""
        breaks = np.flatnonzero(self.data == 0x0A)
        starts = np.sort(np.concatenate((self.offsets[:-1], breaks + 1)))
        text = np.sort(
            np.concatenate((np.arange(self.n), np.searchsorted(self.offsets, breaks, "right") - 1))
        )
        last = np.append(text[1:] != text[:-1], True) if len(text) else np.empty(0, bool)
        ends = np.empty(len(starts), np.int64)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.offsets[text[last] + 1]
        filled = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        return starts[filled], ends[filled], text[filled]

    def distinct_words(self) -> np.ndarray:
        keys = arrays.mix(self.words + arrays.mix(self.text_of_word.astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[order][1:] != keys[order][:-1]
        return np.bincount(self.text_of_word[order[first]], minlength=self.n)

    def repeated_lines(self) -> np.ndarray:
        starts, ends, text = self.lines()
        line = arrays.range_hash(self.prefix, starts, ends)
        order = np.lexsort((line, text))
        same = (line[order][1:] == line[order][:-1]) & (text[order][1:] == text[order][:-1])
        return np.bincount(text[order][1:][same], minlength=self.n)

    def repeated_words(self) -> np.ndarray:
        """Words that lie in a window of eight words found at least twice in their text."""
        count = len(self.words) - WINDOW + 1
        if count <= 0:
            return np.zeros(self.n, np.int64)
        windows = np.zeros(count, dtype=np.uint64)
        for k in range(WINDOW):
            windows = windows * arrays.BASE + self.words[k : k + count]
        at = np.flatnonzero(self.text_of_word[:count] == self.text_of_word[WINDOW - 1 :])
        keys = arrays.mix(windows[at] + arrays.mix(self.text_of_word[at].astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        inside = arrays.covered(at[again], at[again] + WINDOW, len(self.words))
        return np.bincount(self.text_of_word[inside], minlength=self.n)
