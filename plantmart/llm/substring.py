"""Repeated passages of words: seeds at winnowed anchors, extended both ways, later copies removed.

Anchors are the winnowed five-word grams: every window of 20 words has one, and equal windows have the
same one. Documents meet at equal anchors. From the anchor a match is extended to both sides over all
windows that contain it; equal extensions are recognised by their hashes, many partners at once (see
repeats.py), which gives the same maximal repeats as extending pair by pair without forming the pairs.

Defined cases: a NULL text has no words; texts shorter than a window keep all words; of equal windows the
one with the smallest doc_id and position stays (no doc_id comes first); rows that agree in doc_id and
text are one document given twice and get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantmart.llm import arrays, repeats


def deduplicated(docs: DataFrame, length: int = 20, gram: int = 5) -> DataFrame:
    """doc_id, text (the kept words with one space between them), n_words and n_removed of each row.

    `docs` needs doc_id and text. `length` is the shortest repeat in words.
    """
    windows = repeats.Windows(length, gram, refine=(1,), words=True, every=False)
    docs = repeats.keyed(docs)
    places = repeats.repeated(docs, windows)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            symbols = repeats.Symbols(chunk.column("text"), words=True)
            gone = repeats.marked(chunk, symbols, length)
            text = np.repeat(np.arange(chunk.num_rows), np.diff(symbols.offsets))
            removed = np.bincount(text[gone], minlength=chunk.num_rows)
            starts, sizes, text = symbols.starts[~gone], (symbols.ends - symbols.starts)[~gone], text[~gone]
            # Each kept word takes one more byte, a space, but for the last of its text.
            row = symbols.data[arrays.gathered(starts, sizes + 1) % max(len(symbols.data), 1)]
            ends = np.cumsum(sizes + 1)
            row[ends - 1] = 0x20
            last = np.append(text[1:] != text[:-1], True) if len(text) else np.empty(0, bool)
            row = np.delete(row, ends[last] - 1)
            lengths = np.bincount(text, weights=sizes + 1, minlength=chunk.num_rows).astype(np.int64)
            lengths -= np.bincount(text, minlength=chunk.num_rows) > 0
            kept = arrays.binaries(row, np.concatenate(([0], np.cumsum(lengths))), pa.string())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), kept, pa.array(np.diff(symbols.offsets)), pa.array(removed)],
                ["doc_id", "text", "n_words", "n_removed"],
            )

    schema = "doc_id bigint, text string, n_words bigint, n_removed bigint"
    return repeats.listed(docs, places).mapInArrow(cleaned, schema)
