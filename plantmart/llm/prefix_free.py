"""Repeated byte strings by prefix-free parsing of the corpus.

A rolling hash over 128 bytes triggers phrase borders: a position is a trigger if its hash is the
smallest in some window of a repeat's length, so no phrase is longer than that, and copies are parsed
alike wherever they stand. The dictionary holds the contexts of triggers, each distinct one once; the
parse is the list of triggers with the context each of them has. Sorting the parse by (trigger hash,
context) brings the suffixes that start with equal bytes together, which is all that the order of suffixes
serves for here; entries of the dictionary that agree only in part are cut into shorter phrases of
16 and then of single suffixes and sorted again. See repeats.py, and README.md on the order used.

Defined cases: a NULL text is empty; texts shorter than a repeat keep all bytes; rows that agree in doc_id
and text are one document given twice, which is no repeat, and get equal results; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plantmart.llm import arrays, repeats


def deduplicated(docs: DataFrame, length: int = 400, gram: int = 128) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed and n_spans of each row; `docs` needs doc_id and text.

    Every byte in a string of `length` bytes that starts anywhere else too is removed.
    """
    windows = repeats.Windows(length, gram, refine=(16, 1), words=False, every=True)
    docs = repeats.keyed(docs)
    places = repeats.repeated(docs, windows)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            symbols = repeats.Symbols(chunk.column("text"), words=False)
            gone = repeats.marked(chunk, symbols, length)
            before = np.concatenate(([0], np.cumsum(gone)))[symbols.offsets]
            runs = np.searchsorted(arrays.spans(gone, symbols.offsets[:-1])[0], symbols.offsets)
            kept = arrays.binaries(symbols.data[~gone], symbols.offsets - before, pa.binary())
            counts = [pa.array(np.diff(x)) for x in (symbols.offsets, before, runs)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), kept, *counts], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
            )

    schema = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return repeats.listed(docs, places).mapInArrow(cleaned, schema)
