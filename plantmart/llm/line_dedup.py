"""Repeated runs of lines by distributed prefix doubling over the sequences of line ids.

Lines with a word get ids, equal lines equal ones. Names of runs are doubled: the name of the 2 L lines
from a line on is made of the names of its first and second L lines, as in building a suffix array. Only
runs whose name occurs again stay active. At `least_lines` lines the runs with one name are the interval
of suffixes whose common prefix is at least that long; its first member stays, and the lines of all others
are deleted. Neighbouring members join into the maximal repeated runs.

A single line is a run of its own if it has `least_words` words, as a paragraph has, whether its neighbours are
repeated or not; shorter single lines stay, as they may be chance.

Names are 128-bit digests instead of ranks: only their equality is used, and ranks would need a global sort
at every length.

Defined cases: a NULL text counts as empty and becomes so; lines without a word belong to no run and are
never deleted; a text that loses all lines with a word stays as a row; rows that agree in doc_id and text
are one document given twice and get equal results; rows without a doc_id come first; ties in doc_id are
ordered by a hash of the text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.repeats import NO_ID, keyed
from plantmart.llm.storing import Steps, unused

LEAST_WORDS = 10
WORD = "[^\\x20\\x09-\\x0D]"


def _lines(docs: DataFrame) -> DataFrame:
    """doc, row, i (number among the lines with a word), line (number among all), name, words."""
    lines = docs.select("doc", "row", F.posexplode(F.split("text", "\n", -1)).alias("line", "value"))
    named = lines.where(F.col("value").rlike(WORD)).select(
        "doc", "row", "line", F.unhex(F.md5("value")).alias("name"),
        F.regexp_count("value", F.lit(WORD + "+")).alias("words"),
    )
    # Lines of a document given twice share a number.
    place = F.dense_rank().over(Window.partitionBy("doc", "row").orderBy("line"))
    return named.select("*", place.alias("i"))


def _doubled(runs: DataFrame, step: int) -> DataFrame:
    """Names of the runs that reach `step` lines further."""
    after = Window.partitionBy("doc", "row").orderBy("i").rangeBetween(step, step)
    found = runs.withColumn("second", F.first("name").over(after)).where("second is not null")
    return found.select("doc", "row", "i", F.unhex(F.md5(F.concat("name", "second"))).alias("name"))


def _active(runs: DataFrame, steps: Steps) -> DataFrame:
    """Runs whose name occurs more than once, with the place of the first.

    The names are written first: a join of two shuffled sides is one whose hot keys Spark splits, which it
    cannot do in the stage that groups the names.
    """
    place = F.struct("doc", "row", "i")
    names = runs.groupBy("name").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    again = steps.store(names.where("first != last").select("name", "first"), "names")
    return runs.join(again.hint("merge"), "name")


def _later(runs: DataFrame, length: int) -> DataFrame:
    """Where a run of `length` lines that has been before begins and ends."""
    later = runs.where(F.struct("doc", "row", "i") != F.col("first"))
    return later.select("doc", "row", "i", (F.col("i") + length).alias("end"))


def dead_lines(docs: DataFrame, least_lines: int = 2, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, row, dead): per document the numbers of the lines to delete. `docs` is what keyed() gives."""
    steps = Steps(docs.sparkSession)
    lines = steps.store(_lines(docs), "lines")
    runs, length = steps.store(_active(lines.select("doc", "row", "i", "name", "words"), steps), "runs"), 1
    single = steps.store(_later(runs.where(F.col("words") >= least_words), 1), "single-lines")
    runs = runs.drop("words")
    while length < least_lines:
        step = min(length, least_lines - length)
        runs = steps.store(_active(_doubled(runs.drop("first"), step), steps), "runs")
        length += step
        steps.keep_only(lines, single, runs)
    copies = _later(runs, length).unionByName(single).groupBy("doc", "row", "i").agg(F.max("end").alias("end"))
    before = Window.partitionBy("doc", "row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max("end").over(before)
    marked = lines.join(copies, ["doc", "row", "i"], "left").withColumn("reach", reach).where("reach > i")
    dead = marked.groupBy("doc", "row").agg(F.sort_array(F.collect_set("line")).alias("dead"))
    dead = steps.store(dead, "dead-lines")
    steps.keep_only(dead)
    return dead


def _without(chunk: pa.RecordBatch, dead_column: str) -> tuple[pa.Array, list[np.ndarray]]:
    """The texts without their dead lines; numbers of lines with a word, dead lines and runs of these."""
    data, offsets = arrays.text_bytes(chunk.column("text"))
    breaks = np.flatnonzero(data == 0x0A)
    n = chunk.num_rows
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    text = np.sort(np.concatenate((np.arange(n), np.searchsorted(offsets, breaks, "right") - 1)))
    words = arrays.spans(~arrays.IS_SPACE[data], offsets[:-1])[0]
    ends = np.append(starts[1:], len(data))
    filled = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    first = np.searchsorted(text, np.arange(n))
    lists = chunk.column(dead_column)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    gone = lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(first, counts)
    dead = np.zeros(len(starts), dtype=bool)
    dead[gone.astype(np.int64)] = True
    # A line goes with the line break after it; the last line of a text with the break before it.
    keep = ~np.repeat(dead, ends - starts)
    kept_lines = np.flatnonzero(~dead)
    text_kept = text[kept_lines]
    last_kept = kept_lines[np.append(text_kept[1:] != text_kept[:-1], len(text_kept) > 0)[: len(text_kept)]]
    last_line = np.append(first[1:], len(starts)) - 1
    short = last_kept[last_kept != last_line[text[last_kept]]]
    keep[ends[short] - 1] = False
    before = np.concatenate(([0], np.cumsum(keep)))[offsets]
    texts = arrays.binaries(data[keep], before, pa.string())
    dead, text = dead[filled], text[filled]
    begins = dead.copy()
    begins[1:] &= ~dead[:-1] | (text[1:] != text[:-1])
    return texts, [np.bincount(x, minlength=n) for x in (text, text[dead], text[begins])]


def _with_dead(docs: DataFrame, least_lines: int, least_words: int, dead_column: str) -> DataFrame:
    """The rows with the list of their dead lines, which is NULL for most.

    The lists grow with the documents, so they are merged with them and not broadcast, whatever their size.
    """
    of_doc, of_row = (unused(c, [*docs.columns, dead_column]) for c in ("of_doc", "of_row"))
    dead = dead_lines(keyed(docs), least_lines, least_words).hint("merge")
    dead = dead.select(F.col("doc").alias(of_doc), F.col("row").alias(of_row), F.col("dead").alias(dead_column))
    doc = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID))
    same = (doc == F.col(of_doc)) & (F.xxhash64(docs["text"]) == F.col(of_row))
    return docs.join(dead, same, "left").drop(of_doc, of_row)


def deduplicated(docs: DataFrame, least_lines: int = 2, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text without later copies, n_lines (with a word), n_deleted and n_runs of each row."""
    marked = _with_dead(docs.select("doc_id", "text"), least_lines, least_words, "dead")

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            texts, counts = _without(chunk, "dead")
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), texts, *map(pa.array, counts)],
                ["doc_id", "text", "n_lines", "n_deleted", "n_runs"],
            )

    schema = "doc_id bigint, text string, n_lines bigint, n_deleted bigint, n_runs bigint"
    return marked.select(F.col("doc_id").cast("bigint"), "text", "dead").mapInArrow(without, schema)


def cleaned(docs: DataFrame, least_lines: int = 2, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents with all their columns; later copies are deleted from the texts.

    n_chars, if there is such a column, follows the text.
    """
    columns = docs.columns
    dead = unused("dead", columns)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            texts, _ = _without(chunk, dead)
            kept = [texts if c == "text" else chunk.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(kept, columns)

    found = _with_dead(docs, least_lines, least_words, dead).mapInArrow(without, docs.schema)
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found
