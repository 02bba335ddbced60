"""Quality rules: plain counts, and how far a document's histograms lie from its language's.

Two histograms are kept per document: character classes of all bytes, and common words (with one bin for
all other words). The reference of a language sums them over all its documents. The distance is the
Jensen-Shannon distance with base 2, from 0 to 1. Short documents have noisy histograms, so each
distance is only used from a minimum number of words on.

Defined cases: a NULL text has no words; a NULL language forms a language of its own; documents are
judged row by row, so repeated rows get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.texts import CLASSES, Texts
from plantmart.session import new_folder

@dataclass(frozen=True)
class Rules:
    """Limits; a document is rejected if a base limit or a distance limit is passed."""

    least_words: int = 20
    most_repeated: float = 0.30
    # A word is common if it makes up at least this share of its language's words.
    common_share: float = 0.004
    # Guards, and limits of the distances: chance alone adds to a distance as 1 / sqrt(words).
    least_words_for_classes: int = 20
    most_class_distance: float = 0.18
    class_slack: float = 0.8
    least_words_for_words: int = 60
    most_word_distance: float = 0.22
    word_slack: float = 1.0


_COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int8()), ("bin", pa.int64()), ("n", pa.int64())])


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language of character classes (kind 0), words by hash (1) and all words (2)."""
    for chunk in arrays.chunks(batches):
        texts = Texts(chunk.column("text"))
        codes = chunk.column("lang").dictionary_encode()
        code = codes.indices.fill_null(len(codes.dictionary)).to_numpy().astype(np.int64)
        names = [*codes.dictionary.to_pylist(), None]
        classes = texts.classes()
        for c in np.unique(code):
            mine = code == c
            words, n = np.unique(texts.words[mine[texts.text_of_word]], return_counts=True)
            bins = np.concatenate((np.arange(len(CLASSES)), words.view(np.int64), [0]))
            kinds = np.concatenate((np.zeros(len(CLASSES)), np.ones(len(words)), [2])).astype(np.int8)
            counts = np.concatenate((classes[mine].sum(0), n, [n.sum()]))
            yield arrays.batch_of(
                {"lang": pa.array([names[c]] * len(bins), pa.string()), "kind": kinds, "bin": bins, "n": counts},
                _COUNTS,
            )


def references(docs: DataFrame, rules: Rules) -> dict[str | None, dict]:
    """Per language the counts of character classes, of its common words and of all words.

    All documents are counted; the counts are written once, because the totals decide which of the
    words are common. What reaches the driver is bounded per language: eight classes, at most
    1 / common_share common words, one total.
    """
    folder = new_folder(docs.sparkSession, "quality-rules")
    (
        docs.select("lang", "text")
        .mapInArrow(_histograms, "lang string, kind tinyint, bin bigint, n bigint")
        .groupBy("lang", "kind", "bin")
        .agg(F.sum("n").alias("n"))
        .write.parquet(folder)
    )
    counts = docs.sparkSession.read.parquet(folder)
    found: dict[str | None, dict] = {}
    common = F.lit(False)
    for lang, _, _, total in counts.where("kind = 2").select("lang", "kind", "bin", "n").collect():
        found[lang] = {"classes": np.zeros(len(CLASSES)), "words": {}, "total": total}
        common |= F.col("lang").eqNullSafe(F.lit(lang)) & (F.col("n") >= rules.common_share * total)
    wanted = counts.where((F.col("kind") == 0) | ((F.col("kind") == 1) & common))
    for lang, kind, place, n in wanted.select("lang", "kind", "bin", "n").collect():
        if kind == 0:
            found[lang]["classes"][place] = n
        else:
            found[lang]["words"][place] = n
    return found


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, between each row of p and of q (rows of shares)."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def _shares(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(-1, keepdims=True)
    return np.where(total > 0, counts / np.maximum(total, 1), 0.0)


def distances(texts: Texts, langs: list, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each text to its language: character classes, common words."""
    by_class, by_word = np.zeros(texts.n), np.zeros(texts.n)
    classes = _shares(texts.classes())
    for lang in set(langs):
        one = known[lang]
        rows = np.flatnonzero([x == lang for x in langs])
        by_class[rows] = distance(classes[rows], _shares(one["classes"])[None, :])
        bins = np.array(sorted(one["words"]), dtype=np.int64)
        reference = np.array([one["words"][b] for b in bins], dtype=np.float64)
        reference = _shares(np.append(reference, max(one["total"], 0) - reference.sum()))
        place = np.full(texts.n, -1)
        place[rows] = np.arange(len(rows))
        mine = np.flatnonzero(place[texts.text_of_word] >= 0)
        words = texts.words[mine].view(np.int64)
        at = np.searchsorted(bins, words)
        hit = at < len(bins)
        hit[hit] = bins[at[hit]] == words[hit]
        at = np.where(hit, at, len(bins))
        width = len(bins) + 1
        cells = place[texts.text_of_word[mine]] * width + at
        counted = np.bincount(cells, minlength=len(rows) * width).reshape(len(rows), width)
        by_word[rows] = distance(_shares(counted), reference[None, :])
    return by_class, by_word


_VERDICTS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()), ("kept", pa.bool_()),
        ("class_distance", pa.float64()), ("word_distance", pa.float64()),
    ]
)
_VERDICT_SQL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def _judge(chunk: pa.RecordBatch, rules: Rules, known: dict) -> dict[str, object]:
    texts = Texts(chunk.column("text"))
    n_words, repeated = texts.n_words, texts.repeated_words()
    by_class, by_word = distances(texts, chunk.column("lang").to_pylist(), known)
    base_failed = (n_words < rules.least_words) | (100 * repeated > 100 * rules.most_repeated * n_words)
    chance = 1 / np.sqrt(np.maximum(n_words, 1))
    far = by_class > rules.most_class_distance + rules.class_slack * chance
    far &= n_words >= rules.least_words_for_classes
    odd = by_word > rules.most_word_distance + rules.word_slack * chance
    far |= odd & (n_words >= rules.least_words_for_words)
    return {
        "n_words": n_words, "word_chars": texts.word_chars(), "n_symbols": texts.symbols(),
        "n_dup_lines": texts.repeated_lines(), "n_repeat_words": repeated,
        "base_failed": base_failed, "kept": ~(base_failed | far),
        "class_distance": by_class, "word_distance": by_word,
    }


def verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the plain counts, base_failed, kept and both distances, one row per document.

    `docs` needs doc_id, text and lang; other columns are not read.
    """
    known = docs.sparkSession.sparkContext.broadcast(references(docs, rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            yield arrays.batch_of(
                {"doc_id": chunk.column("doc_id"), **_judge(chunk, rules, known.value)}, _VERDICTS
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text", "lang").mapInArrow(judge, _VERDICT_SQL)


def filtered(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with all their columns and nothing else.

    The verdict is reached beside the row it belongs to, so no join is needed and repeated ids are safe.
    """
    known = docs.sparkSession.sparkContext.broadcast(references(docs, rules))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = [_judge(chunk, rules, known.value)["kept"] for chunk in arrays.chunks([batch])]
            if flags:
                yield batch.filter(pa.array(np.concatenate(flags)))

    return docs.mapInArrow(keep, docs.schema)
