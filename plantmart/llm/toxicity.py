"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A text is a row of words; a word's embedding is the sum of the embeddings of its hashed features, the
whole word and its beginnings of four to six bytes, so that inflected forms share what is learnt. Filters
of several widths slide over the word embeddings, each keeps its largest value over the whole text, and
a logistic layer turns these into a score. The model is fitted on a bounded sample of labelled rows;
scoring uses the filters as lookup tables (one value per hashed feature, filter and offset), so a text
costs a few additions per word however long it is.

Score and prediction depend on the text alone. Besides, each language gets a threshold of its own,
which decides the column `toxic`. It is calibrated on scores by networks that have not seen the scored text: the labelled
texts are split in parts, and each part is scored by a network fitted on the others.

Defined cases: a NULL text is empty, and an empty text has the score of a text without any word; NULL
labels and labels without a document are ignored; without both labels every score is the share of
toxic labels (0 without labels); repeated rows get equal scores; rows without doc_id are only scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.quality_model import held_out

BUCKET_BITS = 17
PAD = 1 << BUCKET_BITS
BEGINNINGS = (4, 5, 6)
FEATURES = 1 + len(BEGINNINGS)

# Words are runs of letters, digits and bytes beyond ASCII; capital letters count as small ones.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[0x80:] = True


@dataclass(frozen=True)
class Settings:
    """Shape and training of the network. `sample` bounds the labelled rows that are used."""

    dimensions: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    sample: int = 6000
    # Features in fewer sampled texts than this are not learnt and count as absent.
    least_texts: int = 3
    # Share of words hidden at each look at a text, so that a score rests on every telling word.
    hidden: float = 0.5
    epochs: int = 10
    batch: int = 32
    step: float = 0.05
    decay: float = 1e-4
    seed: int = 11
    # A language needs so many labelled rows in the sample for a threshold of its own.
    least_rows: int = 200
    # Parts of the sample that are left out of fitting in turn, to be scored for the thresholds.
    parts: int = 2


def hashed(texts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the distinct words, which of them each word is, and how many words lie before each text.

    The last of the distinct words is none at all; filters meet it beyond the end of a text.
    """
    data, offsets = arrays.text_bytes(texts)
    folded = _FOLDED[data]
    starts, ends = arrays.spans(_IN_WORD[folded], offsets[:-1])
    before = np.searchsorted(starts, offsets)
    prefix = arrays.prefix_hash(folded.astype(np.uint64) + np.uint64(1))
    whole = arrays.range_hash(prefix, starts, ends)
    distinct, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    features = np.full((len(distinct) + 1, FEATURES), PAD, dtype=np.int32)
    shift = np.uint64(64 - BUCKET_BITS)
    features[:-1, 0] = distinct >> shift
    for k, size in enumerate(BEGINNINGS, start=1):
        longer = ends - starts > size
        head = arrays.range_hash(prefix, starts[longer], starts[longer] + size)
        features[:-1, k][longer] = head >> shift
    return features, inverse.astype(np.int32), before


@dataclass
class Network:
    settings: Settings
    embedding: np.ndarray = field(init=False)
    filters: list[np.ndarray] = field(init=False)
    biases: list[np.ndarray] = field(init=False)
    weights: np.ndarray = field(init=False)
    offset: float = 0.0

    def __post_init__(self) -> None:
        s, random = self.settings, np.random.default_rng(self.settings.seed)
        self.embedding = random.normal(0, 0.1, (PAD + 1, s.dimensions))
        self.embedding[PAD] = 0
        self.filters = [random.normal(0, 0.3, (w, s.dimensions, s.filters)) for w in s.widths]
        self.biases = [np.zeros(s.filters) for _ in s.widths]
        self.weights = random.normal(0, 0.1, len(s.widths) * s.filters)

    def _pooled(self, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest value of each filter over a text (rows of features), and where each was found."""
        embedded = self.embedding[words].sum(1)
        values, places = [], []
        for width, kernel, bias in zip(self.settings.widths, self.filters, self.biases):
            x = np.concatenate((embedded, np.zeros((width, embedded.shape[1]))))
            count = len(x) - width + 1
            out = sum(x[o : o + count] @ kernel[o] for o in range(width)) + bias
            at = out.argmax(0)
            places.append(at)
            values.append(out[at, np.arange(out.shape[1])])
        return np.concatenate(values), places

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """Adagrad on the logistic loss; the gradient reaches only the words each filter has chosen.

        A text is given as the features of distinct words, and which of these each of its words is.
        """
        s, random = self.settings, np.random.default_rng(self.settings.seed + 1)
        share = labels.mean()
        self.offset = float(np.log(share / (1 - share)))
        seen_e = np.full(self.embedding.shape, 1e-8)
        seen_f = [np.full(f.shape, 1e-8) for f in self.filters]
        seen_b = [np.full(b.shape, 1e-8) for b in self.biases]
        seen_w, seen_o = np.full(self.weights.shape, 1e-8), 1e-8
        for _ in range(s.epochs):
            order = random.permutation(len(texts))
            for start in range(0, len(order), s.batch):
                rows = order[start : start + s.batch]
                touched, parts = [], []
                grad_f = [s.decay * f for f in self.filters]
                grad_b = [np.zeros_like(b) for b in self.biases]
                grad_w, grad_o = s.decay * self.weights, 0.0
                for row in rows:
                    features, places_of = texts[row]
                    words = features[places_of]
                    words[random.random(len(words)) < s.hidden] = PAD
                    pooled, places = self._pooled(words)
                    active = np.maximum(pooled, 0)
                    error = (1 / (1 + np.exp(-(active @ self.weights + self.offset))) - labels[row]) / len(rows)
                    grad_w += error * active
                    grad_o += error
                    back = error * self.weights * (pooled > 0)
                    for k, (width, at) in enumerate(zip(s.widths, places)):
                        g = back[k * s.filters : (k + 1) * s.filters]
                        grad_b[k] += g
                        for o in range(width):
                            chosen = words[np.minimum(at + o, len(words) - 1)]
                            grad_f[k][o] += self.embedding[chosen].sum(1).T * g
                            touched.append(chosen.ravel())
                            parts.append(np.repeat(self.filters[k][o].T * g[:, None], FEATURES, axis=0))
                ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
                grad_e = np.zeros((len(ids), s.dimensions))
                np.add.at(grad_e, inverse, np.concatenate(parts))
                grad_e[ids == PAD] = 0
                seen_e[ids] += grad_e**2
                self.embedding[ids] -= s.step * grad_e / np.sqrt(seen_e[ids])
                for k in range(len(s.widths)):
                    seen_f[k] += grad_f[k] ** 2
                    self.filters[k] -= s.step * grad_f[k] / np.sqrt(seen_f[k])
                    seen_b[k] += grad_b[k] ** 2
                    self.biases[k] -= s.step * grad_b[k] / np.sqrt(seen_b[k])
                seen_w += grad_w**2
                self.weights -= s.step * grad_w / np.sqrt(seen_w)
                seen_o += grad_o**2
                self.offset -= s.step * grad_o / np.sqrt(seen_o)

    def tables(self) -> Tables:
        return Tables(
            [
                [(self.embedding @ kernel[o]).astype(np.float32) for o in range(len(kernel))]
                for kernel in self.filters
            ],
            [b.astype(np.float32) for b in self.biases],
            self.weights,
            self.offset,
        )


@dataclass
class Tables:
    """A trained network as lookup tables: per width and offset, hashed word by filter."""

    tables: list[list[np.ndarray]]
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: float

    def score(self, features: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        widest = max(map(len, self.tables), default=0)
        # Each text is followed by as many absent words as the widest filter has, so none crosses a text.
        padded = np.full(len(words) + n * widest, len(features) - 1, dtype=np.int32)
        text = np.repeat(np.arange(n), np.diff(first))
        padded[np.arange(len(words)) + text * widest] = words
        starts = first[:-1] + np.arange(n) * widest
        ends = first[1:] + np.arange(n) * widest
        pooled = []
        for per_offset, bias in zip(self.tables, self.biases):
            count = len(padded) - len(per_offset) + 1
            out = sum(
                table[features].sum(1)[padded[o : o + count]] for o, table in enumerate(per_offset)
            )
            # A text's windows start at its words and at the absent word right after them.
            cuts = np.stack((starts, ends + 1), axis=1).ravel()
            cuts = cuts[:-1] if cuts[-1] >= count else cuts
            pooled.append(np.maximum.reduceat(out, cuts, axis=0)[::2] + bias)
        if not pooled:
            return np.full(n, 1 / (1 + np.exp(-self.offset)))
        logit = np.maximum(np.concatenate(pooled, axis=1), 0) @ self.weights + self.offset
        return 1 / (1 + np.exp(-logit))


def constant(share: float) -> Tables:
    return Tables([], [], np.zeros(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))


def _sampled(docs: DataFrame, marks: DataFrame, size: int) -> pa.Table:
    """Language, text and label of at most `size` labelled documents, chosen by a hash of the id."""
    chosen = F.broadcast(marks.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(size))
    found = docs.join(chosen, "doc_id").select("doc_id", "lang", "text", "y").toArrow()
    return found.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("text", "ascending")]).slice(0, size)


def _best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold with the best F1, halfway between neighbouring scores."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    last = np.append(np.diff(scores[order]) != 0, True)
    at = int(np.argmax(np.where(last, f1, -1)))
    below = scores[order][at + 1] if at + 1 < len(order) else 0.0
    return float((scores[order][at] + below) / 2)


def _trained(chunks: list[tuple], labels: np.ndarray, chosen: np.ndarray, settings: Settings) -> Tables:
    """The network fitted on the chosen rows; chunks are what :func:`hashed` gives, one after the other."""
    # The words of each text, as numbers of its chunk's distinct words.
    words_of = [(k, words[a:b]) for k, (_, words, first) in enumerate(chunks) for a, b in zip(first[:-1], first[1:])]
    words_of = [entry for entry, wanted in zip(words_of, chosen) if wanted]
    known = np.zeros(PAD + 1, dtype=np.int64)
    for k, words in words_of:
        known[np.unique(chunks[k][0][np.unique(words)])] += 1
    rare = known < settings.least_texts
    features = [np.where(rare[found], PAD, found) for found, _, _ in chunks]
    # A text is followed by absent words for the filters.
    none = [np.full(max(settings.widths), len(found) - 1, dtype=words.dtype) for found, words, _ in chunks]
    network = Network(settings)
    network.embedding[rare] = 0
    network.train([(features[k], np.concatenate((words, none[k]))) for k, words in words_of], labels[chosen])
    return network.tables()


def _left_out_scores(chunks: list[tuple], labels: np.ndarray, part: np.ndarray, settings: Settings) -> np.ndarray | None:
    """Each row's score by a network fitted on the other parts; None if these lack a label."""
    found = np.empty(len(labels))
    for left_out in (part == k for k in range(settings.parts)):
        if labels[~left_out].min(initial=1) == labels[~left_out].max(initial=0) or left_out.all():
            return None
        tables = _trained(chunks, labels, ~left_out, settings)
        found[left_out] = np.concatenate([tables.score(*chunk) for chunk in chunks])[left_out]
    return found


def fit(rows: pa.Table, settings: Settings) -> tuple[Tables, dict[str | None, float]]:
    """The network, fitted on all rows, and a threshold for each language with enough of them."""
    labels = rows.column("y").to_numpy().astype(np.float64)
    if not len(labels) or labels.min() == labels.max():
        return constant(labels[0] if len(labels) else 0.0), {}
    chunks, part = [], []
    for chunk in arrays.chunks(iter(rows.to_batches())):
        chunks.append(hashed(chunk.column("text")))
        # By text, so that copies of one are left out together.
        part += [zlib.crc32(text) % settings.parts for text in chunk.column("text").to_pylist()]
    tables = _trained(chunks, labels, np.ones(len(labels), dtype=bool), settings)
    langs = np.array([x if x is not None else "" for x in rows.column("lang").to_pylist()], dtype=object)
    enough = [x for x in sorted(set(langs)) if (langs == x).sum() >= settings.least_rows and labels[langs == x].any()]
    scores = _left_out_scores(chunks, labels, np.array(part), settings) if enough else None
    if scores is None:
        return tables, {}
    return tables, {x or None: _best_threshold(scores[langs == x], labels[langs == x]) for x in enough}


def scores(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.5,
    settings: Settings = Settings(),
) -> DataFrame:
    """doc_id, held_out, score, predicted, and toxic by the language's threshold, for every document.

    `docs` needs doc_id, text and lang, `labels` doc_id and toxic. Labels of the held-out fold are not
    used. Texts are not shuffled: the sample of ids is small enough to be sent to each scan.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.col("lang").cast("string"))
    out = held_out(F.col("doc_id"), folds, fold)
    marks = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int").alias("y"))
    tables, thresholds = fit(_sampled(docs, marks.dropna().where(~out), settings.sample), settings)
    shared = spark.sparkContext.broadcast(tables)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in arrays.chunks(batches):
            score = shared.value.score(*hashed(chunk.column("text")))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("lang"), pa.array(score)], ["doc_id", "lang", "score"]
            )

    found = docs.mapInArrow(scored, "doc_id bigint, lang string, score double")
    own = F.lit(threshold)
    for lang, value in thresholds.items():
        own = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(value)).otherwise(own)
    return found.select(
        "doc_id", out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        (F.col("score") >= own).alias("toxic"),
    )
