"""Quality score: kernel ridge regression over document statistics, by random Fourier features.

A Gaussian kernel over standardised statistics is approximated by cosines of fixed random projections.
Ridge weights come from normal equations that each partition sums over its labelled rows, so every
labelled row counts and only a matrix of fixed size is gathered. Scores are then calibrated by isotonic
regression over a histogram of fixed size.

Defined cases: a NULL text is empty; NULL labels and labels without a document are ignored; without any
label every score is 0.5; each row is scored alone, so repeated rows get equal scores; rows without a
doc_id are scored and never used for learning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmart.llm import arrays
from plantmart.llm.texts import Texts
from plantmart.session import new_folder

N_STATISTICS = 18
BINS = 2000
LEAST_SCORE, MOST_SCORE = -0.5, 1.5


@dataclass(frozen=True)
class Kernel:
    """Number of cosines, kernel width per statistic, ridge penalty per row, seed of the projections."""

    cosines: int = 256
    width: float = 0.7
    penalty: float = 1e-4
    seed: int = 17

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(self.seed)
        scale = self.width * np.sqrt(N_STATISTICS)
        directions = random.standard_normal((N_STATISTICS, self.cosines)) / scale
        return directions, random.uniform(0, 2 * np.pi, self.cosines)


def statistics(texts: Texts) -> np.ndarray:
    """One row of plain statistics for each text; zeros for an empty one."""
    n_bytes = np.diff(texts.offsets)
    words = np.maximum(texts.n_words, 1)
    lengths = texts.ends - texts.starts
    lines = texts.lines()[2]
    n_lines = np.maximum(np.bincount(lines, minlength=texts.n), 1)
    per_word = lambda flags: texts.per_text(flags) / words
    short = np.bincount(texts.text_of_word[lengths <= 3], minlength=texts.n)
    columns = [
        np.log1p(n_bytes), np.log1p(texts.n_words),
        *(texts.classes() / np.maximum(n_bytes, 1)[:, None]).T,
        texts.word_chars() / words, short / words, texts.distinct_words() / words,
        texts.repeated_lines() / n_lines, texts.repeated_words() / words, n_lines / words,
        per_word(texts.data == ord("!")), per_word(texts.data == ord("|")),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


_ROWS = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in arrays.chunks(batches):
        x = statistics(Texts(chunk.column("text")))
        offsets = np.arange(0, x.size + 1, N_STATISTICS, dtype=np.int32)
        yield arrays.batch_of(
            {"doc_id": chunk.column("doc_id"), "x": pa.ListArray.from_arrays(offsets, x.ravel())}, _ROWS
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


@dataclass
class Model:
    kernel: Kernel
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None = None
    levels: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        directions, phases = self.kernel.projection()
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        cosines = np.sqrt(2 / self.kernel.cosines) * np.cos(z @ directions + phases)
        return np.concatenate((cosines, np.ones((len(x), 1))), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, LEAST_SCORE, MOST_SCORE)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.levels is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), *self.levels), 0.0, 1.0)


def isotonic(places: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and levels of the best non-decreasing step function (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for place, count, total in zip(places, counts, sums):
        blocks.append([place * count, count, total])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    found = np.array(blocks)
    return found[:, 0] / found[:, 1], found[:, 2] / found[:, 1]


def _moments(labelled: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    x = [F.col("x")[i] for i in range(N_STATISTICS)]
    row = labelled.agg(F.count("*"), *map(F.avg, x), *map(F.stddev_pop, x)).first()
    n, rest = row[0], np.array([v or 0.0 for v in row[1:]])
    mean, spread = rest[:N_STATISTICS], rest[N_STATISTICS:]
    return n, mean, np.where(spread > 1e-9, spread, 1.0)


def _normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all labelled rows: a row of the matrix per record, added up by Spark."""
    size = model.kernel.cosines + 1
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = shared.value.features(_matrix(batch.column("x")))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += z.T @ np.concatenate((z, y[:, None]), axis=1)
        offsets = np.arange(0, total.size + 1, size + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.ListArray.from_arrays(offsets, total.ravel())], ["i", "row"]
        )

    def added(key: tuple, parts: pa.Table) -> pa.Table:
        rows = parts.column("row").combine_chunks().flatten().to_numpy().reshape(-1, size + 1)
        return pa.table({"i": pa.array([key[0].as_py()]), "row": pa.array([rows.sum(0).tolist()])})

    schema = "i bigint, row array<double>"
    rows = labelled.select("x", "y").mapInArrow(sums, schema).groupBy("i").applyInArrow(added, schema).collect()
    whole = np.zeros((size, size + 1))
    for i, row in rows:
        whole[i] = row
    return whole[:, :-1], whole[:, -1]


def fit(labelled: DataFrame, kernel: Kernel = Kernel()) -> Model:
    """A model from all rows of (x, y); y is 0 or 1."""
    n, mean, spread = _moments(labelled)
    model = Model(kernel, mean, spread)
    if not n:
        return model
    gram, right = _normal_equations(labelled, model)
    model.weights = np.linalg.solve(gram + kernel.penalty * n * np.eye(len(gram)), right)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = shared.value.raw(_matrix(batch.column("x")))
            place = (raw - LEAST_SCORE) / (MOST_SCORE - LEAST_SCORE) * (BINS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.rint(place).astype(np.int64)), batch.column("y")], ["bin", "y"]
            )

    counted = (
        labelled.select("x", "y").mapInArrow(binned, "bin bigint, y double")
        .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("y"))
        .collect()
    )
    bins, counts, sums = (np.array(c, dtype=np.float64) for c in zip(*sorted(counted)))
    places = LEAST_SCORE + bins / (BINS - 1) * (MOST_SCORE - LEAST_SCORE)
    model.levels = isotonic(places, counts, sums)
    return model


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, fold: int = 2,
    threshold: float = 0.7, kernel: Kernel = Kernel(),
) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    `docs` needs doc_id and text, `labels` doc_id and the label column. Labels of the held-out fold are
    not used. The statistics are written once to the shared folder (some 150 bytes a document), so the
    texts are read once and never shuffled.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "quality-statistics")
    docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _rows_of, "doc_id bigint, x array<double>"
    ).write.parquet(folder)
    known = spark.read.parquet(folder)
    out = held_out(F.col("doc_id"), folds, fold)
    marks = labels.select(F.col("doc_id").cast("bigint"), F.col(label).cast("double").alias("y")).dropna()
    labelled = known.join(marks.where(~out), "doc_id")
    model = spark.sparkContext.broadcast(fit(labelled, kernel))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.score(_matrix(batch.column("x")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    found = known.mapInArrow(scored, "doc_id bigint, score double")
    return found.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
