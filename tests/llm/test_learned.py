"""Classifiers: held-out accuracy, independence of other columns, defined cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plantmart.llm import quality_model, toxicity

TABLES = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"


def tables(spark, folder):
    return (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def held_out(frame, labels, mark):
    return frame.join(labels, "doc_id").where("held_out").select("score", "predicted", mark).collect()


def recall(rows, mark, label):
    of = [r for r in rows if r[mark] == label]
    return sum(r.predicted == label for r in of) / len(of)


def test_toxic_texts_are_found(spark):
    docs, labels = tables(spark, LARGER)
    rows = held_out(
        toxicity.scores(docs, labels).drop("toxic"), labels, "toxic"
    )
    assert recall(rows, "toxic", 1) > 0.85 and recall(rows, "toxic", 0) > 0.98


def test_quality_is_told(spark):
    docs, labels = tables(spark, LARGER)
    rows = held_out(quality_model.scores(docs, labels), labels, "quality")
    assert recall(rows, "quality", 0) > 0.9 and recall(rows, "quality", 1) > 0.98


@pytest.mark.parametrize("operator, label", ((toxicity.scores, "toxic"), (quality_model.scores, "quality")))
def test_defined_cases(spark, operator, label):
    docs, labels = tables(spark, TABLES)
    more = spark.createDataFrame(
        [(10**6, None, None, "x"), (10**6, None, None, "x"), (10**6 + 1, "", "en", "x"), (None, "ein text", "de", "x")],
        "doc_id bigint, text string, lang string, source string",
    )
    odd = spark.createDataFrame([(10**7, 1), (5, None), (None, 1)], f"doc_id bigint, {label} int")
    whole = docs.select("doc_id", "text", "lang", "source").unionByName(more)
    marks = labels.select("doc_id", label).unionByName(odd)
    other = whole.withColumns({"lang": F.lit("xx"), "source": F.lit("y"), "score": F.lit(1), "y": F.lit(3)})
    first, second = (
        sorted(operator(d, marks).select("doc_id", "held_out", "score", "predicted").collect(), key=repr)
        for d in (whole, other)
    )
    assert first == second and len(first) == 1004
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in first)
    assert len({r.score for r in first if r.doc_id in (10**6, 10**6 + 1)}) == 1
    folds, fold = (5, 0) if label == "toxic" else (4, 2)
    wanted = {r.doc_id for r in whole.where(F.crc32(F.col("doc_id").cast("string")) % folds == fold).collect()}
    assert {r.doc_id for r in first if r.held_out} == wanted


@pytest.mark.parametrize("operator, label", ((toxicity.scores, "toxic"), (quality_model.scores, "quality")))
def test_held_out_labels_are_not_learnt(spark, operator, label):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    folds, fold = (5, 0) if label == "toxic" else (4, 2)
    out = F.crc32(F.col("doc_id").cast("string")) % folds == fold
    turned = labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label)))
    first, second = (sorted(operator(docs, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert first == second


@pytest.mark.parametrize("operator, label", ((toxicity.scores, "toxic"), (quality_model.scores, "quality")))
def test_without_labels_or_documents(spark, operator, label):
    docs, labels = tables(spark, "/root/testdata/sf0.001")
    assert operator(docs.where("false"), labels).count() == 0
    unlabelled = operator(docs, labels.where("false")).select("score").distinct().collect()
    assert len(unlabelled) == 1
    one_kind = operator(docs, labels.withColumn(label, F.lit(1))).select("score").distinct().collect()
    assert all(r.score > 0.99 for r in one_kind)


def test_thresholds_come_from_scores_of_texts_left_out_of_fitting(monkeypatch):
    """Labels by chance can only be known to a network that has learnt these very texts."""
    chance = random.Random(3)
    words = ["".join(chance.choices("abcdefghij", k=9)) for _ in range(800)]
    texts = [" ".join(chance.choices(words, k=20)) for _ in range(400)]
    labels = [chance.randrange(2) for _ in texts]
    texts, labels = texts + texts[:40], labels + labels[:40]
    rows = pa.table({"doc_id": range(len(texts)), "lang": ["de"] * len(texts), "text": texts, "y": labels})
    seen = {}
    monkeypatch.setattr(toxicity, "_best_threshold", lambda scores, y: seen.update(scores=scores, y=y) or 0.25)
    settings = toxicity.Settings()
    tables, thresholds = toxicity.fit(rows, settings)
    assert thresholds == {"de": 0.25}

    def better(scores):
        """How often a row with label 1 has a higher score than one with label 0."""
        ones, others = scores[seen["y"] == 1], scores[seen["y"] == 0]
        return (ones[:, None] > others[None, :]).mean()

    whole = np.concatenate(
        [tables.score(*toxicity.hashed(c.column("text"))) for c in toxicity.arrays.chunks(iter(rows.to_batches()))]
    )
    assert better(whole) > 0.8 and better(seen["scores"]) < 0.65
    assert np.array_equal(seen["scores"][:40], seen["scores"][400:])
