"""Slots against the given weights over many periods, many sources, and the mix in the pipeline's result."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plantmart.llm import mixing
from plantmart.llm.storing import stored

SMALL = "/root/testdata/sf0.001"


def slots(spark, weights, n_slots):
    """(source, slots in order) of all blocks that are due before n_slots."""
    total = sum(weights.values())
    steps = mixing.paths(mixing.as_table(spark, weights))
    sizes = spark.createDataFrame([(s, math.ceil(n_slots * w / total) + 2) for s, w in weights.items()], "s string, n bigint")
    blocks = steps.join(sizes, F.col("of").eqNullSafe(F.col("s"))).withColumn("block", F.explode(F.expr("sequence(0L, n - 1)")))
    found = blocks.groupBy("of").agg(F.sort_array(F.collect_list(F.expr(mixing.SLOT))).alias("slots"))
    return {r.of: r.slots for r in found.collect()}


MANY = {f"s{k}": 1.0 for k in range(499)} | {"big": 9 * 499.0}


@pytest.mark.parametrize(
    "weights",
    (
        {"a": 0.7, "b": 0.1, "c": 0.1, None: 0.1}, {"x": 1e6**0.5, **{f"s{k}": (2e6 / 19) ** 0.5 for k in range(19)}}, MANY,
        {f"s{k}": 1.0 + k % 7 for k in range(1500)}, {"a": 1.0}, {f"s{k}": 2.0**-k for k in range(30)},
    ),
)
def test_deviation_does_not_grow(spark, weights):
    n_slots, total = 50_000, sum(weights.values())
    found = slots(spark, weights, n_slots)
    assert set(found) == set(weights)
    taken = sorted(s for of in found.values() for s in of if s < n_slots)
    assert taken == list(range(n_slots))
    for source, of in found.items():
        for had, slot in enumerate(of):
            # Before the slot and after it: `had` and one more of slot and slot + 1 slots.
            w = weights[source] / total
            assert abs(had - slot * w) < 2 and abs(had + 1 - (slot + 1) * w) < 2


def test_more_sources_than_a_period_has_slots(spark):
    rows = [(k, f"text {k}", f"domain{k % 1300}") for k in range(2600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.places(docs, mixing.tempered(docs), block=1).collect()
    assert sorted(r.doc_id for r in found) == list(range(2600))
    assert sorted(r.slot for r in found) == list(range(2600))


def test_a_weight_that_is_not_positive_fails(spark):
    docs = spark.createDataFrame([(1, "t", "a")], "doc_id bigint, text string, source string")
    with pytest.raises(Exception, match="positive"):
        mixing.places(docs, {"a": 0.0}).collect()


def test_the_pipeline_gives_its_rows_in_the_order_of_the_mix(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, SMALL)
    docs = stored(docs, "mixing-test")
    rows = sorted((r.source, r.doc_id) for r in docs.select("source", "doc_id").collect())
    by_source = {}
    for source, doc in rows:
        by_source.setdefault(source, []).append(doc)
    weights = {s: len(ids) ** 0.5 for s, ids in by_source.items()}
    order = slots(spark, weights, 2000)
    expected = sorted((order[s][k // 16], k % 16, doc) for s, ids in by_source.items() for k, doc in enumerate(ids))
    assert [r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()] == [doc for *_, doc in expected]
    stage = corpus_pipeline.mix_sources(spark, docs, SMALL)
    last = corpus_pipeline.encode_tokens(spark, stage, SMALL)
    assert sorted((r.slot, r.place, r.doc_id) for r in last.collect()) == expected
