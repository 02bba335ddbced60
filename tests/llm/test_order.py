"""Mixing, nearest neighbours, components, and the queries that SQL can express."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from plantmart.llm import arrays, mixing, nearest, queries
from plantmart.llm.components import components
from plantmart.llm.storing import stored

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("weights", ({"a": 1}, {"a": 5, "b": 3, "c": 2}, {f"s{k}": k**2 + 0.3 for k in range(23)}))
def test_schedule_keeps_to_the_weights(weights):
    shares = mixing.whole_shares(weights)
    assert sum(shares.values()) == mixing.PERIOD
    had = dict.fromkeys(shares, 0)
    for t, (source, block, slot) in enumerate(mixing.schedule(shares), start=1):
        assert (block, slot) == (had[source], t - 1)
        had[source] += 1
        assert all(abs(had[s] - t * shares[s] / mixing.PERIOD) < 1 for s in shares)
    assert had == shares


@pytest.mark.parametrize("places", (arrays.PLACES, 64))
def test_window_minima(places, monkeypatch):
    monkeypatch.setattr(arrays, "PLACES", places)
    for n, width in ((0, 5), (4, 5), (5, 5), (63, 7), (64, 7), (65, 7), (500, 16), (300, 1)):
        values = np.random.default_rng(n).integers(0, 40, n).astype(np.uint64) << np.uint64(50)
        expected = [
            max(range(k, k + width), key=lambda i: (-int(values[i]), i)) for k in range(n - width + 1)
        ]
        assert arrays.window_minimum(values, width).tolist() == expected


def test_weights_are_checked():
    for weights in ({"a": 0, "b": 1}, {str(k): 1 for k in range(1001)}):
        with pytest.raises(ValueError):
            mixing.whole_shares(weights)
    assert mixing.whole_shares({}) == {}


def mixture(spark):
    pick = random.Random(2)
    rows = [(k, f"text {k}", pick.choice(["hot", "hot", "hot", "b", None])) for k in range(900)]
    rows += [(None, "no id", "b"), (3, "again", "hot"), (3, "again", "hot")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)


def test_every_row_has_a_place(spark):
    docs = mixture(spark).withColumns({"slot": F.lit(1), "part": F.lit(2), "of": F.lit(3)})
    weights = {"hot": 0.2, "b": 0.5, None: 0.3}
    found = mixing.places(docs, weights, block=4).collect()
    assert len(found) == docs.count()
    by_source = {}
    for r in found:
        by_source.setdefault(r.source, []).append((r.block, r.place, r.doc_id if r.doc_id is not None else -1, r.slot))
    shares = mixing.whole_shares(weights)
    for source, rows in by_source.items():
        rows.sort()
        assert [(b, p) for b, p, _, _ in rows] == [divmod(k, 4) for k in range(len(rows))]
        assert [d for _, _, d, _ in rows] == sorted(d for _, _, d, _ in rows)
        slots = sorted({s for *_, s in rows})
        for block, slot in enumerate(slots):
            assert abs(block + 1 - (slot + 1) * shares[source] / mixing.PERIOD) < 1
    slots = {(r.slot, r.source) for r in found}
    assert len({s for s, _ in slots}) == len(slots)


def test_mixed_documents_come_in_order(spark):
    docs = mixture(spark)
    weights = mixing.tempered(docs)
    found = mixing.mixed(docs, weights, block=4)
    assert found.columns == docs.columns
    rows = [tuple(r) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    slot = {(r.doc_id, r.source): (r.slot, r.place) for r in mixing.places(docs, weights, block=4).collect() if r.doc_id != 3}
    order = [slot[(d, s)] for d, _, s in rows if d != 3]
    assert order == sorted(order)
    assert mixing.mixed(docs.where("false"), {}, block=4).count() == 0


def test_a_source_without_weight_fails(spark):
    with pytest.raises(Exception, match="no weight"):
        mixing.places(mixture(spark), {"hot": 1.0}).collect()


def neighbours(vectors, k=10, of=lambda i: i % 100 == 0):
    found = {}
    for i in filter(of, vectors):
        others = [j for j in vectors if j != i and len(vectors[j]) == len(vectors[i])]
        scored = sorted((float(np.sqrt(((vectors[j] - vectors[i]) ** 2).sum())), j) for j in others)
        found[i] = scored[:k]
    return found


def test_nearest_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table.collect()}
    exact = neighbours(vectors)
    found = {}
    for r in nearest.search(table, F.col("vec_id") % 100 == 0, pass_bytes=8000).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        assert abs(r.score - np.linalg.norm(vectors[r.query_id] - vectors[r.vec_id])) < 1e-9
    assert all([n for n, _, _ in sorted(rows)] == list(range(1, 11)) for rows in found.values())
    hits = sum(len({v for _, v, _ in found[q]} & {j for _, j in exact[q]}) for q in exact)
    assert set(found) == set(exact) and hits >= 0.98 * 10 * len(exact)


def test_nearest_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [2.0, 0.0]),
        (7, [1.0, 1.0]), (8, [1.0, -1.0]), (9, [3.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (None, [1.0, 0.0]),
        (200, [5.0]), (300, [1.0, 2.0, 3.0]), (400, []),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(9))
    found = {}
    for r in nearest.search(table, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(x) for q, x in found.items()} == {
        0: [(1, 100, 0.0), (2, 6, 1.0), (3, 7, 1.0), (4, 8, 1.0)],
        100: [(1, 0, 0.0), (2, 6, 1.0), (3, 7, 1.0), (4, 8, 1.0)],
        200: [(1, 9, 2.0)],
    }
    assert nearest.search(table.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_codes_stay_where_they_are(spark):
    """However many passes there are, no scan shuffles a vector, and the first reads only codes and scalars."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    codes = stored(nearest.encoded(table, 256, 5), "codes-test")
    queries = nearest.as_queries(codes.where("vec_id % 100 = 0").select("vec_id", "vector", "dimension").toArrow(), 256, 5)
    assert codes.where("length(code) <> 32").count() == 0
    for found in (nearest.limits(codes, lambda: queries, 10, 3.0), nearest.reranked(codes, lambda: queries, 10, 3.0)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("MapInArrow"):]
        assert "Exchange" not in scan and "Join" not in scan
        assert ("vector" in scan[scan.index("ReadSchema"):]) == (found.columns != ["query_id", "limit"])


def test_bounds_hold_for_most_pairs(spark):
    rng = np.random.default_rng(3)
    x, q = (v / np.linalg.norm(v, axis=1)[:, None] for v in (rng.standard_normal((3000, 64)), rng.standard_normal((20, 64))))
    widths = []
    for bits in (64, 256):
        rotation = nearest._rotation(64, bits, 5)
        codes, own = nearest.encode(x, rotation)
        products, error = nearest.estimates(codes, own, (q @ rotation.T).astype(np.float32), 3.0)
        assert (np.abs(products - q @ x.T) <= error).mean() > 0.99
        widths.append(error.mean())
    assert widths[1] < 0.6 * widths[0]


def test_many_equal_vectors(spark):
    table = spark.range(1000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    found = nearest.search(table, F.col("vec_id") % 500 == 0, pass_bytes=1500).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(0, k) for k in range(1, 11)} | {(500, k) for k in range(10)}


def test_components(spark):
    pick = random.Random(4)
    links = [(k, k + 1) for k in range(0, 90)] + [(pick.randint(100, 160), pick.randint(100, 160)) for _ in range(40)]
    links += [(200, k) for k in range(201, 260)] + [(300, 300)]
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert {r.u: r.v for r in found.collect()} == {a: b for a, b in label.items() if a != b}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    oracle = duckdb.connect()
    for table in os.listdir(SMALL):
        oracle.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{table}'")
    expected = oracle.execute(queries.ORACLES[name])
    columns = [c[0] for c in expected.description]
    wanted = sorted(expected.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SMALL).collect()), key=repr) == wanted


def test_all_ten_are_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
