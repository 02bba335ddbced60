"""Nearest neighbours by randomly rotated one-bit codes, reranked on the original vectors.

Every vector is turned into a space of `bits` dimensions by a fixed random rotation; the signs of its
components there, packed into bits, are its code, and its length and its agreement with its own code are its
correction scalars. From these the inner product with a query is estimated without bias, with an error
that falls with the number of bits. A vector is reranked if the lower bound of its distance is not above
the k-th smallest upper bound of all vectors.

Codes, scalars and vectors are stored once, side by side, and never move again. Queries come to them in passes
of a bounded number of bytes, each sent to all tasks: one scan reads codes and scalars alone and finds
each query's limit, a second one reads the vectors too and reranks. Only the k best of each query and task are shuffled.

Defined cases: vectors that are NULL or zero, or hold NULL, NaN or infinite components, take no part, nor
do rows without an id; vectors are only compared with vectors of their own dimension; of rows that
share an id the smallest vector counts; equal distances are ranked by id; with fewer candidates than k, all
are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmart.llm.storing import Steps
from plantmart.session import new_folder

# Queries and vectors meet in tiles of this size within a task.
QUERY_TILE, VECTOR_TILE = 256, 2048

Queries = dict[int, dict[str, np.ndarray]]


@lru_cache(maxsize=4)
def _rotation(dimension: int, bits: int, seed: int) -> np.ndarray:
    """The first `dimension` columns of a random rotation of `bits` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimension, bits]).standard_normal((bits, dimension)))
    return q * np.sign(np.diag(r))


def code_length(dimension: int, bits: int) -> int:
    """Bits of a code: a whole number of bytes, not fewer than the vector has components."""
    return -(-max(dimension, bits) // 8) * 8


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array of double) and dimension: one row per id, without unusable vectors."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("bigint"), vector.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad)
        .where(F.exists("vector", lambda x: x != 0))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"))
        .withColumn("dimension", F.size("vector"))
    )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def lengths(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(1)
    return scale * np.linalg.norm(vectors / scale[:, None], axis=1)


def encode(unit: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the inner product of each with its own code."""
    turned = unit @ rotation.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(turned.shape[1])


def estimates(codes: np.ndarray, own: np.ndarray, turned: np.ndarray, bound: float):
    """Estimated inner products of unit vectors with rotated unit queries (a row each), and error bounds."""
    bits = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    products = (turned @ signs.T).astype(np.float64) / np.sqrt(bits)
    error = bound * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(bits - 1)
    return products / own, error


def _by_dimension(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dimensions = batch.column("dimension").to_numpy()
        for dimension in np.unique(dimensions):
            yield int(dimension), batch.filter(pa.array(dimensions == dimension))


def _encoder(bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dimension, batch in _by_dimension(batches):
            vectors = _matrix(batch.column("vector"), dimension)
            length = lengths(vectors)
            codes, own = encode(vectors / length[:, None], _rotation(dimension, code_length(dimension, bits), seed))
            packed = pa.array([code.tobytes() for code in codes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, packed, pa.array(length), pa.array(own)], [*batch.schema.names, "code", "length", "own"]
            )

    return run


def encoded(vectors: DataFrame, bits: int, seed: int) -> DataFrame:
    """vec_id, vector, dimension, code, length and own of every usable vector."""
    schema = "vec_id bigint, vector array<double>, dimension int, code binary, length double, own double"
    return usable(vectors).select("vec_id", "vector", "dimension").mapInArrow(_encoder(bits, seed), schema)


def as_queries(rows: pa.Table, bits: int, seed: int) -> Queries:
    """Ids, vectors, lengths and rotated unit vectors of the queries of a pass, by dimension."""
    found: Queries = {}
    for dimension, batch in _by_dimension(rows.to_batches()):
        vectors = _matrix(batch.column("vector"), dimension)
        length = lengths(vectors)
        turned = (vectors / length[:, None]) @ _rotation(dimension, code_length(dimension, bits), seed).T
        part = {"id": batch.column("vec_id").to_numpy(), "vector": vectors, "length": length, "turned": turned.astype(np.float32)}
        old = found.get(dimension)
        found[dimension] = {name: np.concatenate([old[name], x]) if old else x for name, x in part.items()}
    return found


def _tiles(batches: Iterator[pa.RecordBatch], queries: Queries, bound: float):
    """Tiles of queries and vectors of one dimension, with bounds of their squared distances."""
    for dimension, batch in _by_dimension(batches):
        if dimension not in queries:
            continue
        q = queries[dimension]
        for at in range(0, batch.num_rows, VECTOR_TILE):
            tile = batch.slice(at, VECTOR_TILE)
            ids, length, own = (tile.column(c).to_numpy() for c in ("vec_id", "length", "own"))
            codes = np.frombuffer(b"".join(tile.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
            for start in range(0, len(q["id"]), QUERY_TILE):
                chosen = slice(start, start + QUERY_TILE)
                products, error = estimates(codes, own, q["turned"][chosen], bound)
                base = length**2 + q["length"][chosen, None] ** 2
                reach = 2 * length * q["length"][chosen, None]
                low = base - reach * np.minimum(products + error, 1)
                high = base - reach * np.maximum(products - error, -1)
                yield dimension, chosen, tile, low, high, q["id"][chosen, None] == ids


def _limit_finder(queries: Callable[[], Queries], k: int, bound: float):
    """For each query the k smallest upper bounds within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = queries()
        best = {d: np.full((len(q["id"]), k), np.inf) for d, q in known.items()}
        for dimension, chosen, _, _, high, itself in _tiles(batches, known, bound):
            high[itself | np.isnan(high)] = np.inf
            pool = np.concatenate([best[dimension][chosen], high], axis=1)
            best[dimension][chosen] = np.partition(pool, k - 1, axis=1)[:, :k]
        for dimension, found in best.items():
            row, _ = np.nonzero(np.isfinite(found))
            columns = [pa.array(known[dimension]["id"][row]), pa.array(found[np.isfinite(found)])]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "high"])

    return run


def limits(codes: DataFrame, queries: Callable[[], Queries], k: int, bound: float) -> DataFrame:
    """query_id and limit, the k-th smallest upper bound; queries with fewer than k candidates are left out."""
    scanned = codes.select("vec_id", "dimension", "code", "length", "own")
    highs = scanned.mapInArrow(_limit_finder(queries, k, bound), "query_id bigint, high double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("high"))
    return highs.select("query_id", "high", place.alias("place")).where(F.col("place") == k).select("query_id", F.col("high").alias("limit"))


def exact(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of rows, added up component by component."""
    total = np.zeros(len(vectors))
    for k in range(vectors.shape[1]):
        total += (vectors[:, k] - queries[:, k]) ** 2
    return np.sqrt(total)


def _first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row (a query) the k smallest scores, ties by id."""
    order = np.lexsort((ids, scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    first = np.searchsorted(row, row)
    kept = np.arange(len(row)) - first < k
    return row[kept], ids[kept], scores[kept]


def _reranker(queries: Callable[[], Queries], k: int, bound: float):
    """For each query the k nearest within a task, of the vectors whose lower bound is within its limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = queries()
        best = {d: (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)) for d in known}
        for dimension, chosen, tile, low, _, itself in _tiles(batches, known, bound):
            q = known[dimension]
            row, at = np.nonzero(~(low > q["limit"][chosen, None]) & ~itself)
            if len(row):
                ids, vectors = tile.column("vec_id").to_numpy()[at], _matrix(tile.column("vector"), dimension)
                scores = exact(vectors[at], q["vector"][chosen][row])
                fresh = _first(row + chosen.start, ids, scores, k)
                best[dimension] = _first(*[np.concatenate(pair) for pair in zip(best[dimension], fresh)], k)
        for dimension, (row, ids, scores) in best.items():
            columns = [pa.array(known[dimension]["id"][row]), pa.array(ids), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


def reranked(codes: DataFrame, queries: Callable[[], Queries], k: int, bound: float) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest vectors of each query of a pass."""
    found = codes.mapInArrow(_reranker(queries, k, bound), "query_id bigint, vec_id bigint, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = found.select("query_id", place.alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, bits: int = 256, pass_bytes: int = 16 << 20,
    bound: float = 3.0, seed: int = 5,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest vectors of each query, by Euclidean distance.

    `vectors` needs vec_id and embedding; queries are the rows for which `is_query`, a condition on
    vec_id, holds; candidates are all rows but the query's own. `bits` is the least length of a code.
    `pass_bytes` is what the queries of a pass and their best candidates take, which every task holds.
    `bound` is the error bound in standard deviations of the estimate: a true neighbour is missed about
    once in several hundred at 3.
    """
    spark = vectors.sparkSession
    steps = Steps(spark)
    codes = steps.store(encoded(vectors, bits, seed), "vector-codes")
    asked = codes.where(is_query).select("vec_id", "vector", "dimension")
    each = F.col("dimension") * 8 + F.greatest("dimension", F.lit(bits)) * 4 + F.lit(32 * k)
    passes = -(-(asked.agg(F.sum(each)).first()[0] or 0) // pass_bytes)
    folder = new_folder(spark, "nearest")
    for number in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).toArrow()
        queries = as_queries(rows, bits, seed)
        sent = spark.sparkContext.broadcast(queries)
        limit = limits(codes, lambda sent=sent: sent.value, k, bound).toArrow()
        sent.destroy()
        reach = dict(zip(limit.column("query_id").to_pylist(), limit.column("limit").to_pylist()))
        for q in queries.values():
            q["limit"] = np.array([reach.get(i, np.inf) for i in q["id"].tolist()])
        sent = spark.sparkContext.broadcast(queries)
        reranked(codes, lambda sent=sent: sent.value, k, bound).write.parquet(f"{folder}/pass={number}")
        sent.destroy()
    steps.drop(codes)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not passes:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/pass={number}" for number in range(passes)])
