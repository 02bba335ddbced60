"""Byte-level BPE holds little of the corpus at a time."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from plantmart.llm import arrays, bpe
from plantmart.llm.storing import in_small_batches
from tests.llm import plain


def test_blocks_stay_small():
    texts = [f"word{k} " * (40_000) for k in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": texts})
    sizes = [sum(len(t.as_py()) for c in block for t in c.column("text")) for block in bpe._blocks(iter([batch]))]
    assert sum(sizes) == sum(map(len, texts))
    assert len(sizes) > 1 and max(sizes) <= (4 << 20) + arrays.CHUNK_BYTES


def test_batches_from_spark_stay_small(spark):
    """A batch of 10,000 texts, Spark's default, was held several times over by the JVM and by Python."""
    docs = spark.range(4_000).selectExpr("id AS doc_id", "repeat('some words ', 100) AS text").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.column("text").nbytes]})

    found = in_small_batches(docs, 1 << 20).mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r.n for r in found) == 4_000
    assert len(found) > 4 and max(r.size for r in found) <= 1 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("rows_")]


def test_a_block_does_not_keep_the_batch():
    """The texts of a block are copies: a slice would keep the whole batch in memory with it."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(400)), "text": ["some words " * 2_000] * 400})
    block = next(bpe._blocks(iter([batch])))
    held = sum(c.column("text").get_total_buffer_size() for c in block)
    assert held < 1.5 * bpe.BLOCK_BYTES < batch.nbytes


def test_replay_holds_little_beside_its_words():
    """Positions take four bytes, and enter the index a part at a time."""
    words = [f"{k * 7919 % 99991}w{k}".encode() for k in range(100_000)]
    vocabulary = bpe.Vocabulary(plain.RANKS)
    tracemalloc.start()
    tokens, first = bpe.replay(words, vocabulary)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens[first[7] : first[8]].tolist() == vocabulary.greedy(words[7])
    assert peak < 48 * sum(map(len, words))


def test_words_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(bpe, "ENTERED", 5)
    vocabulary = bpe.Vocabulary(plain.RANKS)
    words = [b"internationalization", b"", b"aaaaaaaaaaa", "größer".encode(), b"x"]
    found, first = bpe.replay(words, vocabulary)
    assert [found[a:b].tolist() for a, b in zip(first, first[1:])] == [vocabulary.greedy(w) for w in words]
