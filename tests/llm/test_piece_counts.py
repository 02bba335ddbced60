"""Token counts against the library, and of vocabularies in which merges do not come in order."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from plantmart.llm import piece_counts
from plantmart.llm.queries import op12_token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
SMALL = "/root/testdata/sf0.001"


def awkward():
    pick = random.Random(5)
    texts = [
        None, "", " ", "a", "  zwei  wörter   ", "<s></s><unk> <0x0A>\n▁c ▁▁ x▁y", "\x00 漢字 \U0001f600 Zürich ½ ﬁ",
        " " * 1000 + "x" + " " * 77, "a" * 5000, "ab" * 3000, "\n\n\n\t\t  \n", "aaaa bbbb aaaaaaa    bb     c",
        "".join(pick.choice("abcde ") for _ in range(20000)), "".join(pick.choice("0123456789+/Aa") for _ in range(9000)),
    ]
    return texts + ["".join(pick.choice("abt he  in\n▁éあ") for _ in range(pick.randint(0, 60))) for _ in range(500)]


@pytest.mark.parametrize("block", (piece_counts.BLOCK_BYTES, 3000))
def test_counts_are_those_of_the_library(spark, block, monkeypatch):
    monkeypatch.setattr(piece_counts, "BLOCK_BYTES", block)
    texts = awkward()
    rows = [(k % 7 or None, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, n_bytes int").repartition(3)
    found = piece_counts.token_counts(docs, piece_counts.read_pieces(PATH))
    expected = [(k % 7 or None, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for k, t in enumerate(texts)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert piece_counts.token_counts(docs.where("false"), piece_counts.read_pieces(PATH)).count() == 0


def test_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op12_token_counts(spark, SMALL).collect()
    assert len(found) == len(docs)
    for row in found:
        n = len(LIBRARY.encode(docs[row.doc_id]))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(docs[row.doc_id].encode()), n, n > 4096)


def plain(text, pieces):
    """One merge after the other: the highest score, of equal ones the leftmost."""
    parts = list(text)
    while True:
        found = [(-pieces[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces]
        if not found:
            return sum(1 if p in pieces else len(p.encode()) for p in parts)
        k = min(found)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


@pytest.mark.parametrize("seed", range(8))
def test_any_order_of_merges(seed):
    """Pieces with random scores, many of them equal: merges may bring forth pairs that should come before them."""
    pick = random.Random(seed)
    pieces = {c: -float(pick.randint(0, 9)) for c in "abc"}
    for _ in range(40):
        pieces["".join(pick.choice("abcd") for _ in range(pick.randint(2, 5)))] = -float(pick.randint(0, 12))
    vocabulary = piece_counts.Vocabulary(list(pieces.items()))
    texts = ["".join(pick.choice("aabbcdä") for _ in range(pick.randint(1, 90))) for _ in range(300)]
    points = np.array([ord(c) for t in texts for c in t], dtype=np.int32)
    found = piece_counts.surviving(vocabulary.symbols(points), np.array([len(t) for t in texts]), vocabulary)
    assert found.tolist() == [plain(t, pieces) for t in texts]
