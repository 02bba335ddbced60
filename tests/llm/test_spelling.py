"""Spelling variants against brute force: words, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter

import pytest

from plantmart.llm import spelling

SMALL = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_words(rows, thinned=97, least_length=5, least_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(lowered(text)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % thinned == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least_count}


def edits(word, letters):
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters}
    return out - {word}


def plain(rows, **options):
    words = plain_words(rows, **options)
    letters = {c for w in words for c in w}
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if words[x] >= 2 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    wide = [(a, b, "x", 1) for a, b in rows]
    docs = spark.createDataFrame(wide, "doc_id bigint, text string, word string, n int").repartition(3)
    return sorted(map(tuple, spelling.variants(docs, **options).collect()), key=repr)


def corpus(seed=4):
    """Words over few letters, so that most have neighbours; some share long halves; odd texts and ids."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abé") for _ in range(pick.randint(4, 8))) for _ in range(300)]
    vocabulary += ["gemeinsameranfang" + "".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    vocabulary += ["".join(pick.choice("xyzÿ") for _ in range(3)) + "gemeinsamesende" for _ in range(60)]
    vocabulary += ["aaaaa", "aaaaaa", "aaaaaaa", "aaaaaaaa", "ß×÷À", "b" * 3000, "b" * 2999, "b" * 1500 + "c" + "b" * 1499]
    rows = [(k % 50 or None, " ".join(pick.choices(vocabulary, k=60)) + "\n1Za,AAAAA") for k in range(200)]
    rows += [(k, f"{v} {v.upper()}-{v}") for k, v in enumerate(vocabulary)]
    return rows + [(None, None), (1, ""), (1, ""), (2, "123 漢字"), (3, "É́é" * 5)]


@pytest.mark.parametrize("most, symbols", ((spelling.GROUP, spelling.SYMBOLS), (9, 400)))
def test_brute_force(spark, most, symbols, monkeypatch):
    monkeypatch.setattr(spelling, "SYMBOLS", symbols)
    rows = corpus()
    expected = plain(rows, thinned=7)
    assert sum(r[2] > 0 for r in expected) > 300 and any(r[5] != (r[3] or r[0]) for r in expected)
    assert found(spark, rows, thinned=7, most=most) == expected


def test_small_blocks_and_whole_table(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    monkeypatch.setattr(spelling, "BLOCK_BYTES", 5000)
    assert found(spark, rows) == plain(rows)


def test_nothing_to_find(spark):
    assert found(spark, [(1, "zu kurz")]) == []
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.variants(docs).collect() == []
    once = [(k, "einzelnes") for k in range(3)]
    assert found(spark, once, thinned=10**9) == [("einzelnes", 3, 0, None, None, "einzelnes")]
