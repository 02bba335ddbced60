"""Collocations against brute force, and the steps that only large corpora need."""

import random
import re
from collections import Counter, defaultdict

import pytest

from plantmart.llm import collocations

BREAK, WORD = re.compile("[.,;:!?\n\v\f\r]"), re.compile("[^ \t]+")


def pieces(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [WORD.findall(p) for p in BREAK.split(lowered)]


def plain(rows, least, longest=5, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for d in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for d in range(2, len(p)):
                for i in range(len(p) - d + 1):
                    inside[p[i : i + d]] = max(inside[p[i : i + d]], a)
        ranked = []
        for p, a in candidates.items():
            if inside[p] >= a:
                continue
            cuts = ((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def corpus(seed=3, n=400):
    """Few words, repeated passages, one very common pair, and odd texts."""
    pick = random.Random(seed)
    words = ["der", "die", "Straße", "zum", "Haus", "x", "漢字", "#1", "Ä", "ende"]
    passage = "es war einmal vor langer zeit ein haus"
    rows = []
    for k in range(n):
        text = [pick.choice(words) + pick.choice(["", "", "", ".", ", ", "\n", "\t"]) for _ in range(pick.randint(0, 40))]
        text += ["der die"] * (k % 3) + [passage] * (k % 2)
        pick.shuffle(text)
        rows.append((" ".join(text), pick.choice(["de", "en", None, "und"])))
    return rows + [(None, "de"), ("", None), (" .,; ", "fr"), ("\n", None), ("allein", "it"), ("zu " * 5000, "xx")]


def found(spark, rows, **options):
    wide = [(None, *r, "y", 1) for r in rows]
    docs = spark.createDataFrame(wide, "doc_id bigint, text string, lang string, word string, n int").repartition(4)
    return sorted(map(tuple, collocations.collocations(docs, **options).collect()))


@pytest.mark.parametrize("slot_bits, block", ((collocations.SLOT_BITS, collocations.BLOCK_BYTES), (20, 2000), (3, 500)))
def test_brute_force(spark, slot_bits, block, monkeypatch):
    """With few slots nothing is ruled out, and crowded pairs are split by their third word."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "COMBINE", block // 10)
    rows = corpus()
    expected = plain(rows, 5)
    assert len(expected) > 400 and len({r[0] for r in expected}) > 3
    assert found(spark, rows, least=5, slot_bits=slot_bits) == expected


def test_limits(spark):
    rows = corpus(8, 100)
    assert found(spark, rows, least=3, longest=3, top=7) == plain(rows, 3, 3, 7)
    assert found(spark, rows, least=10**6) == []
    assert found(spark, [("", "de")]) == []
    with pytest.raises(ValueError):
        found(spark, rows, longest=6)


def test_pairs_are_split_when_crowded(spark):
    """One pair makes up most of all pairs; its continuations lie in several tasks."""
    rows = [(" ".join(f"a b c{k % 7}" for k in range(j, j + 60)), "de") for j in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    _, flags, crowded, groups = collocations._slots(docs, 5, 16)
    assert groups == collocations.LEAST_GROUPS
    assert len(flags) == 2**16 // 8 and 0 < len(crowded) <= 2 * collocations.SHARE
    assert found(spark, rows, least=5) == plain(rows, 5)


def test_numbers_beyond_64_bits(spark):
    """The product of the counts passes 64 bits, the score does not."""
    big = 10**13
    nodes = [([1], big, "de", "a"), ([2], big // 3, "de", "b"), ([1, 2], big // 7, None, None), ([9], 9 * big, "de", None)]
    frame = spark.createDataFrame(nodes, collocations._NODES)
    row = collocations.scored(frame).first()
    assert (row.score, row.l, row.r) == (1000 * (big // 7) * 9 * big // (big * (big // 3)), big, big // 3)
