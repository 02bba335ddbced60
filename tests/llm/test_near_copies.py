"""The pipeline's near-duplicate stage against brute-force Jaccard similarities."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from plantmart import session
from plantmart.llm import near_copies


def shingles(text, size=5):
    found = (text or "").encode().lower().split()
    return {b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)} or {b" ".join(found)}


def first_of_each(texts):
    """Indexes of the smallest members of the components of all pairs with a Jaccard similarity of 0.8 or more."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if root[i] != root[j] and 10 * shared >= 8 * (len(a) + len(sets[j]) - shared):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return sorted(set(root))


def changed(pick, words, n):
    words = list(words)
    for at in pick.sample(range(len(words)), n):
        words[at] = f"neu{pick.randint(0, 10**9)}"
    return " ".join(words)


def corpus():
    """Texts around the limit, a crowd of near copies, and a passage that many other texts share."""
    pick = random.Random(11)
    texts = [None, "", "  \n", "eins", "EINS", "eins zwei drei vier fünf", "eins zwei drei vier fünf sechs"]
    for g in range(40):
        base = [f"w{g}x{k}" for k in range(pick.choice((12, 60, 200, 400)))]
        texts += [changed(pick, base, round(len(base) * share)) for share in (0, 0.01, 0.015, 0.02, 0.025, 0.03)]
    crowd = [f"c{k}" for k in range(150)]
    texts += [changed(pick, crowd, pick.randint(0, 3)) for _ in range(120)]
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} {' '.join(f'e{k}y{j}' for j in range(pick.randint(5, 60)))}" for k in range(120)]
    pick.shuffle(texts)
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)


@pytest.mark.parametrize("few", (near_copies.FEW, 3))
def test_all_pairs_with_the_similarity_and_no_others(spark, few, monkeypatch):
    monkeypatch.setattr(near_copies, "FEW", few)
    texts = corpus()
    docs = frame(spark, texts)
    found = corpus_pipeline.keep_one_of_near_copies(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == first_of_each(texts)


def test_no_copies_at_all(spark):
    assert near_copies.one_of_each(frame(spark, ["a b c d e f", "g h i j k l"])).count() == 2
    assert near_copies.one_of_each(frame(spark, ["x"]).where("false")).count() == 0


def test_crowd_under_few_keys(spark, monkeypatch):
    """Short texts: a third of all nodes share every key, and no round compares all of their pairs."""
    monkeypatch.setattr(near_copies, "FEW", 4)
    texts = [f"a b c d e f g h i j k l m n o p q r s t u v w x {k}" for k in range(300)]
    texts += [f"x{k} y{k} z{k} v{k} w{k}" for k in range(600)]
    docs = frame(spark, texts)
    compared = []
    similar = near_copies._similar

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return similar(pairs, sets, percent)

    monkeypatch.setattr(near_copies, "_similar", counted)
    found = near_copies.one_of_each(docs)
    assert sorted(r.doc_id for r in found.collect()) == first_of_each(texts)
    assert sum(compared) < 3 * 300


def test_defined_cases_and_names(spark):
    """NULL ids, repeated rows, columns with the names that are used inside."""
    text = "eins zwei drei vier fünf sechs sieben"
    names = ["key", "node", "n", "first", "hash", "own_hash", "own_id", "kept_hash", "kept_id", "place", "h1", "_place"]
    rows = [(None, text), (7, text), (7, text), (7, "anders"), (None, None), (8, " "), (None, "ohne"), (None, "ohne")]
    docs = spark.createDataFrame([(*r, *names) for r in rows], ", ".join(["doc_id bigint", "text string", *(f"{c} string" for c in names)]))
    found = near_copies.one_of_each(docs)
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    assert kept == sorted([(7, text), (7, "anders"), (8, " "), (None, "ohne")], key=repr)


def test_superseded_steps_are_deleted(spark):
    folder = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    near_copies.one_of_each(frame(spark, corpus())).collect()
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left <= {"near-kept", "links"}


def test_fingerprints_link_first_and_the_similarity_decides(spark, monkeypatch):
    """Every distinct fingerprint is looked up, links are verified, and what they leave is found all the same."""
    texts = corpus()
    # Equal fingerprints, but no similarity: all shingles but a few are repeats of one.
    repeated = "ab " * 200
    texts += [repeated + " ".join(f"q{k}r{j}" for j in range(9)) for k in range(3)]
    searched, checked = [], []
    links, similar = near_copies.simhash.links, near_copies._similar

    def searching(prints, *rest):
        searched.extend(r.fingerprint for r in prints.collect())
        found = links(prints, *rest)
        assert found.count() > 0
        return found

    def checking(pairs, sets, percent):
        kept = similar(pairs, sets, percent)
        checked.append((pairs.count(), kept.count()))
        return kept

    monkeypatch.setattr(near_copies.simhash, "links", searching)
    monkeypatch.setattr(near_copies, "_similar", checking)
    found = near_copies.one_of_each(frame(spark, texts))
    assert sorted(r.doc_id for r in found.collect()) == first_of_each(texts)
    texts_of = pa.array([(t or "").encode() for t in texts], pa.large_binary())
    prints = near_copies.simhash.fingerprints_of(texts_of, 5).view(np.int64)
    assert len(set(prints[-3:].tolist())) == 1
    assert len(set(searched)) == len(searched) and set(searched) <= set(prints.tolist())
    # The first comparison is that of the fingerprints; it finds links, and later ones find the others.
    assert checked[0][1] > 0 and sum(n for _, n in checked[1:]) > 0
