"""Operators on texts against plain versions: quality rules, repeats, lines, fingerprints, tokens."""

import random

import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from plantmart.llm import bpe, line_dedup, prefix_free, quality_rules, repeats, simhash, substring
from plantmart.llm.queries import token_digests
from tests.llm import plain
from tests.llm.test_near_copies import first_of_each

SMALL = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"wort{k}" for k in range(70))
LINES = "erste zeile\n\nzweite zeile\n  \ndritte zeile"
AWKWARD = [
    None, "", "   \n\t", "a", "ein wort\n", PASSAGE, f"vorher {PASSAGE} nachher", f"{PASSAGE} {PASSAGE}",
    f"x\n{PASSAGE[30:]}\ny", "a" * 1500, "ab" * 700, " ".join(["und"] * 60), LINES, LINES + "\nvierte", "neu\n" + LINES,
    LINES, "zweite zeile\ndritte zeile\nzweite zeile\ndritte zeile", "Zürich ß € 漢字 \U0001f600 " * 40,
    "Zürich ß € 漢字 \U0001f600 " * 41, "#$%& <> || ** " * 30, "EINS ZWEI drei vier", "eins zwei DREI vier", "\n\n\n",
    " ".join(random.Random(3).choice(["der", "die", "das", "nicht"]) for _ in range(3000)),
]
CLASH = (
    "kept", "dead", "text_hash", "fingerprint", "start", "doc", "row", "key", "id", "h", "spots", "spot", "kept_id", "kept_hash",
    "own_id", "own_hash", "_place", "_row", "_doc", "of_doc", "of_row", "of_id", "own_row",
)


def rows_of(spark, texts, langs=None):
    """Documents with doc_id 0, 1, ... in an order of their own, and columns with names used inside."""
    rows = [(k, t, langs[k] if langs else "de", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    random.Random(1).shuffle(rows)
    made = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return made.repartition(3).withColumns({c: F.lit("x") for c in CLASH})


def small_texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    return [r.text for r in rows], [r.lang for r in rows]


def by_id(frame):
    return [tuple(r)[1:] for r in sorted(frame.collect(), key=lambda r: r.doc_id)]


@pytest.fixture(scope="module")
def texts(spark):
    return AWKWARD + small_texts(spark)[0]


def test_base_counts(spark, texts):
    found = quality_rules.verdicts(rows_of(spark, texts))
    counts = found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by_id(counts) == [plain.base_counts(t) for t in texts]


def test_quality_verdicts(spark):
    texts, langs = small_texts(spark)
    texts, langs = [*texts, *AWKWARD], [*langs, *[None] * len(AWKWARD)]
    rules = quality_rules.Rules()
    expected = plain.quality_kept(list(zip(texts, langs)), rules)
    docs = rows_of(spark, texts, langs)
    assert by_id(quality_rules.verdicts(docs).select("doc_id", "kept")) == [(k,) for k in expected]
    kept = quality_rules.filtered(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, x in enumerate(expected) if x]


def test_repeated_passages(spark, texts):
    found = substring.deduplicated(rows_of(spark, texts))
    digests = found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert by_id(digests) == plain.substring(texts)


def test_repeated_byte_strings(spark, texts):
    found = prefix_free.deduplicated(rows_of(spark, texts))
    digests = found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert by_id(digests) == plain.byte_strings(texts)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_few_symbols(spark, seed):
    """Short alphabets make many ties, nested and overlapping repeats."""
    pick = random.Random(seed)
    texts = ["".join(pick.choice("ab") for _ in range(pick.choice((0, 5, 30, 90)))) for _ in range(60)]
    windows = repeats.Windows(12, 4, refine=(4, 1), words=False, every=True)
    docs = repeats.keyed(rows_of(spark, texts))
    found = [set() for _ in texts]
    for r in repeats.repeated(docs, windows).collect():
        found[r.doc] |= set(range(r.start, r.start + r.n - 1 + 12))
    gone = plain.kept_windows([t.encode() for t in texts], 12, every=True)
    assert found == [{k for k, x in enumerate(g) if x} for g in gone]


def test_hot_passage_stays_once(spark):
    """A passage in every document, between words of its own: only the first copy stays."""
    texts = [f"{'x' * (k % 7)}vor{k} {PASSAGE} nach{k}" for k in range(400)]
    found = by_id(substring.deduplicated(rows_of(spark, texts)).select("doc_id", "n_removed"))
    assert found == [(0,)] + [(70,)] * 399


def test_line_runs(spark, texts):
    found = by_id(line_dedup.deduplicated(rows_of(spark, texts)))
    assert found == plain.lines_without_copies(texts)


@pytest.mark.parametrize("least", (1, 3, 4))
def test_line_runs_of_other_lengths(spark, least):
    pick = random.Random(least)
    texts = ["\n".join(pick.choice(["a b", "c", "", "d e f"]) for _ in range(pick.randint(0, 30))) for _ in range(60)]
    found = by_id(line_dedup.deduplicated(rows_of(spark, texts), least))
    assert found == plain.lines_without_copies(texts, least)


def test_cleaned_documents_keep_their_columns(spark, texts):
    docs = rows_of(spark, texts)
    found = line_dedup.cleaned(docs)
    assert found.columns == docs.columns
    got = [(r.text, r.n_chars, r.source) for r in sorted(found.collect(), key=lambda r: r.doc_id)]
    expected = [x[0] for x in plain.lines_without_copies(texts)]
    assert got == [(t, len(t), f"s{k % 3}") for k, t in enumerate(expected)]


@pytest.mark.parametrize("block", (4096, 4))
def test_near_duplicates(spark, texts, block):
    prints = [plain.fingerprint(t) for t in texts]
    labels = plain.smallest_reachable(prints)
    found = simhash.groups(rows_of(spark, texts), block=block)
    as_signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    assert by_id(found) == list(zip(as_signed, labels))
    kept = simhash.one_of_each(rows_of(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(labels))


def test_links_of_a_crowd(spark):
    """Thousands of fingerprints around one, more than a block: one component, no more links than needed."""
    pick = random.Random(5)
    prints = sorted({sum(1 << k for k in pick.sample(range(64), pick.randint(0, 3))) for _ in range(700)})
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint bigint")
    labels = plain.smallest_reachable(prints)
    for block in (4096, 64):
        found = simhash._roots(frame, 4, block).collect()
        roots = {}
        for r in found:
            roots.setdefault(r.root, set()).add(r.fingerprint % (1 << 64))
        groups = {}
        for p, label in zip(prints, labels):
            groups.setdefault(label, set()).add(p)
        assert sorted(map(sorted, roots.values())) == sorted(map(sorted, groups.values()))


def test_tokens(spark, texts):
    found = by_id(token_digests(rows_of(spark, texts)))
    ids = [plain.tokens(t) for t in texts]
    expected = [(len(x), plain.sha(",".join(map(str, x))), plain.sha(t or "")) for x, t in zip(ids, texts)]
    assert found == expected


def test_decoding_alone(spark, texts):
    docs = rows_of(spark, texts)
    found = bpe.decode(bpe.encode(docs, plain.RANKS, public_tokenizers.PATTERN), plain.RANKS)
    assert [(list(t), bytes(d)) for t, d in by_id(found)] == [(plain.tokens(t), (t or "").encode()) for t in texts]


def test_unknown_token(spark):
    rows = spark.createDataFrame([(1, [10**6])], "doc_id bigint, tokens array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(rows, plain.RANKS).collect()
    none = spark.createDataFrame([(1, None)], "doc_id bigint, tokens array<int>")
    assert bytes(bpe.decode(none, plain.RANKS).first().decoded) == b""


def test_a_rank_that_comes_too_late():
    """Merging ab (rank 257) gives rise to abc, which ranks before it; then words are encoded pair by pair."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"cab": 258}
    vocabulary = bpe.Vocabulary(ranks)
    words = [b"abcab", b"ab", b"abab", b"cabc", b"abcabc"]
    found, first = bpe.replay(words, vocabulary)
    assert [found[a:b].tolist() for a, b in zip(first, first[1:])] == [vocabulary.greedy(w) for w in words]


def all_operators(docs):
    return {
        "quality": quality_rules.verdicts(docs),
        "substring": substring.deduplicated(docs),
        "bytes": prefix_free.deduplicated(docs),
        "lines": line_dedup.deduplicated(docs),
        "near": simhash.groups(docs),
        "one": simhash.one_of_each(docs),
        "tokens": token_digests(docs),
    }


def test_empty_table(spark):
    for name, found in all_operators(rows_of(spark, ["x"]).where("false")).items():
        assert found.count() == 0, name


def test_rows_without_id_and_repeated_rows(spark):
    """Rows given twice get equal results; rows without an id are kept and come first."""
    long = " ".join(f"w{k}" for k in range(300))
    rows = [(None, long), (7, long), (7, long), (7, "anders"), (8, None), (None, None), (None, None)]
    docs = spark.createDataFrame([Row(doc_id=a, text=b, lang=None) for a, b in rows], "doc_id bigint, text string, lang string")
    found = all_operators(docs)
    for name, frame in found.items():
        assert name == "one" or frame.count() == len(rows), name
    removed = sorted((r.doc_id is None, r.n_removed) for r in found["substring"].collect() if r.n_words == 300)
    assert removed == [(False, 300), (False, 300), (True, 0)]
    assert {r.n_removed for r in found["bytes"].collect() if r.n_bytes > 400} == {len(long)}
    near = {(r.doc_id, r.component_id) for r in found["near"].collect()}
    assert near == {(None, 7), (7, 7), (8, 8), (None, 8)}
    kept = found["one"].collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(7, "anders"), (7, long), (8, None)]


def test_rows_without_id_that_share_a_short_hash(spark):
    """Texts of equal 32-bit hashes are not one document; each keeps its lines."""
    made = spark.range(300_000).select(F.concat(F.lit("nummer "), "id", F.lit(" von vielen")).alias("text"))
    pairs = made.groupBy(F.hash("text")).agg(F.collect_list("text").alias("texts")).where(F.size("texts") > 1)
    texts = [t for r in pairs.collect() for t in r.texts]
    assert len(texts) > 4
    rows = [(None, t) for t in texts] + [(1, f"{PASSAGE}\n{PASSAGE}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [r.text for r in line_dedup.deduplicated(docs).where("doc_id IS NULL").collect()]
    assert sorted(kept) == sorted(texts)
    kept = [r.text for r in substring.deduplicated(docs).where("doc_id IS NULL").collect()]
    assert sorted(kept) == sorted(texts)
    assert {r.n_removed for r in prefix_free.deduplicated(docs).where("doc_id IS NULL").collect()} == {0}


def test_single_lines_count_from_ten_words_on(spark):
    long, short = " ".join(f"w{k}" for k in range(10)), " ".join(f"w{k}" for k in range(9))
    texts = [f"a\n{long}\nb", f"c\n{long}\nd", long, f"{short}\ne", f"f\n{short}", f"{long}\n{long}"]
    found = line_dedup.deduplicated(rows_of(spark, texts))
    expected = [x[0] for x in plain.lines_without_copies(texts)]
    assert [r.text for r in sorted(found.collect(), key=lambda r: r.doc_id)] == expected
    assert expected == [texts[0], "c\nd", "", texts[3], texts[4], ""]


def test_pipeline(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    verdicts = plain.quality_kept([(r.text, r.lang) for r in docs], quality_rules.Rules())
    docs = [r for r, kept in zip(docs, verdicts) if kept]
    cleaned = [x[0] for x in plain.lines_without_copies([r.text for r in docs])]
    expected = []
    for at in first_of_each(cleaned):
        ids = plain.tokens(cleaned[at])
        expected.append((docs[at].doc_id, len(ids), plain.sha(",".join(map(str, ids))), plain.sha(cleaned[at])))
    found = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert found == expected
    assert len(corpus_pipeline.STAGES) == 5
