"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmart.llm import (
    bpe,
    collocations,
    line_dedup,
    mixing,
    nearest,
    piece_counts,
    prefix_free,
    quality_model,
    quality_rules,
    simhash,
    spelling,
    substring,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


ORACLES["op4_line_dedup"] = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
every_line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS nr
  FROM texts
),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS i
  FROM every_line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
pairs AS (
  SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS second FROM lines
),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line, second ORDER BY doc_id, i) AS copy
  FROM pairs WHERE second IS NOT NULL
),
single AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS copy FROM lines
  WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {line_dedup.LEAST_WORDS}
),
dead AS (
  SELECT doc_id, i FROM ranked WHERE copy > 1
  UNION SELECT doc_id, i + 1 FROM ranked WHERE copy > 1
  UNION SELECT doc_id, i FROM single WHERE copy > 1
),
marked AS (
  SELECT e.doc_id, e.nr, e.line, l.i, d.i IS NOT NULL AS dead,
         d.i IS NOT NULL AND lag(d.i) OVER (PARTITION BY e.doc_id, l.i IS NULL ORDER BY l.i) IS NULL AS starts
  FROM every_line e LEFT JOIN lines l USING (doc_id, nr) LEFT JOIN dead d ON d.doc_id = e.doc_id AND d.i = l.i
)
SELECT doc_id, count(i) AS n_lines, CAST(count(*) FILTER (dead) AS BIGINT) AS n_deleted,
       CAST(count(*) FILTER (starts) AS BIGINT) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT dead), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op8_nearest"] = """
WITH usable AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
  GROUP BY vec_id
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, 
         sqrt(list_sum([(q.v[k] - c.v[k]) * (q.v[k] - c.v[k]) FOR k IN range(1, len(q.v) + 1)])) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


_WORD = "[^\\x20\\x09-\\x0D]+"

ORACLES["op9_seed_and_extend"] = f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)
),
windows AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER following AS content, count(*) OVER following AS n
  FROM words WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS copy FROM windows WHERE n = 20
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM ranked, range(20) steps(k) WHERE copy > 1)
SELECT d.doc_id, count(w.i) AS n_words, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (g.i IS NULL), '')) AS kept_sha256
FROM documents d LEFT JOIN words w ON w.doc_id = d.doc_id
LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i
GROUP BY d.doc_id
"""


def _count_sql(characters: str) -> str:
    return f"length(regexp_replace(text, '[^{characters}]', '', 'g'))"


_RULES = quality_rules.Rules()
_CLASSES_SQL = {
    "space": _count_sql("\\x20\\x09-\\x0D"), "lower": _count_sql("a-z"), "upper": _count_sql("A-Z"),
    "digit": _count_sql("0-9"), "stop": _count_sql(".,;:?\\x27\\x22()\\-"), "symbol": _count_sql("#*$%&|<>"),
    "ascii": _count_sql("\\x00-\\x7F"), "wide": f"strlen(text) - {_count_sql('\\x00-\\x7F')}",
}
_BINS = ("space", "lower", "upper", "digit", "stop", "symbol", "other", "wide")


def _divergence_sql(p: str, q: str) -> str:
    return (
        f"sqrt(least(greatest(sum((CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END "
        f"+ CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END)) / 2, 0), 1))"
    )


# Documents are numbered by their ids, which are keys in the given tables.
ORACLES["op5_quality_rules"] = f"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, lang, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i
  FROM (SELECT doc_id, lang, regexp_extract_all(text, '{_WORD}') AS w FROM texts)
),
totals AS (SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
repeated_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '{_WORD}') GROUP BY 1
),
windows AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER following AS content, count(*) OVER following AS n
  FROM words WINDOW following AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, content) AS found FROM windows WHERE n = 8),
repeated_words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k FROM again, range(8) steps(k) WHERE found > 1)
  GROUP BY 1
),
counted AS (SELECT doc_id, lang, {', '.join(f'{sql} AS "{c}"' for c, sql in _CLASSES_SQL.items())} FROM texts),
classes AS (
  SELECT doc_id, lang, bin, n FROM (
    SELECT *, "ascii" - space - lower - upper - digit - stop - symbol AS other FROM counted
  ) UNPIVOT (n FOR bin IN ({', '.join(_BINS)}))
),
class_shares AS (
  SELECT doc_id, lang, bin, coalesce(n / nullif(sum(n) OVER (PARTITION BY doc_id), 0), 0) AS p FROM classes
),
class_reference AS (
  SELECT lang, bin, coalesce(n / nullif(sum(n) OVER (PARTITION BY lang), 0), 0) AS q
  FROM (SELECT lang, bin, sum(n) AS n FROM classes GROUP BY lang, bin)
),
by_class AS (
  SELECT doc_id, {_divergence_sql('p', 'q')} AS distance FROM class_shares s JOIN class_reference r
  ON r.lang IS NOT DISTINCT FROM s.lang AND r.bin = s.bin GROUP BY 1
),
word_counts AS (
  SELECT *, sum(n) OVER (PARTITION BY lang) AS total
  FROM (SELECT lang, word, count(*) AS n FROM words GROUP BY lang, word)
),
common AS (SELECT lang, word, n / total AS q FROM word_counts WHERE n >= {_RULES.common_share} * total),
word_reference AS (
  SELECT * FROM common UNION ALL SELECT lang, NULL, 1 - sum(q) FROM common GROUP BY lang
),
found_words AS (
  SELECT w.doc_id, c.word, count(*) AS n FROM words w
  LEFT JOIN common c ON c.lang IS NOT DISTINCT FROM w.lang AND c.word = w.word GROUP BY ALL
),
by_word AS (
  SELECT doc_id, {_divergence_sql('p', 'q')} AS distance FROM (
    SELECT t.doc_id, r.q, coalesce(f.n, 0) / t.n_words AS p
    FROM totals t JOIN texts x ON x.doc_id = t.doc_id JOIN word_reference r ON r.lang IS NOT DISTINCT FROM x.lang
    LEFT JOIN found_words f ON f.doc_id = t.doc_id AND f.word IS NOT DISTINCT FROM r.word
  ) GROUP BY 1
),
judged AS (
  SELECT x.doc_id, coalesce(t.n_words, 0) AS n_words, coalesce(t.word_chars, 0) AS word_chars,
    c.symbol AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(w.n, 0) AS n_repeat_words,
    coalesce(bc.distance, 0) AS class_distance, coalesce(bw.distance, 0) AS word_distance
  FROM texts x LEFT JOIN totals t USING (doc_id) LEFT JOIN counted c USING (doc_id)
  LEFT JOIN repeated_lines l USING (doc_id) LEFT JOIN repeated_words w USING (doc_id)
  LEFT JOIN by_class bc USING (doc_id) LEFT JOIN by_word bw USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT (n_words >= {_RULES.least_words_for_classes} AND class_distance >
    {_RULES.most_class_distance} + {_RULES.class_slack} / sqrt(greatest(n_words, 1)))
  AND NOT (n_words >= {_RULES.least_words_for_words} AND word_distance >
    {_RULES.most_word_distance} + {_RULES.word_slack} / sqrt(greatest(n_words, 1))) AS kept
FROM (
  SELECT *, n_words < {_RULES.least_words} OR 100 * n_repeat_words > {100 * _RULES.most_repeated:.0f} * n_words AS base_failed
  FROM judged
)
"""


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return found.drop("class_distance", "word_distance")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_digests(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Every text encoded and decoded again: number of ids, digests of the ids and of the bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    found = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True, carried=carried)
    return found.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(bpe.joined(F.col("tokens")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *carried,
    )


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op6_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_free.deduplicated(table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


@query
def op9_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = mixing.places(docs, mixing.tempered(docs))
    return found.select("doc_id", "source", "block", "slot", "place")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


@query
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# Texts of more tokens than this do not fit into one training sequence.
CONTEXT = 4096


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = piece_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    found = piece_counts.token_counts(table(spark, sf_dir, "documents"), pieces)
    return found.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op13_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
grams AS (
  {" UNION ALL ".join(
      f"SELECT lang, {k} AS d, array_to_string(ws[i : i + {k - 1}], ' ') AS phrase "
      f"FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM words)"
      for k in range(1, collocations.LONGEST + 1)
  )}
),
found AS (SELECT lang, d, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY 1),
candidates AS (SELECT lang, d, phrase, n AS a, string_split(phrase, ' ') AS ws FROM found WHERE d > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.k, l.n AS l, r.n AS r, t.n AS n,
    ((1000::HUGEINT * c.a * t.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, d)) AS k FROM candidates) x
  JOIN candidates c ON c.lang = x.lang AND c.phrase = x.phrase JOIN totals t ON t.lang = c.lang
  JOIN found l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : x.k], ' ')
  JOIN found r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[x.k + 1 :], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, a, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM (
    SELECT lang, a, ws, k, unnest(range(1, d - k + 2)) AS i FROM (
      SELECT *, unnest(range(2, d)) AS k FROM candidates
    )
  )
),
kept AS (SELECT b.* FROM best b ANTI JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase AND i.a >= b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) WHERE rank <= {collocations.TOP}
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _crc_nibbles() -> list[int]:
    table = list(range(16))
    for _ in range(4):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


def _crc_step(state: str) -> str:
    """Four bits of a checksum; lists count from one."""
    return f"xor(({_crc_nibbles()}::BIGINT[])[({state} & 15) + 1], {state} >> 4)"


_HALF = _crc_step("xor(c, b)")

ORACLES["op11_spelling_variants"] = f"""
WITH runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents
  ) GROUP BY ALL
),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bs
  FROM runs
),
checked AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bs), lambda c, b: {_crc_step(f"({_HALF})")})) AS h
  FROM bytes
),
thinned AS (
  SELECT n, CASE WHEN h % {spelling.THINNED} = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
  FROM checked
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= {spelling.LEAST_LENGTH}
  GROUP BY 1 HAVING sum(n) >= {spelling.LEAST_COUNT}
),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
holes AS (SELECT word, n, i, word[: i] || '*' || word[i + 2 :] AS hole FROM places),
links AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM places a JOIN words b ON a.word[: a.i] || a.word[a.i + 2 :] = b.word
  UNION SELECT b.word, a.word, a.n FROM places a JOIN words b ON a.word[: a.i] || a.word[a.i + 2 :] = b.word
),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM links
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
chains AS (
  WITH RECURSIVE steps AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NOT NULL
  )
  SELECT s.word, s.at AS root FROM steps s JOIN formed f ON f.word = s.at WHERE f.form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN chains USING (word)
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
