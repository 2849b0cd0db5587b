"""Registered queries of the corpus operators, one per operator.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (collocations, decontam, jaccard, langid, licenses, quality_bayes, rules, secrets,
                         sentencepiece, spelling, suffix_dedup, tokens, urls)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(col: str) -> F.Column:
    return F.array_join(F.array_sort(F.array_distinct(col)), ",")


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    return jaccard.ngram_jaccard_components(_read(spark, sf_dir, "documents"), k=4, pct=85)


@query
def op2_quality_classifier(spark, sf_dir):
    return quality_bayes.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query
def op3_sentencepiece(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode(docs).select("doc_id", "n_pieces", "round_trip", "ids")


@query
def op4_quality_rules(spark, sf_dir):
    out = rules.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def op5_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    rows = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return langid.identify(rows, model)


@query
def op6_token_counts(spark, sf_dir):
    return tokens.document_token_counts(_read(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


@query
def op7_benchmark_decontamination(spark, sf_dir):
    return decontam.benchmark_matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query
def op8_suffix_array_dedup(spark, sf_dir):
    # the contract's 400 bytes; the text is also given without every repeated passage of over 50 words
    out = suffix_dedup.suffix_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"), 400, words=51, apart=True)
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
                      F.col("_n_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"),
                      F.col("_kept").alias("kept_text"), F.col("_kept_words").alias("kept_text_without_long_passages"))


@query
def op9_license_scan(spark, sf_dir):
    out = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      _joined("base_labels").alias("base_labels"), _joined("labels").alias("labels"), "score")


@query
def op10_url_filter(spark, sf_dir):
    out = urls.filter_urls(_read(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(_read(spark, sf_dir, "documents"), threshold=10, inside_pct=50, top=2000)


@query
def op12_secret_scan(spark, sf_dir):
    out = secrets.scan_secrets(_read(spark, sf_dir, "documents"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base"), 256).alias("base_sha256"),
                      joined("spans").alias("spans"))


@query
def op13_spelling_variants(spark, sf_dir):
    words = spelling.word_counts(_read(spark, sf_dir, "documents"), min_length=7, min_count=2, typo_every=31)
    return spelling.spelling_variants(words, ratio=10)


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


# Words, shingles, links and components, from the contract alone.
ORACLE: dict[str, str] = {"op1_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.sh = q.sh AND p.doc_id <> q.doc_id
    GROUP BY p.doc_id, q.doc_id) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b
  WHERE 100 * x.c >= 85 * (na.n + nb.n - x.c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
"""}

# Phrases, cuts and ranks, from the contract alone; HUGEINT products are exact.
ORACLE["op11_collocations"] = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i+k-1])) AS g
  FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, g, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
f10 AS (SELECT lang, k, array_to_string(g, ' ') AS g, g AS ws, f FROM f WHERE f >= 10),
parts AS (
  SELECT lang, g, k, f AS a, 1 AS j, ws[1] AS lp, array_to_string(ws[2:k], ' ') AS rp FROM f10 WHERE k >= 2 UNION ALL
  SELECT lang, g, k, f AS a, 2 AS j, array_to_string(ws[1:2], ' '), ws[3] FROM f10 WHERE k = 3),
cuts AS (
  SELECT c.lang, c.g, c.k, c.a, c.j, l.f AS l, r.f AS r, (1000000 * c.a * c.a) // (l.f * r.f) AS score
  FROM parts c JOIN f10 l ON l.lang = c.lang AND l.g = c.lp JOIN f10 r ON r.lang = c.lang AND r.g = c.rp),
cut AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
longer AS (
  SELECT lang, s, max(f) AS m FROM (
    SELECT lang, f, array_to_string(ws[1:2], ' ') AS s FROM f10 WHERE k = 3 UNION ALL
    SELECT lang, f, array_to_string(ws[2:3], ' ') FROM f10 WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT c.lang, c.g AS phrase, a, l, r, score FROM cut c
  LEFT JOIN longer o ON o.lang = c.lang AND o.s = c.g WHERE o.m IS NULL OR 100 * o.m < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
