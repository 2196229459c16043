"""Registered queries of the text operators: one ``opN_<name>`` each, applied
with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.llm import align, bpe, bytes_dedup, chosen_path, decontaminate, exact_dedup, filter_audit, jaccard_join, lang_id, licenses, phrase_dedup, token_file, toxicity
from nimbus.llm.common import read_table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read_table(spark, sf_dir, "documents"), tokenizer_path()
    return bpe.digests(bpe.decode_documents(bpe.encode_documents(docs, path), path))


def op2_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.report(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.predictions(toxicity.score(docs, model))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lang_id.predict(docs, lang_id.fit(docs)).select("doc_id", lang_id.held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(licenses.document_files(read_table(spark, sf_dir, "documents")))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "license", "origin", "score", "from_dir")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_files(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_bytes_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytes_dedup.report(read_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(read_table(spark, sf_dir, "documents"))


def op11_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.report(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.document_masks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_phrase_dedup, op3_toxicity, op4_language, op5_jaccard_join, op6_decontaminate, op7_licenses, op8_token_file, op9_bytes_dedup, op10_exact_dedup,
                                   op11_chosen_path, op12_filter_audit, op13_align)}

SQL_EXACT_DEDUP = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""

SQL_LICENSES = r"""
WITH t(license, said) AS (VALUES
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
  ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
  ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
  ('MIT', 'Released under the MIT License.'),
  ('Proprietary', 'All rights reserved.')
), tf AS (
  SELECT license, term, count(*) AS c
  FROM (SELECT license, unnest(regexp_extract_all(lower(said), '[a-z0-9]+')) AS term FROM t) GROUP BY ALL
), idf AS (SELECT term, ln(6.0 / (1 + count(*))) + 1 AS w FROM tf GROUP BY term
), tv AS (SELECT license, term, c * w AS w FROM tf JOIN idf USING (term)
), tn AS (SELECT license, sqrt(sum(w * w)) AS n FROM tv GROUP BY license
), files AS (
  SELECT doc_id, text, coalesce(source, '') || CASE (doc_id % 4 + 4) % 4 WHEN 0 THEN '' ELSE '/' || coalesce(CAST(floor(doc_id / 1000) AS BIGINT)::VARCHAR, '') END
           || CASE WHEN (doc_id % 4 + 4) % 4 >= 2 THEN '/' || CAST(floor(doc_id / 100) AS BIGINT)::VARCHAR ELSE '' END
           || CASE WHEN (doc_id % 4 + 4) % 4 = 3 THEN '/' || CAST(floor(doc_id / 10) AS BIGINT)::VARCHAR ELSE '' END AS dir,
         len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n_words
  FROM documents
), numbered AS (
  SELECT doc_id, dir, n_words, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS said FROM files
), words AS (
  SELECT doc_id, dir, n_words, line, term, count(*) AS tf
  FROM (SELECT * EXCLUDE (said), unnest(regexp_extract_all(lower(said), '[a-z0-9]+')) AS term FROM numbered) GROUP BY ALL
), weighed AS (
  SELECT words.*, tf * coalesce(idf.w, ln(6.0) + 1) AS lw FROM words LEFT JOIN idf USING (term)
), norms AS (SELECT doc_id, dir, n_words, line, sqrt(sum(lw * lw)) AS n, sum(tf) AS line_words FROM weighed GROUP BY ALL
), dots AS (SELECT doc_id, line, license, sum(lw * tv.w) AS dot FROM weighed JOIN tv USING (term) GROUP BY ALL
), scored AS (
  SELECT doc_id, dir, n_words, line, license, line_words, round(dot / (norms.n * tn.n), 6) AS score
  FROM dots JOIN norms USING (doc_id, line) JOIN tn USING (license)
), own AS (
  SELECT doc_id, dir, license, score, 2 * line_words >= n_words AS covers FROM scored WHERE score >= 0.8
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, license) = 1
), speaks AS (
  SELECT dir AS from_dir, license AS dir_license FROM own WHERE covers
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY dir || '/' || doc_id::VARCHAR) = 1
), above AS (
  SELECT d.dir, s.from_dir, s.dir_license FROM (SELECT DISTINCT dir FROM files) d JOIN speaks s ON d.dir = s.from_dir OR starts_with(d.dir, s.from_dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(s.from_dir) DESC) = 1
)
SELECT files.doc_id, coalesce(own.license, s.dir_license) AS license,
       CASE WHEN own.license IS NOT NULL THEN 'own' WHEN s.dir_license IS NOT NULL THEN 'inherited' END AS origin,
       own.score, CASE WHEN own.license IS NULL THEN s.from_dir END AS from_dir
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN above s ON s.dir = files.dir
"""

# Every document is taken through all 120 orders step by step: no coalitions, no potential.
SQL_FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(l.quality = 1, false)::INT AS good, coalesce(l.toxic = 1, false)::INT AS toxic,
         concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN l USING (doc_id)
), x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders
), counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), told AS (
  SELECT part, filter_order, step, n, good, toxic, fails, contains(fails, filter_order[step]) AS own,
         len(regexp_extract_all(fails, '[' || filter_order[1:step - 1] || '0]')) > 0 AS gone
  FROM counted, steps
), done AS (
  SELECT part, filter_order, step, filter_order[step] AS filter,
         coalesce(sum(n) FILTER (NOT gone AND NOT own), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = filter_order[step]), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (own AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (own AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM told GROUP BY ALL
)
SELECT * EXCLUDE (filter), sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM done
"""

ORACLE_SQL = {"op7_licenses": SQL_LICENSES, "op10_exact_dedup": SQL_EXACT_DEDUP, "op12_filter_audit": SQL_FILTER_AUDIT}
