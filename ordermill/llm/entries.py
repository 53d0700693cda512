"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import alignment, ann, bpe, decontaminate, jaccard_join, passages, pii, quality, secrets, token_files, toxicity, whitening, word_lm
from ordermill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUALITY_KEPT = 0.3


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.selectExpr("*", f"CAST(score >= {QUALITY_KEPT} AS INT) AS predicted")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), digests=_sha256)
    return coded.selectExpr("doc_id", "n_tokens", "ids_text AS ids_sha256", "decoded AS decoded_sha256")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = (pii.count_of(kind).alias(f"n_{name}") for kind, name in enumerate(pii.KINDS))
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents that labels mark as good."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return word_lm.word_cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    spans = "array_join(transform(spans, s -> concat(s.start, ':', s.end)), ',') AS spans"
    return scores.selectExpr("doc_id", "held_out", "score", "CAST(score >= 0.5 AS INT) AS predicted", spans)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond 64 bits is null."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(secrets.labelled(docs)))
    counts = (secrets.count_of(kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3])
    return found.select("doc_id", *counts, F.sha2(secrets.written("base"), 256).alias("base_sha256"), secrets.written("spans").alias("spans"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"), digest=_sha256)
    return aligned.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_token_files": op2_token_files,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_passages": op7_passages,
    "op8_lm_score": op8_lm_score,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_secrets": op12_secrets,
    "op13_alignment": op13_alignment,
}
# Only the exact join has a result that SQL can state; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words
),
classes AS (SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL),
members AS (SELECT rep, n, unnest(s) AS g FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM members a JOIN members b ON a.g = b.g AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (
  SELECT rep AS a, rep AS b FROM classes
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN roots USING (rep)""",
}
