"""From documents to token ids: five stages, each an operator of ``ordermill.llm`` over whole tables.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and reads
again as the next stage's docs. All but the last return the columns of ``documents``. Ids of documents
that go are broadcast if their size allows it and joined by a shuffle otherwise; texts otherwise stay
where they are. Rows without doc_id are never rejected, as no decision can name them; a null text
counts as empty; an empty table passes through. Columns beside those that a stage reads may have any
names; long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import bpe, decontaminate, jaccard_join, pii, quality
from ordermill.llm.common import repeated_ids, sized, table
from ordermill.operators.storage import scratch_path, temporary

QUALITY_KEPT = 0.3
SHINGLE, SIMILARITY = 5, (80, 100)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(sized(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``QUALITY_KEPT``; of rows that repeat an id, the
    best decides for all."""
    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    best = scores.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("score").alias("score"))
    return _without(docs, best.where(F.col("score") < QUALITY_KEPT))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest id. Of rows that repeat id and text one stays, the
    first by the text of all its columns; rows without an id all stay."""
    found = jaccard_join.jaccard_components(docs, SHINGLE, *SIMILARITY)
    kept = _without(docs, found.where("component_id <> doc_id"))
    if not repeated_ids(found):
        return kept
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    named = kept.where("doc_id IS NOT NULL").groupBy("doc_id", "text").agg(F.min_by(row, F.to_json(row)).alias("r"))
    return named.select("r.*").union(kept.where("doc_id IS NULL"))


def keep_off_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item stands."""
    return _without(docs, decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    found = pii.find(docs, pii.train(docs), "__base", "__spans")
    found = found.withColumn("text", pii.redacted(F.col("text"), "__spans"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.size("__spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed)
    return found.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids as text and the text that they decode to."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", keep_off_benchmark),
    ("PII", redact),
    ("BPE encoding and decoding", encode),
]

# Training, similarity of sets and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
