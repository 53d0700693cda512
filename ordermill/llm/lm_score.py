"""Cross-entropy difference of two matched n-gram models.

Both models count the same ``ORDER``-grams over one vocabulary, the most frequent characters of the
corpus, with an unknown and a boundary symbol; both are smoothed alike (Witten-Bell, down to the
uniform distribution). The target model counts the target documents, the background model all
documents. A document's score is the mean over its tokens, the closing boundary included, of
the target's loss less the background's: the lower, the more it is like the target.

Counts cover the whole corpus: tasks count their share, Spark sums by n-gram. ``SYMBOLS ** ORDER``
bounds what the driver gets and broadcasts, 2.6 million numbers, at every size of input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import sized, slices, texts, tidy

SYMBOLS, ORDER = 40, 4
UNKNOWN, BOUNDARY = 0, 1
CODE_POINTS = 0x110000
SCORE_SCHEMA = "doc_id bigint, n_tokens bigint, score double"


def code_points(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the lower-cased texts in a row, and the length of each text."""
    texts = [(x or "").lower() for x in part.column("text").to_pylist()]
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return joined, np.array([len(x) for x in texts], np.int64)


def _count_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CODE_POINTS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            joined, _ = code_points(part)
            found = np.bincount(joined)
            counts[: len(found)] += found
    seen = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["c", "n"])


def vocabulary(given: DataFrame) -> list[int]:
    """The most frequent characters of all documents; ties go to the smaller code point."""
    counts = given.mapInArrow(tidy(_count_characters), "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    return [r.c for r in counts.orderBy(F.desc("n"), "c").limit(SYMBOLS - 2).collect()]


def _lookup(characters: list[int]) -> np.ndarray:
    table = np.full(CODE_POINTS, UNKNOWN, np.int64)
    table[characters] = np.arange(2, 2 + len(characters))
    return table


def gram_ids(joined: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each token; per document its characters and a closing boundary.
    Before the first character stand boundaries."""
    pad = ORDER - 1
    # Every document: pad boundaries, its symbols, one boundary.
    starts = np.cumsum([0, *(lengths + pad + 1)])[:-1]
    total = int(lengths.sum()) + len(lengths) * (pad + 1)
    line = np.full(total, BOUNDARY, np.int64)
    inside = np.ones(total, bool)
    for k in range(pad):
        inside[starts + k] = False
    token = inside.copy()
    inside[starts + pad + lengths] = False
    line[inside] = table[joined]
    ids = line.copy()
    for k in range(1, ORDER):
        ids[k:] += line[:-k] * SYMBOLS**k
    return ids[token]


def _count_grams(characters: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, size = _lookup(characters), SYMBOLS**ORDER
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                joined, lengths = code_points(part)
                ids = gram_ids(joined, lengths, table)
                target = np.repeat(part.column("target").to_numpy(zero_copy_only=False).astype(bool), lengths + 1)
                counts[0] += np.bincount(ids, minlength=size)
                counts[1] += np.bincount(ids[target], minlength=size)
        seen = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(seen.astype(np.int32)), *(pa.array(c[seen]) for c in counts)], names=["gram", "background", "target"])

    return run


def losses(counts: np.ndarray) -> np.ndarray:
    """Minus the logarithm of each n-gram's smoothed probability, from the counts of all."""
    grams = counts.reshape((SYMBOLS,) * ORDER).astype(np.float64)
    tables = [grams]
    for _ in range(ORDER - 1):
        tables.append(tables[-1].sum(axis=0))
    probability = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for table in reversed(tables):
        seen = table.sum(axis=-1, keepdims=True)
        kinds = np.maximum((table > 0).sum(axis=-1, keepdims=True), 1)
        probability = (table + kinds * probability) / (seen + kinds)
    return -np.log(probability).ravel()


def _score(characters: list[int], difference) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, by_gram = _lookup(characters), difference.value
        for batch in batches:
            for part in slices(batch, "text"):
                joined, lengths = code_points(part)
                if not len(lengths):
                    continue
                values = by_gram[gram_ids(joined, lengths, table)]
                tokens = lengths + 1
                sums = np.add.reduceat(values, np.cumsum(tokens) - tokens)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(tokens), pa.array(sums / tokens)], names=["doc_id", "n_tokens", "score"]
                )

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` of every row of ``docs``.

    ``target_ids`` has the column doc_id; repeated or null ids there change nothing. A null text counts
    and scores as an empty one, whose one token is its boundary. Without target documents that
    model is the uniform distribution. Rows that repeat count as often as they stand there.
    """
    spark = docs.sparkSession
    given = texts(docs)
    characters = vocabulary(given)
    chosen = target_ids.selectExpr("CAST(doc_id AS BIGINT) AS doc_id").distinct().withColumn("target", F.lit(True))
    marked = _with_flag(given, chosen)
    counts = (
        marked.mapInArrow(tidy(_count_grams(characters)), "gram int, background bigint, target bigint")
        .groupBy("gram").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
        .toArrow()
    )
    at = counts.column("gram").to_numpy()
    dense = np.zeros((2, SYMBOLS**ORDER), np.int64)
    for k, name in enumerate(("background", "target")):
        dense[k][at] = counts.column(name).to_numpy()
    difference = spark.sparkContext.broadcast(losses(dense[1]) - losses(dense[0]))
    return given.mapInArrow(tidy(_score(characters, difference)), SCORE_SCHEMA)


def _with_flag(given: DataFrame, chosen: DataFrame) -> DataFrame:
    """``given`` with the column target."""
    return given.join(sized(chosen), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
