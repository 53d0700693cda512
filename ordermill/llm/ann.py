"""Approximate nearest neighbours by cosine: inverted lists with adaptive dimension scans.

Centroids and the number of lists to probe are fitted on a bounded sample; every vector is indexed.
Vectors are scaled to length one and turned by a random rotation, after which any first d coordinates
estimate the whole distance. Within a list they lie in blocks of columns. A scan adds up one block
after another and, after each, tests the hypothesis that a candidate is nearer than the query's
k-th best so far; a candidate that fails is abandoned. What is left is measured exactly.

A list of any length is cut into blocks of rows, and the queries that probe a block into chunks, so a
task holds a bounded number of both: a vector that a third of all rows repeat fills many blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordermill.llm.common import Stored, tidy

SAMPLE, PER_LIST, TRIALS, LISTS, ROUNDS, RECALL = 20_000, 20, 200, 16_384, 12, 0.98
COLUMNS, DOUBT, SLACK = 16, 2.1, 1e-9
BLOCK_ROWS, CHUNK_QUERIES = 20_000, 5_000
SEED = 20_240_602
FOUND = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither vanish nor overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Of original vectors in double precision, each row on its own, so equal rows score alike."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    query = query / np.abs(query).max()
    lengths = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum())
    return (rows * query).sum(axis=1) / lengths


def owners(sample: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each vector, some vectors at a time."""
    parts = (sample[k : k + 2_000] @ centres.T for k in range(0, len(sample), 2_000))
    return np.concatenate([p.argmax(axis=1) for p in parts]) if len(sample) else np.empty(0, np.int64)


def centroids_of(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    draw = np.random.default_rng(SEED)
    distinct = np.unique(sample, axis=0)
    centres = distinct[draw.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        owner = owners(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        length = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(length[:, None] > 1e-12, sums / np.maximum(length, 1e-12)[:, None], centres)
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many lists hold that share of the true neighbours of trial queries within the sample."""
    owner = owners(sample, centres)
    step = max(1, len(sample) // TRIALS)
    ranks = []
    for i in range(0, len(sample), step):
        near = sample @ sample[i]
        near[i] = -np.inf
        best = np.argsort(-near, kind="stable")[:k]
        place = np.empty(len(centres), np.int64)
        place[np.argsort(-(centres @ sample[i]), kind="stable")] = np.arange(len(centres))
        ranks.extend(place[owner[best]])
    if not ranks:
        return len(centres)
    return min(len(centres), int(np.quantile(ranks, recall, method="higher")) + 1)


def scan(query: np.ndarray, blocks: list[np.ndarray], first: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the k nearest, from squared distances over the first block on."""
    size = sum(b.shape[1] for b in blocks)
    alive, partial, seen = np.arange(len(first)), first, blocks[0].shape[1]
    if len(first) > k:
        nearest = np.argpartition(first, k - 1)[:k]
        whole = np.zeros(k)
        at = 0
        for b in blocks:
            whole += ((b[nearest] - query[at : at + b.shape[1]]) ** 2).sum(axis=1)
            at += b.shape[1]
        limit = whole.max() + SLACK
    else:
        return alive
    for b in blocks[1:]:
        keep = partial * (size / seen) <= limit * (1 + DOUBT / np.sqrt(seen)) ** 2
        alive, partial = alive[keep], partial[keep]
        partial = partial + ((b[alive] - query[seen : seen + b.shape[1]]) ** 2).sum(axis=1)
        seen += b.shape[1]
    return alive[partial <= limit]


def _search(k: int, rotation: np.ndarray) -> Callable:
    size = len(rotation)
    cuts = list(range(0, size, COLUMNS))

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if candidates.num_rows and queries.num_rows:
            ids = candidates.column("vec_id").to_numpy()
            rows = _matrix(candidates.column("vec").combine_chunks(), size)
            turned = _unit(rows) @ rotation
            blocks = [np.ascontiguousarray(turned[:, a : a + COLUMNS]) for a in cuts]
            lengths = (blocks[0] ** 2).sum(axis=1)
            wanted = queries.column("query_id").to_numpy()
            asked = _matrix(queries.column("vec").combine_chunks(), size)
            looked = _unit(asked) @ rotation
            for at in range(0, len(wanted), 64):
                head = looked[at : at + 64, :COLUMNS]
                first = np.maximum((head**2).sum(axis=1)[:, None] + lengths - 2 * head @ blocks[0].T, 0.0)
                for i, distances in enumerate(first, at):
                    # The query itself may be a row here: one neighbour more is looked for.
                    alive = scan(looked[i], blocks, distances, k + 1)
                    alive = alive[ids[alive] != wanted[i]]
                    scores = cosines(rows[alive], asked[i]) if len(alive) else np.empty(0)
                    best = np.lexsort((ids[alive], -scores))[:k]
                    out["query_id"] += [int(wanted[i])] * len(best)
                    out["vec_id"] += ids[alive[best]].tolist()
                    out["score"] += scores[best].tolist()
        return pa.table(
            {"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())}
        )

    return run


def _lists(centres: np.ndarray, probes: int, name: str) -> Callable:
    """Adds the ``probes`` nearest lists of every vector, as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                near = -(_unit(_matrix(part.column("vec"), centres.shape[1])) @ centres.T)
                best = np.argsort(near, axis=1, kind="stable")[:, :probes]
                lists = pa.array(list(best.astype(np.int32)), pa.list_(pa.int32()))
                yield pa.record_batch([*part.columns, lists], names=[*part.schema.names, name])

    return run


def usable(vec: Column) -> Column:
    """Whether a vector has only finite components and one that is not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k nearest found for each query.

    Both tables have vec_id and embedding (an array of numbers). Score is the cosine of the original vectors;
    ties go to the smaller vec_id. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do those of another length than most. A query finds no row
    of its own vec_id. Rows that repeat a vec_id are candidates each; of queries that repeat one, the
    smallest vector asks. Fewer candidates than k give fewer rows, an empty table none. Other columns are
    not read, whatever their names. The index is fitted on about ``SAMPLE`` vectors, or ``PER_LIST`` per
    list where that is more; there are as many lists as the root of the number of vectors, ``LISTS`` at most.
    """
    spark = vectors.sparkSession
    stored, last = Stored(spark), Stored(spark)

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
        return df.where(usable(F.col("vec")) & F.col("vec_id").isNotNull())

    rows = clean(vectors)
    common = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").head()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = common["size"]
    rows, asked = rows.where(F.size("vec") == size), clean(queries).where(F.size("vec") == size)
    asked = asked.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    # As many lists as a list has vectors, so that the work of a query grows with the root of the table.
    lists = max(1, min(LISTS, int(common["count"] ** 0.5)))
    wanted = max(SAMPLE, PER_LIST * lists)
    share = max(1, min(1 << 20, (wanted << 20) // common["count"]))
    sample = rows.where(f"pmod(xxhash64(vec_id), {1 << 20}) < {share}").limit(2 * wanted).orderBy("vec_id").toArrow()
    if not sample.num_rows:
        sample = rows.orderBy("vec_id").limit(wanted).toArrow()
    units = _unit(_matrix(sample.column("vec").combine_chunks(), size))
    centres = centroids_of(units, lists)
    probes = probes_needed(units, centres, k, recall)
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))[0]

    schema = "vec_id bigint, vec array<double>, lists array<int>"
    indexed = rows.mapInArrow(tidy(_lists(centres, 1, "lists")), schema).select("vec_id", "vec", F.col("lists")[0].alias("list"))
    indexed = stored.put(indexed, "lists")
    # One row per list, ``LISTS`` at most; rows per block and queries per chunk follow from them.
    probed = stored.put(
        asked.mapInArrow(tidy(_lists(centres, probes, "lists")), schema).select(F.col("vec_id").alias("query_id"), "vec", F.explode("lists").alias("list")),
        "probes",
    )
    per_list = indexed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    per_probe = probed.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("chunks"))
    cells = F.broadcast(per_list.join(per_probe, "list"))
    cell = ["list", "block", "chunk"]
    left = (
        indexed.join(cells, "list").withColumn("block", F.expr("pmod(xxhash64(vec_id), blocks)").cast("int"))
        .withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).select(*cell, "vec_id", "vec")
    )
    right = (
        probed.join(cells, "list").withColumn("chunk", F.expr("pmod(xxhash64(query_id), chunks)").cast("int"))
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*cell, "query_id", "vec")
    )
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_search(k, rotation), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    result = last.put(ranked.select("query_id", "rank", "vec_id", "score"), "neighbours")
    stored.drop()
    return result
