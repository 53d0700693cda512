"""N-gram Jaccard join with count-vector R-trees; exact.

Shingles are hashed into ``GROUPS`` groups; a document's counts per group are a point. The sum of
the coordinate minima of two points bounds the overlap of their sets from above, and so does the
sum against the upper corner of an R-tree node, for all points below it.

1. Every document gives its shingle count, a digest of its set, its point and its prefix: the
   rarest ``n - ceil(t n) + 1`` shingles. Two linked sets share a shingle of both prefixes,
   whatever order "rare" means, as long as it is one order; so the frequent shingles that shape the
   order may come from a sample.
2. Documents with equal sets are one class; its smallest id goes on.
3. The classes that share a prefix shingle are a block. Its R-tree finds the pairs whose bound
   reaches the overlap that a link needs; of these only a spanning forest is kept, so what leaves a
   block is linear in its rows. The forests' components are the candidate groups.
4. Each document of a group sends its shingle set there once. Pairs that the tree leaves over are
   verified, except between documents that verified links connect already.

Blocks and groups beyond a cell's size are split: first every row is compared with the smallest id,
the hub; rows near it need not be compared with each other, as the hub connects them. The others, the
far rows, are cut into chunks and meet every chunk of the block, each pair of chunks as a cell.

Long texts fill all groups alike, so their points say little. Where the sets are at hand, a second point
of ``FINE`` groups is counted from them on the spot, and its bound comes before the verification.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored, repeated_ids, sized, slices, texts, texts_of, tidy
from ordermill.llm.graph import components
from ordermill.llm.shingles import WordHashes, shingle_set
from ordermill.operators.joins import BROADCAST_BYTES

GROUPS, FINE, FANOUT = 128, 1_024, 32
CELL_ROWS, CELL_SHINGLES = 4_096, 16_000_000
ROW_WEIGHT = 400  # of a set besides its shingles, mostly its points, so that a cell of short ones is bounded too
VERIFIED = 1 << 18  # shingles of sets that are compared with one set at a time
SAMPLE_DOCS, FREQUENT = 20_000, 100_000
_FULL = 255  # a coordinate that stands for any larger one

SIGNED = "doc_id bigint, n int, digest binary, point binary, keys array<bigint>"


class Similarity:
    """``den * |A and B| >= num * |A or B|`` in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def needed(self, sizes, other):
        """The least overlap of linked sets of these sizes."""
        return -(-self.num * (sizes + other) // (self.num + self.den))

    def least_size(self, size):
        return -(-self.num * size // self.den)

    def prefix(self, size: int) -> int:
        return size - self.least_size(size) + 1


def point_of(shingles: np.ndarray) -> bytes:
    counts = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, _FULL).astype(np.uint8).tobytes()


def points_of(column: list[bytes]) -> np.ndarray:
    points = np.frombuffer(b"".join(column), np.uint8).reshape(-1, GROUPS).astype(np.int32)
    points[points == _FULL] = 1 << 24
    return points


def fine_points(sets: list[np.ndarray]) -> np.ndarray:
    """Counts per fine group; 16 bits hold any that a set of less than 60 million shingles has."""
    points = np.zeros((len(sets), FINE), np.uint16)
    for row, shingles in enumerate(sets):
        points[row] = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % FINE, minlength=FINE)
    return points


class CountTree:
    """An R-tree over points with sizes, packed by size and then by the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, similarity: Similarity):
        self.similarity = similarity
        order = np.argsort(sizes, kind="stable")
        if len(order) > FANOUT:
            widest = int(points.var(axis=0).argmax())
            slab = FANOUT * max(1, round((len(order) / FANOUT) ** 0.5))
            order = np.concatenate(
                [s[np.argsort(points[s, widest], kind="stable")] for s in np.split(order, range(slab, len(order), slab))]
            )
        self.order, self.levels = order, []
        high, low_n, high_n = points[order], sizes[order], sizes[order]
        self.levels.append((high, low_n, high_n))
        while len(high) > FANOUT:
            cut = np.arange(0, len(high), FANOUT)
            high = np.maximum.reduceat(high, cut)
            low_n, high_n = np.minimum.reduceat(low_n, cut), np.maximum.reduceat(high_n, cut)
            self.levels.append((high, low_n, high_n))

    def near(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose bound reaches the overlap that a link with this point needs."""
        at = np.arange(len(self.levels[-1][0]))
        least = self.similarity.least_size(size)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low_n, high_n = (x[at] for x in self.levels[depth])
            bound = np.minimum(high, point).sum(axis=1)
            fits = (high_n >= least) & (self.similarity.least_size(low_n) <= size)
            at = at[fits & (bound >= self.similarity.needed(np.maximum(low_n, least), size))]
            if depth:
                below = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = below[below < len(self.levels[depth - 1][0])]
        return self.order[at]


def overlaps(shingles: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted set with others, none of them empty."""
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(shingles, joined), len(shingles) - 1)
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat((shingles[at] == joined).astype(np.int64), starts)


def forest(
    points: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray] | None, probes: np.ndarray, targets: np.ndarray,
    near: np.ndarray, similarity: Similarity,
) -> Iterator[tuple[int, int]]:
    """Edges that connect all rows that links between ``probes`` and ``targets`` connect.

    Rows marked ``near`` are connected already. Without sets, a bound that suffices is a link.
    """
    label = np.arange(len(sizes))
    if near.any():
        label[near] = np.flatnonzero(near)[0]
    fine = fine_points(sets) if sets is not None else None
    where = np.flatnonzero(targets)
    tree = CountTree(points[where], sizes[where], similarity)
    for i in np.flatnonzero(probes):
        found = where[tree.near(points[i], sizes[i])]
        found = found[label[found] != label[i]]
        while len(found):
            # As many at once as their sets take little memory, however long they are.
            stop = max(1, int(np.searchsorted(np.cumsum(sizes[found]), VERIFIED)))
            some, found = found[:stop], found[stop:]
            if sets is not None:
                bound = np.minimum(fine[some], fine[i]).sum(axis=1, dtype=np.int64)
                some = some[bound >= similarity.needed(sizes[some], sizes[i])]
            if sets is not None and len(some):
                common = overlaps(sets[i], [sets[j] for j in some])
                some = some[common >= similarity.needed(sizes[some], sizes[i])]
            for j in some:
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    yield i, j
            found = found[label[found] != label[i]]


def signer(shingle: int, similarity: Similarity, frequent: np.ndarray, counts: np.ndarray) -> Callable:
    """Documents to ``SIGNED``. ``frequent``, ascending, with ``counts``, shapes the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, digests, points, keys = [], [], [], []
                for text in texts_of(part):
                    found = shingle_set(text, shingle, hashes)
                    sizes.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    points.append(point_of(found))
                    if len(frequent) and len(found):
                        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                        often = np.where(frequent[at] == found, counts[at], 0)
                        if often.any():
                            found = found[np.argsort(often, kind="stable")]
                    keys.append(found[: similarity.prefix(len(found))].view(np.int64) if len(found) else [])
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                     pa.array(points, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "digest", "point", "keys"],
                )

    return run


def frequent_shingles(given: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several documents of a bounded sample, with their counts there.

    They order the prefixes, which decides the work and not the result. At most ``FREQUENT`` come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(text, shingle, hashes) for text in texts_of(part)]
                keys, counts = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    share = max(1, min(1 << 20, (SAMPLE_DOCS << 20) // max(1, given.count())))
    sample = given.where(f"pmod(xxhash64(doc_id), {1 << 20}) < {share}")
    rows = (
        sample.mapInArrow(tidy(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where("n > 2")
        .orderBy(F.desc("n"), "key").limit(FREQUENT).collect()
    )
    keys = np.array([r.key for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r.n for r in rows], np.int64)[order]


def _near(similarity: Similarity, n: np.ndarray, points: np.ndarray, hub_n: np.ndarray, hub_points: np.ndarray) -> np.ndarray:
    """Whether the bound lets each row be linked with its hub."""
    return np.minimum(points, hub_points).sum(axis=1) >= similarity.needed(n, hub_n)


def _marker(similarity: Similarity) -> Callable:
    """Whether each row is near its block's hub, by the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hub_n = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "hub_n"))
            points, hubs = (points_of(batch.column(c).to_pylist()) for c in ("point", "hub_point"))
            keep = [c for c in batch.schema.names if not c.startswith("hub_")]
            near = _near(similarity, n, points, hub_n, hubs)
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(near)], names=[*keep, "near"])

    return run


def _array(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _cell_worker(similarity: Similarity) -> Callable:
    """Sorted rows of cells to the edges of each cell's forest."""

    names = ("rep", "n", "chunk", "near", "point", "shingles")

    def edges(key: tuple, cell: dict[str, list]) -> list[tuple[int, int]]:
        _, f, c = key
        reps, sizes = cell["rep"], np.array(cell["n"], np.int64)
        chunk, near = np.array(cell["chunk"]), np.array(cell["near"])
        probes, targets = ~near & (chunk == f), chunk == c
        if f < 0:  # an unsplit block
            probes, targets = ~near, np.ones(len(reps), bool)
        sets = list(map(_array, cell["shingles"])) if "shingles" in cell else None
        found = forest(points_of(cell.pop("point")), sizes, sets, probes, targets, near, similarity)
        return [(reps[i], reps[j]) for i, j in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Columns of one cell at a time; a set is one object, however many cells a task has.
        cell, at = {}, None
        out: list[tuple[int, int]] = []
        for batch in batches:
            heavy = "shingles" if "shingles" in batch.schema.names else "point"
            for part in slices(batch, heavy):
                keys = list(zip(*(part.column(n).to_pylist() for n in ("block", "f", "c"))))
                first = 0
                while first < len(keys):
                    last = first + 1
                    while last < len(keys) and keys[last] == keys[first]:
                        last += 1
                    if keys[first] != at:
                        out += edges(at, cell) if cell else []
                        cell, at = {n: [] for n in names if n in part.schema.names}, keys[first]
                    for name, column in cell.items():
                        column += part.column(name).slice(first, last - first).to_pylist()
                    first = last
            if len(out) > 50_000:
                yield _edge_batch(out)
                out = []
        out += edges(at, cell) if cell else []
        if out:
            yield _edge_batch(out)

    return run


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"])


def block_edges(
    weights: DataFrame, rows_of: Callable[[DataFrame, str, bool], DataFrame], marked_of: Callable[[DataFrame, DataFrame], DataFrame],
    weight: str, limit: int, similarity: Similarity, stored: Stored,
) -> DataFrame:
    """Edges (a, b) that connect, in every block, what links within the block connect.

    ``weights`` has a row with block and weight for all or parts of each block. ``rows_of(blocks, how,
    hubs)`` gives the rows (block, rep, hub, n, point and perhaps shingles) in the given blocks
    (``left_semi``) or in all others (``left_anti``), with ``hubs`` only those of hubs; ``marked_of(blocks,
    hubs)`` those in the given blocks with ``near``, whether they resemble their hub, whose columns are named
    ``hub_``. Blocks of up to
    ``limit`` are one cell. In the others every row, of the weight ``weight``, is marked as near its hub or
    far; a cell holds about twice ``limit`` at most, or two rows.
    """
    large = weights.groupBy("block").agg(F.sum("weight").alias("weight")).where(f"weight > {limit}")
    large = stored.put(large.select("block"), "large")
    some = large.head() is not None
    whole = rows_of(sized(large), "left_anti", False)
    kept = [c for c in whole.columns if c != "hub"]
    none = F.lit(-1)
    whole = whole.select(*kept, F.lit(False).alias("near"), none.alias("chunk"), none.alias("f"), none.alias("c"))
    if not some:
        return _solved(whole, similarity)
    light = [c for c in kept if c != "block"]
    hubs = rows_of(sized(large), "left_semi", True)
    hubs = hubs.select(*(F.col(c).alias("hub" if c == "rep" else f"hub_{c}") for c in light)).dropDuplicates(["hub"])
    # One hub per large block: few, but each may be a long document's set.
    hubs = stored.put(hubs, "hubs")
    size = sum((F.octet_length(c) for c in hubs.columns if c in ("hub_point", "hub_shingles")), F.lit(64))
    if (hubs.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        hubs = F.broadcast(hubs)
    marked = stored.put(marked_of(sized(large), hubs).select(*kept, "hub", "near"), "marked")
    close = marked.where("near AND rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    stats = (
        marked.groupBy("block")
        .agg(
            F.expr(f"sum(CASE WHEN near THEN 0L ELSE CAST({weight} AS BIGINT) END)").alias("far_weight"),
            F.expr(f"sum(CASE WHEN near THEN CAST({weight} AS BIGINT) ELSE 0L END)").alias("near_weight"),
            F.expr("count_if(NOT near)").alias("far_rows"),
        )
        .where("far_rows > 0")
        .selectExpr(
            "block", f"CAST(ceil(far_weight / {limit}) AS INT) AS fs", f"CAST(ceil(near_weight / {limit}) AS INT) AS ns"
        )
    )
    chunk = "CASE WHEN near THEN fs + pmod(xxhash64(rep), greatest(ns, 1)) ELSE pmod(xxhash64(rep), fs) END"
    places = """
        CASE WHEN near THEN transform(sequence(0, fs - 1), x -> struct(x AS f, chunk AS c))
             ELSE array_distinct(concat(
                 transform(sequence(chunk, fs + ns - 1), x -> struct(chunk AS f, x AS c)),
                 transform(sequence(0, chunk), x -> struct(x AS f, chunk AS c)))) END"""
    parts = (
        marked.drop("hub").join(sized(stats), "block")
        .withColumn("chunk", F.expr(f"CAST({chunk} AS INT)"))
        .withColumn("cell", F.explode(F.expr(places)))
        .select(*kept, "near", "chunk", "cell.f", "cell.c")
    )
    return close.union(_solved(whole.union(parts), similarity))


def _solved(cells: DataFrame, similarity: Similarity) -> DataFrame:
    # Not merged into fewer partitions, so that sorting them takes little memory.
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, "block", "f", "c").sortWithinPartitions("block", "f", "c", "rep")
    return dealt.mapInArrow(tidy(_cell_worker(similarity)), "a bigint, b bigint")


def _shingle_sets(shingle: int, similarity: Similarity | None = None) -> Callable:
    """Texts of a block to their sets; with the similarity, beside their hubs' sets, also whether they are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingle_set(text, shingle, hashes) for text in texts_of(part)]
                sizes, points = np.array([len(s) for s in sets], np.int64), list(map(point_of, sets))
                columns = [
                    part.column("block"), part.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(points, pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()), part.column("block"),
                ]
                names = ["block", "rep", "n", "point", "shingles", "hub"]
                if similarity:
                    hub_n, hubs = part.column("hub_n").to_numpy().astype(np.int64), points_of(part.column("hub_point").to_pylist())
                    near = _near(similarity, sizes, points_of(points), hub_n, hubs)
                    for i in np.flatnonzero(near):
                        common = overlaps(sets[i], [_array(part.column("hub_shingles")[int(i)].as_py())])
                        near[i] = common[0] >= similarity.needed(sizes[i], hub_n[i])
                    columns, names = [*columns, pa.array(near)], [*names, "near"]
                yield pa.record_batch(columns, names=names)

    return run


def jaccard_components(docs: DataFrame, shingle: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at white space; a set holds the distinct ``shingle``-word
    shingles, the whole sequence if there are fewer words. Two documents link when
    ``den * |A and B| >= num * |A or B|``; a component's id is its smallest doc_id. Null and empty texts
    have no shingles and link with nothing; a row without doc_id has the component null.
    Rows that repeat an id are one document. Other columns are not read.
    """
    spark, similarity = docs.sparkSession, Similarity(num, den)
    stored, last = Stored(spark), Stored(spark)
    given = texts(docs)
    signed = stored.put(
        given.mapInArrow(tidy(signer(shingle, similarity, *frequent_shingles(given, shingle))), SIGNED), "signed"
    )
    members = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored.put(members.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = members.join(sized(classes.select(F.col("rep").alias("doc_id")).distinct()), "doc_id", "left_semi")
    if repeated_ids(members):
        reps = reps.dropDuplicates(["doc_id", "digest"])
    reps = reps.withColumnRenamed("doc_id", "rep")

    # Blocks: one shuffle of the prefixes serves both the count and the join with it.
    keys = reps.select("rep", F.explode("keys").alias("block")).repartition("block")
    shared = keys.groupBy("block").agg(F.count("*").alias("rows"), F.min("rep").alias("hub")).where("rows > 1")
    shared = keys.join(shared.drop("rows"), "block")
    rows = shared.join(reps.select("rep", "n", "point"), "rep").select("block", "rep", "n", "point", "hub")
    rows = stored.put(rows, "blocks")
    sizes = stored.put(signed.select("doc_id", "n", "digest"), "sizes")
    stored.forget("signed")

    def rows_in(blocks: DataFrame, how: str, hubs: bool) -> DataFrame:
        return (rows.where("rep = hub") if hubs else rows).join(blocks, "block", how)

    def rows_marked(blocks: DataFrame, hubs: DataFrame) -> DataFrame:
        order = ["block", "rep", "n", "point", "hub", *[c for c in hubs.columns if c != "hub"]]
        both = rows_in(blocks, "left_semi", False).join(hubs, "hub").select(order)
        return both.mapInArrow(tidy(_marker(similarity)), "block bigint, rep bigint, n int, point binary, hub bigint, near boolean")

    bounds = block_edges(
        rows.select("block", F.lit(1).alias("weight")), rows_in, rows_marked, "1", CELL_ROWS, similarity, stored
    )
    groups = components(bounds.distinct(), stored)
    groups = groups.union(groups.select(F.col("root").alias("node"), "root").distinct())
    groups = stored.put(groups.select(F.col("node").alias("doc_id"), F.col("root").alias("block")), "groups")

    # Groups: the sets of their documents, computed again from the texts where they lie.
    columns = "block bigint, rep bigint, n int, point binary, shingles binary, hub bigint"

    def texts_in(blocks: DataFrame, how: str, hubs: bool) -> DataFrame:
        chosen = groups.where("doc_id = block") if hubs else groups
        return given.join(sized(chosen.join(blocks, "block", how)), "doc_id")

    def sets_of(blocks: DataFrame, how: str, hubs: bool) -> DataFrame:
        return texts_in(blocks, how, hubs).mapInArrow(tidy(_shingle_sets(shingle)), columns)

    def sets_marked(blocks: DataFrame, hubs: DataFrame) -> DataFrame:
        # The hub comes beside the text, so that a task needs one Python worker and not a second to compare.
        both = texts_in(blocks, "left_semi", False).join(hubs.withColumnRenamed("hub", "block"), "block")
        return both.mapInArrow(tidy(_shingle_sets(shingle, similarity)), f"{columns}, near boolean")

    weights = groups.join(sizes, "doc_id").select("block", (F.col("n") + ROW_WEIGHT).alias("weight"))
    links = block_edges(weights, sets_of, sets_marked, f"n + {ROW_WEIGHT}", CELL_SHINGLES, similarity, stored)
    roots = components(links, stored)

    named = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("root", "rep").alias("root"))
    result = sizes.join(named, "digest", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("root"))).otherwise(F.col("doc_id")).alias("component_id"),
    )
    result = last.put(result, "components")
    stored.drop()
    return result
