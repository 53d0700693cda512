"""Whitening of embeddings by principal components, with eigenvectors refined in mixed precision.

Entries become integers, so sums and centred products of all rows are exact: every task adds its own up
in numpy, Spark adds the tasks' as decimals, and the covariance that reaches the driver has no rounding
before its last step. Its eigenvectors are found in float32 and corrected by the iteration of Ogita
and Aishima, matrix products in extended precision that square the error every time. Eigenvalues that
are too close to be told apart at the current error are taken as a cluster, whose invariant subspace is
refined as a whole while a small problem of its own, shifted by the cluster's mean, turns its basis.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored, tidy

SCALE, OFFSET = 1024, 100_000
LIMIT = float(1 << 44)  # a scaled entry beyond it has no exact products here
COMPONENTS, ROUNDS, ROWS = 8, 30, 4_096
DIGITS = pa.decimal128(38, 0)
RESULT = "vec_id bigint, deviation decimal(38,0), whitened array<double>"


def usable(vec: Column) -> Column:
    """Whether a vector is not empty and holds only finite entries in range."""
    fine = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LIMIT))
    return F.coalesce(fine & (F.size(vec) > 0), F.lit(False))


def _scaled(column: pa.Array, size: int) -> np.ndarray:
    """floor(1024 c) of the rows; the offset of 100,000 changes sums but nothing that is centred."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(values * SCALE).astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors and dimension: rows and their sum."""
    found: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            own = batch.column("vec").filter(pa.array(sizes == size))
            n, total = found.get(size, (0, np.zeros(size, object)))
            found[size] = n + len(own), total + _scaled(own, size).sum(axis=0).astype(object)
    for size, (n, total) in found.items():
        yield pa.record_batch(
            [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(map(Decimal, total), DIGITS)],
            names=["size", "i", "n", "total"],
        )


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of integers without rounding, as Python integers.

    Floating-point products are exact while sums stay below 2**53; larger factors are split in two.
    """
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if top * 16 <= 1 << 53:
        step = max(16, (1 << 53) // max(1, top))
        parts = (a[k : k + step].T.astype(float) @ b[k : k + step].astype(float) for k in range(0, len(a), step))
        return sum((p.astype(np.int64).astype(object) for p in parts), np.zeros((a.shape[1], b.shape[1]), object))
    if np.abs(a).max() < np.abs(b).max():
        return exact_products(b, a).T
    high = a >> 22
    return exact_products(high, b) * (1 << 22) + exact_products(a - (high << 22), b)


def _products(size: int, middle: list[int]) -> Callable:
    """Per pair of dimensions, the sum of products of what is left when ``middle`` is taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = np.zeros((size, size), object), np.array(middle, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = _scaled(batch.slice(at, ROWS).column("vec"), size) - shift
                total += exact_products(rows, rows)
        i, j = np.triu_indices(size)
        yield pa.record_batch(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(Decimal, total[i, j]), DIGITS)], names=["i", "j", "total"]
        )

    return run


def ratio(top: int, bottom: int) -> np.longdouble:
    """A quotient of integers of any size in extended precision."""
    scaled = (top << 80) // bottom
    high = float(scaled)
    return (np.longdouble(high) + np.longdouble(float(scaled - int(high)))) / np.longdouble(2) ** 80


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of values that follow each other within ``gap``, where there are several."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a symmetric matrix, in its precision."""
    wide = np.longdouble
    size, scale = len(matrix), np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(size, wide), np.eye(size, dtype=wide)
    a = matrix.astype(wide) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    unit, norm, before = np.eye(size, dtype=wide), np.sqrt((a * a).sum()), np.inf
    for _ in range(ROUNDS):
        r = unit - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        # Norms of matrices in float64: they only bound which eigenvalues can be told apart.
        doubt = 2 * (np.linalg.norm(off.astype(float), 2) + float(norm) * np.linalg.norm(r.astype(float), 2))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > doubt
        clusters = _clusters(values, doubt)
        for c in clusters:  # a chain of close values is one cluster, its ends too
            apart[np.ix_(c, c)] = False
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ step
        for c in clusters:
            mean = values[c].mean()
            inner = x[:, c].T @ (a @ x[:, c]) - mean * (x[:, c].T @ x[:, c])
            width = np.abs(inner).max()
            if width > np.finfo(wide).eps:
                x[:, c] = x[:, c] @ np.linalg.eigh((inner / width).astype(float))[1].astype(wide)
        change = float(np.abs(step).max())
        # Steps fall by squares until rounding over the smallest gap is all that is left of them.
        if change < np.finfo(wide).eps * 4 or (change > before / 2 and change < 1e-6):
            break
        before = change
    for _ in range(2):
        x = x + x @ (unit - x.T @ x) / 2
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(size)])
    return values[order] * scale, x * sign


@dataclass
class Whitening:
    """What a fit leaves: exact means, and the leading components with their share of all variance.

    An entry x has the mean OFFSET + middle + rest / n. Components whose eigenvalue is zero
    to the precision of the matrix have the deviation None.
    """

    n: int
    middle: list[int]
    rest: list[int]
    axes: np.ndarray
    values: list[float]
    explained: list[float]

    @property
    def usable(self) -> list[bool]:
        floor = max(self.values, default=0.0) * len(self.middle) * 1e-15
        return [v > floor for v in self.values]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Means and principal components of all usable vectors of the most common length (of equally
    common ones, the shorter); None if there are none."""
    rows = _rows(vectors)
    lengths = rows.withColumn("size", F.size("vec")).drop("vec_id").mapInArrow(tidy(_sums), "size int, i int, n bigint, total decimal(38,0)")
    lengths = lengths.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    common = lengths.where("i = 0").orderBy(F.desc("n"), "size").head()
    if common is None:
        return None
    size, n = common["size"], common["n"]
    sums = [int(r.total) for r in lengths.where(F.col("size") == size).orderBy("i").collect()]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    products = rows.where(F.size("vec") == size).select("vec").mapInArrow(tidy(_products(size, middle)), "i int, j int, total decimal(38,0)")
    covariance = np.zeros((size, size), np.longdouble)
    for r in products.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        covariance[r.i, r.j] = covariance[r.j, r.i] = ratio(n * int(r.total) - rest[r.i] * rest[r.j], n * n)
    values, axes = eigen(covariance)
    k, trace = min(components, size), np.trace(covariance)
    share = [float(v / trace) if trace else 0.0 for v in values[:k]]
    return Whitening(n, middle, rest, axes[:, :k].astype(float), [float(v) for v in values[:k]], share)


def _rows(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rows.where(usable(F.col("vec")))


def deviations(rows: np.ndarray, model: Whitening) -> list[int]:
    """Sums over dimensions of (n x - S)**2, exact; ``rows`` without the middle."""
    rest = np.array(model.rest, object)
    top = model.n * int(np.abs(rows).max(initial=0)) + int(np.abs(rest).max(initial=0))
    if top * top * rows.shape[1] < 1 << 63:
        apart = model.n * rows - rest.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = model.n * rows.astype(object) - rest
    return (apart * apart).sum(axis=1).tolist()


def apply(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (see ``deviations``; null beyond 38 digits) and whitened, the coordinates of each
    usable vector of the fitted length on the components, over their standard deviations."""
    size = len(model.middle)
    middle, rest = np.array(model.middle, np.int64), np.array([r / model.n for r in model.rest])
    deviation = np.sqrt(np.array([v if ok else 1.0 for v, ok in zip(model.values, model.usable)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = _scaled(part.column("vec"), size) - middle
                white = ((rows - rest) @ model.axes) / deviation
                lists = [[w if ok else None for w, ok in zip(row, model.usable)] for row in white.tolist()]
                exact = [Decimal(d) if d < 10**38 else None for d in deviations(rows, model)]
                yield pa.record_batch(
                    [part.column("vec_id"), pa.array(exact, DIGITS), pa.array(lists, pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "whitened"],
                )

    return _rows(vectors).where(F.size("vec") == size).mapInArrow(tidy(run), RESULT)


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened coordinates' covariance minus the identity."""
    used = [k for k, ok in enumerate(model.usable) if ok]
    cells = [(i, j) for i in used for j in used if i <= j]
    if not cells:
        return None
    row = whitened.agg(*(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) for i, j in cells)).head()
    return max(abs(c - (i == j)) for c, (i, j) in zip(row, cells))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The whitened coordinates of every usable vector, fitted on all of them.

    ``vectors`` has vec_id and embedding, an array of numbers; an entry c counts as floor(1024 c) + 100,000.
    Returns a row per vector and component, from 1 by falling eigenvalue: vec_id, component, n (vectors),
    deviation (exact sum over dimensions of (n x - S)**2, as decimal; null beyond 38 digits), whitened,
    explained (share of all variance) and identity_error (of the whole result). Vectors that are null, empty or
    hold null, non-finite or huge entries (1024 c of 2**44 or more) take no part, nor do those of another length
    than most. Rows that repeat or lack a vec_id stay. Fewer dimensions give fewer components; one without
    variance has whitened null and is left out of identity_error, which is null if none is left. Other columns
    are not read; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(vectors, components)
    if model is None:
        return spark.createDataFrame([], schema)
    rows = Stored(spark).put(apply(vectors, model), "whitened")
    error = identity_error(rows, model)
    explained = F.array(*(F.lit(e) for e in model.explained))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("k")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
