"""The quality classifier against plain matrices over all labelled rows at once."""

import zlib

import numpy as np
import pytest

from ordermill.llm import entries, quality
from ordermill.llm.common import table

SF = "/root/testdata/sf0.01"


def rising(good, counts):
    """Isotonic means by their minimax formula."""
    n = len(good)
    mean = [[sum(good[a : b + 1]) / sum(counts[a : b + 1]) if a <= b else None for b in range(n)] for a in range(n)]
    return [max(min(mean[a][b] for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


def test_scores_are_those_of_plain_matrices(spark):
    measured = {r.doc_id: [r[s] for s in quality.STATISTICS] for r in quality.measured(table(spark, SF, "documents")).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect() if r.quality is not None and r.doc_id in measured}
    fold = {d: zlib.crc32(str(d).encode()) % 5 for d in measured}
    taught = [d for d in labels if fold[d]]
    x, y, folds = np.array([measured[d] for d in taught]), np.array([labels[d] for d in taught], float), np.array([fold[d] for d in taught])
    kernel = quality.Kernel(x.mean(axis=0), x.std(axis=0))
    z = kernel(x)

    def ridge_fit(rows, ridge):
        penalty = np.diag([*[ridge] * (z.shape[1] - 1), 1e-6])
        return np.linalg.solve(z[rows].T @ z[rows] + penalty, z[rows].T @ y[rows])

    left_out = []
    for ridge in quality.RIDGES:
        scores = np.zeros(len(y))
        for f in quality.FOLDS:
            scores[folds == f] = z[folds == f] @ ridge_fit(folds != f, ridge)
        left_out.append(scores)
    best = int(np.argmin([((s - y) ** 2).sum() for s in left_out]))
    cells = quality._cell(left_out[best])
    kinds = np.unique(cells)
    good, counts = ([float(f(cells == c)) for c in kinds] for f in (lambda m: y[m].sum(), lambda m: m.sum()))
    values = np.array(rising(good, counts))
    # Cells of one value are one knot, at their mean.
    runs = np.split(np.arange(len(kinds)), np.flatnonzero(np.diff(values) > 1e-12) + 1)
    knots = [np.average(kinds[r], weights=np.array(counts)[r]) for r in runs], [values[r[0]] for r in runs]
    every = sorted(measured)
    raw = kernel(np.array([measured[d] for d in every])) @ ridge_fit(np.ones(len(y), bool), quality.RIDGES[best])
    expected = np.clip(np.interp((raw - quality.LOW) / (quality.HIGH - quality.LOW) * quality.GRID, *knots), 0, 1)
    found = {r.doc_id: r.score for r in entries.op1_quality(spark, SF).collect()}
    assert [found[d] for d in every] == pytest.approx(expected.tolist(), abs=1e-6)
