"""Quality classifier: random Fourier features over document statistics, ridge, isotonic scores.

The features approximate a Gaussian kernel: ``sqrt(2 / D) cos(W x + b)`` of the standardised
statistics ``x``. Tasks sum the normal equations of their labelled rows by training fold, Spark sums
the tasks' sums cell by cell, and the driver solves systems of ``D + 1`` unknowns: one per fold left out,
whose scores choose the ridge and calibrate, and one of all folds. Calibration pools adjacent
violators over a fixed grid of scores, so it too sees all labelled rows as sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored, fold, slices, texts, texts_of, tidy

STATISTICS = (
    "log_words log_bytes word_length letters digits blanks symbols capitals odd_word_ends distinct_words"
    " distinct_rate top_word repeated_lines lines_per_word byte_entropy longest_word short_words repeats"
    " lone_symbols title_words"
).split()
FEATURES, WIDTH, SEED = 160, 0.06, 20_240_601
RIDGES = (1e-1, 1.0, 10.0, 100.0)
GRID, LOW, HIGH = 2_000, -0.5, 1.5
FOLDS = (1, 2, 3, 4)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT, _UPPER, _LETTER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58], _UPPER[65:91] = True, True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL = ~(_SPACE | _DIGIT | _LETTER)
_USUAL_END = _DIGIT | _LETTER
_USUAL_END[[ord(c) for c in ".,;:?"]] = True


def statistics(text: bytes) -> list[float]:
    """Numbers about a whole text; all are 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text, np.uint8)
    counts = np.bincount(raw, minlength=256)
    size, n = len(raw), len(words)
    gap = np.concatenate([[True], _SPACE[raw], [True]])
    starts, ends = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
    lengths, first, last = ends - starts, raw[starts], raw[ends - 1]
    often = Counter(words)
    lines = [x for x in text.split(b"\n") if x]
    share = counts[counts > 0] / size
    letters = int(counts[_LETTER].sum())
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        math.log1p(n), math.log1p(size), float(lengths.mean()), letters / size, counts[_DIGIT].sum() / size,
        counts[_SPACE].sum() / size, counts[_SYMBOL].sum() / size, counts[_UPPER].sum() / max(1, letters),
        float((~_USUAL_END[last]).mean()), len(often) / n, math.log(len(often)) / math.log(n + 1),
        max(often.values()) / n, 1 - len(set(lines)) / len(lines), len(lines) / n,
        float(-(share * np.log(share)).sum()), math.log(float(lengths.max())), float((lengths <= 3).mean()),
        same / n, float(((lengths == 1) & _SYMBOL[first]).mean()), float((_UPPER[first] & (lengths > 1)).mean()),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = [statistics(text) for text in texts_of(part)]
            columns = np.array(rows, np.float64).reshape(-1, len(STATISTICS)).T
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, columns)], names=["doc_id", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every whole text; of a null text those of an empty one."""
    given = texts(docs)
    return given.mapInArrow(tidy(_measure), "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


class Kernel:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, 1 / np.where(spread > 1e-9, spread, 1.0)
        self.waves = draw.normal(size=(len(STATISTICS), FEATURES)) * math.sqrt(2 * WIDTH)
        self.shift = draw.uniform(0, 2 * math.pi, FEATURES)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) * self.scale, -6, 6)
        z = math.sqrt(2 / FEATURES) * np.cos(x @ self.waves + self.shift)
        return np.concatenate([z, np.ones((len(rows), 1))], axis=1)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS], axis=1)


def _equations(kernel: Kernel) -> Callable:
    """Sums of z z' and z y of a task's rows: (fold, i, j, value), where j = D + 1 is the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                z, y, k = kernel(_rows(batch)), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
                for f in np.unique(k):
                    own = z[k == f]
                    sums[f] = sums.get(f, 0) + own.T @ np.concatenate([own, y[k == f, None]], axis=1)
        i, j = np.triu_indices(size, 0, size + 1)
        for f, total in sums.items():
            yield pa.record_batch(
                [pa.array(np.full(len(i), f, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                names=["fold", "i", "j", "value"],
            )

    return run


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    a, b = sums[:, :-1], sums[:, -1]
    a = np.triu(a) + np.triu(a, 1).T
    penalty = np.full(len(a), ridge)
    penalty[-1] = 1e-6
    return np.linalg.solve(a + np.diag(penalty), b)


def _binned(kernel: Kernel, weights: dict[tuple[int, int], np.ndarray]) -> Callable:
    """Labelled rows to (ridge, cell of the score by the model without the row's fold, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z, y, k = kernel(_rows(batch)), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for r in range(len(RIDGES)):
                scores = np.choose([FOLDS.index(f) for f in k], [z @ weights[f, r] for f in FOLDS])
                yield pa.record_batch(
                    [pa.array(np.full(len(y), r, np.int32)), pa.array(_cell(scores)), pa.array(y.astype(np.int64)), pa.array((scores - y) ** 2)],
                    names=["ridge", "cell", "label", "loss"],
                )

    return run


def _cell(scores: np.ndarray) -> np.ndarray:
    return np.clip((scores - LOW) / (HIGH - LOW) * GRID, 0, GRID - 1).astype(np.int32)


def isotonic(cells: np.ndarray, positives: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising calibration, cell and probability."""
    blocks: list[list[float]] = []
    for cell, good, n in zip(cells, positives, counts):
        blocks.append([cell * n, good, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _apply(kernel: Kernel, weights: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = kernel(_rows(batch)) @ weights
            scores = np.interp((raw - LOW) / (HIGH - LOW) * GRID, *knots)
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.clip(scores, 0.0, 1.0))], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` (0 to 1, higher: label 1 likelier) of every row of ``docs``.

    ``labels`` has doc_id and quality; the model learns from rows whose crc32(doc_id) mod 5 is not
    0, and from the texts' statistics alone. Rows without label or id teach nothing; a document with
    several labels counts once per label. Without any labelled row every score is 0.5. A row
    without id has held_out null.
    """
    spark = docs.sparkSession
    stored, last = Stored(spark), Stored(spark)
    rows = stored.put(measured(docs), "statistics")
    taught = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    taught = taught.where("label IS NOT NULL").withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0").distinct()
    taught = stored.put(rows.join(taught, "doc_id"), "taught")
    moments = taught.agg(
        F.count("*"), *(F.avg(s) for s in STATISTICS), *(F.stddev_pop(s) for s in STATISTICS)
    ).head()
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    if not moments[0]:
        return rows.select("doc_id", held_out, F.lit(0.5).alias("score"))
    k = len(STATISTICS)
    kernel = Kernel(np.array(moments[1 : k + 1]), np.array(moments[k + 1 :]))
    cells = (
        taught.mapInArrow(tidy(_equations(kernel)), "fold int, i int, j int, value double")
        .groupBy("fold", "i", "j").agg(F.sum("value").alias("value")).toArrow()
    )
    sums = np.zeros((5, FEATURES + 1, FEATURES + 2))
    at = [cells.column(c).to_numpy() for c in ("fold", "i", "j")]
    sums[at[0], at[1], at[2]] = cells.column("value").to_numpy()
    total = sums.sum(axis=0)
    weights = {(f, r): _solve(total - sums[f], ridge) for f in FOLDS for r, ridge in enumerate(RIDGES)}
    binned = (
        taught.mapInArrow(tidy(_binned(kernel, weights)), "ridge int, cell int, label bigint, loss double")
        .groupBy("ridge", "cell").agg(F.sum("label").alias("good"), F.count("*").alias("n"), F.sum("loss").alias("loss"))
        .orderBy("ridge", "cell").collect()
    )
    loss = [sum(b.loss for b in binned if b.ridge == r) for r in range(len(RIDGES))]
    best = int(np.argmin(loss))
    own = [b for b in binned if b.ridge == best]
    knots = isotonic(*(np.array([b[c] for b in own], np.float64) for c in ("cell", "good", "n")))
    scored = rows.mapInArrow(tidy(_apply(kernel, _solve(total, RIDGES[best]), knots)), "doc_id bigint, score double")
    result = last.put(scored.select("doc_id", held_out, "score"), "quality")
    stored.drop()
    return result
