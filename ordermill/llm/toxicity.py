"""Toxicity: a linear-chain conditional random field tags toxic words, documents follow from it.

Documents carry labels, words do not, so token labels are derived first: a word of a document
labelled toxic is a toxic token if the word is evidence, that is, if it stands in far more toxic than clean
documents, and in many different contexts there (copies of one text repeat their contexts).
The field has the states clean and toxic, a weight per evidence word, one for all other words, and
transitions; it is trained on windows of labelled tokens by gradient ascent.

Forward-backward gives each word's marginal. Other words all have one potential, so a run of g
of them is the g-th power of one 2 x 2 matrix; the recursions step from evidence word to evidence word,
through whole texts of any length, and texts without evidence need none. A document's score
is a logistic function of its expected number of toxic tokens, their density and the highest marginal.

Words, windows and the logistic function are fitted on a sample of at most ``MAX_DOCS`` labelled
documents, chosen by hashes of ids. Every word that passes the tests is evidence with a weight of its
own; the sample of documents bounds their number. The field learns from the first ``MAX_WINDOWS``
windows by hash and, for every evidence word, from the first ``WORD_WINDOWS`` that hold it, so none
is without a window.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import Stored, fold, slices, texts, tidy

MAX_DOCS, MAX_WINDOWS, WORD_WINDOWS, WINDOW = 20_000, 4_000, 8, 96
MIN_DOCS, MIN_CONTEXTS, MIN_Z, MIN_LOG_ODDS = 3, 3, 2.5, 1.5
STEPS, RATE, DECAY = 150, 0.2, 1e-3
_WORD = re.compile(r"[^\W\d_]+")
SPANS = "array<struct<start:int,end:int,marginal:double>>"
MEASURES = f"doc_id bigint, expected double, density double, highest double, spans {SPANS}"


def _texts(part: pa.RecordBatch) -> list[str]:
    return [x or "" for x in part.column("text").to_pylist()]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, clean documents) of a slice's labelled texts."""
    for batch in batches:
        for part in slices(batch, "text"):
            found = (Counter(), Counter())
            for text, label in zip(_texts(part), part.column("label").to_pylist()):
                found[label].update(set(_WORD.findall(text.lower())))
            words = list(found[1])  # words of clean documents alone are no evidence
            yield pa.record_batch(
                [pa.array(words, pa.string()), pa.array([found[1][w] for w in words], pa.int64()), pa.array([found[0][w] for w in words], pa.int64())],
                names=["word", "toxic", "clean"],
            )


def _count_contexts(words: set[str]) -> Callable:
    """(word, context, label, clean documents) where a candidate stands between its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen = set()
                for text, label in zip(_texts(part), part.column("label").to_pylist()):
                    found = _WORD.findall(text.lower())
                    if words.isdisjoint(found):
                        continue
                    for before, word, after in zip(["", *found], found, [*found[1:], ""]):
                        if word in words:
                            seen.add((word, xxhash.xxh3_64_intdigest(f"{before} {after}") >> 1, label))
                rows = list(seen)
                yield pa.record_batch(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())],
                    names=["word", "context", "label"],
                )

    return run


def evidence_words(taught: DataFrame, toxic: int, clean: int) -> list[str]:
    """Words that tell toxic from clean documents, the strongest first."""
    counts = taught.mapInArrow(tidy(_count_words), "word string, toxic bigint, clean bigint").groupBy("word")
    odds = (
        f"ln((toxic + 0.5) / ({toxic} - toxic + 0.5)) - ln((clean + 0.5) / (greatest({clean} - clean, 0) + 0.5))"
    )
    rows = (
        counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(f"toxic >= {MIN_DOCS}")
        .withColumn("z", F.expr(f"({odds}) / sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))"))
        .where(f"z >= {MIN_Z}").select("word").collect()
    )
    if not rows:
        return []
    contexts = taught.mapInArrow(tidy(_count_contexts({r.word for r in rows})), "word string, context bigint, label int")
    odds = f"ln((toxic + 0.5) / (clean + 0.5)) - ln({toxic / max(1, clean)})"
    kept = (
        contexts.distinct().groupBy("word")
        .agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
        .withColumn("odds", F.expr(odds))
        .where(f"toxic >= {MIN_CONTEXTS} AND odds >= {MIN_LOG_ODDS}")
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "word").collect()
    )
    return [r.word for r in kept]


def _windows(words: dict[str, int]) -> Callable:
    """Windows of token numbers (0: other words) and labels; those without evidence now and then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, toxic, order = [], [], []
                for doc, text, label in zip(part.column("doc_id").to_pylist(), _texts(part), part.column("label").to_pylist()):
                    ids = [words.get(w, 0) for w in _WORD.findall(text.lower())]
                    for at in range(0, len(ids), WINDOW):
                        some, hashed = ids[at : at + WINDOW], xxhash.xxh3_64_intdigest(f"{doc} {at}") >> 1
                        if any(some) or hashed % 64 == 0:
                            tokens.append(some)
                            toxic.append(label)
                            order.append(hashed)
                yield pa.record_batch(
                    [pa.array(tokens, pa.list_(pa.int32())), pa.array(toxic, pa.int32()), pa.array(order, pa.int64())],
                    names=["tokens", "label", "place"],
                )

    return run


@dataclass
class Field:
    """Parameters of the field: ``words`` to numbers, ``weight`` of the toxic state by number, the
    log potentials ``step[from, to]`` of transitions and ``begin`` of the first state."""

    words: dict[str, int]
    weight: np.ndarray
    step: np.ndarray
    begin: np.ndarray

    def prepare(self) -> None:
        """The eigensystem of a step over one other word, largest value first, scaled to it."""
        over = np.exp(self.step) * np.array([1.0, math.exp(self.weight[0])])
        values, left = np.linalg.eig(over)
        first = np.argsort(-values.real)
        self._values, vectors = values.real[first] / values.real[first[0]], left.real[:, first]
        self._vectors, self._inverse = vectors, np.linalg.inv(vectors)
        self._step = np.exp(self.step)
        self._start = np.exp(self.begin)

    def _run(self, length: int) -> np.ndarray:
        return (self._vectors * self._values**length) @ self._inverse

    def marginals(self, places: list[int], numbers: list[int], length: int) -> list[float]:
        """P(toxic) of the evidence words at ``places`` in a text of ``length`` words."""
        runs = np.diff([-1, *places, length]) - 1
        jumps = [self._run(int(g)) if g else None for g in runs]
        strength = [np.array([1.0, math.exp(min(self.weight[k], 50.0))]) for k in numbers]
        # The first word has no step before it: it starts with its own potential.
        other = np.array([1.0, math.exp(self.weight[0])])
        ahead, forward = self._start, []
        for i, potential in enumerate(strength):
            if i == 0:
                if runs[0]:
                    ahead = self._start * other
                    ahead = ahead @ self._run(int(runs[0]) - 1) @ self._step
            else:
                ahead = (ahead @ jumps[i] if jumps[i] is not None else ahead) @ self._step
            ahead = ahead * potential
            ahead = ahead / ahead.sum()
            forward.append(ahead)
        behind, result = np.ones(2), [0.0] * len(places)
        for i in range(len(places) - 1, -1, -1):
            if i + 1 < len(places):
                behind = self._step @ (strength[i + 1] * behind)
            if jumps[i + 1] is not None:
                behind = jumps[i + 1] @ behind
            behind = behind / behind.sum()
            joint = forward[i] * behind
            result[i] = float(joint[1] / joint.sum())
        return result


def train_field(words: list[str], windows: list[tuple[list[int], int]]) -> Field:
    """Maximum likelihood with a small penalty, by gradient ascent with momentum and adaptive steps."""
    size = max((len(t) for t, _ in windows), default=1)
    count = len(words) + 1
    field = Field({w: i + 1 for i, w in enumerate(words)}, np.zeros(count), np.zeros((2, 2)), np.zeros(2))
    if not windows:
        field.prepare()
        return field
    tokens = np.zeros((len(windows), size), np.int64)
    here = np.zeros((len(windows), size), bool)
    truth = np.zeros((len(windows), size), np.int64)
    for row, (ids, label) in enumerate(windows):
        tokens[row, : len(ids)], here[row, : len(ids)] = ids, True
        truth[row, : len(ids)] = (np.array(ids) > 0) & (label == 1)
    both = here[:, 1:] & here[:, :-1]
    seen = np.bincount(tokens[here & (truth == 1)], minlength=count).astype(float)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (truth[:, :-1][both], truth[:, 1:][both]), 1.0)
    first = np.bincount(truth[:, 0], minlength=2).astype(float)
    parameters = np.zeros(count + 6)
    momentum, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for t in range(1, STEPS + 1):
        weight, step, begin = parameters[:count], parameters[count : count + 4].reshape(2, 2), parameters[count + 4 :]
        emit = np.zeros((*tokens.shape, 2))
        emit[..., 1] = weight[tokens]
        emit = np.exp(np.clip(emit, -30, 30))
        move = np.exp(step)
        forward = np.empty_like(emit)
        ahead = np.exp(begin) * emit[:, 0]
        forward[:, 0] = ahead / ahead.sum(axis=1, keepdims=True)
        for k in range(1, size):
            ahead = (forward[:, k - 1] @ move) * emit[:, k]
            forward[:, k] = np.where(here[:, k, None], ahead / ahead.sum(axis=1, keepdims=True), forward[:, k - 1])
        behind = np.ones((len(tokens), 2))
        marginal, moved = np.zeros_like(emit), np.zeros((2, 2))
        for k in range(size - 1, -1, -1):
            joint = forward[:, k] * behind
            marginal[:, k] = joint / joint.sum(axis=1, keepdims=True)
            if k:
                weighted = emit[:, k] * behind
                pair = forward[:, k - 1, :, None] * move * weighted[:, None, :]
                pair /= pair.sum(axis=(1, 2), keepdims=True)
                moved += pair[here[:, k]].sum(axis=0)
                earlier = weighted @ move.T
                behind = np.where(here[:, k, None], earlier / earlier.sum(axis=1, keepdims=True), behind)
        expected = np.bincount(tokens[here], marginal[..., 1][here], count)
        slope = np.concatenate([seen - expected, (pairs - moved).ravel(), first - marginal[:, 0].sum(axis=0)])
        slope = slope / len(windows) - DECAY * parameters
        momentum = 0.9 * momentum + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        parameters = parameters + RATE * (momentum / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    field.weight, field.step, field.begin = parameters[:count], parameters[count : count + 4].reshape(2, 2), parameters[count + 4 :]
    field.prepare()
    return field


def _tag(field: Field) -> Callable:
    """Texts to ``MEASURES``; spans are words with a marginal of one half or more, by code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = field.words
        known = words.keys()
        for batch in batches:
            for part in slices(batch, "text"):
                measures, spans = np.zeros((3, part.num_rows)), []
                for row, text in enumerate(_texts(part)):
                    found = _WORD.findall(text.lower())
                    if known.isdisjoint(found):
                        spans.append([])
                        continue
                    places = [m.span() for m in _WORD.finditer(text)]
                    found = [text[a:b].lower() for a, b in places]
                    at = [k for k, w in enumerate(found) if w in words]
                    marginal = field.marginals(at, [words[found[k]] for k in at], len(found))
                    expected = sum(marginal)
                    measures[:, row] = expected, expected / len(found), max(marginal, default=0.0)
                    spans.append(
                        [{"start": places[k][0], "end": places[k][1], "marginal": p} for k, p in zip(at, marginal) if p >= 0.5]
                    )
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
                yield pa.record_batch(
                    [part.column("doc_id"), *map(pa.array, measures), pa.array(spans, kind)],
                    names=["doc_id", "expected", "density", "highest", "spans"],
                )

    return run


def _features(expected, density, highest) -> np.ndarray:
    return np.stack([np.ones(len(expected)), np.log1p(expected), np.log1p(1000 * density), highest], axis=1)


def train_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps."""
    weights, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[1e-1] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        weights = weights + np.linalg.solve(hessian + 1e-9 * np.eye(len(hessian)), x.T @ (y - p) - penalty @ weights)
    return weights


def teaching_windows(windows: DataFrame) -> DataFrame:
    """The windows (tokens, label, place) that the field learns from, in the order of their hashes."""
    held = windows.select("place", F.explode(F.array_distinct("tokens")).alias("word")).where("word > 0")
    first = Window.partitionBy("word").orderBy("place")
    of_words = held.withColumn("n", F.row_number().over(first)).where(f"n <= {WORD_WINDOWS}").select("place")
    chosen = windows.select("place").orderBy("place").limit(MAX_WINDOWS).union(of_words).distinct()
    return windows.join(chosen, "place").select("tokens", "label", "place").orderBy("place")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and toxic ``spans`` of every row of ``docs``.

    ``labels`` has doc_id and toxic; only rows whose crc32(doc_id) mod 5 is not 0 teach, and only
    texts are inputs. Texts without words score as such without evidence; with no labels, or
    one class alone, every score is 0 and there are no spans. Rows without id have held_out null. Rows that
    repeat stay, equal texts score alike, long ones are tagged whole, and an empty table gives an empty one.
    Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    stored = Stored(spark)
    given = texts(docs)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.where("label IN (0, 1)").withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0").drop("fold").distinct()
    share = max(1, min(1 << 20, (MAX_DOCS << 20) // max(1, known.count())))
    # At most about MAX_DOCS ids: their size is known, so the texts stay where they are.
    known = F.broadcast(known.where(f"pmod(xxhash64(doc_id), {1 << 20}) < {share}"))
    taught = stored.put(given.join(known, "doc_id"), "taught")
    sizes = {r.label: r["count"] for r in taught.groupBy("label").count().collect()}
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    if not sizes.get(0) or not sizes.get(1):
        stored.drop()
        return given.select("doc_id", held_out, F.lit(0.0).alias("score"), F.expr(f"CAST(array() AS {SPANS})").alias("spans"))
    words = evidence_words(taught, sizes[1], sizes[0])
    numbers = {w: i + 1 for i, w in enumerate(words)}
    windows = stored.put(taught.mapInArrow(tidy(_windows(numbers)), "tokens array<int>, label int, place bigint"), "windows")
    field = train_field(words, [(r.tokens, r.label) for r in teaching_windows(windows).collect()])
    # The documents' measures come out of the field; labels join them by id, not by text.
    seen = taught.select("doc_id", "text").mapInArrow(tidy(_tag(field)), MEASURES).drop("spans").distinct().join(known, "doc_id")
    table = seen.toArrow()
    columns = [table.column(c).to_numpy() for c in ("expected", "density", "highest", "label")]
    weights = train_logistic(_features(*columns[:3]), columns[3].astype(float))
    stored.drop()
    linear = " + ".join(
        f"({w!r}) * {x}"
        for w, x in zip(map(float, weights), ("1.0", "log1p(expected)", "log1p(1000 * density)", "highest"))
    )
    score = F.expr(f"1 / (1 + exp(-({linear})))").alias("score")
    return given.mapInArrow(tidy(_tag(field)), MEASURES).select("doc_id", held_out, score, "spans")
