"""Quality and toxicity on held-out labels; loss differences against plain counting."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermill.llm import entries, lm_score, quality, toxicity
from ordermill.llm.common import table

SF = "/root/testdata/sf0.1"


def held_out(spark, query, label):
    scores = query(spark, SF).where("held_out")
    known = table(spark, SF, "labels").select("doc_id", F.col(label).alias("label")).where("label IS NOT NULL")
    rows = scores.join(known, "doc_id").select("score", "predicted", "label").collect()
    assert len(rows) > 500 and all(0 <= r.score <= 1 for r in rows)
    return rows


def ranked(rows):
    """Share of pairs of a good and a bad row that the scores put in order."""
    good, bad = ([r.score for r in rows if r.label == k] for k in (1, 0))
    return np.mean([np.mean(np.array(bad) < g) + 0.5 * np.mean(np.array(bad) == g) for g in good])


def test_quality_on_held_out_labels(spark):
    rows = held_out(spark, entries.op1_quality, "quality")
    assert ranked(rows) > 0.98
    assert np.mean([r.predicted == r.label for r in rows]) > 0.97


def test_toxicity_on_held_out_labels(spark):
    rows = held_out(spark, entries.op10_toxicity, "toxic")
    assert ranked(rows) > 0.9
    assert np.mean([r.predicted == r.label for r in rows]) > 0.97


@pytest.fixture(scope="module")
def label_rows():
    return [(k, k % 2, (k // 2) % 2) for k in range(12)] + [(None, 1, 1), (3, None, None), (4, 0, 1)]


def test_edge_rows(spark, with_clashes, edge_rows, label_rows):
    docs = with_clashes(edge_rows)
    labels = spark.createDataFrame(label_rows, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("x"))
    for scores in (quality.quality_scores(docs, labels), toxicity.toxicity_scores(docs, labels)):
        rows = scores.collect()
        assert len(rows) == len(edge_rows)
        assert all(r.score is not None and 0 <= r.score <= 1 for r in rows)
        assert {r.held_out for r in rows if r.doc_id is None} == {None}


def test_without_labels_or_documents(spark, with_clashes, edge_rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert {r.score for r in quality.quality_scores(with_clashes(edge_rows), none).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(with_clashes(edge_rows), none).collect()} == {0.0}
    assert quality.quality_scores(empty, none).count() == toxicity.toxicity_scores(empty, none).count() == 0


def test_isotonic_pools_violators():
    cells, values = quality.isotonic(np.arange(5.0), np.array([0.0, 2, 1, 1, 4]), np.array([4.0, 4, 4, 4, 4]))
    assert values.tolist() == [0.0, pytest.approx(1 / 3), 1.0]
    assert cells.tolist() == [0.0, 2.0, 4.0]


def test_marginals_equal_sums_over_all_paths():
    field = toxicity.Field({"a": 1, "b": 2}, np.array([-1.0, 2.0, 0.5]), np.array([[0.3, -0.8], [-0.2, 0.9]]), np.array([0.1, -0.4]))
    field.prepare()
    for line in ([0, 1, 0, 0, 2, 0], [1, 2], [0, 0, 0, 1], [2], [1, 0, 0, 0, 0, 0, 0, 1]):
        weights = {}
        for code in range(2 ** len(line)):
            states = [code >> k & 1 for k in range(len(line))]
            score = field.begin[states[0]] + sum(field.weight[w] for w, s in zip(line, states) if s)
            score += sum(field.step[a, b] for a, b in zip(states, states[1:]))
            weights[tuple(states)] = math.exp(score)
        at = [k for k, w in enumerate(line) if w]
        expected = [sum(v for s, v in weights.items() if s[k]) / sum(weights.values()) for k in at]
        assert field.marginals(at, [line[k] for k in at], len(line)) == pytest.approx(expected)


def test_toxic_spans_are_code_points(spark):
    near = [a + b for a in "bcdfghjklm" for b in ("ay", "oe", "ui", "ea", "ou")]
    texts = [f"\U0001f600 é{near[k % 50]} {'vile' if k % 3 == 0 else 'kind'} {near[k * 7 % 50]} word" for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 3 == 0) for r in rows)
    for r in rows:
        assert [texts[r.doc_id][s.start : s.end] for s in r.spans] == (["vile"] if r.doc_id % 3 == 0 else [])


def plain_losses(texts, characters):
    """N-gram probabilities by the textbook recursion."""
    number = {chr(c): i + 2 for i, c in enumerate(characters)}
    counts, total = Counter(), {}
    for text in texts:
        line = [1] * 3 + [number.get(c, 0) for c in text.lower()] + [1]
        for end in range(3, len(line)):
            for size in range(1, 5):
                counts[tuple(line[end - size + 1 : end + 1])] += 1
    contexts = {}
    for gram, n in counts.items():
        contexts.setdefault(gram[:-1], []).append(n)

    def probability(gram):
        if not gram:
            return 1 / lm_score.SYMBOLS
        own = contexts.get(gram[:-1], [])
        kinds = max(1, len(own))
        return (counts[gram] + kinds * probability(gram[1:])) / (sum(own) + kinds)

    return number, lambda gram: -math.log(probability(gram))


def test_loss_differences_equal_plain_counting(with_clashes, spark):
    texts = ["the cat", "the dog!", "", None, "zzz 123 zzz", "The the the", "é日本"]
    docs = with_clashes(list(enumerate(texts)))
    target = spark.createDataFrame([(0,), (1,), (1,), (None,), (99,)], "doc_id bigint")
    whole = [t or "" for t in texts]
    characters = lm_score.vocabulary(docs.select("doc_id", "text"))
    number, background = plain_losses(whole, characters)
    _, aimed = plain_losses(whole[:2], characters)
    for row in lm_score.cross_entropy_difference(docs, target).collect():
        line = [1] * 3 + [number.get(c, 0) for c in whole[row.doc_id].lower()] + [1]
        grams = [tuple(line[i - 3 : i + 1]) for i in range(3, len(line))]
        assert row.n_tokens == len(grams)
        assert row.score == pytest.approx(sum(aimed(g) - background(g) for g in grams) / len(grams))


def test_loss_differences_of_edge_rows(spark, with_clashes, edge_rows):
    none = spark.createDataFrame([], "doc_id bigint")
    assert lm_score.cross_entropy_difference(with_clashes(edge_rows), none).count() == len(edge_rows)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_score.cross_entropy_difference(empty, none).count() == 0


def test_op8_tells_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    known = table(spark, sf, "labels").where("quality IS NOT NULL").select("doc_id", F.col("quality").alias("label"))
    rows = entries.op8_lm_score(spark, sf).withColumn("score", -F.col("score")).join(known, "doc_id").collect()
    assert ranked(rows) > 0.95
