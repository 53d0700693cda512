"""Neighbours, test items and passages against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import prose
from pyspark.sql import functions as F

from ordermill.llm import ann, decontaminate, entries, passages
from ordermill.llm.common import table

SF = "/root/testdata/sf0.01"
EMPTY = "doc_id bigint, text string"


def nearest_by_hand(rows, asked, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = {}
    for q, v in usable:
        if q in asked:
            scores = [(-round(float(w @ v / np.sqrt((w @ w) * (v @ v))), 12), i) for i, w in usable if i != q]
            found[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return found


def test_all_lists_probed_is_exact(spark, monkeypatch):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=24).tolist()) for i in range(400)] + [(500 + i, [1.0] * 24) for i in range(150)]
    rows += [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] * 24), (1003, [None] * 24), (1004, [1.0]), (None, [1.0] * 24)]
    rows += [(1005, [1e200] * 24), (1006, [float("inf")] * 24)]
    monkeypatch.setattr(ann, "BLOCK_ROWS", 60)
    monkeypatch.setattr(ann, "CHUNK_QUERIES", 7)
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("vec", F.lit(1))
    queries = vectors.where("vec_id % 10 = 0")
    found = defaultdict(list)
    for r in ann.nearest(vectors, queries, 5, recall=1.0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    expected = nearest_by_hand([r for r in rows if r[0] != 1004], {r[0] for r in rows if r[0] and r[0] % 10 == 0} | {0}, 5)
    assert found.keys() == expected.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.97 * sum(map(len, expected.values()))
    tied = [i for i, _ in found[510]]
    assert tied == [500, 501, 502, 503, 504]  # equal vectors: the smallest ids
    assert all(s == pytest.approx(1) for _, s in found[510])


def test_few_and_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    three = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 1.0]), (3, [0.0, 1.0])], schema)
    rows = ann.nearest(three, three.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in rows] == [(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)]
    none = three.limit(0)
    assert ann.nearest(none, none).count() == 0


def test_op9_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    expected = nearest_by_hand(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    found = defaultdict(set)
    for r in entries.op9_ann(spark, SF).collect():
        found[r.query_id].add(r.vec_id)
    hits = sum(len(found[q] & {i for i, _ in e}) for q, e in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def item_index(items):
    frequency = Counter()
    for _, question, answer in items:
        frequency.update(set(decontaminate.terms(question) + decontaminate.terms(answer)))
    mean = np.mean([len(decontaminate.terms(q) + decontaminate.terms(a)) for _, q, a in items])
    return decontaminate.ItemIndex(items, frequency, len(items), mean)


def test_block_max_wand_finds_all_above(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    for _ in range(20):
        index = item_index([(i, " ".join(draw.choices(words, k=draw.randint(3, 30))), "") for i in range(150)])
        for _ in range(10):
            query = sorted({index.numbers[w] for w in draw.sample(words, draw.randint(1, 50)) if w in index.numbers})
            threshold, scores = draw.choice([0.2, 0.4, 0.6, 0.8]), Counter()
            for t in query:
                for item, share in zip(index.items[t], index.shares[t]):
                    scores[item] += share
            found = dict(index.above(query, threshold))
            assert {i for i, s in scores.items() if s >= threshold + 1e-9} <= found.keys()
            assert all(found[i] == pytest.approx(scores[i]) and scores[i] >= threshold - 1e-9 for i in found)


def leaks_by_hand(docs, items, overlap=0.8):
    found = set()
    for doc, text in docs:
        words = decontaminate.terms(text or "")
        for item, whole in items:
            parts = decontaminate.question_and_answer(whole or "")
            shares = []
            for part in map(decontaminate.terms, parts):
                size = min(5, len(part))
                wanted = {tuple(part[i : i + size]) for i in range(len(part) - size + 1)} if size else set()
                there = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()
                shares.append(len(wanted & there) / len(wanted) if wanted else 1.0)
            if any(map(decontaminate.terms, parts)) and min(shares) >= overlap:
                found.add((doc, item))
    return found


def test_op4_finds_every_leak(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    found = {(r.doc_id, r.item_id) for r in entries.op4_decontaminate(spark, sf).collect()}
    assert found == leaks_by_hand(docs, items) and found


@pytest.mark.parametrize("words", [decontaminate.INDEX_WORDS, 50])
def test_leaks_of_edge_rows(spark, with_clashes, edge_rows, monkeypatch, words):
    monkeypatch.setattr(decontaminate, "INDEX_WORDS", words)
    item, other = prose(70, 30), prose(71, 20) + ". And so it is."
    rows = [*edge_rows, (20, prose(72, 300) + " " + item.upper() + "!! " + prose(73, 300)), (21, "\x0b".join(other.split()))]
    rows += [(22, "　".join(item.split())), (23, item[: len(item) // 2])]
    benchmark = [(1, item), (2, other), (3, None), (4, ""), (None, "text"), (1, item), (5, "!!!")]
    test = spark.createDataFrame(benchmark, "item_id bigint, text string")
    found = decontaminate.leaks(with_clashes(rows), test).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(20, 1), (21, 2), (22, 1)]
    none = test.limit(0)
    assert decontaminate.leaks(with_clashes(rows), none).count() == 0
    assert decontaminate.leaks(spark.createDataFrame([], EMPTY), test).count() == 0


def test_items_with_their_own_answers(spark):
    schema = "item_id bigint, question string, answer string"
    items = spark.createDataFrame([(1, prose(80, 25), "forty two"), (2, prose(81, 25), None)], schema)
    docs = [(1, prose(80, 25) + " forty two"), (2, prose(80, 25) + " forty three"), (3, prose(81, 25))]
    found = decontaminate.leaks(spark.createDataFrame(docs, EMPTY), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (3, 2)]


def windows_by_hand(values, width):
    found = []
    for c, v in enumerate(values):
        left = right = c
        while left and values[left - 1] > v:
            left -= 1
        while right + 1 < len(values) and values[right + 1] >= v:
            right += 1
        if v and right - left + 1 >= width:
            found.append((left, c, right))
    return found


def test_compact_windows():
    draw = random.Random(6)
    for _ in range(200):
        values = [draw.randint(0, 30) for _ in range(draw.randint(0, 120))]
        width = draw.choice([1, 2, 3, 5, 8])
        found = zip(*(x.tolist() for x in passages.compact_windows(np.array(values, np.uint64), width)))
        assert sorted(found) == sorted(windows_by_hand(values, width))


def test_planted_passages(with_clashes):
    shared, edited = prose(90, 60).split(), prose(91, 120).split()
    near = list(edited)
    near[60] = "changed"
    rows = [(k, prose(100 + k, 150)) for k in range(30)]
    rows += [(40 + k, " ".join([prose(200 + k, 40), *shared, prose(300 + k, 40)])) for k in range(6)]
    rows += [(50, " ".join([prose(400, 30), *edited])), (51, " ".join([*near, prose(401, 30)]))]
    rows += [(60, prose(402, 80)), (61, prose(402, 80)), (61, prose(402, 80)), (62, prose(403, 40)), (63, prose(403, 40))]
    found = passages.repeated_passages(with_clashes(rows)).collect()
    assert {r.doc_id for r in found} | {r.other_id for r in found} == {*range(40, 46), 50, 51, 60, 61}
    texts = dict(rows)
    for r in found:
        own = texts[r.doc_id].split()[r.start : r.end]
        other = texts[r.other_id].split()[r.other_start : r.other_end]
        a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (own, other))
        assert len(own) >= 50 and r.similarity >= 0.8 and r.similarity == pytest.approx(len(a & b) / len(a | b))


def test_op7_finds_all_equal_passages(spark):
    texts = {r.doc_id: r.text.encode().lower().split() for r in table(spark, SF, "documents").collect()}
    holders = defaultdict(set)
    for doc, words in texts.items():
        for i in range(len(words) - 49):
            holders[tuple(words[i : i + 50])].add(doc)
    expected = {d for docs in holders.values() if len(docs) > 1 for d in docs}
    found = entries.op7_passages(spark, SF).collect()
    seen = {r.doc_id for r in found} | {r.other_id for r in found}
    assert len(expected & seen) >= 0.99 * len(expected)


def test_passages_of_edge_rows(spark, with_clashes, edge_rows):
    rows = [*edge_rows, (30, "of " * 300), (31, None)]
    found = passages.repeated_passages(with_clashes(rows)).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(30, 10)}
    assert passages.repeated_passages(spark.createDataFrame([], EMPTY)).count() == 0
