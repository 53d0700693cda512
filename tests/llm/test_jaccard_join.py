"""Components of exactly linked documents, against comparing every pair."""

import random

import duckdb
import numpy as np
import pytest
from samples import prose

from ordermill.llm import entries, jaccard_join
from ordermill.llm.common import Stored, table
from ordermill.llm.graph import components

SF = "/root/testdata/sf0.001"


def shingles(text, size):
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if size else frozenset()


def brute(rows, size=4, num=85, den=100):
    sets = {doc: shingles(text, size) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((doc, len(s), find(doc)) for doc, s in sets.items())


def near_copies(seed, count, edits):
    """Variants of one text, more and more apart."""
    draw, words = random.Random(seed), prose(seed, 120).split()
    found = []
    for _ in range(count):
        copy = list(words)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = draw.choice(["zz", "yy", "xx"]) + str(draw.random())
        found.append(" ".join(copy))
    return found


@pytest.fixture(scope="module")
def rows():
    texts = near_copies(1, 60, 9) + near_copies(2, 40, 4) + [prose(k, 60) for k in range(50, 80)]
    texts += [None, "", "one", "One", "two words", "two words", "TWO words\x0b"]
    return list(enumerate(texts))


def test_equals_all_pairs(with_clashes, rows):
    found = jaccard_join.jaccard_components(with_clashes(rows)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_other_shingles_and_similarity(with_clashes, rows):
    found = jaccard_join.jaccard_components(with_clashes(rows), 5, 80, 100).collect()
    assert sorted(map(tuple, found)) == brute(rows, 5, 80, 100)


@pytest.mark.parametrize(("cells", "sets"), [(7, 900), (3, 200)])
def test_split_blocks_lose_nothing(with_clashes, rows, monkeypatch, cells, sets):
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", cells)
    monkeypatch.setattr(jaccard_join, "CELL_SHINGLES", sets)
    monkeypatch.setattr(jaccard_join, "ROW_WEIGHT", 1)
    found = jaccard_join.jaccard_components(with_clashes(rows)).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_op3_on_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, entries.op3_jaccard_join(spark, SF).collect())) == brute(rows)


def test_sql_counterpart(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute(entries.ORACLE_SQL["op3_jaccard_join"]).fetchall()
    assert sorted(rows) == sorted(map(tuple, entries.op3_jaccard_join(spark, SF).collect()))


def test_edge_rows(with_clashes, edge_rows):
    found = jaccard_join.jaccard_components(with_clashes(edge_rows)).collect()
    assert len(found) == len(edge_rows)
    by_id = {}
    for row in found:
        by_id.setdefault(row.doc_id, []).append((row.n_shingles, row.component_id))
    assert by_id[None][0][1] is None
    assert by_id[1] == [(0, 1)] and by_id[3] == [(0, 3)]
    assert {c for _, c in by_id[6] + by_id[7]} == {6}
    assert by_id[10] == [(1, 10)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_tree_bounds_never_drop_a_link():
    draw = np.random.default_rng(4)
    similarity = jaccard_join.Similarity(85, 100)
    sizes = draw.integers(1, 400, 500)
    points = np.stack([np.bincount(draw.integers(0, 8, n), minlength=jaccard_join.GROUPS) for n in sizes]).astype(np.int32)
    tree = jaccard_join.CountTree(points, sizes, similarity)
    for i in range(0, 500, 7):
        bound = np.minimum(points, points[i]).sum(axis=1)
        expected = np.flatnonzero(
            (bound >= similarity.needed(sizes, sizes[i])) & (sizes >= similarity.least_size(sizes[i]))
            & (similarity.least_size(sizes) <= sizes[i])
        )
        assert set(expected) <= set(tree.near(points[i], sizes[i]).tolist())


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    stored = Stored(spark)
    found = components(spark.createDataFrame(chain, "a bigint, b bigint"), stored).collect()
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(1, 61)] + [(100 + i, 100) for i in range(1, 50)]
    stored.drop()
