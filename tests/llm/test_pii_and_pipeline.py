"""Base spans against the patterns in Python; the pipeline stage by stage."""

import hashlib
import random
import re

import numpy as np
import pytest
from samples import prose
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import entries, pii
from ordermill.llm.common import table

SF = "/root/testdata/sf0.001"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def base_by_hand(text):
    found = [
        (m.start(), kind, m.end()) for kind, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(kind, m.group())
    ]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def odd_texts():
    draw = random.Random(7)
    pool = (
        "a@b.c|x_y%z@q-w.e.r|1.2.3.4|300.1.2.3.4.5.6.7|4111 1111 1111 1111|4111-1111-1111-1112|+1 (469) 555-3334|+12|é|\U0001f600"
        "| |-|.|7|0005|@|+|a@b|call 555 123 4567|4111.1111.1111.1111|john (at) ex (dot) com|10[.]0[.]0[.]1|\n|_d@e.f.|12345678901234567890123"
    ).split("|")
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 14))) for _ in range(800)]
    return [*texts, "1" * 30_000, "a" * 30_000 + "@b.c", "1 " * 10_000, "+1" * 3_000 + "23456789", "a@b.c," * 1_500]


def luhn_valid(draw):
    digits = [4] + [draw.randint(0, 9) for _ in range(14)]
    total = sum(x // 10 + x % 10 for x in (d * (1 + (i + 1) % 2) for i, d in enumerate(digits)))
    return "".join(map(str, digits)) + str(-total % 10)


def corpus(count=400):
    """Personal data after words that announce it, and number-like decoys in tables."""
    draw = random.Random(11)
    texts = []
    for i in range(count):
        n = [str(draw.randint(100, 999)) for _ in range(8)]
        card, wrong = luhn_valid(draw), "4000 1234 5678 " + f"{draw.randint(1000, 9999)}"
        grouped = " ".join(card[k : k + 4] for k in range(0, 16, 4))
        texts += [
            f"please call +1 {n[0]}-{n[1]}-{draw.randint(1000, 9999)} today",
            f"the row {n[0]} {n[1]} {draw.randint(1000, 9999)} {n[3]} of the table",
            f"paid by visa card {grouped} in full",
            f"part {n[4]} {wrong} {n[5]} listed",
            f"write an email to a{n[6]}@host{n[7]}.com soon",
            f"the server at 10.{i % 200}.{i % 90}.7 is up",
            f"version {n[0]}.{n[1]}.{n[2]}.{n[3]} came out",
        ]
    return texts


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string"))


def test_base_spans_of_odd_texts(with_clashes, model, edge_rows):
    rows = [*edge_rows, *enumerate(odd_texts(), 1_000)]
    found = pii.find(with_clashes(rows), model).select("doc_id", pii.joined("base").alias("base")).collect()
    assert sorted(((r.doc_id, r.base) for r in found), key=repr) == sorted(((d, base_by_hand(t)) for d, t in rows), key=repr)


def added(spark, model, texts):
    """The spans of texts beside their base spans, and the redacted texts."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.find(docs, model).orderBy("doc_id")
    rows = found.select(pii.joined("spans").alias("s"), pii.joined("base").alias("b"), pii.redacted(F.col("text"), "spans").alias("t")).collect()
    return [sorted(set(r.s.split(",")) - set(r.b.split(","))) for r in rows], [r.t for r in rows]


def test_context_decides(spark, model):
    pairs = [
        ("please call 555 123 4567 today", "the row 555 123 4567 of the table", ["phone:12:24"]),
        ("please call 555-123-4567 today", "the row 1 555-123-4567 2 of the table", ["phone:12:24"]),
        # The check fails, the format and the context of a card are there.
        ("paid by visa card 4111.1111.1111.1112 in full", "part 123 4111.1111.1111.1112 555 listed", ["card:18:37"]),
        ("paid by visa card 4111.1111.1111.1111 in full", "part 123 4111.1111.1111.1111 555 listed", ["card:18:37"]),
        ("the server at 10[.]0[.]0[.]1 is up", "part 9 10[.]0[.]0[.]1 8 listed", ["ip:14:28"]),
    ]
    for cued, plain, span in pairs:
        (with_cue, without), (redacted, same) = added(spark, model, [cued, plain])
        assert (with_cue, without) == (span, []), cued
        assert "[" + span[0].split(":")[0].upper() + "]" in redacted and same == plain


def test_written_out_emails(spark, model):
    (one, two, three), _ = added(spark, model, ["write an email to john (at) ex (dot) com", "look at nt. The", "meet at ten . We"])
    assert (one, two, three) == (["email:18:40"], [], [])


def test_what_the_rules_go_by_is_no_feature(spark):
    # The same format and context, with and without a right check digit, octets in range, or a plus.
    pairs = [
        (2, "visa 4111 1111 1111 1111 x", "visa 4111 1111 1111 1112 x"),
        (2, "visa 4111111111111111 x", "visa 4111111111111112 x"),
        (1, "server 10.11.200.13 x", "server 10.11.300.13 x"),
        (3, "call +555 123 4567 x", "call 555 123 4567 x"),
        (1, "server 10.11.12.13 x", "server 10[.]11[.]12[.]13 x"),
    ]
    docs = spark.createDataFrame([(i, text) for i, pair in enumerate(pairs) for text in pair[1:]], "doc_id bigint, text string")
    rows = pii.candidates(docs).collect()
    for i, (kind, *_) in enumerate(pairs):
        right, wrong = ([r for r in rows if (r.doc_id, r.kind, r.positive) == (i, kind, good)] for good in (True, False))
        assert len(right) == len(wrong) == 1 and all(right[0][n] == wrong[0][n] for n in pii.FEATURES), i


def test_trees_against_plain_boosting(spark, model):
    """Every round takes the split that a search over all splits finds, and the engine adds up the same trees."""
    docs = spark.createDataFrame(list(enumerate(corpus(60))), "doc_id bigint, text string")
    rows = pii.candidates(docs).collect()
    names = list(pii.FEATURES)
    x = np.array([[r[n] for n in names] for r in rows])
    y = np.array([r.positive for r in rows], float)
    # Counted rows give the trees of single ones.
    keys, at = np.unique(x, axis=0, return_inverse=True)
    counted = pii.boost(keys, np.bincount(at.ravel(), y), np.bincount(at.ravel()).astype(float))
    single = pii.boost(x, y, np.ones(len(x)))
    assert np.allclose(pii._margins(counted, x), pii._margins(single, x))

    def gain(mask, g, h):
        return sum(g[m].sum() ** 2 / (h[m].sum() + 1) for m in (mask, ~mask))

    p = np.full(len(x), 1 / (1 + np.exp(-single.start)))
    g, h = y - p, p * (1 - p)
    best = max(gain(x[:, f] <= c, g, h) for f in range(x.shape[1]) for c in np.unique(x[:, f]))
    feature, limit = single.trees[0][:2]
    assert gain(x[:, names.index(feature)] <= limit, g, h) == pytest.approx(best)
    table = pii.candidates(docs).select(F.struct(*names).alias("c"), *names)
    scored = table.select(model.margin(F.col("c")).alias("m"), *names).collect()
    assert np.allclose([r.m for r in scored], pii._margins(model, np.array([[r[n] for n in names] for r in scored])))


def test_calibration_against_counting():
    model = pii.Model([("size", 1, ("size", 0, -1.0, 0.5), ("size", 2, 1.0, 2.0))], 0.0, [])
    x = np.array([[0, size, 0, 0, 0, 0, 0] for size in range(4)])
    margin, p = [-1.0, 0.5, 1.0, 2.0], []
    p = [1 / (1 + np.exp(-m)) for m in margin]
    count = np.array([100.0, 100, 100, 100])
    assert pii.calibrated(model, x, np.array([0.0, 10, 85, 99]), count) == pytest.approx(p[2], abs=1e-8)
    assert pii.calibrated(model, x, np.array([0.0, 10, 70, 99]), count) == pytest.approx(p[3], abs=1e-8)
    assert pii.calibrated(model, x, np.array([0.0, 10, 70, 80]), count) == 1.0
    assert pii.calibrated(model, x, np.array([0.0, 0, 0, 19]), np.array([0.0, 0, 0, 19])) == 1.0


def test_inner_names_of_the_input_stay(spark, model):
    names = ["__pii_text", "__PII_base", "__pii_loose", "__pii_added", "kind", "c"]
    docs = spark.createDataFrame([(1, "mail a@b.com", *names)], "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    row = pii.find(docs, model).head()
    assert [row[n] for n in names] == names and len(row.spans) == 1


def test_overlapping_spans_are_redacted_together(spark, model):
    docs = spark.createDataFrame([(1, "\U0001f600 a1.2.3.4@b.com x")], "doc_id bigint, text string")
    row = pii.find(docs, model).select(pii.joined("spans").alias("s"), pii.redacted(F.col("text"), "spans").alias("t")).head()
    assert row.s == "email:2:16,ip:3:10" and row.t == "\U0001f600 [EMAIL] x"


def test_no_candidates_and_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    model = pii.train(empty)
    assert pii.find(empty, model).count() == 0
    docs = spark.createDataFrame([(1, "call 555 123 4567")], "doc_id bigint, text string")
    assert pii.find(docs, model).select(pii.joined("spans").alias("s")).head().s == ""


def test_op6_on_a_whole_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = entries.op6_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = base_by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in expected.split(",")) for k in pii.KINDS]
        assert set(filter(None, expected.split(","))) <= set(r.spans.split(","))


def test_stages_do_what_they_say(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = corpus_pipeline.keep_quality(spark, docs, SF)
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    bad = entries.op1_quality(spark, SF).where("predicted = 0").select("doc_id")
    assert kept.join(bad, "doc_id").count() == 0
    one = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    assert one.columns == columns and 0 < one.count() < docs.count()
    clean = corpus_pipeline.keep_off_benchmark(spark, docs, SF)
    leaked = {r.doc_id for r in entries.op4_decontaminate(spark, SF).collect()}
    everything = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in clean.collect()} == everything - leaked
    redacted = corpus_pipeline.redact(spark, docs, SF)
    assert redacted.columns == columns and redacted.count() == docs.count()
    assert not any(base_by_hand(r.text) for r in redacted.collect())


def test_stages_take_edge_rows(spark, with_clashes, edge_rows):
    # Clashing names stand for the columns that documents has beside id and text.
    docs = with_clashes([*edge_rows, (12, "mail a@b.com"), (13, prose(500, 100))]).withColumn("n_chars", F.length("text"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF)
        assert found.columns == docs.columns
        assert 1 <= found.count() <= docs.count()
        assert found.where("doc_id IS NULL").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_rows_without_id_stay_beside_repeated_ids(spark):
    text = " ".join(prose(7, 40).split())
    rows = [(1, text, "b", 2), (1, text, "a", 3), (None, prose(8, 40), "x", 1), (None, prose(8, 40), "x", 1), (1, prose(9, 40), "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars int")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[3], rows[4]], key=str)


def test_run(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    everything = {r.doc_id for r in table(spark, SF, "documents").collect()}
    ids = [r.doc_id for r in found]
    assert len(set(ids)) == len(ids) and 0 < len(ids) < len(everything)
    assert all(r.n_tokens == len(r.ids_text.split()) for r in found)


def test_every_document_teaches(spark, monkeypatch):
    """Far more documents than the model once took: each candidate is counted, for the trees or for a threshold."""
    taught = []
    boost, calibrated = pii.boost, pii.calibrated
    monkeypatch.setattr(pii, "boost", lambda x, good, total: taught.append(total.sum()) or boost(x, good, total))
    monkeypatch.setattr(pii, "calibrated", lambda model, x, good, total: taught.append(total.sum()) or calibrated(model, x, good, total))
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('write to a', id, '@b.co') AS text")
    pii.train(docs)
    assert sum(taught) == 60_000
