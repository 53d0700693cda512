"""Base secrets against the patterns in Python, the character models against plain counting."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from samples import prose

from ordermill.llm import entries, secrets
from ordermill.llm.common import table

SF = "/root/testdata/sf0.001"
PATTERNS = [
    r"(?a)((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]+",
]
SCHEMA = "doc_id bigint, text string"


def base_by_hand(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if [lambda: len(m.group(2)) >= 6, lambda: len(m.group()) >= 20, lambda: len(m.group()) >= 24][kind]():
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def odd_texts():
    draw = random.Random(9)
    pool = (
        "password|PassWd|secret|token|api_key|APIKEY|api__key|=|:| = |\"|'|\": \"|abc|abcdef|0123456789abcdef|AKIA|IOSFODNN7EXAMPLE|AKIAX"
        "|é|\U0001f600| |\n|==|=:|deadbeef|.|-|_|A|Z9Z9Z9Z9|passwordtoken=|ſecret=abcdef|toKen=abcdefg"
    ).split("|")
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 14))) for _ in range(1_000)]
    return [*texts, "a" * 30_000, "token" * 5_000, "token=" + "x" * 30_000, "token" + " " * 30_000, "secret=abc " * 3_000, "AKIA" * 10_000, "deadbeef " * 3_000]


def test_base_spans_of_odd_texts(with_clashes, edge_rows):
    rows = [*edge_rows, *enumerate(odd_texts(), 1_000)]
    docs = with_clashes(rows).withColumns({n: F.lit("x") for n in ("__secret_text", "__SECRET_base", "__secret_more", "value", "random")})
    found = secrets.find(docs, secrets.train(secrets.labelled(docs)))
    assert [c for c in found.columns if c not in ("base", "spans")] == [c for c in docs.columns if c not in ("base", "spans")]
    both = found.select("doc_id", secrets.written("base").alias("b"), secrets.written("spans").alias("s"), "__secret_text").collect()
    assert sorted(((r.doc_id, r.b) for r in both), key=repr) == sorted(((d, base_by_hand(t)) for d, t in rows), key=repr)
    assert all(set(r.b.split(",")) <= {"", *r.s.split(",")} and r["__secret_text"] == "x" for r in both)


@pytest.fixture(scope="module")
def samples():
    draw = random.Random(4)
    keys = ["".join(draw.choice(secrets.ALPHABET[:64]) for _ in range(draw.randint(16, 48))) for _ in range(600)]
    names = "get set user account load write order item price total index count file path name list value key map table".split()
    plain = [draw.choice(["", "_", "-"]).join(draw.choice(names) for _ in range(draw.randint(2, 6))) for _ in range(1_500)]
    return sorted({*keys}), sorted({*plain} - {*keys})


@pytest.fixture(scope="module")
def model(spark, samples):
    keys, plain = samples
    return secrets.train(spark.createDataFrame([(v, True) for v in keys] + [(v, False) for v in plain], "value string, random boolean"))


def hash_part(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return {r.value: r.part for r in df.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(4))).collect()}


def test_ratios_are_those_of_plain_counting(spark, samples, model):
    keys, plain = samples
    part = hash_part(spark, keys + plain)
    counts, single = {}, {}
    for label, values in ((True, keys), (False, plain)):
        counts[label], single[label] = defaultdict(Counter), Counter(c for v in values if part[v] for c in v)
        for v in values:
            if part[v]:
                for a, b in zip([""] + list(v), v):
                    counts[label][a][b] += 1

    def log_p(label, a, b):
        own = counts[label][a]
        alone = (single[label][b] + 1) / (single[label].total() + len(secrets.ALPHABET))
        return math.log((own[b] + secrets.BACKOFF * alone) / (own.total() + secrets.BACKOFF))

    values = [v for v in keys + plain if not part[v]]
    scores = {r.value: r.s for r in spark.createDataFrame([(v,) for v in values], "value string").select("value", model.score(F.col("value")).alias("s")).collect()}
    for v in values:
        expected = sum(log_p(True, a, b) - log_p(False, a, b) for a, b in zip([""] + list(v), v))
        assert scores[v] == pytest.approx(expected, abs=1e-9)
    # Held-out strings are told apart.
    caught = [scores[v] >= model.threshold for v in keys if not part[v]]
    assert sum(caught) >= 0.95 * len(caught)
    assert not any(scores[v] >= model.threshold for v in plain if not part[v] and len(v) >= secrets.LEAST)


def test_candidates_are_added_by_their_ratio(spark, model):
    key = "q7Zt0VxY2pLm9KsWc4Rb"
    texts = [
        f"use {key} now", "use get_user_account_total_price now", f"token={key}", f"é{key} glued", f"({key})", f"\U0001f600 {key}\n{key}",
        "short q7Zt0VxY2pL", f"mail {key}@host.com", f"hex {'0a1b2c3d' * 3} and {key}",
    ]
    found = secrets.find(spark.createDataFrame(list(enumerate(texts)), SCHEMA), model)
    spans = {r.doc_id: r.s for r in found.select("doc_id", secrets.written("spans").alias("s")).collect()}
    assert spans == {
        0: "random:4:24", 1: "", 2: "assign:0:26", 3: "", 4: "random:1:21", 5: "random:2:22,random:23:43", 6: "", 7: "", 8: "hex:4:28,random:33:53",
    }


def test_models_learned_from_documents(spark):
    docs = spark.createDataFrame([(i, prose(i, 120)) for i in range(300)] + [(900, "key: Zx81Kq0LmPw37VbT9uRaQe5Yh2Jd7Gs4Fk6WnB0c")], SCHEMA)
    found = secrets.find(docs, secrets.train(secrets.labelled(docs)))
    spans = {r.doc_id: r.s for r in found.select("doc_id", secrets.written("spans").alias("s")).collect()}
    assert spans.pop(900) == "random:5:45" and not any(spans.values())


def test_a_long_candidate_costs_its_length(spark, model):
    draw = random.Random(2)
    key = "".join(draw.choice(secrets.ALPHABET[:62]) for _ in range(200_000))
    docs = spark.createDataFrame([(1, "a " + key), (2, "a " + "get_user_" * 20_000)], SCHEMA)
    assert [r.s for r in secrets.find(docs, model).orderBy("doc_id").select(secrets.written("spans").alias("s")).collect()] == ["random:2:200002", ""]


def test_no_strings_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert secrets.train(secrets.labelled(empty)) is None
    assert secrets.find(empty, None).count() == 0
    docs = spark.createDataFrame([(None, None), (1, "token=abcdef")], SCHEMA)
    assert [r.s for r in secrets.find(docs, None).orderBy("doc_id").select(secrets.written("spans").alias("s")).collect()] == ["", "assign:0:12"]


def test_op12_on_a_whole_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = entries.op12_secrets(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        expected = base_by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k + ":") for x in expected.split(",")) for k in secrets.KINDS[:3]]
        assert set(filter(None, expected.split(","))) <= set(r.spans.split(","))


def test_no_python_on_the_main_path(spark):
    plan = entries.op12_secrets(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_every_document_teaches(spark):
    """More documents than the models once took: each has a word that one other document holds and a digest."""
    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('word', char(97 + id div 2 % 26), lpad(translate(id div 2, '0123456789', 'qrstuvwxyz'), 5, 'k')) AS text")
    rows = secrets.labelled(docs).groupBy("random").count().collect()
    assert {r.random: r[1] for r in rows} == {True: 36_000, False: 6_000}


def test_words_of_one_document_alone_teach_nothing(spark):
    rows = [(1, "alpha alpha beta gamma"), (1, "alpha delta"), (2, "beta 1234"), (None, "gamma omega"), (None, "omega")]
    found = secrets.labelled(spark.createDataFrame(rows, SCHEMA)).where("NOT random").collect()
    assert {r.value for r in found} == {"beta", "gamma", "1234"}
