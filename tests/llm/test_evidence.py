"""Every word that passes the tests is evidence, however many there are."""

import random

from ordermill.llm import toxicity


def test_more_evidence_than_a_few_hundred_words(spark):
    draw = random.Random(3)
    syllables = [a + b for a in "bcdfghjklmnprstvwz" for b in "aeiou"]
    near = [a + b for a in syllables for b in syllables[:20]]
    vile = ["x" + a + b for a in syllables for b in syllables[:5]][:400]
    toxic = [" ".join(x for i in range(6) for w in [vile[(6 * k + i) % 400]] for x in (draw.choice(near), w, draw.choice(near))) for k in range(900)]
    clean = [" ".join(draw.choices(near, k=18)) for _ in range(4500)]
    asked = [f"{draw.choice(near)} {w} {draw.choice(near)}" for w in vile]
    docs = spark.createDataFrame(list(enumerate([*toxic, *clean, *asked])), "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k < 900)) for k in range(5400)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).where("doc_id >= 5400").collect()
    spotted = sum([asked[r.doc_id - 5400][s.start : s.end] for s in r.spans] == [vile[r.doc_id - 5400]] for r in rows)
    assert spotted >= 390


def test_every_evidence_word_has_windows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_WINDOWS", 5)
    monkeypatch.setattr(toxicity, "WORD_WINDOWS", 2)
    rows = [([k % 40, 0, 0, 40 if k == 99 else 0], k % 2, 1000 - k) for k in range(100)]
    found = toxicity.teaching_windows(spark.createDataFrame(rows, "tokens array<int>, label int, place bigint")).collect()
    places = [r.place for r in found]
    assert places == sorted(set(places)) and places[:5] == [901, 902, 903, 904, 905]
    # Brute force: the first five, and for every word its first two.
    wanted = set(sorted(r[2] for r in rows)[:5])
    for word in range(1, 41):
        wanted |= set(sorted(r[2] for r in rows if word in r[0])[:2])
    assert set(places) == wanted
