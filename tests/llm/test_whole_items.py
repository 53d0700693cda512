"""Test items without an answer of their own: the edit may fall anywhere."""

import pytest
from samples import prose

from ordermill.llm import decontaminate

BODY = prose(90, 60).replace(",", "").replace(".", "")
CLOSING = "we ask which of these holds"
ITEM = f"{BODY}. {CLOSING}?"


def changed(text, place):
    words = text.split()
    words[place] = "other"
    return " ".join(words)


@pytest.mark.parametrize("schema", ["item_id bigint, text string", "item_id bigint, question string, answer string"])
def test_edits_of_the_last_sentence(spark, schema):
    docs = [(1, ITEM), (2, BODY), *((10 + k, changed(ITEM, -1 - k)) for k in range(6))]
    docs += [(20, f"{BODY} {prose(91, 10)} {CLOSING}"), (21, CLOSING), (22, " ".join(BODY.split()[:40]))]
    items = spark.createDataFrame([(1, ITEM) if "text" in schema else (1, ITEM, None)], schema)
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 10, 11, 12, 13, 14, 15, 20]
    assert all(r.question_overlap >= 0.8 and r.answer_overlap == 1 for r in found)
