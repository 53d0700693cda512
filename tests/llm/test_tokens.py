"""BPE and token files against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermill.llm import bpe, entries, token_files
from ordermill.llm.common import table
from ordermill.operators.storage import scratch_path

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    draw = random.Random(3)
    pool = "abAB'sé́ \tİ<|endoftext|>12ß日Σ\x1d .ÉǄªª²\x85\xa0"
    fixed = ["<|startoftext|><|endoftext|>x", "'S don't DON'T", "a\x0bb\x0cc\x00", "abc" * 900 + "é" * 300]
    return fixed + ["".join(draw.choice(pool) for _ in range(draw.randint(0, 60))) for _ in range(500)]


def test_rank_arrays_merge_like_the_library(library):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdefghinort") for _ in range(draw.randint(1, 60))).encode() for _ in range(500)]
    found = bpe.WordBpe(PATH).encode_words(words)
    assert found == [ids_of(library, w.decode()) for w in words]


def test_long_words_take_the_same_merges(library):
    coder = bpe.WordBpe(PATH)
    word = ("thereof" * 40).encode()
    ids = [*coder._inner[list(word[:-1])].tolist(), int(coder._last[word[-1]])]
    assert coder._merge_long(ids) == ids_of(library, word.decode())


def test_encode_documents(with_clashes, edge_rows, library):
    rows = [*edge_rows, *enumerate(odd_texts(), 1_000)]
    found = bpe.encode_documents(with_clashes(rows)).collect()
    expected = []
    for doc, text in rows:
        ids = ids_of(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), " ".join(map(str, ids)), decoded))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.encode_documents(empty).count() == 0
    assert token_files.token_files_round_trip(empty).count() == 0


def test_op5_on_a_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for row in entries.op5_bpe(spark, SF).collect():
        ids = ids_of(library, texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def spans(rows, library):
    start, found = 0, []
    for doc, text in rows:
        ids = [*ids_of(library, text), token_files.END_ID]
        found.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return found


def test_token_files(with_clashes, edge_rows, library):
    rows = [(d, t) for d, t in edge_rows if d is not None and d != 8] + list(enumerate(odd_texts(), 1_000))
    shuffled = random.Random(2).sample(rows, len(rows))
    found = token_files.token_files_round_trip(with_clashes(shuffled)).orderBy("start").collect()
    assert list(map(tuple, found)) == spans(rows, library)


def test_rows_without_id_come_first(spark, library):
    rows = [(3, "c"), (None, "one two"), (-5, None), (None, "one two"), (0, "zero"), (None, "one two")]
    found = token_files.token_files_round_trip(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    ordered = [r for r in rows if r[0] is None] + sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    assert list(map(tuple, found.orderBy("start").collect())) == spans(ordered, library)


def test_an_id_of_many_rows_fills_several_parts(spark):
    rows = [(i, "the of") for i in range(50)] + [(50, "the of")] * 300 + [(51 + i, "the of") for i in range(50)] + [(None, "the")] * 200
    folder = scratch_path(spark, "many")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    manifest = token_files.write_token_files(docs, folder, parts=12).collect()
    assert max(r.n_docs for r in manifest) < 130 and sum(r.n_unnamed for r in manifest) == 200
    found = token_files.read_token_files(spark, folder).orderBy("start").collect()
    ids = [r.doc_id for r in found]
    assert ids[:200] == [None] * 200 and ids[200:] == sorted(d for d, _ in rows if d is not None)
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:k]) for k in range(len(found))]


def test_parts_follow_the_size_of_the_input(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    assert token_files._parts(docs) == 8
    monkeypatch.setattr(token_files, "PART_BYTES", 1 << 12)
    assert token_files._parts(docs) > 20
    assert token_files._parts(spark.createDataFrame([(1, "a")], "doc_id bigint, text string")) == 8  # of no known size


def test_op2_on_a_whole_table(spark, library):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    found = entries.op2_token_files(spark, SF).orderBy("doc_id").collect()
    assert list(map(tuple, found)) == spans(rows, library)


def test_wide_ids_take_four_bytes(spark, monkeypatch):
    monkeypatch.setattr(token_files, "id_width", lambda path: 4)
    docs = spark.createDataFrame([(2, "the of"), (1, "and")], "doc_id bigint, text string")
    folder = scratch_path(spark, "wide")
    manifest = token_files.write_token_files(docs, folder).collect()
    assert {r.width for r in manifest} == {4}
    assert [r.start for r in token_files.read_token_files(spark, folder).orderBy("start").collect()] == [0, 2]
