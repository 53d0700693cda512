"""Cross-entropy difference of two matched word bigram models.

Both models count the bigrams of words over all words of the corpus, none of which becomes an unknown
one; both are smoothed alike (Witten-Bell: bigrams, words, the uniform distribution). The target model
counts the target documents, the background model all documents. A document's score is the mean over
its tokens, the closing boundary included, of the target's loss less the background's: the lower, the
more it is like the target.

A word is a run of letters, digits and underscores in lower case, one ideograph or kana, or one other mark. Words
travel as 64-bit hashes and bigrams as one such number.

Texts are split into words once and stored in pieces of some megabytes. A piece sends each of its distinct bigrams
with its own counts to the part of the bigram's hash, whose task adds up what all pieces sent and answers each with
the counts of the whole corpus in the order of its question; where a bigram came up first, the answer marks it. The
marked ones of a piece give its share of the kinds that follow a word, so the words are asked about in the same way,
and then every piece can score its texts. A part has about ``HOT`` keys, frequent ones count once per piece, and what
is sent grows with the input alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored, sized, slices, texts, tidy

HOT, ROWS = 1 << 20, 16  # keys per part; messages per batch
_SINGLE = "぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[{_SINGLE}]|[^\W{_SINGLE}]+|[^\w\s]")
MESSAGE = "piece bigint, kind int, part int, data array<binary>, sums array<bigint>"
TEXTS, GRAMS, WORDS = 0, 1, 2  # kinds of messages
SCORES = "doc_id bigint, n_tokens bigint, score double"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def _bytes(numbers: np.ndarray) -> bytes:
    """Whole numbers by place of their bytes, as many places as the largest one needs: counts are mostly small."""
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T
    size = len(numbers) and (8 if numbers.min() < 0 else max(1, (int(numbers.max()).bit_length() + 7) // 8))
    return planes[:size].tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    if n:
        wide[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n).T
    return wide.view("<i8").ravel()


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    piece, kind, part, data, sums = zip(*rows) if rows else [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()))
    return pa.record_batch(
        [pa.array(x, k) for x, k in zip((piece, kind, part, data, sums), kinds)], names=["piece", "kind", "part", "data", "sums"]
    )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a piece as numbers of its own words. A boundary, the hash of no word, closes each text."""
    piece = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in slices(batch, "text"):
            lists = [words_of(x) for x in part.column("text").to_pylist()]
            lengths = np.array([len(x) + 1 for x in lists], np.int64)
            words = pa.array(chain.from_iterable(lists), pa.string()).dictionary_encode()
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in ["", *words.dictionary.to_pylist()]], np.uint64)
            second = np.zeros(int(lengths.sum()), np.int64)
            inside = np.ones(len(second), bool)
            inside[np.cumsum(lengths) - 1] = False
            second[inside] = words.indices.to_numpy().astype(np.int64) + 1
            ids = part.column("doc_id")
            target = part.column("target").to_numpy(zero_copy_only=False).astype(np.uint8)
            data = [
                hashes.tobytes(), _bytes(second), _bytes(lengths), target.tobytes(),
                _bytes(ids.fill_null(0).to_numpy()), ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
            ]
            yield _messages([(piece, TEXTS, 0, data, [len(second), len(hashes)])])
            piece += 1


class Piece:
    """The stored texts of a piece, and the answers that it has got."""

    def __init__(self, messages: list[dict]):
        self.texts = next(m["data"] for m in messages if m["kind"] == TEXTS)
        self.messages = messages
        self.hashes = np.frombuffer(self.texts[0], np.uint64)
        self.lengths = _numbers(self.texts[2], len(self.texts[3]))
        self.second = _numbers(self.texts[1], int(self.lengths.sum()))
        # Distinct bigrams as the numbers of both words, and which of them ends at each token.
        first = np.concatenate([[0], self.second[:-1]])
        kinds, self.which = np.unique(first * len(self.hashes) + self.second, return_inverse=True)
        self.w1, self.w2 = kinds // len(self.hashes), kinds % len(self.hashes)
        self.grams = gram_of(self.hashes[self.w1], self.hashes[self.w2])

    def counts(self, which: np.ndarray, n: int) -> list[np.ndarray]:
        """Of all and of the target's tokens, by number."""
        target = np.repeat(np.frombuffer(self.texts[3], np.uint8).astype(bool), self.lengths)
        return [np.bincount(x, minlength=n) for x in (which, which[target])]

    def answers(self, kind: int, keys: np.ndarray) -> list[np.ndarray]:
        """What the parts answered, in the order of ``keys``."""
        found = sorted((m for m in self.messages if m["kind"] == kind), key=lambda m: m["part"])
        order = np.argsort(keys, kind="stable")
        sizes = [m["sums"][-1] for m in found]
        out = []
        for column in zip(*(m["data"] for m in found)):
            values = np.empty(len(keys), np.int64)
            values[order] = np.concatenate([_numbers(x, n) for x, n in zip(column, sizes)])
            out.append(values)
        return out


def _questions(piece: int, kind: int, keys: np.ndarray, counts: list[np.ndarray], parts: int) -> list[tuple]:
    """A message per part with the keys that fall there, in ascending order, and their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], [c[order] for c in counts]
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(part, np.arange(parts + 1))
    spans = [(p, slice(a, b)) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    return [(piece, kind, p, [keys[at].tobytes(), *(_bytes(c[at]) for c in counts)], []) for p, at in spans]


def _ask_grams(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                message = batch.slice(row, 1).to_pylist()
                own = Piece(message)
                rows = _questions(message[0]["piece"], GRAMS, own.grams, own.counts(own.which, len(own.grams)), parts)
                for first in range(0, len(rows), ROWS):
                    yield _messages(rows[first : first + ROWS])

    return run


def _ask_words(parts: int) -> Callable:
    """How often each word stands in a piece, and how many kinds of words were first seen here to follow it."""

    def run(table: pa.Table) -> pa.Table:
        own = Piece(table.to_pylist())
        _, target, new = own.answers(GRAMS, own.grams)
        n = len(own.hashes)
        kinds = [np.bincount(own.w1[x], minlength=n) for x in (new > 0, (new > 0) & (target > 0))]
        rows = _questions(table["piece"][0].as_py(), WORDS, own.hashes, own.counts(own.second, n) + kinds, parts)
        return pa.Table.from_batches([_messages(rows)])

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums over all questions of a part for each key, and whether it came up here first. ``sums`` has
    the number of these new keys, their first two sums, how many have a count of the target, and the number of keys asked."""
    rows = [m for batch in batches for m in batch.to_pylist()]
    if not rows:
        return
    keys = [np.frombuffer(m["data"][0], np.uint64) for m in rows]
    _, at, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    new = np.zeros(len(which), np.int64)
    new[at] = 1
    sums = []
    for column in zip(*(m["data"][1:] for m in rows)):
        total = np.zeros(len(at), np.int64)
        np.add.at(total, which, np.concatenate([_numbers(x, len(k)) for x, k in zip(column, keys)]))
        sums.append(total)
    stops = np.cumsum([len(k) for k in keys])
    for m, stop, n in zip(rows, stops, map(len, keys)):
        asked, fresh = which[stop - n : stop], new[stop - n : stop]
        own = [total[asked] for total in sums]
        whole = [fresh.sum(), *((x * fresh).sum() for x in own[:2]), ((own[1] > 0) * fresh).sum(), n]
        yield _messages([(m["piece"], m["kind"], m["part"], [_bytes(x) for x in (*own, fresh)], [int(x) for x in whole])])


def _score(kinds: int, total: int, aimed: int, aimed_kinds: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        own = Piece(table.to_pylist())
        background, target, _ = own.answers(GRAMS, own.grams)
        b, t, b_kinds, t_kinds, _ = own.answers(WORDS, own.hashes)
        t_kinds = np.maximum(t_kinds, 1)
        # Every token but for the boundaries' places stands as often before a word as behind one.
        single = (b + 1.0) / (total + kinds), (t + aimed_kinds / kinds) / (aimed + aimed_kinds)
        w1, w2 = own.w1, own.w2
        losses = np.log((background + b_kinds[w1] * single[0][w2]) / (b[w1] + b_kinds[w1]))
        losses -= np.log((target + t_kinds[w1] * single[1][w2]) / (t[w1] + t_kinds[w1]))
        sums = np.add.reduceat(losses[own.which], np.cumsum(own.lengths) - own.lengths)
        ids = pa.array(_numbers(own.texts[4], len(own.lengths)), mask=np.frombuffer(own.texts[5], bool))
        return pa.table([ids, pa.array(own.lengths), pa.array(sums / own.lengths)], names=["doc_id", "n_tokens", "score"])

    return run


def gram_of(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """One number for a bigram."""
    return (w1 << np.uint64(21) | w1 >> np.uint64(43)) ^ w2


def _parts(keys: int | None) -> int:
    return max(1, -(-(keys or 0) // HOT))


def word_cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` of every row of ``docs``.

    ``target_ids`` has the column doc_id; repeated or null ids there change nothing. A null text counts
    and scores as an empty one, whose one token is its boundary. Without target documents that
    model is the uniform distribution. Rows that repeat count as often as they stand there.
    """
    spark = docs.sparkSession
    stored, last = Stored(spark), Stored(spark)
    chosen = target_ids.selectExpr("CAST(doc_id AS BIGINT) AS doc_id").distinct().withColumn("target", F.lit(True))
    flagged = texts(docs).join(sized(chosen), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    kept = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")  # what a step has sent goes when its result is stored
    try:
        pieces = stored.put(flagged.mapInArrow(tidy(_split), MESSAGE), "pieces")
        tokens, words = pieces.agg(F.sum(F.get("sums", F.lit(0))), F.sum(F.get("sums", F.lit(1)))).head()

        def answered(questions: DataFrame, parts: int, label: str) -> DataFrame:
            return stored.put(questions.repartitionById(parts, "part").mapInArrow(tidy(_answer), MESSAGE), label)

        grams = answered(pieces.mapInArrow(tidy(_ask_grams(_parts(tokens))), MESSAGE), _parts(tokens), "grams")
        asked = pieces.unionByName(grams).groupBy("piece").applyInArrow(_ask_words(_parts(words)), MESSAGE)
        known = answered(asked, _parts(words), "words")
        kinds, total, aimed, aimed_kinds = known.agg(*(F.coalesce(F.sum(F.get("sums", F.lit(k))), F.lit(0)) for k in range(4))).head()
        scores = pieces.unionByName(grams).unionByName(known).groupBy("piece")
        result = last.put(scores.applyInArrow(_score(max(1, kinds), total, aimed, max(1, aimed_kinds)), SCORES), "scores")
    finally:
        if kept is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, kept)
    stored.drop()
    return result
