"""Benchmark decontamination: every passage asks a BM25 index of test items, block-max WAND answers.

Test items are the documents of the index, training passages its queries. A posting holds the share
that a term contributes to the item's own score, so a score of 1 is the whole item and one
threshold serves items of all lengths. Postings lie in blocks with their largest share. A passage
whose terms cannot add up to the threshold by their largest shares in any block of items is not looked up;
the others walk the postings, skipping blocks that cannot reach it. All items above the threshold come
back, and each is verified: the shingles of its question and of its answer must stand in the passage,
or, of an item without an answer of its own, those of the whole text.

The index is broadcast in parts of at most ``INDEX_WORDS`` words, each of which all passages ask, so a
benchmark of any size works. Texts are read where they lie; nothing but findings is shuffled.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import slices, texts, tidy

SHINGLE, OVERLAP, THRESHOLD = 5, 0.8, 0.6
PASSAGE, BLOCK, INDEX_WORDS = 128, 32, 300_000
ITEM_BLOCK, TABLE = 4, 1 << 24
K1, B, COMMON_SHARE = 1.2, 0.75, 0.05
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
FOUND = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def term(word: str) -> str:
    """A word in lower case without the marks around it; nothing for a word of marks alone."""
    word = word.lower()
    if word.isalpha():
        return word
    return word.strip(string.punctuation) if word.isascii() and word.isprintable() else _EDGE.sub("", word)


def terms(text: str) -> list[str]:
    return [t for t in map(term, text.split()) if t]


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence is the answer if there are several."""
    sentences = [s for s in _SENTENCE.split(text.strip()) if terms(s)]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


class ItemIndex:
    """An inverted index of items (id, question, answer) with the statistics of the whole benchmark."""

    def __init__(self, items: list[tuple[int, str, str]], frequency: dict[str, int], count: int, mean: float):
        self.ids = [i for i, _, _ in items]
        self.parts = [(terms(q), terms(a)) for _, q, a in items]
        # Without an answer of its own, an item may also stand in two pieces, its last sentence apart.
        self.pieces = [None if own[1] else [terms(x) for x in question_and_answer(q)] for (_, q, _), own in zip(items, self.parts)]
        self.numbers: dict[str, int] = {}
        postings: list[list[tuple[int, float]]] = []
        self.longest = 0
        for item, (question, answer) in enumerate(self.parts):
            words = question + answer
            self.longest = max(self.longest, len(words))
            often = Counter(words)
            norm = K1 * (1 - B + B * len(words) / max(mean, 1e-9))
            weight = {
                w: math.log(1 + (count - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                for w, n in often.items()
            }
            total = sum(weight.values())
            for w, value in weight.items():
                number = self.numbers.setdefault(w, len(self.numbers))
                if number == len(postings):
                    postings.append([])
                postings[number].append((item, value / total))
        self.items = [[i for i, _ in p] for p in postings]
        self.shares = [[s for _, s in p] for p in postings]
        self.tops = [[max(s[k : k + BLOCK]) for k in range(0, len(s), BLOCK)] for s in self.shares]
        self.top = np.array([*(max(s) for s in self.shares), 0.0])
        self.common = np.array([*(len(p) > COMMON_SHARE * len(items) for p in postings), False])
        # Largest share of a term within each block of items, for the bound of whole passages.
        size = max(ITEM_BLOCK, -(-len(self.numbers) * len(items) // TABLE))
        self.table = np.zeros((len(self.numbers), -(-len(items) // size)), np.float32)
        for t, (own, shares) in enumerate(zip(self.items, self.shares)):
            np.maximum.at(self.table[t], np.array(own) // size, np.array(shares, np.float32))
        self._top, self._common = self.top.tolist(), self.common.tolist()
        # Common terms together give an item no more than the largest such sum of any item.
        sums = np.zeros(len(items))
        for t in np.flatnonzero(self.common):
            sums[self.items[t]] += self.shares[t]
        self.common_top = float(sums.max(initial=0.0)) + 1e-9

    def above(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """Items whose score for these distinct terms reaches the threshold; block-max WAND."""
        cursors = [[self.items[t][0], 0, t] for t in query]
        found, top, common, most = [], self._top, self._common, self.common_top
        while cursors:
            cursors.sort()
            rare, often, pivot = 0.0, 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                if common[t]:
                    often += top[t]
                else:
                    rare += top[t]
                if rare + min(often, most) >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # The blocks that hold the item, or would, bound what it and its neighbours can score.
            rare, often = 0.0, 0.0
            beyond = cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.ids)
            for _, at, t in cursors[: pivot + 1]:
                items = self.items[t]
                block = at // BLOCK
                while (block + 1) * BLOCK < len(items) and items[(block + 1) * BLOCK - 1] < item:
                    block += 1
                if items[min((block + 1) * BLOCK, len(items)) - 1] >= item:
                    if common[t]:
                        often += self.tops[t][block]
                    else:
                        rare += self.tops[t][block]
                    beyond = min(beyond, items[min((block + 1) * BLOCK, len(items)) - 1] + 1)
            if rare + min(often, most) < threshold:
                self._advance(cursors, pivot, max(beyond, item + 1))
            elif cursors[0][0] == item:
                score = sum(self.shares[t][at] for i, at, t in cursors[: pivot + 1] if i == item)
                if score >= threshold:
                    found.append((item, score))
                self._advance(cursors, pivot, item + 1)
            else:
                self._advance(cursors, pivot, item)
        return found

    def _advance(self, cursors: list[list[int]], pivot: int, item: int) -> None:
        """Move the cursors up to the pivot to the first posting at or after ``item``."""
        for cursor in cursors[: pivot + 1]:
            _, at, t = cursor
            items = self.items[t]
            at = bisect_left(items, item, at)
            cursor[0], cursor[1] = (items[at] if at < len(items) else len(self.ids)), at
        cursors[:] = [c for c in cursors if c[1] < len(self.items[c[2]])]

    def overlaps(self, item: int, passage: list[int], shingle: int) -> tuple[float, float]:
        """Shares of the question's and the answer's shingles in the passage; 1 where there are none. Of an
        item without an answer the share of the whole, or of its two pieces where both have more."""

        def share(words: list[str]) -> float:
            own = [self.numbers[w] for w in words]
            size = min(shingle, len(own))
            if not size:
                return 1.0
            wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
            there = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
            return len(wanted & there) / len(wanted)

        question, answer = map(share, self.parts[item])
        if self.pieces[item] is not None:
            question = max(question, min(map(share, self.pieces[item])))
        return question, answer


def passages(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts one after another: each passage's text, start and end. They overlap by half."""
    stride = size // 2
    counts = np.maximum(1, -(-lengths // stride) - 1)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.cumsum(lengths) - lengths
    start = begin[text] + nth * stride
    return text, start, np.minimum(start + size, begin[text] + lengths[text])


def promising(index: ItemIndex, sequence: np.ndarray, start: np.ndarray, end: np.ndarray, threshold: float) -> np.ndarray:
    """The passages whose distinct terms can reach the threshold in some block of items."""
    known = np.flatnonzero(sequence < len(index.numbers))
    first, last = np.searchsorted(known, start), np.searchsorted(known, end)
    sizes = last - first
    if not sizes.sum():
        return np.empty(0, np.int64)
    place = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    pairs = np.repeat(np.arange(len(start)), sizes) * len(index.numbers) + sequence[known[place]]
    pairs.sort()
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    owner, number = np.divmod(pairs, len(index.numbers))
    found = []
    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
    step = max(1, TABLE // 8 // index.table.shape[1] // 64)
    for k in range(0, len(cuts), step):
        some = cuts[k : k + step]
        stop = cuts[k + step] if k + step < len(cuts) else len(pairs)
        bound = np.add.reduceat(index.table[number[some[0] : stop]], some - some[0], axis=0).max(axis=1)
        found.append(owner[some[bound >= threshold - 1e-4]])
    return np.concatenate(found)


def findings(
    index: ItemIndex, sequence: np.ndarray, lengths: np.ndarray, threshold: float, overlap: float, shingle: int
) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Verified (text, item) of texts given as term numbers; the last number stands for foreign terms."""
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    text, start, end = passages(lengths, max(PASSAGE, 2 * index.longest))
    foreign = len(index.numbers)
    for k in promising(index, sequence, start, end, threshold).tolist():
        passage = sequence[start[k] : end[k]].tolist()
        for item, score in index.above(sorted(set(passage) - {foreign}), threshold):
            question, answer = index.overlaps(item, passage, shingle)
            if min(question, answer) >= overlap:
                at, found = (int(text[k]), item), (score, question, answer)
                best[at] = max(best.get(at, found), found)
    return best


def _ask(index, threshold: float, overlap: float, shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = cloudpickle.loads(index.value)
        foreign = len(items.numbers)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                # Arrow numbers the words of a slice; only distinct ones become terms here. White
                # space beyond ASCII is cut out of the few words that hold it.
                split = pc.ascii_split_whitespace(pc.fill_null(part.column("text"), ""))
                words = split.flatten().dictionary_encode()
                kinds, odd = [], {}
                for k, word in enumerate(words.dictionary.to_pylist()):
                    if not word.isascii() and len(pieces := word.split()) > 1:
                        odd[k] = [items.numbers.get(t, foreign) for t in map(term, pieces) if t]
                        kinds.append(-1)
                    else:
                        kinds.append(items.numbers.get(t, foreign) if (t := term(word)) else -1)
                number = np.array(kinds or [-1], np.int64)
                indices = words.indices.to_numpy()
                offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
                sequence, lengths = number[indices], np.diff(offsets)
                if odd:
                    texts = [sequence[a:b] for a, b in zip(offsets, offsets[1:])]
                    for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                        own = indices[a:b].tolist()
                        if not odd.keys().isdisjoint(own):
                            texts[row] = np.array([n for k in own for n in odd.get(k, [number[k]])], np.int64)
                    sequence, lengths = np.concatenate(texts), np.array([len(x) for x in texts])
                real = sequence >= 0
                ends = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(lengths)])]
                found = findings(items, sequence[real], np.diff(ends), threshold, overlap, shingle)
                docs = part.column("doc_id").to_pylist()
                rows = [(docs[row], items.ids[item], *values) for (row, item), values in found.items()]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return run


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, question and answer. A table with the column text holds whole items without answers."""
    if "question" in benchmark.columns:
        return benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "question", "answer")
    return benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("question"), F.lit(None).cast("string").alias("answer"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shingle: int = SHINGLE
) -> DataFrame:
    """One row per document and test item that stands in it: ``doc_id``, ``item_id``, the best
    ``score`` and the shares of the item's ``shingle``-word shingles found: of question and answer, or of the whole
    text as the question where an item has no answer.

    Words are compared in lower case without surrounding marks. Null and empty texts, on either side,
    match nothing; neither do rows without id. Items that repeat an id are looked for each, and the
    best stays. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    given = texts(docs).where("doc_id IS NOT NULL")
    rows = benchmark_items(benchmark).where("item_id IS NOT NULL").orderBy("item_id").toLocalIterator()
    found, held, group = None, 0, []
    groups = []
    frequency: Counter = Counter()
    count = total = 0
    for row in rows:
        question, answer = row.question or "", row.answer or ""
        words = terms(question) + terms(answer)
        if not words:
            continue
        frequency.update(set(words))
        count, total = count + 1, total + len(words)
        group.append((row.item_id, question, answer))
        held += len(words)
        if held >= INDEX_WORDS:
            groups.append(group)
            held, group = 0, []
    if group:
        groups.append(group)
    for group in groups:
        index = spark.sparkContext.broadcast(cloudpickle.dumps(ItemIndex(group, frequency, count, total / count)))
        some = given.mapInArrow(tidy(_ask(index, threshold, overlap, shingle)), FOUND)
        found = some if found is None else found.union(some)
    if found is None:
        return spark.createDataFrame([], FOUND)
    return found.groupBy("doc_id", "item_id").agg(
        *(F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap"))
    )
