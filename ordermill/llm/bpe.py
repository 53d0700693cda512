"""BPE encoding and decoding with contiguous rank arrays.

A word is a row of token ids, its part boundaries; beside it stands the row of the ranks of adjacent
pairs. The smallest rank is looked for again and again, its boundary is deleted and the ranks of the
two neighbours are refreshed. Short words of equal length are the rows of one matrix, so numpy does
a step for all of them at once. Long words, for which scanning would be quadratic, take the same
merges from a heap.

Text between ASCII white space encodes independently of what surrounds it: normalisation and
splitting never reach across. Such chunks are kept in a bounded memo, and so are the words in them.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from ordermill.llm.common import slices, texts, texts_of, tidy

WORD_BPE = "word_bpe_49k.json"
SHORT = 24
NO_RANK = np.int64(1) << 62
MEMO_ENTRIES, MEMO_BYTES = 100_000, 64
# Letters up to U+024F, of which normalising changes the case alone; the pattern that splits them
# into words is the vocabulary's, fixed by its file.
LETTERS = "".join(c for c in map(chr, range(0x80, 0x250)) if c.isalpha() and c != "\u0130")
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z{LETTERS}]+|[0-9]|[^ A-Za-z0-9{LETTERS}]+")
PLAIN = re.compile(rf"[!-~{LETTERS}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that
    are printable in Latin-1 stand for themselves, the others follow from 256 in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(own)]
    return [chr(b) if b in set(own) else chr(256 + others.index(b)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of a tokenizer file with word ends and byte-level symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        self._at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._library = Tokenizer.from_file(path)  # its normaliser and splitter, for other scripts
        symbols = byte_symbols()
        self._inner = np.array([self.vocab[s] for s in symbols], np.int64)
        self._last = np.array([self.vocab[s + suffix] for s in symbols], np.int64)
        pairs = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in map(tuple, model["merges"])]
        self._of = {(a << 32) | b: (rank, new) for rank, (a, b, new) in enumerate(pairs)}
        keys = np.array([(a << 32) | b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self._new = np.array([new for _, _, new in pairs], np.int64)  # by rank
        self._symbol = {s.encode(): b for b, s in enumerate(symbols)}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NO_RANK)

    def _merge_rows(self, ids: np.ndarray) -> list[list[int]]:
        """All merges of words of equal length, one matrix row each."""
        count, width = ids.shape
        result: list = [None] * count
        rows, lengths = np.arange(count), np.full(count, width)
        ranks = np.full((count, width + 1), NO_RANK)  # a column more, for the neighbour at the end
        if width > 1:
            ranks[:, : width - 1] = self._rank(ids[:, :-1], ids[:, 1:])
        ids = np.concatenate([ids, np.zeros((count, 2), np.int64)], axis=1)
        while len(rows):
            best = ranks.argmin(axis=1)
            at = np.arange(len(rows))
            lowest = ranks[at, best]
            done = lowest == NO_RANK
            if done.any():
                for i in np.flatnonzero(done):
                    result[rows[i]] = ids[i, : lengths[i]].tolist()
                go = ~done
                rows, lengths, ids, ranks = rows[go], lengths[go], ids[go], ranks[go]
                best, lowest, at = best[go], lowest[go], np.arange(len(rows))
                if not len(rows):
                    break
            ids[at, best] = self._new[lowest]
            # Delete the boundary: what stands right of the merged pair moves one to the left.
            width = ids.shape[1]
            column = np.arange(width - 1)
            source = column + (column > best[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            column = np.arange(ranks.shape[1] - 1)
            source = column + (column >= best[:, None])
            ranks = np.take_along_axis(ranks, source, axis=1)
            lengths = lengths - 1
            right = np.flatnonzero(best < lengths - 1)
            ranks[right, best[right]] = self._rank(ids[right, best[right]], ids[right, best[right] + 1])
            over = np.flatnonzero(best >= lengths - 1)
            ranks[over, best[over]] = NO_RANK
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self._rank(ids[left, best[left] - 1], ids[left, best[left]])
        return result

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges for one long word, lowest rank first and leftmost among equal ones."""
        count = len(ids)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        alive = [True] * count

        def pair(i: int) -> tuple | None:
            j = after[i]
            found = self._of.get((ids[i] << 32) | ids[j]) if j < count else None
            return (found[0], i, ids[i], ids[j], found[1]) if found else None

        heap = [x for x in map(pair, range(count)) if x]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if alive[i] else count
            if j >= count or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[j] < count:
                before[after[j]] = i
            for x in (pair(i), pair(before[i]) if before[i] >= 0 else None):
                if x:
                    heapq.heappush(heap, x)
        return [x for x, here in zip(ids, alive) if here]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of words, each the UTF-8 of one piece that the splitter gave."""
        result: list = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, members in by_length.items():
            if length <= SHORT:
                raw = np.frombuffer(b"".join(words[i] for i in members), np.uint8).reshape(-1, length)
                ids = self._inner[raw]
                ids[:, -1] = self._last[raw[:, -1]]
                for i, tokens in zip(members, self._merge_rows(ids)):
                    result[i] = tokens
            else:
                for i in members:
                    raw = np.frombuffer(words[i], np.uint8)
                    result[i] = self._merge_long([*self._inner[raw[:-1]].tolist(), int(self._last[raw[-1]])])
        return result

    def split(self, chunk: bytes) -> list[bytes | int]:
        """The words of a chunk, and the ids of special tokens that stand in it."""
        text = chunk.decode()
        if "<|" not in text and PLAIN.fullmatch(text):
            return [w.encode() for w in WORDS.findall(text.lower())]
        parts: list[bytes | int] = []
        for k, part in enumerate(self._at_special.split(text)):
            parts += [self.special[part]] if k % 2 else self._pieces(part)
        return parts

    def _pieces(self, text: str) -> list[bytes]:
        found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(self._symbol[c.encode()] for c in piece) for piece, _ in found]

    def decode(self, ids: list[int]) -> str:
        """The library's text of ids where a file names no decoder: tokens joined by blanks."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


class Memo:
    """Values of keys, computed once while kept.

    Two generations are kept: when the young one is full it becomes the old one, and what is looked up
    there is young again. So what comes often stays, and the size is bounded. ``compute`` takes the
    keys that are missing; long keys are not kept. What it returns does not depend on what it holds.
    """

    def __init__(self, compute: Callable[[list], list], entries: int = MEMO_ENTRIES):
        self._compute, self._entries, self._young, self._old = compute, entries, {}, {}

    def values(self, lists: list[list]) -> Iterator[list]:
        """For each list of keys, their values in order."""
        if len(self._young) > self._entries:
            self._young, self._old = {}, self._young
        young, old = self._young, self._old
        fresh = {key for keys in lists for key in keys if key not in young}
        missing = fresh - old.keys()
        for key in fresh - missing:
            young[key] = old[key]
        missing = list(missing)
        young.update(zip(missing, self._compute(missing)))
        for keys in lists:
            yield [young[key] for key in keys]
        for key in missing:
            if len(key) > MEMO_BYTES:
                del young[key]


class ChunkEncoder:
    """Chunks to (number of ids, ids as text, tokens as text)."""

    def __init__(self, bpe: WordBpe):
        self.bpe, self._words = bpe, {}

    def ids(self, chunks: list[bytes]) -> list[list[int]]:
        words = self._words
        if len(words) > MEMO_ENTRIES:
            words.clear()
        pieces = [self.bpe.split(chunk) for chunk in chunks]
        missing = list({w for ws in pieces for w in ws if w.__class__ is bytes and w not in words})
        words.update(zip(missing, self.bpe.encode_words(missing)))
        out = []
        for ws in pieces:
            if len(ws) == 1 and ws[0].__class__ is bytes:
                out.append(words[ws[0]])
                continue
            joined: list[int] = []
            for w in ws:
                joined += [w] if w.__class__ is int else words[w]
            out.append(joined)
        for w in [w for w in missing if len(w) > MEMO_BYTES]:
            del words[w]
        return out

    def __call__(self, chunks: list[bytes]) -> list[tuple[int, str, str]]:
        tokens = self.bpe.tokens
        return [
            (len(ids), " ".join(map(str, ids)), " ".join([tokens[i] for i in ids])) for ids in self.ids(chunks)
        ]


SCHEMA = "doc_id bigint, n_tokens bigint, ids_text string, decoded string"


def coder(path: str, digests: Callable[[str], str] | None) -> Callable:
    """Arrow batches of doc_id and text to ``SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(ChunkEncoder(WordBpe(path)))
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                counts, ids, decoded = [], [], []
                for values in memo.values([text.split() for text in texts_of(part)]):
                    values = [v for v in values if v[0]]
                    counts.append(sum(v[0] for v in values))
                    ids.append(" ".join([v[1] for v in values]))
                    decoded.append(" ".join([v[2] for v in values]))
                if digests:
                    ids, decoded = list(map(digests, ids)), list(map(digests, decoded))
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=["doc_id", "n_tokens", "ids_text", "decoded"],
                )

    return run


def encode_documents(
    docs: DataFrame, tokenizer: str | None = None, digests: Callable[[str], str] | None = None
) -> DataFrame:
    """Every whole text of ``docs`` encoded and decoded again.

    Returns doc_id, n_tokens, ids_text (decimal ids joined by one blank) and decoded; with
    ``digests``, that function of the two texts instead of the texts. A null or empty text has no
    tokens and two empty texts. Repeated rows give repeated rows; other columns are not read, and an
    empty table gives an empty one.
    """
    return texts(docs).mapInArrow(tidy(coder(tokenizer or public_tokenizers.path(WORD_BPE), digests)), SCHEMA)
