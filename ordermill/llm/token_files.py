"""Token ids as flat binary files with 64-bit document offsets.

A folder of token files holds, per part, ``<name>.ids`` (unsigned little-endian integers of 2 or 4
bytes, all documents one after another), ``<name>.docs`` (64-bit document ids) and
``<name>.offsets`` (64-bit, one more than documents: where each document starts within the part).
The manifest, a Parquet table, has one row per part: its number, its first id's place in the whole
(``base``, the prefix sum of the parts before), its counts and its file names. Parts are ranges
of ascending document id. Documents without an id come first; a part's row says how many of its first
documents these are (``n_unnamed``), and their place in ``.docs`` holds 0. Documents of one id follow each
other in no order that counts, so an id that many share fills several parts.

Documents are encoded where they are read; what is shuffled are packed ids, by part numbers that
come from quantiles of the id column alone, so nothing is encoded twice to find the cuts. A task
writes files under a name of its own attempt and reports it in its manifest row; Spark commits that
row for one attempt only, so files of lost or repeated attempts are never listed.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import files
from ordermill.llm.bpe import PLAIN, WORD_BPE, WORDS, Memo
from ordermill.llm.common import slices, texts, tidy
from ordermill.operators.storage import qualified, scratch_path

END_ID = 2
SLICE, ROWS = 8 << 20, 500
PART_BYTES, LARGEST = 128 << 20, 1 << 50  # of input per part; estimates beyond the latter say nothing
PART_SCHEMA = "part int, n_docs bigint, n_unnamed bigint, n_tokens bigint, width int, name string"
SPAN_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def id_width(path: str) -> int:
    """Bytes per id: 2 where the vocabulary allows it, else 4."""
    tokenizer = Tokenizer.from_file(path)
    return 2 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


class WordIds:
    """Ids of chunks between ASCII white space, with the library.

    Chunks of ASCII and Latin letters are split into the words that the vocabulary's pattern gives,
    each of which ends in a token that only ends words; so many new words go to the library as one
    text and its ids are cut at those ends. Other chunks go there as they are. Words are kept
    up to a bounded number.
    """

    KEPT, AT_ONCE = 200_000, 64

    def __init__(self, path: str, width: int):
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._kind, self._kept = f"<u{width}", {}
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self._kind) for x in found]

    def _learn(self, words: list[str]) -> None:
        groups = [words[i : i + self.AT_ONCE] for i in range(0, len(words), self.AT_ONCE)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(group):  # never seen; then each word by itself
                self._kept.update(zip(group, (x.tobytes() for x in self._encode(group))))
                continue
            data, size, at = ids.tobytes(), ids.itemsize, 0
            for word, end in zip(group, ends.tolist()):
                self._kept[word] = data[at * size : end * size]
                at = end

    def __call__(self, chunks: list[str]) -> list[bytes]:
        kept, plain, words_of = self._kept, PLAIN.fullmatch, WORDS.findall
        if len(kept) > self.KEPT:
            kept.clear()
        # Most chunks are one word of letters; the others are split, or left to the library.
        single = [c.lower() if c.isascii() and c.isalpha() else None for c in chunks]
        rest = [c for c, word in zip(chunks, single) if word is None]
        split = [words_of(c.lower()) if plain(c) and "<|" not in c else None for c in rest]
        new = {w for w in single if w is not None and w not in kept}
        new.update(w for words in split if words for w in words if w not in kept)
        self._learn(list(new))
        others = iter([x.tobytes() for x in self._encode([c for c, words in zip(rest, split) if words is None])])
        joined = iter([next(others) if words is None else b"".join([kept[w] for w in words]) for words in split])
        return [next(joined) if word is None else kept[word] for word in single]


def packed_ids(path: str, end_id: int, width: int) -> Callable:
    """Arrow batches of doc_id and text to doc_id and the bytes of the ids, end id included.

    The words of a slice are numbered by Arrow, each distinct one is encoded once, and numpy
    puts the ids of all words in their places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to give out
        encode, kind = Memo(WordIds(path, width)), f"<u{width}"
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                column = pc.fill_null(part.column("text"), "")
                if not pc.any(pc.match_substring(column, "<|")).as_py():
                    column = pc.ascii_lower(column)  # special tokens are the only case that counts
                split = pc.ascii_split_whitespace(column)
                words = split.flatten().dictionary_encode()
                values = [*next(encode.values([words.dictionary.to_pylist()])), end]
                sizes = np.array([len(v) // width for v in values], np.int64)
                places, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(values), kind)
                stops = split.offsets.to_numpy() - split.offsets[0].as_py()
                numbers = np.insert(words.indices.to_numpy(), stops[1:], len(values) - 1)
                stops = stops + np.arange(len(stops))
                for first in range(0, part.num_rows, ROWS):
                    some = stops[first : first + ROWS + 1]
                    own = numbers[some[0] : some[-1]]
                    each = sizes[own]
                    after = np.cumsum(each)
                    ids = flat[np.repeat(places[own] - (after - each), each) + np.arange(after[-1])]
                    bounds = np.concatenate([[0], after[some[1:] - some[0] - 1]]) * width
                    data = pa.Array.from_buffers(
                        pa.large_binary(), len(some) - 1, [None, pa.py_buffer(bounds.astype("<i8").tobytes()), pa.py_buffer(ids.tobytes())]
                    )
                    yield pa.record_batch(
                        [part.column("doc_id").slice(first, len(some) - 1), data.cast(pa.binary())], names=["doc_id", "ids"]
                    )

    return run


def _part_writer(folder: str, width: int) -> Callable:
    """Writes the rows of one part, which come in order, and reports the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_file, docs, ends, part, name = None, [], [np.zeros(1, np.int64)], None, None
        total = unnamed = 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if ids_file is None:
                    part = batch.column("part")[0].as_py()
                    name = f"part-{part:06d}-{uuid.uuid4().hex}"
                    ids_file = files.create(f"{folder}/{name}.ids")
                rows = batch.column("ids").to_pylist()
                for row in rows:
                    ids_file.write(row)
                sizes = np.array([len(row) // width for row in rows], np.int64)
                ends.append(total + np.cumsum(sizes))
                total += int(sizes.sum())
                unnamed += batch.column("doc_id").null_count
                docs.append(pc.fill_null(batch.column("doc_id"), 0).to_numpy().astype(np.int64))
        finally:
            if ids_file is not None:
                ids_file.close()
        if name is None:
            return
        for suffix, arrays in (("docs", docs), ("offsets", ends)):
            with files.create(f"{folder}/{name}.{suffix}") as file:
                for array in arrays:
                    file.write(array.astype("<i8").tobytes())
        count = sum(map(len, docs))
        yield pa.record_batch(
            [pa.array([part], pa.int32()), *(pa.array([x]) for x in (count, unnamed, total)), pa.array([width], pa.int32()), pa.array([name])],
            names=["part", "n_docs", "n_unnamed", "n_tokens", "width", "name"],
        )

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, parts: int | None = None
) -> DataFrame:
    """Encode ``docs`` into token files in ``folder`` and return the manifest, stored there too.

    ``parts`` is the number of ranges, by default one per ``PART_BYTES`` of input as Spark estimates it, but
    ``spark.sql.shuffle.partitions`` at least. A null or empty text is the end id alone. Rows without an id
    come first, rows that repeat one stay, one after another. Long texts are encoded whole, other columns
    are not read, and an empty table gives an empty manifest.
    """
    spark, path = docs.sparkSession, tokenizer or public_tokenizers.path(WORD_BPE)
    folder, width = qualified(spark, folder), id_width(path)
    parts = parts or _parts(docs)
    given = texts(docs)
    first = F.lit(-(1 << 63)).cast("bigint")  # stands for no id, before all others
    key = F.coalesce("doc_id", first)
    cuts = given.agg(F.percentile_approx(key, [k / parts for k in range(1, parts)] or [0.5], 100 * parts)).head()[0]
    part_of = F.lit(0)
    if cuts and parts > 1:
        # The part of an id is the number of cuts below it; an id that fills several cuts is dealt to them.
        cuts, numbers = sorted(cuts), F.monotonically_increasing_id()
        below = F.expr(f"{len(cuts)} - aggregate({_constant(cuts)}, 0, (n, c) -> n + CAST(c >= key AS INT))")
        equal = F.expr(f"aggregate({_constant(cuts)}, 0, (n, c) -> n + CAST(c = key AS INT))")
        part_of = below + F.pmod(numbers, F.greatest(equal, F.lit(1)))
    packed = given.mapInArrow(tidy(packed_ids(path, end_id, width)), "doc_id bigint, ids binary")
    ordered = (
        packed.withColumn("key", key).withColumn("part", part_of.cast("int")).drop("key")
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"))
    )
    where = f"{folder}/manifest"
    written = ordered.mapInArrow(tidy(_part_writer(folder, width)), PART_SCHEMA)
    written.write.parquet(f"{where}-counts")
    counts = spark.read.schema(PART_SCHEMA).parquet(f"{where}-counts")
    # One row per part: the prefix sum needs a single small window.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(where)
    return spark.read.parquet(where)


def _parts(docs: DataFrame) -> int:
    """How many parts the estimated size of the documents asks for."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, -(-size // PART_BYTES)) if size < LARGEST else least


def _constant(cuts: list[int]) -> str:
    return "from_json('[" + ",".join(map(str, cuts)) + "]', 'array<bigint>')"


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens
    and ids_crc32, the crc32 of its ids as unsigned little-endian 32-bit integers."""
    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = files.mapped(f"{folder}/{row['name']}.ids", f"<u{row['width']}")
                docs = files.mapped(f"{folder}/{row['name']}.docs", "<i8")
                offsets = files.mapped(f"{folder}/{row['name']}.offsets", "<i8")
                for first in range(0, len(docs), 10_000):
                    some = slice(first, min(first + 10_000, len(docs)))
                    starts, ends = offsets[:-1][some], offsets[1:][some]
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)]
                    named = np.arange(some.start, some.stop) >= row["n_unnamed"]
                    yield pa.record_batch(
                        [pa.array(docs[some], mask=~named), pa.array(starts + row["base"]), pa.array(ends - starts), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = max(1, manifest.count())
    # A part is one task: the manifest is small, the files behind its rows are not.
    return manifest.withColumn("at", F.row_number().over(Window.orderBy("part")) - 1).repartitionById(
        parts, F.col("at").cast("int")
    ).mapInArrow(tidy(run), SPAN_SCHEMA)


def token_files_round_trip(docs: DataFrame) -> DataFrame:
    """Write token files into the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, folder)
    return read_token_files(docs.sparkSession, folder)
