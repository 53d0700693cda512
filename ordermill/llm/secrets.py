"""Secrets by character Markov models of random and of ordinary strings, in DataFrame functions alone.

Three base patterns always count: values assigned to telling names, access keys and long hexadecimal runs.
Other strings that might be secrets, long runs of key characters outside of these, are scored by the
log-likelihood ratio of two first-order character models, of random strings and of ordinary identifiers,
and added where it reaches a threshold.

Both models are learned from labelled strings. ``labelled`` gives them, of all documents: random are digests in the
three alphabets that keys are written in, which are random by construction, and the documents' own base
secrets; ordinary are, outside of these, the words and identifiers that several documents hold, which a
random string hardly does, and all numbers. Training sees counts per pair of characters, at most
``2 * 68 ** 2`` rows whatever the input, and the models come back as one array of log ratios.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored
from ordermill.llm.spans import PLACE, apart, free_name, joined, located, place

KINDS = ("assign", "access", "hex", "random")
# The base patterns, fixed by contract, written so that no text makes them retry. Of access keys and
# hexadecimal runs, which are as long as their characters go, only those long enough match at once.
_NAME = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_ASSIGN = _NAME + r"[\"']?\x20*+[:=]\x20*+[\"']?"
BASE = {
    "assign": _ASSIGN + "[A-Za-z0-9+/_.=-]++",
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}+",
}
HINT = {"assign": r"[:=]", "access": "AKIA", "hex": "[0-9a-f]{24}"}
LEAST_VALUE, LEAST = 6, 16
# Characters of keys, by place; 0 stands for the beginning of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_KEY = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![\p{{L}}\p{{N}}+/_=.@-])[{_KEY}]{{{LEAST},}}+(?![\p{{L}}\p{{N}}@])"
WORD = rf"(?<![\p{{L}}\p{{N}}])[{_KEY}]{{4,}}+(?![\p{{L}}\p{{N}}])"
PRIOR, QUIET, BACKOFF = float(np.log(1e6)), 0.9995, 16


def base_spans(text: Column) -> Column:
    """The base secrets, as spans with their text, in the order of their kinds."""

    def found(k: int) -> Column:
        kind = KINDS[k]
        spans = located(text, BASE[kind], k, HINT[kind])
        if kind != "assign":
            return spans
        return F.filter(spans, lambda s: F.length(value_of(s["t"])) >= LEAST_VALUE)

    return F.concat(*map(found, range(3)))


def value_of(t: Column) -> Column:
    """What an assignment assigns."""
    return F.regexp_replace(t, "^" + _ASSIGN, "")


def labelled(docs: DataFrame) -> DataFrame:
    """Distinct strings of all documents with their label, ``value`` and ``random``."""
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    upper = F.concat(*(F.conv(F.substring(digest, k, 12), 16, 36) for k in (1, 13)))
    made = F.array(digest, F.base64(F.unhex(digest)), upper)
    held = F.transform(F.filter("base", lambda s: s["kind"] != 0), lambda s: s["t"])
    random = given.withColumn("base", base_spans(F.col("text"))).select(F.explode(F.concat(made, held)).alias("value"))
    # What the base patterns match is taken out of the text; a blank keeps its neighbours apart.
    rest = F.col("text")
    for kind in BASE:
        rest = F.regexp_replace(rest, BASE[kind], " ")
    words = given.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)))).alias("value"))
    # Two documents hold a word if its smallest and largest id differ; rows without an id are one document.
    ids = words.groupBy("value").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("unnamed")
    )
    number = F.col("value").rlike("^[0-9/_=+-]+$")
    ordinary = ids.where(F.expr("low < high OR (low IS NOT NULL AND unnamed > 0)") | number).select("value")
    both = random.withColumn("random", F.lit(True)).union(ordinary.withColumn("random", F.lit(False)))
    return both.where("value IS NOT NULL").distinct()


@dataclass
class Model:
    """Log ratios by place of the character before and of the character, and the least sum that counts."""

    ratios: list[float]
    threshold: float

    def score(self, value: Column) -> Column:
        """Log-likelihood ratio of a string, random against ordinary."""
        # One literal, which the optimizer turns into one constant array.
        table, width = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>"), len(ALPHABET) + 1

        def add(acc: Column, c: Column) -> Column:
            at = _at(c)
            return F.struct(at.alias("at"), (acc["sum"] + F.get(table, acc["at"] * width + at)).alias("sum"))

        return F.aggregate(F.split(value, ""), F.expr("named_struct('at', 0, 'sum', CAST(0 AS DOUBLE))"), add)["sum"]


def _at(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c)


def _pairs(samples: DataFrame) -> DataFrame:
    """How often each pair of neighbours stands in strings of each label and part (held out or not)."""
    chars = F.transform(F.split("value", ""), _at)
    before = F.concat(F.array(F.lit(0)), F.slice("c", F.lit(1), F.size("c") - 1))
    pairs = F.arrays_zip(before.alias("a"), F.col("c").alias("b"))
    rows = samples.withColumn("c", chars).select("random", F.explode(pairs).alias("p"))
    return rows.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).count()


def ratios_of(counts: dict[bool, np.ndarray]) -> list[float]:
    """Log ratios of transition probabilities. A pair counts as ``BACKOFF`` more than seen, shared out by how
    often its second character stands at all, which in turn is once more than seen."""
    logs = {}
    for label, table in counts.items():
        single = table.sum(axis=0) + 1.0
        single[0] = 0  # nothing leads back to the beginning
        single /= single.sum()
        smooth = (table + BACKOFF * single) / (table.sum(axis=1, keepdims=True) + BACKOFF)
        logs[label] = np.log(np.maximum(smooth, 1e-300))
    return (logs[True] - logs[False]).ravel().tolist()


def train(samples: DataFrame) -> Model | None:
    """Both models from ``value`` and ``random``; a quarter of the strings, by hash, sets the threshold.

    The threshold is the ratio that outweighs odds of a million to one against a secret or, if larger, the one
    that only a share of ``1 - QUIET`` of held-out ordinary strings of candidate length exceeds. Without
    strings of both labels there is no model.
    """
    stored = Stored(samples.sparkSession)
    samples = stored.put(samples, "labelled")  # two jobs read them
    part = F.pmod(F.xxhash64("value"), F.lit(4))
    width = len(ALPHABET) + 1
    counts = {label: np.zeros((width, width)) for label in (True, False)}
    for r in _pairs(samples.where(part != 0)).collect():
        # ``count`` is a method of rows, so the last column is taken by its place.
        counts[r.random][r.a, r.b] += r[-1]
    if not all(c.any() for c in counts.values()):
        stored.drop()
        return None
    model = Model(ratios_of(counts), PRIOR)
    long = samples.where((part == 0) & ~F.col("random") & (F.length("value") >= LEAST))
    loud = long.agg(F.percentile_approx(model.score(F.col("value")), QUIET, 100_000)).head()[0]
    model.threshold = max(PRIOR, loud or PRIOR)
    stored.drop()
    return model


def find(docs: DataFrame, model: Model | None, base: str = "base", spans: str = "spans") -> DataFrame:
    """Adds two arrays of (start, kind, end) by start and kind: ``base``, the base secrets of whole texts, and
    ``spans``, these and the candidates outside of them that the models call random. Without a
    model nothing is added. Rows stay as they are, repeated ones too; other columns stay, whatever their
    names, but for any of these two. A null or empty text has no spans; an empty table gives an empty one.
    """
    own = [c for c in docs.columns if c not in (base, spans)]
    text, found, more = (free_name(docs.columns, f"__secret_{n}") for n in ("text", "base", "more"))
    body = F.col(text)
    rows = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn(found, base_spans(body))
    added = F.expr(f"CAST(array() AS array<{PLACE}>)")
    if model:
        loose = apart(located(body, CANDIDATE, 3, rf"[{_KEY}]{{{LEAST}}}"), found)
        added = F.transform(F.filter(loose, lambda s: model.score(s["t"]) >= model.threshold), place)
    rows = rows.withColumn(more, added).withColumn(found, F.array_sort(F.transform(found, place)))
    every = F.array_sort(F.concat(found, more))
    return rows.select(*(F.col(f"`{c}`") for c in own), F.col(found).alias(base), every.alias(spans))


def count_of(kind: str) -> Column:
    """How many base spans of a kind a row has."""
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def written(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return joined(spans, KINDS)
