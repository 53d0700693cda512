"""Personal data by candidate gradient boosting, in DataFrame functions alone.

Generators with high recall propose overlapping spans: the four base patterns, and looser forms of
them (written-out at and dot, bracketed dots, other separators, numbers without a plus). Boosted trees of
depth two score a candidate by its format and context; a threshold per kind, calibrated on held-out
candidates, selects what is added to the base spans, which always stay.

Nobody has labelled personal data here, so the trees learn from the base rules: a base span is positive, and
what the rules refuse, a base match that fails its check or a loose candidate, is negative. What the rules go by
is no feature: not the check digit, the octets' sizes or the plus, nor the signs that set loose forms
apart, which are undone first. What is left is how many digits there are and how they are grouped, the
words before and the numbers around. So a loose candidate is added where its format and context are those
of base spans, far more often than of refused ones, whether or not it passes the check.

Features are a few small numbers, so training sees a table of counts per combination, at most
``2 * 4 * 6 * 4 * 2 ** 4`` rows whatever the input, and the trees come back as one SQL expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.spans import apart, free_name, located, place
from ordermill.llm.spans import joined as written_spans

KINDS = ("email", "ip", "card", "phone")
# The base patterns, fixed by contract, written so that no text makes them retry: a match begins where
# a run of its characters does, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Written-out "at" goes only with written-out "dot": both alone are everyday prose.
_AT, _DOT = r"\x20?(?:@|\(at\)|\[at\])\x20?", r"(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)"
_LABEL = "[A-Za-z0-9-]++"
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++"
    rf"(?:{_AT}{_LABEL}(?:{_DOT}{_LABEL})+|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL})+)",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){2,3}(?:[\x20._/-]{1,2}[0-9]{1,3})?(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3}[\x20.-][0-9]{3,4}(?![0-9])",
}
# A pattern is tried only on texts that hold what each of its matches holds.
HINT = {
    "email": {"base": "@", "loose": r"@|[(\[]at[)\]]|\x20dot\x20"},
    "ip": {"base": r"[0-9]\.[0-9]", "loose": r"[0-9]\x20?[(\[]"},
    "card": {"base": r"[0-9][\x20-]?[0-9]", "loose": r"[0-9]{4}[\x20._/-]"},
    "phone": {"base": r"\+[0-9]", "loose": r"[0-9][)\x20.-]"},
}
CUES = {
    "email": "e-?mail|contact|write|mailto",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|credit|payment|account",
    "phone": r"phone|tel\b|call|fax|mobile|whatsapp",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
FEATURES = {"kind": 4, "size": 6, "tail": 4, "cue": 2, "edge": 2, "before": 2, "after": 2}
CONTEXT = 24
ROUNDS, RATE, PRECISION, LEAST_EVIDENCE = 20, 0.4, 0.9, 20


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        twice = F.substring(digits, size - i + 1, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.floor(twice / 10).cast("int") + twice % 10

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _valid(kind: int, t: Column) -> Column:
    """Whether a base match of the kind passes its check."""
    digits = _digits(t)
    size = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": t.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"),
        "card": size.between(12, 19) & luhn(digits),
        "phone": size.between(9, 15),
    }[KINDS[kind]]


def base_spans(text: Column) -> list[Column]:
    """Per kind, the valid base matches."""

    def valid(kind: int) -> Callable[[Column], Column]:
        return lambda s: _valid(kind, s["t"])

    return [F.filter(located(text, BASE[k], i, HINT[k]["base"]), valid(i)) for i, k in enumerate(KINDS)]


def _undone(kind: int, t: Column) -> Column:
    """A loose candidate in the form that the base pattern expects."""
    if KINDS[kind] == "email":
        return F.regexp_replace(F.regexp_replace(t, rf"{_AT}|\x20at\x20", "@"), _DOT, ".")
    if KINDS[kind] == "ip":
        return F.regexp_replace(t, r"\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?", ".")
    return _digits(t) if KINDS[kind] == "card" else F.concat(F.lit("+"), _digits(t))


def _features(text: Column, s: Column, loose: bool) -> list[Column]:
    """The small numbers of a candidate, in the order of ``FEATURES``."""

    def by_kind(make) -> Column:
        column = make(len(KINDS) - 1)
        for k in range(len(KINDS) - 2, -1, -1):
            column = F.when(s["kind"] == k, make(k)).otherwise(column)
        return column

    t = by_kind(lambda k: _undone(k, s["t"])) if loose else s["t"]
    # Emails: the length of the last label. Numbers: their digits, and those after the last separator.
    n = F.when(s["kind"] == 0, F.length(F.substring_index(t, ".", -1))).otherwise(F.length(_digits(t)))
    letters = F.when(n < 2, 0).when(n == 2, 1).when(n == 3, 2).when(n < 7, 3).otherwise(4)
    digits = F.when(n < 7, 0).when(n < 9, 1).when(n < 13, 2).when(n < 16, 3).when(n == 16, 4).otherwise(5)
    size = F.when(s["kind"] == 0, letters).otherwise(digits)
    last = F.length(F.regexp_extract(s["t"], "[0-9]*$", 0))
    tail = F.when((s["kind"] < 2) | (last < 3), 0).when(last == 3, 1).when(last == 4, 2).otherwise(3)
    first = F.greatest(s["start"] - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, first + 1, s["start"] - first))
    after = F.substring(text, s["end"] + 1, F.lit(4))
    cue = by_kind(lambda k: before.rlike(CUES[KINDS[k]]))
    flags = [cue, after.rlike("^[A-Za-z0-9_@]"), before.rlike(r"[0-9][\x20|,;.\t]*$"), after.rlike(r"^[\x20|,;.\t]+[0-9]")]
    return [s["kind"], size, tail, *(flag.cast("int") for flag in flags)]


def with_spans(text: Column, docs: DataFrame, base: str, loose: str) -> DataFrame:
    """Adds ``base``, valid base matches by start and kind, and ``loose``, other candidates outside of them."""
    found = docs.withColumn(base, F.array_sort(F.transform(F.concat(*base_spans(text)), _ordered)))
    every = F.concat(*(located(text, LOOSE[k], i, HINT[k]["loose"]) for i, k in enumerate(KINDS)))
    return found.withColumn(loose, apart(every, base))


def _ordered(s: Column) -> Column:
    """A span whose fields give the order: by start, then by kind as listed."""
    return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["t"].alias("t"))


def _described(text: Column, spans: Column, loose: bool) -> Column:
    def describe(s: Column) -> Column:
        values = _features(text, s, loose)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), *(v.alias(n) for n, v in zip(FEATURES, values)))

    return F.transform(spans, describe)


@dataclass
class Model:
    """Boosted trees as an expression over a candidate's features, and a threshold per kind."""

    trees: list[tuple]
    start: float
    thresholds: list[float]

    def margin(self, c: Column) -> Column:
        total = F.lit(self.start)
        for feature, limit, low, high in self.trees:
            total = total + F.when(c[feature] <= limit, self._leaf(c, low)).otherwise(self._leaf(c, high))
        return total

    def _leaf(self, c: Column, leaf: tuple) -> Column:
        feature, limit, low, high = leaf
        return F.when(c[feature] <= limit, float(low)).otherwise(float(high))

    def selects(self, c: Column) -> Column:
        limit = F.lit(self.thresholds[-1])
        for k, value in enumerate(self.thresholds[:-1]):
            limit = F.when(c["kind"] == k, value).otherwise(limit)
        return 1 / (1 + F.exp(-self.margin(c))) >= limit


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int, float, float]:
    """Feature, limit and the leaves' steps of the split with the largest gain."""
    best = (-1.0, 0, 0, 0.0, 0.0)
    step = lambda a, b: a / (b + 1.0)
    for f in range(x.shape[1]):
        for limit in np.unique(x[:, f]):
            low = x[:, f] <= limit
            ga, ha, gb, hb = g[low].sum(), h[low].sum(), g[~low].sum(), h[~low].sum()
            gain = ga * step(ga, ha) + gb * step(gb, hb)
            if gain > best[0] + 1e-12:
                best = (gain, f, int(limit), step(ga, ha), step(gb, hb))
    return best[1:]


def boost(x: np.ndarray, positive: np.ndarray, count: np.ndarray) -> Model:
    """Trees of depth two for the logistic loss over rows that stand for ``count`` candidates each."""
    names = list(FEATURES)
    start = float(np.log((positive.sum() + 1) / (count.sum() - positive.sum() + 1)))
    margin, trees = np.full(len(x), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        g, h = positive - count * p, count * p * (1 - p)
        feature, limit, _, _ = _best_split(x, g, h)
        low = x[:, feature] <= limit
        leaves = []
        for side in (low, ~low):
            f, cut, a, b = _best_split(x[side], g[side], h[side]) if side.any() else (0, 0, 0.0, 0.0)
            a, b = float(np.clip(RATE * a, -4, 4)), float(np.clip(RATE * b, -4, 4))
            margin[side] += np.where(x[side][:, f] <= cut, a, b)
            leaves.append((names[f], cut, a, b))
        trees.append((names[feature], limit, *leaves))
    return Model(trees, start, [0.5] * len(KINDS))


def _margins(model: Model, x: np.ndarray) -> np.ndarray:
    at = {n: x[:, i] for i, n in enumerate(FEATURES)}
    total = np.full(len(x), model.start)
    for feature, limit, low, high in model.trees:
        low, high = (np.where(at[f] <= cut, a, b) for f, cut, a, b in (low, high))
        total += np.where(at[feature] <= limit, low, high)
    return total


def candidates(docs: DataFrame) -> DataFrame:
    """All candidates of documents with their features and ``positive``, whether they are base spans."""
    text = F.col("__text")
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))

    def refused(kind: int) -> Column:
        spans = located(text, BASE[KINDS[kind]], kind, HINT[KINDS[kind]]["base"])
        return F.filter(spans, lambda s: ~_valid(kind, s["t"]))

    found = with_spans(text, given, "__base", "__loose")
    found = found.withColumn("__refused", apart(F.concat(*map(refused, range(len(KINDS)))), "__loose"))

    def labelled(name: str, loose: bool, positive: bool) -> Column:
        return F.transform(_described(text, F.col(name), loose), lambda c: F.struct(c.alias("c"), F.lit(positive).alias("positive")))

    described = [labelled("__base", False, True), labelled("__refused", False, False), labelled("__loose", True, False)]
    rows = found.select("doc_id", F.inline(F.concat(*described)))
    return rows.select("doc_id", "positive", *(F.col(f"c.{n}").alias(n) for n in FEATURES))


def train(docs: DataFrame) -> Model:
    """Fit on the candidates of all documents but a quarter, chosen by their id's hash; the thresholds on
    that quarter.

    A kind's threshold is the least score from which on ``PRECISION`` of its candidates are base spans, at
    least ``LEAST_EVIDENCE`` of them; a kind without is never added to.
    """
    rows = candidates(docs)
    names, held = list(FEATURES), (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0).alias("held")
    table = rows.groupBy(held, *names).agg(F.count("*").alias("total"), F.count_if("positive").alias("good")).collect()

    def arrays(some: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.array([[r[n] for n in names] for r in some]).reshape(-1, len(names))
        return x, np.array([r.good for r in some], float), np.array([r.total for r in some], float)

    fitted, trial = [r for r in table if not r.held], [r for r in table if r.held]
    if not fitted:
        return Model([], -30.0, [1.0] * len(KINDS))
    model = boost(*arrays(fitted))
    model.thresholds = [calibrated(model, *arrays([r for r in trial if r.kind == k])) for k in range(len(KINDS))]
    return model


def calibrated(model: Model, x: np.ndarray, positive: np.ndarray, count: np.ndarray) -> float:
    """The least score from which on the share of positive candidates is ``PRECISION``, or 1."""
    if not len(x):
        return 1.0
    p = 1 / (1 + np.exp(-_margins(model, x)))
    scores, at = np.unique(-p, return_inverse=True)  # candidates of equal scores stand or fall together
    good, total = (np.cumsum(np.bincount(at, weights)) for weights in (positive, count))
    enough = np.flatnonzero((good >= PRECISION * total) & (good >= LEAST_EVIDENCE))
    # A hair below, as the engine adds up the trees in its own way.
    return float(max(0.5, -scores[enough[-1]] - 1e-9)) if len(enough) else 1.0


def find(docs: DataFrame, model: Model, base: str = "base", spans: str = "spans") -> DataFrame:
    """Adds two arrays of (start, kind, end) by start and kind: ``base``, the valid base matches of whole
    texts, and ``spans``, these and the selected candidates, of which those that begin later go
    where two overlap. Other columns stay, whatever their names, but for any of these two. A null or
    empty text has no spans, a long one is searched whole; rows that repeat stay as they are, and an empty
    table gives an empty one.
    """
    own = [c for c in docs.columns if c not in (base, spans)]
    text, found, loose, added = (free_name(docs.columns, f"__pii_{n}") for n in ("text", "base", "loose", "added"))
    body = F.col(text)
    rows = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = with_spans(body, rows, found, loose).withColumn(loose, _described(body, F.col(loose), True))
    chosen = F.array_sort(F.filter(loose, lambda c: model.selects(c)))

    def keep(acc: Column, c: Column) -> Column:
        free = c["start"] >= acc["at"]
        return F.when(free, F.struct(c["end"].alias("at"), F.concat(acc["out"], F.array(place(c))).alias("out"))).otherwise(acc)

    empty = F.expr("named_struct('at', 0, 'out', CAST(array() AS array<struct<start:int,kind:int,end:int>>))")
    rows = rows.withColumn(added, F.aggregate(chosen, empty, keep)["out"]).withColumn(found, F.transform(found, place))
    every = F.array_sort(F.concat(found, added))
    return rows.select(*(F.col(f"`{c}`") for c in own), F.col(found).alias(base), every.alias(spans))


def count_of(kind: int) -> Column:
    """How many base spans of a kind a row has."""
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return written_spans(spans, KINDS)


def redacted(text: Column, spans: str) -> Column:
    """The text with every span, overlapping ones together, replaced by its first kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        apart = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.element_at(names, s["kind"] + 1))).alias("out"))
        over = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when((s["start"] >= acc["at"]) | (F.size(acc["out"]) == 0), apart).otherwise(over)

    empty = F.expr("named_struct('at', 0, 'out', CAST(array() AS array<string>))")
    pieces = F.aggregate(
        spans, empty, add, lambda acc: F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text))))
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)
