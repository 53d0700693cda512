"""Places of pattern matches in texts, in DataFrame functions alone.

Positions are code points. They follow from the lengths of the matches of a pattern and of the gaps
between them, summed up in blocks, so a text with many matches costs little more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "struct<start:int,end:int,kind:int,t:string>"
PLACE = "struct<start:int,kind:int,end:int>"


def located(text: Column, pattern: str, kind: int, hint: str) -> Column:
    """The matches of a pattern with their places, as an array of ``SPAN``; the pattern is tried only
    on texts that hold ``hint``, which each of its matches does."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h"), h.alias("t")))

    def begin() -> Column:
        return F.expr(f"named_struct('at', 0, 'out', CAST(array() AS array<{SPAN}>))")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        span = F.struct(start.alias("start"), (start + x["h"]).alias("end"), F.lit(kind).alias("kind"), x["t"].alias("t"))
        return F.struct((start + x["h"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def shift(acc: Column, block: Column) -> Column:
        moved = F.transform(
            block["out"],
            lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["kind"].alias("kind"), s["t"].alias("t")),
        )
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(parts, b * BLOCK + 1, F.lit(BLOCK)), begin(), add))
    found = F.aggregate(blocks, begin(), shift)["out"]
    return F.when(text.rlike(hint) & (F.size(hits) > 0), found).otherwise(F.expr(f"CAST(array() AS array<{SPAN}>)"))


def place(span: Column) -> Column:
    """A span without its text; the order of the fields is the order of spans: by start, then kind as listed."""
    return F.struct(span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"))


def apart(spans: Column, others: Column | str) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def joined(spans: Column | str, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def free_name(columns: list[str], name: str) -> str:
    """A column name that none of ``columns`` has, with case aside."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
