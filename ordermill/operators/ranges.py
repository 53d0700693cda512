"""Ordered windows over groups that do not fit one task.

A window without a partition key, or with one very large group, would sort all its rows in one
task. Here the rows are cut into ranges along their sort key, each range is a window partition
of its own, and what crosses a cut is carried over from a few numbers per range:

1. a sample of the sort keys gives the cuts, each of them the key of an existing row;
2. a row's range is the number of cuts before its key, a pure function of the row, so a task
   that is run again puts it into the same range;
3. one small aggregate per range gives the offsets of the following ranges.

The sample decides only how even the ranges are. Every row takes part in every result. There is
a range for every ``ROWS_PER_RANGE`` rows, however many that makes; the driver gets the cuts and a few
numbers per range, which is a hundred thousand rows for a hundred billion. They are constant arrays
in the plan, looked up by the number of the range.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal
from math import ceil

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "_range"
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 50


@dataclass
class Ranges:
    """``rows`` with their range number, and the cuts: range i ends with the row ``cuts[i]``."""

    rows: DataFrame
    cuts: list[Row]
    bounds: Column  # the cuts as an array of structs

    @property
    def before(self) -> Column:
        """The cut that ends the range before a row's range; NULL in range 0."""
        return F.get(self.bounds, F.col(RANGE) - 1)

    @property
    def after(self) -> Column:
        """The cut that ends a row's range; NULL in the last one."""
        return F.get(self.bounds, F.col(RANGE))

    @property
    def has_before(self) -> Column:
        return F.col(RANGE) > 0

    @property
    def has_after(self) -> Column:
        return F.col(RANGE) < len(self.cuts)


def split(
    df: DataFrame,
    order: dict[str, Column],
    group: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    min_ranges: int | None = None,
) -> Ranges:
    """Cut ``df`` into ranges along ``order``: named sort keys, all ascending, NULLs first.

    The keys should identify a row: rows that agree on all of them stay in one range. With a
    ``group`` column, which then is the first key ``grp``, only groups that fill more than a
    range are cut. The other groups are small enough as they are, and their rows skip the search.
    """
    if min_ranges is None:
        # Ranges are hashed to tasks; several for each core even out the load.
        min_ranges = 4 * df.sparkSession.sparkContext.defaultParallelism
    if group is not None:
        order = {"grp": F.col(group)} | order
    key = F.struct(*[column.alias(name) for name, column in order.items()])
    keys = df.select(key.alias("key"))
    count = df.count()
    number = min(count, max(min_ranges, ceil(count / rows_per_range)))
    cuts = _sample_cuts(keys, count, number) if number > 1 else []
    if group is not None:
        owned = Counter(cut.grp for cut in cuts)
        cuts = [cut for cut in cuts if owned[cut.grp] > 1]
    bounds = _constant([cut.asDict() for cut in cuts], keys.schema["key"].dataType)
    position = F.lit(0)
    if cuts:
        position = _cuts_before(key, bounds, len(cuts))
        if group is not None:
            position = F.when(_is_one_of(F.col(group), {cut.grp for cut in cuts}), position)
        position = F.coalesce(position, F.lit(0))
    return Ranges(df.withColumn(RANGE, position), cuts, bounds)


def _sample_cuts(keys: DataFrame, count: int, number: int) -> list[Row]:
    """Up to ``number - 1`` distinct keys that split the rows about evenly, in order.

    The sample is sorted in parts, of which no task holds more than a share, and every so many-th key
    is a cut; only those leave Spark.
    """
    # Twice the aim, because the sample size varies around its mean.
    share = min(1.0, 2 * SAMPLES_PER_RANGE * number / count)
    size = max(1, round(share * count / number))
    parts = max(1, ceil(number / 1_000))
    sample = keys.sample(share, 7).repartitionByRange(parts, "key")
    # Places run on through a part; a part's rest is carried by no cut and is less than one range.
    place = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    numbered = sample.withColumn("part", F.spark_partition_id()).withColumn("place", place)
    found = numbered.filter(F.col("place") % size == 0).select("key").distinct().collect()
    cuts = sorted((row.key for row in found), key=_sortable)
    return cuts[: number - 1]


def _sortable(key: Row) -> tuple:
    """A key's values with NULLs first, as Spark sorts them."""
    return tuple((value is not None, value) for value in key)


def _cuts_before(key: Column, bounds: Column, number: int) -> Column:
    """How many of the ``number`` cuts sort before ``key``, by binary search."""
    steps = [1 << i for i in reversed(range(number.bit_length()))]

    def advance(position: Column, step: Column) -> Column:
        target = position + step
        ahead = (target <= number) & (F.get(bounds, target - 1) < key)
        return F.when(ahead, target).otherwise(position)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def _constant(values: list, dtype: T.DataType) -> Column:
    """A constant array; through JSON, because a literal per value takes long to set up."""
    options = {"mode": "FAILFAST", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.from_json(F.lit(json.dumps(values, default=_text)), T.ArrayType(dtype), options)


def _text(value: Decimal | dt.datetime) -> str:
    """What JSON has no type for, exactly and free of any time zone."""
    if isinstance(value, dt.datetime):
        return value.isoformat(timespec="microseconds")
    return str(value)


def _is_one_of(column: Column, values: set) -> Column:
    known = column.isin(sorted(v for v in values if v is not None))
    return known | column.isNull() if None in values else known


def _descending(value: str) -> dict[str, Column]:
    """Sort keys for ``value DESC NULLS LAST``."""
    return {"unknown": F.col(value).isNull(), "value": -F.col(value)}


def global_row_number(df: DataFrame, value: str, tiebreak: str, **sizes) -> tuple[DataFrame, int]:
    """Add ``row_number`` by ``value`` descending over all rows; also return their number."""
    ranges = split(df, _descending(value) | {"tiebreak": F.col(tiebreak)}, **sizes)
    counts = {row[RANGE]: row["count"] for row in ranges.rows.groupBy(RANGE).count().collect()}
    offsets, seen = [], 0
    for number in range(len(ranges.cuts) + 1):
        offsets.append(seen)
        seen += counts.get(number, 0)
    offset = F.get(_constant(offsets, T.LongType()), F.col(RANGE))
    within = Window.partitionBy(RANGE).orderBy(F.desc_nulls_last(value), F.asc(tiebreak))
    numbered = ranges.rows.withColumn("row_number", F.row_number().over(within) + offset)
    return numbered.drop(RANGE), seen


def global_ntile(
    df: DataFrame, value: str, tiebreak: str, tiles: int, name: str = "ntile", **sizes
) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY value DESC, tiebreak)`` without a one-task window."""
    numbered, total = global_row_number(df, value, tiebreak, **sizes)
    size, larger = divmod(total, tiles)  # the first `larger` tiles hold size + 1 rows
    index = F.col("row_number") - 1
    edge = larger * (size + 1)
    tile = F.floor(index / (size + 1)) + 1
    if size:
        tile = F.when(index < edge, tile).otherwise(larger + F.floor((index - edge) / size) + 1)
    return numbered.withColumn(name, tile.cast("bigint")).drop("row_number")


def global_running_sum(
    df: DataFrame, value: str, tiebreak: str, name: str = "running_sum", **sizes
) -> tuple[DataFrame, Decimal | None]:
    """``SUM(value) OVER (ORDER BY value DESC)``; also return the grand total.

    Equal values share the sum that includes all of them. A value whose rows go on across a cut
    is the value of that cut, and its sum comes from the range totals.
    """
    ranges = split(df, _descending(value) | {"tiebreak": F.col(tiebreak)}, **sizes)
    dtype = df.schema[value].dataType
    at_before = -F.col(value) == ranges.before["value"]
    at_after = -F.col(value) == ranges.after["value"]
    edge = F.when(at_before | at_after, F.col(value)).alias("edge")
    totals = ranges.rows.groupBy(RANGE, edge).agg(F.sum(value).alias("total")).collect()

    with decimal.localcontext(prec=38):
        of_range: dict[int, Decimal | None] = {}
        of_edge: dict[Decimal, list[Row]] = {}
        for row in totals:
            of_range[row[RANGE]] = _add(of_range.get(row[RANGE]), row.total)
            if row.edge is not None:
                of_edge.setdefault(row.edge, []).append(row)
        before, seen = [], None  # the sum of all earlier ranges
        for number in range(len(ranges.cuts) + 1):
            before.append(seen)
            seen = _add(seen, of_range.get(number))
        # Up to a cut, all values are the cut's or larger; its ties beyond it are added. A value
        # is looked at once, at its first cut.
        at_cut: list[Decimal | None] = []
        for number, cut in enumerate(ranges.cuts):
            if number and cut.value == ranges.cuts[number - 1].value:
                at_cut.append(at_cut[-1])
                continue
            shared = before[number + 1]
            for row in of_edge.get(-cut.value, []) if cut.value is not None else []:
                if row[RANGE] > number:
                    shared = _add(shared, row.total)
            at_cut.append(shared)

    offset = F.get(_constant(before, dtype), F.col(RANGE))
    sums = _constant(at_cut, dtype)
    inside = F.sum(value).over(Window.partitionBy(RANGE).orderBy(F.desc_nulls_last(value)))
    running = (
        F.when(at_before, F.get(sums, F.col(RANGE) - 1))
        .when(at_after, F.get(sums, F.col(RANGE)))
        .when(F.col("_inside").isNull(), offset)
        .otherwise(F.coalesce(offset, F.lit(0)) + F.col("_inside"))
    )
    result = ranges.rows.withColumn("_inside", inside).withColumn(name, running)
    return result.drop(RANGE, "_inside"), seen


def _add(a: Decimal | None, b: Decimal | None) -> Decimal | None:
    return b if a is None else a if b is None else a + b


def dense_rank_in_groups(
    df: DataFrame, group: str, value: str, tiebreak: str, name: str = "rank", **sizes
) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY value DESC)`` for groups of any size.

    Only the group of the cut before a range can have begun in an earlier one. Its rows add the
    number of distinct values seen there, less one if the cut's own value goes on in this range.
    """
    ranges = split(df, _descending(value) | {"tiebreak": F.col(tiebreak)}, group, **sizes)
    rows, cuts = ranges.rows, ranges.cuts
    rank = F.dense_rank().over(
        Window.partitionBy(RANGE, group).orderBy(F.desc_nulls_last(value))
    )
    if not cuts:  # no group was split
        return rows.withColumn(name, rank).drop(RANGE)

    carried = ranges.has_before & F.col(group).eqNullSafe(ranges.before["grp"])
    goes_on = carried & (-F.col(value)).eqNullSafe(ranges.before["value"])
    leaving = ranges.has_after & F.col(group).eqNullSafe(ranges.after["grp"])
    facts = {
        row[RANGE]: row
        for row in rows.groupBy(RANGE)
        .agg(
            F.max(goes_on).alias("goes_on"),
            F.count_distinct(F.when(leaving, F.struct(value))).alias("leaving"),
        )
        .collect()
    }
    offsets, seen = [], 0
    for number in range(len(cuts) + 1):
        fact = facts.get(number)
        offsets.append(seen - int(fact.goes_on) if fact else seen)
        if number < len(cuts):
            whole = number > 0 and cuts[number - 1].grp == cuts[number].grp
            seen = fact.leaving + (offsets[number] if whole else 0)
    offset = F.get(_constant(offsets, T.LongType()), F.col(RANGE))
    ranked = rows.withColumn(name, rank + F.when(carried, offset).otherwise(0))
    return ranked.drop(RANGE)


def lag_in_groups(
    df: DataFrame, group: str, at: str, tiebreak: str, name: str = "previous", **sizes
) -> Ranges:
    """``LAG(at) OVER (PARTITION BY group ORDER BY at)`` for groups of any size.

    ``at`` is a zone-free timestamp. The row before the first row of a range is the cut itself.
    """
    ranges = split(df, {"at": F.col(at), "tiebreak": F.col(tiebreak)}, group, **sizes)
    within = Window.partitionBy(RANGE, group).orderBy(at, tiebreak)
    previous = F.lag(at).over(within)
    if ranges.cuts:
        carried = F.when(ranges.before["grp"] == F.col(group), ranges.before["at"])
        previous = F.when(F.row_number().over(within) == 1, carried).otherwise(previous)
    ranges.rows = ranges.rows.withColumn(name, previous)
    return ranges


def totals_in_groups(ranges: Ranges, group: str, totals: dict[str, Column]) -> DataFrame:
    """Add each group's sums of the ``totals`` columns to its rows, and drop the range number.

    A group that was not split is summed where it is. The few that were are summed by an
    aggregate with one row for each, and ``group`` must not be NULL in them.
    """
    rows = ranges.rows
    within = Window.partitionBy(RANGE, group)
    inside = {name: F.sum(column).over(within) for name, column in totals.items()}
    if not ranges.cuts:  # no group was split
        return rows.withColumns(inside).drop(RANGE)
    at_cuts = (
        rows.filter(_is_one_of(F.col(group), {cut.grp for cut in ranges.cuts}))
        .groupBy(group)
        .agg(*[F.sum(c).alias(f"_{name}") for name, c in totals.items()], F.lit(True).alias("_cut"))
    )
    merged = {
        name: F.when(F.col("_cut"), F.col(f"_{name}")).otherwise(F.col(name)) for name in totals
    }
    return (
        rows.withColumns(inside)
        .join(F.broadcast(at_cuts), group, "left")
        .withColumns(merged)
        .drop(RANGE, "_cut", *[f"_{name}" for name in totals])
    )
