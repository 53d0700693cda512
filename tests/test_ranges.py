"""Split windows against the plain windows they stand for, with cuts in awkward places."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import ranges

SMALL = {"rows_per_range": 10, "min_ranges": 1}


def amounts(kind: str) -> list[Decimal | None]:
    rng = random.Random(3)
    cents = {
        "distinct": [rng.randrange(10**9) for _ in range(400)],
        "few values": [rng.randrange(12) * 50 for _ in range(500)],
        "one value owns a third": [77] * 150 + [rng.randrange(-500, 500) for _ in range(300)],
        "nulls": [None if rng.random() < 0.3 else rng.randrange(40) for _ in range(300)],
        "all equal": [5] * 120,
        "all null": [None] * 60,
        "fewer rows than tiles": [3, 1],
        "one row": [9],
        "empty": [],
    }[kind]
    return [None if c is None else Decimal(c).scaleb(-2) for c in cents]


KINDS = [
    "distinct",
    "few values",
    "one value owns a third",
    "nulls",
    "all equal",
    "all null",
    "fewer rows than tiles",
    "one row",
    "empty",
]


@pytest.fixture(params=KINDS)
def frame(request, spark):
    values = list(enumerate(amounts(request.param)))
    random.Random(1).shuffle(values)
    return spark.createDataFrame(values, "id bigint, v decimal(38,6)").repartition(5)


def same(ours, plain):
    columns = plain.columns
    left, right = ours.select(columns).collect(), plain.collect()
    key = repr
    assert sorted(map(tuple, left), key=key) == sorted(map(tuple, right), key=key)


@pytest.mark.parametrize("tiles", [4, 7])
def test_ntile(frame, tiles):
    order = Window.orderBy(F.desc_nulls_last("v"), "id")
    plain = frame.withColumn("tile", F.ntile(tiles).over(order).cast("bigint"))
    same(ranges.global_ntile(frame, "v", "id", tiles, "tile", **SMALL), plain)


def test_running_sum(frame):
    plain = frame.withColumn("s", F.sum("v").over(Window.orderBy(F.desc_nulls_last("v"))))
    ours, total = ranges.global_running_sum(frame, "v", "id", "s", **SMALL)
    same(ours, plain)
    assert total == frame.agg(F.sum("v")).first()[0]


@pytest.mark.parametrize("groups", [1, 3, 60])
def test_dense_rank(frame, groups):
    grouped = frame.withColumn("g", F.concat(F.lit("g"), F.pmod(F.xxhash64("id"), F.lit(groups))))
    order = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    plain = grouped.withColumn("r", F.dense_rank().over(order))
    same(ranges.dense_rank_in_groups(grouped, "g", "v", "id", "r", **SMALL), plain)


@pytest.mark.parametrize("groups", [1, 3, 60])
@pytest.mark.parametrize("days", [2, 300])
def test_lag_and_totals(spark, groups, days):
    rng = random.Random(groups + days)
    start = dt.datetime(2020, 1, 1)
    rows = [
        (
            i,
            # The first group owns a third of all rows.
            0 if rng.random() < 0.33 else rng.randrange(groups),
            None
            if rng.random() < 0.05
            else start + dt.timedelta(days=rng.randrange(days), seconds=rng.randrange(3) * 7),
        )
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "id bigint, g bigint, at timestamp_ntz").repartition(5)
    order = Window.partitionBy("g").orderBy("at", "id")
    seconds = F.timestamp_diff("SECOND", F.col("prev"), F.col("at"))
    plain = frame.withColumn("prev", F.lag("at").over(order)).withColumn("gap", seconds)
    plain = plain.withColumn("total", F.sum("gap").over(Window.partitionBy("g")))
    split = ranges.lag_in_groups(frame, "g", "at", "id", "prev", **SMALL)
    assert len(split.cuts) > 10
    split.rows = split.rows.withColumn("gap", seconds)
    same(ranges.totals_in_groups(split, "g", {"total": F.col("gap")}), plain)


def test_text_group_keys(spark):
    rows = [(i, f"k{i % 3}", dt.datetime(2020, 1, 1 + i % 28)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id bigint, g string, at timestamp_ntz")
    plain = frame.withColumn("prev", F.lag("at").over(Window.partitionBy("g").orderBy("at", "id")))
    same(ranges.lag_in_groups(frame, "g", "at", "id", "prev", **SMALL).rows, plain)


def test_a_tie_group_is_split(spark):
    """Rows of one value spread over many ranges instead of sharing one."""
    frame = spark.range(5000).select("id", F.lit(Decimal("1.00")).cast("decimal(38,6)").alias("v"))
    split = ranges.split(frame, {"v": F.col("v"), "id": F.col("id")}, rows_per_range=100)
    sizes = [r["count"] for r in split.rows.groupBy(ranges.RANGE).count().collect()]
    assert len(sizes) > 25 and max(sizes) < 1000 and sum(sizes) == 5000


def test_rows_per_range_are_bounded_for_any_number(spark):
    frame = spark.range(60_000).select("id", (F.col("id") % 3_000).cast("decimal(38,6)").alias("v"))
    frame = frame.withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).cache()
    sizes = {"rows_per_range": 40, "min_ranges": 1}
    split = ranges.split(frame, {"v": F.col("v"), "id": F.col("id")}, **sizes)
    rows = [r["count"] for r in split.rows.groupBy(ranges.RANGE).count().collect()]
    assert len(rows) > 1_000 and max(rows) < 8 * 40 and sum(rows) == 60_000
    order = Window.orderBy(F.desc_nulls_last("v"), "id")
    plain = frame.withColumn("tile", F.ntile(7).over(order).cast("bigint"))
    same(ranges.global_ntile(frame, "v", "id", 7, "tile", **sizes), plain)
    plain = frame.withColumn("s", F.sum("v").over(Window.orderBy(F.desc_nulls_last("v"))))
    same(ranges.global_running_sum(frame, "v", "id", "s", **sizes)[0], plain)
    plain = frame.withColumn(
        "r", F.dense_rank().over(Window.partitionBy("g").orderBy(F.desc_nulls_last("v")))
    )
    same(ranges.dense_rank_in_groups(frame, "g", "v", "id", "r", **sizes), plain)
    # Every group that is larger than the bound is cut, into parts that are not.
    split = ranges.split(frame, {"v": F.col("v"), "id": F.col("id")}, "g", **sizes)
    parts = split.rows.groupBy("g", ranges.RANGE).count()
    assert parts.agg(F.max("count")).first()[0] < 8 * 40
    frame.unpersist()


def test_only_cuts_are_collected(spark, monkeypatch):
    """The sample stays in Spark: no more keys come to the driver than there are cuts."""
    frame = spark.range(100_000).select("id")
    split = ranges.split(frame, {"id": F.col("id")}, rows_per_range=1_000)
    assert 50 <= len(split.cuts) < 200
    assert split.cuts == sorted(split.cuts)
