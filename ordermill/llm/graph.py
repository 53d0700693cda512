"""Connected components of an edge table, with alternating star contractions.

Every round is two aggregations and joins over the edges, written to the shared folder, so lineage
stays short and a lost executor costs a re-read. No node's neighbours meet in one task: minima
are pre-aggregated, and the joins back to the edges are of one row per node on one side, which
lets Spark split a node that owns a third of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import Stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, stored: Stored) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for the nodes of edges (a, b)
    that are not roots themselves. Ids are bigint; loops and nulls are ignored."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored.put(ordered.where("a > b").distinct(), "edges")
    state = None
    while True:
        mark = F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(38, 0)))")
        found = edges.agg(F.count("*"), mark).head()
        if tuple(found) == state or not found[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(found)
        edges = stored.put(_small_star(_large_star(edges)), "edges")
