"""Connected components by alternating large-star and small-star rounds.

Every round moves edges to smaller neighbours until each node hangs on the
smallest of its component, which takes about log(n) rounds.  The edges of a
round are a table in the shared folder; the driver sees only two numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import staged_at
from sluice.session import drop_scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger node ``u`` to the smaller ``v``."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(low, "u").where("v > m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node of its component) of every node of
    ``edges(u, v)`` that is not itself a root.  Loops and repeats are fine."""
    edges, path = staged_at(spark, edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        last = path
        edges, path = staged_at(spark, _small(_large(edges)), "edges")
        drop_scratch(spark, last)  # the round after it is written
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
