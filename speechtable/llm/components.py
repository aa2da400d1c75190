"""Connected components of an edge table, without collecting edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechtable import settings


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge to another one.

    Alternates "large star" and "small star": every node links its larger neighbours (then all its smaller
    neighbours) to its smallest neighbour, until no edge changes; the rounds grow with the logarithm of the
    longest chain. Each round is two aggregates by node with partial sums and two joins; the table is written to
    the shared folder between rounds, so lineage stays short and a lost executor costs one round.
    Null ends and self links are ignored.
    """
    table = edges.select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
    table = table.where("high > low").distinct()
    table = settings.materialize(table, "links")
    before = None
    while (state := _state(table)) != before:
        before = state
        both = table.unionByName(table.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.least("high", F.min("low")).alias("root"))
        large = both.where("low > high").join(least, "high").select(F.col("low").alias("high"), F.col("root").alias("low"))
        large = large.where("high > low").distinct()
        least = large.groupBy("high").agg(F.min("low").alias("root"))
        small = large.join(least, "high").select(F.explode(F.array(
            F.struct(F.col("low").alias("high"), F.col("root").alias("low")),
            F.struct("high", F.col("root").alias("low")))).alias("e")).select("e.*")
        table = settings.materialize(small.where("high > low").distinct(), "links")
    nodes = table.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.unionByName(table.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def _state(table: DataFrame):
    return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first())
