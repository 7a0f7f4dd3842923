"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelith.llm.staging import Stage


def _large_star(stage: Stage, edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    # written, so that the join can split a node with very many neighbours
    low = stage.write(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    rest = down.join(low, "u").where("v <> low").select(F.col("v").alias("a"), F.col("low").alias("b"))
    return low.select(F.col("u").alias("a"), F.col("low").alias("b")).union(rest)


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node but the roots has exactly one edge, and that leads to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    return ends.groupBy("node").agg(F.sum("out").alias("outs"), F.count("*").alias("n")).where(
        "outs > 1 OR (outs = 1 AND n > 1)"
    ).isEmpty()


def components(stage: Stage, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that isn't its own root.

    ``edges`` are (a, b) of one orderable type. Each step is written out; the number of steps is
    logarithmic in the number of nodes. No group is gathered anywhere: the stars are minima per node.
    """
    now = stage.write(edges.where("a <> b").distinct())
    while True:
        then = stage.write(_small_star(_large_star(stage, now)).where("a <> b").distinct())
        stage.drop(now)
        now = then
        if _is_forest(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
