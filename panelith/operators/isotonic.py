"""Isotonic regression whose pooled blocks merge between ranges of the input.

Equal inputs combine first. Rows are dealt to ascending ranges; each pools its adjacent violators into a stack
of blocks with rising means, and stacks of neighbouring ranges merge, ``FAN`` at a time, by pooling again:
blocks that stay apart at a seam stay as they are. For labels 0 and 1 the means of the final blocks are distinct
fractions whose denominators add up to the number of rows, so n rows leave some 2 n**(2/3) blocks at the very most (and of
the order of n**(1/3) on noisy labels); these alone come to the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.session import cut_lineage

FAN = 16
BLOCK = "part int, lo double, hi double, weight double, total double"


def pool(stack: list[list[float]], blocks) -> list[list[float]]:
    """Pushes (lo, hi, weight, total) blocks, in ascending order, on a stack of blocks with rising means."""
    for lo, hi, weight, total in blocks:
        while stack and stack[-1][3] * weight >= total * stack[-1][2]:
            before = stack.pop()
            lo, weight, total = before[0], weight + before[2], total + before[3]
        stack.append([lo, hi, weight, total])
    return stack


def _frame(part: int, stack: list[list[float]]) -> pd.DataFrame:
    out = pd.DataFrame(stack, columns=["lo", "hi", "weight", "total"])
    out.insert(0, "part", part)
    return out


def _pool_range(batches):
    stack, part = [], None
    for rows in batches:
        if len(rows):
            part = int(rows["part"].iloc[0])
            pool(stack, rows[["x", "x", "weight", "total"]].itertuples(index=False, name=None))
    if part is not None:
        yield _frame(part, stack)


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("lo", kind="stable")
    return _frame(int(key[0]), pool([], rows[["lo", "hi", "weight", "total"]].itertuples(index=False, name=None)))


def isotonic_blocks(rows: DataFrame, x: str, y: str) -> DataFrame:
    """(lo, hi, weight, mean): the least-squares rising step function of ``y`` on ``x``; rows with NULL on
    either side take no part."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = rows.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna().groupBy("x").agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum("y").alias("total")
    )
    ranged = points.repartitionByRange(n, "x").withColumn("part", F.spark_partition_id()).sortWithinPartitions("x")
    blocks = cut_lineage(ranged.mapInPandas(_pool_range, BLOCK))
    width = n
    while width > 1:
        blocks = blocks.groupBy(F.expr(f"part div {FAN}").cast("int").alias("key")).applyInPandas(_merge, BLOCK)
        width = -(-width // FAN)
    return blocks.select("lo", "hi", "weight", (F.col("total") / F.col("weight")).alias("mean"))


def isotonic_curve(blocks: DataFrame):
    """Column function: straight lines between the blocks' ends, level outside; NULL stays NULL, and so is everything
    if there are no blocks."""
    found = sorted(tuple(r) for r in cut_lineage(blocks).select("lo", "hi", "mean").collect())
    xs = np.array([e for lo, hi, _ in found for e in (lo, hi)])
    ys = np.array([m for _, _, m in found for _ in (0, 1)])

    @F.pandas_udf(T.DoubleType())
    def curve(value: pd.Series) -> pd.Series:
        given = value.to_numpy(float)
        return pd.Series(np.where(np.isnan(given), np.nan, np.interp(given, xs, ys)) if len(xs) else np.full(len(given), np.nan))

    def apply(value: Column) -> Column:
        out = curve(value.cast("double"))
        return F.when(~F.isnan(out), out)

    return apply
