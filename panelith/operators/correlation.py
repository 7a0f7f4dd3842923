"""Pairwise-complete moments of many columns at once.

A task keeps matrices (column x column) of its rows: how many rows have both values, and sums of values,
squares and products over those. What leaves a task are counts, means and central moments of each pair, one row
a pair, whatever the number of rows; they merge around the common mean, so no digits cancel. Nothing in the
plan grows with the number of columns but the rows of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelith.functions.columns import finite, ratio
from panelith.session import cut_lineage

PARTIAL = "i int, j int, n double, mx double, my double, sxx double, syy double, sxy double"
#: a spread below this share of the size of the values is rounding noise
NOISE = 1e-13


def _moments(k: int):
    upper = np.triu_indices(k)

    def run(batches):
        shift = None
        for rows in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in rows.columns]).astype(float)
            if not len(x):
                continue
            known = ~np.isnan(x)
            if shift is None:
                total = known.sum(axis=0)
                shift = np.where(known, x, 0).sum(axis=0) / np.maximum(total, 1)
                sums = [np.zeros((k, k)) for _ in range(4)]
            x = np.where(known, x - shift, 0.0)
            seen = known.astype(float)
            for held, more in zip(sums, (seen.T @ seen, x.T @ seen, (x * x).T @ seen, x.T @ x)):
                held += more
        if shift is None:
            return
        n, s, q, c = sums
        some = np.maximum(n, 1)
        parts = [n, shift[:, None] + s / some, shift[None, :] + s.T / some,
                 q - s * s / some, q.T - s.T * s.T / some, c - s * s.T / some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32())] + [pa.array(p[upper]) for p in parts],
            names=["i", "j", "n", "mx", "my", "sxx", "syy", "sxy"],
        )

    return run


def pair_moments(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, sxx, syy, sxy) for every ordered pair of columns, over the rows with both values finite: sums
    of squared deviations and of their products. A spread that is rounding noise is 0. Pairs without rows have n = 0."""
    spark = rows.sparkSession
    parts = cut_lineage(rows.select(*[finite(c).alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(_moments(len(columns)), PARTIAL))
    centre = parts.groupBy("i", "j").agg(
        *[ratio(F.sum(F.col("n") * F.col(m)), F.sum("n")).alias(f"_{m}") for m in ("mx", "my")]
    )
    dx, dy, n = F.col("mx") - F.col("_mx"), F.col("my") - F.col("_my"), F.col("n")
    merged = parts.where("n > 0").join(centre, ["i", "j"]).groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.first("_mx").alias("_mx"), F.first("_my").alias("_my"),
        F.sum(F.col("sxx") + n * dx * dx).alias("sxx"), F.sum(F.col("syy") + n * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + n * dx * dy).alias("sxy"),
    )

    def clean(total: str, mean: str):
        floor = F.col("n") * NOISE * NOISE * F.col(mean) * F.col(mean)
        return F.when(F.col(total) > floor, F.col(total)).otherwise(0.0)

    merged = merged.select("i", "j", "n", clean("sxx", "_mx").alias("sxx"), clean("syy", "_my").alias("syy"), "sxy")
    both = merged.unionByName(
        merged.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "n", F.col("syy").alias("sxx"), F.col("sxx").alias("syy"), "sxy")
    )
    k, names = len(columns), F.array(*[F.lit(c) for c in columns])
    pairs = spark.range(k * k).select(F.expr(f"cast(id div {k} as int)").alias("i"), F.expr(f"cast(id % {k} as int)").alias("j"))
    pairs = pairs.select("i", "j", F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"))
    out = pairs.join(both, ["i", "j"], "left")
    return out.select("a", "b", F.coalesce("n", F.lit(0.0)).cast("long").alias("n"), "sxx", "syy", "sxy")


def pair_correlation(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr); NULL without spread on either side."""
    return pair_moments(rows, columns).select(
        "a", "b", ratio(F.col("sxy"), F.sqrt("sxx") * F.sqrt("syy")).alias("corr")
    )


def pair_covariance(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, cov): sample covariances; NULL with fewer than two rows."""
    return pair_moments(rows, columns).select("a", "b", ratio(F.col("sxy"), F.col("n") - 1).alias("cov"))
