"""As-of alignment: equi joins plus forward fill, never a non-equi join.

The forward fill runs over distinct (series key, dt) pairs, so its windows are bounded by the
calendar whatever the number of entities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_values(
    needed: DataFrame,
    series: DataFrame,
    keys: list[str],
    values: list[str],
    dt: str = "dt",
    source_dt: str | None = None,
) -> DataFrame:
    """For every distinct (keys, dt) in ``needed``: the newest non-null ``values`` of ``series``
    with date <= dt. ``source_dt`` also returns the date the (first) value was taken from."""
    points = needed.select(*keys, dt).distinct()
    extra = ["_src"] if source_dt else []
    left = points.select(
        *keys, dt, *[F.lit(None).cast(series.schema[v].dataType).alias(v) for v in values],
        *([F.lit(None).cast("date").alias("_src")] if source_dt else []),
        F.lit(True).alias("_need"),
    )
    right = series.select(
        *keys, dt, *values, *([F.col(dt).alias("_src")] if source_dt else []),
        F.lit(False).alias("_need"),
    )
    # series rows sort before the rows asking for the same date
    fill = (
        Window.partitionBy(*keys)
        .orderBy(F.col(dt), F.col("_need"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = left.unionByName(right)
    for v in values + extra:
        filled = filled.withColumn(v, F.last(v, ignorenulls=True).over(fill))
    out = filled.where("_need").drop("_need")
    return out.withColumnRenamed("_src", source_dt) if source_dt else out


def align_benchmark(
    panel: DataFrame,
    sector_bench: DataFrame,
    market: DataFrame,
    mode: str = "exact",
) -> DataFrame:
    """Adds ``bench``: the sector's close on the entity's dates, or the market's for entities whose
    sector has no series at all. ``exact`` leaves gaps empty, ``ffill`` carries the past forward.

    panel: (entity, dt, sector, ...); sector_bench: (sector, dt, bench_close);
    market: (dt, market_close).
    """
    if mode not in ("exact", "ffill"):
        raise ValueError(f"unknown alignment mode {mode!r}")
    listed = sector_bench.select("sector").distinct().withColumn("_listed", F.lit(True))
    tagged = panel.join(F.broadcast(listed), "sector", "left")  # a row per sector
    if mode == "ffill":
        needed = panel.select("sector", "dt").distinct()
        sector_bench = asof_values(needed, sector_bench, ["sector"], ["bench_close"])
        days = panel.select("dt").distinct().withColumn("_k", F.lit(0))
        market = asof_values(
            days, market.withColumn("_k", F.lit(0)), ["_k"], ["market_close"]
        ).drop("_k")
    joined = tagged.join(sector_bench, ["sector", "dt"], "left").join(market, "dt", "left")
    return joined.withColumn(
        "bench",
        F.when(F.col("_listed"), F.col("bench_close")).otherwise(F.col("market_close")),
    ).drop("_listed", "bench_close", "market_close")


def join_macro(rows: DataFrame, macro: DataFrame) -> DataFrame:
    """Per-date values onto every row; dates without a macro row stay NULL."""
    return rows.join(macro, "dt", "left")
