"""Panels derived from the order tables: prices, sectors, benchmarks, macro series.

The raw fact table is reduced to one row per (entity, dt) with a map-side combined aggregate
before anything else happens, so an entity that owns a third of all raw rows still contributes at
most one row per calendar date afterwards. Every later window over an entity is bounded by the
calendar for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SCHEMAS: dict[tuple[str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; its schema is read from a footer once per session, however often a plan uses it."""
    path = f"{sf_dir}/{name}.parquet"
    key = spark.sparkContext.applicationId, path
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def week_of(col: str) -> Column:
    return F.to_date(F.date_trunc("week", F.col(col)))


def day_of(col: str) -> Column:
    return F.to_date(F.col(col))


def entity_bound(spark: SparkSession, sf_dir: str) -> int:
    """Upper bound on a cross-section: the number of entities (answered from file footers)."""
    return table(spark, sf_dir, "supplier").count()


def price_panel(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """(entity, dt, open-free bar): volume-weighted close, high, low, volume, notional."""
    dt = week_of("l_shipdate") if grain == "week" else day_of("l_shipdate")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") > 0)
        .groupBy(F.col("l_suppkey").alias("entity"), dt.alias("dt"))
        .agg(
            F.sum("l_extendedprice").alias("notional"),
            F.sum("l_quantity").alias("volume"),
            F.max(unit).alias("high"),
            F.min(unit).alias("low"),
        )
        .withColumn("close", F.col("notional") / F.col("volume"))
    )


def dim_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity -> sector (region of the supplier)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("entity"), F.col("n_regionkey").alias("sector")
    )


def single_entities(spark: SparkSession, sf_dir: str) -> bool:
    """Whether no entity repeats in the dimension, so that the panel has one row per (entity, dt)."""
    return dim_entity(spark, sf_dir).groupBy("entity").count().where("count > 1").isEmpty()


def sector_panel(spark: SparkSession, sf_dir: str, grain: str = "week", prices: DataFrame | None = None) -> DataFrame:
    prices = price_panel(spark, sf_dir, grain) if prices is None else prices
    return prices.join(dim_entity(spark, sf_dir), "entity")


def sector_series(panel: DataFrame) -> DataFrame:
    """Sector benchmark: volume-weighted close per (sector, dt), from the reduced panel."""
    return (
        panel.groupBy("sector", "dt")
        .agg((F.sum("notional") / F.sum("volume")).alias("bench_close"))
    )


def market_series(panel: DataFrame) -> DataFrame:
    return panel.groupBy("dt").agg((F.sum("notional") / F.sum("volume")).alias("market_close"))


def market_totals(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """(dt, notional, volume) of the whole market: one row per date from one map-side combined aggregate, for
    readers that need no entity."""
    dt = week_of("l_shipdate") if grain == "week" else day_of("l_shipdate")
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") > 0)
        .groupBy(dt.alias("dt"))
        .agg(F.sum("l_extendedprice").alias("notional"), F.sum("l_quantity").alias("volume"))
    )


def macro_series(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """Five macro symbols: mean order value per priority and period."""
    dt = week_of("o_orderdate") if grain == "week" else day_of("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("symbol"), dt.alias("dt"))
        .agg(F.avg("o_totalprice").alias("close"))
    )
