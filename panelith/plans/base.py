"""Shared inputs of the registered queries, once as DataFrames and once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelith.functions.columns import by_entity, ratio
from panelith.operators import windows as W
from panelith.operators.align import align_benchmark
from panelith.plans.registry import cte
from panelith.session import cut_lineage
from panelith.sources import panel as P

# weekly counterparts of the usual daily windows
RETURNS = {"mom_1": 1, "mom_4": 4, "ret_13": 13, "ret_26": 26}
AVERAGES = {"vs_ma10": 10, "vs_ma40": 40}
SPREAD = ("ret26_minus_mom4", "ret_26", "mom_4")
FEATURES = ["mom_1", "mom_4", "ret_13", "vs_ma10", "rsi"]
# the reference market and macro roles, filled from the order priorities
MACRO_SYMBOLS = {
    "1-URGENT": "VIX", "2-HIGH": "VIX3M", "3-MEDIUM": "HYOAS", "4-NOT SPECIFIED": "TNX", "5-LOW": "TWO",
}

cte("dim", "", "SELECT s_suppkey AS entity, n_regionkey AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey")
cte("panel", "dim", """
SELECT entity, dt, sector, notional, volume, high, low, notional / volume AS close FROM (
  SELECT l_suppkey AS entity, CAST(date_trunc('week', l_shipdate) AS DATE) AS dt,
         sum(l_extendedprice) AS notional, sum(l_quantity) AS volume,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low
  FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2) JOIN dim USING (entity)""")
cte("daypanel", "dim", """
SELECT entity, dt, sector, notional, volume, notional / volume AS close FROM (
  SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt,
         sum(l_extendedprice) AS notional, sum(l_quantity) AS volume
  FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2) JOIN dim USING (entity)""")
cte("sbench", "panel", "SELECT sector, dt, sum(notional) / sum(volume) AS bench_close FROM panel GROUP BY 1, 2")
cte("market", "panel", "SELECT dt, sum(notional) / sum(volume) AS market_close FROM panel GROUP BY 1")
cte("aligned", "panel sbench", "SELECT p.*, b.bench_close AS bench FROM panel p LEFT JOIN sbench b USING (sector, dt)")
cte("feat", "aligned", """
SELECT *, ret_26 - mom_4 AS ret26_minus_mom4,
  CASE WHEN nd = 14 AND dn <> 0 THEN 100 - 100 / (1 + up / dn) END AS rsi FROM (
  SELECT *,
    close / lag(close, 1) OVER w - 1 AS mom_1, close / lag(close, 4) OVER w - 1 AS mom_4,
    close / lag(close, 13) OVER w - 1 AS ret_13, close / lag(close, 26) OVER w - 1 AS ret_26,
    CASE WHEN count(close) OVER w10 = 10 THEN close / avg(close) OVER w10 - 1 END AS vs_ma10,
    CASE WHEN count(close) OVER w40 = 40 THEN close / avg(close) OVER w40 - 1 END AS vs_ma40,
    count(delta) OVER w14 AS nd,
    avg(CASE WHEN delta > 0 THEN delta WHEN delta <= 0 THEN 0 END) OVER w14 AS up,
    avg(CASE WHEN delta < 0 THEN -delta WHEN delta >= 0 THEN 0 END) OVER w14 AS dn
  FROM (SELECT *, close - lag(close) OVER (PARTITION BY entity ORDER BY dt) AS delta FROM aligned)
  WINDOW w AS (PARTITION BY entity ORDER BY dt),
    w10 AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
    w14 AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
    w40 AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 39 PRECEDING AND CURRENT ROW))""")
cte("fwd", "feat", """
SELECT * FROM (SELECT *, lead(close, 4) OVER w / close - 1 - (lead(bench, 4) OVER w / bench - 1) AS fwd_ret
  FROM feat WINDOW w AS (PARTITION BY entity ORDER BY dt)) WHERE fwd_ret IS NOT NULL""")


def panel(spark: SparkSession, sf: str, prices: DataFrame | None = None) -> DataFrame:
    return P.sector_panel(spark, sf, prices=prices)


def staged_panel(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(prices per entity and week, the same aligned to the sector), each written once, for queries that derive
    several inputs from them."""
    prices = cut_lineage(P.price_panel(spark, sf))
    return prices, cut_lineage(aligned(spark, sf, prices))


def staged_bars(spark: SparkSession, sf: str) -> DataFrame:
    """(entity, dt, notional, volume, close), written once without the day's range: for the series, the sectors'
    benchmark and the market."""
    bars = cut_lineage(P.price_panel(spark, sf).select("entity", "dt", "notional", "volume"))
    return bars.withColumn("close", F.col("notional") / F.col("volume"))


def aligned_and_market(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``aligned`` without the bars' range, and the market's close: both benchmarks from one table of a row per sector
    and date, which is broadcast, so that prices travel to their entity only."""
    rows = panel(spark, sf, staged_bars(spark, sf))
    totals = cut_lineage(rows.groupBy("sector", "dt").agg(F.sum("notional").alias("notional"), F.sum("volume").alias("volume")))
    bench = P.sector_series(totals).withColumnRenamed("bench_close", "bench")
    base = rows.drop("notional", "volume").join(F.broadcast(bench), ["sector", "dt"], "left")
    return base, P.market_series(totals)


def aligned(spark: SparkSession, sf: str, prices: DataFrame | None = None) -> DataFrame:
    base = panel(spark, sf, prices)
    return base.join(
        P.sector_series(base).withColumnRenamed("bench_close", "bench"), ["sector", "dt"], "left"
    )


def features(spark: SparkSession, sf: str, base: DataFrame | None = None) -> DataFrame:
    base = aligned(spark, sf) if base is None else base
    return W.price_features(base, RETURNS, AVERAGES, 14, SPREAD)


def forward(spark: SparkSession, sf: str, h: int = 4) -> DataFrame:
    return W.forward_return(features(spark, sf), h)


def sql_rank_norm(feature: str, alias: str | None = None) -> str:
    """SQL text: cross-sectional rank to [0, 1] of one feature."""
    v = f"round({feature}, 10)"
    return (
        f"CASE WHEN {feature} IS NULL OR count({feature}) OVER (PARTITION BY dt) <= 1 THEN 0.5 ELSE "
        f"(rank() OVER (PARTITION BY dt ORDER BY {v} ASC NULLS LAST) "
        f"+ (count({v}) OVER (PARTITION BY dt, {v}) - 1) / 2.0 - 1) "
        f"/ (count({feature}) OVER (PARTITION BY dt) - 1) END AS {alias or feature}"
    )


def sql_tie_rank(value: str, keys: str) -> str:
    v = f"round({value}, 10)"
    part = f"PARTITION BY {keys}" if keys else ""
    ties = f"PARTITION BY {keys}, {v}" if keys else f"PARTITION BY {v}"
    return f"(rank() OVER ({part} ORDER BY {v}) + (count(*) OVER ({ties}) - 1) / 2.0)"


def macro_roles(spark: SparkSession, sf: str, grain: str = "day", panel_df: DataFrame | None = None) -> DataFrame:
    """(symbol, dt, close) with the market as SPY and the order priorities in the macro roles."""
    prices = P.market_totals(spark, sf, grain) if panel_df is None else panel_df
    spy = P.market_series(prices).select(F.lit("SPY").alias("symbol"), "dt", F.col("market_close").alias("close"))
    names = F.create_map(*[F.lit(x) for kv in MACRO_SYMBOLS.items() for x in kv])
    macro = P.macro_series(spark, sf, grain).select(names[F.col("symbol")].alias("symbol"), "dt", "close")
    return spy.unionByName(macro)


cte("macrorow", "daypanel", """
SELECT 'SPY' AS symbol, dt, sum(notional) / sum(volume) AS close FROM daypanel GROUP BY 2
UNION ALL SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'VIX' WHEN '2-HIGH' THEN 'VIX3M' WHEN '3-MEDIUM' THEN 'HYOAS'
  WHEN '4-NOT SPECIFIED' THEN 'TNX' ELSE 'TWO' END, CAST(o_orderdate AS DATE), avg(o_totalprice) FROM orders GROUP BY 1, 2""")
cte("macrowide", "macrorow", """
SELECT dt, """ + ", ".join(
    f"last_value({r} IGNORE NULLS) OVER (ORDER BY dt ROWS UNBOUNDED PRECEDING) AS {r}" for r in W.MACRO_ROLES
) + " FROM (SELECT dt, " + ", ".join(
    f"max(CASE WHEN symbol = '{r}' THEN close END) AS {r}" for r in W.MACRO_ROLES
) + " FROM macrorow GROUP BY dt)")
