"""Queries over alignment, window features, macro series and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelith.functions.ranks import fits_window
from panelith.operators import windows as W
from panelith.operators.align import align_benchmark, join_macro
from panelith.plans.base import (
    FEATURES, aligned, features, forward, macro_roles, panel, sql_rank_norm, sql_tie_rank,
)
from panelith.plans.registry import cte, register
from panelith.session import cut_lineage
from panelith.sources import panel as P

HORIZONS = [1, 2, 4, 8, 13]


@register("price_panel", "entity:i dt:d close:f high:f low:f volume:f sector:i", "panel",
          "SELECT * FROM panel")
def price_panel(spark, sf):
    return panel(spark, sf)


# Gappy benchmark: value-weighted price of all lines per region, return flag and day. An entity follows the
# series of its region and of one flag (days without such lines are gaps), or one that does not exist, so
# that exact alignment, forward fill and the market fallback all occur.
FLAGS = ["A", "N", "R"]
cte("gapbench", "dim", """
SELECT sector * 4 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS symbol, CAST(l_shipdate AS DATE) AS dt,
 sum(l_extendedprice) / sum(l_quantity) AS bench_close
FROM lineitem JOIN dim ON entity = l_suppkey GROUP BY 1, 2""")
cte("gappanel", "daypanel", "SELECT *, sector * 4 + entity % 4 AS symbol FROM daypanel")
cte("daymarket", "daypanel", "SELECT dt, sum(notional) / sum(volume) AS market_close FROM daypanel GROUP BY 1")


def gap_bench(spark, sf):
    lines = P.table(spark, sf, "lineitem")
    flag = F.when(F.col("l_returnflag") == FLAGS[0], 0).when(F.col("l_returnflag") == FLAGS[1], 1).otherwise(2)
    # reduce to entity x flag x day first, then to symbol x day
    per_entity = lines.groupBy(F.col("l_suppkey").alias("entity"), flag.alias("flag"), P.day_of("l_shipdate").alias("dt")).agg(
        F.sum("l_extendedprice").alias("notional"), F.sum("l_quantity").alias("volume"))
    symbols = per_entity.join(P.dim_entity(spark, sf), "entity").withColumn("sector", F.col("sector") * 4 + F.col("flag"))
    return P.sector_series(symbols)


def gap_panel(day):
    return day.withColumn("sector", F.col("sector") * 4 + F.col("entity") % 4)


@register("align_benchmark_exact", "entity:i dt:d close:f bench:f", "gappanel gapbench daymarket", """
SELECT entity, dt, close, CASE WHEN entity % 4 = 3 THEN market_close ELSE bench_close END AS bench
FROM gappanel LEFT JOIN gapbench USING (symbol, dt) LEFT JOIN daymarket USING (dt)""")
def align_exact(spark, sf):
    day = P.sector_panel(spark, sf, "day")
    return align_benchmark(gap_panel(day), gap_bench(spark, sf), P.market_series(day), "exact")


@register("align_benchmark_ffill", "entity:i dt:d close:f bench:f", "gappanel gapbench daymarket", """
SELECT p.entity, p.dt, p.close, CASE WHEN p.entity % 4 = 3 THEN m.market_close ELSE b.bench_close END AS bench
FROM gappanel p ASOF LEFT JOIN gapbench b ON p.symbol = b.symbol AND p.dt >= b.dt LEFT JOIN daymarket m ON m.dt = p.dt""")
def align_ffill(spark, sf):
    day = P.sector_panel(spark, sf, "day")
    return align_benchmark(gap_panel(day), gap_bench(spark, sf), P.market_series(day), "ffill")


@register("forward_return", "entity:i dt:d fwd_ret:f direction:s", "fwd",
          "SELECT entity, dt, fwd_ret, CASE WHEN round(fwd_ret, 10) >= 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM fwd")
def forward_return(spark, sf):
    return W.forward_return(aligned(spark, sf), 4)


@register("forward_return_clipped", "entity:i dt:d fwd_ret:f direction:s", "fwd",
          "SELECT entity, dt, least(0.4, greatest(-0.4, fwd_ret)) AS fwd_ret, CASE WHEN round(fwd_ret, 10) >= 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM fwd")
def forward_return_clipped(spark, sf):
    return W.forward_return(aligned(spark, sf), 4, clip=0.40)


@register("multi_horizon_returns", "entity:i dt:d " + " ".join(f"fwd_{h}:f" for h in HORIZONS), "aligned",
          "SELECT entity, dt, " + ", ".join(
              f"lead(close, {h}) OVER w / close - 1 - (lead(bench, {h}) OVER w / bench - 1) AS fwd_{h}" for h in HORIZONS)
          + " FROM aligned WINDOW w AS (PARTITION BY entity ORDER BY dt)")
def multi_horizon(spark, sf):
    return W.multi_horizon_returns(aligned(spark, sf), HORIZONS)


@register("price_features", "entity:i dt:d mom_1:f mom_4:f ret_13:f ret_26:f vs_ma10:f vs_ma40:f rsi:f ret26_minus_mom4:f",
          "feat", "SELECT * FROM feat")
def price_features(spark, sf):
    return features(spark, sf)


RESID = dict(beta_window=13, mom_window=52, skip_window=4, vol_window=8, change_window=4)
cte("residmom", "aligned", """
SELECT *,
  CASE WHEN count(resid) OVER wc = 48 THEN sum(resid) OVER wc END
    / (CASE WHEN count(resid) OVER wv = 8 THEN stddev_samp(resid) OVER wv END * sqrt(48.0) + 1e-8) AS resid_mom_vol_scaled,
  lag(close, 4) OVER w / lag(close, 52) OVER w - 1 AS mom_12_1,
  close / lag(close, 4) OVER w - 1 AS mom_1m,
  CASE WHEN count(r) OVER wr = 4 THEN sum(r) OVER wr END - CASE WHEN count(r) OVER wp = 4 THEN sum(r) OVER wp END AS mom_change,
  lag(bench, 4) OVER w / lag(bench, 52) OVER w - 1 AS sector_mom
FROM (SELECT *, round(r - CASE WHEN count(r) OVER wb = 13 AND var_samp(rb) OVER wb <> 0
        THEN covar_samp(r, rb) OVER wb / var_samp(rb) OVER wb END * rb, 12) AS resid
  FROM (SELECT *, close / lag(close) OVER w - 1 AS r, bench / lag(bench) OVER w - 1 AS rb FROM aligned
        WINDOW w AS (PARTITION BY entity ORDER BY dt))
  WINDOW wb AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING))
WINDOW w AS (PARTITION BY entity ORDER BY dt),
  wc AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 51 PRECEDING AND 4 PRECEDING),
  wv AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 7 PRECEDING AND CURRENT ROW),
  wr AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
  wp AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING)""")


@register("residual_momentum_features",
          "entity:i dt:d resid_mom_vol_scaled:f mom_12_1:f mom_1m:f mom_change:f sector_mom:f", "residmom",
          "SELECT * FROM residmom")
def residual_momentum(spark, sf):
    return W.residual_momentum_features(aligned(spark, sf), **RESID)


cte("vol", "panel", """
SELECT * EXCLUDE (lr), CASE WHEN count(lr) OVER w = 8 THEN stddev_samp(lr) OVER w END * sqrt(52.0) AS realized_vol
FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY entity ORDER BY dt)) AS lr FROM panel)
WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")


@register("realized_vol", "entity:i dt:d realized_vol:f", "vol", "SELECT * FROM vol")
def realized_vol(spark, sf):
    return W.realized_vol(panel(spark, sf), 8, 52)


@register("ewm_indicators", "entity:i dt:d ewm_rsi:f macd_line:f macd_signal:f macd_cross:i macd_above_zero:i", "panel", """
, pos AS (SELECT entity, dt, close, row_number() OVER (PARTITION BY entity ORDER BY dt) AS rn,
    close - lag(close) OVER (PARTITION BY entity ORDER BY dt) AS delta FROM panel),
rec AS (
  SELECT entity, dt, rn, close AS e12, close AS e26, 0.0::DOUBLE AS line, 0.0::DOUBLE AS sig,
         NULL::DOUBLE AS g, NULL::DOUBLE AS l FROM pos WHERE rn = 1
  UNION ALL
  SELECT p.entity, p.dt, p.rn, p.close * (2/13.0::DOUBLE) + r.e12 * (1 - 2/13.0::DOUBLE),
    p.close * (2/27.0::DOUBLE) + r.e26 * (1 - 2/27.0::DOUBLE),
    (p.close * (2/13.0::DOUBLE) + r.e12 * (1 - 2/13.0::DOUBLE)) - (p.close * (2/27.0::DOUBLE) + r.e26 * (1 - 2/27.0::DOUBLE)),
    ((p.close * (2/13.0::DOUBLE) + r.e12 * (1 - 2/13.0::DOUBLE)) - (p.close * (2/27.0::DOUBLE) + r.e26 * (1 - 2/27.0::DOUBLE))) * 0.2::DOUBLE + r.sig * 0.8::DOUBLE,
    CASE WHEN r.g IS NULL THEN greatest(p.delta, 0) ELSE greatest(p.delta, 0) * (1/14.0::DOUBLE) + r.g * (13/14.0::DOUBLE) END,
    CASE WHEN r.l IS NULL THEN greatest(-p.delta, 0) ELSE greatest(-p.delta, 0) * (1/14.0::DOUBLE) + r.l * (13/14.0::DOUBLE) END
  FROM rec r JOIN pos p ON p.entity = r.entity AND p.rn = r.rn + 1),
side AS (SELECT *, sign(round(line - sig, 10)) AS s, lag(sign(round(line - sig, 10))) OVER (PARTITION BY entity ORDER BY dt) AS ps FROM rec),
turn AS (SELECT *, CASE WHEN s > 0 AND ps <= 0 THEN 1 WHEN s < 0 AND ps >= 0 THEN -1 END AS t FROM side)
SELECT entity, dt, CASE WHEN l > 0 THEN 100 - 100 / (1 + g / l) END AS ewm_rsi, line AS macd_line, sig AS macd_signal,
  coalesce(last_value(t IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS macd_cross,
  CASE WHEN line > 0 THEN 1 ELSE 0 END AS macd_above_zero FROM turn""")
def ewm_indicators(spark, sf):
    return W.ewm_indicators(panel(spark, sf))


@register("volume_ratio", "entity:i dt:d volume_ratio:f", "panel", """
SELECT entity, dt, CASE WHEN count(volume) OVER w = 20 THEN avg(volume) OVER w END / avg(volume) OVER (PARTITION BY entity) AS volume_ratio
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def volume_ratio(spark, sf):
    return W.volume_ratio(panel(spark, sf), 20)


RN_COLS = "entity:i dt:d " + " ".join(f"{f}:f" for f in FEATURES)
RN_SQL = "SELECT entity, dt, " + ", ".join(sql_rank_norm(f) for f in FEATURES) + " FROM feat"


@register("rank_normalize", RN_COLS, "feat", RN_SQL)
def rank_normalize(spark, sf):
    rows = features(spark, sf).select("entity", "dt", *FEATURES)
    return W.rank_normalize(rows, FEATURES, P.entity_bound(spark, sf))


@register("rank_normalize_unbounded", RN_COLS, "feat", RN_SQL)
def rank_normalize_unbounded(spark, sf):
    """The same with no bound on the cross-section: it is counted, and dates beyond a task go through ranges of the
    values. None of these features reads a benchmark."""
    rows = features(spark, sf, panel(spark, sf)).select("entity", "dt", *FEATURES)
    return W.rank_normalize(rows, FEATURES, None)


@register("combined_rank", "entity:i dt:d mom_4:f combined_rank:i", "feat", """
SELECT entity, dt, mom_4, row_number() OVER (PARTITION BY dt ORDER BY round(mom_4, 10) DESC, entity) AS combined_rank
FROM feat WHERE mom_4 IS NOT NULL""")
def combined_rank(spark, sf):
    rows = features(spark, sf).where("mom_4 IS NOT NULL").select("entity", "dt", "mom_4")
    return W.combined_rank(rows, "mom_4", group_bound=P.entity_bound(spark, sf))


cte("zrow", "market feat", """
SELECT f.entity, f.dt, m.mkt_ret FROM feat f JOIN
 (SELECT dt, market_close / lag(market_close, 4) OVER (ORDER BY dt) - 1 AS mkt_ret FROM market) m USING (dt)""")


@register("ts_zscore", "entity:i dt:d mkt_ret:f mkt_ret_z:f", "zrow", """
SELECT z.entity, z.dt, z.mkt_ret, s.z AS mkt_ret_z FROM zrow z JOIN (
 SELECT dt, CASE WHEN count(mkt_ret) OVER w >= 60 THEN (mkt_ret - avg(mkt_ret) OVER w) / stddev_samp(mkt_ret) OVER w END AS z
 FROM (SELECT DISTINCT dt, mkt_ret FROM zrow) WINDOW w AS (ORDER BY dt ROWS BETWEEN 156 PRECEDING AND 1 PRECEDING)) s USING (dt)""")
def ts_zscore(spark, sf):
    base = panel(spark, sf)
    w = W.Window.orderBy("dt")
    macro = P.market_series(base).select(
        "dt", (F.col("market_close") / F.lag("market_close", 4).over(w) - 1).alias("mkt_ret"))
    return W.ts_zscore(join_macro(base.select("entity", "dt"), macro), ["mkt_ret"], 156)


@register("join_macro", "entity:i dt:d close:f urgent:f low:f", "panel", """
SELECT p.entity, p.dt, p.close, m.urgent, m.low FROM panel p LEFT JOIN (
 SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS dt, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent,
  avg(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low FROM orders GROUP BY 1) m USING (dt)""")
def macro_join(spark, sf):
    macro = (P.macro_series(spark, sf).groupBy("dt").pivot("symbol", ["1-URGENT", "5-LOW"])
             .agg(F.first("close")).toDF("dt", "urgent", "low"))
    return join_macro(panel(spark, sf).select("entity", "dt", "close"), macro)


LEVELS = "spy_20d_return:f vix_level:f vix_term_slope:f hy_oas_bps:f yield_curve_slope:f"
LEVEL_SQL = """VIX AS vix_level, VIX3M - VIX AS vix_term_slope, HYOAS * 100.0 AS hy_oas_bps, TNX - TWO AS yield_curve_slope"""
cte("mdaily", "macrowide", f"""
SELECT * FROM (SELECT dt, SPY / lag(SPY, 20) OVER (ORDER BY dt) - 1 AS spy_20d_return, {LEVEL_SQL} FROM macrowide)
WHERE spy_20d_return IS NOT NULL""")
cte("mweekly", "macrowide", f"""
SELECT * FROM (SELECT dt, SPY / lag(SPY, 4) OVER (ORDER BY dt) - 1 AS spy_20d_return, {LEVEL_SQL} FROM (
 SELECT CAST(c.dt AS DATE) AS dt, {", ".join(f"w.{r}" for r in W.MACRO_ROLES)} FROM (
   SELECT unnest(generate_series(min(wk), max(wk), INTERVAL 7 DAY)) AS dt FROM (
     SELECT dt + CAST((12 - isodow(dt)) % 7 AS INTEGER) AS wk FROM macrowide)) c
 LEFT JOIN (SELECT dt + CAST((12 - isodow(dt)) % 7 AS INTEGER) AS wk,
   {", ".join(f"max_by({r}, CASE WHEN {r} IS NOT NULL THEN dt END) AS {r}" for r in W.MACRO_ROLES)} FROM macrowide GROUP BY 1) w
 ON w.wk = c.dt)) WHERE spy_20d_return IS NOT NULL ORDER BY dt DESC LIMIT 260""")


def daily_macro(spark, sf):
    return W.macro_daily(W.macro_wide(macro_roles(spark, sf)))


@register("macro_daily", "dt:d " + LEVELS, "mdaily", "SELECT * FROM mdaily")
def macro_daily(spark, sf):
    return daily_macro(spark, sf)


def weekly_macro(spark, sf):
    return W.macro_weekly(W.macro_wide(macro_roles(spark, sf)), 4, 260)


@register("macro_weekly", "dt:d " + LEVELS, "mweekly", "SELECT * FROM mweekly")
def macro_weekly(spark, sf):
    return weekly_macro(spark, sf)


@register("latest_row", "dt:d feature:s value:f", "mdaily", """
SELECT * FROM (UNPIVOT (SELECT * FROM mdaily ORDER BY dt DESC LIMIT 1)
 ON spy_20d_return, vix_level, vix_term_slope, hy_oas_bps, yield_curve_slope INTO NAME feature VALUE value)""")
def latest_row(spark, sf):
    return W.latest_row(daily_macro(spark, sf))


cte("breadth", "panel market", """
SELECT dt, coalesce(last_value(f IGNORE NULLS) OVER p, 0.5) AS market_breadth, coalesce(last_value(s IGNORE NULLS) OVER p, 0.5) AS market_breadth_200d
FROM market LEFT JOIN (
  SELECT dt, CASE WHEN count(f) >= 10 THEN avg(f) END AS f, CASE WHEN count(s) >= 10 THEN avg(s) END AS s FROM (
    SELECT dt, CASE WHEN count(*) OVER e >= 10 THEN CASE WHEN count(*) OVER w10 = 10 AND close > avg(close) OVER w10 THEN 1.0 ELSE 0.0 END END AS f,
      CASE WHEN count(*) OVER e >= 40 THEN CASE WHEN count(*) OVER w40 = 40 AND close > avg(close) OVER w40 THEN 1.0 ELSE 0.0 END END AS s
    FROM panel WINDOW e AS (PARTITION BY entity),
      w10 AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
      w40 AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 39 PRECEDING AND CURRENT ROW)) GROUP BY dt) USING (dt)
WINDOW p AS (ORDER BY dt ROWS UNBOUNDED PRECEDING)""")


def weekly_breadth(spark, sf, prices=None):
    base = P.price_panel(spark, sf) if prices is None else prices
    return W.market_breadth(base, P.market_series(base), 10, 40)


@register("market_breadth", "dt:d market_breadth:f market_breadth_200d:f", "breadth", "SELECT * FROM breadth")
def market_breadth(spark, sf):
    return weekly_breadth(spark, sf)


PANEL_COLS = ("spy_20d_return spy_20d_vol vix_level vix_term_slope vix_vix3m_ratio yield_curve_slope yield_curve_10y_2y "
              "hy_oas_level hy_oas_change_21d baa10y_level baa10y_change_21d market_breadth market_breadth_200d").split()
cte("mpanelall", "macrowide daypanel", """
SELECT dt, SPY / lag(SPY, 20) OVER w - 1 AS spy_20d_return,
  CASE WHEN count(lr) OVER w20 = 20 THEN stddev_samp(lr) OVER w20 END * sqrt(252.0) AS spy_20d_vol,
  VIX / 20.0 AS vix_level, (VIX - VIX3M) / 20.0 AS vix_term_slope,
  coalesce(CASE WHEN VIX3M <> 0 THEN VIX / VIX3M END, 1.0) AS vix_vix3m_ratio,
  0.0::DOUBLE AS yield_curve_slope, (TNX - TWO) / 10.0 AS yield_curve_10y_2y, HYOAS AS hy_oas_level,
  HYOAS - lag(HYOAS, 21) OVER w AS hy_oas_change_21d, 0.0::DOUBLE AS baa10y_level, 0.0::DOUBLE AS baa10y_change_21d,
  0.5::DOUBLE AS market_breadth, 0.5::DOUBLE AS market_breadth_200d
FROM (SELECT *, ln(SPY / lag(SPY) OVER (ORDER BY dt)) AS lr FROM macrowide WHERE dt IN (SELECT dt FROM daypanel))
WINDOW w AS (ORDER BY dt), w20 AS (ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
cte("mpanel", "mpanelall", "SELECT * FROM mpanelall WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in PANEL_COLS))


def daily_macro_panel(spark, sf):
    prices = cut_lineage(P.market_totals(spark, sf, "day"))  # a row per day
    wide = W.macro_wide(macro_roles(spark, sf, "day", prices))
    # the panel lives on the market's own dates; two curve inputs have no series here
    return W.macro_panel(wide.join(prices.select("dt").distinct(), "dt", "left_semi"))


@register("macro_panel", "dt:d " + " ".join(f"{c}:f" for c in PANEL_COLS), "mpanel", "SELECT * FROM mpanel")
def macro_panel(spark, sf):
    return daily_macro_panel(spark, sf)


def sql_composite(weights: dict, frame: str, source: str, sign: str = "") -> str:
    num, den = [], []
    for n, wt in weights.items():
        z = (f"coalesce(({n} - avg({n}) OVER f) / CASE WHEN stddev_pop({n}) OVER f <> 0 THEN stddev_pop({n}) OVER f END, 0)")
        num.append(f"CASE WHEN {n} IS NOT NULL THEN {wt} * {z} ELSE 0 END")
        den.append(f"CASE WHEN {n} IS NOT NULL THEN {abs(wt)} ELSE 0 END")
    return (f"SELECT *, row_number() OVER (ORDER BY dt) AS pos, {sign}(coalesce(({' + '.join(num)}) / nullif({' + '.join(den)}, 0), 0)) AS z "
            f"FROM {source} WINDOW f AS (ORDER BY dt ROWS BETWEEN {frame})")


LIVE = {k: v for k, v in W.COMPOSITE_WEIGHTS.items() if k != "market_breadth"}


@register("composite_intensity", "dt:d intensity_z:f", "mweekly",
          "SELECT dt, z AS intensity_z FROM (" + sql_composite(LIVE, "259 PRECEDING AND CURRENT ROW", "mweekly") + ")")
def composite_intensity(spark, sf):
    return W.composite_intensity(weekly_macro(spark, sf))


cte("intens", "mpanel", sql_composite(
    {k: v for k, v in W.COMPOSITE_WEIGHTS.items() if k != "hy_oas_bps"}, "260 PRECEDING AND 1 PRECEDING", "mpanel", "-"))


@register("intensity_series", "dt:d intensity_z:f", "intens",
          "SELECT dt, CASE WHEN pos <= 4 THEN 0 ELSE z END AS intensity_z FROM intens")
def intensity_series(spark, sf):
    return W.intensity_series(daily_macro_panel(spark, sf))


cte("replay", "mdaily", "SELECT dt, z AS intensity_z FROM (" + sql_composite(
    LIVE, "1260 PRECEDING AND CURRENT ROW", "mdaily", "-") + ") WHERE pos >= 60")


@register("intensity_replay", "dt:d intensity_z:f", "replay", "SELECT * FROM replay")
def intensity_replay(spark, sf):
    return W.intensity_replay(daily_macro(spark, sf))


cte("rlabels", "daymarket", """
SELECT dt, CASE WHEN f < -0.03 THEN 0 WHEN f > 0.03 THEN 2 ELSE 1 END AS label FROM (
 SELECT dt, lead(market_close, 20) OVER (ORDER BY dt) / market_close - 1 AS f FROM daymarket)""")


@register("regime_labels", "dt:d label:i", "rlabels", "SELECT * FROM rlabels")
def regime_labels(spark, sf):
    return W.regime_labels(P.market_series(P.price_panel(spark, sf, "day")))


cte("nonover", "panel", """
SELECT dt FROM (WITH RECURSIVE k AS (SELECT min(dt) AS dt FROM panel
 UNION ALL SELECT (SELECT min(p.dt) FROM panel p WHERE p.dt >= k.dt + 28) FROM k WHERE k.dt IS NOT NULL)
SELECT dt FROM k WHERE dt IS NOT NULL)""")


@register("nonoverlap_rows", "entity:i dt:d close:f", "panel nonover", """
SELECT arg_min(entity, entity) AS entity, dt, arg_min(close, entity) AS close FROM panel WHERE dt IN (SELECT dt FROM nonover) GROUP BY dt""")
def nonoverlap_rows(spark, sf):
    return W.nonoverlap_rows(panel(spark, sf), 28)


@register("top_k_per_group", "entity:i dt:d mom_4:f rn:i", "feat", """
SELECT entity, dt, mom_4, row_number() OVER (PARTITION BY dt ORDER BY round(mom_4, 10) DESC, entity) AS rn FROM feat
WHERE mom_4 IS NOT NULL QUALIFY rn <= 5""")
def top_k(spark, sf):
    rows = features(spark, sf).select("entity", "dt", "mom_4")
    return W.top_k_per_group(rows, ["dt"], "mom_4", 5)


CAP_SHARE = 0.5


@register("recency_cap", "entity:i dt:d close:f", "panel", """
SELECT entity, dt, close FROM panel QUALIFY row_number() OVER (ORDER BY dt DESC, entity DESC) <= (SELECT count(*) // 2 + 1 FROM panel)""")
def recency_cap(spark, sf):
    base = panel(spark, sf).select("entity", "dt", "close")
    return W.recency_cap(base, base.count() // 2 + 1)


def class_rows_source(spark, sf):
    """Market rows for the state classifier: trailing return, breadth, forward label."""
    prices = cut_lineage(P.price_panel(spark, sf))
    market = cut_lineage(P.market_series(prices))
    w = W.Window.orderBy("dt")
    back = market.withColumn("back", F.col("market_close") / F.lag("market_close", 4).over(w) - 1)
    rows = back.join(weekly_breadth(spark, sf, prices).withColumnRenamed("market_breadth", "breadth"), "dt")
    return rows.join(W.regime_labels(market, 4), "dt").where("back IS NOT NULL")
