"""Queries over rank correlations, drift, gates and selection tables."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.columns import by_entity
from panelith.operators import drift as D
from panelith.operators import evaluation as E
from panelith.operators import windows as W
from panelith.plans.base import FEATURES, aligned, aligned_and_market, features, forward, panel, sql_tie_rank
from panelith.plans.registry import cte, register
from panelith.plans.scoring import CLIP, coarse, predictions, residual_score
from panelith.plans.windows import daily_macro
from panelith.session import cut_lineage, discard
from panelith.sources import panel as P

SPECS = ["mom_4", "ret_13", "vs_ma10", "rsi", "stale"]


def bound(spark, sf):
    return P.entity_bound(spark, sf)


# --- rank correlation ------------------------------------------------------------------------

cte("ev", "fwd", """
SELECT entity, dt, sector, mom_1, mom_4, ret_13, vs_ma10, rsi, fwd_ret, lag(mom_4, 8) OVER (PARTITION BY entity ORDER BY dt) AS stale FROM fwd""")


def eval_rows(spark, sf):
    """Features, an old momentum reading without price overlap, and the outcome."""
    # the bars are written once, for the series and for the sectors' benchmark
    bars = cut_lineage(P.price_panel(spark, sf).drop("high", "low"))
    rows = W.forward_return(features(spark, sf, aligned(spark, sf, bars)), 4)
    return rows.select("entity", "dt", "sector", "mom_1", "mom_4", "ret_13", "vs_ma10", "rsi", "fwd_ret",
                       F.lag("mom_4", 8).over(by_entity()).alias("stale"))


def sql_ic(source: str, pred: str, actual: str, keys: str, floor: int = 2, extra: str = "") -> str:
    """SQL text: Spearman per group."""
    group = f"GROUP BY {keys}" if keys else ""
    head = f"{keys}, " if keys else ""
    return f"""SELECT {head}CASE WHEN count(*) >= {floor} AND round(stddev_pop(rp), 10) > 0 AND round(stddev_pop(ra), 10) > 0 THEN corr(rp, ra) END AS ic, count(*) AS n FROM (
 SELECT {head}{sql_tie_rank(pred, keys)} AS rp, {sql_tie_rank(actual, keys)} AS ra FROM {source} WHERE {pred} IS NOT NULL AND {actual} IS NOT NULL {extra}) {group}"""


cte("ics", "ev", f"SELECT * FROM ({sql_ic('ev', 'mom_4', 'fwd_ret', 'dt')}) WHERE ic IS NOT NULL")


@register("ic_series", "dt:d ic:f n:i", "ics", "SELECT * FROM ics")
def ic_series(spark, sf):
    return E.ic_series(forward(spark, sf), "mom_4", "fwd_ret", group_bound=bound(spark, sf))


@register("ic_series_unbounded", "dt:d ic:f n:i", "ics", "SELECT * FROM ics")
def ic_series_unbounded(spark, sf):
    return E.ic_series(forward(spark, sf), "mom_4", "fwd_ret")


# The flagship ranks the normalised feature, so it runs both shuffle axes.
@register("mean_rank_ic", "mean_ic:f n_dates:i", "ics", "SELECT avg(ic) AS mean_ic, count(*) AS n_dates FROM ics")
def mean_rank_ic(spark, sf):
    n = bound(spark, sf)
    rows = forward(spark, sf).where("mom_4 IS NOT NULL").select("entity", "dt", "mom_4", "fwd_ret")
    return E.mean_rank_ic(E.ic_series(W.rank_normalize(rows, ["mom_4"], n), "mom_4", "fwd_ret", group_bound=n))


@register("parity_ic", "baseline_ic:f variant_ic:f n_pairs:i", "ev", """
SELECT corr(ret_13, fwd_ret) AS baseline_ic, corr(mom_4, fwd_ret) AS variant_ic, count(*) AS n_pairs FROM ev WHERE ret_13 IS NOT NULL AND mom_4 IS NOT NULL""")
def parity_ic(spark, sf):
    return E.parity_ic(eval_rows(spark, sf), "ret_13", "mom_4", "fwd_ret")


@register("slice_ic", "sector:i ic:f n:i", "ev", sql_ic("ev", "mom_4", "fwd_ret", "sector", 10))
def slice_ic(spark, sf):
    return E.slice_ic(eval_rows(spark, sf), "mom_4", "sector", "fwd_ret")


@register("cutover_gate", "sector:i baseline_ic:f variant_ic:f n_pairs:i relative_lift:f passed:b reason:s", "ev", """
, g AS (SELECT sector, corr(-ret_13, fwd_ret) AS b, corr(-mom_4, fwd_ret) AS v, count(*) AS n FROM ev WHERE ret_13 IS NOT NULL AND mom_4 IS NOT NULL GROUP BY 1)
SELECT sector, b AS baseline_ic, v AS variant_ic, n AS n_pairs, CASE WHEN n >= 30 AND round(b, 10) > 0 THEN v / b END AS relative_lift,
 n >= 30 AND round(b, 10) > 0 AND v / b >= 1.15 AS passed,
 CASE WHEN n < 30 THEN 'insufficient_data' WHEN round(b, 10) <= 0 THEN 'baseline_below_floor' WHEN v / b >= 1.15 THEN 'pass' ELSE 'lift_below_threshold' END AS reason FROM g""")
def cutover_gate(spark, sf):
    rows = eval_rows(spark, sf).withColumns({"base": -F.col("ret_13"), "variant": -F.col("mom_4")})
    return E.cutover_gate(E.parity_ic(rows, "base", "variant", "fwd_ret", by=["sector"]))


@register("pooled_rank_ic", "ic:f n:i", "ev", sql_ic("ev", "mom_4", "fwd_ret", "", 10))
def pooled_rank_ic(spark, sf):
    return E.pooled_rank_ic(eval_rows(spark, sf), "mom_4", "fwd_ret")


@register("realized_read", "sector:i ic:f n:i n_weeks:i", "ev", f"""
SELECT * FROM ({sql_ic("ev", "mom_4", "fwd_ret", "sector", 10)}) JOIN (
 SELECT sector, count(DISTINCT isoyear(dt) * 100 + weekofyear(dt)) AS n_weeks FROM ev WHERE mom_4 IS NOT NULL GROUP BY 1) USING (sector)""")
def realized_read(spark, sf):
    return E.realized_read(eval_rows(spark, sf), "mom_4", "fwd_ret", ["sector"])


cte("evlong", "ev", "SELECT * FROM (UNPIVOT ev ON mom_4, ret_13, vs_ma10, rsi, stale INTO NAME feature VALUE value)")
cte("fics", "evlong", f"SELECT * FROM ({sql_ic('evlong', 'value', 'fwd_ret', 'feature, dt')}) WHERE ic IS NOT NULL")
cte("fic", "fics", "SELECT feature, avg(ic) AS mean_ic, count(*) AS n_dates FROM fics GROUP BY 1")


def feature_series(spark, sf):
    """A row per feature and date, written once: most readers use it in several branches."""
    return cut_lineage(E.feature_ic_series(eval_rows(spark, sf), SPECS, "fwd_ret", bound(spark, sf)))


@register("feature_ic", "feature:s mean_ic:f n_dates:i", "fic", "SELECT * FROM fic")
def feature_ic(spark, sf):
    return E.feature_ic(eval_rows(spark, sf), SPECS, "fwd_ret", bound(spark, sf))


@register("prune_features", "feature:s mean_ic:f kept:b reason:s", "fic", """
, f AS (SELECT feature, mean_ic, abs(round(mean_ic, 10)) < 0.02 AS weak FROM fic UNION ALL SELECT 'constant', NULL, false)
SELECT feature, mean_ic, NOT weak OR (SELECT bool_and(weak) FROM f) AS kept,
 CASE WHEN mean_ic IS NULL THEN 'ic_unmeasurable' WHEN (SELECT bool_and(weak) FROM f) THEN 'all_below_threshold_prune_skipped' WHEN weak THEN 'below_ic_noise_threshold' ELSE 'above_ic_noise_threshold' END AS reason FROM f""")
def prune_features(spark, sf):
    rows = eval_rows(spark, sf).withColumn("constant", F.lit(1.0))
    names = [*SPECS, "constant"]
    return E.prune_features(E.feature_ic(rows, names, "fwd_ret", bound(spark, sf)), names, 0.02)


cte("dec", "ev", """
SELECT bin, avg(m) AS mean_actual, count(*) AS n_dates FROM (
 SELECT dt, ((r - 1) * 10) // n AS bin, avg(fwd_ret) AS m FROM (
  SELECT dt, fwd_ret, row_number() OVER (PARTITION BY dt ORDER BY round(mom_4, 10), entity) AS r, count(*) OVER (PARTITION BY dt) AS n FROM ev WHERE mom_4 IS NOT NULL)
 WHERE n >= 10 GROUP BY 1, 2) GROUP BY 1""")


def deciles(spark, sf):
    return E.decile_spread(eval_rows(spark, sf), "mom_4", "fwd_ret", group_bound=bound(spark, sf))


@register("decile_spread", "bin:i mean_actual:f n_dates:i", "dec", "SELECT * FROM dec")
def decile_spread(spark, sf):
    return deciles(spark, sf)


@register("decile_summary", "top_minus_bottom:f monotonicity:f share_rising:f n_bins:i", "dec", """
SELECT arg_max(mean_actual, bin) - arg_min(mean_actual, bin) AS top_minus_bottom, corr(bin, r) AS monotonicity, avg(up) AS share_rising, count(*) AS n_bins
FROM (SELECT *, rank() OVER (ORDER BY round(mean_actual, 10)) AS r, CASE WHEN mean_actual > lag(mean_actual) OVER (ORDER BY bin) THEN 1.0 WHEN lag(mean_actual) OVER (ORDER BY bin) IS NOT NULL THEN 0.0 END AS up FROM dec)""")
def decile_summary(spark, sf):
    return E.decile_summary(deciles(spark, sf))


# --- bootstrap -------------------------------------------------------------------------------


def sql_bootstrap(source: str, pred: str, actual: str, n_iter: int, seed: int, key: str) -> str:
    """SQL text: the same integer draws, rows repeated as often as their date is drawn."""
    return f"""
SELECT {key}, count(ic) AS n_usable, quantile_cont(ic, 0.025) AS ci_lo, quantile_cont(ic, 0.975) AS ci_hi, max(nd) AS n_dates FROM (
 SELECT {key}, iter, corr(rp, ra) AS ic, max(nd) AS nd FROM (
  SELECT {key}, iter, nd, {sql_tie_rank(pred, key + ', iter')} AS rp, {sql_tie_rank(actual, key + ', iter')} AS ra FROM (
   SELECT s.{key}, t.iter, t.nd, s.{pred}, s.{actual} FROM (
    SELECT {key}, iter, nd, xor(y, y >> 13) % nd AS i FROM (SELECT {key}, iter, nd, (xor(x, x >> 15) * {E.MIX_B}) % {E.MIX_MOD} AS y FROM (
     SELECT {key}, iter, nd, (((iter * 1000003 + i + {seed}) % {E.MIX_MOD}) * {E.MIX_A}) % {E.MIX_MOD} AS x FROM dts, range({n_iter}) r(iter)))) t
   JOIN dts d ON d.{key} = t.{key} AND d.i = t.i
   JOIN {source} s ON s.{key} = d.{key} AND s.dt = d.dt AND s.{pred} IS NOT NULL AND s.{actual} IS NOT NULL))
 GROUP BY {key}, iter) GROUP BY {key}"""


def sql_dates(source: str, pred: str, actual: str, key: str) -> str:
    return f""", dts AS (SELECT {key}, dt, CAST(row_number() OVER (PARTITION BY {key} ORDER BY dt) - 1 AS BIGINT) AS i, count(*) OVER (PARTITION BY {key}) AS nd
 FROM (SELECT DISTINCT {key}, dt FROM {source} WHERE {pred} IS NOT NULL AND {actual} IS NOT NULL))"""


BOOT = 1000


@register("bootstrap_ic_ci", "sector:i n_usable:i ci_lo:f ci_hi:f n_dates:i", "ev",
          sql_dates("ev", "stale", "fwd_ret", "sector") + sql_bootstrap("ev", "stale", "fwd_ret", BOOT, 42, "sector"))
def bootstrap_ic_ci(spark, sf):
    return E.bootstrap_ic_ci(eval_rows(spark, sf), "stale", "fwd_ret", BOOT, by=["sector"])


HB = [1, 4, 8]
cte("hbrow", "feat market", """
SELECT f.entity, f.dt, f.mom_4 AS pred, CASE WHEN m.r > 0.03 THEN 'bull' WHEN m.r < -0.03 THEN 'bear' ELSE 'neutral' END AS regime, """ + ", ".join(
    f"lead(f.close, {h}) OVER w / f.close - 1 - (lead(f.bench, {h}) OVER w / f.bench - 1) AS fwd_{h}" for h in HB) + """
FROM feat f LEFT JOIN (SELECT dt, market_close / lag(market_close, 4) OVER (ORDER BY dt) - 1 AS r FROM market) m USING (dt)
WINDOW w AS (PARTITION BY f.entity ORDER BY f.dt)""")
cte("hblong", "hbrow", "SELECT entity, dt, pred, regime, CAST(substr(h, 5) AS INTEGER) AS horizon, actual FROM (UNPIVOT hbrow ON fwd_1, fwd_4, fwd_8 INTO NAME h VALUE actual) WHERE pred IS NOT NULL")
HB_SQL = sql_dates("hblong", "pred", "actual", "horizon") + f"""
, ci AS ({sql_bootstrap("hblong", "pred", "actual", BOOT, 42, "horizon")}),
keep AS (""" + " UNION ALL ".join(f"""SELECT {h} AS horizon, dt FROM (WITH RECURSIVE k{h} AS (SELECT min(dt) AS dt FROM hbrow
 UNION ALL SELECT (SELECT min(p.dt) FROM hbrow p WHERE p.dt >= k{h}.dt + {7 * h}) FROM k{h} WHERE k{h}.dt IS NOT NULL) SELECT dt FROM k{h} WHERE dt IS NOT NULL)""" for h in HB) + f"""),
first AS (SELECT dt, min(entity) AS entity FROM hbrow GROUP BY dt),
sparse AS (SELECT k.horizon, l.pred, l.actual FROM keep k JOIN first f USING (dt) JOIN hblong l ON l.dt = f.dt AND l.entity = f.entity AND l.horizon = k.horizon)
SELECT horizon, 'overall' AS scope, ic, n, ci_lo, ci_hi FROM ({sql_ic("hblong", "pred", "actual", "horizon", 100)}) JOIN ci USING (horizon)
UNION ALL SELECT horizon, 'nonoverlap', ic, n, NULL, NULL FROM ({sql_ic("sparse", "pred", "actual", "horizon", 10)})
UNION ALL SELECT horizon, regime, ic, n, NULL, NULL FROM ({sql_ic("hblong", "pred", "actual", "horizon, regime", 30)})"""


@register("horizon_battery", "horizon:i scope:s ic:f n:i ci_lo:f ci_hi:f", "hblong", HB_SQL)
def horizon_battery(spark, sf):
    base, market = aligned_and_market(spark, sf)
    rows = W.multi_horizon_returns(features(spark, sf, base), HB)
    w = W.Window.orderBy("dt")
    market = market.select(
        "dt", X.classify_regime(F.col("market_close") / F.lag("market_close", 4).over(w) - 1).alias("regime"))
    # a row per date
    rows = rows.join(F.broadcast(market), "dt", "left").withColumnRenamed("mom_4", "pred")
    rows = cut_lineage(rows.select("entity", "dt", "pred", "regime", *[f"fwd_{h}" for h in HB]))
    discard(base)
    return E.horizon_battery(rows, "pred", HB, "regime", BOOT, {h: 7 * h for h in HB}, staged=True)


# --- series statistics -----------------------------------------------------------------------


@register("downside_stats", "feature:s n:i n_downside:i mean_ic:f downside_deviation:f sortino:f cvar:f frac_negative:f worst:f passes:b", "fics", """
SELECT *, n >= 5 AND (CASE WHEN sortino IS NULL THEN mean_ic > 0 ELSE sortino >= 0 END) AS passes FROM (
 SELECT feature, count(*) AS n, count(CASE WHEN ic < 0 THEN 1 END) AS n_downside, avg(ic) AS mean_ic, coalesce(sqrt(avg(CASE WHEN ic < 0 THEN ic * ic END)), 0) AS downside_deviation,
  CASE WHEN sqrt(avg(CASE WHEN ic < 0 THEN ic * ic END)) > 1e-12 THEN avg(ic) / sqrt(avg(CASE WHEN ic < 0 THEN ic * ic END)) END AS sortino,
  avg(CASE WHEN r <= greatest(1, ceil(k * 0.05)) THEN ic END) AS cvar, avg(CASE WHEN ic < 0 THEN 1.0 ELSE 0.0 END) AS frac_negative, min(ic) AS worst
 FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY ic) AS r, count(*) OVER (PARTITION BY feature) AS k FROM fics) GROUP BY feature)""")
def downside_stats(spark, sf):
    return E.downside_stats(feature_series(spark, sf), by=["feature"])


cte("mom", "fics", """
SELECT feature, n, m AS mean, sqrt(m2 * n / (n - 1)) AS std, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurt FROM (
 SELECT feature, count(*) AS n, any_value(mu) AS m, avg(pow(ic - mu, 2)) AS m2, avg(pow(ic - mu, 3)) AS m3, avg(pow(ic - mu, 4)) AS m4
 FROM (SELECT *, avg(ic) OVER (PARTITION BY feature) AS mu FROM fics) GROUP BY feature)""")


@register("series_moments", "feature:s n:i mean:f std:f skew:f kurt:f", "mom", "SELECT * FROM mom")
def series_moments(spark, sf):
    return E.series_moments(feature_series(spark, sf), by=["feature"])


def sql_phi(z: str) -> str:
    """SQL text: normal distribution function by its power series, saturated beyond eight."""
    return (f"CASE WHEN {z} < -8 THEN 0.0 WHEN {z} > 8 THEN 1.0 ELSE 0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 150), "
            f"lambda k: sign({z}) * exp((2 * k + 1) * ln(greatest(abs({z}), 1e-300)) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi())))) END")


TRIALS, N_EFF = 12, 60
_inv = NormalDist().inv_cdf
_STAR = (1 - E.EULER_GAMMA) * _inv(1 - 1 / TRIALS) + E.EULER_GAMMA * _inv(1 - 1 / (TRIALS * math.e))


@register("deflated_sharpe", "feature:s n:i n_used:i ic_ir:f sr_benchmark:f psr_vs_zero:f dsr:f ir_needed:f status:s passes:b", "mom", f"""
, s AS (SELECT *, greatest(2, least({N_EFF}, n)) AS n_used, mean / std AS sr FROM mom),
z AS (SELECT *, {_STAR!r}::DOUBLE / sqrt(n_used) AS star, sqrt(n_used - 1) / sqrt(1 - skew * sr + (kurt - 1) / 4 * sr * sr) AS wd FROM s),
q AS (SELECT *, sr * wd AS z0, (sr - star) * wd AS z1 FROM z)
SELECT feature, n, n_used, sr AS ic_ir, star AS sr_benchmark, {sql_phi('z0')} AS psr_vs_zero, {sql_phi('z1')} AS dsr, {_inv(0.95)!r}::DOUBLE / sqrt(n_used - 1) AS ir_needed,
 'ok' AS status, ({sql_phi('z1')}) >= 0.95 AS passes FROM q""")
def deflated_sharpe(spark, sf):
    moments = E.series_moments(feature_series(spark, sf), by=["feature"])
    return E.deflated_sharpe(moments, TRIALS, N_EFF)


@register("selection_pbo", "pbo:f mean_logit:f n_splits:i n_specs:i", "fics", """
, t AS (SELECT feature, count(*) AS t FROM fics GROUP BY 1), md AS (SELECT t FROM t GROUP BY t ORDER BY count(*) DESC, t DESC LIMIT 1),
b AS (SELECT feature, blk, sum(ic) AS s, count(*) AS c FROM (SELECT f.feature, f.ic, ((row_number() OVER (PARTITION BY f.feature ORDER BY dt) - 1) * 8) // t.t AS blk FROM fics f JOIN t USING (feature) WHERE t.t = (SELECT t FROM md)) GROUP BY 1, 2),
sc AS (SELECT sp, feature, round(sum(CASE WHEN (sp >> blk) & 1 = 1 THEN s END) / sum(CASE WHEN (sp >> blk) & 1 = 1 THEN c END), 10) AS i,
  round(sum(CASE WHEN (sp >> blk) & 1 = 0 THEN s END) / sum(CASE WHEN (sp >> blk) & 1 = 0 THEN c END), 10) AS o FROM b, range(256) r(sp) WHERE bit_count(sp) = 4 GROUP BY 1, 2),
w AS (SELECT sp, row_number() OVER (PARTITION BY sp ORDER BY i DESC, feature) AS best, rank() OVER (PARTITION BY sp ORDER BY o) AS r, count(*) OVER (PARTITION BY sp) AS n FROM sc)
SELECT avg(CASE WHEN l <= 0 THEN 1.0 ELSE 0.0 END) AS pbo, avg(l) AS mean_logit, count(*) AS n_splits, max(n) AS n_specs FROM (
 SELECT ln((r / (n + 1.0::DOUBLE)) / (1 - r / (n + 1.0::DOUBLE))) AS l, n FROM w WHERE best = 1)""")
def selection_pbo(spark, sf):
    return E.selection_pbo(feature_series(spark, sf), "feature")


@register("champion_monitor", "ic:f n:i n_weeks:i chasing_noise:b reason:s", "ev", f"""
SELECT *, round(ic, 10) <= 0 AS chasing_noise, CASE WHEN round(ic, 10) <= 0 THEN 'noise_watch' ELSE 'healthy' END AS reason FROM ({sql_ic("ev", "mom_4", "fwd_ret", "", 10)}),
 (SELECT count(DISTINCT isoyear(dt) * 100 + weekofyear(dt)) AS n_weeks FROM ev WHERE mom_4 IS NOT NULL)""")
def champion_monitor(spark, sf):
    return E.champion_monitor(E.realized_read(eval_rows(spark, sf), "mom_4", "fwd_ret"))


@register("challenger_leaderboard", "feature:s ic:f n:i n_weeks:i beats_champion:b ready:b reason:s place:i", "evlong", f"""
, r AS (SELECT * FROM ({sql_ic("evlong", "value", "fwd_ret", "feature", 10)}) JOIN (SELECT feature, count(DISTINCT isoyear(dt) * 100 + weekofyear(dt)) AS n_weeks FROM evlong GROUP BY 1) USING (feature)),
j AS (SELECT *, round(ic, 10) >= round((SELECT ic FROM r WHERE feature = 'mom_4'), 10) AS beats FROM r WHERE feature <> 'mom_4')
SELECT feature, ic, n, n_weeks, beats AS beats_champion, beats AND n_weeks >= 4 AND n >= 20 AS ready,
 CASE WHEN ic IS NULL THEN 'insufficient_outcomes' WHEN n_weeks < 4 OR n < 20 THEN 'soak_too_young' WHEN NOT beats THEN 'below_champion' ELSE 'ready' END AS reason,
 row_number() OVER (ORDER BY (beats AND n_weeks >= 4 AND n >= 20) DESC, round(ic, 10) DESC, feature) AS place FROM j""")
def challenger_leaderboard(spark, sf):
    reads = cut_lineage(E.realized_reads(eval_rows(spark, sf), SPECS, "fwd_ret"))
    champion = reads.where("feature = 'mom_4'")
    return E.challenger_leaderboard(reads.where("feature <> 'mom_4'"), champion, version="feature")


# --- classification, calibration -------------------------------------------------------------

cte("cls", "market", """
SELECT * FROM (SELECT dt, CASE WHEN f < -0.03 THEN 0 WHEN f > 0.03 THEN 2 ELSE 1 END AS truth, CASE WHEN b < -0.03 THEN 0 WHEN b > 0.03 THEN 2 ELSE 1 END AS pred, b FROM (
 SELECT dt, lead(market_close, 4) OVER (ORDER BY dt) / market_close - 1 AS f, market_close / lag(market_close, 4) OVER (ORDER BY dt) - 1 AS b FROM market)) WHERE b IS NOT NULL""")


def class_rows(spark, sf):
    """Forward market label against the label of the trailing return."""
    market = P.market_series(panel(spark, sf))
    w = W.Window.orderBy("dt")
    back = F.col("market_close") / F.lag("market_close", 4).over(w) - 1
    rows = market.withColumn("b", back).join(W.regime_labels(market, 4).withColumnRenamed("label", "truth"), "dt")
    return rows.where("b IS NOT NULL").withColumn("pred", F.when(F.col("b") < -0.03, 0).when(F.col("b") > 0.03, 2).otherwise(1))


@register("classification_metrics", "class:i support:i predicted:i hits:i precision:f recall:f f1:f macro_f1:f accuracy:f", "cls", """
, m AS (SELECT c AS class, (SELECT count(*) FROM cls WHERE truth = c) AS support, (SELECT count(*) FROM cls WHERE pred = c) AS predicted, (SELECT count(*) FROM cls WHERE truth = c AND pred = c) AS hits FROM range(3) r(c)),
p AS (SELECT *, coalesce(hits / nullif(predicted, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall FROM m),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p)
SELECT *, avg(f1) OVER () AS macro_f1, sum(hits) OVER () / (sum(support) OVER ())::DOUBLE AS accuracy FROM f""")
def classification_metrics(spark, sf):
    return E.classification_metrics(class_rows(spark, sf), "truth", "pred", [0, 1, 2])


@register("confusion_matrix", "truth:i pred:i n:i", "cls", """
SELECT x.i AS truth, y.j AS pred, count(c.dt) AS n FROM range(3) x(i) CROSS JOIN range(3) y(j) LEFT JOIN cls c ON c.truth = x.i AND c.pred = y.j GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return E.confusion_matrix(class_rows(spark, sf), "truth", "pred", [0, 1, 2])


@register("ece", "ece:f n:i", "pred fwd", """
SELECT sum(n * abs(p - y)) / sum(n) AS ece, sum(n) AS n FROM (
 SELECT least(floor(p_up * 10), 9) AS b, count(*) AS n, avg(p_up) AS p, avg(CASE WHEN round(fwd_ret, 10) >= 0 THEN 1.0 ELSE 0.0 END) AS y
 FROM pred JOIN fwd USING (entity, dt) GROUP BY 1)""")
def ece(spark, sf):
    rows = W.forward_return(predictions(spark, sf), 4)
    return E.ece(rows.withColumn("y", (F.round("fwd_ret", 10) >= 0).cast("double")), "p_up", "y")


# --- drift -----------------------------------------------------------------------------------

SPLIT = "1999-01-01"
cte("trainlong", "feat", f"SELECT * FROM (UNPIVOT (SELECT entity, dt, {', '.join(FEATURES)} FROM feat) ON {', '.join(FEATURES)} INTO NAME feature VALUE value)")
cte("ref", "trainlong", f"""
, """.strip(", \n") + f"""SELECT feature, pos AS position, round(value, 6) AS value, n, mean, std FROM (
 SELECT *, CASE WHEN n > 2000 THEN (p * 1999 + n - 2) // (n - 1) ELSE p END AS pos FROM (
  SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY dt, entity) - 1 AS p, count(*) OVER (PARTITION BY feature) AS n,
   avg(value) OVER (PARTITION BY feature) AS mean, stddev_pop(value) OVER (PARTITION BY feature) AS std FROM trainlong WHERE dt < DATE '{SPLIT}'))
WHERE n <= 2000 OR (pos * (n - 1)) // 1999 = p""")


def train_rows(spark, sf):
    return features(spark, sf).where(F.col("dt") < SPLIT).select("entity", "dt", *FEATURES)


def late_rows(spark, sf):
    return features(spark, sf).where(F.col("dt") >= SPLIT).select("entity", "dt", *FEATURES)


@register("drift_reference", "feature:s position:i value:f n:i mean:f std:f", "ref", "SELECT * FROM ref")
def drift_reference(spark, sf):
    return D.drift_reference(train_rows(spark, sf), FEATURES, 2000, bound(spark, sf))


cte("ks", "trainlong", f"""
SELECT feature, max(abs(fr - fc)) AS ks, max(nr) AS n_ref, max(nc) AS n_cur FROM (
 SELECT *, sum(r) OVER (PARTITION BY feature ORDER BY value)::DOUBLE / nr AS fr, sum(1 - r) OVER (PARTITION BY feature ORDER BY value)::DOUBLE / nc AS fc FROM (
  SELECT *, sum(r) OVER (PARTITION BY feature) AS nr, sum(1 - r) OVER (PARTITION BY feature) AS nc FROM (
   SELECT feature, round(value, 6) AS value, 1 AS r FROM trainlong WHERE dt < DATE '{SPLIT}' UNION ALL SELECT feature, round(value, 6), 0 FROM trainlong WHERE dt >= DATE '{SPLIT}'))) GROUP BY 1""")


def ks(spark, sf):
    """All training values against all later ones, to six decimals."""
    sides = [
        E.long_features(rows, FEATURES, ["entity", "dt"]).withColumn("value", F.round("value", 6))
        for rows in (train_rows(spark, sf), late_rows(spark, sf))
    ]
    return D.ks_drift(*sides)


@register("ks_drift", "feature:s ks:f n_ref:i n_cur:i", "ks", "SELECT * FROM ks")
def ks_drift(spark, sf):
    return ks(spark, sf)


@register("ks_summary", "max_ks:f mean_ks:f n_features:i", "ks", "SELECT max(ks) AS max_ks, avg(ks) AS mean_ks, count(*) AS n_features FROM ks")
def ks_summary(spark, sf):
    return D.ks_summary(ks(spark, sf))


DRIFTED = ["close", "bench", "notional", "mom_4", "shift"]


@register("feature_drift", "feature:s z:f place:i n_drifted:i severity:s", "feat", f"""
, l AS (SELECT * FROM (UNPIVOT (SELECT dt, close, bench, notional, mom_4, notional * (1 + 9 * CAST(dt >= DATE '{SPLIT}' AS INTEGER)) AS shift FROM feat) ON close, bench, notional, mom_4, shift INTO NAME feature VALUE value)),
z AS (SELECT feature, abs(avg(value) FILTER (WHERE dt >= DATE '{SPLIT}') - avg(value) FILTER (WHERE dt < DATE '{SPLIT}')) / stddev_pop(value) FILTER (WHERE dt < DATE '{SPLIT}') AS z FROM l GROUP BY 1)
SELECT feature, round(z, 2) AS z, row_number() OVER (ORDER BY round(z, 2) DESC, feature) AS place, count(*) OVER () AS n_drifted, CASE WHEN max(round(z, 2)) OVER () >= 5 THEN 'CRITICAL' ELSE 'WARN' END AS severity
FROM z WHERE z > 3 QUALIFY place <= 5""")
def feature_drift(spark, sf):
    late = (F.col("dt") >= SPLIT).cast("int")
    rows = features(spark, sf).withColumn("shift", F.col("notional") * (1 + 9 * late))
    return D.feature_drift(rows.where(F.col("dt") < SPLIT), rows.where(F.col("dt") >= SPLIT), DRIFTED)


cte("pdays", "coarse", """
SELECT dt, count(*) AS n, greatest(sum(CASE WHEN q >= 0.5 THEN 1 ELSE 0 END), sum(CASE WHEN q < 0.5 THEN 1 ELSE 0 END))::DOUBLE / count(*) AS share,
 avg(round(abs(q - 0.5) * 2, 4)) AS conf, stddev_pop(predicted_alpha) AS sd FROM coarse GROUP BY dt""")


@register("prediction_days", "dt:d n:i dominant_share:f mean_confidence:f alpha_std:f", "pdays",
          "SELECT dt, n, share AS dominant_share, conf AS mean_confidence, sd AS alpha_std FROM pdays")
def prediction_days(spark, sf):
    return D.prediction_days(coarse(spark, sf))


DRIFT_DAY = "1998-06-15"


@register("prediction_drift", "code:s severity:s value:f", "pdays", f"""
, d AS (SELECT *, row_number() OVER (ORDER BY dt DESC) AS k FROM pdays WHERE dt <= DATE '{DRIFT_DAY}' AND dt > DATE '{DRIFT_DAY}' - 42 QUALIFY k <= 5),
f AS (SELECT count(*) AS nd, max(CASE WHEN k = 1 THEN share END) AS share, max(CASE WHEN k = 1 THEN conf END) AS conf, max(CASE WHEN k = 1 THEN sd END) AS sd,
  sum(CASE WHEN round(share, 10) > 0.8 AND k <= 3 THEN 1 ELSE 0 END) AS nc, sum(CASE WHEN round(conf, 10) < 0.45 THEN 1 ELSE 0 END) AS nl FROM d)
SELECT 'no_recent_predictions' AS code, 'CRITICAL' AS severity, 0.0 AS value FROM f WHERE nd = 0
UNION ALL SELECT 'direction_clustering', 'WARN', share FROM f WHERE round(share, 10) > 0.8
UNION ALL SELECT 'persistent_direction_clustering', 'CRITICAL', nc FROM f WHERE nc >= 3
UNION ALL SELECT 'confidence_collapse', CASE WHEN (NOT (nd >= 3 AND nl >= 3) AND nd >= 2 AND nl = 1) OR round(conf, 10) < 0.225 THEN 'CRITICAL' ELSE 'WARN' END, conf FROM f WHERE round(conf, 10) < 0.45
UNION ALL SELECT 'alpha_degeneration', 'CRITICAL', sd FROM f WHERE round(sd, 12) < 0.001
UNION ALL SELECT 'feature_drift', 'INFO', NULL""")
def prediction_drift(spark, sf):
    none = spark.createDataFrame([], "check string")
    return D.prediction_drift(coarse(spark, sf), DRIFT_DAY, none, look_back=42)


# --- gates -----------------------------------------------------------------------------------

GATE_COLS = "n:i n_unique:i modal_fraction:f saturation_rate:f std:f direction_skew:f n_up:i n_down:i failed_check:s passed:b"


def sql_gate(source: str, p: str, direction: str, key: str, floor: int = 5) -> str:
    return f"""
SELECT *, failed_check IS NULL AS passed FROM (SELECT *, CASE WHEN n < {floor} THEN NULL WHEN n_unique < 8 AND modal_fraction >= 0.5 THEN 'unique_p_up' WHEN saturation_rate > 0.25 THEN 'saturation_rate'
  WHEN round(std, 9) < 0.005 THEN 'stdev' WHEN direction_skew > 0.85 THEN 'direction_skew' END AS failed_check FROM (
 SELECT {key}, sum(c) AS n, count(*) AS n_unique, max(c) / sum(c)::DOUBLE AS modal_fraction, sum(sat) / sum(c)::DOUBLE AS saturation_rate, max(sd) AS std,
  coalesce(greatest(sum(u), sum(d)) / nullif(sum(u) + sum(d), 0)::DOUBLE, 0) AS direction_skew, sum(u) AS n_up, sum(d) AS n_down FROM (
  SELECT {key}, round({p}, 6) AS v, any_value(sd) AS sd, count(*) AS c, sum(CASE WHEN {p} <= 0.011 OR {p} >= 0.989 THEN 1 ELSE 0 END) AS sat,
   sum(CASE WHEN {direction} = 'UP' THEN 1 ELSE 0 END) AS u, sum(CASE WHEN {direction} = 'DOWN' THEN 1 ELSE 0 END) AS d
  FROM (SELECT *, stddev_pop({p}) OVER (PARTITION BY {key}) AS sd FROM {source}) GROUP BY {key}, v) GROUP BY {key}))"""


@register("distribution_gate", "dt:d " + GATE_COLS, "pred", sql_gate("pred", "p_up", "predicted_direction", "dt"))
def distribution_gate(spark, sf):
    return D.distribution_gate(predictions(spark, sf), ["dt"])


@register("distribution_gate_coarse", "dt:d " + GATE_COLS, "coarse",
          sql_gate("(SELECT *, CASE WHEN q >= 0.5 THEN 'UP' ELSE 'DOWN' END AS qd FROM coarse)", "q", "qd", "dt"))
def distribution_gate_coarse(spark, sf):
    return D.distribution_gate(coarse(spark, sf), ["dt"])


@register("stratified_gate", "regime:s n:i modal_fraction:f std:f direction_skew:f evaluated:b failed_check:s passed:b", "pred hbrow", f"""
SELECT regime, n, modal_fraction, std, direction_skew, n >= 25 AS evaluated, CASE WHEN n >= 25 THEN failed_check END AS failed_check, n < 25 OR passed AS passed FROM (
{sql_gate("(SELECT p.*, h.regime FROM pred p JOIN hbrow h USING (entity, dt))", "p_up", "predicted_direction", "regime", 1)})""")
def stratified_gate(spark, sf):
    market = P.market_series(panel(spark, sf))
    w = W.Window.orderBy("dt")
    regimes = market.select("dt", X.classify_regime(F.col("market_close") / F.lag("market_close", 4).over(w) - 1).alias("regime"))
    return D.stratified_gate(predictions(spark, sf).join(regimes, "dt"))


@register("health_gate", "dt:d n:i n_present:i n_finite:i n_unique_alpha:i nonfinite_rate:f alpha_modal_fraction:f sign_skew:f saturation_rate:f failed_check:s passed:b", "feat", f"""
, b AS (SELECT dt, mom_4, ret_13, CASE WHEN mom_4 IS NOT NULL THEN least({CLIP}, greatest(-{CLIP}, -0.1 * mom_4)) END AS al FROM feat),
h AS (SELECT dt, mom_4 IS NOT NULL AS present, CASE WHEN ret_13 IS NOT NULL THEN al END AS g, round(0.5 + al / {2 * CLIP}, 4) AS p FROM b),
a AS (SELECT dt, count(*) AS n, sum(present::INT) AS n_present, count(g) AS n_finite, sum(CASE WHEN present AND g IS NULL THEN 1 ELSE 0 END) AS nb, count(DISTINCT round(g, 9)) AS n_unique_alpha,
  sum(CASE WHEN g > 0 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN g < 0 THEN 1 ELSE 0 END) AS nn, count(p) AS pc, sum(CASE WHEN p <= 0.011 OR p >= 0.989 THEN 1 ELSE 0 END) AS sat FROM h GROUP BY dt),
m AS (SELECT dt, max(c) AS mc FROM (SELECT dt, round(g, 9) AS v, count(*) AS c FROM h WHERE g IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT a.*, coalesce(nb / nullif(n_present, 0)::DOUBLE, 0) AS nonfinite_rate, coalesce(mc / nullif(n_finite, 0)::DOUBLE, 0) AS alpha_modal_fraction, coalesce(greatest(np, nn) / nullif(np + nn, 0)::DOUBLE, 0) AS sign_skew,
  coalesce(sat / nullif(pc, 0)::DOUBLE, 0) AS saturation_rate FROM a LEFT JOIN m USING (dt))
SELECT *, failed_check IS NULL AS passed FROM (SELECT *, CASE WHEN n < 5 THEN NULL WHEN n_present >= 5 AND nonfinite_rate > 0.2 THEN 'alpha_nonfinite_rate' WHEN n_finite >= 5 AND alpha_modal_fraction >= 0.9 THEN 'alpha_collapse'
 WHEN n_finite >= 5 AND sign_skew >= 0.97 THEN 'alpha_sign_skew' WHEN pc >= 5 AND saturation_rate > 0.25 THEN 'saturation_rate' END AS failed_check FROM r)""")
def health_gate(spark, sf):
    # a model that needs the 13-week return emits NaN without it
    rows = features(spark, sf).withColumn("alpha", X.clip_col(-0.1 * F.col("mom_4"), CLIP))
    rows = rows.withColumns(X.to_probability(F.col("alpha"), CLIP))
    broken = F.col("alpha").isNotNull() & F.col("ret_13").isNull()
    rows = rows.withColumn("predicted_alpha", F.when(broken, F.lit(float("nan"))).otherwise(F.col("alpha")))
    return D.health_gate(rows, ["dt"])


@register("subsample_gate", "sector:i n:i component_ic:f baseline_ic:f passed:b skipped:b", "fwd momsc", """
SELECT sector, n, CASE WHEN n < 30 THEN 0 ELSE c END AS component_ic, CASE WHEN n < 30 THEN 0 ELSE b END AS baseline_ic, n < 30 OR round(c, 10) >= round(b, 10) AS passed, n < 30 AS skipped FROM (
 SELECT sector, count(*) AS n, corr(-momentum_score, fwd_ret) AS c, corr(-coalesce(mom_1, 0), fwd_ret) AS b FROM fwd JOIN momsc USING (entity, dt)
 WHERE ret_13 IS NULL OR rsi IS NULL OR mom_4 IS NULL OR mom_1 IS NULL OR vs_ma10 IS NULL GROUP BY 1)""")
def subsample_gate(spark, sf):
    rows = forward(spark, sf).withColumns({
        "component": -X.momentum_score("mom_1", "mom_4", "vs_ma10", "rsi"), "baseline": -X.neutral("mom_1"),
        "short": X.short_history_mask(FEATURES)})
    return D.subsample_gate(rows, "component", "baseline", "fwd_ret", "short", by=["sector"])


# --- history tables --------------------------------------------------------------------------


@register("sample_shift", "component:i dt:d n:i prior_n:f pct_change:f warn:b", "ev", """
SELECT *, (n - prior_n) / prior_n::DOUBLE * 100 AS pct_change, coalesce(abs(round((n - prior_n) / prior_n::DOUBLE * 100, 10)) > 30, false) AS warn FROM (
 SELECT *, lag(n) OVER (PARTITION BY component ORDER BY dt) AS prior_n FROM (
  SELECT sector AS component, CAST(date_trunc('quarter', dt) AS DATE) AS dt, count(*) AS n FROM ev GROUP BY 1, 2))""")
def sample_shift(spark, sf):
    counts = forward(spark, sf).groupBy(F.col("sector").alias("component"), F.to_date(F.date_trunc("quarter", "dt")).alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    return E.sample_shift(counts)


cte("hist", "fics", """
SELECT q AS dt, max(CASE WHEN feature = 'mom_4' THEN ic END) AS mom_4_ic, max(CASE WHEN feature = 'ret_13' THEN ic END) AS ret_13_ic, max(CASE WHEN feature = 'stale' THEN ic END) AS stale_ic FROM (
 SELECT feature, CAST(date_trunc('quarter', dt) AS DATE) AS q, avg(ic) AS ic FROM fics GROUP BY 1, 2) GROUP BY 1""")
MODES = ["mom_4", "ret_13", "stale"]


def quarter_ics(spark, sf):
    return feature_series(spark, sf).groupBy("feature", F.to_date(F.date_trunc("quarter", "dt")).alias("q")).agg(
        F.avg("ic").alias("ic"), F.max("dt").alias("last_dt"), F.count(F.lit(1)).alias("n"))


@register("mode_summary", "mode:s wins:i n:i mean_ic:f mean_delta:f win_share:f", "hist", """
, b AS (SELECT *, CASE WHEN round(coalesce(mom_4_ic, -9), 10) >= greatest(round(coalesce(ret_13_ic, -9), 10), round(coalesce(stale_ic, -9), 10)) THEN 'mom_4'
  WHEN round(coalesce(ret_13_ic, -9), 10) >= round(coalesce(stale_ic, -9), 10) THEN 'ret_13' ELSE 'stale' END AS best FROM hist),
l AS (SELECT 'mom_4' AS mode, best, mom_4_ic AS ic, mom_4_ic AS base FROM b UNION ALL SELECT 'ret_13', best, ret_13_ic, mom_4_ic FROM b UNION ALL SELECT 'stale', best, stale_ic, mom_4_ic FROM b)
SELECT mode, sum((mode = best)::INT) AS wins, count(ic) AS n, avg(ic) AS mean_ic, avg(ic - base) AS mean_delta, sum((mode = best)::INT) / (SELECT count(*) FROM b)::DOUBLE AS win_share FROM l GROUP BY 1""")
def mode_summary(spark, sf):
    wide = quarter_ics(spark, sf).groupBy("q").pivot("feature", MODES).agg(F.first("ic")).withColumnRenamed("q", "dt")
    wide = wide.select("dt", *[F.col(m).alias(f"{m}_ic") for m in MODES])
    v = {m: F.coalesce(F.round(f"{m}_ic", 10), F.lit(-9.0)) for m in MODES}
    best = F.when(v["mom_4"] >= F.greatest(v["ret_13"], v["stale"]), "mom_4").when(v["ret_13"] >= v["stale"], "ret_13").otherwise("stale")
    return E.mode_summary(wide.withColumn("best_mode", best), MODES, "mom_4")


@register("feature_fold_ic", "feature:s median_pearson:f pearson_q25:f pearson_q75:f pct_positive_pearson:f median_spearman:f spearman_q25:f spearman_q75:f pct_positive_spearman:f n_folds:i", "evlong", f"""
, y AS (SELECT *, year(dt) AS fold FROM evlong),
s AS ({sql_ic("y", "value", "fwd_ret", "feature, fold", 100)}),
p AS (SELECT feature, fold, corr(value, fwd_ret) AS p FROM y GROUP BY 1, 2 HAVING count(*) >= 100)
SELECT feature, median(p) AS median_pearson, quantile_cont(p, 0.25) AS pearson_q25, quantile_cont(p, 0.75) AS pearson_q75, avg(CASE WHEN p > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_positive_pearson,
 median(ic) AS median_spearman, quantile_cont(ic, 0.25) AS spearman_q25, quantile_cont(ic, 0.75) AS spearman_q75, avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0.0 END) * 100 AS pct_positive_spearman, count(*) AS n_folds
FROM p JOIN s USING (feature, fold) GROUP BY 1""")
def feature_fold_ic(spark, sf):
    return E.feature_fold_ic(eval_rows(spark, sf).withColumn("fold", F.year("dt")), SPECS, "fwd_ret")


@register("feature_correlation", "a:s b:s corr:f", "ev", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM ev" for a in SPECS for b in SPECS))
def feature_correlation(spark, sf):
    return E.feature_correlation(eval_rows(spark, sf), SPECS)


cte("tv", "fics", f"""
SELECT feature, avg(CASE WHEN dt < DATE '{SPLIT}' THEN ic END) AS train_ic, avg(CASE WHEN dt >= DATE '{SPLIT}' THEN ic END) AS val_ic FROM fics GROUP BY 1""")


@register("overfit_signal", "feature:s train_ic:f val_ic:f ic_ratio:f overfit:b", "tv", """
SELECT *, CASE WHEN round(abs(val_ic), 10) >= 1e-3 THEN train_ic / abs(val_ic) END AS ic_ratio, coalesce(CASE WHEN round(abs(val_ic), 10) >= 1e-3 THEN train_ic / abs(val_ic) END > 3, false) AS overfit FROM tv""")
def overfit_signal(spark, sf):
    ic, early = F.col("ic"), F.col("dt") < SPLIT
    ics = feature_series(spark, sf).groupBy("feature").agg(
        F.avg(F.when(early, ic)).alias("train_ic"), F.avg(F.when(~early, ic)).alias("val_ic"))
    return E.overfit_signal(ics)


# Version catalogue: every feature spec registers a version per quarter with its mean IC.
cte("vers", "fics", """
SELECT feature AS model_version, feature || '-' || CAST(q AS VARCHAR) AS version_id, q AS dt, created, ic AS mean_ic, n FROM (
 SELECT feature, CAST(date_trunc('quarter', dt) AS DATE) AS q, max(dt) AS created, avg(ic) AS ic, count(*) AS n FROM fics GROUP BY 1, 2)""")
SPEC_TABLE = [("s1", "mom_4", "active", 0), ("s2", "ret_13", "active", 5), ("s3", "vs_ma10", "active", 1),
              ("s4", "rsi", "retired", 9), ("s5", "stale", "active", 0), ("s6", "never", "active", 3)]
SPEC_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {d})" for a, b, c, d in SPEC_TABLE) + ") s(id, model_version, status, priority)"


def versions(spark, sf):
    return quarter_ics(spark, sf).select(
        F.col("feature").alias("model_version"), F.concat_ws("-", "feature", F.col("q").cast("string")).alias("version_id"),
        F.col("q").alias("dt"), F.col("last_dt").alias("created"), F.col("ic").alias("mean_ic"), "n")


def specs(spark):
    return spark.createDataFrame(SPEC_TABLE, "id string, model_version string, status string, priority int")


@register("rotation_order", "id:s model_version:s last_dt:d priority:i", "vers", f"""
SELECT s.id, s.model_version, v.last_dt, s.priority FROM {SPEC_SQL} LEFT JOIN (SELECT model_version, max(dt) AS last_dt FROM vers GROUP BY 1) v USING (model_version)
WHERE s.status = 'active' ORDER BY last_dt ASC NULLS FIRST, priority DESC, id LIMIT 3""")
def rotation_order(spark, sf):
    return E.rotation_order(specs(spark), versions(spark, sf), 3)


@register("append_trials", "version_id:s model_version:s is_new:b n_trials:i", "vers", """
SELECT version_id, model_version, dt >= DATE '1999-01-01' AS is_new, (SELECT count(*) FROM vers) AS n_trials FROM vers""")
def append_trials(spark, sf):
    rows = versions(spark, sf).select("version_id", "model_version", "dt")
    ledger = rows.where(F.col("dt") < "1999-01-01").drop("dt")
    return E.append_trials(ledger, rows.where(F.col("dt") >= "1998-07-01").drop("dt"))


@register("candidate_pool", "spec_id:s model_version:s version_id:s present:b", "vers", f"""
SELECT s.id AS spec_id, s.model_version, CASE WHEN s.model_version = 'ret_13' THEN coalesce(t.version_id, a.version_id) ELSE t.version_id END AS version_id,
 CASE WHEN s.model_version = 'ret_13' THEN coalesce(t.version_id, a.version_id) ELSE t.version_id END IS NOT NULL AS present
FROM {SPEC_SQL} LEFT JOIN (SELECT model_version, version_id FROM vers WHERE dt = DATE '2001-10-01') t USING (model_version)
LEFT JOIN (SELECT model_version, arg_max(version_id, dt) AS version_id FROM vers GROUP BY 1) a USING (model_version)""")
def candidate_pool(spark, sf):
    return E.candidate_pool(specs(spark), versions(spark, sf), "2001-10-01", "ret_13")


@register("select_winner", "spec_id:s version_id:s mean_ic:f baseline_ic:f baseline_source:s reason:s winner_version_id:s refresh_version_id:s", "fic", """
, c AS (SELECT feature AS spec_id, 'v-' || feature AS version_id, CASE WHEN feature = 'rsi' THEN 5 ELSE 21 END AS fwd, -mean_ic AS ic FROM fic),
b AS (SELECT ic AS base FROM c WHERE spec_id = 'ret_13'),
r AS (SELECT *, CASE WHEN spec_id = 'ret_13' THEN 'champion_arch_baseline' WHEN fwd <> 21 THEN 'non_canonical_horizon' WHEN ic IS NULL THEN 'no_cpcv' WHEN round(ic, 10) <= 0.01 THEN 'below_floor'
  WHEN round(ic, 10) < round(base + 0.005, 10) THEN 'below_champion_arch_plus_margin' ELSE 'eligible' END AS reason FROM c, b)
SELECT spec_id, version_id, ic AS mean_ic, base AS baseline_ic, 'champion_arch_fresh' AS baseline_source, reason, (SELECT arg_max(version_id, ic) FROM r WHERE reason = 'eligible') AS winner_version_id,
 CASE WHEN (SELECT count(*) FROM r WHERE reason = 'eligible') = 0 AND base > 0.01 AND base >= 0.105 THEN 'v-ret_13' END AS refresh_version_id FROM r""")
def select_winner(spark, sf):
    return winners(spark, feature_series(spark, sf))


@register("winner_observe", "spec_id:s beats_baseline:b dsr_selection:f dsr_selection_n_eff:i ic_ir_needed:f gate_pass:b", "fic mom", f"""
, b AS (SELECT -mean_ic AS base FROM fic WHERE feature = 'ret_13'),
s AS (SELECT feature, n, -mean AS mean, std, -skew AS skew, kurt, greatest(2, least({N_EFF}, n)) AS n_used, -mean / std AS sr FROM mom),
z AS (SELECT *, {_STAR!r}::DOUBLE / sqrt(n_used) AS star, sqrt(n_used - 1) / sqrt(1 - skew * sr + (kurt - 1) / 4 * sr * sr) AS wd FROM s),
q AS (SELECT *, (sr - star) * wd AS z1 FROM z)
SELECT feature AS spec_id, round(-mean_ic, 10) >= round(base + 0.005, 10) AS beats_baseline, {sql_phi('z1')} AS dsr_selection, n_used AS dsr_selection_n_eff,
 {_inv(0.95)!r}::DOUBLE / sqrt(n_used - 1) AS ic_ir_needed, ({sql_phi('z1')}) >= 0.95 AND q.n >= 5 AND q.mean >= 0 AS gate_pass FROM q JOIN fic USING (feature), b""")
def winner_observe(spark, sf):
    ics = feature_series(spark, sf)
    series = ics.select(F.col("feature").alias("spec_id"), "dt", (-F.col("ic")).alias("ic"))
    return E.winner_observe(winners(spark, ics), series, 0.005, TRIALS, N_EFF)


def winners(spark, series):
    ics = E.mean_rank_ic(series, ["feature"])
    rows = ics.select(F.col("feature").alias("spec_id"), F.concat(F.lit("v-"), "feature").alias("version_id"),
                      F.when(F.col("feature") == "rsi", 5).otherwise(21).alias("forward_days"), (-F.col("mean_ic")).alias("mean_ic"))
    serving = spark.createDataFrame([(0.10,)], "serving_ic double")
    return E.select_winner(rows, serving, 21, 0.005, 0.01, "ret_13")
