"""Queries over scores, thresholds and batch adjustments."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.columns import by_entity
from panelith.operators import states as S
from panelith.operators import windows as W
from panelith.operators import xsection as C
from panelith.plans.base import FEATURES, aligned, features, panel
from panelith.plans.labels import nav_rows
from panelith.plans.registry import cte, register
from panelith.plans.windows import RESID, daily_macro, weekly_macro
from panelith.sources import panel as P

CLIP = 0.15

cte("momsc", "feat", """
SELECT entity, dt, 0.4 * coalesce(mom_1, 0) + 0.3 * coalesce(mom_4, 0) + 0.2 * coalesce(vs_ma10, 0) + 0.1 * (coalesce(rsi, 50) - 50) / 100 AS momentum_score FROM feat""")


@register("momentum_score", "entity:i dt:d momentum_score:f", "momsc", "SELECT * FROM momsc")
def momentum_score(spark, sf):
    return features(spark, sf).withColumn("momentum_score", X.momentum_score("mom_1", "mom_4", "vs_ma10", "rsi"))


cte("residsc", "residmom", """
SELECT entity, dt, coalesce(resid_mom_vol_scaled, 0) + 0.5 * coalesce(mom_12_1, 0) - 0.5 * coalesce(mom_1m, 0) + 0.5 * coalesce(mom_change, 0)
  + 0.25 * coalesce(sector_mom, 0) AS residual_momentum_score FROM residmom""")


def residual_score(spark, sf, base=None):
    rows = W.residual_momentum_features(aligned(spark, sf) if base is None else base, **RESID)
    return rows.withColumn("residual_momentum_score", X.residual_momentum_score())


@register("residual_momentum_score", "entity:i dt:d residual_momentum_score:f", "residsc", "SELECT * FROM residsc")
def residual_momentum_score(spark, sf):
    return residual_score(spark, sf)


IMPUTED = ["mom_1", "mom_4", "ret_13", "ret_26"]


@register("impute_neutral", "entity:i dt:d mom_1:f mom_4:f ret_13:f ret_26:f names:s n_imputed:i", "feat", """
SELECT entity, dt, coalesce(mom_1, 0) AS mom_1, coalesce(mom_4, 0) AS mom_4, coalesce(ret_13, 0) AS ret_13, coalesce(ret_26, 0) AS ret_26,
 concat_ws(',', CASE WHEN mom_1 IS NULL THEN 'mom_1' END, CASE WHEN mom_4 IS NULL THEN 'mom_4' END, CASE WHEN ret_13 IS NULL THEN 'ret_13' END, CASE WHEN ret_26 IS NULL THEN 'ret_26' END) AS names,
 (mom_1 IS NULL)::INT + (mom_4 IS NULL)::INT + (ret_13 IS NULL)::INT + (ret_26 IS NULL)::INT AS n_imputed FROM feat""")
def impute_neutral(spark, sf):
    rows = features(spark, sf).select("entity", "dt", *IMPUTED)
    return X.impute_neutral(rows, IMPUTED).withColumn("names", F.array_join("imputed", ","))


@register("imputed_entities", "dt:d n_affected:i n:i", "feat", """
SELECT dt, sum(CASE WHEN mom_1 IS NULL OR mom_4 IS NULL OR ret_13 IS NULL OR ret_26 IS NULL THEN 1 ELSE 0 END) AS n_affected, count(*) AS n FROM feat GROUP BY dt""")
def imputed_entities(spark, sf):
    rows = X.impute_neutral(features(spark, sf).select("entity", "dt", *IMPUTED), IMPUTED)
    return rows.groupBy("dt").agg(F.sum((F.col("n_imputed") > 0).cast("int")).alias("n_affected"), F.count(F.lit(1)).alias("n"))


@register("momentum_veto", "entity:i dt:d veto:b", "feat", "SELECT entity, dt, coalesce(mom_4 < -0.1, false) AS veto FROM feat")
def momentum_veto(spark, sf):
    return features(spark, sf).withColumn("veto", X.momentum_veto("mom_4", -0.1))


# Stance inputs: momentum, price against its mean (as a ratio), volatility; leverage and earnings stand
# in from the sector-relative price and return; the next quarter's first day is the event.
cte("stancein", "feat vol", """
SELECT f.entity, f.dt, f.mom_4 AS m, 1 + f.vs_ma10 AS ma, v.realized_vol AS rv, f.close / f.bench AS de, 10 * f.ret_13 AS eps,
 date_diff('day', f.dt, CAST(date_trunc('quarter', f.dt) + INTERVAL 3 MONTH AS DATE)) AS days,
 CASE WHEN f.mom_1 > 0.2 THEN 50 + 50 * f.mom_1 / (1 + abs(f.mom_1)) END AS pm, CASE WHEN f.mom_1 > 0.2 THEN 100 * f.close / (f.close + f.bench) END AS pq
FROM feat f JOIN vol v USING (entity, dt)""")


@register("stance_loadings", "entity:i dt:d load_momentum:f load_value:f load_quality:f load_catalyst:f stance:s stance_source:s", "stancein", """
, v AS (SELECT entity, dt, coalesce(nullif(m, 0), 0) AS m, coalesce(nullif(ma, 0), 1) AS ma, coalesce(nullif(rv, 0), 0.2) AS rv, coalesce(nullif(de, 0), 0.5) AS de, coalesce(nullif(eps, 0), 0) AS eps, days, pm, pq FROM stancein),
q AS (SELECT *, 1 / (1 + exp(-(1.5 - de) * 2)) AS dq FROM v),
r AS (SELECT entity, dt, pm IS NOT NULL OR pq IS NOT NULL AS pil,
  3 * CASE WHEN pm IS NOT NULL OR pq IS NOT NULL THEN coalesce(pm, 0) / 50 ELSE 1 / (1 + exp(-m / 0.05)) + least(0.2, greatest(0, (ma - 1) * 2)) END AS sm,
  3 * CASE WHEN pm IS NOT NULL OR pq IS NOT NULL THEN 0 ELSE 1 / (1 + exp(m / 0.05)) * (dq + 1 / (1 + exp(-eps * 0.5))) / 2 * 2 END AS sv,
  3 * CASE WHEN pm IS NOT NULL OR pq IS NOT NULL THEN coalesce(pq, 0) / 50 ELSE (1 / (1 + exp(-(0.3 - rv) / 0.3)) + dq) / 2 * 1.5 END AS sq,
  3 * CASE WHEN pm IS NOT NULL OR pq IS NOT NULL THEN 0 ELSE CASE WHEN days BETWEEN 0 AND 60 THEN 1.5 * exp(-((days - 10) * (days - 10)) / 288.0) ELSE 0 END END AS sc FROM q),
e AS (SELECT *, exp(sm - greatest(sm, sv, sq, sc)) AS em, exp(sv - greatest(sm, sv, sq, sc)) AS ev, exp(sq - greatest(sm, sv, sq, sc)) AS eq, exp(sc - greatest(sm, sv, sq, sc)) AS ec FROM r)
SELECT entity, dt, round(em / (em + ev + eq + ec), 6) AS load_momentum, round(ev / (em + ev + eq + ec), 6) AS load_value, round(eq / (em + ev + eq + ec), 6) AS load_quality, round(ec / (em + ev + eq + ec), 6) AS load_catalyst,
 CASE WHEN em = 1 THEN 'momentum' WHEN ev = 1 THEN 'value' WHEN eq = 1 THEN 'quality' ELSE 'catalyst' END AS stance, CASE WHEN pil THEN 'pillar' ELSE 'heuristic' END AS stance_source FROM e""")
def stance_loadings(spark, sf):
    rows = W.realized_vol(features(spark, sf), 8, 52)
    event = F.to_date(F.date_trunc("quarter", "dt")) + F.expr("interval 3 months")
    strong = F.col("mom_1") > 0.2
    rows = rows.select(
        "entity", "dt", F.col("mom_4").alias("momentum_20d"), (1 + F.col("vs_ma10")).alias("price_vs_ma50"),
        F.col("realized_vol").alias("realized_vol_20d"), (F.col("close") / F.col("bench")).alias("debt_to_equity"),
        (10 * F.col("ret_13")).alias("eps_ttm"), F.datediff(event.cast("date"), "dt").alias("days_to_earnings"),
        F.when(strong, 50 + 50 * F.col("mom_1") / (1 + F.abs("mom_1"))).alias("pillar_momentum"),
        F.when(strong, 100 * F.col("close") / (F.col("close") + F.col("bench"))).alias("pillar_quality"),
        *[F.lit(None).cast("double").alias(f"pillar_{n}") for n in ("value", "growth", "stewardship", "defensiveness", "catalyst")],
    )
    return X.stance_loadings(rows, has_pillars=True)


@register("classify_regime", "dt:d spy_20d_return:f regime:s", "mdaily", """
SELECT dt, spy_20d_return, CASE WHEN spy_20d_return > 0.03 THEN 'bull' WHEN spy_20d_return < -0.03 THEN 'bear' ELSE 'neutral' END AS regime FROM mdaily""")
def classify_regime(spark, sf):
    return daily_macro(spark, sf).withColumn("regime", X.classify_regime(F.col("spy_20d_return")))


@register("intensity_band", "dt:d band:s", "replay", """
SELECT dt, CASE WHEN intensity_z > 1 THEN 'risk_on' WHEN intensity_z > 0.3 THEN 'risk_on_tilted' WHEN intensity_z > -0.3 THEN 'neutral'
 WHEN intensity_z > -1 THEN 'risk_off_tilted' ELSE 'risk_off' END AS band FROM replay""")
def intensity_band(spark, sf):
    return W.intensity_replay(daily_macro(spark, sf)).withColumn("band", X.intensity_band(F.col("intensity_z")))


@register("guardrail_flags", "dt:d vix_caution_breached:b vix_bear_breached:b spy_30d_caution_breached:b spy_30d_bear_breached:b hy_oas_caution_breached:b active_severity_floor:s", "mdaily", """
SELECT dt, vix_level / 10000 > 22 AS vix_caution_breached, vix_level / 10000 > 30 AS vix_bear_breached, pct < -5 AS spy_30d_caution_breached, pct < -10 AS spy_30d_bear_breached,
 hy_oas_bps / 50000 > 500 AS hy_oas_caution_breached, CASE WHEN vix_level / 10000 > 30 AND pct < -10 THEN 'bear' END AS active_severity_floor
FROM (SELECT *, CASE WHEN abs(spy_20d_return * 1.5) < 1 THEN spy_20d_return * 150 ELSE spy_20d_return * 1.5 END AS pct FROM mdaily)""")
def guardrail_flags(spark, sf):
    # order values brought to the scale of the thresholds
    macro = daily_macro(spark, sf).withColumns(
        {"vix_level": F.col("vix_level") / 10000, "hy_oas_bps": F.col("hy_oas_bps") / 50000})
    return X.guardrail_flags(macro)


# --- predictions -----------------------------------------------------------------------------

cte("pred", "feat", f"""
SELECT entity, dt, sector, mom_4, predicted_alpha, round(p, 4) AS p_up, round(1 - p, 4) AS p_down, CASE WHEN round(p, 10) >= 0.5 THEN 'UP' ELSE 'DOWN' END AS predicted_direction,
 round(abs(p - 0.5) * 2, 4) AS prediction_confidence FROM (
 SELECT *, 0.5 + predicted_alpha / {2 * CLIP} AS p FROM (SELECT *, least({CLIP}, greatest(-{CLIP}, -0.1 * mom_4)) AS predicted_alpha FROM feat WHERE mom_4 IS NOT NULL))""")


def predictions(spark, sf, base=None):
    """Mean-reversion alpha per entity and week with its linear probabilities."""
    rows = features(spark, sf, base).where("mom_4 IS NOT NULL").withColumn(
        "predicted_alpha", X.clip_col(-0.1 * F.col("mom_4"), CLIP))
    return rows.withColumns(X.to_probability(F.col("predicted_alpha"), CLIP))


@register("to_probability", "entity:i dt:d predicted_alpha:f p_up:f p_down:f predicted_direction:s prediction_confidence:f", "pred", "SELECT * FROM pred")
def to_probability(spark, sf):
    return predictions(spark, sf)


@register("clip_col", "entity:i dt:d y:f", "fwd", "SELECT entity, dt, least(0.25, greatest(-0.25, fwd_ret)) AS y FROM fwd")
def clip_col(spark, sf):
    return W.forward_return(aligned(spark, sf), 4).withColumn("y", X.clip_col(F.col("fwd_ret"), 0.25))


cte("coarse", "pred", """
SELECT *, CASE WHEN predicted_alpha > 0.043 THEN 0.7 WHEN predicted_alpha >= 0 THEN 0.55 ELSE 0.45 END AS q FROM pred""")


def coarse(spark, sf):
    """Predictions through a three-step calibrator, which collapses on calm dates."""
    a = F.col("predicted_alpha")
    rows = predictions(spark, sf)
    return rows.withColumns(X.to_probability(a, CLIP, F.when(a > 0.043, 0.7).when(a >= 0, 0.55).otherwise(0.45)))


@register("rescale_batch", "entity:i dt:d rescaled:b p_up:f p_down:f predicted_direction:s prediction_confidence:f", "coarse", """
SELECT entity, dt, r AS rescaled, CASE WHEN r THEN round(p, 4) ELSE q END AS p_up, CASE WHEN r THEN round(1 - p, 4) ELSE round(1 - q, 4) END AS p_down,
 CASE WHEN r THEN CASE WHEN predicted_alpha >= 0 THEN 'UP' ELSE 'DOWN' END ELSE CASE WHEN q >= 0.5 THEN 'UP' ELSE 'DOWN' END END AS predicted_direction,
 CASE WHEN r THEN round(CASE WHEN predicted_alpha >= 0 THEN p ELSE 1 - p END, 4) ELSE round(abs(q - 0.5) * 2, 4) END AS prediction_confidence
FROM (SELECT *, least(1, greatest(0, 0.5 + predicted_alpha / (2 * m))) AS p FROM coarse JOIN (
  SELECT dt, greatest(max(abs(predicted_alpha)), 0.05) AS m, count(*) >= 5 AND count(DISTINCT q) < 3 AS r FROM coarse GROUP BY dt) USING (dt))""")
def rescale_batch(spark, sf):
    return C.rescale_batch(coarse(spark, sf))


@register("rescale_uncalibrated", "entity:i dt:d p_up:f predicted_direction:s prediction_confidence:f", "pred", """
SELECT entity, dt, p AS p_up, CASE WHEN predicted_alpha >= 0 THEN 'UP' ELSE 'DOWN' END AS predicted_direction, CASE WHEN predicted_alpha >= 0 THEN p ELSE round(1 - praw, 4) END AS prediction_confidence
FROM (SELECT *, round(praw, 4) AS p FROM (SELECT *, least(1, greatest(0, 0.5 + predicted_alpha / (2 * m))) AS praw FROM pred JOIN (
  SELECT dt, greatest(max(abs(predicted_alpha)), 0.05) AS m FROM pred GROUP BY dt) USING (dt)))""")
def rescale_uncalibrated(spark, sf):
    return C.rescale_batch(predictions(spark, sf), calibrated=False)


cte("neutral", "pred", f"""
SELECT *, predicted_alpha - m AS c, CASE WHEN round(0.5 + least({CLIP}, greatest(-{CLIP}, round(predicted_alpha - m, 10))) / {2 * CLIP}, 10) >= 0.5 THEN 'UP' ELSE 'DOWN' END AS cdir,
 0.5 + least({CLIP}, greatest(-{CLIP}, round(predicted_alpha - m, 10))) / {2 * CLIP} AS cp
FROM pred JOIN (SELECT dt, avg(predicted_alpha) AS m, count(*) AS n FROM pred GROUP BY dt) USING (dt)""")


@register("neutralize_level", "entity:i dt:d predicted_alpha:f predicted_alpha_raw:f predicted_alpha_centered:f sign_flip:b p_up:f predicted_direction:s prediction_confidence:f", "neutral", """
SELECT entity, dt, CASE WHEN n >= 2 THEN round(c, 6) ELSE predicted_alpha END AS predicted_alpha, round(predicted_alpha, 6) AS predicted_alpha_raw,
 CASE WHEN n >= 2 THEN round(c, 6) END AS predicted_alpha_centered, n >= 2 AND ((round(predicted_alpha, 10) < 0) <> (round(c, 10) < 0)) AS sign_flip,
 CASE WHEN n >= 2 THEN round(cp, 4) ELSE p_up END AS p_up, CASE WHEN n >= 2 THEN cdir ELSE predicted_direction END AS predicted_direction,
 CASE WHEN n >= 2 THEN round(abs(cp - 0.5) * 2, 4) ELSE prediction_confidence END AS prediction_confidence FROM neutral""")
def neutralize_level(spark, sf):
    return C.neutralize_level(predictions(spark, sf), CLIP)


@register("neutralize_stats", "dt:d n:i mean_removed:f n_flips:i skew_raw:f skew_centered:f", "neutral", """
SELECT dt, count(*) AS n, avg(predicted_alpha) AS mean_removed, sum(CASE WHEN (round(predicted_alpha, 10) < 0) <> (round(c, 10) < 0) THEN 1 ELSE 0 END) AS n_flips,
 avg(CASE WHEN predicted_direction = 'DOWN' THEN 1.0 ELSE 0.0 END) AS skew_raw, avg(CASE WHEN cdir = 'DOWN' THEN 1.0 ELSE 0.0 END) AS skew_centered
FROM neutral GROUP BY dt HAVING count(*) >= 2""")
def neutralize_stats(spark, sf):
    return C.neutralize_stats(predictions(spark, sf), CLIP)


# --- regime score and veto -------------------------------------------------------------------

# Heads per entity and week: trailing z of the price as intensity, up/down shares of the last 8 moves as
# posterior, run length of the current direction as staleness, the two drawdown tiers, a forced flag.
cte("heads", "zseries feat", """
SELECT f.entity, f.dt, z.z AS intensity_z, CASE WHEN count(f.mom_1) OVER w8 = 8 THEN avg(CASE WHEN f.mom_1 > 0 THEN 1.0 WHEN f.mom_1 <= 0 THEN 0.0 END) OVER w8 END AS p_bull,
 CASE WHEN count(f.mom_1) OVER w8 = 8 THEN avg(CASE WHEN f.mom_1 < 0 THEN 1.0 WHEN f.mom_1 >= 0 THEN 0.0 END) OVER w8 END AS p_bear,
 CAST(row_number() OVER (PARTITION BY f.entity ORDER BY f.dt) AS INTEGER) % 60 AS weeks_in_state,
 CASE WHEN f.mom_4 < -0.3 THEN 'risk_off' WHEN f.mom_4 < -0.1 THEN 'caution' WHEN f.mom_4 IS NOT NULL THEN 'risk_on' END AS tier,
 CASE WHEN f.vs_ma10 < -0.4 THEN 'alpha_bleed' WHEN f.vs_ma10 IS NOT NULL THEN 'risk_on' END AS excess_tier, f.mom_1 < -0.5 AS forced_bear,
 CASE WHEN f.ret_13 > 0.03 THEN 'bull' WHEN f.ret_13 < -0.03 THEN 'bear' WHEN f.ret_13 IS NOT NULL THEN 'neutral' END AS macro_regime
FROM feat f LEFT JOIN zseries z USING (entity, dt) WINDOW w8 AS (PARTITION BY f.entity ORDER BY f.dt ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")


def heads(spark, sf):
    w = by_entity()
    past, last8 = w.rowsBetween(-26, -1), w.rowsBetween(-7, 0)
    m1, close = F.col("mom_1"), F.col("close")
    z = F.when(F.count(close).over(past) >= 13, (close - F.avg(close).over(past)) / F.stddev_samp(close).over(past))

    def share(test):
        return W.full_frame(m1, F.avg(F.when(m1.isNotNull(), test.cast("double"))), last8, 8)

    m4, ma, r13 = F.col("mom_4"), F.col("vs_ma10"), F.col("ret_13")
    return features(spark, sf).select(
        "entity", "dt", z.alias("intensity_z"), share(m1 > 0).alias("p_bull"), share(m1 < 0).alias("p_bear"),
        (F.row_number().over(w) % 60).alias("weeks_in_state"),
        F.when(m4 < -0.3, "risk_off").when(m4 < -0.1, "caution").when(m4.isNotNull(), "risk_on").alias("tier"),
        F.when(ma < -0.4, "alpha_bleed").when(ma.isNotNull(), "risk_on").alias("excess_tier"),
        (m1 < -0.5).alias("forced_bear"),
        F.when(r13.isNotNull(), X.classify_regime(r13)).alias("macro_regime"),
    )


@register("regime_score", "entity:i dt:d regime_score:f regime_score_categorical:s", "heads", """
, h AS (SELECT *, tanh(intensity_z / 2) AS h1, CASE WHEN p_bull IS NOT NULL THEN (p_bull - p_bear) * CASE WHEN weeks_in_state > 8 THEN 0.25 + 0.75 * pow(0.5, (weeks_in_state - 8) / 12.0) ELSE 1 END END AS h2,
  CASE tier WHEN 'risk_on' THEN 0.0 WHEN 'caution' THEN -0.5 WHEN 'risk_off' THEN -1.0 END AS h3, CASE excess_tier WHEN 'risk_on' THEN 0.0 WHEN 'alpha_bleed' THEN -1.0 END AS h4 FROM heads),
s AS (SELECT entity, dt, CASE WHEN coalesce(forced_bear, false) THEN -1.0 ELSE coalesce((coalesce(0.4 * h1, 0) + coalesce(0.35 * h2, 0) + coalesce(0.15 * h3, 0) + coalesce(0.1 * h4, 0))
  / nullif(CASE WHEN h1 IS NULL THEN 0 ELSE 0.4 END + CASE WHEN h2 IS NULL THEN 0 ELSE 0.35 END + CASE WHEN h3 IS NULL THEN 0 ELSE 0.15 END + CASE WHEN h4 IS NULL THEN 0 ELSE 0.1 END, 0), 0) END AS v FROM h)
SELECT entity, dt, v AS regime_score, CASE WHEN round(v, 10) > 0.2 THEN 'bull' WHEN round(v, 10) < -0.2 THEN 'bear' ELSE 'neutral' END AS regime_score_categorical FROM s""")
def regime_score(spark, sf):
    return X.regime_score(heads(spark, sf))


EFF_SQL = """
SELECT entity, dt, CASE WHEN macro_regime = 'bear' OR tier = 'risk_off' OR excess_tier = 'alpha_bleed' OR forced_bear THEN 'bear'
  WHEN macro_regime = 'bull' THEN 'bull' ELSE 'neutral' END AS effective_regime,
 greatest(CASE tier WHEN 'caution' THEN 1 WHEN 'risk_off' THEN 2 ELSE 0 END, CASE excess_tier WHEN 'alpha_bleed' THEN 2 ELSE 0 END) AS protective_severity FROM heads"""


@register("effective_regime", "entity:i dt:d effective_regime:s protective_severity:i", "heads", EFF_SQL)
def effective_regime(spark, sf):
    return X.effective_regime(heads(spark, sf))


@register("veto_threshold", "entity:i dt:d continuous:f discrete:f", "heads", f"""
, e AS (SELECT h.*, x.protective_severity AS sev FROM heads h JOIN ({EFF_SQL}) x USING (entity, dt)),
a AS (SELECT *, least(0.8, greatest(0, 0.3 + CASE WHEN intensity_z IS NOT NULL THEN least(0.2, greatest(-0.2, intensity_z * 0.1)) ELSE d END)) AS c0, least(0.8, greatest(0, 0.3 + d)) AS d0 FROM (
  SELECT *, CASE macro_regime WHEN 'bear' THEN -0.2 WHEN 'bull' THEN 0.1 ELSE 0 END AS d FROM e))
SELECT entity, dt, least(c0, CASE WHEN coalesce(forced_bear, false) THEN 0.1 ELSE 1 END, CASE WHEN sev >= 2 THEN 0.1 WHEN sev >= 1 THEN 0.2 ELSE 1 END) AS continuous, d0 AS discrete FROM a""")
def veto_threshold(spark, sf):
    rows = X.effective_regime(heads(spark, sf))
    args = (F.lit(0.3), F.col("macro_regime"), F.col("intensity_z"), F.col("forced_bear"), F.col("protective_severity"))
    return rows.withColumns({
        "continuous": X.veto_threshold(*args, continuous=True, forced_enabled=True, drawdown_enabled=True),
        "discrete": X.veto_threshold(*args)})


@register("veto_flag", "entity:i dt:d combined_rank:i veto:b", "pred", """
SELECT entity, dt, r AS combined_rank, predicted_alpha < 0 AND r > n / 2.0 AND prediction_confidence >= 0.3 AS veto FROM (
 SELECT *, row_number() OVER (PARTITION BY dt ORDER BY round(predicted_alpha, 10) DESC, entity) AS r, count(*) OVER (PARTITION BY dt) AS n FROM pred)""")
def veto_flag(spark, sf):
    rows = predictions(spark, sf)
    sizes = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    ranked = W.combined_rank(rows, group_bound=P.entity_bound(spark, sf)).join(sizes, "dt")
    return ranked.withColumn("veto", X.veto_flag(
        F.col("predicted_alpha"), F.col("combined_rank"), F.col("n"), F.col("prediction_confidence"), F.lit(0.3)))


@register("fallback_alpha", "entity:i dt:d alpha:f", "momsc vol", """
SELECT entity, dt, least(0.15, greatest(-0.15, 0.4 * momentum_score + 0.3 * (p - 0.5) * 0.1 + 0.2 * rv * sign(momentum_score))) AS alpha
FROM (SELECT m.entity, m.dt, m.momentum_score, coalesce(v.realized_vol, 0) AS rv, 1 / (1 + exp(-m.momentum_score)) AS p FROM momsc m JOIN vol v USING (entity, dt))""")
def fallback_alpha(spark, sf):
    rows = W.realized_vol(features(spark, sf), 8, 52)
    rows = rows.withColumn("momentum_score", X.momentum_score("mom_1", "mom_4", "vs_ma10", "rsi"))
    score = F.col("momentum_score")
    return rows.withColumn("alpha", X.fallback_alpha(score, X.sigmoid(score), X.neutral("realized_vol"), 0.15))


@register("meta_features", "entity:i dt:d mom_4:f ret_13:f rsi:f ret_26:f", "feat", "SELECT * FROM feat")
def meta_features(spark, sf):
    names = X.meta_features(["mom_1", "mom_4", "ret_13", "rsi"], drop=["mom_1"], add=["ret_26"])
    return features(spark, sf).select("entity", "dt", *names)


@register("baseline_prediction", "entity:i dt:d baseline:f", "vol", "SELECT entity, dt, coalesce(realized_vol, 0) AS baseline FROM vol")
def baseline_prediction(spark, sf):
    rows = W.realized_vol(panel(spark, sf), 8, 52).withColumnRenamed("realized_vol", "vol_20d")
    return rows.withColumn("baseline", X.baseline_prediction(rows))


@register("short_history_mask", "entity:i dt:d short_history:b", "feat",
          "SELECT entity, dt, " + " OR ".join(f"{f} IS NULL" for f in FEATURES) + " AS short_history FROM feat")
def short_history_mask(spark, sf):
    return features(spark, sf).withColumn("short_history", X.short_history_mask(FEATURES))


@register("admission_report", "reason:s n_entities:i n_rows:i", "fwd", """
SELECT reason, count(*) AS n_entities, sum(n) AS n_rows FROM (
 SELECT p.entity, p.n, CASE WHEN p.n < 265 THEN 'insufficient_history' WHEN p.s IS NULL THEN 'missing_features' WHEN f.k IS NULL THEN 'no_labels' ELSE 'admitted' END AS reason
 FROM (SELECT entity, count(*) AS n, max(rsi) AS s FROM feat GROUP BY 1) p LEFT JOIN (SELECT entity, count(*) AS k FROM fwd GROUP BY 1) f USING (entity)) GROUP BY 1""")
def admission_report(spark, sf):
    from panelith.operators.joins import admission_report as report
    rows = features(spark, sf).withColumn("fwd_ret", W.excess_forward("close", "bench", 4))
    return report(rows, 265, ["rsi"], "fwd_ret")
