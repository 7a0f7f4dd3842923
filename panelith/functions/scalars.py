"""Row-wise scores, classifications and thresholds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.functions.columns import clamp, finite, map_lookup, sigmoid

# Blend weights, thresholds and vocabularies that results depend on.
MOMENTUM_BLEND = {"m_short": 0.4, "m_mid": 0.3, "ma": 0.2, "rsi": 0.1}
RESIDUAL_BLEND = {
    "resid_mom_vol_scaled": 1.0, "mom_12_1": 0.5, "mom_1m": -0.5, "mom_change": 0.5, "sector_mom": 0.25,
}
STANCES = ("momentum", "value", "quality", "catalyst")
STANCE_SHARPNESS = 3.0
CONVICTION = {"rising": 1.0, "stable": 0.0, "declining": -1.0}
GUARDRAILS = {
    "vix_caution": 22.0, "vix_bear": 30.0, "spy_caution": -5.0, "spy_bear": -10.0, "oas_caution": 500.0,
}
REGIME_ADJUSTMENT = {
    "bear": -0.20, "bearish": -0.20, "caution": -0.10, "neutral": 0.0, "bull": 0.10, "bullish": 0.10,
}
REGIME_WEIGHTS = {"intensity_z": 0.40, "hmm": 0.35, "drawdown_spy": 0.15, "drawdown_excess": 0.10}
TIER_SCORE = {"risk_on": 0.0, "caution": -0.5, "risk_off": -1.0}
EXCESS_SCORE = {"risk_on": 0.0, "alpha_bleed": -1.0}
TIER_SEVERITY = {"risk_on": 0, "caution": 1, "risk_off": 2, "alpha_bleed": 2}
PROTECTION = {"bull": 0, "neutral": 1, "bear": 2}
NEUTRAL_BAND = 0.20
STALE_GRACE, STALE_HALF_LIFE, STALE_FLOOR = 8, 12.0, 0.25
VOL_BASELINES = ("realized_vol_20d", "vol_20d", "realized_vol_30d", "vol_30d")


def neutral(col: str, default: float = 0.0) -> Column:
    return F.coalesce(finite(col), F.lit(float(default)))


def momentum_score(short: str, mid: str, ma: str, rsi: str) -> Column:
    w = MOMENTUM_BLEND
    return (
        w["m_short"] * neutral(short) + w["m_mid"] * neutral(mid) + w["ma"] * neutral(ma)
        + w["rsi"] * (neutral(rsi, 50.0) - 50) / 100
    )


def residual_momentum_score() -> Column:
    total = F.lit(0.0)
    for name, weight in RESIDUAL_BLEND.items():
        total = total + weight * neutral(name)
    return total


def impute_neutral(rows: DataFrame, features: list[str]) -> DataFrame:
    """Missing features become 0; ``imputed`` lists them and ``n_imputed`` counts them."""
    missing = F.array(*[F.when(finite(f).isNull(), F.lit(f)) for f in features])
    rows = rows.withColumn("imputed", F.filter(missing, lambda x: x.isNotNull()))
    return rows.withColumns({f: neutral(f) for f in features}).withColumn("n_imputed", F.size("imputed"))


def momentum_veto(col: str, threshold: float) -> Column:
    return F.coalesce(finite(col) < threshold, F.lit(False))


def stance_loadings(rows: DataFrame, has_pillars: bool = False) -> DataFrame:
    """Four loadings that sum to one, the dominant stance (fixed order on ties) and its source.

    Features: momentum_20d, price_vs_ma50, realized_vol_20d, debt_to_equity, eps_ttm,
    days_to_earnings; pillar scores (0-100) win when any of them is present.
    """

    def value(col: str, default: float) -> Column:
        # zero means "not reported" for these inputs
        v = finite(col) if col in rows.columns else F.lit(None).cast("double")
        return F.when(v.isNull() | (v == 0), F.lit(default)).otherwise(v)

    mom, ma = value("momentum_20d", 0.0), value("price_vs_ma50", 1.0)
    vol, debt = value("realized_vol_20d", 0.20), value("debt_to_equity", 0.5)
    eps = value("eps_ttm", 0.0)
    debt_quality = sigmoid((1.5 - debt) * 2.0)
    quality = (sigmoid((0.30 - vol) / 0.30) + debt_quality) / 2.0 * 1.5
    fundamentals = (debt_quality + sigmoid(eps * 0.5)) / 2.0
    days = finite("days_to_earnings") if "days_to_earnings" in rows.columns else F.lit(None).cast("double")
    near = F.exp(-((days - 10) * (days - 10)) / (2.0 * 12 * 12)) * 1.5
    raw = {
        "momentum": sigmoid(mom / 0.05) + clamp((ma - 1.0) * 2.0, 0.0, 0.2),
        "value": sigmoid(-mom / 0.05) * fundamentals * 2.0,
        "quality": quality,
        "catalyst": F.when(days.between(0, 60), near).otherwise(0.0),
    }
    source = F.lit("heuristic")
    if has_pillars:
        cluster = [finite(f"pillar_{n}") for n in ("quality", "growth", "stewardship", "defensiveness")]
        total, count = F.lit(0.0), F.lit(0)
        for c in cluster:
            total = total + F.coalesce(c, F.lit(0.0))
            count = count + c.isNotNull().cast("int")
        mean = F.coalesce(total / F.when(count > 0, count), F.lit(0.0))
        present = (
            finite("pillar_momentum").isNotNull() | finite("pillar_value").isNotNull() | (count > 0)
        )
        pillars = {
            "momentum": neutral("pillar_momentum") / 50.0,
            "value": neutral("pillar_value") / 50.0,
            "quality": mean / 50.0,
            "catalyst": F.greatest(F.lit(0.0), neutral("pillar_catalyst")) * 5.0 / 50.0,
        }
        raw = {k: F.when(present, pillars[k]).otherwise(raw[k]) for k in STANCES}
        source = F.when(present, "pillar").otherwise("heuristic")
    rows = rows.withColumns({f"_s_{k}": raw[k] * STANCE_SHARPNESS for k in STANCES})
    top = F.greatest(*[F.col(f"_s_{k}") for k in STANCES])
    weights = {k: F.exp(F.col(f"_s_{k}") - top) for k in STANCES}
    norm = weights["momentum"] + weights["value"] + weights["quality"] + weights["catalyst"]
    rows = rows.withColumns({f"load_{k}": F.round(weights[k] / norm, 6) for k in STANCES})
    best = F.when(F.lit(False), "")
    for k in STANCES:
        best = best.when(F.round(F.col(f"_s_{k}"), 10) == F.round(top, 10), k)
    return rows.withColumns({"stance": best, "stance_source": source}).drop(*[f"_s_{k}" for k in STANCES])


def snapshot_features(
    score: Column, conviction: Column, sector: Column, modifiers: Column, calibrated: Column | None = None,
    canonical: dict[str, str] | None = None,
) -> dict[str, Column]:
    """Four features of one universe entry; the caller drops rows without a score."""
    name = F.coalesce(map_lookup(canonical, sector), sector) if canonical else sector
    return {
        "research_calibrator_prob": calibrated if calibrated is not None else score / 100.0,
        "research_composite_score": score / 100.0,
        "research_conviction": F.coalesce(map_lookup(CONVICTION, conviction), F.lit(0.0)),
        "sector_macro_modifier": F.coalesce(F.try_element_at(modifiers, name), F.lit(1.0)) - 1.0,
    }


def classify_regime(ret: Column, bar: float = 0.03) -> Column:
    return F.when(ret > bar, "bull").when(ret < -bar, "bear").otherwise("neutral")


def intensity_band(z: Column) -> Column:
    return (
        F.when(z > 1.0, "risk_on").when(z > 0.3, "risk_on_tilted").when(z > -0.3, "neutral")
        .when(z > -1.0, "risk_off_tilted").otherwise("risk_off")
    )


def guardrail_flags(rows: DataFrame) -> DataFrame:
    """Breach flags from vix_level, hy_oas_bps and spy_30d_return (else the 20-day one, scaled).
    A return below 1 in size is read as a fraction and turned into percent."""
    scaled = finite("spy_20d_return") * 1.5
    ret = F.coalesce(finite("spy_30d_return"), scaled) if "spy_30d_return" in rows.columns else scaled
    pct = F.when(F.abs(ret) < 1.0, ret * 100.0).otherwise(ret)

    def breach(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    vix, oas, g = finite("vix_level"), finite("hy_oas_bps"), GUARDRAILS
    rows = rows.withColumns(
        {
            "vix_caution_breached": breach(vix > g["vix_caution"]),
            "vix_bear_breached": breach(vix > g["vix_bear"]),
            "spy_30d_caution_breached": breach(pct < g["spy_caution"]),
            "spy_30d_bear_breached": breach(pct < g["spy_bear"]),
            "hy_oas_caution_breached": breach(oas > g["oas_caution"]),
        }
    )
    both = F.col("vix_bear_breached") & F.col("spy_30d_bear_breached")
    return rows.withColumn("active_severity_floor", F.when(both, "bear"))


def veto_adjustment(z: Column, scale: float = 0.10, cap: float = 0.20) -> Column:
    return F.coalesce(clamp(z * scale, -cap, cap), F.lit(0.0))


def veto_threshold(
    base: Column, regime: Column, z: Column, forced: Column, severity: Column, *,
    continuous: bool = False, forced_enabled: bool = False, drawdown_enabled: bool = False,
    scale: float = 0.10, cap: float = 0.20,
) -> Column:
    """Base confidence moved by the regime (continuous when enabled and known), then the lowest of
    that and every enabled protective floor."""
    discrete = F.coalesce(map_lookup(REGIME_ADJUSTMENT, F.lower(F.trim(regime))), F.lit(0.0))
    move = F.when(z.isNotNull(), veto_adjustment(z, scale, cap)).otherwise(discrete) if continuous else discrete
    out = clamp(base + move, 0.0, 0.80)
    if forced_enabled:
        floor = clamp(base - cap, 0.0, 0.80)
        out = F.when(F.coalesce(forced, F.lit(False)), F.least(out, floor)).otherwise(out)
    if drawdown_enabled:
        full, half = clamp(base - cap, 0.0, 0.80), clamp(base - cap / 2.0, 0.0, 0.80)
        floor = F.when(severity >= 2, full).when(severity >= 1, half)
        out = F.when(floor.isNotNull(), F.least(out, floor)).otherwise(out)
    return out


def veto_flag(alpha: Column, rank: Column, n: Column, confidence: Column, threshold: Column) -> Column:
    return F.coalesce(
        (alpha < 0) & (rank > n / 2) & (F.coalesce(confidence, F.lit(0.0)) >= threshold), F.lit(False)
    )


def clip_col(col: Column, bound: float) -> Column:
    return clamp(col, -bound, bound)


def to_probability(alpha: Column, clip: float, fitted: Column | None = None) -> dict[str, Column]:
    """p_up (fitted, or linear in the clipped alpha), direction from one half on, confidence."""
    p = fitted if fitted is not None else clamp(0.5 + clip_col(alpha, clip) / (2.0 * clip), 0.0, 1.0)
    return {
        "p_up": F.round(p, 4),
        "p_down": F.round(1 - p, 4),
        "predicted_direction": F.when(F.round(p, 10) >= 0.5, "UP").when(p.isNotNull(), "DOWN"),
        "prediction_confidence": F.round(F.abs(p - 0.5) * 2.0, 4),
    }


def fallback_alpha(momentum: Column, calibrated: Column, expected_move: Column, clip: float) -> Column:
    blend = (
        0.4 * momentum + 0.3 * (calibrated - 0.5) * 0.1 + 0.2 * expected_move * F.signum(momentum)
    )
    return clip_col(blend, clip)


# --- regime score -----------------------------------------------------------------------------


def staleness_discount(weeks: Column) -> Column:
    decay = F.pow(F.lit(0.5), (weeks - STALE_GRACE) / STALE_HALF_LIFE)
    return F.when(weeks > STALE_GRACE, STALE_FLOOR + (1 - STALE_FLOOR) * decay).otherwise(1.0)


def regime_score(
    rows: DataFrame, z: str = "intensity_z", p_bull: str = "p_bull", p_bear: str = "p_bear",
    weeks: str = "weeks_in_state", tier: str = "tier", excess: str = "excess_tier",
    forced: str = "forced_bear",
) -> DataFrame:
    """Signed score in [-1, 1] from the heads that are present, weights renormalised over them."""
    posterior = clamp(F.coalesce(finite(p_bull), F.lit(0.0)) - F.coalesce(finite(p_bear), F.lit(0.0)), -1, 1)
    known = finite(p_bull).isNotNull() | finite(p_bear).isNotNull()
    heads = {
        "intensity_z": F.tanh(finite(z) / 2.0),
        "hmm": F.when(known, posterior * staleness_discount(F.col(weeks))),
        "drawdown_spy": map_lookup(TIER_SCORE, F.col(tier)),
        "drawdown_excess": map_lookup(EXCESS_SCORE, F.col(excess)),
    }
    total, norm = F.lit(0.0), F.lit(0.0)
    for name, head in heads.items():
        w = REGIME_WEIGHTS[name]
        total = total + F.coalesce(head * w, F.lit(0.0))
        norm = norm + F.when(head.isNotNull(), w).otherwise(0.0)
    blend = F.coalesce(total / F.when(norm > 0, norm), F.lit(0.0))
    floored = F.coalesce(F.col(forced), F.lit(False))
    rows = rows.withColumn("regime_score", clamp(F.when(floored, F.lit(-1.0)).otherwise(blend), -1, 1))
    s = F.round("regime_score", 10)
    return rows.withColumn(
        "regime_score_categorical",
        F.when(s > NEUTRAL_BAND, "bull").when(s < -NEUTRAL_BAND, "bear").otherwise("neutral"),
    )


def most_protective(*labels: Column) -> Column:
    """The most protective of nullable macro labels; unknown words count as neutral rank."""
    ranks = [
        F.when(c.isNotNull(), F.coalesce(map_lookup(PROTECTION, c), F.lit(1))) for c in labels
    ]
    # at least two arguments, NULLs ignored
    top = F.greatest(*ranks, F.lit(None).cast("int"))
    return F.when(top == 2, "bear").when(top == 0, "bull").otherwise("neutral")


def effective_regime(
    rows: DataFrame, macro: str = "macro_regime", tier: str = "tier", excess: str = "excess_tier",
    forced: str = "forced_bear",
) -> DataFrame:
    bear = F.lit("bear")
    legs = [
        F.col(macro),
        F.when(F.col(tier) == "risk_off", bear),
        F.when(F.col(excess) == "alpha_bleed", bear),
        F.when(F.coalesce(F.col(forced), F.lit(False)), bear),
    ]
    severity = F.greatest(
        F.coalesce(map_lookup(TIER_SEVERITY, F.col(tier)), F.lit(0)),
        F.coalesce(map_lookup(TIER_SEVERITY, F.col(excess)), F.lit(0)),
    )
    return rows.withColumns({"effective_regime": most_protective(*legs), "protective_severity": severity})


# --- selection helpers ------------------------------------------------------------------------


def meta_features(base: list[str], drop: list[str] = (), add: list[str] = ()) -> list[str]:
    """The feature list after flags: dropped names leave, added ones follow in order."""
    kept = [f for f in base if f not in set(drop)]
    return kept + [f for f in add if f not in kept]


def baseline_prediction(rows: DataFrame) -> Column:
    """The first volatility column that exists, missing as 0; without one the baseline is 0."""
    for name in VOL_BASELINES:
        if name in rows.columns:
            return neutral(name)
    return F.lit(0.0)


def short_history_mask(features: list[str]) -> Column:
    mask = F.lit(False)
    for f in features:
        mask = mask | finite(f).isNull()
    return mask
