"""Distribution drift against a training reference, and gates on prediction batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.functions.columns import finite, guarded_corr, ratio
from panelith.functions.ranks import cumulative_table, order_number
from panelith.operators.evaluation import long_features

# Alert thresholds.
FEATURE_Z = 3.0
FEATURE_Z_CRITICAL = 5.0
SAME_DIRECTION = 0.80
CONFIDENCE_FLOOR = 0.45
ALPHA_STD_FLOOR = 0.001
PERSIST_DAYS = 3
RECENT_DAYS = 5


def drift_reference(
    rows: DataFrame, features: list[str], cap: int = 2000, group_bound: int | None = None
) -> DataFrame:
    """(feature, position, value, n, mean, std): at most ``cap`` evenly spaced values of each
    feature in (dt, entity) order, with moments of all of them."""
    long = long_features(rows, features, ["entity", "dt"]).withColumn("value", finite("value"))
    long = long.where("value IS NOT NULL")
    stats = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    per_date = long.groupBy("feature", "dt").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy("feature").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_date.select(
        "feature", "dt", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_o")
    )
    # position inside a date by entity alone
    placed = order_number(
        long.withColumn("_same", F.lit(0.0)), ["feature", "dt"], "_same", "entity", "_r",
        group_bound=group_bound,
    )
    placed = placed.join(offsets, ["feature", "dt"]).join(stats, "feature").withColumn(
        "_pos", F.col("_o") + F.col("_r") - 1
    )
    # index i keeps position floor(i * (n - 1) / (cap - 1)); whole-number arithmetic throughout
    slot = F.expr(f"(_pos * {cap - 1} + n - 2) div (n - 1)")
    placed = placed.withColumn("position", F.when(F.col("n") > cap, slot).otherwise(F.col("_pos")))
    kept = placed.where(f"n <= {cap} OR position * (n - 1) div {cap - 1} = _pos")
    return kept.select("feature", "position", F.round("value", 6).alias("value"), "n", "mean", "std")


def ks_drift(
    reference: DataFrame, current: DataFrame, floor: int = 30, keys: list[str] | None = None
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per key; both sides: (keys, value).

    Cumulative counts per distinct value and source; the statistic is the largest gap. Two constant
    samples count as no drift.
    """
    keys = keys or ["feature"]
    both = reference.select(*keys, "value", F.lit(1).alias("_ref")).unionByName(
        current.select(*keys, "value", F.lit(0).alias("_ref"))
    ).withColumn("value", finite("value"))
    table = cumulative_table(
        both, keys, "value",
        {"r": F.sum("_ref"), "c": F.sum(1 - F.col("_ref"))},
    )
    gap = F.abs(
        ratio(F.col("r_below") + F.col("r"), F.col("r_total"))
        - ratio(F.col("c_below") + F.col("c"), F.col("c_total"))
    )

    def distinct(side: str) -> Column:
        return F.sum((F.col(side) > 0).cast("int"))

    out = table.groupBy(*keys).agg(
        F.max(gap).alias("ks"),
        F.max("r_total").alias("n_ref"),
        F.max("c_total").alias("n_cur"),
        ((distinct("r") == 1) & (distinct("c") == 1)).alias("_flat"),
    )
    return (
        out.where((F.col("n_ref") >= floor) & (F.col("n_cur") >= floor))
        .withColumn("ks", F.when(F.col("_flat"), 0.0).otherwise(F.col("ks")))
        .drop("_flat")
    )


def ks_summary(ks: DataFrame) -> DataFrame:
    return ks.agg(
        F.max("ks").alias("max_ks"), F.avg("ks").alias("mean_ks"), F.count(F.lit(1)).alias("n_features")
    )


def feature_drift(train: DataFrame, today: DataFrame, features: list[str], top: int = 5) -> DataFrame:
    """Features whose mean today is more than three training deviations away: the ``top`` worst with
    the number of drifted ones and the severity of the worst."""

    def moments(df: DataFrame) -> DataFrame:
        return long_features(df, features, []).groupBy("feature").agg(
            F.avg(finite("value")).alias("m"), F.stddev_pop(finite("value")).alias("s")
        )

    stats = moments(train).join(
        moments(today).select("feature", F.col("m").alias("t")), "feature"
    ).where("s >= 1e-10 AND t IS NOT NULL")
    scored = stats.withColumn("z", F.round(F.abs(F.col("t") - F.col("m")) / F.col("s"), 2))
    drifted = scored.where(F.abs(F.col("t") - F.col("m")) / F.col("s") > FEATURE_Z)
    # one row per feature
    every = Window.partitionBy(F.lit(1))
    return drifted.select(
        "feature", "z",
        F.row_number().over(every.orderBy(F.col("z").desc(), "feature")).alias("place"),
        F.count(F.lit(1)).over(every).alias("n_drifted"),
        F.when(F.max("z").over(every) >= FEATURE_Z_CRITICAL, "CRITICAL").otherwise("WARN").alias("severity"),
    ).where(F.col("place") <= top)


def prediction_days(preds: DataFrame) -> DataFrame:
    """One row per date: size, share of the commonest direction, mean confidence, alpha spread."""
    up = F.sum((F.col("predicted_direction") == "UP").cast("int"))
    down = F.sum((F.col("predicted_direction") == "DOWN").cast("int"))
    return preds.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        ratio(F.greatest(up, down), up + down).alias("dominant_share"),
        F.avg("prediction_confidence").alias("mean_confidence"),
        F.stddev_pop(finite("predicted_alpha")).alias("alpha_std"),
    )


def prediction_drift(
    preds: DataFrame, as_of: str, available: DataFrame | None = None, look_back: int = 7
) -> DataFrame:
    """Alert rows (code, severity, value) for the newest batches up to ``as_of``.

    ``available`` lists the baselines that exist (column ``check``); checks without one are INFO.
    """
    spark = preds.sparkSession
    day = F.lit(as_of).cast("date")
    window = preds.where((F.col("dt") <= day) & (F.col("dt") > F.date_sub(day, look_back)))
    newest = Window.partitionBy(F.lit(1)).orderBy(F.col("dt").desc())
    # one row per date of the look-back from here on
    days = prediction_days(window).withColumn("_k", F.row_number().over(newest)).where(
        F.col("_k") <= RECENT_DAYS
    )
    low = F.round("mean_confidence", 10) < CONFIDENCE_FLOOR
    clustered = F.round("dominant_share", 10) > SAME_DIRECTION
    today = F.col("_k") == 1
    facts = days.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.max(F.when(today, F.col("dominant_share"))).alias("share"),
        F.max(F.when(today, F.col("mean_confidence"))).alias("confidence"),
        F.max(F.when(today, F.col("alpha_std"))).alias("alpha_std"),
        F.sum((clustered & (F.col("_k") <= PERSIST_DAYS)).cast("int")).alias("n_clustered"),
        F.sum(low.cast("int")).alias("n_low"),
        F.count("mean_confidence").alias("n_conf"),
    )
    conf = F.round("confidence", 10)
    chronic = (F.col("n_conf") >= PERSIST_DAYS) & (F.col("n_low") >= PERSIST_DAYS)
    acute = (F.col("n_conf") >= 2) & (F.col("n_low") == 1) & (conf < CONFIDENCE_FLOOR)
    trend = F.when(chronic, "chronic").when(acute, "acute").otherwise("indeterminate")
    worst = (trend == "acute") | (conf < 0.5 * CONFIDENCE_FLOOR)
    rules = [
        ("no_recent_predictions", F.lit("CRITICAL"), F.col("n_days") == 0, F.lit(0.0)),
        ("direction_clustering", F.lit("WARN"), F.round("share", 10) > SAME_DIRECTION, F.col("share")),
        (
            "persistent_direction_clustering", F.lit("CRITICAL"),
            F.col("n_clustered") >= PERSIST_DAYS, F.col("n_clustered").cast("double"),
        ),
        (
            "confidence_collapse", F.when(worst, "CRITICAL").otherwise("WARN"),
            conf < CONFIDENCE_FLOOR, F.col("confidence"),
        ),
        (
            "alpha_degeneration", F.lit("CRITICAL"),
            F.round("alpha_std", 12) < ALPHA_STD_FLOOR, F.col("alpha_std"),
        ),
    ]
    alerts = F.array(
        *[
            F.when(
                F.coalesce(rule, F.lit(False)),
                F.struct(F.lit(code).alias("code"), sev.alias("severity"), val.cast("double").alias("value")),
            )
            for code, sev, rule, val in rules
        ]
    )
    out = facts.select(F.explode(F.filter(alerts, lambda a: a.isNotNull())).alias("a")).select("a.*")
    if available is not None:
        required = spark.createDataFrame([("feature_drift",)], "check string")
        skipped = required.join(available, "check", "left_anti").select(
            F.col("check").alias("code"), F.lit("INFO").alias("severity"), F.lit(None).cast("double").alias("value")
        )
        out = out.unionByName(skipped)
    return out


def max_severity(alerts: DataFrame) -> DataFrame:
    order = F.when(F.col("severity") == "CRITICAL", 3).when(F.col("severity") == "WARN", 2).otherwise(1)
    return alerts.agg(F.max_by("severity", order).alias("severity"), F.count(F.lit(1)).alias("n_alerts"))


# --- batch gates ------------------------------------------------------------------------------

# Limits of the distribution gate.
GATE = {
    "min_unique": 8, "max_modal": 0.5, "max_saturation": 0.25, "min_std": 0.005, "max_skew": 0.85,
    "floor": 0.011, "ceiling": 0.989, "min_batch": 5,
}
HEALTH = {"max_nonfinite": 0.20, "max_modal": 0.90, "max_sign_skew": 0.97, "max_saturation": 0.25}


def distribution_gate(
    preds: DataFrame, by: list[str], min_batch: int | None = None, p: str = "p_up"
) -> DataFrame:
    """Shape of every batch's probabilities and the first check it fails (NULL when none).

    Equal rounded values are counted first, so a batch that piles onto one value stays cheap.
    """
    floor = GATE["min_batch"] if min_batch is None else min_batch
    known = preds.where(F.col(p).isNotNull())
    v = F.col(p)
    cells = known.groupBy(*by, F.round(p, 6).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"),
        F.sum(v).alias("_s"),
        F.sum(v * v).alias("_q"),
        F.sum(((v <= GATE["floor"]) | (v >= GATE["ceiling"])).cast("int")).alias("_sat"),
        F.sum((F.col("predicted_direction") == "UP").cast("int")).alias("_up"),
        F.sum((F.col("predicted_direction") == "DOWN").cast("int")).alias("_dn"),
    )
    n = F.col("n")
    out = cells.groupBy(*by).agg(
        F.sum("_c").alias("n"),
        F.count(F.lit(1)).alias("n_unique"),
        F.max("_c").alias("_m"),
        F.sum("_sat").alias("_sat"),
        F.sum("_s").alias("_s"),
        F.sum("_q").alias("_q"),
        F.sum("_up").alias("n_up"),
        F.sum("_dn").alias("n_down"),
    )
    var = F.col("_q") / n - (F.col("_s") / n) * (F.col("_s") / n)
    out = out.withColumns(
        {
            "modal_fraction": F.col("_m") / n,
            "saturation_rate": F.col("_sat") / n,
            "std": F.sqrt(F.greatest(var, F.lit(0.0))),
            "direction_skew": F.coalesce(
                ratio(F.greatest("n_up", "n_down"), F.col("n_up") + F.col("n_down")), F.lit(0.0)
            ),
        }
    )
    failed = (
        F.when(n < floor, None)
        .when((F.col("n_unique") < GATE["min_unique"]) & (F.col("modal_fraction") >= GATE["max_modal"]), "unique_p_up")
        .when(F.col("saturation_rate") > GATE["max_saturation"], "saturation_rate")
        .when(F.round("std", 9) < GATE["min_std"], "stdev")
        .when(F.col("direction_skew") > GATE["max_skew"], "direction_skew")
    )
    return out.withColumn("failed_check", failed).withColumn(
        "passed", F.col("failed_check").isNull()
    ).drop("_m", "_sat", "_s", "_q")


def stratified_gate(preds: DataFrame, regime: str = "regime", min_size: int = 25) -> DataFrame:
    """The distribution gate per regime; small slices are reported but not judged."""
    gated = distribution_gate(preds, [regime], min_batch=1)
    judged = F.col("n") >= min_size
    return gated.withColumns(
        {
            "evaluated": judged,
            "failed_check": F.when(judged, F.col("failed_check")),
            "passed": ~judged | F.col("passed"),
        }
    )


def health_gate(preds: DataFrame, by: list[str], min_batch: int = 5) -> DataFrame:
    """Recalibration-invariant brokenness per batch. NaN and infinities count as broken here, a NULL
    alpha only as absent."""
    a, p = F.col("predicted_alpha"), F.col("p_up")
    broken = F.isnan(a) | (F.abs(a) == float("inf"))
    good = F.when(a.isNotNull() & ~broken, a)
    rows = preds.withColumns({"_good": good, "_broken": broken & a.isNotNull()})
    cells = rows.groupBy(*by, F.round("_good", 9).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"),
        F.count("_good").alias("_g"),
        F.sum(F.col("_broken").cast("int")).alias("_b"),
        F.sum((F.col("_good") > 0).cast("int")).alias("_pos"),
        F.sum((F.col("_good") < 0).cast("int")).alias("_neg"),
        F.count("p_up").alias("_p"),
        F.sum(((p <= GATE["floor"]) | (p >= GATE["ceiling"])).cast("int")).alias("_sat"),
    )
    out = cells.groupBy(*by).agg(
        F.sum("_c").alias("n"),
        F.sum(F.col("_g") + F.col("_b")).alias("n_present"),
        F.sum("_g").alias("n_finite"),
        F.sum("_b").alias("_b"),
        F.max("_g").alias("_m"),
        F.count("_v").alias("n_unique_alpha"),
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("n_neg"),
        F.sum("_p").alias("_p"),
        F.coalesce(F.sum("_sat"), F.lit(0)).alias("_sat"),
    )
    zero = F.lit(0.0)
    out = out.withColumns(
        {
            "nonfinite_rate": F.coalesce(ratio(F.col("_b"), F.col("n_present")), zero),
            "alpha_modal_fraction": F.coalesce(ratio(F.col("_m"), F.col("n_finite")), zero),
            "sign_skew": F.coalesce(
                ratio(F.greatest("n_pos", "n_neg"), F.col("n_pos") + F.col("n_neg")), zero
            ),
            "saturation_rate": F.coalesce(ratio(F.col("_sat"), F.col("_p")), zero),
        }
    )
    enough = F.col("n_finite") >= min_batch
    failed = (
        F.when(F.col("n") < min_batch, None)
        .when((F.col("n_present") >= min_batch) & (F.col("nonfinite_rate") > HEALTH["max_nonfinite"]), "alpha_nonfinite_rate")
        .when(enough & (F.col("alpha_modal_fraction") >= HEALTH["max_modal"]), "alpha_collapse")
        .when(enough & (F.col("sign_skew") >= HEALTH["max_sign_skew"]), "alpha_sign_skew")
        .when((F.col("_p") >= min_batch) & (F.col("saturation_rate") > HEALTH["max_saturation"]), "saturation_rate")
    )
    return out.withColumn("failed_check", failed).withColumn(
        "passed", F.col("failed_check").isNull()
    ).drop("_b", "_m", "_p", "_sat")


def calibrator_gate(
    spark, score, alpha_range: tuple[float, float] = (-0.05, 0.05), points: int = 25
) -> DataFrame:
    """The distribution gate over an even sweep of alphas scored by a fitted calibrator.

    ``score`` maps a DataFrame with column ``alpha`` to one with ``p_up``.
    """
    lo, hi = alpha_range
    sweep = spark.range(points).select(
        (F.lit(lo) + F.col("id") * ((hi - lo) / (points - 1))).alias("alpha")
    )
    scored = score(sweep).withColumns(
        {
            "batch": F.lit("sweep"),
            "predicted_direction": F.when(F.col("p_up") > 0.5, "UP").when(F.col("p_up") < 0.5, "DOWN"),
        }
    )
    return distribution_gate(scored, ["batch"])


def subsample_gate(
    rows: DataFrame, component: str, baseline: str, actual: str, mask: str, min_n: int = 30,
    by: list[str] | None = None,
) -> DataFrame:
    """Component against its named baseline on the masked rows; too few rows skip the gate."""
    keys = by or []
    sub = rows.where(F.coalesce(F.col(mask), F.lit(False))).withColumns(
        {c: finite(c) for c in (component, baseline, actual)}
    ).dropna(subset=[component, baseline, actual])
    out = sub.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(guarded_corr(component, actual, 2), F.lit(0.0)).alias("_c"),
        F.coalesce(guarded_corr(baseline, actual, 2), F.lit(0.0)).alias("_b"),
    )
    skip = F.col("n") < min_n
    return out.select(
        *keys, "n",
        F.when(skip, 0.0).otherwise(F.col("_c")).alias("component_ic"),
        F.when(skip, 0.0).otherwise(F.col("_b")).alias("baseline_ic"),
        (skip | (F.round("_c", 10) >= F.round("_b", 10))).alias("passed"),
        skip.alias("skipped"),
    )
