"""Per-date batch adjustments of predictions. Batch facts are one row per date, joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.functions.columns import clamp
from panelith.functions.scalars import to_probability

MIN_DISTINCT, MIN_BATCH, ALPHA_FLOOR = 3, 5, 0.05


def rescale_batch(preds: DataFrame, calibrated: bool = True, by: str = "dt") -> DataFrame:
    """Keeps calibrated probabilities unless a batch of five or more shows fewer than three distinct
    ones (to four places); then, and without a calibrator, they are rescaled linearly by the batch's
    largest alpha. The rescaled confidence is the winning side's probability."""
    alpha = F.coalesce("predicted_alpha", F.lit(0.0))
    p4 = F.round(F.coalesce("p_up", F.lit(0.5)), 4)
    # distinct values first: a batch piled onto one value shrinks before the second step
    cells = preds.groupBy(by, p4.alias("_v")).agg(
        F.max(F.abs(alpha)).alias("_m"), F.count(F.lit(1)).alias("_c")
    )
    facts = cells.groupBy(by).agg(
        F.max("_m").alias("_m"), F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d")
    )
    collapsed = (F.col("_n") >= MIN_BATCH) & (F.col("_d") < MIN_DISTINCT)
    rescale = collapsed if calibrated else F.lit(True)
    scale = F.greatest(F.col("_m"), F.lit(ALPHA_FLOOR))
    p = clamp(0.5 + alpha / (2.0 * scale), 0.0, 1.0)
    up = alpha >= 0
    new = {
        "p_up": F.round(p, 4),
        "p_down": F.round(1 - p, 4),
        "predicted_direction": F.when(up, "UP").otherwise("DOWN"),
        "prediction_confidence": F.round(F.when(up, p).otherwise(1 - p), 4),
    }
    joined = preds.join(facts, by).withColumn("rescaled", rescale)
    out = {k: F.when(F.col("rescaled"), v).otherwise(F.col(k)) for k, v in new.items()}
    return joined.withColumns(out).drop("_m", "_n", "_d")


def neutralize_level(preds: DataFrame, clip: float, enabled: bool = True, by: str = "dt") -> DataFrame:
    """Alpha minus its batch mean with everything derived from it; batches of one stay as they are."""
    alpha = F.coalesce("predicted_alpha", F.lit(0.0))
    facts = preds.groupBy(by).agg(F.avg(alpha).alias("_mean"), F.count(F.lit(1)).alias("_n"))
    rows = preds.join(facts, by).withColumns(
        {
            "predicted_alpha_raw": F.round(alpha, 6),
            "predicted_alpha_centered": F.when(F.col("_n") >= 2, F.round(alpha - F.col("_mean"), 6)),
            "_centered": alpha - F.col("_mean"),
        }
    )
    rows = rows.withColumn(
        "sign_flip",
        (F.col("_n") >= 2) & ((F.round(alpha, 10) < 0) != (F.round("_centered", 10) < 0)),
    )
    derived = to_probability(F.round("_centered", 10), clip)
    rows = rows.withColumn("centered_direction", derived["predicted_direction"])
    if enabled:
        live = {**derived, "predicted_alpha": F.col("predicted_alpha_centered")}
        rows = rows.withColumns(
            {k: F.when(F.col("_n") >= 2, v).otherwise(F.col(k)) for k, v in live.items()}
        )
    return rows.drop("_mean", "_n", "_centered")


def neutralize_stats(preds: DataFrame, clip: float, by: str = "dt") -> DataFrame:
    """Per batch: mean removed, sign flips, share of DOWN before and after."""
    rows = neutralize_level(preds, clip, enabled=False, by=by)

    def down(col: str) -> Column:
        return F.avg((F.col(col) == "DOWN").cast("double"))

    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.coalesce("predicted_alpha", F.lit(0.0))).alias("mean_removed"),
        F.sum(F.col("sign_flip").cast("int")).alias("n_flips"),
        down("predicted_direction").alias("skew_raw"),
        down("centered_direction").alias("skew_centered"),
    ).where("n >= 2")
