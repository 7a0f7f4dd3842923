"""Compositions: daily scoring, out-of-sample training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.columns import finite
from panelith.operators import drift as D
from panelith.operators import gram as G
from panelith.operators import windows as W
from panelith.operators.xsection import neutralize_level, rescale_batch
from panelith.session import cut_lineage


def score_cross_section(
    features: DataFrame, as_of: str | list[str], model: DataFrame, meta: list[str], clip: float, *,
    universe: DataFrame | None = None, macro: DataFrame | None = None, base_confidence: float = 0.30,
    calibrated: bool = False, neutralize: bool = True, continuous: bool = False, forced_enabled: bool = False,
    drawdown_enabled: bool = False, group_bound: int | None = None,
) -> DataFrame:
    """The daily chain for one date or several: universe, imputation, meta model (fallback blend without one),
    clip, probability, rank, batch rescale, level neutralisation, veto against the date's threshold, health
    gate and coverage of the candidates.

    features: (entity, dt, meta..., momentum_score, expected_move, research_calibrator_prob); model: one row,
    possibly none; universe: (entity, source), all entities without it; macro: a row per date with regime,
    intensity_z, forced_bear and protective_severity, any of them missing or NULL. Candidates (source both or
    buy_candidate) without a prediction count as ``n_missing``. Gate and coverage are one row per date.
    """
    days = [as_of] if isinstance(as_of, str) else list(as_of)
    rows = features.where(F.col("dt").isin([F.lit(d).cast("date") for d in days]))
    if universe is not None:
        rows = rows.join(universe.select("entity", "source"), "entity")
    else:
        rows = rows.withColumn("source", F.lit("unknown"))
    # read by the batch statistics, the ranks and the gates below
    raw = {f"_raw_{n}": X.neutral(n, d) for n, d in (("momentum_score", 0.0), ("research_calibrator_prob", 0.5), ("expected_move", 0.0))}
    rows = X.impute_neutral(rows.withColumns(raw), meta)
    # an empty model table leaves NULL coefficients behind and the blend takes over
    slot = model.select("coef", "intercept", "noise", "centre", "cov")
    one = rows.sparkSession.range(1).join(slot, F.lit(True), "left").drop("id")
    scored = G.score_linear(rows, one, meta, pred="meta_alpha", with_std=True)
    blend = X.fallback_alpha(*[F.col(c) for c in raw], clip)
    alpha = X.clip_col(F.coalesce("meta_alpha", blend), clip)
    scored = scored.withColumn("predicted_alpha", alpha).withColumns(X.to_probability(F.col("predicted_alpha"), clip)).drop(*raw)
    ranked = cut_lineage(W.combined_rank(cut_lineage(scored), group_bound=group_bound))
    final = cut_lineage(neutralize_level(rescale_batch(ranked, calibrated), clip, neutralize))

    # one row per date from here on
    candidate = F.col("source").isin("both", "buy_candidate")
    batch = final.groupBy("dt").agg(F.count(F.lit(1)).alias("_n"), F.sum(candidate.cast("int")).alias("_covered"))
    gate = D.health_gate(final, ["dt"]).select("dt", "failed_check", F.col("passed").alias("gate_passed"))
    wanted = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("_wanted"))
    if universe is not None:
        wanted = universe.agg(F.sum(candidate.cast("long")).alias("_wanted"))
    facts = batch.join(gate, "dt").crossJoin(F.broadcast(wanted))
    known = dict(macro.dtypes) if macro is not None else {}
    inputs = {"regime": "string", "intensity_z": "double", "forced_bear": "boolean", "protective_severity": "int"}
    if macro is not None:
        facts = facts.join(macro.select("dt", *[c for c in inputs if c in known]), "dt", "left")
    facts = facts.withColumns({c: F.lit(None).cast(t) for c, t in inputs.items() if c not in known})
    threshold = X.veto_threshold(
        F.lit(base_confidence), F.coalesce("regime", F.lit("")), F.col("intensity_z"), F.coalesce("forced_bear", F.lit(False)),
        F.col("protective_severity"), continuous=continuous, forced_enabled=forced_enabled, drawdown_enabled=drawdown_enabled,
    )
    facts = facts.withColumns({
        "veto_threshold": threshold, "n_missing": F.when(F.col("_wanted") > 0, F.col("_wanted") - F.col("_covered")).otherwise(0),
    }).drop(*inputs, "_wanted", "_covered")
    out = final.join(F.broadcast(facts), "dt")
    veto = X.veto_flag(
        F.col("predicted_alpha"), F.col("combined_rank"), F.col("_n"), F.col("prediction_confidence"), F.col("veto_threshold")
    )
    return out.withColumn("veto", veto).drop("_n")


def build_oos_rows(
    features: DataFrame, labels: DataFrame, folds: DataFrame, snapshots: DataFrame | None,
    macro: DataFrame | None, scores: list[str], outcomes: list[str],
) -> DataFrame:
    """One row per entity and test date: layer-one scores, as-of snapshot fields, macro, outcomes.

    With ``snapshots`` (entity, dt, research columns, already as-of) rows without one drop out; a
    model that uses no research feature passes None and keeps every row.
    """
    tests = folds.where("role = 'test'").select("fold_id", "dt")
    rows = features.select("entity", "dt", *scores).join(tests, "dt")
    rows = rows.join(labels.select("entity", "dt", *outcomes), ["entity", "dt"])
    if snapshots is not None:
        rows = rows.join(snapshots, ["entity", "dt"])
    if macro is not None:
        rows = rows.join(macro, "dt", "left")
    return rows.where(finite(outcomes[0]).isNotNull())
