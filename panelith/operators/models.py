"""Model fits, leak-free evaluation and daily scoring as Spark jobs."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions import scalars as X
from panelith.functions.columns import RANK_DIGITS, clamp, finite, ratio, safe_corr
from panelith.functions.ranks import exact_quantiles, fits_window, order_number, tie_rank
from panelith.operators import evaluation as E
from panelith.operators import folds as FD
from panelith.operators import gram as G
from panelith.operators import variants as V
from panelith.operators.bootstrap import MIX_A, MIX_B, MIX_MOD, MIX_STEP
from panelith.operators.isotonic import isotonic_blocks, isotonic_curve
from panelith.session import cut_lineage

#: registered versions that are scored side by side in every task
BROADCAST_VERSIONS = 10_000
# Score buckets of the hit-rate calibrator.
BUCKETS = ((0, 40), (40, 55), (55, 65), (65, 75), (75, 85), (85, 100))


# --- calibrators ------------------------------------------------------------------------------


def bucket_of(score: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for i, (lo, hi) in enumerate(BUCKETS):
        out = out.when((score >= lo) & (score < hi), i)
    return out


def fit_bucket_calibrator(rows: DataFrame, score: str, hit: str) -> DataFrame:
    """(bucket, n, rate, overall) for every bucket: hit rate, or the overall one below three."""
    spark = rows.sparkSession
    known = rows.select(finite(score).alias("_s"), finite(hit).alias("_h")).dropna()
    per = known.groupBy(bucket_of(F.col("_s")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_h").alias("_r"), F.sum("_h").alias("_hits")
    )
    # at most seven rows, the out-of-range one included; read twice below
    per = cut_lineage(per)
    whole = Window.partitionBy(F.lit(1))
    per = per.withColumn("overall", F.sum("_hits").over(whole) / F.sum("n").over(whole))
    total = per.agg(F.max("overall").alias("overall"))
    grid = spark.range(0, len(BUCKETS), 1, 1).select(F.col("id").cast("int").alias("bucket"))
    out = grid.crossJoin(F.broadcast(total)).join(per.drop("overall"), "bucket", "left")
    rate = F.when(F.coalesce("n", F.lit(0)) >= 3, F.col("_r")).otherwise(F.col("overall"))
    return out.select("bucket", F.coalesce("n", F.lit(0)).alias("n"), rate.alias("rate"), "overall")


def apply_bucket_calibrator(rows: DataFrame, table: DataFrame, score: str, out: str = "prob") -> DataFrame:
    """Scores outside every bucket get the overall rate, or 0.5 when that is zero."""
    # six rows
    rates = table.agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "rate"))).alias("_rates"),
        F.max("overall").alias("_overall"),
    )
    outside = F.when(F.col("_overall") == 0, 0.5).otherwise(F.coalesce("_overall", F.lit(0.5)))
    joined = rows.crossJoin(F.broadcast(rates))
    bucket = bucket_of(finite(score))
    prob = F.when(bucket.isNotNull(), F.try_element_at("_rates", bucket)).otherwise(outside)
    return joined.withColumn(out, prob).drop("_rates", "_overall")


def holdout_gate(
    rows: DataFrame, score: str, hit: str, dt: str = "dt", share: float = 0.2, min_n: int = 30,
    tiebreak: str = "entity",
) -> DataFrame:
    """Calibrator fitted on the early rows against score/100 on the last ``share`` by date."""
    known = cut_lineage(
        rows.where(finite(score).isNotNull() & finite(hit).isNotNull()).select(dt, tiebreak, score, hit)
    )
    per_date = known.groupBy(dt).agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(F.lit(1)).orderBy(dt).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    offsets = per_date.select(
        dt, F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_o"), F.sum("_c").over(whole).alias("_n")
    )
    placed = order_number(
        known.withColumn("_same", F.lit(0.0)), [dt], "_same", tiebreak, "_r", staged=True
    ).join(offsets, dt)
    hold = F.least(F.greatest(F.round(F.col("_n") * share), F.lit(min_n)), F.col("_n") - min_n)
    placed = placed.withColumn("_fit", F.col("_o") + F.col("_r") <= F.col("_n") - hold)
    table = fit_bucket_calibrator(placed.where("_fit"), score, hit)
    tail = apply_bucket_calibrator(placed.where("NOT _fit"), table, score, "_p")
    out = tail.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(safe_corr(F.col("_p"), finite(hit)), F.lit(0.0)).alias("component_ic"),
        F.coalesce(safe_corr(finite(score) / 100.0, finite(hit)), F.lit(0.0)).alias("baseline_ic"),
        F.max("_n").alias("n_total"),
    )
    skip = F.col("n_total") < 2 * min_n
    better = F.round("component_ic", 10) >= F.round("baseline_ic", 10)
    return out.withColumns({"passed": skip | better, "skipped": skip})


def assemble(rows: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    ready = rows.withColumns({f"_in_{f}": F.coalesce(finite(f), F.lit(0.0)) for f in features})
    return (
        VectorAssembler(inputCols=[f"_in_{f}" for f in features], outputCol=out)
        .transform(ready)
        .drop(*[f"_in_{f}" for f in features])
    )


def probability(model, rows: DataFrame, out: str) -> DataFrame:
    cols = ["rawPrediction", "probability", "prediction"]
    return model.transform(rows).withColumn(out, vector_to_array("probability")[1]).drop(*cols)


def fit_calibrator(rows: DataFrame, alpha: str, label: str, method: str = "isotonic", c: float = 1.0):
    """(score function, ECE before, ECE after): logistic or isotonic map of alpha to probability,
    kept inside [0.01, 0.99]."""
    # fitted over several passes: computed once
    data = cut_lineage(rows.select(finite(alpha).alias("alpha"), finite(label).alias("label")).dropna())
    if method == "isotonic":
        curve = isotonic_curve(isotonic_blocks(data, "alpha", "label"))

        def raw(df: DataFrame) -> DataFrame:
            return df.withColumn("p_up", curve(F.col("alpha")))
    elif method == "logistic":
        n = data.count()
        model = LogisticRegression(regParam=1.0 / (c * n), standardization=False).fit(assemble(data, ["alpha"]))

        def raw(df: DataFrame) -> DataFrame:
            return probability(model, assemble(df, ["alpha"]), "p_up").drop("features")
    else:
        raise ValueError(f"unknown calibration method {method!r}")

    def score(df: DataFrame) -> DataFrame:
        return raw(df).withColumn("p_up", clamp(F.col("p_up"), 0.01, 0.99))

    span = data.agg(F.max(F.abs("alpha")).alias("m")).first()["m"] or 1.0
    linear = data.withColumn("p_up", clamp(0.5 + F.col("alpha") / (2 * span), 0.0, 1.0))
    before = E.ece(linear, "p_up", "label").first()["ece"]
    after = E.ece(score(data), "p_up", "label").first()["ece"]
    return score, before, after


def balanced_weight(rows: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes x class size) as a row weight; one row per class is joined back."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(F.lit(1))
    counts = counts.withColumn(
        out, F.sum("_c").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("_c"))
    ).drop("_c")
    return rows.join(F.broadcast(counts), label)  # a row per class


def auc_brier(rows: DataFrame, p: str, label: str, group_bound: int | None = None) -> DataFrame:
    """AUC as a rank sum over ties, Brier score and base rate."""
    known = rows.select(F.col(p).alias("_p"), F.col(label).cast("double").alias("_y")).dropna()
    ranked = tie_rank(known, [], "_p", "_r", group_bound=group_bound)
    pos = F.sum("_y")
    n = F.count(F.lit(1))
    rank_sum = F.sum(F.when(F.col("_y") == 1, F.col("_r")))
    return ranked.agg(
        n.alias("n"),
        F.avg("_y").alias("base_rate"),
        F.avg((F.col("_p") - F.col("_y")) * (F.col("_p") - F.col("_y"))).alias("brier"),
        ratio(rank_sum - pos * (pos + 1) / 2, pos * (n - pos)).alias("auc"),
    )


def fit_meta_label(rows: DataFrame, features: list[str], label: str):
    """Class-balanced logistic model of a 0/1 label, then a logistic recalibration of its score."""
    known = cut_lineage(rows.where(finite(label).isNotNull()).select(*features, label))
    data = balanced_weight(assemble(known, features), label)
    model = LogisticRegression(labelCol=label, weightCol="weight", regParam=1e-3).fit(data)
    scored = probability(model, data, "score")
    calibrator = LogisticRegression(labelCol=label, featuresCol="cal", regParam=0.0).fit(
        assemble(scored, ["score"], "cal")
    )

    def score(df: DataFrame) -> DataFrame:
        first = probability(model, assemble(df, features), "score")
        return probability(calibrator, assemble(first, ["score"], "cal"), "prob").drop("features", "cal")

    return score


def evaluate_auc(scored: DataFrame, raw: str, label: str) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol=raw, labelCol=label).evaluate(scored)


# --- trees and classifiers ------------------------------------------------------------------------


def relevance_grades(rows: DataFrame, y: str, quantiles=(0.2, 0.4, 0.6, 0.8)) -> DataFrame:
    """Grade 0-4 by the number of quintile thresholds at or below the value."""
    cuts = exact_quantiles(rows.withColumn("_v", finite(y)), [], "_v", list(quantiles))
    names = [f"q{i}" for i in range(len(quantiles))]
    joined = rows.crossJoin(F.broadcast(cuts))
    grade = F.lit(0)
    for q in names:
        grade = grade + (finite(y) >= F.col(q)).cast("int")
    return joined.withColumn("grade", grade).drop(*names)


def fit_gbt(
    rows: DataFrame, features: list[str], y: str, validation: Column, max_iter: int = 20, depth: int = 3,
    seed: int = 42,
):
    """(model, importances) of boosted trees on |y| that stop early on the validation rows."""
    known = cut_lineage(
        rows.where(finite(y).isNotNull()).select(*features, F.abs(finite(y)).alias("_y"), validation.alias("_val"))
    )
    data = assemble(known, features)
    model = GBTRegressor(
        labelCol="_y", maxIter=max_iter, maxDepth=depth, validationIndicatorCol="_val", seed=seed,
        predictionCol="gbt_pred",
    ).fit(data)
    weights = [float(v) for v in model.featureImportances.toArray()]
    table = rows.sparkSession.createDataFrame(list(zip(features, weights)), "feature string, importance double")
    return model, table


def fit_research_gbt(
    rows: DataFrame, features: list[str], label: str, dt: str = "dt", train_share: float = 0.8,
    min_rows: int = 100, max_iter: int = 10, out: str = "research_calibrator_prob",
):
    """Rows with ``out`` rewritten by a boosted classifier fitted on the early 80 % of dates; below
    ``min_rows`` labelled rows they come back unchanged."""
    rows = cut_lineage(rows)
    known = rows.where(finite(label).isNotNull())
    if known.count() < min_rows:
        return rows, None
    roles = FD.time_split(known, train_share, 1 - train_share, dt)
    data = assemble(known.join(roles, dt), features)
    model = GBTClassifier(labelCol=label, maxIter=max_iter, maxDepth=3, seed=42).fit(
        data.where("role = 'train'")
    )
    return probability(model, assemble(rows, features), out).drop("features"), model


def fit_state_classifier(rows: DataFrame, features: list[str], label: str, reg: float = 1e-3, classes: int | None = None):
    """Class-balanced multinomial logistic model; adds ``state`` and one probability per class. Of ``classes`` in all,
    those above the largest label of the rows have probability 0."""
    data = balanced_weight(assemble(cut_lineage(rows.select(*features, label)), features), label)
    model = LogisticRegression(labelCol=label, weightCol="weight", family="multinomial", regParam=reg).fit(data)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, features))
        probs = vector_to_array("probability")
        cols = {f"p{i}": F.coalesce(F.get(probs, F.lit(i)), F.lit(0.0)) for i in range(classes or model.numClasses)}
        return out.withColumns({**cols, "state": F.col("prediction").cast("int")}).drop(
            "rawPrediction", "probability", "prediction", "features"
        )

    return score


# --- leak-free evaluation -----------------------------------------------------------------------


def oos_predictions(
    rows: DataFrame, features: list[str], y: str, folds: DataFrame, extra: list[str] | None = None,
    subset: DataFrame | None = None, min_train: int = 50,
) -> DataFrame:
    """(extra, fold_id, entity, dt, y, pred) of every fold's test rows.

    The per-date statistics are computed once; folds, extra keys (such as a horizon) and feature
    subsets (a small table with key ``variant`` and the positions in ``use``) are sums of them.
    """
    extra = extra or []
    per_date = G.gram_table(rows, features, y, [*extra, "dt"])
    keys = [*extra, "fold_id"]
    grams = G.fold_gram(per_date, folds, len(features), keys).where(F.col("n") >= min_train)
    model_keys, use = keys, None
    if subset is not None:
        grams = grams.crossJoin(F.broadcast(subset))
        model_keys, use = [*keys, "variant"], "use"
    models = G.solve_rows(grams, model_keys, len(features), use)
    tests = folds.where("role = 'test'").drop("role")
    held = rows.where(finite(y).isNotNull()).select(*extra, "entity", "dt", y, *features).join(tests, "dt")
    return G.score_linear(held, models, features, keys).where("pred IS NOT NULL")


def oos_read(
    preds: DataFrame, y: str, by: list[str] | None = None, n_iter: int = 0, group_bound: int | None = None
) -> DataFrame:
    """Cross-sectional and pooled IC of stacked out-of-fold predictions, with an interval when
    ``n_iter`` is positive. Groups without ten predictions report too few folds."""
    keys = by or ["model"]
    rows = preds if by else preds.withColumn("model", F.lit("all"))
    rows = cut_lineage(rows.select(*keys, "fold_id", "entity", "dt", y, "pred"))
    series = E.ic_series(rows, "pred", y, keys, group_bound)
    out = E.mean_rank_ic(series, keys).withColumnRenamed("mean_ic", "xsec_ic")
    pooled = E.pooled_rank_ic(rows, "pred", y, keys).withColumnRenamed("ic", "pooled_ic")
    n_folds = rows.groupBy(*keys).agg(F.countDistinct("fold_id").alias("n_folds"))
    out = n_folds.join(pooled, keys).join(out, keys, "left")
    if n_iter:
        out = out.join(
            E.bootstrap_ic_ci(rows, "pred", y, n_iter, by=keys).select(*keys, "ci_lo", "ci_hi"), keys, "left"
        )
    return out.withColumn("status", F.when(F.col("n") < 10, "insufficient_folds").otherwise("ok"))


def leakfree_oos_ic(
    rows: DataFrame, features: list[str], y: str, forward: int, n_folds: int = 5, min_test: int = 21,
    n_iter: int = 0, group_bound: int | None = None, estimator: Estimator | None = None,
) -> DataFrame:
    """Second-level walk-forward read. With ``estimator`` (any Spark ML regressor on ``features``)
    each fold is one distributed fit; the default shares per-date statistics between folds."""
    known = cut_lineage(rows.dropna(subset=[*features, y]).select("entity", "dt", *features, y))
    folds = FD.expanding_folds(known, forward, n_folds=n_folds, min_test=min_test)
    if estimator is None:
        preds = oos_predictions(known, features, y, folds)
    else:
        preds = estimator_predictions(known, features, y, folds, estimator)
    return oos_read(preds, y, n_iter=n_iter, group_bound=group_bound)


def estimator_predictions(
    rows: DataFrame, features: list[str], y: str, folds: DataFrame, estimator: Estimator
) -> DataFrame:
    """Out-of-fold predictions of an ML estimator: a driver loop over a handful of folds."""
    data = assemble(rows, features).withColumn("label", F.col(y))
    folds = cut_lineage(folds)
    out = None
    for r in folds.select("fold_id").distinct().orderBy("fold_id").collect():
        part = folds.where(F.col("fold_id") == r["fold_id"])
        train = data.join(part.where("role = 'train'").select("dt"), "dt", "left_semi")
        test = data.join(part.where("role = 'test'").select("dt"), "dt", "left_semi")
        scored = estimator.fit(train).transform(test).select(
            F.lit(r["fold_id"]).alias("fold_id"), "entity", "dt", y, F.col("prediction").alias("pred")
        )
        out = scored if out is None else out.unionByName(scored)
    return out


def nonlinear_oos_ic(
    rows: DataFrame, features: list[str], y: str, forward: int, n_folds: int = 3, min_test: int = 21,
    max_iter: int = 5, group_bound: int | None = None,
) -> DataFrame:
    tree = GBTRegressor(labelCol="label", maxIter=max_iter, maxDepth=3, seed=42)
    return leakfree_oos_ic(
        rows, features, y, forward, n_folds, min_test, group_bound=group_bound, estimator=tree
    )


def cpcv_ic(
    rows: DataFrame, features: list[str], y: str, forward: int, n_groups: int = 6, k_test: int = 2,
    group_bound: int | None = None,
) -> DataFrame:
    """(fold_id, ic, n_dates): mean cross-sectional IC of every combination."""
    known = cut_lineage(rows.dropna(subset=[*features, y]).select("entity", "dt", *features, y))
    folds = FD.cpcv_folds(known, forward, n_groups=n_groups, k_test=k_test)
    if fits_window(group_bound):
        folds = cut_lineage(folds)
        per_date = G.gram_table(known, features, y, ["dt"])
        grams = G.fold_gram(per_date, folds, len(features), ["fold_id"]).where("n >= 50")
        models = cut_lineage(G.solve_rows(grams, ["fold_id"], len(features)).withColumn("variant", F.col("fold_id").cast("string")))
        tests = folds.where("role = 'test'").withColumn("variant", F.col("fold_id").cast("string"))
        names, by_date, days = V.model_table(models, tests, tests.select("variant", F.lit(0).alias("needs")).distinct())
        outcome = F.round(finite(y), RANK_DIGITS).alias(y)
        held = known.where(finite(y).isNotNull()).join(F.broadcast(days), "dt")  # a row per date
        series = V.date_ics(held.select("_day", F.lit(0).alias("_missing"), outcome, *features), features, y, names, by_date)
        series = series.withColumn("fold_id", F.col("variant").cast(folds.schema["fold_id"].dataType))
        return E.mean_rank_ic(series, ["fold_id"]).withColumnRenamed("mean_ic", "ic")
    preds = oos_predictions(known, features, y, folds)
    series = E.ic_series(preds, "pred", y, ["fold_id"], group_bound)
    return E.mean_rank_ic(series, ["fold_id"]).withColumnRenamed("mean_ic", "ic")


def cpcv_summary(ics: DataFrame, n_groups: int, k_test: int) -> DataFrame:
    from math import comb

    paths = round(k_test / n_groups * comb(n_groups, k_test))
    return ics.agg(
        F.count("ic").alias("n_combos"),
        F.lit(paths).alias("n_paths"),
        F.avg("ic").alias("mean_ic"),
        F.stddev_samp("ic").alias("std_ic"),
        F.percentile("ic", 0.05).alias("p05_ic"),
        F.percentile("ic", 0.50).alias("p50_ic"),
        F.percentile("ic", 0.95).alias("p95_ic"),
        F.min("ic").alias("min_ic"),
        F.max("ic").alias("max_ic"),
        F.avg((F.col("ic") > 0).cast("double")).alias("frac_positive"),
    )


def horizon_curve(
    rows: DataFrame, features: list[str], horizons: list[int], n_folds: int = 5, min_test: int = 21,
    group_bound: int | None = None,
) -> DataFrame:
    """Leak-free read per horizon: each one has its own purge, so folds are keyed by horizon. The inputs are
    written once for all horizons; what is read per horizon holds no inputs."""
    cols = {h: f"fwd_{h}" for h in horizons}
    known = cut_lineage(rows.dropna(subset=features).select("entity", "dt", *features, *cols.values()))
    folds = per_date = None
    for h, col in cols.items():
        own = known.where(finite(col).isNotNull())
        part = FD.expanding_folds(own, h, n_folds=n_folds, min_test=min_test).withColumn("horizon", F.lit(h))
        grams = G.gram_table(known, features, col, ["dt"]).withColumn("horizon", F.lit(h))
        folds = part if folds is None else folds.unionByName(part)
        per_date = grams if per_date is None else per_date.unionByName(grams)
    folds = cut_lineage(folds)
    k = len(features)
    train = per_date.join(folds.where("role = 'train'").drop("role"), ["horizon", "dt"])
    grams = train.groupBy("horizon", "fold_id").agg(*[F.sum(n).alias(n) for n in G.gram_names(k)])
    models = G.solve_rows(grams.where("n >= 50"), ["horizon", "fold_id"], k)
    # per date a row for each horizon that tests it
    tests = F.broadcast(folds.where("role = 'test'").drop("role"))
    actual = F.coalesce(*[F.when(F.col("horizon") == h, F.col(col)) for h, col in cols.items()])
    held = known.join(tests, "dt").withColumn("actual", actual).where(finite("actual").isNotNull())
    preds = G.score_linear(held, models, features, ["horizon", "fold_id"])
    return oos_read(preds, "actual", ["horizon"], group_bound=group_bound)


def feature_variants(
    rows: DataFrame, features: list[str], y: str, forward: int, variants: dict[str, list[str]],
    n_folds: int = 5, min_test: int = 21, group_bound: int | None = None,
) -> DataFrame:
    """Leak-free read per named feature subset, each on the rows that know all of its own features.

    Cross products are summed per date and pattern of missing features, a missing value counting as 0; a
    subset adds up the patterns that lack none of its features and selects its rows and columns. Its
    folds follow its own dates.
    """
    spark = rows.sparkSession
    k = len(features)
    missing = F.lit(0).cast("long")
    for i, f in enumerate(features):
        missing = missing + F.when(finite(f).isNull(), F.lit(1 << i)).otherwise(0)
    known = rows.where(finite(y).isNotNull()).select("entity", "dt", y, missing.alias("_missing"), *[F.coalesce(finite(f), F.lit(0.0)).alias(f) for f in features])
    known = cut_lineage(known)
    table = F.broadcast(spark.createDataFrame(  # one row per variant
        [(name, [features.index(f) for f in use], sum(1 << features.index(f) for f in use)) for name, use in variants.items()],
        "variant string, use array<int>, needs long",
    ))
    admits = F.col("_missing").bitwiseAND(F.col("needs")) == 0
    per_date = cut_lineage(G.gram_table(known, features, y, ["dt", "_missing"]))
    per_date = per_date.join(table, admits).groupBy("variant", "dt").agg(*[F.sum(n).alias(n) for n in G.gram_names(k)])
    per_date = cut_lineage(per_date)
    folds = cut_lineage(FD.expanding_folds(per_date.select("variant", "dt"), forward, n_folds=n_folds, min_test=min_test, by=["variant"]))
    train = per_date.join(folds.where("role = 'train'").drop("role"), ["variant", "dt"])
    grams = train.groupBy("variant", "fold_id").agg(*[F.sum(n).alias(n) for n in G.gram_names(k)]).where("n >= 50")
    models = G.solve_rows(grams.join(table, "variant"), ["variant", "fold_id"], k, "use")
    tests = folds.where("role = 'test'").drop("role")
    if fits_window(group_bound):
        models = cut_lineage(models)
        names, by_date, days = V.model_table(models, tests, table)
        placed, cuts, even = V.placed_rows(known, y, days)
        if even:
            series = V.date_ics(placed, features, y, names, by_date)
            pooled = V.pooled_ics(placed, features, y, names, by_date, cuts).withColumnRenamed("ic", "pooled_ic")
            out = pooled.join(E.mean_rank_ic(series, ["variant"]).withColumnRenamed("mean_ic", "xsec_ic"), "variant", "left")
            return out.withColumn("status", F.when(F.col("n") < 10, "insufficient_folds").otherwise("ok"))
    # cross-sections beyond a task, or outcomes that many rows share: a row per variant
    tests = F.broadcast(tests.join(table.drop("use"), "variant"))
    held = known.join(tests, "dt").where(admits)
    preds = G.score_linear(held, models, features, ["variant", "fold_id"])
    return oos_read(preds, y, ["variant"], group_bound=group_bound)


def leave_one_out(rows: DataFrame, features: list[str], y: str, forward: int, **kw) -> DataFrame:
    """Full model and every model without one feature, with the IC the feature adds."""
    variants = {"full": features} | {f"without_{f}": [g for g in features if g != f] for f in features}
    reads = cut_lineage(feature_variants(rows, features, y, forward, variants, **kw))
    full = reads.where("variant = 'full'").select(F.col("xsec_ic").alias("_full"))
    return reads.crossJoin(F.broadcast(full)).withColumn("ic_added", F.col("_full") - F.col("xsec_ic")).drop("_full")


def add_one_in(rows: DataFrame, base: list[str], extra: list[str], y: str, forward: int, **kw) -> DataFrame:
    variants = {"base": base} | {f"with_{f}": [*base, f] for f in extra}
    return feature_variants(rows, [*base, *extra], y, forward, variants, **kw)


ROUNDS = 4


def shuffled_places(place: np.ndarray, n: int, key: int) -> np.ndarray:
    """A bijection of 0 .. n - 1, another for each ``key``: Feistel rounds on the quotient and the remainder by the
    root of n, repeated from where they lead while that is n or more (cycle walking)."""
    side = isqrt(max(n, 1) - 1) + 1

    def rounds(at: np.ndarray) -> np.ndarray:
        left, right = at // side, at % side
        for k in range(ROUNDS):
            v = (right * MIX_A + k * MIX_STEP + key) % MIX_MOD
            v = (v ^ (v >> 15)) * MIX_B % MIX_MOD
            left, right = right, (left + (v ^ (v >> 13))) % side
        return left * side + right

    out = rounds(place)
    beyond = np.flatnonzero(out >= n)
    while len(beyond):
        out[beyond] = rounds(out[beyond])
        beyond = beyond[out[beyond] >= n]
    return out


def shuffled_place(place: Column, n: int, key: int) -> Column:
    """The same of a column: whole batches at a time."""

    @F.pandas_udf(T.LongType())
    def at(places: pd.Series) -> pd.Series:
        return pd.Series(shuffled_places(places.to_numpy(), n, key))

    return at(place)


def permutation_importance(
    scored: DataFrame, models: DataFrame, features: list[str], y: str, pred: str = "pred"
) -> DataFrame:
    """(feature, ic_drop): loss of in-sample IC when one column is shuffled.

    Rows are numbered once, by (dt, entity); a keyed bijection of the numbers says where a row's value of each
    feature goes, so that all features take one sort and one join of narrow rows.
    """
    model = models.select("coef")
    thin = cut_lineage(scored.select(*[finite(f).alias(f) for f in features], y, pred, "entity", F.unix_date("dt").cast("double").alias("_day")))
    n = thin.count()
    base = cut_lineage(
        order_number(thin, [], "_day", "entity", "_pos", digits=None, staged=True).withColumn("_pos", F.col("_pos").cast("long") - 1)
    )
    places = base.select("_pos", *features, *[shuffled_place(F.col("_pos"), n, i).alias(f"_at{i}") for i in range(len(features))])
    sent = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_at{i}").alias("_pos"), F.col(f).alias("_x")) for i, f in enumerate(features)])
    donors = places.select(F.explode(sent).alias("s")).select("s.*")
    mixed = base.join(donors, "_pos").crossJoin(F.broadcast(model)).withColumn(
        "_p", F.col(pred) + F.get("coef", F.col("i")) * (F.col("_x") - F.get(F.array(*features), F.col("i")))
    )
    drop = mixed.groupBy("i").agg(
        (safe_corr(F.col(pred), F.col(y)) - F.coalesce(safe_corr(F.col("_p"), F.col(y)), F.lit(0.0))).alias("ic_drop")
    )
    return drop.select(F.get(F.array(*[F.lit(f) for f in features]), F.col("i")).alias("feature"), "ic_drop")


# --- scoring --------------------------------------------------------------------------------------


def score_versions(rows: DataFrame, versions: DataFrame, features: list[str], clip: float) -> DataFrame:
    """Every registered version on the same inputs in one pass. versions: (version_id, coef,
    intercept); up to ``BROADCAST_VERSIONS`` of them are broadcast."""
    slots = cut_lineage(versions.select("version_id", "coef", "intercept"))
    joined = rows.crossJoin(F.broadcast(slots) if slots.count() <= BROADCAST_VERSIONS else slots)
    alpha = X.clip_col(G.linear_value(features), clip)
    out = joined.withColumn("predicted_alpha", alpha).drop("coef", "intercept")
    return out.withColumns(X.to_probability(F.col("predicted_alpha"), clip))
