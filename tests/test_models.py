"""Fits without an SQL twin, checked against brute force or a naive predictor."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelith.operators import gram as G
from panelith.operators import models as M
from panelith.operators import states as S
from panelith.plans.evaluation import eval_rows
from panelith.plans.labels import zscores
from panelith.session import cut_lineage


@pytest.fixture(scope="module")
def rows(spark, sf):
    return cut_lineage(eval_rows(spark, sf).dropna(subset=["mom_4", "stale", "ret_13", "fwd_ret"]))


def test_permutation_importance_equals_its_expectation(rows):
    """A shuffled column keeps its spread but loses its covariance with the outcome."""
    names = ["mom_4", "stale"]
    models = G.fit_bayes_ridge(rows, names, "fwd_ret")
    scored = cut_lineage(G.score_linear(rows, models, names))
    out = M.permutation_importance(scored, models, names, "fwd_ret")
    drop = {r.feature: r.ic_drop for r in out.collect()}
    pdf, coef = scored.select(*names, "fwd_ret", "pred").toPandas(), models.first().coef
    base = np.corrcoef(pdf["pred"], pdf["fwd_ret"])[0, 1]
    for i, name in enumerate(names):
        j = 1 - i
        spread = np.sqrt(sum((c * pdf[f].std()) ** 2 for c, f in zip(coef, names)))
        left = coef[j] * np.cov(pdf[names[j]], pdf["fwd_ret"])[0, 1] / (spread * pdf["fwd_ret"].std())
        assert drop[name] == pytest.approx(base - left, abs=4 / np.sqrt(len(pdf)))
    assert drop["mom_4"] > drop["stale"]


def test_boosted_trees_beat_the_mean(rows):
    model, importance = M.fit_gbt(rows, ["mom_4", "ret_13"], "fwd_ret", F.col("dt") >= "2000-01-01", max_iter=5)
    scored = model.transform(M.assemble(rows, ["mom_4", "ret_13"])).withColumn("y", F.abs("fwd_ret"))
    mse = scored.agg(F.avg((F.col("y") - F.col("gbt_pred")) ** 2)).first()[0]
    assert mse < scored.agg(F.var_pop("y")).first()[0]
    assert sum(r.importance for r in importance.collect()) == pytest.approx(1.0)


def test_isotonic_calibration_lowers_the_error(rows):
    data = rows.withColumn("up", (F.col("fwd_ret") >= 0).cast("int")).withColumn("a", -F.col("mom_4"))
    _, before, after = M.fit_calibrator(data, "a", "up", "isotonic")
    assert after <= before


def test_leakfree_read_equals_numpy(spark, rows):
    names, fwd = ["mom_4", "stale"], 4
    pdf = rows.select("entity", "dt", *names, "fwd_ret").toPandas()
    dates = np.sort(pdf["dt"].unique())
    n = len(dates)
    size = max(21, n // 6)
    got = M.oos_predictions(rows, names, "fwd_ret", __import__("panelith.operators.folds", fromlist=["x"]).expanding_folds(rows, fwd))
    got = got.toPandas().set_index(["entity", "dt"])["pred"]
    for k in range(5):
        start = n - (5 - k) * size
        train = pdf[pdf["dt"].isin(dates[: start - fwd])]
        test = pdf[pdf["dt"].isin(dates[start : start + size])]
        x, y = train[names].to_numpy(), train["fwd_ret"].to_numpy()
        row = {"w": float(len(y)), "n": float(len(y)), "y": y.sum(), "yy": (y * y).sum()}
        for i in range(2):
            row[f"x{i}"], row[f"xy{i}"] = x[:, i].sum(), (x[:, i] * y).sum()
            for j in range(i, 2):
                row[f"xx{i}_{j}"] = (x[:, i] * x[:, j]).sum()
        m = G.solve_evidence(row, [0, 1], 2)
        want = test[names].to_numpy() @ np.array(m["coef"]) + m["intercept"]
        mine = got.loc[list(zip(test["entity"], test["dt"]))].to_numpy()
        assert np.allclose(mine, want)


def test_latch_grid_equals_plain_replay(spark, sf):
    z = cut_lineage(zscores(spark, sf))
    grid = S.latch_replays(z, hazards=(0.01,), min_runs=(5, 10), rules=S.LatchRules(floor=-0.5)).toPandas()
    one = z.where("entity = 1").toPandas().sort_values("dt")
    for run in (5, 10):
        post, st, want = S.RunLengthPosterior(S.ChangePointPrior(hazard=0.01)), dict(S.NEW_LATCH), []
        for v in one["z"]:
            post.observe(v)
            st = S.latch_step(st, v, post.short_mass(run), S.LatchRules(floor=-0.5, min_run=run))
            want.append(st["on"])
        mine = grid[(grid.entity == 1) & (grid.min_run == run)].sort_values("dt")["on"].tolist()
        assert mine == want


def test_meta_label_probabilities_rank_the_label(rows):
    data = rows.withColumn("down", (F.col("fwd_ret") < 0).cast("int"))
    score = M.fit_meta_label(data, ["mom_4", "ret_13"], "down")
    r = M.auc_brier(score(data), "prob", "down").first()
    assert r.auc > 0.55 and r.brier < 0.25


def test_state_classifier_probabilities_sum_to_one(rows):
    data = rows.withColumn("label", F.when(F.col("fwd_ret") < -0.2, 0).when(F.col("fwd_ret") > 0.2, 2).otherwise(1))
    out = M.fit_state_classifier(data, ["mom_4", "ret_13"], "label")(data)
    bad = out.where(F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-9)
    assert bad.count() == 0 and out.select("state").distinct().count() >= 2


def test_auc_matches_pair_counting(spark):
    pdf = pd.DataFrame({"p": [0.1, 0.4, 0.4, 0.8, 0.3], "y": [0, 0, 1, 1, 1]})
    got = M.auc_brier(spark.createDataFrame(pdf), "p", "y").first().auc
    pairs = [(a > b) + 0.5 * (a == b) for a in pdf.p[pdf.y == 1] for b in pdf.p[pdf.y == 0]]
    assert got == pytest.approx(np.mean(pairs))


def test_states_without_rows_have_probability_zero(spark):
    """Large markets move little: a label that no row has must not take its column away."""
    rows = spark.createDataFrame([(0.1 * i, 0.5, i % 2) for i in range(20)], "back double, breadth double, label int")
    got = M.fit_state_classifier(rows, ["back", "breadth"], "label", classes=3)(rows)
    assert {r.p2 for r in got.select("p2").collect()} == {0.0}


def test_cross_products_by_task_equal_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(G, "GRAM_ROWS", 3)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(200, 4)), columns=["a", "b", "y", "w"]).assign(k=rng.integers(0, 7, 200))
    pdf.loc[::9, "a"] = None
    rows = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    got = {r.k: r.asDict() for r in G.gram_table(rows, ["a", "b"], "y", ["k"], "w").collect()}
    known = pdf.dropna()
    for k, x in known.groupby("k"):
        row = got[k if k else None]
        assert row["n"] == len(x) and row["w"] == pytest.approx(x.w.sum())
        assert row["xx0_1"] == pytest.approx((x.w * x.a * x.b).sum()) and row["xy1"] == pytest.approx((x.w * x.b * x.y).sum())
    assert len(got) == known.k.nunique()
