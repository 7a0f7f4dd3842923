"""Hand-made tables for the rules that are easy to get wrong."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.ranks import exact_quantiles, order_number, rank_table, tie_rank
from panelith.operators import drift as D
from panelith.operators import evaluation as E
from panelith.operators import folds as FD
from panelith.operators import gram as G
from panelith.operators import joins as J
from panelith.operators import labels as L
from panelith.operators import models as M
from panelith.operators import states as S
from panelith.operators import windows as W
from panelith.operators.align import align_benchmark
from panelith.plans.base import features
from panelith.sources import files as FS

DAY = dt.date(2024, 1, 1)


def day(i):
    return DAY + dt.timedelta(days=i)


def series(spark, values, entity=1, name="close"):
    rows = [(entity, day(i), float(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"entity long, dt date, {name} double")


def test_rank_normalize_ties_and_missing(spark):
    rows = [(1, 1.0), (2, 1.0), (3, 0.0), (4, None), (5, float("nan"))]
    df = spark.createDataFrame([(e, DAY, v) for e, v in rows], "entity long, dt date, f double")
    for bound in (10, None):
        out = {r.entity: r.f for r in W.rank_normalize(df, ["f"], bound).collect()}
        assert out == {1: 0.75, 2: 0.75, 3: 0.0, 4: 0.5, 5: 0.5}


def test_single_finite_value_is_neutral(spark):
    df = spark.createDataFrame([(1, DAY, 3.0), (2, DAY, None)], "entity long, dt date, f double")
    assert {r.f for r in W.rank_normalize(df, ["f"], None).collect()} == {0.5}


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_ranks_without_bound_equal_pandas(spark, partitions):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 3000), "id": np.arange(3000), "v": rng.normal(size=3000).round(2)})
    pdf.loc[:999, "v"] = 0.25  # a third of all rows tie
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = tie_rank(spark.createDataFrame(pdf), ["k"], "v", "r", "n").toPandas().sort_values("id")
        num = order_number(spark.createDataFrame(pdf), ["k"], "v", "id", "rn").toPandas().sort_values("id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = pdf.groupby("k")["v"].rank()
    assert np.allclose(got["r"], want)
    assert (got["n"].to_numpy() == pdf.groupby("k")["v"].transform("size").to_numpy()).all()
    order = pdf.sort_values(["k", "v", "id"]).groupby("k").cumcount() + 1
    assert (num.set_index("id")["rn"] == order.sort_index()).all()


def test_exact_quantiles(spark):
    v = np.random.default_rng(2).normal(size=501)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    got = exact_quantiles(df, [], "v", [0.0, 0.2, 0.5, 0.9, 1.0]).first()
    assert np.allclose(list(got), np.quantile(v, [0.0, 0.2, 0.5, 0.9, 1.0]))


def test_first_touch_looks_up_before_down_and_tail(spark):
    rows = series(spark, [0.0, 0.02, -0.05, 0.01, 0.01], name="r").withColumn("b", F.lit(0.02))
    out = [r.tb_alpha for r in L.triple_barrier_alpha(rows, "r", 2, "b").orderBy("dt").collect()]
    assert out[0] == 0.02 and out[1] == -0.02 and out[2] == pytest.approx(0.02) and out[3:] == [None, None]
    touch = [r.tb_touch for r in L.triple_barrier_touch(rows, "r", 2, "b").orderBy("dt").collect()]
    assert touch == [1.0, 0.0, 1.0, None, None]
    cls = [r.tb_class for r in L.triple_barrier_class(rows, "r", 2, 0.05, 0.05).orderBy("dt").collect()]
    assert cls[0] == 0 or cls[0] == 1
    assert cls[3:] == [-1, -1]


def test_uniqueness_weights(spark):
    df = spark.createDataFrame([(1, 0, 5), (2, 10, 5), (3, 10, 5), (4, 10, 5)], "id int, start int, length int")
    out = {r.id: r.weight for r in L.uniqueness_weights(df).collect()}
    assert out[1] == 1.0 and all(out[i] == pytest.approx(1 / 3) for i in (2, 3, 4))


def test_alignment_modes(spark):
    panel = spark.createDataFrame([(1, day(i), "s", 1.0) for i in range(3)] + [(2, day(1), "none", 1.0)], "entity long, dt date, sector string, close double")
    bench = spark.createDataFrame([("s", day(0), 10.0), ("s", day(2), 12.0)], "sector string, dt date, bench_close double")
    market = spark.createDataFrame([(day(1), 99.0)], "dt date, market_close double")
    exact = {(r.entity, r.dt): r.bench for r in align_benchmark(panel, bench, market, "exact").collect()}
    filled = {(r.entity, r.dt): r.bench for r in align_benchmark(panel, bench, market, "ffill").collect()}
    assert exact[(1, day(1))] is None and filled[(1, day(1))] == 10.0
    assert exact[(2, day(1))] == 99.0


def test_drawdown_ladder_equals_sequential_walk(spark):
    rng = np.random.default_rng(3)
    parts = []
    for e in range(5):
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 200)))
        nav = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, 200)))
        nav[::17] = np.nan
        parts.append(pd.DataFrame({"entity": e, "dt": [day(i) for i in range(200)], "close": close, "nav": nav}))
    pdf = pd.concat(parts)
    df = spark.createDataFrame(pdf).withColumn("nav", F.when(~F.isnan("nav"), F.col("nav")))
    for bands in (S.DrawdownBands(), S.DrawdownBands(min_persist=2)):
        got = S.drawdown_tiers(df, bands).toPandas().sort_values(["entity", "dt"])
        for e, part in pdf.groupby("entity"):
            want, _ = S.tier_walk(part, bands)
            mine = got[got["entity"] == e]
            assert list(mine["tier"]) == list(want["tier"])
            assert list(mine["excess_tier"]) == list(want["excess_tier"])


def test_stretch_open_at_the_end(spark):
    out = S.drawdown_stretches(series(spark, [100, 89, 94, 96, 100, 80, 82])).orderBy("start_dt").collect()
    assert [(r.start_dt, r.end_dt) for r in out] == [(day(1), day(3)), (day(5), day(6))]


def test_change_point_posterior_against_direct_formula():
    prior = S.ChangePointPrior(hazard=0.1)
    post = S.RunLengthPosterior(prior)
    post.observe(0.7)
    a, b, k = 1.0, 1.0, 1.0
    scale = math.sqrt(b * (k + 1) / (a * k))
    t = math.gamma(a + 0.5) / (math.gamma(a) * math.sqrt(2 * a * math.pi) * scale) * (1 + (0.7 / scale) ** 2 / (2 * a)) ** -(a + 0.5)
    assert post.mass == pytest.approx([0.1, 0.9])
    assert t > 0 and post.mean[1] == pytest.approx(0.35)
    for x in np.random.default_rng(0).normal(size=50):
        post.observe(x)
    assert post.mass.sum() == pytest.approx(1.0)


def test_horizon_folds_the_tail():
    post = S.RunLengthPosterior(S.ChangePointPrior(horizon=5))
    for x in range(20):
        post.observe(0.1 * x)
    assert len(post.mass) == 5 and post.mass.sum() == pytest.approx(1.0)


def test_latch_needs_two_days_and_releases_slowly():
    rules, st = S.LatchRules(min_run=1), dict(S.NEW_LATCH)
    seen = []
    for z, c in [(-2, 0.9), (-2, 0.9), (-0.5, 0.1), (0, 0.1), (0, 0.1), (0, 0.1)]:
        st = S.latch_step(st, z, c, rules)
        seen.append(st["on"])
    assert seen == [False, True, True, True, True, False]


def test_dividend_factor_applies_to_earlier_bars_only(spark):
    prices = series(spark, [100, 100, 100])
    pay = spark.createDataFrame([(1, day(1), 10.0), (1, day(9), 50.0), (1, day(2), 500.0)], "entity long, ex_dt date, amount double")
    out = [r.adj_close for r in S.adjust_dividends(prices, pay).orderBy("dt").collect()]
    assert out == pytest.approx([90.0, 100.0, 100.0])


def test_cpcv_purge_and_embargo(spark):
    rows = spark.createDataFrame([(1, day(i)) for i in range(60)], "entity long, dt date")
    out = FD.cpcv_folds(rows, 3, 2, 6, 2).where("fold_id = 2").toPandas()  # groups 0 and 3
    idx = (pd.to_datetime(out["dt"]) - pd.Timestamp(DAY)).dt.days
    test, train = set(idx[out["role"] == "test"]), set(idx[out["role"] == "train"])
    assert test == set(range(0, 10)) | set(range(30, 40))
    assert train == set(range(12, 27)) | set(range(42, 60))


def test_expanding_folds_shrink(spark):
    rows = spark.createDataFrame([(1, day(i)) for i in range(70)], "entity long, dt date")
    out = FD.expanding_folds(rows, 2, n_folds=5, min_test=20).toPandas()
    assert set(out["fold_id"]) == {0, 1} or set(out["fold_id"]) == {1}
    assert not set(out[out.role == "train"].dt) & set(out[(out.role == "test") & (out.fold_id == out.fold_id.max())].dt)


def test_evidence_fit_recovers_coefficients(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = x @ [0.5, -1.0, 0.0] + 2 + rng.normal(0, 0.1, 400)
    pdf = pd.DataFrame({"entity": np.arange(400), "dt": DAY, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})
    m = G.fit_bayes_ridge(spark.createDataFrame(pdf), ["a", "b", "c"], "y").first()
    assert m.coef == pytest.approx([0.5, -1.0, 0.0], abs=0.03) and m.intercept == pytest.approx(2, abs=0.02)
    assert 1 / m.noise == pytest.approx(0.01, rel=0.3)


def test_bucket_calibrator_edges(spark):
    rows = spark.createDataFrame([(10.0, 1), (12.0, 0), (20.0, 0), (60.0, 1), (100.0, 0)], "s double, h int")
    table = M.fit_bucket_calibrator(rows, "s", "h")
    rate = {r.bucket: r.rate for r in table.collect()}
    assert rate[0] == pytest.approx(1 / 3) and rate[2] == pytest.approx(0.4)
    zero = M.fit_bucket_calibrator(rows.withColumn("h", F.lit(0)), "s", "h")
    assert M.apply_bucket_calibrator(rows.where("s = 100"), zero, "s").first().prob == 0.5


def test_constant_prediction_has_no_ic(spark):
    rows = spark.createDataFrame([(i, DAY, 1.0, float(i)) for i in range(20)], "entity long, dt date, p double, a double")
    assert E.pooled_rank_ic(rows, "p", "a").first().ic is None
    assert E.ic_series(rows, "p", "a", group_bound=100).count() == 0


def test_deflated_sharpe_against_closed_form(spark):
    m = spark.createDataFrame([(50, 0.05, 0.1, 0.0, 3.0)], "n long, mean double, std double, skew double, kurt double")
    r = E.deflated_sharpe(m, 1).first()
    z = 0.5 * 7 / math.sqrt(1 + 0.5 * 0.25)
    assert r.psr_vs_zero == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=1e-9)
    assert r.dsr == pytest.approx(r.psr_vs_zero)


def test_ks_constant_samples_and_floor(spark):
    flat = spark.createDataFrame([("f", 1.0)] * 40, "feature string, value double")
    assert D.ks_drift(flat, flat).first().ks == 0.0
    assert D.ks_drift(flat.limit(10), flat).count() == 0


def test_health_gate_counts_nan_but_not_null(spark):
    rows = [(DAY, v, 0.5) for v in [0.1, -0.1, 0.2, -0.2, float("nan"), float("nan"), None]]
    df = spark.createDataFrame(rows, "dt date, predicted_alpha double, p_up double")
    r = D.health_gate(df, ["dt"]).first()
    assert r.n_present == 6 and r.failed_check == "alpha_nonfinite_rate"


def test_upsert_is_case_insensitive(spark):
    old = spark.createDataFrame([(DAY, "ab", 0.1), (DAY, "c", 0.2)], "dt date, entity string, predicted_alpha double")
    new = spark.createDataFrame([(DAY, "AB", 0.3)], "dt date, entity string, predicted_alpha double")
    out = {r.entity: (r.predicted_alpha, r.combined_rank) for r in J.upsert_predictions(old, new, group_bound=10).collect()}
    assert out == {"AB": (0.3, 1), "c": (0.2, 2)}


def test_hard_failures(spark, tmp_path):
    one = spark.createDataFrame([(1, DAY)], "entity long, dt date")
    with pytest.raises(ValueError, match="duplicate key"):
        FS.assert_unique(one.union(one), ["entity", "dt"])
    with pytest.raises(ValueError, match="no prediction"):
        J.require_coverage(one, one.where("entity > 1"))
    with pytest.raises(ValueError, match="market series ends"):
        FS.assert_fresh(one, "2024-02-01")
    failed = spark.createDataFrame([(False,)], "passed boolean")
    with pytest.raises(ValueError, match="refused"):
        FS.write_predictions(one, str(tmp_path / "p"), "v", failed)
    assert FS.read_existing(spark, str(tmp_path / "none"), "2024-01-01").count() == 0


def test_regime_score_floor_and_missing_heads(spark):
    df = spark.createDataFrame(
        [(2.0, None, None, 0, None, None, False), (2.0, 1.0, 0.0, 0, "risk_on", "risk_on", True)],
        "intensity_z double, p_bull double, p_bear double, weeks_in_state int, tier string, excess_tier string, forced_bear boolean",
    )
    out = X.regime_score(df).collect()
    assert out[0].regime_score == pytest.approx(math.tanh(1.0)) and out[1].regime_score == -1.0


def test_no_look_ahead(spark, sf):
    """Cutting the input at a date changes no feature at or before it."""
    cut = "1998-01-05"
    rows = features(spark, sf)
    cols = ["mom_4", "ret_13", "vs_ma10", "rsi"]
    base = spark.createDataFrame(rows.select("entity", "dt", "close", "bench").toPandas())
    full = W.price_features(base, {"mom_4": 4, "ret_13": 13}, {"vs_ma10": 10}).where(F.col("dt") <= cut)
    part = W.price_features(base.where(F.col("dt") <= cut), {"mom_4": 4, "ret_13": 13}, {"vs_ma10": 10})
    key = ["entity", "dt"]
    a = full.select(*key, *cols).toPandas().sort_values(key).reset_index(drop=True)
    b = part.select(*key, *cols).toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
