"""Pair moments, isotonic blocks, keyed shuffles and the greedy walk against numpy and plain loops."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelith.operators import correlation as C
from panelith.operators import isotonic as I
from panelith.operators import models as M
from panelith.operators import windows as W


def test_pairwise_complete_correlations_equal_numpy(spark):
    """Gaps, infinities, a constant column, a far-off mean and an empty column, over seven partitions."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    x[:, 1] = 1e8 + 0.5 * x[:, 0] + x[:, 1]
    x[:, 3] = 0.1
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 4] = np.nan
    x[5, 0] = np.inf
    names = list("abcde")
    rows = spark.createDataFrame([tuple(float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names)).repartition(7)
    got = {(r.a, r.b): r for r in C.pair_moments(rows, names).collect()}
    corr = {(r.a, r.b): r["corr"] for r in C.pair_correlation(rows, names).collect()}
    cov = {(r.a, r.b): r["cov"] for r in C.pair_covariance(rows, names).collect()}
    assert len(got) == len(corr) == len(cov) == 25
    x[5, 0] = np.nan
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert got[a, b].n == both.sum()
            if "e" in (a, b):
                assert corr[a, b] is None and cov[a, b] is None
                continue
            u, v = x[both, i], x[both, j]
            if "d" in (a, b):
                assert corr[a, b] is None
            else:
                assert corr[a, b] == pytest.approx(np.corrcoef(u, v)[0, 1], abs=1e-7)
                assert cov[a, b] == pytest.approx(np.cov(u, v)[0, 1], abs=1e-7)


def test_many_columns_plan_and_an_empty_table(spark):
    k = 300
    wide = spark.range(200).select(*[F.sin(F.col("id") * (i + 1)).alias(f"f{i}") for i in range(k)])
    assert C.pair_correlation(wide, wide.columns).where("corr IS NOT NULL").count() == k * k
    none = C.pair_correlation(wide.limit(0), ["f0", "f1"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)


def isotonic(points):
    """The max-min formula, quadratic."""
    xs = sorted({x for x, _ in points})
    w = np.array([sum(1 for x, _ in points if x == v) for v in xs], float)
    s = np.array([sum(y for x, y in points if x == v) for v in xs])
    cw, cs = np.concatenate([[0], w.cumsum()]), np.concatenate([[0], s.cumsum()])
    n = len(xs)
    means = [[(cs[b + 1] - cs[a]) / (cw[b + 1] - cw[a]) if b >= a else np.inf for b in range(n)] for a in range(n)]
    return np.array(xs), np.array([max(min(means[a][b] for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


@pytest.mark.parametrize("kind", ["noisy", "rising", "falling", "one value"])
def test_isotonic_blocks_equal_the_max_min_formula(spark, kind):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=150), 2)
    y = {"noisy": (rng.random(150) < 1 / (1 + np.exp(-x))).astype(float), "rising": x, "falling": -x, "one value": x}[kind]
    if kind == "one value":
        x = np.zeros(150)
    points = [(float(a), float(b)) for a, b in zip(x, y)]
    rows = spark.createDataFrame([*points, (None, 1.0), (0.0, None)], "x double, y double").repartition(5)
    blocks = I.isotonic_blocks(rows, "x", "y")
    table = sorted(tuple(r) for r in blocks.collect())
    assert all(a[3] < b[3] and a[1] < b[0] for a, b in zip(table, table[1:]))
    xs, want = isotonic(points)
    curve = I.isotonic_curve(blocks)
    asked = spark.createDataFrame([(float(v),) for v in xs], "x double")
    got = dict(asked.select("x", curve(F.col("x")).alias("p")).collect())
    assert [got[v] for v in xs] == pytest.approx(list(want))
    ends = spark.createDataFrame([(-99.0,), (99.0,), (None,)], "x double").select("x", curve(F.col("x")).alias("p")).collect()
    assert {r.x: r.p for r in ends} == {-99.0: pytest.approx(want[0]), 99.0: pytest.approx(want[-1]), None: None}


def test_isotonic_without_rows(spark):
    rows = spark.createDataFrame([], "x double, y double")
    curve = I.isotonic_curve(I.isotonic_blocks(rows, "x", "y"))
    assert spark.createDataFrame([(1.0,)], "x double").select(curve(F.col("x"))).first()[0] is None


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_shuffled_places_are_a_bijection(spark, n):
    out = spark.range(n).select(*[M.shuffled_place(F.col("id"), n, k).alias(f"k{k}") for k in range(3)]).toPandas()
    for k in range(3):
        assert sorted(out[f"k{k}"]) == list(range(n))
    if n == 1000:
        assert abs(np.corrcoef(np.arange(n), out["k0"])[0, 1]) < 0.1
        assert (out["k0"] != out["k1"]).mean() > 0.95


def test_greedy_walk_keeps_what_a_loop_keeps(spark):
    rng = np.random.default_rng(4)
    start = dt.date(2020, 1, 1)
    days = sorted({int(d) for d in rng.integers(0, 900, 300)} | {0, 400, 401})
    rows = spark.createDataFrame([(start + dt.timedelta(d), e) for d in days for e in (1, 2)] + [(None, 1)], "dt date, entity int")
    got = W.nonoverlap_dates(rows, [1, 7, 28, 91]).collect()
    for gap in (1, 7, 28, 91):
        kept = []
        for d in days:
            if not kept or d - kept[-1] >= gap:
                kept.append(d)
        assert sorted((r.dt - start).days for r in got if r.gap == gap) == kept
    assert W.nonoverlap_dates(rows.limit(0), [7]).count() == 0


def test_composite_does_not_look_ahead(spark):
    """Later rows, however wild, change no earlier score; a constant past scores 0."""
    start = dt.date(2020, 1, 1)
    rng = np.random.default_rng(6)
    name = next(iter(W.COMPOSITE_WEIGHTS))
    calm = [(start + dt.timedelta(i), 5.0 + 1e-6 * float(rng.normal()) * (i >= 10)) for i in range(60)]
    wild = [(start + dt.timedelta(60 + i), float(1e6 * rng.normal())) for i in range(20)]
    score = lambda rows: {r["dt"]: r["intensity_z"] for r in W.composite_intensity(
        spark.createDataFrame(rows, f"dt date, {name} double"), {name: 1.0}, 30).collect()}
    short, whole = score(calm), score(calm + wild)
    assert all(short[d] == pytest.approx(whole[d], abs=1e-9) for d in short)
    assert all(short[start + dt.timedelta(i)] == 0 for i in range(10))
    values = np.array([v for _, v in calm])
    last = values[30:60]
    assert short[start + dt.timedelta(59)] == pytest.approx((last[-1] - last.mean()) / last.std(), rel=1e-3)
