"""Scans, the grid bootstrap and per-variant reads against plain pandas and numpy."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelith.functions.scans import scan_states
from panelith.operators import bootstrap as B
from panelith.operators import evaluation as E
from panelith.operators import gram as G
from panelith.operators import labels as L
from panelith.operators import models as M
from panelith.operators import variants as V
from panelith.operators import states as S
from panelith.operators import windows as W


@pytest.fixture(scope="module")
def gappy(spark):
    rng = np.random.default_rng(0)
    rows = []
    for e in range(8):
        n = int(rng.integers(1, 200)) if e else 1
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
        for i in range(n):
            rows.append((e, i, float(close[i]) if e < 4 or rng.random() > 0.1 else None, float(rng.normal()) if rng.random() > 0.2 else None))
    return spark.createDataFrame(rows, "entity int, dt int, close double, v double")


def by_entity(df, column):
    pdf = df.toPandas().sort_values(["entity", "dt"])
    return {e: g[column].to_numpy(float) for e, g in pdf.groupby("entity")}


def test_weighted_deviation_equals_pandas(gappy):
    got = by_entity(L.ewm_std(gappy, "v"), "sigma")
    for e, v in by_entity(gappy, "v").items():
        want = pd.Series(v).ewm(span=20, min_periods=10).std()
        np.testing.assert_allclose(got[e], want, atol=1e-12)


def test_indicators_equal_pandas(gappy):
    out = W.ewm_indicators(gappy).toPandas().sort_values(["entity", "dt"])
    for e, c in by_entity(gappy, "close").items():
        c = pd.Series(c)
        gain = c.diff().clip(lower=0).ewm(com=13, adjust=False).mean()
        loss = (-c.diff().clip(upper=0)).ewm(com=13, adjust=False).mean()
        line = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
        mine = out[out.entity == e]
        np.testing.assert_allclose(mine.macd_line.to_numpy(float), line, atol=1e-10)
        np.testing.assert_allclose(mine.macd_signal.to_numpy(float), line.ewm(span=9, adjust=False).mean(), atol=1e-10)
        np.testing.assert_allclose(mine.ewm_rsi.to_numpy(float), 100 - 100 / (1 + gain / loss.where(loss > 0)), atol=1e-9)


@pytest.mark.parametrize("n", [5, 16, 23])
def test_states_equal_a_walk(spark, n):
    rng = np.random.default_rng(n)
    tables = [rng.integers(0, n, n).tolist() for _ in range(4)]
    symbols = {e: rng.integers(0, 4, size).tolist() for e, size in enumerate((1, 2, 31, 64, 65))}
    rows = spark.createDataFrame([(e, i, s) for e, x in symbols.items() for i, s in enumerate(x)], "entity int, dt int, symbol int")
    w = Window.partitionBy("entity").orderBy("dt")
    got = by_entity(scan_states(rows, w, F.col("symbol"), tables, 1, 65), "state")
    for e, x in symbols.items():
        state, want = 1, []
        for s in x:
            state = tables[s][state]
            want.append(state)
        assert got[e].tolist() == want


@pytest.mark.parametrize("m", [2, 3, 5])
def test_gated_ladder_equals_the_walk(spark, m):
    rng = np.random.default_rng(m)
    bands = S.DrawdownBands(min_persist=m)
    frames = []
    for e in range(6):
        n = int(rng.integers(1, 120))
        close, nav = (100 * np.exp(np.cumsum(rng.normal(0, 0.03, n))) for _ in range(2))
        nav[rng.random(n) < 0.15] = np.nan
        frames.append(pd.DataFrame({"entity": e, "dt": range(n), "close": close, "nav": nav}))
    got = S.drawdown_tiers(spark.createDataFrame(pd.concat(frames)), bands).toPandas().sort_values(["entity", "dt"])
    for e, part in enumerate(frames):
        want, _ = S.tier_walk(part, bands)
        mine = got[got.entity == e]
        assert mine.tier.tolist() == want.tier.tolist() and mine.excess_tier.tolist() == want.excess_tier.tolist()


def test_posteriors_together_equal_one_by_one():
    rng = np.random.default_rng(2)
    series = [rng.normal(size=n) for n in (1, 40, 7, 90, 40)]
    prior, hazards = S.ChangePointPrior(horizon=30), np.array([0.01, 0.02, 0.004, 0.1, 0.01])
    got = S.run_length_masses(series, hazards, prior, [3, 8])
    for x, h, out in zip(series, hazards, got):
        one = S.RunLengthPosterior(S.ChangePointPrior(hazard=h, horizon=30))
        for z, row in zip(x, out):
            one.observe(z)
            np.testing.assert_allclose(row, [one.short_mass(3), one.short_mass(8), one.top_mass()], rtol=1e-9)


@pytest.fixture(scope="module")
def pairs():
    rng = np.random.default_rng(0)
    n = 500
    pdf = pd.DataFrame({"g": rng.integers(0, 2, n), "dt": rng.integers(0, 11, n), "p": rng.normal(size=n).round(1), "a": rng.normal(size=n).round(2)})
    pdf.loc[rng.random(n) < 0.3, "p"] = 0.5  # one value very often
    pdf["a"] = (pdf.a + 0.3 * pdf.p).round(2)
    return pdf


@pytest.mark.parametrize("strip", [None, 200, 31])
def test_resampled_ranks_equal_repeated_rows(spark, pairs, strip):
    both = E.cut_lineage(spark.createDataFrame(pairs).groupBy("g", "dt", F.col("p").alias("_p"), F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("_c")))
    got = {(r.g, r.iter): r.ic for r in B.resampled_ics(both, ["g"], 25, 7, strip=strip).collect()}
    for g, x in pairs.groupby("g"):
        dates = sorted(x["dt"].unique())
        for i, times in enumerate(B.draw_counts(len(dates), np.arange(25), 7).astype(int)):
            assert times.sum() == len(dates)
            rows = pd.concat([x[x["dt"] == d] for d, t in zip(dates, times) for _ in range(t)])
            assert got[g, i] == pytest.approx(rows.p.rank().corr(rows.a.rank()), abs=1e-12)


def test_interval_of_a_thousand_draws(spark, pairs):
    got = E.bootstrap_ic_ci(spark.createDataFrame(pairs), "p", "a").first()
    dates = sorted(pairs["dt"].unique())
    ics = []
    for times in B.draw_counts(len(dates), np.arange(1000), 42).astype(int):
        rows = pairs.loc[pairs.index.repeat(times[pairs["dt"].map(dates.index)])]
        ics.append(rows.p.rank().corr(rows.a.rank()))
    assert got["n_usable"] == 1000
    np.testing.assert_allclose([got["ci_lo"], got["ci_hi"]], np.percentile(ics, [2.5, 97.5]), atol=1e-12)


def test_variants_use_their_own_rows(spark):
    rng = np.random.default_rng(5)
    names = ["a", "b", "c"]
    n_dates, n_names = 130, 14
    pdf = pd.DataFrame({"entity": np.tile(np.arange(n_names), n_dates), "dt": np.repeat(np.arange(n_dates), n_names)})
    for f in names:
        pdf[f] = rng.normal(size=len(pdf))
    pdf["y"] = 0.5 * pdf.a - 0.2 * pdf.b + rng.normal(size=len(pdf))
    pdf.loc[pdf["dt"] < 30, "b"] = np.nan
    pdf.loc[rng.random(len(pdf)) < 0.2, "c"] = np.nan
    rows = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).astype({"entity": int, "dt": int}), "entity int, dt int, a double, b double, c double, y double")
    got = {r["variant"]: r for r in M.leave_one_out(rows, names, "y", 4, min_test=10, group_bound=n_names).collect()}
    for variant, use in {"full": names, "without_b": ["a", "c"], "without_c": ["a", "b"], "without_a": ["b", "c"]}.items():
        mine = pdf.dropna(subset=[*use, "y"])
        dates = sorted(mine["dt"].unique())
        size = max(10, len(dates) // 6)
        preds = []
        for k in range(5):
            start = len(dates) - (5 - k) * size
            if start - 4 <= 10:
                continue
            train = mine[mine["dt"].isin(dates[: start - 4])]
            test = mine[mine["dt"].isin(dates[start : start + size])]
            row = {"w": len(train), "n": len(train), "y": train.y.sum(), "yy": (train.y**2).sum()}
            for i, f in enumerate(use):
                row |= {f"x{i}": train[f].sum(), f"xy{i}": (train[f] * train.y).sum()}
                row |= {f"xx{i}_{j}": (train[f] * train[use[j]]).sum() for j in range(i, len(use))}
            model = G.solve_evidence(row, list(range(len(use))), len(use))
            preds.append(test.assign(pred=model["intercept"] + test[use].to_numpy() @ np.array(model["coef"])))
        preds = pd.concat(preds)
        per_date = [g.pred.rank().corr(g.y.rank()) for _, g in preds.groupby("dt") if len(g) > 1]
        assert got[variant]["n"] == len(preds)
        assert got[variant]["xsec_ic"] == pytest.approx(np.mean(per_date), abs=1e-9)
        assert got[variant]["pooled_ic"] == pytest.approx(preds.pred.rank().corr(preds.y.rank()), abs=1e-9)


def test_variants_travel_as_one_row(spark, monkeypatch):
    """Many small pieces give what a row per variant gives, with ties, missing values and a table of copies."""
    rng = np.random.default_rng(6)
    n_dates, n_names = 70, 30
    pdf = pd.DataFrame({"entity": np.tile(np.arange(n_names), n_dates), "dt": np.repeat(np.arange(n_dates), n_names)})
    for f in "abc":
        pdf[f] = rng.integers(0, 4, len(pdf)).astype(float)
    pdf["y"] = (0.3 * pdf.a + rng.normal(size=len(pdf))).round(2)
    pdf.loc[rng.random(len(pdf)) < 0.3, "c"] = None
    pdf = pd.concat([pdf, pdf[pdf["dt"] % 7 == 0]])
    rows = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "entity long, dt int, a double, b double, c double, y double")
    kw = {"min_test": 8, "group_bound": n_names}
    monkeypatch.setattr(V, "PIECE_ROWS", 150)
    with monkeypatch.context() as m:
        m.setattr(M, "oos_read", None)  # the row per variant would be read here
        got = {r["variant"]: r for r in M.leave_one_out(rows, list("abc"), "y", 4, **kw).collect()}
    monkeypatch.setattr(M, "fits_window", lambda bound: False)
    want = {r["variant"]: r for r in M.leave_one_out(rows, list("abc"), "y", 4, **kw).collect()}
    assert got.keys() == want.keys() and len(want) == 4
    for variant, r in want.items():
        for c in ("n", "n_dates", "n_folds", "status"):
            assert got[variant][c] == r[c]
        for c in ("pooled_ic", "xsec_ic", "ic_added"):
            assert got[variant][c] == pytest.approx(r[c], abs=1e-9)


def test_horizons_share_the_inputs(spark, monkeypatch):
    """The inputs are written once for all horizons; each horizon reads what it reads alone."""
    rng = np.random.default_rng(8)
    n_dates, n_names = 90, 12
    pdf = pd.DataFrame({"entity": np.tile(np.arange(n_names), n_dates), "dt": np.repeat(np.arange(n_dates), n_names)})
    for f in "ab":
        pdf[f] = rng.normal(size=len(pdf))
    for h in (1, 4):
        pdf[f"fwd_{h}"] = 0.3 * pdf.a + rng.normal(size=len(pdf))
        pdf.loc[pdf["dt"] >= n_dates - h, f"fwd_{h}"] = None
    rows = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "entity long, dt int, a double, b double, fwd_1 double, fwd_4 double")
    written = []
    stage = M.cut_lineage
    monkeypatch.setattr(M, "cut_lineage", lambda df: written.append(df.columns) or stage(df))
    got = {r["horizon"]: r for r in M.horizon_curve(rows, ["a", "b"], [1, 4], min_test=8, group_bound=n_names).collect()}
    assert len([c for c in written if "a" in c]) == 1 and not [c for c in written if "a" in c and "horizon" in c]
    for h in (1, 4):
        want = M.leakfree_oos_ic(rows, ["a", "b"], f"fwd_{h}", h, min_test=8, group_bound=n_names).first()
        for c in ("n", "n_dates", "n_folds", "status"):
            assert got[h][c] == want[c]
        for c in ("pooled_ic", "xsec_ic"):
            assert got[h][c] == pytest.approx(want[c], abs=1e-9)


def test_long_strips_hold_every_row_once(spark):
    """Two packed strips and their matrices per date, against cumulative sums over the whole group."""
    rng = np.random.default_rng(3)
    n, n_dates = 3000, 5
    pdf = pd.DataFrame({"g": 0, "dt": rng.integers(0, n_dates, n), "_p": rng.normal(size=n), "_a": rng.normal(size=n), "_c": rng.integers(1, 3, n)})
    pdf["_a"] += pdf["_p"]
    both = E.cut_lineage(spark.createDataFrame(pdf))
    ics = [{r.iter: r.ic for r in B.resampled_ics(both, ["g"], 40, 7, strip=s).collect()} for s in (None, 700)]
    assert ics[0].keys() == ics[1].keys()
    for i, ic in ics[0].items():
        assert ics[1][i] == pytest.approx(ic, abs=1e-12)


def test_a_strip_is_shipped_packed(spark):
    """What stands before positions of a strip is looked up, on every boundary of the stored table."""
    rng = np.random.default_rng(4)
    date, count = rng.integers(0, 3, 1000).astype(np.uint16), rng.integers(1, 4, 1000)
    strip = B.LongStrip(date, count, np.array([5.0, 0.0, 7.0]))
    at = np.array([0, 1, B.STEP - 1, B.STEP, B.STEP + 1, 999, 1000])
    want = [np.bincount(date[:i], count[:i], minlength=3) + [5, 0, 7] for i in at]
    np.testing.assert_array_equal(strip.before(at), want)


@pytest.mark.parametrize("n_dates", [1, 5, 256, 257, 357, 70_000])
def test_packed_dates_come_back(n_dates):
    date = np.random.default_rng(n_dates).integers(0, n_dates, 1003)
    packed = B.packed_dates(date, n_dates)
    np.testing.assert_array_equal(B.unpacked_dates(packed, len(date), n_dates), date)
    assert len(packed) <= 1003 + 9 * 126


@pytest.mark.parametrize("whole", [True, False])
def test_battery_travels_once_for_all_scopes(spark, monkeypatch, whole):
    """Against repeated rows: ties, copies, missing values and dates, two regimes a date, a constant outcome. No row per
    horizon is written."""
    rng = np.random.default_rng(11)
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(30)]
    pdf = pd.DataFrame([(e, d) for d in [*dates, None] for e in range(30)], columns=["entity", "dt"])
    n = len(pdf)
    pdf["p"] = rng.normal(size=n).round(1)
    pdf["regime"] = np.where(rng.random(n) < 0.4, "bull", "bear")
    pdf.loc[pdf["dt"].isna(), "regime"] = None
    for h in (1, 4):
        pdf[f"fwd_{h}"] = (0.3 * pdf.p + rng.normal(size=n)).round(2)
        pdf.loc[rng.random(n) < 0.2, f"fwd_{h}"] = None
    pdf["fwd_8"] = 1.5
    pdf.loc[rng.random(n) < 0.05, "p"] = None
    pdf.loc[pdf["dt"] == dates[3], "fwd_4"] = None
    pdf = pd.concat([pdf, pdf[::9]], ignore_index=True)
    rows = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)],
                                 "entity long, dt date, p double, regime string, fwd_1 double, fwd_4 double, fwd_8 double")
    if not whole:
        for name, value in (("STRIP", 100), ("LONG_STRIP", 300), ("PIECE_ROWS", 90)):
            monkeypatch.setattr(B, name, value)
    written, stage = [], E.cut_lineage

    def noted(df):
        out = stage(df)
        if {"p", "_p", "actual", "_a"} & set(out.columns):
            written.append(out.count())
        return out

    for module in (E, B):
        monkeypatch.setattr(module, "cut_lineage", noted)
    got = {(r["horizon"], r["scope"]): r for r in E.horizon_battery(
        rows, "p", [1, 4, 8], "regime", 50, {1: 7, 4: 28, 8: 56}, nonoverlap_floor=3).collect()}
    assert max(written) <= len(pdf) and sum(written) < 2 * len(pdf)

    def ic(x, h):
        return x.p.rank().corr(x[f"fwd_{h}"].rank()) if x.p.nunique() > 1 and x[f"fwd_{h}"].nunique() > 1 else None

    def same(r, x, h, floor):
        want = ic(x, h) if len(x) >= floor else None
        assert r["n"] == len(x) and r["ic"] == (want if want is None else pytest.approx(want, abs=1e-9))

    scopes = set()
    for h in (1, 4, 8):
        known = pdf.dropna(subset=["p", f"fwd_{h}"])
        same(got[h, "overall"], known, h, 100)
        for x in ("bull", "bear"):
            same(got[h, x], known[known.regime == x], h, 30)
        same(got[h, None], known[known.regime.isna()], h, 30)
        kept, last = [], None
        for d in dates:
            if last is None or (d - last).days >= 7 * h:
                kept.append(d)
                last = d
        same(got[h, "nonoverlap"], known[known["dt"].isin(kept) & (known.entity == 0)], h, 3)
        # the missing date is drawn like any other
        by_date = [known[known["dt"].isna()], *[known[known["dt"] == d] for d in dates if (known["dt"] == d).any()]]
        ics = []
        for times in B.draw_counts(len(by_date), np.arange(50), 42).astype(int):
            ics.append(ic(pd.concat([x for x, t in zip(by_date, times) for _ in range(t)]), h))
        ends = [None, None] if h == 8 else [pytest.approx(v, abs=1e-9) for v in np.percentile(ics, [2.5, 97.5])]
        assert [got[h, "overall"]["ci_lo"], got[h, "overall"]["ci_hi"]] == ends
        assert all(got[h, x]["ci_lo"] is None for x in ("bull", "bear", None, "nonoverlap"))
        scopes |= {(h, x) for x in ("overall", "bull", "bear", None, "nonoverlap")}
    assert got.keys() == scopes


def test_battery_of_no_rows(spark):
    rows = spark.createDataFrame([], "entity long, dt date, p double, regime string, fwd_1 double")
    assert not E.horizon_battery(rows, "p", [1], "regime", 20, {1: 7}).collect()
