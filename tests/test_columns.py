"""Reads of many columns, where a row travels once: against a row per column, with nulls, ties and several pieces."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from panelith.operators import evaluation as E
from panelith.operators import models as M
from panelith.operators import variants as V

FEATURES = ["f0", "f1", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 900
    start = dt.date(2020, 11, 2)
    pdf = pd.DataFrame({
        "entity": np.arange(n) % 30, "dt": [start + dt.timedelta(weeks=int(i) // 30) for i in range(n)],
        "f0": np.round(rng.normal(size=n), 1), "f1": rng.normal(size=n) * 1e6, "flat": 1.0, "y": rng.normal(size=n),
    })
    pdf.loc[::7, "f0"] = np.nan
    pdf.loc[::11, "f1"] = np.inf
    pdf.loc[::13, "y"] = np.nan
    pdf["fold"] = [d.year for d in pdf["dt"]]
    return spark.createDataFrame(pdf)


def same(a, b, keys):
    a, b = (x.toPandas().sort_values(keys, ignore_index=True) for x in (a, b))
    assert len(a) and len(a) == len(b)
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c], b[c], rtol=1e-9, atol=1e-12)
        else:
            assert a[c].tolist() == b[c].tolist()


def no_long_form(*_, **__):
    raise AssertionError("a row per column")


def test_series_of_columns(rows, monkeypatch):
    long = E.ic_series(E.long_features(rows, FEATURES, ["entity", "dt", "y"]), "value", "y", ["feature"], 30)
    monkeypatch.setattr(E, "long_features", no_long_form)
    same(E.feature_ic_series(rows, FEATURES, "y", 30), long.select("feature", "dt", "ic", "n"), ["feature", "dt"])
    same(E.feature_ic(rows, FEATURES, "y", 30), E.mean_rank_ic(long, ["feature"]), ["feature"])


def test_pooled_reads_of_columns(rows, monkeypatch):
    monkeypatch.setattr(V, "PIECE_ROWS", 100)
    long = E.realized_read(E.long_features(rows, FEATURES, ["dt", "y"]), "value", "y", ["feature"])
    monkeypatch.setattr(E, "long_features", no_long_form)
    same(E.realized_reads(rows, FEATURES, "y"), long, ["feature"])


def test_pooled_reads_of_shared_outcomes(spark, rows, monkeypatch):
    monkeypatch.setattr(V, "PIECE_ROWS", 100)
    tied = rows.selectExpr("dt", "f0", "f1", "flat", "CAST(y > 0 AS DOUBLE) AS y")
    long = E.realized_read(E.long_features(tied, FEATURES, ["dt", "y"]), "value", "y", ["feature"])
    same(E.realized_reads(tied, FEATURES, "y"), long, ["feature"])


def test_folds_of_columns(rows, monkeypatch):
    monkeypatch.setattr(V, "PIECE_ROWS", 100)
    wide = E.feature_fold_ic(rows, FEATURES, "y")
    monkeypatch.setattr(V, "pooled_column_ics", lambda *_: None)
    same(wide, E.feature_fold_ic(rows, FEATURES, "y"), ["feature"])
    monkeypatch.undo()
    monkeypatch.setattr(E, "long_features", no_long_form)
    assert E.feature_fold_ic(rows, FEATURES, "y").count() == 3


def test_combinations_read_a_row_once(rows, monkeypatch):
    clean = rows.selectExpr("entity", "dt", "coalesce(f0, 0) AS f0", "f1 / 1e6 AS f1", "y").where("f1 < 1e9")
    many = M.cpcv_ic(clean, ["f0", "f1"], "y", 1)
    monkeypatch.setattr(M, "oos_predictions", no_long_form)
    same(M.cpcv_ic(clean, ["f0", "f1"], "y", 1, group_bound=30), many, ["fold_id"])
