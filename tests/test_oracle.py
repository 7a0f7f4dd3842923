"""A sample of registered queries against their SQL at the smallest scale (tools/check.py runs all)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

SAMPLE = [
    "mean_rank_ic", "align_benchmark_ffill", "residual_momentum_features", "rank_normalize",
    "triple_barrier_alpha", "canonical_alpha", "drawdown_tiers", "macro_weekly", "upsert_predictions",
    "leave_one_out", "ks_drift", "stream_bars", "fit_bayes_ridge", "factor_covariance", "estimator_oos_ic",
    "drawdown_tiers_gated", "change_points", "latch_grid", "ewm_indicators", "ewm_std", "score_cross_section",
    "feature_correlation", "nonoverlap_rows", "composite_intensity", "permutation_importance", "align_benchmark_exact",
]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert compare(got, want) == ""


def test_registry_is_complete():
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries)
    assert len(queries) > 180


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1
