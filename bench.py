"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to completion into a sink that discards rows, once to warm up and then timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from panelith.plans import load_registry
from panelith.session import build_session, clear_scratch

HEADLINE = [
    "price_panel", "mean_rank_ic", "align_benchmark_ffill", "price_features", "residual_momentum_features",
    "rank_normalize", "triple_barrier_alpha", "canonical_alpha", "uniqueness_weights", "macro_panel",
    "drawdown_tiers", "change_points", "adjust_dividends", "stance_loadings", "regime_score",
    "rescale_batch", "feature_ic", "decile_spread", "pooled_rank_ic", "ks_drift", "distribution_gate",
    "realized_alpha", "asof_snapshot", "upsert_predictions", "fit_bayes_ridge", "cpcv_ic",
    "leave_one_out", "factor_returns", "score_cross_section", "build_oos_rows", "stream_drawdown",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.log.level": "ERROR",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="panelith-bench-"),
        },
    )
    registry = load_registry()
    times: dict[str, float] = {}
    for name in names:
        for warm in (False, True):
            start = time.perf_counter()
            registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if warm:
                times[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "warm seconds over headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
