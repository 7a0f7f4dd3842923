"""Rank correlations, bootstrap intervals, deciles, Sharpe statistics and selection rules."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions.columns import RANK_DIGITS, finite, guarded_corr, ratio, safe_corr
from panelith.functions.ranks import fits_window, join_same, order_number, pooled_ranks, tie_rank
from panelith.operators import variants as V
from panelith.operators.bootstrap import MIX_A, MIX_B, MIX_MOD, draw_counts, resampled_ics, weighted_ics
from panelith.operators.correlation import pair_correlation
from panelith.operators.windows import nonoverlap_dates
from panelith.session import cut_lineage

EULER_GAMMA = 0.5772156649015329


# --- correlation ------------------------------------------------------------------------------


def parity_ic(
    pairs: DataFrame, baseline: str, variant: str, realized: str = "realized_alpha", floor: int = 10,
    by: list[str] | None = None,
) -> DataFrame:
    """Pearson of two streams with the outcome over the rows where all three are known."""
    rows = pairs.withColumns({c: finite(c) for c in (baseline, variant, realized)})
    rows = rows.dropna(subset=[baseline, variant, realized])
    return rows.groupBy(*(by or [])).agg(
        guarded_corr(baseline, realized, floor).alias("baseline_ic"),
        guarded_corr(variant, realized, floor).alias("variant_ic"),
        F.count(F.lit(1)).alias("n_pairs"),
    )


def rank_ic(
    rows: DataFrame, keys: list[str], pred: str, actual: str, floor: int = 2,
    group_bound: int | None = None,
) -> DataFrame:
    """(keys, ic, n): Spearman correlation per group of the rows with both values; NULL below the
    floor or when a side is constant. Without a bound on the group the ranks are shifted over pieces."""
    both = rows.select(*keys, finite(pred).alias("_p"), finite(actual).alias("_a")).dropna(
        subset=["_p", "_a"]
    )
    if fits_window(group_bound):
        both = tie_rank(both, keys, "_p", "_rp", group_bound=group_bound)
        both = tie_rank(both, keys, "_a", "_ra", group_bound=group_bound)
    else:
        both = pooled_ranks(cut_lineage(both), keys, {"_p": "_rp", "_a": "_ra"})
    return both.groupBy(*keys).agg(
        guarded_corr("_rp", "_ra", floor).alias("ic"), F.count(F.lit(1)).alias("n")
    )


def slice_ic(
    pairs: DataFrame, variant: str, slice_col: str, realized: str = "realized_alpha", floor: int = 10
) -> DataFrame:
    """Rank IC per slice value; a slice may be any share of the rows."""
    known = pairs.where(F.col(slice_col).isNotNull())
    return rank_ic(known, [slice_col], variant, realized, floor)


def ic_series(
    rows: DataFrame, pred: str, actual: str, by: list[str] | None = None,
    group_bound: int | None = None, dt: str = "dt",
) -> DataFrame:
    """Cross-sectional rank IC per date; dates that cannot be measured drop out."""
    keys = [*(by or []), dt]
    return rank_ic(rows, keys, pred, actual, 2, group_bound).where("ic IS NOT NULL")


def mean_rank_ic(series: DataFrame, by: list[str] | None = None) -> DataFrame:
    return series.groupBy(*(by or [])).agg(
        F.avg("ic").alias("mean_ic"), F.count(F.lit(1)).alias("n_dates")
    )


def pooled_rank_ic(
    rows: DataFrame, pred: str, actual: str, by: list[str] | None = None, floor: int = 10
) -> DataFrame:
    return rank_ic(rows, by or [], pred, actual, floor)


def iso_week(dt: str = "dt") -> Column:
    return F.extract(F.lit("YEAROFWEEK"), F.col(dt)) * 100 + F.weekofyear(dt)


def realized_read(
    rows: DataFrame, pred: str, actual: str, by: list[str] | None = None, floor: int = 10
) -> DataFrame:
    """Pooled rank IC of matured pairs with their number and the distinct ISO weeks they cover."""
    keys = by or []
    known = finite(pred).isNotNull() & finite(actual).isNotNull()
    matured = cut_lineage(rows.where(known).select(*keys, "dt", pred, actual))
    ic = pooled_rank_ic(matured, pred, actual, keys, floor)
    weeks = matured.groupBy(*keys).agg(F.countDistinct(iso_week()).alias("n_weeks"))
    return ic.join(weeks, keys) if keys else ic.crossJoin(weeks)


def long_features(rows: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    return rows.select(*keep, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        keep, features, "feature", "value"
    )


def feature_ic_series(
    rows: DataFrame, features: list[str], actual: str, group_bound: int | None = None
) -> DataFrame:
    """(feature, dt, ic, n): every feature's cross-sectional rank IC per date; dates that cannot be measured drop out.
    Cross-sections beyond a task go through the long form, a row per feature."""
    if fits_window(group_bound):
        return V.column_ics(rows, features, actual)
    return ic_series(long_features(rows, features, ["entity", "dt", actual]), "value", actual, ["feature"], group_bound)


def realized_reads(rows: DataFrame, features: list[str], actual: str) -> DataFrame:
    """``realized_read`` of every feature: (feature, ic, n, n_weeks). A row travels once for all features."""
    known = cut_lineage(V.known_columns(rows, features, actual, ["dt", F.lit(0).alias("_day")]))
    ics = V.pooled_column_ics(known, features)
    if ics is None:
        return realized_read(long_features(rows, features, ["dt", actual]), "value", actual, ["feature"])
    has = [F.max((F.col("_missing").bitwiseAND(1 << i) == 0).cast("int")).alias(f"_{i}") for i in range(len(features))]
    seen = F.filter(F.array(*[F.when(F.col(f"_{i}") == 1, F.lit(f)) for i, f in enumerate(features)]), lambda f: f.isNotNull())
    # a row per date
    dates = known.groupBy("dt").agg(*has).select("dt", F.explode(seen).alias("feature"))
    weeks = dates.groupBy("feature").agg(F.countDistinct(iso_week()).alias("n_weeks"))
    return ics.drop("_day").join(weeks, "feature")


def feature_ic(
    rows: DataFrame, features: list[str], actual: str, group_bound: int | None = None
) -> DataFrame:
    """Every feature's own mean cross-sectional IC."""
    return mean_rank_ic(feature_ic_series(rows, features, actual, group_bound), ["feature"])


def prune_features(ics: DataFrame, features: list[str], noise: float) -> DataFrame:
    """keep/drop per feature; unmeasurable ones stay, and nothing goes if everything would go."""
    spark = ics.sparkSession
    names = spark.createDataFrame([(f,) for f in features], "feature string")
    rows = names.join(ics, "feature", "left")
    weak = F.coalesce(F.abs(F.round("mean_ic", 10)) < noise, F.lit(False))
    # one row per feature
    all_weak = F.min(weak.cast("int")).over(Window.partitionBy(F.lit(1))) == 1
    return rows.withColumns(
        {
            "kept": ~weak | all_weak,
            "reason": F.when(F.col("mean_ic").isNull(), "ic_unmeasurable")
            .when(all_weak, "all_below_threshold_prune_skipped")
            .when(weak, "below_ic_noise_threshold")
            .otherwise("above_ic_noise_threshold"),
        }
    )


def decile_spread(
    rows: DataFrame, pred: str, actual: str, bins: int = 10, min_names: int = 10,
    group_bound: int | None = None,
) -> DataFrame:
    """(bin, mean_actual, n_dates): per date and bin the mean outcome, then the mean over dates."""
    both = rows.select("entity", "dt", finite(pred).alias("_p"), finite(actual).alias("_a")).dropna()
    # predictions are worked out once, for the sizes and for the ranks
    both = cut_lineage(both)
    sizes = both.groupBy("dt").agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_pop("_p").alias("_sp"), F.stddev_pop("_a").alias("_sa")
    ).where(f"_n >= {max(min_names, bins)} AND _sp >= 1e-12 AND _sa >= 1e-12").drop("_sp", "_sa")
    ranked = order_number(both.join(sizes, "dt"), ["dt"], "_p", "entity", "_r", group_bound=group_bound)
    slot = F.floor((F.col("_r") - 1) * bins / F.col("_n")).cast("int")
    per_date = ranked.withColumn("bin", slot).groupBy("dt", "bin").agg(F.avg("_a").alias("_m"))
    return per_date.groupBy("bin").agg(
        F.avg("_m").alias("mean_actual"), F.count(F.lit(1)).alias("n_dates")
    )


def decile_summary(spread: DataFrame) -> DataFrame:
    """Top minus bottom, rank correlation of bin and mean, share of rising steps (few bins)."""
    w = Window.partitionBy(F.lit(1)).orderBy("bin")
    rows = spread.withColumn(
        "_up", (F.col("mean_actual") > F.lag("mean_actual").over(w)).cast("double")
    )
    rows = tie_rank(rows, [], "mean_actual", "_rm", group_bound=0)
    return rows.agg(
        (F.max_by("mean_actual", "bin") - F.min_by("mean_actual", "bin")).alias("top_minus_bottom"),
        guarded_corr("bin", "_rm", 2).alias("monotonicity"),
        F.avg("_up").alias("share_rising"),
        F.count(F.lit(1)).alias("n_bins"),
    )


# --- bootstrap --------------------------------------------------------------------------------

def bootstrap_ic_ci(
    rows: DataFrame, pred: str, actual: str, n_iter: int = 1000, ci: float = 0.95, seed: int = 42,
    by: list[str] | None = None, min_dates: int = 3, min_iters: int = 10, dt: str = "dt",
) -> DataFrame:
    """Percentile interval of the pooled rank IC under resampling of whole dates."""
    keys = by or []
    both = rows.select(
        *keys, dt, F.round(finite(pred), RANK_DIGITS).alias("_p"), F.round(finite(actual), RANK_DIGITS).alias("_a")
    ).dropna(subset=["_p", "_a"])
    # equal pairs of one date travel together
    both = cut_lineage(both.groupBy(*keys, dt, "_p", "_a").agg(F.count(F.lit(1)).alias("_c")))
    n_dates = both.groupBy(*keys).agg(F.countDistinct(dt).alias("n_dates"))
    return percentile_interval(resampled_ics(both, keys, n_iter, seed, dt), n_dates, keys, ci, min_dates, min_iters)


def percentile_interval(
    ics: DataFrame, n_dates: DataFrame, keys: list[str], ci: float = 0.95, min_dates: int = 3, min_iters: int = 10
) -> DataFrame:
    """The interval of the usable draws per key, NULL with few of them or few dates."""
    tail = (1 - ci) / 2
    usable = F.count("ic") >= min_iters
    out = ics.groupBy(*keys).agg(
        F.count("ic").alias("n_usable"),
        F.when(usable, F.percentile("ic", tail)).alias("ci_lo"),
        F.when(usable, F.percentile("ic", 1 - tail)).alias("ci_hi"),
    )
    out = join_same(out, n_dates, keys)
    enough = F.col("n_dates") >= min_dates
    return out.withColumns(
        {"ci_lo": F.when(enough, F.col("ci_lo")), "ci_hi": F.when(enough, F.col("ci_hi"))}
    )


class DateWeights:
    """What rows count in the draws of their dates, then in fixed sets of classes. A class holds rows of one date."""

    def __init__(self, day: np.ndarray, n_iter: int, seed: int, sets: np.ndarray):
        #: per class the number of its date among those drawn, -1 for none; per set its classes
        self.day, self.n_iter, self.seed, self.sets = day, n_iter, seed, sets

    def __call__(self, iters: np.ndarray) -> np.ndarray:
        out, drawn, has = np.zeros((len(iters), len(self.day))), iters < self.n_iter, self.day >= 0
        if drawn.any() and has.any():
            out[np.ix_(drawn, has)] = draw_counts(self.day.max() + 1, iters[drawn], self.seed)[:, self.day[has]]
        out[~drawn] = self.sets[iters[~drawn] - self.n_iter]
        return out


def horizon_battery(
    rows: DataFrame, pred: str, horizons: list[int], regime: str, n_iter: int, gap_days: dict[int, int],
    seed: int = 42, floor: int = 100, regime_floor: int = 30, nonoverlap_floor: int = 10, staged: bool = False,
) -> DataFrame:
    """One row per (horizon, scope): overall with its interval, the non-overlapping subsample, and
    each regime. rows: (entity, dt, pred, regime, fwd_<h>...).

    The overall and the regimes' correlations are further weightings of the rows by date and regime, beside the
    draws, so that a row travels once for all scopes. ``staged``: rows are written already, for this call alone; they are removed."""
    cols = [f"fwd_{h}" for h in horizons]
    rows = rows.select("entity", "dt", pred, regime, *cols)
    if not staged:
        rows = cut_lineage(rows)
    spark = rows.sparkSession
    # the mask walks over all rows, all horizons in one pass; outcomes are looked at afterwards
    kept = nonoverlap_dates(rows, [gap_days[h] for h in horizons])
    gaps = spark.createDataFrame([(h, gap_days[h]) for h in horizons], "horizon int, gap int")
    first = rows.groupBy("dt").agg(F.min("entity").alias("entity"))
    chosen = kept.join(F.broadcast(gaps), "gap").join(first, "dt").select("horizon", "dt", "entity")
    # a row per horizon and date
    sparse = rows.join(F.broadcast(cut_lineage(chosen)), ["dt", "entity"])
    own = F.coalesce(*[F.when(F.col("horizon") == h, F.col(c)) for h, c in zip(horizons, cols)])
    apart = rank_ic(sparse.select("horizon", pred, own.alias("actual")), ["horizon"], pred, "actual", nonoverlap_floor)
    apart = apart.withColumn("scope", F.lit("nonoverlap"))

    targets = [f"_a{t}" for t in range(len(horizons))]
    values = {"_p": pred, **dict(zip(targets, cols))}
    pairs = rows.select("dt", F.col(regime).alias("_regime"), *[F.round(finite(c), RANK_DIGITS).alias(v) for v, c in values.items()])
    pairs = pairs.where(F.col("_p").isNotNull() & F.coalesce(*targets).isNotNull())
    # a row per date and regime
    held = pairs.groupBy("dt", "_regime").agg(*[F.count(v).alias(v) for v in targets]).collect()
    last = lambda v: (v is not None, v)
    held.sort(key=lambda r: (last(r["dt"]), last(r["_regime"])))
    regimes = sorted({r["_regime"] for r in held}, key=last)
    weights, n_dates = [], []
    for v in targets:
        days = sorted({r["dt"] for r in held if r[v]}, key=last)
        number = {d: i for i, d in enumerate(days)}
        known = np.array([r[v] > 0 for r in held], dtype=bool)
        sets = [known, *[known & np.array([r["_regime"] == x for r in held], dtype=bool) for x in regimes]]
        weights.append(DateWeights(np.array([number[r["dt"]] if r[v] else -1 for r in held], dtype=int), n_iter, seed, np.array(sets, dtype=float)))
        n_dates.append(len(days) - (None in number))
    classes = spark.createDataFrame(
        [(r["dt"], r["_regime"], i) for i, r in enumerate(held)], T.StructType([pairs.schema["dt"], pairs.schema["_regime"], T.StructField("_d", T.IntegerType())]))
    placed = join_same(pairs, F.broadcast(classes), ["dt", "_regime"]).select(
        "_p", *targets, "_d", F.lit(len(held)).cast("long").alias("_nd"), F.lit(1).cast("long").alias("_n"))
    ics = weighted_ics(placed, [], targets, lambda t, _, iters: weights[t](iters), n_iter + 1 + len(regimes), spent=rows)

    tags = [(t, h, n_iter + i, x, f) for t, h in enumerate(horizons) for i, (x, f) in enumerate([("overall", floor), *[(x, regime_floor) for x in regimes]])]
    tags = spark.createDataFrame(tags, T.StructType([
        T.StructField(c, T.IntegerType()) for c in ("_t", "horizon", "iter")] + [T.StructField("scope", rows.schema[regime].dataType), T.StructField("_floor", T.IntegerType())]))
    whole = ics.join(F.broadcast(tags), ["_t", "iter"]).where("n > 0").select(
        "horizon", F.when(F.col("n") >= F.col("_floor"), F.col("ic")).alias("ic"), F.col("n").cast("long").alias("n"), "scope")
    sizes = spark.createDataFrame([(t, h, n) for t, (h, n) in enumerate(zip(horizons, n_dates))], "_t int, horizon int, n_dates long")
    drawn = ics.where(F.col("iter") < n_iter).join(F.broadcast(sizes.select("_t", "horizon")), "_t")
    drawn = drawn.select("horizon", F.when(F.col("n") >= 5, F.col("ic")).alias("ic"))
    interval = percentile_interval(drawn, sizes.select("horizon", "n_dates"), ["horizon"])
    interval = interval.select("horizon", F.lit("overall").alias("scope"), "ci_lo", "ci_hi")
    return whole.unionByName(apart).join(interval, ["horizon", "scope"], "left")


# --- series statistics ------------------------------------------------------------------------


def downside_stats(
    series: DataFrame, value: str = "ic", target: float = 0.0, tail_pct: float = 5.0,
    sortino_bar: float = 0.0, by: list[str] | None = None,
) -> DataFrame:
    """Downside deviation, Sortino and tail mean of a date-indexed series (one row per date)."""
    keys = by or []
    part = Window.partitionBy(*(keys or [F.lit(1)]))
    rows = series.where(finite(value).isNotNull()).withColumns(
        {"_r": F.row_number().over(part.orderBy(value)), "_n": F.count(F.lit(1)).over(part)}
    )
    v = F.col(value)
    worst = F.greatest(F.lit(1), F.ceil(F.col("_n") * (tail_pct / 100.0)))
    below = F.when(v < target, (v - target) * (v - target))
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(below).alias("n_downside"),
        F.avg(v).alias("mean_ic"),
        F.coalesce(F.sqrt(F.avg(below)), F.lit(0.0)).alias("downside_deviation"),
        F.avg(F.when(F.col("_r") <= worst, v)).alias("cvar"),
        F.avg((v < 0).cast("double")).alias("frac_negative"),
        F.min(v).alias("worst"),
    )
    sortino = F.when(F.col("downside_deviation") > 1e-12, F.col("mean_ic") / F.col("downside_deviation"))
    enough = F.col("n") >= 5
    out = out.withColumn("sortino", F.when(enough, sortino))
    passes = F.when(F.col("sortino").isNotNull(), F.col("sortino") >= sortino_bar).otherwise(
        F.col("mean_ic") > 0
    )
    return out.withColumn("passes", enough & passes).withColumn(
        "cvar", F.when(enough, F.col("cvar"))
    )


def promotion_series(combinations: DataFrame, walk_forward: DataFrame, value: str = "ic") -> DataFrame:
    """(ic, source): the series that the promotion gates read. That is the ICs of the purged combinations
    (``cpcv``), and only without any of them the walk-forward series (``expanding_wf``)."""
    first = combinations.where(finite(value).isNotNull()).select(F.col(value).alias("ic"), F.lit("cpcv").alias("source"))
    second = walk_forward.where(finite(value).isNotNull()).select(
        F.col(value).alias("ic"), F.lit("expanding_wf").alias("source")
    )
    any_first = first.limit(1).select(F.lit(True).alias("_any"))
    return first.union(second.join(F.broadcast(any_first), F.col("_any"), "left_anti"))


def series_moments(series: DataFrame, value: str = "ic", by: list[str] | None = None) -> DataFrame:
    """Mean, sample deviation, population skew and plain (non-excess) kurtosis."""
    v = finite(value)
    return series.where(v.isNotNull()).groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.skewness(v).alias("skew"),
        (F.kurtosis(v) + 3.0).alias("kurt"),
    )


@F.pandas_udf(T.DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    """Distribution function of the standard normal; applied to result rows only."""
    cdf = NormalDist().cdf
    return z.map(lambda v: cdf(v) if pd.notna(v) else None).astype(float)


def expected_max_sharpe(trials: Column, spread: Column, quantiles: dict[str, float]) -> Column:
    return F.when(
        (trials >= 2) & (spread > 0),
        spread * ((1 - EULER_GAMMA) * quantiles["plain"] + EULER_GAMMA * quantiles["deep"]),
    ).otherwise(0.0)


def deflated_sharpe(
    moments: DataFrame, n_trials: int, n_eff: int | None = None, threshold: float = 0.95,
    trials_std: float | None = None,
) -> DataFrame:
    """Probabilistic and deflated Sharpe ratio of every moments row."""
    inv = NormalDist().inv_cdf
    q = (
        {"plain": inv(1 - 1 / n_trials), "deep": inv(1 - 1 / (n_trials * math.e))}
        if n_trials >= 2
        else {"plain": 0.0, "deep": 0.0}
    )
    used = F.col("n") if n_eff is None else F.greatest(F.lit(2), F.least(F.lit(n_eff), F.col("n")))
    ok = (F.col("n") >= 5) & (F.col("std") >= 1e-12)
    rows = moments.withColumns({"n_used": used, "ic_ir": F.when(ok, F.col("mean") / F.col("std"))})
    spread = F.lit(trials_std) if trials_std is not None else 1 / F.sqrt("n_used")
    rows = rows.withColumn("sr_benchmark", expected_max_sharpe(F.lit(n_trials), spread, q))
    sr = F.col("ic_ir")
    var = 1 - F.col("skew") * sr + (F.col("kurt") - 1) / 4 * sr * sr
    width = F.sqrt(F.col("n_used") - 1) / F.when(var > 1e-12, F.sqrt(var)).otherwise(1e-6)
    rows = rows.withColumns(
        {"_z0": sr * width, "_z1": (sr - F.col("sr_benchmark")) * width}
    ).withColumns({"psr_vs_zero": normal_cdf("_z0"), "dsr": normal_cdf("_z1")})
    needed = inv(threshold) / F.sqrt(F.col("n_used") - 1)
    return rows.withColumns(
        {
            "psr_vs_zero": finite("psr_vs_zero"),
            "dsr": finite("dsr"),
            "ir_needed": F.when(F.col("n_used") >= 2, needed),
            "status": F.when(ok, "ok").otherwise("insufficient"),
            "passes": F.coalesce(F.col("dsr") >= threshold, F.lit(False)),
        }
    ).drop("_z0", "_z1")


def selection_pbo(series: DataFrame, spec: str, value: str = "ic", blocks: int = 8, dt: str = "dt") -> DataFrame:
    """Probability of backtest overfitting by combinatorially symmetric splits (Bailey, Borwein,
    Lopez de Prado, Zhu): every half of the blocks picks its best spec by mean, whose rank among
    all specs on the other half gives a logit; the share at or below zero is the probability.

    Only specs measured on the most common number of dates take part. After the block sums the
    table has specs x blocks rows.
    """
    lengths = series.groupBy(spec).agg(F.count(F.lit(1)).alias("_t"))
    modal = lengths.groupBy("_t").agg(F.count(F.lit(1)).alias("_k")).agg(
        F.max_by("_t", F.struct("_k", "_t")).alias("_t")
    )
    aligned = series.join(lengths.join(modal, "_t"), spec)
    order = Window.partitionBy(spec).orderBy(dt)
    rows = aligned.withColumn(
        "_b", F.floor((F.row_number().over(order) - 1) * blocks / F.col("_t")).cast("int")
    )
    sums = rows.groupBy(spec, "_b").agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    splits = series.sparkSession.range(1 << blocks).where(
        F.bit_count("id") == blocks // 2
    ).withColumnRenamed("id", "split")
    inside = F.getbit(F.col("split"), F.col("_b")) == 1
    scored = sums.crossJoin(F.broadcast(splits)).groupBy("split", spec).agg(
        (F.sum(F.when(inside, F.col("_s"))) / F.sum(F.when(inside, F.col("_c")))).alias("_is"),
        (F.sum(F.when(~inside, F.col("_s"))) / F.sum(F.when(~inside, F.col("_c")))).alias("_oos"),
    )
    scored = scored.withColumns({c: F.round(c, 10) for c in ("_is", "_oos")})
    part = Window.partitionBy("split")
    scored = scored.withColumns(
        {
            "_best": F.row_number().over(part.orderBy(F.col("_is").desc(), spec)),
            "_rank": F.rank().over(part.orderBy("_oos")),
            "_n": F.count(F.lit(1)).over(part),
        }
    )
    omega = F.col("_rank") / (F.col("_n") + 1)
    return scored.where("_best = 1").select(
        F.ln(omega / (1 - omega)).alias("_l"), F.col("_n").alias("n_specs")
    ).agg(
        F.avg((F.col("_l") <= 0).cast("double")).alias("pbo"),
        F.avg("_l").alias("mean_logit"),
        F.count(F.lit(1)).alias("n_splits"),
        F.max("n_specs").alias("n_specs"),
    )


# --- gates and selection ----------------------------------------------------------------------


def cutover_gate(
    ics: DataFrame, lift: float = 1.15, min_pairs: int = 30, ic_floor: float = 0.0
) -> DataFrame:
    """Pass when the variant's IC is at least ``lift`` times a healthy baseline's."""
    few = F.col("n_pairs") < min_pairs
    weak = F.coalesce(F.round("baseline_ic", 10) <= ic_floor, F.lit(True))
    gain = F.when(~few & ~weak, ratio(F.col("variant_ic"), F.col("baseline_ic")))
    passed = F.coalesce(gain >= lift, F.lit(False))
    return ics.withColumns(
        {
            "relative_lift": gain,
            "passed": passed,
            "reason": F.when(few, "insufficient_data").when(weak, "baseline_below_floor")
            .when(passed, "pass").otherwise("lift_below_threshold"),
        }
    )


def champion_monitor(read: DataFrame, min_outcomes: int = 20) -> DataFrame:
    known = F.col("ic").isNotNull() & (F.col("n") >= min_outcomes)
    return read.withColumns(
        {
            "chasing_noise": F.when(known, F.round("ic", 10) <= 0),
            "reason": F.when(~known, "insufficient_outcomes")
            .when(F.round("ic", 10) <= 0, "noise_watch").otherwise("healthy"),
        }
    )


def challenger_leaderboard(
    reads: DataFrame, champion: DataFrame, min_weeks: int = 4, min_outcomes: int = 20,
    version: str = "version_id",
) -> DataFrame:
    """Readiness of every challenger against the champion's read (one row), best first."""
    champ = champion.select(F.col("ic").alias("champion_ic"))
    rows = reads.crossJoin(F.broadcast(champ))
    beats = F.coalesce(F.round("ic", 10) >= F.round("champion_ic", 10), F.lit(False))
    enough = (F.col("n_weeks") >= min_weeks) & (F.col("n") >= min_outcomes)
    rows = rows.withColumns(
        {
            "beats_champion": beats,
            "ready": enough & beats,
            "reason": F.when(F.col("ic").isNull(), "insufficient_outcomes")
            .when(~enough, "soak_too_young").when(~beats, "below_champion").otherwise("ready"),
        }
    )
    # one row per version
    place = Window.partitionBy(F.lit(1)).orderBy(
        F.col("ready").desc(), F.round("ic", 10).desc_nulls_last(), version
    )
    return rows.withColumn("place", F.row_number().over(place))


def classification_metrics(rows: DataFrame, truth: str, pred: str, classes: list[int]) -> DataFrame:
    """Per class of the full grid: support, predicted, hits, precision, recall, f1; macro F1 and
    accuracy repeat on every row."""
    cells = rows.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("_n"))
    grid = rows.sparkSession.createDataFrame([(c,) for c in classes], "class int")
    t = cells.groupBy(F.col(truth).alias("class")).agg(F.sum("_n").alias("support"))
    p = cells.groupBy(F.col(pred).alias("class")).agg(F.sum("_n").alias("predicted"))
    h = cells.where(F.col(truth) == F.col(pred)).select(F.col(truth).alias("class"), F.col("_n").alias("hits"))
    out = grid.join(t, "class", "left").join(p, "class", "left").join(h, "class", "left")
    out = out.na.fill(0, ["support", "predicted", "hits"])
    precision = F.coalesce(ratio(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(ratio(F.col("hits"), F.col("support")), F.lit(0.0))
    out = out.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(
        ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    out = out.withColumn("f1", f1)
    # one row per class
    every = Window.partitionBy(F.lit(1))
    return out.withColumns(
        {
            "macro_f1": F.avg("f1").over(every),
            "accuracy": ratio(F.sum("hits").over(every), F.sum("support").over(every)),
        }
    )


def confusion_matrix(rows: DataFrame, truth: str, pred: str, classes: list[int]) -> DataFrame:
    spark = rows.sparkSession
    grid = spark.createDataFrame([(a, b) for a in classes for b in classes], "truth int, pred int")
    cells = rows.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return grid.join(cells, ["truth", "pred"], "left").na.fill(0, ["n"])


def agreement_score(
    pairs: DataFrame, recent: int, bear_weight: float = 2.0, dt: str = "dt"
) -> DataFrame:
    """1 - cost / worst cost over all pairs and over the newest ``recent`` ones, a missed bear
    costing ``bear_weight`` and every other miss 1. pairs: (dt, agreed, bear_miss, bull_miss)."""
    order = Window.partitionBy(F.lit(1)).orderBy(F.col(dt).desc())
    rows = pairs.withColumn("_new", F.row_number().over(order) <= recent)
    cost = F.when(F.col("agreed"), 0.0).when(F.col("bear_miss"), bear_weight).otherwise(1.0)
    other = ~F.col("agreed") & ~F.col("bear_miss") & ~F.col("bull_miss")
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("agreed").cast("double")).alias("symmetric"),
        (1 - F.avg(cost) / bear_weight).alias("asymmetric"),
        (1 - F.avg(F.when(F.col("_new"), cost)) / bear_weight).alias("rolling"),
        F.sum(F.col("bear_miss").cast("int")).alias("bear_misses"),
        F.sum(F.col("bull_miss").cast("int")).alias("bull_misses"),
        F.sum(other.cast("int")).alias("other_misses"),
    )


def ece(rows: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal-width bins (published definition)."""
    slot = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1))
    cells = rows.dropna(subset=[p, y]).groupBy(slot.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(p).alias("_p"), F.avg(y).alias("_y")
    )
    gap = F.sum(F.col("_n") * F.abs(F.col("_p") - F.col("_y"))) / F.sum("_n")
    return cells.agg(gap.alias("ece"), F.sum("_n").alias("n"))


def sample_shift(counts: DataFrame, warn_pct: float = 30.0) -> DataFrame:
    """Change of a component's sample size against the run before. counts: (component, dt, n)."""
    w = Window.partitionBy("component").orderBy("dt")
    rows = counts.withColumn("prior_n", F.lag("n").over(w))
    pct = ratio(F.col("n") - F.col("prior_n"), F.col("prior_n")) * 100.0
    return rows.withColumn("pct_change", pct).withColumn(
        "warn", F.coalesce(F.abs(F.round("pct_change", 10)) > warn_pct, F.lit(False))
    )


def mode_summary(history: DataFrame, modes: list[str], base: str) -> DataFrame:
    """history: (dt, best_mode, <mode>_ic...): wins, mean IC and mean gain over ``base``."""
    total = history.agg(F.count(F.lit(1)).alias("_t"))
    long = history.select("dt", *[F.col(f"{m}_ic").alias(m) for m in modes], "best_mode", F.col(f"{base}_ic").alias("_base"))
    long = long.unpivot(["dt", "best_mode", "_base"], modes, "mode", "ic")
    return long.groupBy("mode").agg(
        F.sum((F.col("mode") == F.col("best_mode")).cast("int")).alias("wins"),
        F.count("ic").alias("n"),
        F.avg("ic").alias("mean_ic"),
        F.avg(F.col("ic") - F.col("_base")).alias("mean_delta"),
    ).crossJoin(F.broadcast(total)).withColumn("win_share", F.col("wins") / F.col("_t")).drop("_t")


#: features x folds whose numbers the driver holds
MANY_READS = 2_000


def _fold_ics(known: DataFrame, features: list[str], actual: str, fold: str, floor: int) -> DataFrame | None:
    """(feature, p, s, n) per feature and fold from written rows of ``known_columns``; None where these cannot be read
    in pieces."""
    # a row per fold
    names = sorted(r[fold] for r in known.select(fold).distinct().limit(MANY_READS + 1).collect())
    if not names or len(names) * len(features) > MANY_READS:
        return None
    number = F.create_map(*[F.lit(x) for i, v in enumerate(names) for x in (v, i)])
    known = known.withColumn("_day", F.element_at(number, F.col(fold)))
    ics = V.pooled_column_ics(known, features, len(names))
    if ics is None:
        return None
    own = known.select("_day", actual, *[
        F.when(F.col("_missing").bitwiseAND(1 << i) == 0, F.col(f)).alias(f) for i, f in enumerate(features)
    ])
    reads = own.groupBy("_day").agg(*[guarded_corr(f, actual, floor).alias(f) for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("p")) for f in features])
    pearson = reads.select("_day", F.explode(pairs).alias("r")).select("_day", "r.*")
    return pearson.join(ics, ["feature", "_day"]).select("feature", "p", F.when(F.col("n") >= floor, F.col("ic")).alias("s"), "n")


def _long_fold_ics(rows: DataFrame, features: list[str], actual: str, fold: str, floor: int) -> DataFrame:
    """The same with a row per feature."""
    long = long_features(rows, features, [fold, actual]).withColumns(
        {"value": finite("value"), actual: finite(actual)}
    ).dropna(subset=["value", actual])
    long = cut_lineage(long)
    keys = ["feature", fold]
    pearson = long.groupBy(*keys).agg(
        guarded_corr("value", actual, floor).alias("p"), F.count(F.lit(1)).alias("n")
    )
    spearman = rank_ic(long, keys, "value", actual, floor).select(*keys, F.col("ic").alias("s"))
    return pearson.join(spearman, keys)


def feature_fold_ic(
    rows: DataFrame, features: list[str], actual: str, fold: str = "fold", floor: int = 100
) -> DataFrame:
    """Per feature: median, quartiles and share positive of the per-fold Pearson and Spearman.
    A fold with enough rows but a constant side counts as 0."""
    known = cut_lineage(V.known_columns(rows.where(F.col(fold).isNotNull()), features, actual, [fold]))
    per_fold = _fold_ics(known, features, actual, fold, floor)
    if per_fold is None:
        per_fold = _long_fold_ics(rows, features, actual, fold, floor)
    per_fold = per_fold.where(F.col("n") >= floor).na.fill(0.0, ["p", "s"])

    def stats(c: str, name: str) -> list[Column]:
        return [
            F.median(c).alias(f"median_{name}"),
            F.percentile(c, 0.25).alias(f"{name}_q25"),
            F.percentile(c, 0.75).alias(f"{name}_q75"),
            (F.avg((F.col(c) > 0).cast("double")) * 100).alias(f"pct_positive_{name}"),
        ]

    return per_fold.groupBy("feature").agg(
        *stats("p", "pearson"), *stats("s", "spearman"), F.count(F.lit(1)).alias("n_folds")
    )


def feature_correlation(rows: DataFrame, features: list[str]) -> DataFrame:
    """(a, b, corr) for all pairs both ways, pairwise complete, from matrices that tasks add up."""
    return pair_correlation(rows, features)


def overfit_signal(ics: DataFrame, warn: float = 3.0, train: str = "train_ic", val: str = "val_ic") -> DataFrame:
    """train IC over |validation IC|; too small a denominator is "could not measure"."""
    size = F.round(F.abs(F.col(val)), 10)
    out = ics.withColumn("ic_ratio", F.when(size >= 1e-3, F.col(train) / F.abs(F.col(val))))
    return out.withColumn("overfit", F.coalesce(F.col("ic_ratio") > warn, F.lit(False)))


def select_winner(
    candidates: DataFrame, serving_ic: DataFrame, horizon: int, margin: float, min_ic: float,
    base_spec: str,
) -> DataFrame:
    """Eligibility of every candidate and the one decision.

    candidates: (spec_id, version_id, forward_days, mean_ic); serving_ic: one row (serving_ic). The
    baseline is the base architecture's own fresh read when there is one, else the serving read.
    """
    base = candidates.where(F.col("spec_id") == base_spec).agg(
        F.max("mean_ic").alias("base_ic"),
        F.max("forward_days").alias("base_fwd"),
        F.max("version_id").alias("base_version"),
    )
    rows = candidates.crossJoin(F.broadcast(base)).crossJoin(F.broadcast(serving_ic))
    baseline = F.coalesce("base_ic", "serving_ic")
    ic = F.round("mean_ic", 10)
    rows = rows.withColumns(
        {
            "baseline_ic": baseline,
            "baseline_source": F.when(F.col("base_ic").isNotNull(), "champion_arch_fresh").otherwise(
                "serving_champion_stale"
            ),
        }
    )
    short = F.col("baseline_ic").isNotNull() & (ic < F.round(F.col("baseline_ic") + margin, 10))
    rows = rows.withColumn(
        "reason",
        F.when(F.col("spec_id") == base_spec, "champion_arch_baseline")
        .when(F.col("forward_days") != horizon, "non_canonical_horizon")
        .when(F.col("mean_ic").isNull(), "no_cpcv")
        .when(ic <= min_ic, "below_floor")
        .when(short, "below_champion_arch_plus_margin")
        .otherwise("eligible"),
    )
    winner = rows.where("reason = 'eligible'").agg(
        F.max_by("version_id", F.struct("mean_ic", "version_id")).alias("winner_version_id")
    )
    rows = rows.crossJoin(F.broadcast(winner))
    refresh = (
        F.col("winner_version_id").isNull()
        & (F.col("base_ic") > min_ic)
        & (F.col("serving_ic").isNull() | (F.col("base_ic") >= F.col("serving_ic") + margin))
        & (F.col("base_fwd") == horizon)
    )
    return rows.withColumn("refresh_version_id", F.when(refresh, F.col("base_version"))).drop(
        "base_ic", "base_fwd", "base_version"
    )


def winner_observe(
    winners: DataFrame, series: DataFrame, margin: float, n_trials: int, n_eff: int | None = None, by: str = "spec_id"
) -> DataFrame:
    """Columns beside the winner table that decide nothing: whether a candidate beats the baseline by the
    margin, its deflated Sharpe ratio at the cumulative number of trials, the ratio it would need, and
    whether it passes the downside and overfit gates. ``series``: (by, dt, ic)."""
    deflated = deflated_sharpe(series_moments(series, by=[by]), n_trials, n_eff).select(
        by, F.col("dsr").alias("dsr_selection"), F.col("n_used").alias("dsr_selection_n_eff"),
        F.col("ir_needed").alias("ic_ir_needed"), F.col("passes").alias("_overfit"),
    )
    downside = downside_stats(series, by=[by]).select(by, F.col("passes").alias("_downside"))
    rows = winners.join(deflated, by, "left").join(downside, by, "left")
    ic, bar = F.round("mean_ic", 10), F.round(F.col("baseline_ic") + margin, 10)
    beats = F.col("mean_ic").isNotNull() & (F.col("baseline_ic").isNull() | (ic >= bar))
    return rows.withColumns({
        "beats_baseline": beats,
        "gate_pass": F.coalesce(F.col("_overfit") & F.col("_downside"), F.lit(False)),
    }).drop("_overfit", "_downside")


def rotation_order(specs: DataFrame, versions: DataFrame, budget: int) -> DataFrame:
    """The ``budget`` stalest active specs: never registered first, then oldest, then priority.

    specs: (id, model_version, status, priority); versions: (model_version, dt).
    """
    newest = versions.groupBy("model_version").agg(F.max("dt").alias("last_dt"))
    active = specs.where("coalesce(status, 'active') = 'active' AND id IS NOT NULL")
    return (
        active.join(newest, "model_version", "left")
        .orderBy(F.col("last_dt").asc_nulls_first(), F.coalesce("priority", F.lit(0)).desc(), "id")
        .limit(budget)
    )


def append_trials(ledger: DataFrame, trained: DataFrame) -> DataFrame:
    """Ledger plus the new versions, and the cumulative number of trials."""
    fresh = trained.where("version_id IS NOT NULL").dropDuplicates(["version_id"]).join(
        ledger, "version_id", "left_anti"
    )
    merged = ledger.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)))
    count = merged.agg(F.count(F.lit(1)).alias("n_trials"))
    return merged.crossJoin(F.broadcast(count))


def candidate_pool(specs: DataFrame, versions: DataFrame, run_dt: str, base_label: str) -> DataFrame:
    """Newest version per spec label registered for ``run_dt``; the base architecture falls back to
    its newest overall; specs without a version are reported as absent."""
    order = F.struct("dt", "created", "version_id")
    today = F.when(F.col("dt") == F.lit(run_dt).cast("date"), F.col("version_id"))
    picks = versions.groupBy("model_version").agg(
        F.max_by(today, F.when(today.isNotNull(), order)).alias("_today"),
        F.max_by("version_id", order).alias("_any"),
    )
    chosen = F.when(
        F.col("model_version") == base_label, F.coalesce("_today", "_any")
    ).otherwise(F.col("_today"))
    return specs.join(picks, "model_version", "left").select(
        F.col("id").alias("spec_id"), "model_version", chosen.alias("version_id"),
        chosen.isNotNull().alias("present"),
    )
