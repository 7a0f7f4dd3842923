"""Path-dependent labels, overlap weights and cohort-relative outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelith.functions.columns import by_entity, finite, ratio
from panelith.functions.scans import decayed_sums
from panelith.operators.windows import realized_vol, vol_cohort


def residual_log_return(aligned: DataFrame, bench: str | None = "bench", out: str = "resid") -> DataFrame:
    w = by_entity()
    own = F.ln(ratio(F.col("close"), F.lag("close").over(w)))
    if bench is not None:
        own = own - F.ln(ratio(F.col(bench), F.lag(bench).over(w)))
    return aligned.withColumn(out, finite(own))


def ewm_std(
    rows: DataFrame, value: str, span: int = 20, min_periods: int = 10, out: str = "sigma"
) -> DataFrame:
    """Bias-corrected exponentially weighted deviation: decayed sums of weights, squared weights, values and
    squares over one window. A missing value adds nothing and lets the others age; values count from the
    series' first one, so that a far level costs no digits."""
    w = by_entity()
    keep = 1 - 2.0 / (span + 1)
    known = finite(value).isNotNull()
    start = F.first(finite(value), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_x", F.coalesce(finite(value) - start, F.lit(0.0)))
    one, x = known.cast("double"), F.col("_x")
    rows = decayed_sums(rows, w, {"_w": (one, keep), "_w2": (one, keep * keep), "_sx": (x, keep), "_sxx": (x * x, keep)})
    seen = F.count(finite(value)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    mean = F.col("_sx") / F.col("_w")
    spread_left = F.col("_w") * F.col("_w") - F.col("_w2")
    var = F.greatest(F.col("_sxx") / F.col("_w") - mean * mean, F.lit(0.0)) * F.col("_w") * F.col("_w") / spread_left
    enough = (seen >= max(min_periods, 2)) & (spread_left > 0)
    return rows.withColumn(out, F.when(enough, F.sqrt(var))).drop("_x", "_w", "_w2", "_sx", "_sxx")


def first_touch(rows: DataFrame, value: str, forward: int, up: Column, down: Column) -> DataFrame:
    """Adds ``_walk`` = (cum, hit) over the next ``forward`` rows: hit 1 when the running sum first
    reaches ``up``, -1 when it first reaches ``-down`` (up is looked at first), 0 for neither.
    ``_steps`` counts the rows ahead; a missing value counts as no move."""
    ahead = by_entity().rowsBetween(1, forward)
    path = F.collect_list(F.coalesce(F.col(value), F.lit(0.0))).over(ahead)
    rows = rows.withColumns({"_path": path, "_up": up, "_down": down})

    def walk(acc: Column, x: Column) -> Column:
        cum = acc["cum"] + x
        step = F.when(cum >= F.col("_up"), 1).when(cum <= -F.col("_down"), -1).otherwise(0)
        return F.when(acc["hit"] != 0, acc).otherwise(
            F.struct(cum.alias("cum"), step.cast("int").alias("hit"))
        )

    start = F.struct(F.lit(0.0).alias("cum"), F.lit(0).alias("hit"))
    return rows.withColumns(
        {"_walk": F.aggregate("_path", start, walk), "_steps": F.size("_path")}
    )


_WALK_COLUMNS = ("_path", "_up", "_down", "_walk", "_steps")


def triple_barrier_class(
    rows: DataFrame, value: str, forward: int, up: float, down: float, out: str = "tb_class"
) -> DataFrame:
    """2 up, 0 down, 1 neither; a time-out beyond half a barrier takes that side; -1 for the tail."""
    walked = first_touch(rows, value, forward, F.lit(float(up)), F.lit(float(down)))
    cum, hit = F.col("_walk.cum"), F.col("_walk.hit")
    label = (
        F.when(F.col("_steps") < forward, -1)
        .when((hit == 1) | ((hit == 0) & (cum > up / 2)), 2)
        .when((hit == -1) | ((hit == 0) & (cum < -down / 2)), 0)
        .otherwise(1)
    )
    return walked.withColumn(out, label).drop(*_WALK_COLUMNS)


def triple_barrier_alpha(
    rows: DataFrame, value: str, forward: int, barrier: str, out: str = "tb_alpha"
) -> DataFrame:
    """Return capped at the touched barrier, uncapped at time-out; NULL without barrier or tail."""
    walked = first_touch(rows, value, forward, F.col(barrier), F.col(barrier))
    cum, hit = F.col("_walk.cum"), F.col("_walk.hit")
    label = F.when(hit == 1, F.col("_up")).when(hit == -1, -F.col("_down")).otherwise(cum)
    known = F.col(barrier).isNotNull() & (F.col("_steps") == forward)
    return walked.withColumn(out, F.when(known, label)).drop(*_WALK_COLUMNS)


def triple_barrier_touch(
    rows: DataFrame, value: str, forward: int, barrier: str, timeout: str = "nan",
    out: str = "tb_touch",
) -> DataFrame:
    """1 up first, 0 down first; a time-out is NULL ("nan") or the sign of the move ("sign")."""
    if timeout not in ("nan", "sign"):
        raise ValueError(f"timeout must be 'nan' or 'sign', got {timeout!r}")
    walked = first_touch(rows, value, forward, F.col(barrier), F.col(barrier))
    cum, hit = F.col("_walk.cum"), F.col("_walk.hit")
    label = F.when(hit == 1, 1.0).when(hit == -1, 0.0)
    if timeout == "sign":
        label = label.otherwise(F.when(cum > 0, 1.0).otherwise(0.0))
    known = F.col(barrier).isNotNull() & (F.col("_steps") == forward)
    return walked.withColumn(out, F.when(known, label)).drop(*_WALK_COLUMNS)


def vol_scaled_barriers(
    aligned: DataFrame, multiplier: float = 2.0, span: int = 20, min_periods: int = 10,
    bench: str | None = "bench",
) -> DataFrame:
    """Adds ``resid`` and ``barrier`` = multiplier x its exponentially weighted deviation."""
    rows = residual_log_return(aligned, bench)
    return ewm_std(rows, "resid", span, min_periods).withColumn(
        "barrier", F.col("sigma") * float(multiplier)
    )


def uniqueness_weights(
    labels: DataFrame, start: str = "start", length: str = "length", group: list[str] | None = None,
    out: str = "weight",
) -> DataFrame:
    """Mean over a label's window of 1 / (labels covering that position in the group).

    A weight depends on (group, start, length) only, so equal windows are counted first; after
    that no cell holds more rows than there are distinct windows over one position.
    """
    keys = [*(group or []), start, length]
    windows = labels.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cells = windows.withColumn("_t", F.explode(F.expr(f"sequence({start}, {start} + {length} - 1)")))
    cover = F.sum("_n").over(Window.partitionBy(*(group or []), "_t"))
    weights = (
        cells.withColumn("_c", cover).groupBy(*keys).agg(F.avg(1 / F.col("_c")).alias(out))
    )
    return labels.join(weights, keys)


def cohort_basket(rows: DataFrame, horizon: int, log_fwd: str = "log_fwd") -> DataFrame:
    """Equal-weight forward log return per (dt, cohort); needs two members, counted even when their
    own outcome is still open."""
    return (
        rows.where("cohort IS NOT NULL")
        .groupBy("dt", "cohort")
        .agg(F.avg(log_fwd).alias("basket"), F.count(F.lit(1)).alias("members"))
        .withColumn("basket", F.when(F.col("members") >= 2, F.col("basket")))
    )


def canonical_alpha(
    panel: DataFrame, horizon: int, vol_window: int = 20, periods: int = 252, cohorts: int = 10,
    group_bound: int | None = None,
) -> DataFrame:
    """Own forward log return minus the basket of the volatility cohort the entity is in at dt."""
    rows = realized_vol(panel, vol_window, periods)
    ahead = F.lead("close", horizon).over(by_entity())
    rows = rows.withColumn("log_fwd", F.ln(ratio(ahead, F.col("close"))))
    members = vol_cohort(rows, cohorts, group_bound)
    baskets = cohort_basket(members, horizon)
    return members.join(baskets, ["dt", "cohort"], "left").withColumn(
        "canonical_alpha", F.col("log_fwd") - F.col("basket")
    )


def label_distribution(rows: DataFrame, value: str = "fwd_ret", direction: str = "direction") -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(direction) == "UP").cast("double")).alias("share_up"),
        F.avg((F.col(direction) == "DOWN").cast("double")).alias("share_down"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
    )
