"""Trailing and leading window features of an (entity, dt) panel and of macro series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.functions.columns import by_entity, clamp, finite, full_frame, ratio
from panelith.functions.ranks import WINDOW_GROUP_LIMIT, fits_window, join_same, order_number, pooled_ranks, rank_table, tie_rank
from panelith.functions.scans import PACKED, scan_affine, scan_maps
from panelith.session import cut_lineage, discard, spread


# --- forward returns -------------------------------------------------------------------------


def excess_forward(close: str, bench: str | None, h: int) -> Column:
    """h-row-ahead return of ``close`` minus the same of ``bench`` on the entity's own rows."""
    w = by_entity()
    own = F.lead(close, h).over(w) / F.col(close) - 1
    if bench is None:
        return own
    return own - (ratio(F.lead(bench, h).over(w), F.col(bench)) - 1)


def forward_return(
    aligned: DataFrame, h: int, bench: str | None = "bench", clip: float | None = None
) -> DataFrame:
    """Adds ``fwd_ret`` and ``direction`` (UP from zero on); rows without an outcome drop out."""
    value = excess_forward("close", bench, h)
    out = aligned.withColumn("fwd_ret", finite(value)).where("fwd_ret IS NOT NULL")
    if clip is not None:
        out = out.withColumn("fwd_ret", clamp(F.col("fwd_ret"), -clip, clip))
    return out.withColumn(
        "direction", F.when(F.round("fwd_ret", 10) >= 0, "UP").otherwise("DOWN")
    )


def multi_horizon_returns(aligned: DataFrame, horizons: list[int], bench: str = "bench") -> DataFrame:
    return aligned.withColumns(
        {f"fwd_{h}": finite(excess_forward("close", bench, h)) for h in horizons}
    )


# --- price features --------------------------------------------------------------------------


def price_features(
    panel: DataFrame,
    returns: dict[str, int],
    averages: dict[str, int],
    rsi_window: int = 14,
    spread: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Trailing returns, price against moving averages, rolling-mean RSI, return spread."""
    w = by_entity()
    close = F.col("close")
    out = panel.withColumn("_delta", close - F.lag("close").over(w))
    cols: dict[str, Column] = {
        name: ratio(close, F.lag("close", n).over(w)) - 1 for name, n in returns.items()
    }
    for name, n in averages.items():
        mean = full_frame(close, F.avg("close"), w.rowsBetween(1 - n, 0), n)
        cols[name] = ratio(close, mean) - 1
    frame = w.rowsBetween(1 - rsi_window, 0)
    delta = F.col("_delta")
    # greatest/least skip NULLs, so the first difference is kept out by hand
    gain = F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))
    loss = F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))
    up = full_frame(delta, F.avg(gain), frame, rsi_window)
    down = full_frame(delta, F.avg(loss), frame, rsi_window)
    cols["rsi"] = 100 - 100 / (1 + ratio(up, down))
    out = out.withColumns(cols).drop("_delta")
    if spread:
        name, long_leg, short_leg = spread
        out = out.withColumn(name, F.col(long_leg) - F.col(short_leg))
    return out


def residual_momentum_features(
    aligned: DataFrame,
    beta_window: int = 60,
    mom_window: int = 252,
    skip_window: int = 21,
    vol_window: int = 20,
    change_window: int = 21,
) -> DataFrame:
    """Five features against ``bench``; the beta frame ends one row back, so it never sees the
    return it explains."""
    w = by_entity()
    close, bench = F.col("close"), F.col("bench")
    past = w.rowsBetween(-beta_window, -1)
    eps = 1e-8  # fixed value of the scaling
    base = aligned.withColumns(
        {
            "_r": finite(ratio(close, F.lag("close").over(w)) - 1),
            "_rb": finite(ratio(bench, F.lag("bench").over(w)) - 1),
        }
    )
    pair = F.when(F.col("_r").isNotNull(), F.col("_rb"))
    cov = full_frame(pair, F.covar_samp("_r", "_rb"), past, beta_window)
    var = full_frame(F.col("_rb"), F.var_samp("_rb"), past, beta_window)
    # an entity that is its own benchmark leaves rounding noise, which the scaling below would blow up
    base = base.withColumn("_resid", F.round(F.col("_r") - ratio(cov, var) * F.col("_rb"), 12))
    span = max(mom_window - skip_window, 1)
    resid = F.col("_resid")
    cum = full_frame(
        resid, F.sum("_resid"), w.rowsBetween(1 - span - skip_window, -skip_window), span
    )
    vol = full_frame(resid, F.stddev_samp("_resid"), w.rowsBetween(1 - vol_window, 0), vol_window)
    k = change_window
    recent = full_frame(F.col("_r"), F.sum("_r"), w.rowsBetween(1 - k, 0), k)
    prior = full_frame(F.col("_r"), F.sum("_r"), w.rowsBetween(1 - 2 * k, -k), k)

    def skip_month(col: str) -> Column:
        return ratio(F.lag(col, skip_window).over(w), F.lag(col, mom_window).over(w)) - 1

    return base.withColumns(
        {
            "resid_mom_vol_scaled": finite(cum / (vol * float(span) ** 0.5 + eps)),
            "mom_12_1": finite(skip_month("close")),
            "mom_1m": finite(ratio(close, F.lag("close", skip_window).over(w)) - 1),
            "mom_change": finite(recent - prior),
            "sector_mom": finite(skip_month("bench")),
        }
    ).drop("_r", "_rb", "_resid")


def realized_vol(panel: DataFrame, window: int = 20, periods: int = 252) -> DataFrame:
    w = by_entity()
    out = panel.withColumn("_lr", F.ln(ratio(F.col("close"), F.lag("close").over(w))))
    vol = full_frame(F.col("_lr"), F.stddev_samp("_lr"), w.rowsBetween(1 - window, 0), window)
    return out.withColumn("realized_vol", vol * float(periods) ** 0.5).drop("_lr")


def ewm_indicators(
    panel: DataFrame, rsi_com: int = 13, fast: int = 12, slow: int = 26, signal: int = 9, look_back: int = 3
) -> DataFrame:
    """Exponentially weighted RSI and MACD, as scans of affine maps over one window per entity.

    The crossing flag reports the newest sign change of line - signal within ``look_back`` rows. Rows
    without a close keep the averages of the row before; after a gap the old average weighs less.
    """
    w = by_entity()
    # rows with a close follow each other in a window of their own
    missing = finite("close").isNull()
    own = Window.partitionBy("entity", "_missing").orderBy("dt")
    place = F.row_number().over(w)
    rows = panel.select("entity", "dt", finite("close").alias("close"), missing.alias("_missing"), place.alias("_row"))
    rows = rows.withColumns({"_gap": F.col("_row") - F.lag("_row").over(own), "_delta": F.when(F.col("_gap") == 1, F.col("close") - F.lag("close").over(own))})

    def average(x: Column, share: float, first: Column, gap: Column) -> tuple[Column, Column]:
        """The map of one observation; the first known one is taken whole."""
        old = F.pow(F.lit(1 - share), gap)
        return (
            F.when(first, 0.0).otherwise(F.when(x.isNull(), 1.0).otherwise(old / (old + share))),
            F.when(first, F.coalesce(x, F.lit(0.0))).otherwise(F.when(x.isNull(), 0.0).otherwise(share * x / (old + share))),
        )

    delta, close = F.col("_delta"), F.col("close")
    moves = F.count(delta).over(own.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"_moves": moves, "_first": F.col("_gap").isNull(), "_up": F.greatest(delta, F.lit(0.0)), "_down": F.greatest(-delta, F.lit(0.0))})
    up, down = F.when(delta.isNotNull(), F.col("_up")), F.when(delta.isNotNull(), F.col("_down"))
    # a move needs two closes side by side: its own count of rows since the last one
    known = F.last(F.when(delta.isNotNull(), F.col("_row")), ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_since", F.coalesce(F.col("_row") - known, F.lit(1)))
    r, f, s, g = 1.0 / (1 + rsi_com), 2.0 / (fast + 1), 2.0 / (slow + 1), 2.0 / (signal + 1)
    begins = F.col("_moves") <= F.when(delta.isNotNull(), 1).otherwise(0)
    gap = F.coalesce("_gap", F.lit(1))
    maps = {
        "_gain": average(up, r, begins, F.col("_since")), "_loss": average(down, r, begins, F.col("_since")),
        "_fast": average(close, f, F.col("_first"), gap), "_slow": average(close, s, F.col("_first"), gap),
    }
    rows = scan_affine(rows, own, maps, 1 - min(r, f, s))
    rsi = F.when((F.col("_moves") > 0) & (F.col("_loss") > 0), 100 - 100 / (1 + F.col("_gain") / F.col("_loss")))
    live = F.when(~F.col("_missing"), F.struct(rsi.alias("rsi"), (F.col("_fast") - F.col("_slow")).alias("line")))
    held = F.last(live, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_held", held).select(
        "entity", "dt", F.col("_held.rsi").alias("ewm_rsi"), F.col("_held.line").alias("macd_line"), F.col("_held").isNull().alias("_none")
    )
    # only leading rows have no line
    lined = Window.partitionBy("entity", "_none").orderBy("dt")
    rows = rows.withColumn("_first", F.row_number().over(lined) == 1)
    rows = scan_affine(rows, lined, {"macd_signal": average(F.col("macd_line"), g, F.col("_first"), F.lit(1))}, 1 - g)
    out = rows.select("entity", "dt", "ewm_rsi", "macd_line", F.when(~F.col("_none"), F.col("macd_signal")).alias("macd_signal"))
    side = F.signum(F.round(F.col("macd_line") - F.col("macd_signal"), 10))
    out = out.withColumn("_side", side).withColumn(
        "_turn",
        F.when((F.col("_side") > 0) & (F.lag("_side").over(w) <= 0), 1).when(
            (F.col("_side") < 0) & (F.lag("_side").over(w) >= 0), -1
        ),
    )
    recent = w.rowsBetween(1 - look_back, 0)
    return out.withColumns(
        {
            "macd_cross": F.coalesce(F.last("_turn", ignorenulls=True).over(recent), F.lit(0)),
            "macd_above_zero": (F.col("macd_line") > 0).cast("int"),
        }
    ).drop("_side", "_turn")


def volume_ratio(panel: DataFrame, window: int = 20) -> DataFrame:
    """Rolling mean volume over the series' own mean."""
    w = by_entity()
    rolling = full_frame(F.col("volume"), F.avg("volume"), w.rowsBetween(1 - window, 0), window)
    whole = F.avg("volume").over(Window.partitionBy("entity"))
    return panel.withColumn("volume_ratio", ratio(rolling, whole))


# --- cross-sections --------------------------------------------------------------------------


def combined_rank(
    rows: DataFrame,
    value: str = "predicted_alpha",
    by: list[str] | None = None,
    group_bound: int | None = None,
) -> DataFrame:
    return order_number(
        rows, by or ["dt"], value, "entity", "combined_rank", descending=True,
        group_bound=group_bound,
    )


def rank_normalize(
    rows: DataFrame, features: list[str], group_bound: int | None = None, dt: str = "dt"
) -> DataFrame:
    """Per date: (average-tie rank - 1) / (finite - 1); missing values and dates with at most one
    finite value give 0.5."""

    def scaled(rank: Column, n: Column) -> Column:
        return F.when(rank.isNull() | (n <= 1), F.lit(0.5)).otherwise((rank - 1) / (n - 1))

    rows = rows.withColumns({f: finite(f) for f in features})
    if not fits_window(group_bound):
        rows = cut_lineage(rows)
        # without a bound the dates are counted: while the largest fits a task, one shuffle serves all features
        group_bound = rows.groupBy(dt).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if fits_window(group_bound):
            # a few dates a task: each date is sorted once per feature, which should not spill
            rows = spread(rows, dt)
    if fits_window(group_bound):
        for f in features:
            rows = tie_rank(rows, [dt], f, "_rank", "_n", group_bound)
            rows = rows.withColumn(f, scaled(F.col("_rank"), F.col("_n"))).drop("_rank", "_n")
        return rows
    # large cross-sections: rows travel to pieces of one feature after the other, as they are
    pieces = 4 * -(-group_bound // WINDOW_GROUP_LIMIT)
    for f in features:
        known, none = rows.where(F.col(f).isNotNull()), rows.where(F.col(f).isNull())
        sizes = known.groupBy(dt).agg(F.count(F.lit(1)).alias("_n"))  # a row per date
        ranked = join_same(pooled_ranks(known, [dt], {f: "_rank"}, pieces), F.broadcast(sizes), [dt])
        ranked = ranked.withColumn(f, scaled(F.col("_rank"), F.col("_n"))).drop("_rank", "_n")
        done = cut_lineage(ranked.unionByName(none.withColumn(f, F.lit(0.5))))
        discard(rows)
        rows = done
    return rows


def vol_cohort(rows: DataFrame, cohorts: int = 10, group_bound: int | None = None) -> DataFrame:
    """Equal-size volatility groups per date, from first-come ranks; a lone name has none."""
    ranked = order_number(
        rows.where("realized_vol IS NOT NULL"), ["dt"], "realized_vol", "entity", "_r",
        group_bound=group_bound,
    )
    sizes = rows.groupBy("dt").agg(F.count("realized_vol").alias("_n"))
    # edges are multiples of (n-1)/cohorts; the rounding keeps exact edges in the lower group
    slot = F.ceil(F.round((F.col("_r") - 1) * F.lit(float(cohorts)) / (F.col("_n") - 1), 9))
    return (
        ranked.join(sizes, "dt")
        .withColumn("cohort", F.when(F.col("_n") > 1, F.greatest(slot, F.lit(1)) - 1))
        .drop("_r", "_n")
    )


def ts_zscore(
    rows: DataFrame, values: list[str], window: int, min_periods: int = 60, dt: str = "dt"
) -> DataFrame:
    """Past-only z-score of per-date values: one row per date first, then the frame that ends the
    day before, then back onto every row."""
    per_date = rows.groupBy(dt).agg(*[F.first(v).alias(v) for v in values])
    # a calendar of dates, one row each
    past = Window.orderBy(dt).rowsBetween(-window, -1)
    cols = {}
    for v in values:
        z = ratio(F.col(v) - F.avg(v).over(past), F.stddev_samp(v).over(past))
        cols[f"{v}_z"] = F.when(F.count(v).over(past) >= min_periods, z)
    return rows.join(per_date.withColumns(cols).drop(*values), dt, "left")


# --- macro series ----------------------------------------------------------------------------

# Features of the composite and their direction of stress.
COMPOSITE_WEIGHTS = {
    "vix_level": 1.0,
    "hy_oas_bps": 1.0,
    "yield_curve_slope": -1.0,
    "spy_20d_return": -1.0,
    "market_breadth": -1.0,
    "vix_term_slope": -1.0,
}
MACRO_ROLES = ("SPY", "VIX", "VIX3M", "HYOAS", "TNX", "TWO")


def macro_wide(series: DataFrame, roles: tuple[str, ...] = MACRO_ROLES) -> DataFrame:
    """(symbol, dt, close) to one forward-filled row per date; absent symbols are empty columns."""
    wide = series.groupBy("dt").pivot("symbol", list(roles)).agg(F.first("close"))
    past = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return wide.select("dt", *[F.last(r, ignorenulls=True).over(past).alias(r) for r in roles])


def _macro_levels(change: int) -> dict[str, Column]:
    spy = F.col("SPY")
    return {
        "spy_20d_return": ratio(spy, F.lag("SPY", change).over(Window.orderBy("dt"))) - 1,
        "vix_level": F.col("VIX"),
        "vix_term_slope": F.col("VIX3M") - F.col("VIX"),
        "hy_oas_bps": F.col("HYOAS") * 100.0,
        "yield_curve_slope": F.col("TNX") - F.col("TWO"),
        "market_breadth": F.lit(None).cast("double"),
    }


def newest_dates(df: DataFrame, keep: int | None, dt: str = "dt") -> DataFrame:
    return df if keep is None else df.orderBy(F.col(dt).desc()).limit(keep)


def macro_daily(wide: DataFrame, change: int = 20, look_back: int | None = None) -> DataFrame:
    cols = _macro_levels(change)
    out = wide.select("dt", *[c.alias(n) for n, c in cols.items()])
    return newest_dates(out.where("spy_20d_return IS NOT NULL"), look_back)


def macro_weekly(wide: DataFrame, change: int = 4, look_back: int | None = 520) -> DataFrame:
    """Friday-ending weeks on a complete calendar; a week without rows stays empty."""
    friday = F.next_day(F.date_sub("dt", 1), "FRI")
    weeks = wide.groupBy(friday.alias("dt")).agg(
        *[F.max_by(r, F.when(F.col(r).isNotNull(), F.col("dt"))).alias(r) for r in MACRO_ROLES]
    )
    calendar = weeks.agg(F.min("dt").alias("a"), F.max("dt").alias("b")).select(
        F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("dt")
    )
    return macro_daily(calendar.join(weeks, "dt", "left"), change, look_back)


def latest_row(df: DataFrame, dt: str = "dt") -> DataFrame:
    """The newest row as (feature, value) pairs without the missing ones."""
    names = [c for c in df.columns if c != dt]
    last = df.agg(
        F.max_by(F.struct(dt, *names), F.col(dt)).alias("r")
    ).select("r.*")
    return last.unpivot([dt], names, "feature", "value").where(finite("value").isNotNull())


def macro_panel(
    wide: DataFrame, breadth: DataFrame | None = None, window: int = 20, change: int = 21
) -> DataFrame:
    """Daily macro feature panel on the market's dates. ``wide`` must carry SPY, VIX, VIX3M, TNX,
    IRX, TWO, HYOAS, BAA10Y (all forward-filled, NULL columns where a series is absent)."""
    w = Window.orderBy("dt")
    spy = F.col("SPY")
    base = wide.withColumn("_lr", F.ln(ratio(spy, F.lag("SPY").over(w))))
    neutral = F.lit(0.0)

    def spread(a: str, b: str, scale: float) -> Column:
        return (F.col(a) - F.col(b)) / scale

    cols = {
        "spy_20d_return": ratio(spy, F.lag("SPY", window).over(w)) - 1,
        "spy_20d_vol": full_frame(
            F.col("_lr"), F.stddev_samp("_lr"), w.rowsBetween(1 - window, 0), window
        ) * (252.0**0.5),
        "vix_level": F.col("VIX") / 20.0,
        "vix_term_slope": spread("VIX", "VIX3M", 20.0),
        "vix_vix3m_ratio": F.coalesce(ratio(F.col("VIX"), F.col("VIX3M")), F.lit(1.0)),
        "yield_curve_slope": spread("TNX", "IRX", 10.0),
        "yield_curve_10y_2y": spread("TNX", "TWO", 10.0),
        "hy_oas_level": F.col("HYOAS"),
        "hy_oas_change_21d": F.col("HYOAS") - F.lag("HYOAS", change).over(w),
        "baa10y_level": F.col("BAA10Y"),
        "baa10y_change_21d": F.col("BAA10Y") - F.lag("BAA10Y", change).over(w),
    }
    defaults = {"vix_level": F.lit(1.0), "vix_vix3m_ratio": F.lit(1.0)}
    needs = {
        "vix_level": ["VIX"], "vix_term_slope": ["VIX", "VIX3M"], "vix_vix3m_ratio": ["VIX", "VIX3M"],
        "yield_curve_slope": ["TNX", "IRX"], "yield_curve_10y_2y": ["TNX", "TWO"],
        "hy_oas_level": ["HYOAS"], "hy_oas_change_21d": ["HYOAS"],
        "baa10y_level": ["BAA10Y"], "baa10y_change_21d": ["BAA10Y"],
    }
    have = set(wide.columns)
    out = base.select(
        "dt",
        *[
            (c if set(needs.get(n, [])) <= have else defaults.get(n, neutral)).alias(n)
            for n, c in cols.items()
            if set(needs.get(n, [])) <= have or n in needs
        ],
    )
    if breadth is not None:
        out = out.join(breadth, "dt", "left")
    else:
        out = out.withColumns({"market_breadth": F.lit(0.5), "market_breadth_200d": F.lit(0.5)})
    return out.dropna()


def market_breadth(
    panel: DataFrame, dates: DataFrame, fast: int = 50, slow: int = 200, min_names: int = 10
) -> DataFrame:
    """Share of entities above their own moving average per date. Rows inside the warm-up count as
    below; entities shorter than the window do not count at all."""
    w = by_entity()
    whole = Window.partitionBy("entity")

    def above(n: int) -> Column:
        mean = full_frame(F.col("close"), F.avg("close"), w.rowsBetween(1 - n, 0), n)
        flag = F.coalesce((F.col("close") > mean).cast("double"), F.lit(0.0))
        return F.when(F.count(F.lit(1)).over(whole) >= n, flag)

    flags = panel.select("dt", above(fast).alias("f"), above(slow).alias("s"))
    shares = flags.groupBy("dt").agg(
        F.when(F.count("f") >= min_names, F.avg("f")).alias("f"),
        F.when(F.count("s") >= min_names, F.avg("s")).alias("s"),
    )
    past = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    joined = dates.select("dt").distinct().join(shares, "dt", "left")

    def filled(c: str) -> Column:
        return F.coalesce(F.last(c, ignorenulls=True).over(past), F.lit(0.5))

    return joined.select(
        "dt", filled("f").alias("market_breadth"), filled("s").alias("market_breadth_200d")
    )


def _composite(
    features: DataFrame, weights: dict[str, float], first: int, last: int, name: str
) -> DataFrame:
    """Null-aware weighted mean of population z-scores over the rows [first, last].

    Long frames are differences of running sums (of values less the series' first one), so the
    cost does not grow with the frame. A variance below the rounding noise of the sums so far counts as
    zero; no row looks at later ones.
    """
    used = [f for f in weights if f in features.columns]
    order = Window.orderBy("dt")
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    upto = order.rowsBetween(Window.unboundedPreceding, last)
    before = order.rowsBetween(Window.unboundedPreceding, first - 1)

    def framed(col: Column) -> Column:
        zero = F.lit(0.0)
        return F.coalesce(F.sum(col).over(upto), zero) - F.coalesce(F.sum(col).over(before), zero)

    # every row with a value has the same first one
    work = features.withColumns({f"_d_{f}": F.col(f) - F.first(f, ignorenulls=True).over(past) for f in used})
    work = work.withColumns(
        {f"_n_{f}": framed(F.col(f).isNotNull().cast("double")) for f in used}
        | {f"_s_{f}": framed(F.col(f"_d_{f}")) for f in used}
        | {f"_q_{f}": framed(F.col(f"_d_{f}") * F.col(f"_d_{f}")) for f in used}
        | {f"_v_{f}": F.sum(F.col(f"_d_{f}") * F.col(f"_d_{f}")).over(upto) for f in used}
    )
    total, norm = F.lit(0.0), F.lit(0.0)
    for f in used:
        n, d = F.col(f"_n_{f}"), F.col(f"_d_{f}")
        mean = ratio(F.col(f"_s_{f}"), n)
        var = ratio(F.col(f"_q_{f}"), n) - mean * mean
        noise = 1e-13 * ratio(F.col(f"_v_{f}"), n)
        z = F.coalesce((d - mean) / F.sqrt(F.when(var > noise, var)), F.lit(0.0))
        present = F.col(f).isNotNull()
        total = total + F.when(present, z * weights[f]).otherwise(0.0)
        norm = norm + F.when(present, F.lit(abs(weights[f]))).otherwise(0.0)
    return work.select(
        *features.columns,
        F.coalesce(ratio(total, norm), F.lit(0.0)).alias(name),
        F.row_number().over(order).alias("_pos"),
    )


def composite_intensity(
    features: DataFrame, weights: dict[str, float] | None = None, window: int = 260
) -> DataFrame:
    """Stress composite of each row against the trailing window that ends with it."""
    out = _composite(features, weights or COMPOSITE_WEIGHTS, 1 - window, 0, "intensity_z")
    return out.drop("_pos")


def intensity_series(
    features: DataFrame, weights: dict[str, float] | None = None, window: int = 260,
    min_history: int = 4,
) -> DataFrame:
    """Risk-on orientation over strictly prior rows; the first rows are neutral."""
    out = _composite(features, weights or COMPOSITE_WEIGHTS, -window, -1, "intensity_z")
    neutral = F.when(F.col("_pos") <= min_history, F.lit(0.0))
    return out.withColumn("intensity_z", neutral.otherwise(-F.col("intensity_z"))).drop("_pos")


def intensity_replay(
    features: DataFrame, weights: dict[str, float] | None = None, window: int = 1260,
    min_rows: int = 60,
) -> DataFrame:
    """Daily replay: the window includes the current row, short histories are left out."""
    out = _composite(features, weights or COMPOSITE_WEIGHTS, -window, 0, "intensity_z")
    return (
        out.where(F.col("_pos") >= min_rows)
        .withColumn("intensity_z", -F.col("intensity_z"))
        .drop("_pos")
    )


def regime_labels(market: DataFrame, horizon: int = 20, bear: float = -0.03, bull: float = 0.03) -> DataFrame:
    """0 bear, 1 neutral, 2 bull from the forward market return; the open tail is neutral."""
    fwd = ratio(F.lead("market_close", horizon).over(Window.orderBy("dt")), F.col("market_close")) - 1
    return market.withColumn("_fwd", fwd).select(
        "dt", F.when(F.col("_fwd") < bear, 0).when(F.col("_fwd") > bull, 2).otherwise(1).alias("label")
    )


# --- selections ------------------------------------------------------------------------------


def nonoverlap_dates(rows: DataFrame, gaps: list[int], dt: str = "dt") -> DataFrame:
    """(gap, dt) of the dates that a greedy walk over the sorted distinct dates keeps, for each gap: a date is kept
    when it is at least ``gap`` calendar days behind the last kept one.

    The state is the number of days since the last kept date, below the gap; a date maps states to states by
    the days since the date before, so the walk is a scan of maps.
    """
    gaps = sorted({max(1, g) for g in gaps})
    days = cut_lineage(rows.select(dt).where(F.col(dt).isNotNull()).distinct())
    longest = days.count()
    each = days.withColumn("gap", F.explode(F.array(*[F.lit(g) for g in gaps])))
    by_gap = Window.partitionBy("gap").orderBy(dt)
    since = F.datediff(dt, F.lag(dt).over(by_gap))
    each = each.withColumn("_since", F.least(F.coalesce(since, F.col("gap")), F.col("gap")))
    step = F.transform(
        F.sequence(F.lit(0), F.lit(gaps[-1] - 1)),
        lambda s: F.when(s + F.col("_since") >= F.col("gap"), 0).otherwise(s + F.col("_since")),
    )
    walked = scan_maps(each, by_gap, step, PACKED + 1, 0, longest, "_state")
    return walked.where("_state = 0").select("gap", dt)


def nonoverlap_rows(rows: DataFrame, gap_days: int, tiebreak: str = "entity", dt: str = "dt") -> DataFrame:
    """One row per kept date, the first by ``tiebreak``."""
    first = rows.groupBy(dt).agg(F.min(tiebreak).alias(tiebreak))
    return rows.join(first.join(nonoverlap_dates(rows, [gap_days], dt), dt), [dt, tiebreak], "left_semi")


def top_k_per_group(
    rows: DataFrame, keys: list[str], value: str, k: int, tiebreak: str = "entity",
    descending: bool = True,
) -> DataFrame:
    """The k best rows of each group. Each task keeps only its own k best before the shuffle."""
    names = [c for c in rows.columns if c not in keys]
    sign = -1 if descending else 1
    local = rows.where(F.col(value).isNotNull()).withColumn("_o", F.round(F.col(value), 10) * sign)
    order = [F.col("_o"), F.col(tiebreak)]
    # first cut inside salted slices of a group, second cut over the at most slices*k survivors
    salted = local.withColumn("_salt", F.pmod(F.xxhash64(tiebreak), F.lit(64)))
    cut = salted.withColumn(
        "_p", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    ).where(F.col("_p") <= k)
    final = cut.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return final.where(F.col("rn") <= k).select(*keys, *names, "rn")


def recency_cap(rows: DataFrame, max_rows: int, tiebreak: str = "entity", dt: str = "dt") -> DataFrame:
    """The newest ``max_rows`` rows. Whole dates are decided from per-date counts; only the date the
    cap falls on needs an order among its rows (the largest ``tiebreak`` counts as newest)."""
    counts = rows.groupBy(dt).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.orderBy(F.col(dt).desc()).rowsBetween(Window.unboundedPreceding, -1)
    room = counts.withColumn("_room", max_rows - F.coalesce(F.sum("_n").over(newer), F.lit(0))).where(
        "_room > 0"
    )
    tagged = rows.join(room, dt)
    whole = tagged.where("_n <= _room")
    edge = tagged.where("_n > _room")
    ranks = rank_table(edge, [dt], tiebreak).select(dt, tiebreak, "below", "total")
    part = edge.join(ranks, [dt, tiebreak]).where("total - below <= _room").drop("below", "total")
    return whole.unionByName(part).drop("_n", "_room")
