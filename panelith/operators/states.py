"""Drawdown states, episodes, price adjustment and sequential change-point detection."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions.columns import by_entity, ratio
from panelith.functions.scans import scan_states
from panelith.session import cut_lineage, spread


@dataclass(frozen=True)
class DrawdownBands:
    # Depth below the running peak, as a fraction of it.
    caution_enter: float = 0.05
    caution_exit: float = 0.03
    risk_off_enter: float = 0.10
    risk_off_exit: float = 0.07
    excess_enter: float = 0.05
    excess_exit: float = 0.02
    min_persist: int = 1


def drawdown(close: str = "close") -> Column:
    peak = F.max(close).over(by_entity().rowsBetween(Window.unboundedPreceding, 0))
    return ratio(F.col(close), peak) - 1


def drawdown_stretches(rows: DataFrame, enter: float = 0.10, exit: float = 0.05) -> DataFrame:
    """(entity, start_dt, end_dt) of deep drawdowns: in at ``enter``, out at ``exit``, both by the
    last crossing seen. The end is the recovery date; an open stretch ends with the series."""
    w = by_entity()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    dd = F.round(F.col("_dd"), 12)
    event = F.when(dd <= -enter, 1).when(dd >= -exit, 0)
    rows = rows.where("close IS NOT NULL").withColumn("_dd", drawdown())
    rows = rows.withColumn("_in", F.coalesce(F.last(event, ignorenulls=True).over(upto), F.lit(0)))
    begins = (F.col("_in") == 1) & (F.coalesce(F.lag("_in").over(w), F.lit(0)) == 0)
    rows = rows.withColumn("_id", F.sum(begins.cast("int")).over(upto)).withColumn(
        "_last", F.max("dt").over(Window.partitionBy("entity"))
    )
    return (
        rows.where("_id > 0")
        .groupBy("entity", "_id")
        .agg(
            F.min("dt").alias("start_dt"),
            F.coalesce(F.min(F.when(F.col("_in") == 0, F.col("dt"))), F.max("_last")).alias("end_dt"),
        )
        .drop("_id")
    )


def episodes(rows: DataFrame, flag: str, keys: list[str] | None = None) -> DataFrame:
    """(keys, start_dt, end_dt, rows) for every unbroken run of a true ``flag``."""
    keys = keys or ["entity"]
    w = Window.partitionBy(*keys).orderBy("dt")
    on = F.coalesce(F.col(flag), F.lit(False))
    change = (on != F.coalesce(F.lag(on).over(w), F.lit(False))).cast("int")
    tagged = rows.select(*keys, "dt", on.alias("_on"), change.alias("_c"))
    tagged = tagged.withColumn(
        "_run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        tagged.where("_on")
        .groupBy(*keys, "_run")
        .agg(
            F.min("dt").alias("start_dt"),
            F.max("dt").alias("end_dt"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .drop("_run")
    )


def episode_stats(
    rows: DataFrame, flag: str, keys: list[str] | None = None, periods: float = 252.0,
    min_dwell: float = 4.0,
) -> DataFrame:
    """Counts, toggles per year, dwell (calendar days scaled to trading days) per series."""
    keys = keys or ["entity"]
    days = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sum(F.coalesce(F.col(flag), F.lit(False)).cast("int")).alias("n_on"),
    )
    return _run_stats(days, episodes(rows, flag, keys), keys, periods, min_dwell)


def _run_stats(days: DataFrame, runs: DataFrame, keys: list[str], periods: float, min_dwell: float) -> DataFrame:
    runs = runs.withColumn("_dwell", F.datediff("end_dt", "start_dt") * (periods / 365.0))
    runs = runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_episodes"),
        F.avg("_dwell").alias("mean_dwell"),
        F.avg((F.col("_dwell") < min_dwell).cast("double")).alias("share_short"),
    )
    out = days.join(runs, keys, "left").na.fill(0, ["n_episodes", "mean_dwell", "share_short"])
    return out.withColumn(
        "toggles_per_year", F.col("n_episodes") / F.greatest(F.col("n_days") / periods, F.lit(1e-9))
    )


def state_run_length(rows: DataFrame, state: str, keys: list[str] | None = None) -> DataFrame:
    """Adds how many rows in a row the current state has lasted."""
    keys = keys or ["entity"]
    w = Window.partitionBy(*keys).orderBy("dt")
    change = (~F.col(state).eqNullSafe(F.lag(state).over(w))).cast("int")
    tagged = rows.withColumn("_c", change).withColumn(
        "_run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    inside = Window.partitionBy(*keys, "_run").orderBy("dt")
    return tagged.withColumn("run_length", F.row_number().over(inside)).drop("_c", "_run")


def persist(now: str, proposed: str, pend: str | None, n: int, needed: int):
    """(state, waiting for, observations waited): a change takes ``needed`` proposals in a row."""
    if proposed == now:
        return now, None, 0
    n = n + 1 if pend == proposed else 1
    return (proposed, None, 0) if n >= needed else (now, proposed, n)


def propose_tier(tier: str, deep: bool, shallow: bool, recovered: bool, entered: bool) -> str:
    """Where the ladder would go from ``tier``: depth at or beyond the outer bands, past the inner ones."""
    if deep or shallow:
        return "risk_off" if deep else "risk_on"
    if tier == "risk_off":
        return "caution" if recovered else "risk_off"
    return "caution" if tier == "caution" or entered else "risk_on"


def propose_excess(held: str, low: bool, high: bool) -> str:
    if held == "alpha_bleed":
        return "risk_on" if low else held
    return "alpha_bleed" if high else held


def tier_walk(
    pdf: pd.DataFrame, bands: DrawdownBands, state: dict | None = None
) -> tuple[pd.DataFrame, dict]:
    """One entity's ordered observations (dt, close, nav) through the two-leg ladder.

    ``state`` continues an earlier walk; dates at or before its last one are ignored. Used where the
    persistence gate or a carried state makes the ladder truly sequential.
    """
    st = dict(state) if state else {
        "tier": "risk_on", "excess_tier": "risk_on", "peak": None, "nav_peak": None,
        "pend": None, "pend_n": 0, "ex_pend": None, "ex_pend_n": 0, "last_dt": None, "seen": 0,
    }

    out = []
    for dt, close, nav in zip(pdf["dt"], pdf["close"], pdf["nav"]):
        if st["last_dt"] is not None and dt <= st["last_dt"]:
            continue
        st["peak"] = close if st["peak"] is None else max(st["peak"], close)
        dd = close / st["peak"] - 1.0
        depth, tier = round(-dd, 12), st["tier"]
        proposed = propose_tier(
            tier, depth >= bands.risk_off_enter, depth <= bands.caution_exit, depth <= bands.risk_off_exit, depth >= bands.caution_enter
        )
        st["tier"], st["pend"], st["pend_n"] = persist(
            tier, proposed, st["pend"], st["pend_n"], bands.min_persist
        )
        excess = None
        if nav is None or nav != nav:
            st["excess_tier"], st["ex_pend"], st["ex_pend_n"] = "risk_on", None, 0
        else:
            st["nav_peak"] = nav if st["nav_peak"] is None else max(st["nav_peak"], nav)
            excess = max(dd - (nav / st["nav_peak"] - 1.0), 0.0)
            level, held = round(excess, 12), st["excess_tier"]
            proposed = propose_excess(held, level <= bands.excess_exit, level >= bands.excess_enter)
            st["excess_tier"], st["ex_pend"], st["ex_pend_n"] = persist(
                held, proposed, st["ex_pend"], st["ex_pend_n"], bands.min_persist
            )
        st["last_dt"], st["seen"] = dt, st["seen"] + 1
        out.append((dt, dd, st["tier"], excess, st["excess_tier"]))
    cols = ["dt", "drawdown", "tier", "excess", "excess_tier"]
    return pd.DataFrame(out, columns=cols), st


def drawdown_tiers(rows: DataFrame, bands: DrawdownBands = DrawdownBands()) -> DataFrame:
    """Tier per row of (entity, dt, close, nav).

    Without a persistence gate the ladder needs no loop: depths at or beyond the outer bands fix the
    tier whatever came before, and between two such rows the tier can change once, to caution, on
    the first depth that crosses the inner band of the side it came from.
    """
    if bands.min_persist > 1:
        return gated_tiers(rows, bands)
    w = by_entity()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"drawdown": drawdown(), "_nav_dd": drawdown("nav")})
    rows = rows.withColumn("_depth", F.round(-F.col("drawdown"), 12))
    fixed = F.when(F.col("_depth") >= bands.risk_off_enter, "risk_off").when(
        F.col("_depth") <= bands.caution_exit, "risk_on"
    )
    rows = rows.withColumn("_fixed", fixed)
    rows = rows.withColumns(
        {
            "_base": F.coalesce(F.last("_fixed", ignorenulls=True).over(upto), F.lit("risk_on")),
            "_seg": F.count("_fixed").over(upto),
        }
    )
    seg = Window.partitionBy("entity", "_seg").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    tier = (
        F.when(
            (F.col("_base") == "risk_off") & (F.min("_depth").over(seg) <= bands.risk_off_exit), "caution"
        )
        .when(
            (F.col("_base") == "risk_on") & (F.max("_depth").over(seg) >= bands.caution_enter), "caution"
        )
        .otherwise(F.col("_base"))
    )
    # a missing nav clears the excess tier, so each of its events is final
    excess = F.when(
        F.col("nav").isNotNull(), F.greatest(F.col("drawdown") - F.col("_nav_dd"), F.lit(0.0))
    )
    rows = rows.withColumns({"tier": tier, "excess": excess})
    level = F.round("excess", 12)
    event = (
        F.when(F.col("nav").isNull() | (level <= bands.excess_exit), "risk_on")
        .when(level >= bands.excess_enter, "alpha_bleed")
    )
    rows = rows.withColumn(
        "excess_tier", F.coalesce(F.last(event, ignorenulls=True).over(upto), F.lit("risk_on"))
    )
    return rows.select("entity", "dt", "drawdown", "tier", "excess", "excess_tier")


def longest_series(rows: DataFrame, keys: list[str]) -> int:
    """Rows of the longest series: a count before the scan, bounded by the calendar."""
    return rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1


def gated_tiers(rows: DataFrame, bands: DrawdownBands) -> DataFrame:
    """The ladder with a persistence gate: both legs are finite-state machines whose transition maps
    are scanned (a state is a tier, what it waits for, and for how long)."""
    m = bands.min_persist

    def machine(tiers: list[str], symbols: int, move) -> tuple[list, list[list[int]]]:
        states = [(t, None, 0) for t in tiers] + [(t, p, n) for t in tiers for p in tiers if p != t for n in range(1, m)]
        return states, [[states.index(move(symbol, *state)) for state in states] for symbol in range(symbols)]

    def tier_move(symbol: int, tier, pend, n):
        a, b = divmod(max(symbol - 2, 0), 2)
        return persist(tier, propose_tier(tier, symbol == 0, symbol == 1, bool(b), bool(a)), pend, n, m)

    def excess_move(symbol: int, held, pend, n):
        if symbol == 0:
            return "risk_on", None, 0
        high, low = divmod(symbol - 1, 2)
        return persist(held, propose_excess(held, bool(low), bool(high)), pend, n, m)

    def whole(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("int")

    w = by_entity()
    rows = cut_lineage(rows.select("entity", "dt", "close", F.when(~F.isnan("nav"), F.col("nav")).alias("nav")))
    longest = longest_series(rows, ["entity"])
    rows = rows.withColumns({"drawdown": drawdown(), "_nav_dd": drawdown("nav")})
    rows = rows.withColumn(
        "excess", F.when(F.col("nav").isNotNull(), F.greatest(F.col("drawdown") - F.col("_nav_dd"), F.lit(0.0)))
    )
    depth, level = F.round(-F.col("drawdown"), 12), F.round("excess", 12)
    tier_symbol = F.when(depth >= bands.risk_off_enter, 0).when(depth <= bands.caution_exit, 1).otherwise(
        2 + whole(depth <= bands.risk_off_exit) + 2 * whole(depth >= bands.caution_enter)
    )
    excess_symbol = F.when(level.isNull(), 0).otherwise(1 + whole(level <= bands.excess_exit) + 2 * whole(level >= bands.excess_enter))
    legs = (
        ("tier", tier_symbol, machine(["risk_on", "caution", "risk_off"], 6, tier_move)),
        ("excess_tier", excess_symbol, machine(["risk_on", "alpha_bleed"], 5, excess_move)),
    )
    for name, symbol, (states, tables) in legs:
        rows = scan_states(rows, w, symbol, tables, 0, longest, "_state")
        names = F.array(*[F.lit(t) for t, _, _ in states])
        rows = rows.withColumn(name, F.get(names, F.col("_state")))
    return rows.select("entity", "dt", "drawdown", "tier", "excess", "excess_tier")


def adjust_dividends(prices: DataFrame, dividends: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Backward adjustment: a price is scaled by (1 - amount / close before ex-date) for every later
    ex-date up to the last bar; ratios outside (0, 1] are ignored.

    prices: (entity, dt, close, ...); dividends: (entity, ex_dt, amount).
    """
    columns = columns or ["close"]
    bars = prices.withColumns({"_kind": F.lit(1), "amount": F.lit(None).cast("double")})
    events = dividends.select(
        "entity", F.col("ex_dt").alias("dt"), F.lit(0).alias("_kind"), "amount"
    )
    line = bars.unionByName(events, allowMissingColumns=True)
    order = Window.partitionBy("entity").orderBy("dt", "_kind", "amount")
    before = F.last("close", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    last_bar = F.max(F.when(F.col("_kind") == 1, F.col("dt"))).over(Window.partitionBy("entity"))
    step = 1 - ratio(F.col("amount"), F.when(before > 0, before))
    line = line.withColumn("_step", F.when((F.col("_kind") == 0) & (F.col("dt") <= last_bar), step))
    logs = F.when((F.col("_step") > 0) & (F.col("_step") <= 1), F.ln("_step"))
    later = F.sum(logs).over(order.rowsBetween(1, Window.unboundedFollowing))
    line = line.withColumn("_factor", F.exp(F.coalesce(later, F.lit(0.0))))
    out = line.where("_kind = 1")
    return out.withColumns({f"adj_{c}": F.col(c) * F.col("_factor") for c in columns}).drop(
        "_kind", "amount", "_step", "_factor"
    )


# --- change points ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ChangePointPrior:
    # Daily prior of the run-length model.
    hazard: float = 1.0 / 500.0
    mu: float = 0.0
    kappa: float = 1.0
    alpha: float = 1.0
    beta: float = 1.0
    horizon: int = 504


@dataclass(frozen=True)
class LatchRules:
    # Confirmation and release rules of the latch.
    change_threshold: float = 0.5
    floor: float = -1.0
    exit_band: float = -0.3
    min_persist: int = 2
    min_clear: int = 4
    min_run: int = 5


@lru_cache(maxsize=8)
def run_constants(kappa: float, alpha: float, n: int) -> tuple[np.ndarray, ...]:
    """What follows from the run length alone, for n of them: log normalising constant, exponent and degrees of freedom
    of the predictive density, factor of its width, pseudo-count, factor of the squared error."""
    k = np.arange(n)
    kappas, shapes = kappa + k, alpha + 0.5 * k
    norms = np.array([math.lgamma(a + 0.5) - math.lgamma(a) - 0.5 * math.log(2 * a * math.pi) for a in shapes])
    return norms, shapes + 0.5, 2 * shapes, (kappas + 1) / (shapes * kappas), kappas, kappas / (2 * (kappas + 1))


class RunLengthPosterior:
    """Run-length distribution of a Gaussian series with unknown mean and variance.

    Slot k belongs to run length k; its pseudo-count, shape and degrees of freedom follow from k
    alone (until slots fold at the horizon), so only mass, mean and scale are carried.
    """

    def __init__(self, prior: ChangePointPrior, mass=None, mean=None, scale=None):
        self.prior = prior
        self.mass = np.asarray([1.0] if mass is None else mass, dtype=float)
        self.mean = np.asarray([prior.mu] if mean is None else mean, dtype=float)
        self.scale = np.asarray([prior.beta] if scale is None else scale, dtype=float)
        self._fixed = run_constants(prior.kappa, prior.alpha, max(prior.horizon, len(self.mass)))

    def observe(self, x: float) -> None:
        p, n = self.prior, len(self.mass)
        norm, power, twice, widen, kappa, gain = (c[:n] for c in self._fixed)
        gap = x - self.mean
        spread = np.sqrt(self.scale * widen)
        u = gap / spread
        joint = self.mass * np.exp(norm - power * np.log1p(u * u / twice)) / spread
        mass, mean, scale = np.empty(n + 1), np.empty(n + 1), np.empty(n + 1)
        mass[0], mean[0], scale[0] = p.hazard * joint.sum(), p.mu, p.beta
        np.multiply(joint, 1 - p.hazard, out=mass[1:])
        total = mass.sum()
        if total > 0:
            mass /= total
        np.divide(kappa * self.mean + x, kappa + 1, out=mean[1:])
        np.add(self.scale, gap * gap * gain, out=scale[1:])
        if len(mass) > p.horizon:
            mass[p.horizon - 1] += mass[p.horizon:].sum()
            mass, mean, scale = mass[: p.horizon], mean[: p.horizon], scale[: p.horizon]
        self.mass, self.mean, self.scale = mass, mean, scale

    def short_mass(self, run: int) -> float:
        return float(self.mass[:run].sum())

    def top_mass(self) -> float:
        return float(self.mass.max())


def latch_move(on: bool, changes: int, clears: int, broke: bool, above: bool, young: bool, rules: LatchRules):
    """(on, changes, clears) after one observation: on after enough breaks in a row, off after enough quiet
    ones once the value is above the exit band, off while the series is young."""
    changes = changes + 1 if broke else 0
    clears = 0 if broke else clears + 1
    if not on and changes >= rules.min_persist:
        on = True
    elif on and clears >= rules.min_clear and above:
        on = False
    return on and not young, changes, clears


def latch_step(state: dict, z: float, change: float, rules: LatchRules) -> dict:
    """One observation of the two-leg latch; ``state`` holds on, changes, clears, seen."""
    broke = change > rules.change_threshold and z < rules.floor
    seen = state["seen"] + 1
    on, changes, clears = latch_move(
        state["on"], state["changes"], state["clears"], broke, z > rules.exit_band, seen < rules.min_run, rules
    )
    return {"on": on, "changes": changes, "clears": clears, "seen": seen}


def latch_machine(rules: LatchRules) -> tuple[list, list[list[int]]]:
    """(states, tables): counts stop at what the rules ask for; symbols are broke + 2 above + 4 young."""
    counts = [(c, 0) for c in range(rules.min_persist + 1)] + [(0, c) for c in range(1, rules.min_clear + 1)]
    states = [(on, *c) for on in (False, True) for c in counts]

    def move(symbol: int, state) -> int:
        on, changes, clears = latch_move(*state, bool(symbol & 1), bool(symbol & 2), bool(symbol & 4), rules)
        return states.index((on, min(changes, rules.min_persist), min(clears, rules.min_clear)))

    return states, [[move(symbol, state) for state in states] for symbol in range(8)]


def scan_latch(rows: DataFrame, keys: list[str], change: str, rules: LatchRules, longest: int, out: str) -> DataFrame:
    """Adds the latch to rows of (keys, dt, z, ``change``)."""
    w = Window.partitionBy(*keys).orderBy("dt")
    states, tables = latch_machine(rules)
    broke = (F.col(change) > rules.change_threshold) & (F.col("z") < rules.floor)
    symbol = broke.cast("int") + 2 * (F.col("z") > rules.exit_band).cast("int")
    symbol = symbol + 4 * (F.row_number().over(w) < rules.min_run).cast("int")
    rows = scan_states(rows.withColumn("_symbol", symbol), w, F.col("_symbol"), tables, 0, longest, "_state")
    half = len(states) // 2
    return rows.withColumn(out, F.col("_state") >= half).drop("_symbol", "_state")


NEW_LATCH = {"on": False, "changes": 0, "clears": 0, "seen": 0}


#: series whose posteriors advance together in one task
TOGETHER = 256


def run_length_masses(series: list[np.ndarray], hazards: np.ndarray, prior: ChangePointPrior, runs: list[int]):
    """Per series, with a hazard of its own: an array (observations x (runs + 1)) with the mass on each number of
    shortest runs, and the mass of the likeliest run."""
    return run_length_grid(series, np.asarray(hazards, float)[None], prior, runs)[0]


def run_length_grid(series: list[np.ndarray], hazards: np.ndarray, prior: ChangePointPrior, runs: list[int]):
    """The same for every row of ``hazards`` (grid x series). One matrix (series x run lengths) advances one
    observation a step; densities do not depend on the hazard, only the masses are kept for each."""
    order = sorted(range(len(series)), key=lambda i: -len(series[i]))
    sizes = np.array([len(series[i]) for i in order])
    values = np.zeros((len(series), int(sizes.max(initial=0))))
    for row, i in enumerate(order):
        values[row, : sizes[row]] = series[i]
    grid, n = len(hazards), len(series)
    found = np.empty((values.shape[1], grid, n, len(runs) + 1))
    h = np.asarray(hazards, float)[:, order, None]
    mass, mean, scale = np.ones((grid, n, 1)), np.full((n, 1), prior.mu), np.full((n, 1), prior.beta)
    fixed = run_constants(prior.kappa, prior.alpha, prior.horizon + 1)
    for t in range(values.shape[1]):
        # series are in order of falling length: those still running are the first ones
        n = int(np.searchsorted(-sizes, -t, "left"))
        mass, mean, scale, x = mass[:, :n], mean[:n], scale[:n], values[:n, t : t + 1]
        norm, power, twice, widen, kappa, gain = (c[: mean.shape[1]] for c in fixed)
        gap = x - mean
        width = np.sqrt(scale * widen)
        u = gap / width
        joint = mass * np.exp(norm - power * np.log1p(u * u / twice)) / width
        mass = np.concatenate([h[:, :n] * joint.sum(axis=2, keepdims=True), (1 - h[:, :n]) * joint], axis=2)
        total = mass.sum(axis=2, keepdims=True)
        mass /= np.where(total > 0, total, 1.0)
        mean = np.concatenate([np.full((n, 1), prior.mu), (kappa * mean + x) / (kappa + 1)], axis=1)
        scale = np.concatenate([np.full((n, 1), prior.beta), scale + gap * gap * gain], axis=1)
        if mean.shape[1] > prior.horizon:
            mass[..., prior.horizon - 1] += mass[..., prior.horizon :].sum(axis=2)
            mass, mean, scale = (a[..., : prior.horizon] for a in (mass, mean, scale))
        for j, run in enumerate(runs):
            found[t, :, :n, j] = mass[..., :run].sum(axis=2)
        found[t, :, :n, -1] = mass.max(axis=2)
    place = np.argsort(order)
    return [[np.ascontiguousarray(found[: len(x), g, place[i]]) for i, x in enumerate(series)] for g in range(grid)]


def run_length_posterior(
    rows: DataFrame, runs: list[int], prior: ChangePointPrior, hazards: list[float] | None = None
) -> DataFrame:
    """(entity, dt, z, hazard, short_<run>..., max_run_prob) for every row and hazard. rows: (entity, dt, z),
    written; groups of about ``TOGETHER`` series share a task's matrix."""
    hazards = hazards or [prior.hazard]
    names = [f"short_{run}" for run in runs] + ["max_run_prob"]
    schema = T.StructType(
        [rows.schema["entity"], rows.schema["dt"], T.StructField("z", T.DoubleType()), T.StructField("hazard", T.DoubleType())]
        + [T.StructField(c, T.DoubleType()) for c in names]
    )

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["entity", "dt"], kind="stable")
        first = np.flatnonzero(pdf["entity"].ne(pdf["entity"].shift()).to_numpy())
        series = np.split(pdf["z"].to_numpy(float), first[1:])
        many = run_length_grid(series, np.repeat(np.array(hazards)[:, None], len(series), axis=1), prior, runs)
        out = []
        for hazard, each in zip(hazards, many):
            block = np.concatenate(each)
            out.append(pdf[["entity", "dt", "z"]].assign(hazard=hazard, **{c: block[:, j] for j, c in enumerate(names)}))
        return pd.concat(out)[schema.names]

    n_entities = rows.select("entity").distinct().count()
    groups = max(1, -(-n_entities * len(hazards) // TOGETHER), min(n_entities, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    grouped = rows.select("entity", "dt", "z").withColumn("_group", F.pmod(F.xxhash64("entity"), F.lit(groups)))
    return spread(grouped, "_group").groupBy("_group").applyInPandas(replay, schema)


def change_points(
    rows: DataFrame, value: str = "z", prior: ChangePointPrior = ChangePointPrior(),
    rules: LatchRules = LatchRules(),
) -> DataFrame:
    """Per row: mass on short runs, mass of the likeliest run, change flag, latch. Posteriors of many entities
    advance together; the latch is a scan of transition maps."""
    source = cut_lineage(rows.where(F.col(value).isNotNull()).select("entity", "dt", F.col(value).alias("z")))
    found = run_length_posterior(source, [rules.min_run], prior).withColumnRenamed(f"short_{rules.min_run}", "change_confidence")
    found = scan_latch(found.drop("hazard"), ["entity"], "change_confidence", rules, longest_series(source, ["entity"]), "latched")
    signal = F.col("change_confidence") > rules.change_threshold
    return found.select("entity", "dt", "z", "change_confidence", "max_run_prob", signal.alias("change_signal"), "latched")


# The parameter grid of the replay.
HAZARDS = (1 / 250.0, 1 / 500.0, 1 / 750.0, 1 / 1000.0)
MIN_RUNS = (5, 10, 15)


def wide_replays(
    rows: DataFrame, value: str = "z", hazards=HAZARDS, min_runs=MIN_RUNS, rules: LatchRules = LatchRules(),
) -> DataFrame:
    """(entity, dt, hazard, on_<run>...): the latches of all run lengths beside each other."""
    source = cut_lineage(rows.where(F.col(value).isNotNull()).select("entity", "dt", F.col(value).alias("z")))
    longest = longest_series(source, ["entity"])
    found = run_length_posterior(source, list(min_runs), ChangePointPrior(), [float(h) for h in hazards])
    for m in min_runs:
        found = scan_latch(found, ["entity", "hazard"], f"short_{m}", replace(rules, min_run=m), longest, f"on_{m}")
    return found.select("entity", "dt", "hazard", *[f"on_{m}" for m in min_runs])


def latch_replays(
    rows: DataFrame, value: str = "z", hazards=HAZARDS, min_runs=MIN_RUNS,
    rules: LatchRules = LatchRules(),
) -> DataFrame:
    """(entity, dt, hazard, min_run, on) for every grid point. The posterior depends on the hazard
    only, so one pass per (entity, hazard) serves all run lengths."""
    found = wide_replays(rows, value, hazards, min_runs, rules)
    # three columns become three rows only now
    points = F.explode(F.array(*[F.struct(F.lit(m).alias("min_run"), F.col(f"on_{m}").alias("on")) for m in min_runs]))
    return found.select("entity", "dt", "hazard", points.alias("_p")).select("entity", "dt", "hazard", "_p.min_run", "_p.on")


def episode_leads(
    runs: DataFrame, stretches: DataFrame, keys: list[str], lead_days: int = 90, lag_days: int = 31,
    periods: float = 252.0, match: list[str] | None = None,
) -> DataFrame:
    """Per key: median lead of the nearest episode start within [-lead, +lag] days of each stretch
    onset, and the share of episodes that overlap no stretch.

    runs: (keys, start_dt, end_dt); stretches: (match, start_dt, end_dt) where ``match`` are the
    keys both share. Both sides are spread over months, so pairs meet by equality on (match, month)
    before the interval test.
    """
    match = match or keys

    def months(a: Column, b: Column) -> Column:
        first, last = F.trunc(a, "month"), F.trunc(b, "month")
        return F.explode(F.sequence(first, last, F.expr("interval 1 month")))

    onsets = stretches.select(*match, F.col("start_dt").alias("onset")).distinct()
    onset_cells = onsets.withColumn(
        "_m", months(F.date_sub("onset", lead_days), F.date_add("onset", lag_days))
    )
    starts = runs.select(*keys, "start_dt").withColumn("_m", F.trunc("start_dt", "month"))
    near = starts.join(onset_cells, [*match, "_m"]).where(
        F.col("start_dt").between(F.date_sub("onset", lead_days), F.date_add("onset", lag_days))
    )
    diff = F.datediff("onset", "start_dt")
    nearest = near.groupBy(*keys, "onset").agg(
        F.min_by(diff, F.struct(F.abs(diff), F.col("start_dt"))).alias("_d")
    )
    leads = nearest.groupBy(*keys).agg(
        F.median(F.col("_d") * (periods / 365.0)).alias("median_lead")
    )
    run_cells = runs.withColumn("_m", months(F.col("start_dt"), F.col("end_dt")))
    stretch_cells = stretches.select(
        *match, F.col("start_dt").alias("_s"), F.col("end_dt").alias("_e")
    ).withColumn("_m", months(F.col("_s"), F.col("_e")))
    hits = (
        run_cells.join(stretch_cells, [*match, "_m"])
        .where((F.col("start_dt") <= F.col("_e")) & (F.col("_s") <= F.col("end_dt")))
        .select(*keys, "start_dt")
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    fpr = (
        runs.join(hits, [*keys, "start_dt"], "left")
        .groupBy(*keys)
        .agg(F.avg(F.when(F.col("_hit").isNull(), 1.0).otherwise(0.0)).alias("false_positive_rate"))
    )
    return fpr.join(leads, keys, "left")


def latch_grid(
    rows: DataFrame, stretches: DataFrame, value: str = "z", periods: float = 252.0, **grid
) -> DataFrame:
    """Scores of every (entity, hazard, run length): dwell, toggles, lead, false positives."""
    keys = ["entity", "hazard", "min_run"]
    wide = cut_lineage(wide_replays(rows, value, **grid))
    min_runs = grid.get("min_runs", MIN_RUNS)
    # counts and runs are taken beside each other; a row per run length only where its latch is on
    w = Window.partitionBy("entity", "hazard").orderBy("dt")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    on = {m: F.coalesce(F.col(f"on_{m}"), F.lit(False)) for m in min_runs}
    days = wide.groupBy("entity", "hazard").agg(F.count(F.lit(1)).alias("n_days"), *[F.sum(c.cast("int")).alias(f"n_{m}") for m, c in on.items()])
    counts = F.explode(F.array(*[F.struct(F.lit(m).alias("min_run"), F.col(f"n_{m}").alias("n_on")) for m in min_runs]))
    days = days.select("entity", "hazard", "n_days", counts.alias("_p")).select("entity", "hazard", "_p.min_run", "n_days", "_p.n_on")
    tagged = wide.withColumns({f"_c{m}": (c != F.coalesce(F.lag(c).over(w), F.lit(False))).cast("int") for m, c in on.items()})
    tagged = tagged.withColumns({f"_run{m}": F.sum(f"_c{m}").over(upto) for m in min_runs})
    points = F.explode(F.array(*[F.struct(F.lit(m).alias("min_run"), c.alias("on"), F.col(f"_run{m}").alias("run")) for m, c in on.items()]))
    runs = tagged.select("entity", "hazard", "dt", points.alias("_p")).where("_p.on").groupBy(
        "entity", "hazard", F.col("_p.min_run").alias("min_run"), F.col("_p.run").alias("_run")
    ).agg(F.min("dt").alias("start_dt"), F.max("dt").alias("end_dt"), F.count(F.lit(1)).alias("n_rows")).drop("_run")
    runs = cut_lineage(runs)
    stats = _run_stats(days, runs, keys, periods, 4.0)
    leads = episode_leads(runs, stretches, keys, periods=periods, match=["entity"])
    return stats.join(leads, keys, "left").na.fill(0.0, ["false_positive_rate"])
