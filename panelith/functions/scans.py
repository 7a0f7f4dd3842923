"""Finite-state machines over time without a row loop.

A row is a function from state to state. Functions compose associatively, so after k doublings every row
holds the composition of the 2**k rows that end at it: lags over one window, which keep their partitioning
and sort. The composition of all rows so far, applied to the first state, is the state at the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

#: states that fit one long, four bits each
PACKED = 16


def _pack(table: list[int]) -> int:
    value = sum(to << (4 * s) for s, to in enumerate(table))
    return value - 2**64 if value >= 2**63 else value


def _compose(later: Column, earlier: Column, n: int) -> Column:
    """First ``earlier``, then ``later``."""
    if n > PACKED:
        return F.transform(earlier, lambda s: F.get(later, s))

    def at(packed: Column, place) -> Column:
        return F.call_function("shiftrightunsigned", packed, place).bitwiseAND(F.lit(15).cast("long"))

    out = None
    for s in range(n):
        to = at(later, (at(earlier, F.lit(4 * s)) * 4).cast("int"))
        part = F.shiftleft(to, 4 * s)
        out = part if out is None else out.bitwiseOR(part)
    return out


def scan_states(
    rows: DataFrame, window: WindowSpec, symbol: Column, tables: list[list[int]], start: int, longest: int, out: str = "state"
) -> DataFrame:
    """Adds the state after each row. ``tables[symbol][state]`` is the next state, ``window`` the partition and
    order of the series, ``longest`` a bound on its rows."""
    n = len(tables[0])
    if n <= PACKED:
        choices = [F.lit(_pack(t)).cast("long") for t in tables]
    else:
        choices = [F.array(*[F.lit(s) for s in t]) for t in tables]
    step = F.when(F.lit(False), choices[0])
    for i, c in enumerate(choices):
        step = step.when(symbol == i, c)
    return scan_maps(rows, window, step, n, start, longest, out)


def scan_maps(
    rows: DataFrame, window: WindowSpec, step: Column, n: int, start: int, longest: int, out: str = "state"
) -> DataFrame:
    """The same from each row's own map ``step``: up to ``PACKED`` states ``n`` a packed long, beyond an array with
    the next state of each."""
    rows, reach = rows.withColumn("_map", step), 1
    while reach < longest:
        rows = rows.withColumn("_before", F.lag("_map", reach).over(window))
        rows = rows.withColumn("_map", F.when(F.col("_before").isNull(), F.col("_map")).otherwise(_compose(F.col("_map"), F.col("_before"), n)))
        reach *= 2
    if n <= PACKED:
        state = F.call_function("shiftrightunsigned", F.col("_map"), F.lit(4 * start)).bitwiseAND(F.lit(15).cast("long")).cast("int")
    else:
        state = F.get("_map", F.lit(start))
    return rows.withColumn(out, state).drop("_map", "_before")


#: a weight below this share of the newest one is lost in a double
NEGLIGIBLE = 2.0**-64


def passes(decay: float) -> int:
    """Doublings after which a geometric decay is negligible."""
    reach, k = 1, 0
    while decay**reach > NEGLIGIBLE:
        reach, k = 2 * reach, k + 1
    return k


def scan_affine(rows: DataFrame, window: WindowSpec, maps: dict[str, tuple[Column, Column]], decay: float) -> DataFrame:
    """Adds, per name, y after y -> a * y + b of every row so far, from (a, b) of the row; the first row's a must be 0
    and all others at most ``decay``. Maps of 2**k rows are composed with those of the 2**k rows before."""
    rows = rows.withColumns({f"_{part}_{n}": c for n, pair in maps.items() for part, c in zip("ab", pair)})
    for k in range(passes(decay)):
        rows = rows.withColumns({f"_{part}p_{n}": F.lag(f"_{part}_{n}", 2**k).over(window) for n in maps for part in "ab"})
        step = {}
        for n in maps:
            a, b, ap, bp = (F.col(f"_{part}_{n}") for part in ("a", "b", "ap", "bp"))
            step[f"_b_{n}"] = F.when(bp.isNull(), b).otherwise(a * bp + b)
            step[f"_a_{n}"] = F.when(ap.isNull(), a).otherwise(a * ap)
        rows = rows.withColumns(step)
    out = rows.withColumns({n: F.col(f"_b_{n}") for n in maps})
    return out.drop(*[f"_{part}_{n}" for n in maps for part in ("a", "b", "ap", "bp")])


def decayed_sums(rows: DataFrame, window: WindowSpec, terms: dict[str, tuple[Column, float]]) -> DataFrame:
    """Adds, per name, the sum of the terms so far, each weighted by decay ** (rows since)."""
    rows = rows.withColumns({n: term for n, (term, _) in terms.items()})
    for k in range(max(passes(decay) for _, decay in terms.values())):
        live = {n: decay ** (2**k) for n, (_, decay) in terms.items() if decay ** (2**k) > NEGLIGIBLE}
        rows = rows.withColumns({f"_p_{n}": F.lag(n, 2**k).over(window) for n in live})
        rows = rows.withColumns({n: F.col(n) + factor * F.coalesce(f"_p_{n}", F.lit(0.0)) for n, factor in live.items()})
    return rows.drop(*[f"_p_{n}" for n in terms])
