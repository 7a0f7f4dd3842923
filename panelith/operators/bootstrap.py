"""Pooled rank correlations of many resamplings of whole dates, without rows per resampling.

In a resampling every date counts as often as it is drawn, so a row's weighted rank is a sum over the dates: draws
times the date's rows with a smaller value. The draws are a matrix (dates x resamplings) that every task
derives from the seed. A group that fits one strip is one cell: cumulative sums of all resamplings in blocks of
bounded size, shared out over lanes. A larger group is dealt to a few strips of the one value and a few of the other. A
strip is shipped as the packed dates of its rows in order; the cell of two strips looks up, for its own rows, how
many rows of each date stand before them on either side, adds up the products of the two as one matrix
(dates x dates) per date, and multiplies it with the draws. The other sums follow from the number of rows and the ties.
Work and shuffle follow the rows; neither grows with the resamplings but for the last products. Several values can be
ranked against the same one: a row travels to its place by that one for all of them. Any other weights that rows of a
date (or of a finer class) share are one more resampling.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions.ranks import join_same, value_cuts
from panelith.session import cut_lineage, discard, spread

#: (number of the target, number of classes, numbers of the weightings) -> (weightings x classes)
Weigh = Callable[[int, int, np.ndarray], np.ndarray]

# Multipliers of the integer mixing behind the draws (shared with the SQL check).
MIX_A, MIX_B, MIX_MOD, MIX_STEP = 1540483477, 1103515245, 2147483648, 1000003
#: rows of a group that is a single cell
STRIP = 1 << 19
#: rows of a strip of a larger group, but for a value that holds more; two packed strips stand in a cell
LONG_STRIP = 1 << 24
#: rows of a piece of a larger group, which one task sorts
PIECE_ROWS = 1 << 19
#: positions between two stored counts per date of a strip
STEP = 256
#: groups whose date numbers are broadcast
BROADCAST_GROUPS = 1000
#: numbers of one block of cumulative sums
BLOCK = 1 << 20
SUMS = ("sw", "sx", "sy", "sxx", "syy", "sxy")


def draw_counts(n_dates: int, iters: np.ndarray, seed: int) -> np.ndarray:
    """(resamplings x dates): how often each date is drawn when every resampling draws as many dates, with
    replacement, as there are: two multiply-and-fold rounds on whole numbers."""
    x = (iters[:, None] * MIX_STEP + np.arange(n_dates) + seed) % MIX_MOD * MIX_A % MIX_MOD
    x ^= x >> 15
    x = x * MIX_B % MIX_MOD
    x ^= x >> 13
    at = x % n_dates + np.arange(len(iters))[:, None] * n_dates
    return np.bincount(at.ravel(), minlength=len(iters) * n_dates).reshape(len(iters), n_dates).astype(float)


class Strip:
    """Values in order with their dates and counts, and where the values of the cell's rows stand."""

    def __init__(self, value: np.ndarray, date: np.ndarray, count: np.ndarray, asked: np.ndarray):
        order = np.argsort(value, kind="stable")
        value = value[order]
        self.date, self.count = date[order], count[order].astype(float)
        # cumulative sums stand behind a leading zero
        self.below = np.searchsorted(value, asked, "left")
        self.through = np.searchsorted(value, asked, "right")

    def ranks(self, draws: np.ndarray) -> np.ndarray:
        """(resamplings x rows): tie-averaged weighted ranks within the strip."""
        run = np.zeros((len(draws), len(self.date) + 1))
        np.cumsum(draws[:, self.date] * self.count, axis=1, out=run[:, 1:])
        return (run[:, self.below] + run[:, self.through] + 1) / 2


def cell_sums(cell: dict[str, np.ndarray], iters: np.ndarray, weigh: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """(resamplings x 6): weighted sums over a group's rows of 1, x, y, x*x, y*y, x*y for its ranks x and y, counted
    from their middle."""
    value, other, date, count = (cell[n] for n in ("_v", "_x", "_d", "_n"))
    sides = [Strip(asked, date, count, asked) for asked in (value, other)]
    step = max(1, BLOCK // (len(date) + 1))
    n_dates = int(cell["_nd"][0])
    count = count.astype(float)
    out = np.zeros((len(iters), 6))
    for at in range(0, len(iters), step):
        draws = weigh(n_dates, iters[at : at + step])
        w = draws[:, date] * count
        x, y = (s.ranks(draws) - (w.sum(axis=1, keepdims=True) + 1) / 2 for s in sides)
        wx, wy = w * x, w * y
        sums = (w.sum(axis=1), wx.sum(axis=1), wy.sum(axis=1), *(np.einsum("ij,ij->i", a, b) for a, b in ((wx, x), (wy, y), (wx, y))))
        out[at : at + step] = np.stack(sums, axis=1)
    return out


class LongStrip:
    """The dates and counts of a strip's rows in order of their value, and the rows of each date before the strip."""

    def __init__(self, date: np.ndarray, count: np.ndarray, base: np.ndarray):
        self.date, self.count, self.n_dates = date, count, len(base)
        blocks = len(date) // STEP + 1
        self.table = np.empty((blocks, len(base)), dtype=np.int64 if base.sum() + count.sum() >= 1 << 31 else np.int32)
        some = max(1, BLOCK // len(base))
        carry = base
        for at in range(0, blocks, some):
            part = slice(at * STEP, min((at + some) * STEP, len(date)))
            block = np.arange(part.stop - part.start) // STEP
            rows = min(some, blocks - at)
            held = np.bincount(block * len(base) + date[part], count[part], minlength=rows * len(base)).reshape(rows, -1)
            held = carry + np.cumsum(held, axis=0)
            self.table[at], self.table[at + 1 : at + rows] = carry, held[:-1]
            carry = held[-1]

    def before(self, at: np.ndarray) -> np.ndarray:
        """(positions x dates): the rows of each date before each position."""
        block = at // STEP
        long = at - block * STEP
        ends = np.cumsum(long)
        of = np.repeat(np.arange(len(at)), long)
        row = np.repeat(block * STEP - (ends - long), long) + np.arange(len(of))
        some = np.bincount(of * self.n_dates + self.date[row], self.count[row], minlength=len(at) * self.n_dates)
        # of no rows at all bincount makes whole numbers
        return self.table[block] + some.reshape(len(at), -1).astype(float, copy=False)

    def halves(self, lo: np.ndarray, hi: np.ndarray, date: int, count: np.ndarray) -> np.ndarray:
        """(rows x dates): the rows of each date with a smaller value, and half of those with the same."""
        out = self.before(lo)
        alone = hi - lo == 1
        out[alone, date] += count[alone] / 2
        if not alone.all():
            out[~alone] = (out[~alone] + self.before(hi[~alone])) / 2
        return out


def cell_products(rows: dict[str, np.ndarray], x: LongStrip, y: LongStrip, draws: np.ndarray) -> np.ndarray:
    """Per resampling the weighted sum, over a cell's rows, of (rank by x - 1/2) * (rank by y - 1/2)."""
    n_iter, n_dates = draws.shape
    out = np.zeros(n_iter)
    order = np.argsort(rows["_d"], kind="stable")
    held, starts = np.unique(rows["_d"][order], return_index=True)
    # a matrix per date for many rows, each row's ranks in all resamplings for few
    few = 2 * len(order) * n_iter < n_dates * (len(order) + len(held) * n_iter)
    some = max(1, BLOCK // max(n_dates, n_iter if few else 0))
    for d, part in zip(held, np.split(order, starts[1:])):
        total = np.zeros((n_dates, n_dates))
        for at in range(0, len(part), some):
            mine = part[at : at + some]
            lp, hp, la, ha, n = (rows[c][mine] for c in ("_lp", "_hp", "_la", "_ha", "_n"))
            cx, cy = x.halves(lp, hp, d, n), y.halves(la, ha, d, n)
            if few:
                out += draws[:, d] * np.einsum("ij,ij,j->i", draws @ cx.T, draws @ cy.T, n.astype(float))
            else:
                total += (cx * n[:, None]).T @ cy
        if not few:
            out += draws[:, d] * np.einsum("ij,ij->i", draws @ total, draws)
    return out


def tie_sums(lo: np.ndarray, date: np.ndarray, count: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Per resampling the sum of w**3 - w over the values, w being the value's weight. Rows are in order."""
    first = np.flatnonzero(np.r_[True, lo[1:] != lo[:-1]])
    size = np.diff(np.r_[first, len(lo)])
    alone = first[size == 1]
    kinds, times = np.unique(np.stack([date[alone], count[alone]]), axis=1, return_counts=True)
    out = np.zeros(len(draws))
    for (d, n), k in zip(kinds.T, times):
        w = draws[:, d] * float(n)
        out += k * (w * w * w - w)
    shared = np.repeat(size > 1, size)
    where, starts = np.flatnonzero(shared), np.cumsum(size[size > 1]) - size[size > 1]
    step = max(1, BLOCK // (len(where) + 1))
    for at in range(0, len(draws) if len(where) else 0, step):
        w = np.add.reduceat(draws[at : at + step][:, date[where]] * count[where].astype(float), starts, axis=1)
        out[at : at + step] += (w * w * w - w).sum(axis=1)
    return out


def packed_dates(date: np.ndarray, n_dates: int) -> bytes:
    """Numbers of dates: a byte each, and the bits above it packed."""
    high = [np.packbits(date >> b & 1) for b in range(8, max(n_dates - 1, 0).bit_length())]
    return np.concatenate([date.astype(np.uint8), *high]).tobytes()


def unpacked_dates(packed: bytes, m: int, n_dates: int) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8)
    date = raw[:m].astype(np.uint16 if n_dates <= 1 << 16 else np.int32)
    step = -(-m // 8)
    for i, b in enumerate(range(8, max(n_dates - 1, 0).bit_length())):
        date |= np.unpackbits(raw[m + i * step : m + (i + 1) * step], count=m).astype(date.dtype) << date.dtype.type(b)
    return date


def packed_or_same(values: np.ndarray, kind: type) -> bytes:
    """Nothing where all are 1, as they mostly are."""
    return b"" if (values == 1).all() else values.astype(kind).tobytes()


def unpacked_or_same(packed: bytes, m: int, kind: type) -> np.ndarray:
    return np.frombuffer(packed, kind) if len(packed) else np.ones(m, dtype=np.int8)


def run_bounds(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the first one with its value, and the first one behind it."""
    starts = np.flatnonzero(np.r_[True, ascending[1:] != ascending[:-1]])
    ends = np.r_[starts[1:], len(ascending)]
    return np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)


def combined(group: np.ndarray, p: np.ndarray, date: np.ndarray, x: np.ndarray, count: np.ndarray) -> tuple:
    """The rows by group and value ``p``; equal ones are added up. ``x``: (targets x rows), NaN where missing."""
    order = np.lexsort([*x, date, p, group])
    group, p, date, x, count = group[order], p[order], date[order], x[:, order], count[order]
    other = (group[1:] != group[:-1]) | (p[1:] != p[:-1]) | (date[1:] != date[:-1])
    other |= ((x[:, 1:] != x[:, :-1]) & ~(np.isnan(x[:, 1:]) & np.isnan(x[:, :-1]))).any(axis=0)
    first = np.flatnonzero(np.r_[True, other])
    return group[first], p[first], date[first], x[:, first], np.add.reduceat(count, first)


def binaries(table: pa.Table, name: str) -> list[bytes]:
    return table.column(name).to_pylist()


BLOB, PACK = 0, 1
#: what one task tells others about a stretch of rows: stretches on their way, and packed strips
STRETCH = {
    "_kind": "int", "_g": "int", "_t": "int", "_piece": "int", "_to": "int", "_nd": "long", "_m": "long", "_date": "binary", "_count": "binary",
    "_lo": "binary", "_tie": "binary", "_la": "binary", "_tia": "binary", "_x": "binary", "_held": "binary", "_w": "array<double>", "_ties": "array<double>",
}


def stretch_table(rows: list[dict]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    return pa.table({c: pa.array([r.get(c) for r in rows], kinds[t]) for c, t in STRETCH.items()})


def long_ics(placed: DataFrame, targets: list[str], weigh: Weigh, n_iter: int, sides: int, pieces: int, spent: DataFrame | None) -> DataFrame:
    """``weighted_ics`` for groups of any size, by their number ``_g``. Rows are dealt by the one value with all their
    targets, then by each target, and meet as positions; on the way they travel in packed stretches."""
    schema = ", ".join(f"{c} {t}" for c, t in STRETCH.items())
    per = -(-pieces // sides)
    cuts, _ = value_cuts(placed, ["_p", *targets], pieces)
    at = {c: np.array(v) for c, v in cuts.items()}
    k = len(targets)

    def dealt(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        group, p, date, count, nd = (table.column(c).to_numpy() for c in ("_g", "_p", "_d", "_n", "_nd"))
        sizes = dict(zip(group.tolist(), nd.tolist()))
        group, p, date, x, count = combined(group, p, date, np.stack([table.column(c).to_numpy() for c in targets]), count)
        piece = np.searchsorted(at["_p"], p, "left")
        first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (piece[1:] != piece[:-1])])
        rows = [{
            "_kind": BLOB, "_g": int(group[lo]), "_piece": int(piece[lo]), "_nd": sizes[int(group[lo])], "_m": int(hi - lo), "_lo": p[lo:hi].tobytes(),
            "_date": packed_dates(date[lo:hi], sizes[int(group[lo])]), "_count": packed_or_same(count[lo:hi], np.int64), "_x": x[:, lo:hi].tobytes(),
        } for lo, hi in zip(first, [*first[1:], len(p)])]
        return stretch_table(rows).combine_chunks().to_batches()[0]

    def deal(batches):
        held = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= PIECE_ROWS:
                yield dealt(held)
                held = []
        if held:
            yield dealt(held)

    def gathered(table: pa.Table) -> tuple[int, list[int], np.ndarray, np.ndarray]:
        """The number of classes, the length of each stretch, and of all rows the class and count."""
        n_dates, sizes = int(table.column("_nd")[0].as_py()), table.column("_m").to_pylist()
        date = np.concatenate([unpacked_dates(b, m, n_dates) for b, m in zip(binaries(table, "_date"), sizes)])
        count = np.concatenate([unpacked_or_same(b, m, np.int64) for b, m in zip(binaries(table, "_count"), sizes)]).astype(np.int64)
        return n_dates, sizes, date, count

    def strip_pack(head: dict, lo: np.ndarray, date: np.ndarray, count: np.ndarray, n_dates: int) -> dict:
        held = np.bincount(date, count, minlength=n_dates)
        draws = weigh(head["_t"], n_dates, np.arange(n_iter))
        return head | {
            "_kind": PACK, "_m": len(date), "_date": packed_dates(date, n_dates), "_count": packed_or_same(count, np.int64),
            "_held": held.astype(np.int64).tobytes(), "_w": draws @ held, "_ties": tie_sums(lo, date.astype(np.int64), count, draws),
        }

    def by_first(table: pa.Table) -> pa.Table:
        """A piece of ``_p``: a packed strip for each target, and the rows on their way to the pieces of the target."""
        n_dates, sizes, date, count = gathered(table)
        p = np.concatenate([np.frombuffer(b) for b in binaries(table, "_lo")])
        x = np.concatenate([np.frombuffer(b).reshape(k, m) for b, m in zip(binaries(table, "_x"), sizes)], axis=1)
        _, p, date, x, count = combined(np.zeros(len(p), dtype=np.int8), p, date, x, count)
        out = []
        for t, c in enumerate(targets):
            has = ~np.isnan(x[t])
            if not has.any():
                continue
            head = {"_g": table.column("_g")[0].as_py(), "_t": t, "_piece": table.column("_piece")[0].as_py(), "_nd": n_dates}
            value, d, n = x[t][has], date[has], count[has]
            lo, hi = run_bounds(p[has])
            out.append(strip_pack(head, lo, d, n, n_dates) | {"_to": -1})
            to = np.searchsorted(at[c], value, "left")
            order = np.argsort(to, kind="stable")
            first = np.flatnonzero(np.r_[True, to[order][1:] != to[order][:-1]])
            for some in np.split(order, first[1:]):
                out.append(head | {
                    "_kind": BLOB, "_to": int(to[some[0]]), "_m": len(some), "_date": packed_dates(d[some], n_dates), "_count": packed_or_same(n[some], np.int64),
                    "_lo": lo[some].astype(np.uint32).tobytes(), "_tie": packed_or_same((hi - lo)[some], np.uint32), "_x": value[some].tobytes(),
                })
        return stretch_table(out)

    one = placed.select(F.col("_g").cast("int").alias("_g"), F.col("_nd").cast("long").alias("_nd"), F.col("_d").cast("int").alias("_d"),
                        F.col("_n").cast("long").alias("_n"), "_p", *targets)
    stretches = cut_lineage(spread(one.mapInArrow(deal, schema), "_g", "_piece").groupBy("_g", "_piece").applyInArrow(by_first, schema))
    if spent is not None:
        discard(spent)
    # strips outlive the rows on their way
    strips = {"x": cut_lineage(stretches.where(F.col("_kind") == PACK))}
    before: dict = {}
    # groups x targets x pieces numbers
    for r in sorted(strips["x"].select("_g", "_t", "_piece", "_m").collect(), key=lambda r: r["_piece"]):
        strip = before.setdefault((r["_g"], r["_t"]), {})
        strip[r["_piece"]] = strip.get(-1 - r["_piece"] // per, 0)
        strip[-1 - r["_piece"] // per] = strip[r["_piece"]] + r["_m"]

    def by_second(table: pa.Table) -> pa.Table:
        """A piece of a target: its packed strip, and the rows, by the strip of ``_p`` that they stand in."""
        n_dates, sizes, date, count = gathered(table)
        g, t, s = (table.column(c)[0].as_py() for c in ("_g", "_t", "_to"))
        piece = table.column("_piece").to_pylist()
        value = np.concatenate([np.frombuffer(b) for b in binaries(table, "_x")])
        order = np.argsort(value, kind="stable")
        la, ha = run_bounds(value[order])
        start = before[g, t]
        lo = np.concatenate([np.frombuffer(b, np.uint32).astype(np.int64) + start[r] for b, r in zip(binaries(table, "_lo"), piece)])[order]
        tie = np.concatenate([unpacked_or_same(b, m, np.uint32) for b, m in zip(binaries(table, "_tie"), sizes)])[order]
        strip = np.repeat([r // per for r in piece], sizes)[order]
        date, count = date[order], count[order]
        head = {"_g": g, "_t": t, "_nd": n_dates, "_piece": s}
        out = [strip_pack(head, la, date, count, n_dates) | {"_to": -1}]
        for r in np.unique(strip):
            some = strip == r
            out.append(head | {
                "_kind": BLOB, "_to": int(r), "_m": int(some.sum()), "_date": packed_dates(date[some], n_dates), "_count": packed_or_same(count[some], np.int64),
                "_lo": lo[some].astype(np.uint32).tobytes(), "_tie": packed_or_same(tie[some], np.uint32),
                "_la": la[some].astype(np.uint32).tobytes(), "_tia": packed_or_same((ha - la)[some], np.uint32),
            })
        return stretch_table(out)

    on_way = stretches.where(F.col("_kind") == BLOB)
    met = cut_lineage(spread(on_way, "_g", "_t", "_to").groupBy("_g", "_t", "_to").applyInArrow(by_second, schema))
    discard(stretches)
    strips["y"] = met.where(F.col("_kind") == PACK)

    strip_of = F.floor(F.col("_piece") / per).cast("int")
    body = ["_g", "_t", "_r", "_s", "_side", "_piece", "_nd", "_m", "_date", "_count", "_lo", "_tie", "_la", "_tia", "_held"]
    none = F.lit(None).cast("binary")
    cells = met.where(F.col("_kind") == BLOB).withColumns({"_r": F.col("_to"), "_s": strip_of, "_side": F.lit(0), "_held": none}).select(*body)
    every = F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))
    for side, name, mine, across in ((1, "x", "_r", "_s"), (2, "y", "_s", "_r")):
        packs = strips[name].withColumns({mine: strip_of, "_side": F.lit(side)} | {c: none for c in ("_lo", "_tie", "_la", "_tia")})
        own = packs.withColumn("_held", none).withColumn(across, every)
        # of the strips before only what each class holds
        later = packs.where(F.col(mine) < sides - 1).withColumn(mine, F.explode(F.sequence(F.col(mine) + 1, F.lit(sides - 1))))
        later = later.withColumns({"_date": none, "_count": none}).withColumn(across, every)
        cells = cells.unionByName(own.select(*body)).unionByName(later.select(*body))

    def products(table: pa.Table) -> pa.Table:
        side = table.column("_side").to_numpy()
        own = table.filter(pa.array(side == 0))
        got = np.zeros(0)
        if own.num_rows:
            n_dates, sizes, date, count = gathered(own)
            long, first = [], []
            for i in (1, 2):
                packs = table.filter(pa.array(side == i))
                has = packs.column("_date").is_valid()
                held = [np.frombuffer(b, np.int64) for b in binaries(packs.filter(pc.invert(has)), "_held")]
                packs = packs.filter(has).sort_by("_piece")
                _, lengths, d, n = gathered(packs)
                first.append(dict(zip(packs.column("_piece").to_pylist(), np.cumsum([0, *lengths]).tolist())))
                n = np.ones(len(n), dtype=np.int8) if (n == 1).all() else n
                long.append(LongStrip(d, n, np.sum(held, axis=0) if held else np.zeros(n_dates, dtype=np.int64)))
            rows = {"_d": date, "_n": count}
            # positions in the strip of _p, and in the piece of the target
            rows["_lp"] = np.concatenate([np.frombuffer(b, np.uint32) for b in binaries(own, "_lo")]).astype(np.int64)
            rows["_la"] = np.concatenate([np.frombuffer(b, np.uint32) + first[1][s] for b, s in zip(binaries(own, "_la"), own.column("_piece").to_pylist())]).astype(np.int64)
            for lo, hi, c in (("_lp", "_hp", "_tie"), ("_la", "_ha", "_tia")):
                rows[hi] = rows[lo] + np.concatenate([unpacked_or_same(b, m, np.uint32) for b, m in zip(binaries(own, c), sizes)])
            got = cell_products(rows, *long, weigh(table.column("_t")[0].as_py(), n_dates, np.arange(n_iter)))
        return pa.table({
            "_g": pa.array([table.column("_g")[0].as_py()] * len(got), pa.int32()), "_t": pa.array([table.column("_t")[0].as_py()] * len(got), pa.int32()),
            "iter": pa.array(np.arange(len(got)), pa.int32()), "_xy": pa.array(got, pa.float64()),
        })

    part = ["_g", "_t", "_r", "_s"]
    local = cut_lineage(spread(cells, *part).groupBy(*part).applyInArrow(products, "_g int, _t int, iter int, _xy double"))
    total = local.groupBy("_g", "_t", "iter").agg(F.sum("_xy").alias("_xy"))
    for name, packs in strips.items():
        each = packs.select("_g", "_t", F.posexplode(F.arrays_zip("_w", "_ties")).alias("iter", "z"))
        total = total.join(each.groupBy("_g", "_t", "iter").agg(F.sum("z._w").alias(f"_w{name}"), F.sum("z._ties").alias(f"_t{name}")), ["_g", "_t", "iter"])
    n = F.col("_wx")
    vx, vy = (((n * n - 1) - F.col(t) / n) / 12 for t in ("_tx", "_ty"))
    cov = F.col("_xy") / n + n / 2 + 0.25 - (n + 1) * (n + 1) / 4
    out = cut_lineage(total.select("_g", "_t", "iter", n.alias("n"), rank_corr(n, cov, vx, vy).alias("ic")))
    discard(strips["x"], met, local)
    return out


def rank_corr(n: Column, cov: Column, vx: Column, vy: Column) -> Column:
    """NULL without spread; what sums of so many ranks leave of a constant's variance counts as none."""
    noise = F.greatest(F.lit(1e-9), 1e-12 * n * n)
    return F.when((vx > noise) & (vy > noise), cov / F.sqrt(vx * vy))


def resampled_ics(
    both: DataFrame, keys: list[str], n_iter: int, seed: int, dt: str = "dt", strip: int | None = None, floor: int = 5
) -> DataFrame:
    """(keys, iter, ic): weighted Spearman correlation of ``_p`` and ``_a`` in every resampling of the dates.

    ``both``: written rows (keys, dt, _p, _a, _c), without nulls in the two values, ``_c`` the rows that each
    stands for. NULL below ``floor`` rows or without spread.
    """
    by_key = Window.partitionBy(*keys)
    # a key has at most as many dates as the calendar
    dates = both.select(*keys, dt).distinct().withColumns({
        "_d": F.row_number().over(by_key.orderBy(dt)) - 1, "_nd": F.count(F.lit(1)).over(by_key),
    })
    groups = both.select(*keys).distinct().limit(BROADCAST_GROUPS + 1).count()
    placed = join_same(both, F.broadcast(dates) if groups <= BROADCAST_GROUPS else dates, [*keys, dt])
    placed = placed.select(*keys, "_p", "_a", "_d", "_nd", F.col("_c").alias("_n"))
    ics = weighted_ics(placed, keys, ["_a"], lambda t, n_dates, iters: draw_counts(n_dates, iters, seed), n_iter, strip)
    return ics.select(*keys, F.col("iter").cast("long").alias("iter"), F.when(F.col("n") >= floor, F.col("ic")).alias("ic"))


def weighted_ics(
    placed: DataFrame, keys: list[str], targets: list[str], weigh: Weigh, n_iter: int, strip: int | None = None, spent: DataFrame | None = None,
) -> DataFrame:
    """(keys, _t, iter, n, ic): for each target, by its number, the rank correlation of ``_p`` with it over the rows that know it,
    in each of ``n_iter`` weightings, and the sum of the weights. A row travels once for all targets.

    ``placed``: rows (keys, _p, targets, _d, _nd, _n) that can be read again, ``_d`` one of ``_nd`` classes whose rows weigh the same, such
    as a date, ``_n`` the rows that each stands for. ``spent``: staged rows that go as soon as they are dealt out.
    """
    spark = placed.sparkSession
    strip = strip or STRIP
    sizes = placed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / strip).cast("int").alias("_g"), F.count(F.lit(1)).alias("_size"))
    most = sizes.agg(F.max("_g").alias("strips"), F.count(F.lit(1)).alias("groups"), F.max("_size").alias("size"), F.sum("_size").alias("rows")).first()
    top, groups, tasks = most["strips"] or 1, most["groups"] or 1, int(spark.conf.get("spark.sql.shuffle.partitions"))
    if top > 1:
        # cells for every core, strips of bounded length
        cores = spark.sparkContext.defaultParallelism
        sides = min(top, max(isqrt(3 * cores // (groups * len(targets))) + 1, -(-most["size"] // LONG_STRIP)))
        pieces = sides * -(-max(-(-most["rows"] // PIECE_ROWS), -(-cores // groups)) // sides)
        if not keys:
            return long_ics(placed.withColumn("_g", F.lit(0)), targets, weigh, n_iter, sides, pieces, spent).drop("_g")
        # a row per group
        numbers = cut_lineage(placed.select(*keys).distinct().withColumn("_g", F.row_number().over(Window.orderBy(*keys)) - 1))
        numbered = join_same(placed, F.broadcast(numbers) if groups <= BROADCAST_GROUPS else numbers, keys)
        return long_ics(numbered, targets, weigh, n_iter, sides, pieces, spent).join(numbers, "_g").drop("_g")
    lanes = max(1, min(n_iter, -(-tasks // (groups * len(targets)))))
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col(c).alias("x")) for t, c in enumerate(targets)]))
    cells = placed.withColumn("_each", each).where("_each.x IS NOT NULL").select(
        *keys, F.col("_each.t").alias("_t"), F.col("_p").alias("_v"), F.col("_each.x").alias("_x"), "_d", "_nd", "_n")
    cells = cells.withColumn("_lane", F.explode(F.array(*[F.lit(i) for i in range(lanes)])))

    part = [*keys, "_t", "_lane"]
    head = [cells.schema[c] for c in [*keys, "_t"]]
    schema = T.StructType(head + [T.StructField("iter", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in SUMS])

    def sums(table: pa.Table) -> pa.Table:
        cell = {c: table.column(c).to_numpy() for c in ("_v", "_x", "_d", "_nd", "_n")}
        iters = np.arange(int(table.column("_lane")[0].as_py()), n_iter, lanes)
        t = table.column("_t")[0].as_py()
        got = cell_sums(cell, iters, lambda n_dates, some: weigh(t, n_dates, some))
        first = table.slice(0, 1)
        return pa.table(
            [pa.repeat(first.column(c.name)[0], len(iters)).cast(table.schema.field(c.name).type) for c in head] + [pa.array(iters, pa.int32())]
            + [pa.array(got[:, i]) for i in range(6)],
            names=schema.names,
        )

    total = cut_lineage(spread(cells, *part).groupBy(*part).applyInArrow(sums, schema))
    if spent is not None:
        discard(spent)
    n = F.col("sw")
    vx = F.expr("sxx / sw - (sx / sw) * (sx / sw)")
    vy = F.expr("syy / sw - (sy / sw) * (sy / sw)")
    cov = F.expr("sxy / sw - (sx / sw) * (sy / sw)")
    return total.where("sw > 0").select(*keys, "_t", "iter", n.alias("n"), rank_corr(n, cov, vx, vy).alias("ic"))
