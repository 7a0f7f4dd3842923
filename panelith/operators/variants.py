"""Leak-free reads of many models on the same rows: a row travels once, whatever the number of models.

Every model (a variant's fold) is a few numbers, so tasks work out all predictions of a row where its inputs are.
Per date one task ranks the cross-section for every variant. The pooled correlation takes two exchanges: rows go
to pieces of the outcome, where each variant numbers its own rows; the pairs of prediction and rank go on, packed,
to pieces of that variant's predictions. Pieces hold about ``PIECE_ROWS`` rows, so that a task stays as it is when
the table grows. Equal predictions are added up before they travel.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions.columns import RANK_DIGITS, finite
from panelith.functions.ranks import piece_of, value_cuts
from panelith.session import cut_lineage

PIECE_ROWS = 250_000
#: of so many rows one serves to find the cuts between pieces of predictions; they decide nothing else
CUT_EVERY = 64
PACKED = np.dtype([("x", "<f8"), ("y", "<f8"), ("n", "<i4")])


def model_table(models: DataFrame, tests: DataFrame, table: DataFrame) -> tuple[list[str], dict, DataFrame]:
    """Names of the variants; per date, by its number, the models that predict it: (number, fold, needs, intercept,
    coefficients); and (dt, _day), the numbers of the dates. All are bounded by dates x variants."""
    needs = {r["variant"]: r["needs"] for r in table.select("variant", "needs").collect()}
    names = sorted(needs)
    solved = {(r["variant"], r["fold_id"]): (r["intercept"], np.array(r["coef"])) for r in models.select("variant", "fold_id", "intercept", "coef").collect()}
    number: dict = {}
    by_date: dict[int, list] = {}
    for r in tests.select("variant", "fold_id", "dt").where("dt IS NOT NULL").collect():
        model = solved.get((r["variant"], r["fold_id"]))
        if model:
            day = number.setdefault(r["dt"], len(number))
            by_date.setdefault(day, []).append((names.index(r["variant"]), r["fold_id"], needs[r["variant"]], *model))
    schema = T.StructType([tests.schema["dt"], T.StructField("_day", T.IntegerType())])
    return names, by_date, tests.sparkSession.createDataFrame(list(number.items()), schema)


def settled(values: np.ndarray) -> np.ndarray:
    """Rounded to the digits that ranks see; large numbers hold no such digits and stay as they are."""
    return np.where(np.abs(values) < 1e5, np.round(values, RANK_DIGITS), values)


def predict(x: np.ndarray, intercept: float, coef: np.ndarray) -> np.ndarray:
    out = np.full(len(x), intercept)
    for i, c in enumerate(coef):
        out = out + c * x[:, i]
    return settled(out)


def mean_ranks(values: np.ndarray) -> np.ndarray:
    return pd.Series(values).rank(method="average").to_numpy()


def ranks_along(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Tie-averaged ranks of the values at ``order`` (positions by ascending value), in that order."""
    ascending = values[order]
    starts = np.flatnonzero(np.r_[True, ascending[1:] != ascending[:-1]])
    ends = np.r_[starts[1:], len(order)]
    return np.repeat((starts + ends + 1) / 2, ends - starts)


def column_ics(rows: DataFrame, features: list[str], y: str, dt: str = "dt", floor: int = 2) -> DataFrame:
    """(feature, dt, ic, n): rank correlation of every column with the outcome per date, each over the rows that know
    both; dates that cannot be measured drop out. Rows travel once for all columns, a task takes a date."""
    cols = [f"_{i}" for i in range(len(features))]
    thin = rows.select(
        F.unix_date(dt).alias("_day"), finite(y).alias("_y"), *[finite(f).alias(c) for f, c in zip(features, cols)]
    ).where("_y IS NOT NULL")

    def read(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        actual = settled(pdf["_y"].to_numpy())
        by_actual, out = np.argsort(actual, kind="stable"), []
        rank = np.empty(len(actual))
        for name, c in zip(features, cols):
            x = settled(pdf[c].to_numpy(dtype=float))
            has = ~np.isnan(x)
            if has.sum() < max(floor, 1):
                continue
            order = by_actual[has[by_actual]]
            rank[order] = ranks_along(actual, order)
            a = rank[has]
            order = np.argsort(x[has], kind="stable")
            p = np.empty(len(a))
            p[order] = ranks_along(x[has], order)
            if a.min() < a.max() and p.min() < p.max():
                out.append((name, key[0], float(np.corrcoef(p, a)[0, 1]), len(p)))
        return pd.DataFrame(out, columns=["feature", "_day", "ic", "n"])

    found = thin.groupBy("_day").applyInPandas(read, "feature string, _day int, ic double, n long")
    return found.select("feature", F.date_from_unix_date("_day").alias(dt), "ic", "n")


def known_columns(rows: DataFrame, features: list[str], y: str, keep: list[str | Column]) -> DataFrame:
    """The rows with an outcome: ``keep``, the outcome (also rounded, in ``_y``), the columns with 0 where missing, and
    a bit per missing column in ``_missing``."""
    missing = F.lit(0).cast("long")
    for i, f in enumerate(features):
        missing = missing + F.when(finite(f).isNull(), F.lit(1 << i)).otherwise(0)
    return rows.where(finite(y).isNotNull()).select(
        *keep, finite(y).alias(y), F.round(finite(y), RANK_DIGITS).alias("_y"), missing.alias("_missing"),
        *[F.coalesce(finite(f), F.lit(0.0)).alias(f) for f in features],
    )


def pooled_column_ics(known: DataFrame, features: list[str], n_groups: int = 1) -> DataFrame | None:
    """(feature, _day, ic, n): rank correlation of every column with ``_y`` over all rows of each group (its number, up
    to ``n_groups``, in ``_day``), NULL below ten rows or when a side is constant. ``known``: written rows of
    ``known_columns``. None if many rows share an outcome, which pieces of the outcome cannot part."""
    k = len(features)
    placed, cuts, even = place_outcomes(known, "_y")
    if not even:
        return None
    # a column is the model that predicts its own value
    by_group = {g: [(g * k + i, 0, 1 << i, 0.0, row) for i, row in enumerate(np.eye(k))] for g in range(n_groups)}
    names = [f"{g}:{f}" for g in range(n_groups) for f in features]
    out = pooled_ics(placed, features, "_y", names, by_group, cuts)
    name = F.split("variant", ":", 2)
    return out.select(name[1].alias("feature"), name[0].cast("int").alias("_day"), "ic", "n")


def date_ics(known: DataFrame, features: list[str], y: str, names: list[str], by_date: dict) -> DataFrame:
    """(variant, _day, ic, n): rank correlation per date; dates that cannot be measured drop out. A task takes a date."""

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        day = int(pdf["_day"].iat[0])
        x, actual, missing = pdf[features].to_numpy(dtype=float), pdf[y].to_numpy(), pdf["_missing"].to_numpy()
        ranks, out = {}, []
        for v, _, needs, intercept, coef in by_date[day]:
            pred = predict(x, intercept, coef)
            use = ((missing & needs) == 0) & np.isfinite(pred)
            same = use.tobytes()
            if same not in ranks:
                ranks[same] = mean_ranks(actual[use])
            a, p = ranks[same], mean_ranks(pred[use])
            if len(p) >= 2 and a.min() < a.max() and p.min() < p.max():
                out.append((names[v], day, float(np.corrcoef(p, a)[0, 1]), len(p)))
        return pd.DataFrame(out, columns=["variant", "_day", "ic", "n"])

    return known.groupBy("_day").applyInPandas(read, "variant string, _day int, ic double, n long")


def pooled_ics(
    known: DataFrame, features: list[str], y: str, names: list[str], by_date: dict, cuts: list[float],
) -> DataFrame:
    """(variant, ic, n, n_folds): rank correlation over all rows of a variant; NULL below ten rows or when a side
    is constant. ``known``: written rows with the piece of the outcome in ``_piece``."""
    n_pieces = len(cuts) + 1

    def used(pdf: pd.DataFrame):
        """(variant, fold, positions, rounded predictions) of the rows with a prediction, variant after variant."""
        x, missing = pdf[features].to_numpy(dtype=float), pdf["_missing"].to_numpy()
        days, at = np.unique(pdf["_day"].to_numpy(), return_inverse=True)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(np.bincount(at, minlength=len(days)))
        # dates that share their models are predicted together
        alike: dict = {}
        for i, day in enumerate(days):
            part = order[ends[i - 1] if i else 0 : ends[i]]
            for v, fold, needs, intercept, coef in by_date[int(day)]:
                alike.setdefault((v, fold), (needs, intercept, coef, []))[3].append(part)
        for (v, fold), (needs, intercept, coef, parts) in sorted(alike.items(), key=lambda kv: kv[0]):
            rows = np.concatenate(parts)
            rows = rows[(missing[rows] & needs) == 0]
            if len(rows):
                yield v, fold, rows, predict(x[rows], intercept, coef)

    def survey(batches):
        for pdf in batches:
            out = []
            piece = pdf["_piece"].to_numpy()
            for v, fold, rows, pred in used(pdf) if len(pdf) else ():
                fine = np.isfinite(pred)
                counts = np.bincount(piece[rows][fine], minlength=n_pieces)
                sample = pred[fine][::CUT_EVERY]
                out.append((v, fold, counts.tolist(), sample.tolist()))
            yield pd.DataFrame(out, columns=["v", "fold", "counts", "sample"])

    seen = cut_lineage(known.mapInPandas(survey, "v int, fold long, counts array<long>, sample array<double>"))
    totals = np.zeros((len(names), n_pieces), dtype=np.int64)
    # variants x pieces numbers
    for r in seen.select("v", F.posexplode("counts").alias("p", "n")).groupBy("v", "p").agg(F.sum("n").alias("n")).collect():
        totals[r["v"], r["p"]] = r["n"]
    before = np.cumsum(totals, axis=1) - totals
    whole = totals.sum(axis=1)
    share = F.array(*[F.lit(i / n_pieces) for i in range(1, n_pieces)])
    pred_cuts: dict[int, np.ndarray] = {}
    if n_pieces > 1:
        values = seen.select("v", F.explode("sample").alias("x")).groupBy("v").agg(F.percentile_approx("x", share, 100 * n_pieces).alias("cuts"))
        # a variant with a share of the rows takes that share of the pieces
        step = [max(n_pieces // max(ceil(n / PIECE_ROWS), 1), 1) for n in whole.tolist()]
        pred_cuts = {r["v"]: np.unique(r["cuts"][step[r["v"]] - 1 :: step[r["v"]]]) for r in values.collect()}
    none = np.empty(0)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        piece, actual = int(pdf["_piece"].iat[0]), pdf[y].to_numpy()
        gathered: dict[int, list] = {}
        for v, _, rows, pred in used(pdf):
            fine = np.isfinite(pred)
            gathered.setdefault(v, []).append((rows[fine], pred[fine]))
        out = []
        for v, parts in gathered.items():
            rows, pred = (np.concatenate(c) for c in zip(*parts))
            if not len(rows):
                continue
            own = actual[rows]
            rank = mean_ranks(own) + before[v, piece] - (whole[v] + 1) / 2
            x, at = np.unique(pred, return_inverse=True)
            cells = np.empty(len(x), dtype=PACKED)
            cells["x"], cells["y"], cells["n"] = x, np.bincount(at, weights=rank), np.bincount(at)
            squares = np.bincount(at, weights=rank * rank)
            # x ascends, so pieces are stretches of it
            ends = np.searchsorted(x, pred_cuts.get(v, none), side="right")
            bounds = [0, *ends.tolist(), len(x)]
            for p, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
                if hi > lo:
                    out.append((v, p, cells[lo:hi].tobytes(), float(squares[lo:hi].sum()), float(own.min()), float(own.max())))
        return pd.DataFrame(out, columns=["v", "p", "strip", "yy", "lo", "hi"])

    packed = known.groupBy("_piece").applyInPandas(pack, "v int, p int, strip binary, yy double, lo double, hi double")

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = np.concatenate([np.frombuffer(s, dtype=PACKED) for s in pdf["strip"]])
        x, at = np.unique(cells["x"], return_inverse=True)
        n, total = np.bincount(at, weights=cells["n"]), np.bincount(at, weights=cells["y"])
        rank = np.cumsum(n) - (n - 1) / 2
        return pd.DataFrame([(
            int(pdf["v"].iat[0]), int(pdf["p"].iat[0]), int(n.sum()), float(n @ rank), float(n @ rank**2), float(total @ rank), float(total.sum()),
            float(pdf["yy"].sum()), float(pdf["lo"].min()), float(pdf["hi"].max()), float(x[0]), float(x[-1]),
        )], columns=["v", "p", "n", "r", "rr", "ry", "y", "yy", "lo", "hi", "x_lo", "x_hi"])

    part = packed.groupBy("v", "p").applyInPandas(
        sums, "v int, p int, n long, r double, rr double, ry double, y double, yy double, lo double, hi double, x_lo double, x_hi double"
    )
    # a row per variant and piece: ranks of a piece start after the rows of the pieces before, around the middle
    mine = Window.partitionBy("v")
    earlier = mine.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("o", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - (F.sum("n").over(mine) + 1) / 2.0)
    n, o = F.col("n"), F.col("o")
    ic = F.sum(F.col("ry") + o * F.col("y")) / F.sqrt(F.sum(F.col("rr") + 2 * o * F.col("r") + n * o * o)) / F.sqrt(F.sum("yy"))
    vary = (F.min("x_lo") < F.max("x_hi")) & (F.min("lo") < F.max("hi"))
    pooled = part.groupBy("v").agg(F.when((F.sum("n") >= 10) & vary, ic).alias("ic"), F.sum("n").alias("n"))
    folds = seen.groupBy("v").agg(F.countDistinct("fold").alias("n_folds"))
    word = F.get(F.array(*[F.lit(v) for v in names]), F.col("v"))
    return pooled.join(folds, "v").select(word.alias("variant"), "ic", "n", "n_folds")


def placed_rows(known: DataFrame, y: str, days: DataFrame) -> tuple[DataFrame, list[float], bool]:
    """The rows of dates with a model, with the date's number and the piece of the outcome; the cuts between the
    pieces, and whether these are even (no value holds several shares of the rows)."""
    rows = known.withColumn(y, F.round(finite(y), RANK_DIGITS)).join(F.broadcast(days), "dt")  # a row per date
    return place_outcomes(cut_lineage(rows.drop("entity", "dt")), y)


def place_outcomes(rows: DataFrame, y: str) -> tuple[DataFrame, list[float], bool]:
    """Written rows with the piece of the outcome; the cuts between the pieces, and whether these are even."""
    pieces = max(ceil(rows.count() / PIECE_ROWS), 1)
    cuts = value_cuts(rows, [y], pieces)[0][y]
    return rows.withColumn("_piece", piece_of(F.col(y), cuts)), cuts, len(cuts) == pieces - 1
