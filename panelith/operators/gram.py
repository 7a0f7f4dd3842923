"""Linear models from sufficient statistics.

One pass over the rows gives weighted cross products per date (a map-side combined aggregate). Every
fold, combination, horizon or feature subset is then a sum of those small rows, so no refit reads
the data again. The evidence iteration works on one such row at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelith.functions.columns import finite, guarded_corr, ratio
from panelith.operators.correlation import pair_covariance
from panelith.session import cut_lineage

# The usual flat hyper-priors and stopping rule of evidence-maximised regression.
HYPER, TOL, MAX_ITER = 1e-6, 1e-3, 300
#: rows of sums that a task holds
GRAM_ROWS = 20_000


def gram_names(k: int) -> list[str]:
    """n, sums of x_i and y, cross products in a fixed order."""
    return (
        ["w", "n"] + [f"x{i}" for i in range(k)] + ["y", "yy"] + [f"xy{i}" for i in range(k)]
        + [f"xx{i}_{j}" for i in range(k) for j in range(i, k)]
    )


def gram_table(
    rows: DataFrame, features: list[str], y: str, keys: list[str], weight: str | None = None
) -> DataFrame:
    """(keys, cross products) of the rows where every feature and the target are known."""
    cols = {f"_f{i}": finite(f) for i, f in enumerate(features)} | {"_y": finite(y)}
    if weight:
        cols["_w"] = finite(weight)
    known = rows.withColumns(cols).dropna(subset=list(cols))
    k = len(features)
    names = gram_names(k)
    thin = known.select(*keys, *[f"_f{i}" for i in range(k)], "_y", *(["_w"] if weight else []))
    schema = T.StructType([thin.schema[c] for c in keys] + [T.StructField(n, T.DoubleType()) for n in names])
    # columns of (1, x.., y) whose products follow the names, n aside
    one, y_at = 0, k + 1
    pairs = [(one, one)] + [(one, i + 1) for i in range(k)] + [(one, y_at), (y_at, y_at)] + [(i + 1, y_at) for i in range(k)]
    pairs += [(i + 1, j + 1) for i in range(k) for j in range(i, k)]
    left, right = np.array(pairs).T

    def compact(parts: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(parts)
        out = whole.group_by(keys).aggregate([(n, "sum") for n in names])
        return out.rename_columns([c.removesuffix("_sum") if c not in keys else c for c in out.column_names]).select(schema.names)

    def sums(batches):
        # a task's sums per key, passed on when they are many
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            code = np.zeros(batch.num_rows, dtype=np.int64)
            for c in keys:
                col = batch.column(c).dictionary_encode("encode")
                code = np.unique(code * len(col.dictionary) + col.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            starts = np.flatnonzero(np.diff(code[order], prepend=-1))
            z = np.column_stack([np.ones(batch.num_rows), *[batch.column(f"_f{i}").to_numpy() for i in range(k)], batch.column("_y").to_numpy()])[order]
            w = z * batch.column("_w").to_numpy()[order, None] if weight else z
            ends = np.r_[starts[1:], len(order)]
            square = np.empty((len(starts), k + 2, k + 2))
            for i, (at, to) in enumerate(zip(starts, ends)):
                np.matmul(w[at:to].T, z[at:to], out=square[i])
            got = square[:, left, right]
            counts = (ends - starts).astype(float)
            cols = [got[:, 0], counts, *got[:, 1:].T]
            firsts = pa.array(order[starts])
            parts.append(pa.table([batch.column(c).take(firsts) for c in keys] + [pa.array(v) for v in cols], names=schema.names))
            held += len(starts)
            if held > GRAM_ROWS:
                parts = [compact(parts)]
                held = parts[0].num_rows
                if held > GRAM_ROWS // 2:
                    yield from parts[0].to_batches()
                    parts, held = [], 0
        if parts:
            yield from compact(parts).to_batches()

    return thin.mapInArrow(sums, schema).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def fold_gram(per_date: DataFrame, folds: DataFrame, k: int, keys: list[str], role: str = "train") -> DataFrame:
    """Per-date statistics summed over each fold's dates."""
    part = folds.where(F.col("role") == role).select(*[c for c in folds.columns if c != "role"])
    joined = per_date.join(part, "dt")
    return joined.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in gram_names(k)])


def solve_evidence(row: dict, subset: list[int], k: int) -> dict | None:
    """Posterior mean and covariance with noise and weight precision set by the evidence."""
    n = row["w"]
    if row["n"] < 20 or n <= 0:
        return None
    idx = np.array(subset)
    mx = np.array([row[f"x{i}"] for i in range(k)])[idx] / n
    my = row["y"] / n
    full = np.empty((k, k))
    for i in range(k):
        for j in range(i, k):
            full[i, j] = full[j, i] = row[f"xx{i}_{j}"]
    g = full[np.ix_(idx, idx)] - n * np.outer(mx, mx)
    b = np.array([row[f"xy{i}"] for i in range(k)])[idx] - n * mx * my
    yy = row["yy"] - n * my * my
    eig, vec = np.linalg.eigh(g)
    eig = np.maximum(eig, 0.0)
    rotated = vec.T @ b

    def mean(noise: float, prior: float) -> np.ndarray:
        return vec @ (rotated / (eig + prior / noise))

    noise, prior, last = 1.0 / (yy / n + np.finfo(float).eps), 1.0, None
    for step in range(MAX_ITER):
        coef = mean(noise, prior)
        rss = max(yy - 2 * coef @ b + coef @ g @ coef, 0.0)
        used = float(np.sum(noise * eig / (prior + noise * eig)))
        prior = (used + 2 * HYPER) / (coef @ coef + 2 * HYPER)
        noise = (n - used + 2 * HYPER) / (rss + 2 * HYPER)
        if step and np.abs(last - coef).sum() < TOL:
            break
        last = coef
    coef = mean(noise, prior)
    cov = (vec / (eig + prior / noise)) @ vec.T / noise
    out = np.zeros(k)
    out[idx] = coef
    wide = np.zeros((k, k))
    wide[np.ix_(idx, idx)] = cov
    centre = np.zeros(k)
    centre[idx] = mx
    sd = np.sqrt(np.maximum(np.diag(full) / n - (np.array([row[f"x{i}"] for i in range(k)]) / n) ** 2, 0))
    return {
        "coef": out.tolist(), "intercept": float(my - mx @ coef), "noise": float(noise),
        "prior": float(prior), "centre": centre.tolist(), "cov": wide.ravel().tolist(),
        "std_coef": (out * sd / max(np.sqrt(max(yy / n, 0)), 1e-300)).tolist(), "n_fit": int(row["n"]),
    }


def solve_rows(grams: DataFrame, keys: list[str], k: int, subset: str | None = None) -> DataFrame:
    """One model per Gram row. ``subset`` names an array column of feature positions to use."""
    schema = T.StructType(
        [grams.schema[c] for c in keys]
        + [
            T.StructField("coef", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("noise", T.DoubleType()),
            T.StructField("prior", T.DoubleType()),
            T.StructField("centre", T.ArrayType(T.DoubleType())),
            T.StructField("cov", T.ArrayType(T.DoubleType())),
            T.StructField("std_coef", T.ArrayType(T.DoubleType())),
            T.StructField("n_fit", T.LongType()),
        ]
    )

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                used = list(row[subset]) if subset else list(range(k))
                model = solve_evidence(row, [int(i) for i in used], k)
                if model:
                    out.append({**{c: row[c] for c in keys}, **model})
            yield pd.DataFrame(out, columns=schema.names)

    cols = keys + gram_names(k) + ([subset] if subset else [])
    return grams.select(*cols).mapInPandas(solve, schema)


def fit_bayes_ridge(
    rows: DataFrame, features: list[str], y: str, by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """One model row per ``by`` group (one in all without it)."""
    keys = by or ["model"]
    source = rows if by else rows.withColumn("model", F.lit("all"))
    return solve_rows(gram_table(source, features, y, keys, weight), keys, len(features))


def linear_value(features: list[str]) -> Column:
    total = F.col("intercept")
    for i, f in enumerate(features):
        total = total + F.get("coef", F.lit(i)) * finite(f)
    return total


def score_linear(
    rows: DataFrame, models: DataFrame, features: list[str], on: list[str] | None = None,
    pred: str = "pred", with_std: bool = False, carry: list[str] | None = None,
) -> DataFrame:
    """Predictions of joined models; one model row in all is broadcast, others join on ``on``.
    ``carry`` keeps further model keys, one prediction per row and model."""
    cols = ["coef", "intercept", "noise", "centre", "cov"]
    if on:
        # models of folds or variants: as many as the caller asked for
        joined = rows.join(F.broadcast(models.select(*on, *(carry or []), *cols)), on)
    else:
        found = models.select(*cols).take(2)
        if len(found) > 1:
            raise ValueError("more than one model: name their key in ``on``")
        if found:
            # one row of numbers: constants of the plan, so the model is not solved again
            schema = models.select(*cols).schema
            joined = rows.withColumns({c: F.lit(found[0][c]).cast(schema[c].dataType) for c in cols})
        else:
            joined = rows.crossJoin(F.broadcast(models.select(*cols)))
    out = joined.withColumn(pred, linear_value(features))
    if with_std:
        if on:
            out = out.withColumn(f"{pred}_std", _spread(features))
        else:
            known = found and found[0]["cov"] is not None
            out = out.withColumn(f"{pred}_std", _spread_of(found[0], features) if known else F.lit(None).cast("double"))
    return out.drop(*cols)


def _spread(features: list[str]) -> Column:
    """Standard deviation of a prediction, from the joined model's columns."""
    k = len(features)
    off = F.array(*[finite(f) - F.get("centre", F.lit(i)) for i, f in enumerate(features)])

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    rows_of = F.transform(off, lambda _, i: dot(F.slice("cov", i * k + 1, F.lit(k)), off))
    return F.sqrt(dot(off, rows_of) + 1 / F.col("noise"))


def _spread_of(model, features: list[str]) -> Column:
    """The same for one known model: a batch of rows at a time."""
    k = len(features)
    centre, cov, noise = np.array(model["centre"]), np.array(model["cov"]).reshape(k, k), model["noise"]

    @F.pandas_udf(T.DoubleType())
    def spread(*inputs: pd.Series) -> pd.Series:
        off = np.column_stack([s.to_numpy(dtype=float) for s in inputs]) - centre
        return pd.Series(np.sqrt(((off @ cov) * off).sum(axis=1) + 1 / noise))

    return spread(*[finite(f) for f in features])


def in_sample_ic(scored: DataFrame, pred: str, y: str, by: list[str] | None = None) -> DataFrame:
    return scored.groupBy(*(by or [])).agg(guarded_corr(pred, y, 2).alias("ic"), F.count(F.lit(1)).alias("n"))


def fit_scaler(rows: DataFrame, features: list[str]) -> DataFrame:
    """One row: mean and population deviation per feature, a degenerate deviation counting as 1."""
    aggs = []
    for f in features:
        sd = F.coalesce(F.stddev_pop(finite(f)), F.lit(0.0))
        aggs += [
            F.coalesce(F.avg(finite(f)), F.lit(0.0)).alias(f"{f}__mean"),
            F.when(sd > 1e-9, sd).otherwise(1.0).alias(f"{f}__std"),
        ]
    return rows.agg(*aggs)


def apply_scaler(rows: DataFrame, scaler: DataFrame, features: list[str], winsor: float = 3.0) -> DataFrame:
    from panelith.functions.columns import clamp

    joined = rows.crossJoin(F.broadcast(scaler))
    scaled = {
        f: clamp((finite(f) - F.col(f"{f}__mean")) / F.col(f"{f}__std"), -winsor, winsor) for f in features
    }
    return joined.withColumns(scaled).drop(*[f"{f}__{s}" for f in features for s in ("mean", "std")])


def standardized_coefficients(models: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """(keys, feature, coef, standardized): scale-free coefficients of every model."""
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.get("coef", F.lit(i)).alias("coef"),
                F.get("std_coef", F.lit(i)).alias("standardized"),
            )
            for i, f in enumerate(features)
        ]
    )
    return models.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")


# --- cross-sectional factor model ---------------------------------------------------------------


def factor_returns(rows: DataFrame, loadings: list[str], ret: str, min_names: int = 30) -> DataFrame:
    """(dt, factor, value): least-squares return of every factor per date, from per-date cross
    products. Dates with too few names or a singular design drop out."""
    k = len(loadings)
    grams = gram_table(rows, loadings, ret, ["dt"]).where(F.col("n") >= min_names)
    names = ["market", *loadings]
    schema = T.StructType(
        [rows.schema["dt"], T.StructField("factor", T.StringType()), T.StructField("value", T.DoubleType())]
    )

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                a = np.empty((k + 1, k + 1))
                a[0, 0] = row["w"]
                a[0, 1:] = a[1:, 0] = [row[f"x{i}"] for i in range(k)]
                for i in range(k):
                    for j in range(i, k):
                        a[i + 1, j + 1] = a[j + 1, i + 1] = row[f"xx{i}_{j}"]
                b = np.array([row["y"]] + [row[f"xy{i}"] for i in range(k)])
                try:
                    beta = np.linalg.solve(a, b)
                except np.linalg.LinAlgError:
                    continue
                out += [(row["dt"], name, float(v)) for name, v in zip(names, beta)]
            yield pd.DataFrame(out, columns=schema.names)

    return grams.mapInPandas(solve, schema)


def factor_covariance(returns: DataFrame, factors: list[str], min_dates: int = 60) -> DataFrame:
    """(a, b, cov) sample covariance of the factor returns over the dates."""
    wide = cut_lineage(returns.groupBy("dt").pivot("factor", factors).agg(F.first("value")))
    enough = wide.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_dates)
    return pair_covariance(wide, factors).crossJoin(F.broadcast(enough)).drop("_n")


def idio_variance(
    rows: DataFrame, returns: DataFrame, loadings: list[str], ret: str, min_dates: int = 60
) -> DataFrame:
    """(entity, n, idio_var): sample variance of what the factors leave of each entity's return."""
    factors = ["market", *loadings]
    wide = returns.groupBy("dt").pivot("factor", factors).agg(F.first("value"))
    wide = wide.withColumnsRenamed({f: f"_{f}" for f in factors})
    explained = F.col("_market")
    for f in loadings:
        explained = explained + F.col(f"_{f}") * finite(f)
    resid = finite(ret) - explained
    out = rows.join(wide, "dt").groupBy("entity").agg(
        F.count(resid).alias("n"), F.var_samp(resid).alias("idio_var")
    )
    return out.where(F.col("n") >= min_dates)
