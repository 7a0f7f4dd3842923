"""Queries over folds, linear and tree models, leak-free reads and scoring."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.columns import full_frame
from panelith.operators import drift as D
from panelith.operators import evaluation as E
from panelith.operators import folds as FD
from panelith.operators import gram as G
from panelith.operators import joins as J
from panelith.operators import labels as L
from panelith.operators import models as M
from panelith.operators import pipeline as PL
from panelith.operators import states as S
from panelith.operators import windows as W
from panelith.operators.bootstrap import MIX_A, MIX_B, MIX_MOD, MIX_STEP
from panelith.plans.base import FEATURES, aligned, features, forward, panel, staged_panel
from panelith.plans.evaluation import BOOT, bound, eval_rows, sql_bootstrap, sql_dates, sql_ic
from panelith.plans.joins import asof_rows, candidates, modifiers, population, score_tables, universe
from panelith.plans.labels import CP_SQL, TIER_SQL, barriers, smooth, zscores
from panelith.plans.registry import cte, register
from panelith.plans.scoring import CLIP, predictions, residual_score
from panelith.plans.windows import class_rows_source, daily_macro_panel, weekly_breadth
from panelith.session import cut_lineage
from panelith.sources import panel as P

# The inputs of the second-level model, in the order of its coefficients.
META = [
    "research_calibrator_prob", "momentum_score", "expected_move", "research_composite_score", "research_conviction",
    "sector_macro_modifier", "macro_spy_20d_return", "macro_spy_20d_vol", "macro_vix_level", "macro_vix_term_slope",
    "macro_yield_curve_slope", "macro_market_breadth", "regime_intensity_z",
]
K = len(META)
# the macro series here are order values: brought to the size of the other inputs
LEVEL_UNIT, SLOPE_UNIT = 1e-4, 1e-3

# --- inputs ----------------------------------------------------------------------------------

cte("mfeat", "feat momsc vol snapjoin modif bucket mpanel breadth intens", f"""
SELECT f.entity, f.dt, f.sector, CASE WHEN s.score IS NOT NULL THEN coalesce(k.rate, CASE WHEN o.overall = 0 THEN 0.5 ELSE o.overall END) END AS research_calibrator_prob,
 m.momentum_score, v.realized_vol AS expected_move, s.score / 100 AS research_composite_score,
 CASE WHEN s.score IS NOT NULL THEN CASE s.conviction WHEN 'rising' THEN 1.0 WHEN 'declining' THEN -1.0 ELSE 0.0 END END AS research_conviction,
 CASE WHEN s.score IS NOT NULL THEN coalesce(d.modifier, 1) - 1 END AS sector_macro_modifier,
 p.spy_20d_return AS macro_spy_20d_return, p.spy_20d_vol AS macro_spy_20d_vol, p.vix_level * {LEVEL_UNIT} AS macro_vix_level, p.vix_term_slope * {SLOPE_UNIT} AS macro_vix_term_slope,
 p.yield_curve_10y_2y * {SLOPE_UNIT} AS macro_yield_curve_slope, b.market_breadth AS macro_market_breadth, CASE WHEN i.pos <= 4 THEN 0 ELSE i.z END AS regime_intensity_z
FROM feat f JOIN momsc m USING (entity, dt) JOIN vol v ON v.entity = f.entity AND v.dt = f.dt JOIN snapjoin s ON s.entity = f.entity AND s.dt = f.dt
LEFT JOIN modif d ON d.snapshot_dt = s.snapshot_dt AND d.sector = f.sector
LEFT JOIN bucket k ON k.bucket = CASE WHEN s.score < 40 THEN 0 WHEN s.score < 55 THEN 1 WHEN s.score < 65 THEN 2 WHEN s.score < 75 THEN 3 WHEN s.score < 85 THEN 4 WHEN s.score < 100 THEN 5 END
LEFT JOIN mpanel p ON p.dt = f.dt LEFT JOIN breadth b ON b.dt = f.dt LEFT JOIN intens i ON i.dt = f.dt, (SELECT max(overall) AS overall FROM bucket) o""")
XS = ", ".join(f"{f} AS x{i}" for i, f in enumerate(META))
cte("mrow", "mfeat fwd", f"SELECT m.entity, m.dt, m.sector, {XS}, w.fwd_ret AS y FROM mfeat m JOIN fwd w USING (entity, dt)")
cte("er", "mrow", "SELECT * FROM mrow WHERE " + " AND ".join(f"x{i} IS NOT NULL" for i in range(K)))
cte("eidx", "er", "SELECT dt, count(*) AS c, row_number() OVER (ORDER BY dt) - 1 AS idx, count(*) OVER () AS n FROM er GROUP BY dt")


def meta_inputs(spark, sf, staged=None, horizon=None):
    """(entity, dt, sector, the inputs): scores of the first level, the as-of snapshot, the day's macro readings. With
    ``horizon`` also the outcome ``fwd_ret``; rows without one drop out."""
    prices, base = staged or staged_panel(spark, sf)
    uni = cut_lineage(universe(spark, sf, base))
    hits = score_hits(spark, sf, base, uni)
    calibrator = cut_lineage(M.fit_bucket_calibrator(hits, "score", "beat"))
    feats = features(spark, sf, base).withColumn("momentum_score", X.momentum_score("mom_1", "mom_4", "vs_ma10", "rsi"))
    if P.single_entities(spark, sf):
        # one row per (entity, dt): everything about an entity's prices from one shuffle and sort
        rows = W.realized_vol(feats.select("entity", "dt", "sector", "close", "bench", "momentum_score"), 8, 52)
        if horizon:
            rows = W.forward_return(rows, horizon)
        rows = rows.withColumnRenamed("realized_vol", "expected_move").where("dt IS NOT NULL")
        rows = rows.join(cut_lineage(J.asof_snapshot(base, uni)), "dt", "left")
        rows = rows.join(uni.select("entity", "snapshot_dt", "score", "conviction").repartition("entity"), ["entity", "snapshot_dt"], "left")
    else:
        moves = W.realized_vol(base.drop("bench"), 8, 52).select("entity", "dt", F.col("realized_vol").alias("expected_move"))
        rows = feats.select("entity", "dt", "sector", "momentum_score").join(moves, ["entity", "dt"])
        rows = rows.join(asof_rows(spark, sf, base, uni).drop("close"), ["entity", "dt"])
        if horizon:
            rows = rows.join(W.forward_return(base, horizon).select("entity", "dt", "fwd_ret"), ["entity", "dt"])
    known = F.col("score").isNotNull()
    word = F.when(F.col("conviction") == "rising", 1.0).when(F.col("conviction") == "declining", -1.0).otherwise(0.0)
    rows = M.apply_bucket_calibrator(rows, calibrator, "score").withColumns({
        "research_calibrator_prob": F.when(known, F.col("prob")), "research_composite_score": F.col("score") / 100,
        "research_conviction": F.when(known, word)})
    # a row per day, week or quarter and sector each: written, so that the planner knows how small they are
    macro = W.intensity_series(daily_macro_panel(spark, sf)).select(
        "dt", F.col("spy_20d_return").alias("macro_spy_20d_return"), F.col("spy_20d_vol").alias("macro_spy_20d_vol"),
        (F.col("vix_level") * LEVEL_UNIT).alias("macro_vix_level"), (F.col("vix_term_slope") * SLOPE_UNIT).alias("macro_vix_term_slope"),
        (F.col("yield_curve_10y_2y") * SLOPE_UNIT).alias("macro_yield_curve_slope"), F.col("intensity_z").alias("regime_intensity_z"))
    breadth = weekly_breadth(spark, sf, prices).select("dt", F.col("market_breadth").alias("macro_market_breadth"))
    rows = rows.join(cut_lineage(modifiers(spark, sf, base)), ["snapshot_dt", "sector"], "left")
    rows = rows.withColumn("sector_macro_modifier", F.when(known, F.coalesce("modifier", F.lit(1.0)) - 1))
    rows = rows.join(cut_lineage(macro), "dt", "left").join(cut_lineage(breadth), "dt", "left")
    return rows.select("entity", "dt", "sector", *META, *(["fwd_ret"] if horizon else []))


def meta_frame(spark, sf, staged=None):
    """The inputs and the outcome, written once; an input may be missing."""
    return cut_lineage(meta_inputs(spark, sf, staged, 4))


def meta_rows(spark, sf, staged=None):
    return meta_frame(spark, sf, staged).dropna(subset=[*META, "fwd_ret"])


# --- folds -----------------------------------------------------------------------------------


@register("walk_forward_folds", "fold_id:i dt:d role:s", "eidx", """
, k AS (SELECT CAST(k AS INTEGER) AS k, 104 + CAST(k AS INTEGER) * 26 AS s FROM range(100) r(k) WHERE 104 + k * 26 < (SELECT max(n) FROM eidx) AND (SELECT max(n) FROM eidx) - (104 + k * 26) >= 13),
c AS (SELECT k, dt, c, CASE WHEN idx BETWEEN s AND s + 25 THEN 'test' WHEN idx <= s - 4 THEN 'train' END AS role FROM eidx, k),
t AS (SELECT *, sum(CASE WHEN role = 'train' THEN c ELSE 0 END) OVER (PARTITION BY k) AS tr, sum(CASE WHEN role = 'test' THEN c ELSE 0 END) OVER (PARTITION BY k) AS te FROM c WHERE role IS NOT NULL)
SELECT dense_rank() OVER (ORDER BY k) - 1 AS fold_id, dt, role FROM t WHERE tr >= 1000 AND te >= 100""")
def walk_forward_folds(spark, sf):
    return FD.walk_forward_folds(meta_rows(spark, sf), 26, 104, 4)


def sql_expanding(source: str, forward: int, n_folds: int = 5, min_test: int = 21, key: str = "") -> str:
    """SQL text: (fold_id, dt, role) from an index table with idx and n; ample history assumed by the
    test data is checked through the same shrink rule."""
    return f"""SELECT {key} k AS fold_id, dt, CASE WHEN idx >= s AND idx < s + t THEN 'test' ELSE 'train' END AS role FROM (
 SELECT *, CAST(n - (f - k) * t AS BIGINT) AS s FROM (SELECT *, greatest({min_test}, n // (f + 1)) AS t FROM (
  SELECT *, CASE WHEN n < {(n_folds + 1) * min_test} THEN greatest(1, n // {min_test} - 1) ELSE {n_folds} END AS f FROM {source})), range({n_folds}) r(k) WHERE k < f)
WHERE s - {forward} > {min_test} AND ((idx >= s AND idx < s + t) OR idx < s - {forward})"""


cte("efold", "eidx", sql_expanding("eidx", 4))


@register("expanding_folds", "fold_id:i dt:d role:s", "efold", "SELECT * FROM efold")
def expanding_folds(spark, sf):
    return FD.expanding_folds(meta_rows(spark, sf), 4)


COMBOS = ", ".join(f"({i}, {g})" for i, c in enumerate(combinations(range(6), 2)) for g in c)
cte("cfold", "eidx", f"""
SELECT fold_id, dt, CASE WHEN bool_or(idx BETWEEN a AND b) THEN 'test' WHEN NOT bool_or(idx BETWEEN a - 4 AND b + 4) THEN 'train' END AS role FROM (
 SELECT e.dt, e.idx, v.f AS fold_id, v.g * n // 6 AS a, (v.g + 1) * n // 6 - 1 AS b FROM eidx e, (VALUES {COMBOS}) v(f, g)) GROUP BY fold_id, dt
HAVING bool_or(idx BETWEEN a AND b) OR NOT bool_or(idx BETWEEN a - 4 AND b + 4)""")


@register("cpcv_folds", "fold_id:i dt:d role:s", "cfold", "SELECT * FROM cfold")
def cpcv_folds(spark, sf):
    return FD.cpcv_folds(meta_rows(spark, sf), 4)


@register("time_split", "dt:d role:s", "eidx", """
SELECT dt, CASE WHEN p < floor(t * 0.7) THEN 'train' WHEN p < floor(t * 0.85) THEN 'val' ELSE 'test' END AS role FROM (
 SELECT dt, coalesce(sum(c) OVER (ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p, sum(c) OVER () AS t FROM eidx)""")
def time_split(spark, sf):
    return FD.time_split(meta_rows(spark, sf))


# --- linear models ---------------------------------------------------------------------------

GRAM_NAMES = G.gram_names(K)


def sql_gram(k: int = K) -> str:
    """SQL text: the sums of cross products in the order of their names, from columns w, x0.., y."""
    x = range(k)
    terms = ["sum(w)", "count(*)", *[f"sum(w * x{i})" for i in x], "sum(w * y)", "sum(w * y * y)", *[f"sum(w * x{i} * y)" for i in x]]
    terms += [f"sum(w * x{i} * x{j})" for i in x for j in range(i, k)]
    return ", ".join(f"{t} AS {n}" for t, n in zip(terms, G.gram_names(k)))


GRAM_SUMS = sql_gram()
SUMMED = ", ".join(f"sum({n}) AS {n}" for n in GRAM_NAMES)
cte("gram", "er", f"SELECT dt, {GRAM_SUMS} FROM (SELECT *, 1.0::DOUBLE AS w FROM er) GROUP BY dt")


@register("gram_table", "dt:d n:i " + " ".join(f"{n}:f" for n in GRAM_NAMES[2:]), "gram", "SELECT * FROM gram")
def gram_table(spark, sf):
    return G.gram_table(meta_frame(spark, sf), META, "fwd_ret", ["dt"])


def sql_solver(source: str, key: str, matrix: str, k: int, p: str) -> str:
    """SQL text: Gauss-Jordan steps on ``matrix`` (a list of rows) of every row of ``source``, one pivot after the
    other. Ends in a table ``{p}inverse`` (key, inv)."""
    return f"""
{p}gj AS (SELECT {key}, 0 AS j, list_transform(range({k}), lambda r: list_concat(({matrix})[r + 1], list_transform(range({k}), lambda q: CASE WHEN q = r THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END))) AS m FROM {source}
 UNION ALL SELECT {key}, j + 1, list_transform(m, lambda row, r: CASE WHEN r = j + 1 THEN pr ELSE list_transform(row, lambda v, q: v - row[j + 1] * pr[q]) END) FROM (
  SELECT *, list_transform(m[j + 1], lambda v: v / m[j + 1][j + 1]) AS pr FROM {p}gj WHERE j < {k})),
{p}inverse AS (SELECT {key}, list_transform(m, lambda row: row[{k + 1}:]) AS inv FROM {p}gj WHERE j = {k})"""


def sql_bayes(stats: str, key: str, use: str = "", p: str = "", k: int = K) -> str:
    """SQL text: the evidence iteration on rows of sums. Each pass inverts (cross products + ratio of precisions)
    by Gauss-Jordan steps, one pivot a step of the recursion. ``use`` names a list column of 0 and 1:
    inputs switched off have zero cross products and coefficients. Ends in a table ``{p}model`` (key, n, c, b, noise, prior, mx, vy, g, inv)."""
    xs = range(k)
    u = [f"{use}[{i + 1}]" if use else "1" for i in xs]
    name = {(i, j): f"xx{min(i, j)}_{max(i, j)}" for i in xs for j in xs}
    rows = ", ".join("[" + ", ".join(f"{u[i]} * {u[j]} * ({name[i, j]} - x{i} * x{j} / w)" for j in xs) + "]" for i in xs)
    start = f"list_transform(range({k}), lambda r: list_concat(list_transform(g[r + 1], lambda v, q: v + CASE WHEN q = r + 1 THEN l / a ELSE 0.0 END), list_transform(range({k}), lambda q: CASE WHEN q = r THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)))"
    return f"""
, {p}c AS (SELECT {key}, w AS n, [{', '.join(f'x{i} / w' for i in xs)}] AS mx, y / w AS my, [{rows}] AS g, [{', '.join(f'{u[i]} * (xy{i} - x{i} * y / w)' for i in xs)}] AS bv,
  yy - y * y / w AS yy, (yy - y * y / w) / w AS vy, [{', '.join(u)}] AS u FROM {stats} WHERE n >= 20),
{p}it AS (
 SELECT {key}, 0 AS i, 0 AS j, 1 / (vy + 2.220446049250313e-16) AS a, 1.0::DOUBLE AS l, list_transform(range({k}), lambda r: 0.0::DOUBLE) AS c, false AS done,
  {start.replace('l / a', '(vy + 2.220446049250313e-16)')} AS m FROM {p}c
 UNION ALL
 SELECT {key}, i, j, a, l, c, done, CASE WHEN j > 0 THEN list_transform(m, lambda row, r: CASE WHEN r = j THEN pr ELSE list_transform(row, lambda v, q: v - row[j] * pr[q]) END) ELSE {start} END AS m FROM (
  SELECT {key}, CASE WHEN j < {k} THEN i ELSE i + 1 END AS i, CASE WHEN j < {k} THEN j + 1 ELSE 0 END AS j, CASE WHEN j < {k} THEN a ELSE na END AS a, CASE WHEN j < {k} THEN l ELSE nl END AS l,
   CASE WHEN j < {k} THEN c ELSE nc END AS c, CASE WHEN j < {k} THEN done ELSE i >= 1 AND list_sum(list_transform(nc, lambda v, q: abs(v - c[q]))) < 1e-3 END AS done, m, g, CASE WHEN j < {k} THEN list_transform(m[j + 1], lambda v: v / m[j + 1][j + 1]) END AS pr FROM (
   SELECT *, (n - gm + 2e-6) / (greatest(yy - 2 * list_dot_product(nc, bv) + list_sum(list_transform(g, lambda row, r: nc[r] * list_dot_product(row, nc))), 0) + 2e-6) AS na, (gm + 2e-6) / (list_dot_product(nc, nc) + 2e-6) AS nl FROM (
    SELECT t.{key}, t.i, t.j, t.a, t.l, t.c, t.done, t.m, cc.*, CASE WHEN t.j = {k} THEN list_transform(t.m, lambda row: list_dot_product(row[{k + 1}:], cc.bv)) ELSE cc.bv END AS nc,
     {k} - t.l / t.a * CASE WHEN t.j = {k} THEN list_sum(list_transform(t.m, lambda row, r: row[{k} + r])) ELSE 0 END AS gm
    FROM {p}it t JOIN (SELECT * RENAME ({key} AS ky) FROM {p}c) cc ON cc.ky = t.{key} WHERE NOT (t.j = {k} AND (t.done OR t.i >= 300)))) r0)),
{p}model AS (SELECT *, my - list_dot_product(c, mx) AS b FROM (SELECT cc.{key}, n, mx, my, vy, g, f.a AS noise, f.l AS prior, inv, list_transform(inv, lambda row, r: cc.u[r] * list_dot_product(row, cc.bv)) AS c, cc.u FROM {p}c cc
 JOIN (SELECT *, list_transform(m, lambda row: row[{k + 1}:]) AS inv FROM {p}it WHERE j = {k} AND (done OR i >= 300)) f USING ({key})))"""


def sql_value(row: str = "e", model: str = "m", k: int = K) -> str:
    """SQL text: a model's prediction for a row's inputs."""
    return f"{model}.b + " + " + ".join(f"{model}.c[{i + 1}] * {row}.x{i}" for i in range(k))


def with_coefs(models):
    return models.withColumns({f"c{i}": F.get("coef", F.lit(i)) for i in range(K)})


COEFS = " ".join(f"c{i}:f" for i in range(K))
SQL_COEFS = ", ".join(f"c[{i + 1}] AS c{i}" for i in range(K))


@register("fit_bayes_ridge", f"model:s {COEFS} intercept:f noise:f prior:f n_fit:i", "gram", f"""
, st AS (SELECT 'all' AS model, {SUMMED} FROM gram)
{sql_bayes('st', 'model')} SELECT model, {SQL_COEFS}, b AS intercept, noise, prior, n AS n_fit FROM model""")
def fit_bayes_ridge(spark, sf):
    return with_coefs(G.fit_bayes_ridge(meta_frame(spark, sf), META, "fwd_ret"))


cte("wer", "er winlab", """
, """.strip(", \n") + """SELECT e.*, q.w FROM er e JOIN (
 SELECT entity, dt, avg(1.0::DOUBLE / c) AS w FROM (SELECT entity, dt, unnest(generate_series(start, start + 20)) AS t FROM winlab) JOIN (
  SELECT entity, t, count(*) AS c FROM (SELECT entity, unnest(generate_series(start, start + 20)) AS t FROM winlab) GROUP BY 1, 2) USING (entity, t) GROUP BY 1, 2) q USING (entity, dt)""")


@register("fit_bayes_ridge_weighted", f"sector:i {COEFS} intercept:f n_fit:i", "wer", f"""
, st AS (SELECT sector, {GRAM_SUMS} FROM wer GROUP BY sector)
{sql_bayes('st', 'sector')} SELECT m.sector, {SQL_COEFS}, b AS intercept, s.n AS n_fit FROM model m JOIN st s USING (sector)""")
def fit_bayes_ridge_weighted(spark, sf):
    """Per sector, rows weighted by their average uniqueness."""
    from panelith.plans.labels import window_labels
    weights = L.uniqueness_weights(window_labels(spark, sf), group=["entity"]).select("entity", "dt", "weight")
    rows = meta_frame(spark, sf).join(weights, ["entity", "dt"])
    return with_coefs(G.fit_bayes_ridge(rows, META, "fwd_ret", ["sector"], "weight"))


@register("score_linear", "entity:i dt:d pred:f pred_std:f", "gram", f"""
, st AS (SELECT 'all' AS model, {SUMMED} FROM gram)
{sql_bayes('st', 'model')} SELECT entity, dt, pred, sqrt(list_sum(list_transform(inv, lambda row, r: d[r] * list_dot_product(row, d))) / noise + 1 / noise) AS pred_std FROM (
 SELECT e.entity, e.dt, {sql_value()} AS pred, m.inv, m.noise, [{', '.join(f'e.x{i} - m.mx[{i + 1}]' for i in range(K))}] AS d FROM er e, model m)""")
def score_linear(spark, sf):
    rows = meta_rows(spark, sf)
    return G.score_linear(rows, G.fit_bayes_ridge(rows, META, "fwd_ret"), META, with_std=True)


@register("in_sample_ic", "ic:f n:i", "gram", f"""
, st AS (SELECT 'all' AS model, {SUMMED} FROM gram)
{sql_bayes('st', 'model')} SELECT corr({sql_value()}, y) AS ic, count(*) AS n FROM er e, model m""")
def in_sample_ic(spark, sf):
    rows = meta_rows(spark, sf)
    return G.in_sample_ic(G.score_linear(rows, G.fit_bayes_ridge(rows, META, "fwd_ret"), META), "pred", "fwd_ret")


@register("linear_importance", "feature:s coef:f standardized:f", "gram", f"""
, st AS (SELECT 'all' AS model, {SUMMED} FROM gram)
{sql_bayes('st', 'model')} {' UNION ALL '.join(f"SELECT '{f}' AS feature, c[{i + 1}] AS coef, c[{i + 1}] * sqrt(g[{i + 1}][{i + 1}] / n) / sqrt(vy) AS standardized FROM model" for i, f in enumerate(META))}""")
def linear_importance(spark, sf):
    return G.standardized_coefficients(G.fit_bayes_ridge(meta_frame(spark, sf), META, "fwd_ret"), META, ["model"])


FOLD_SQL = "(r * {A} + (k % {T}) * {S} + i) % {M}".format(A=MIX_A, T=M.ROUNDS, S=MIX_STEP, M=MIX_MOD)


@register("permutation_importance", "feature:s ic_drop:f", "gram", f"""
, st AS (SELECT 'all' AS model, {SUMMED} FROM gram)
{sql_bayes('st', 'model')},
pos AS (SELECT e.*, m.c AS coef, {sql_value()} AS pred, row_number() OVER (ORDER BY e.dt, e.entity) - 1 AS p FROM er e, model m),
side AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM pos),
walk AS (
 SELECT i, p, CAST(0 AS BIGINT) AS k, CAST(p // a AS BIGINT) AS l, CAST(p % a AS BIGINT) AS r FROM pos, side, (SELECT unnest(range({K})) AS i)
 UNION ALL SELECT i, p, k + 1, r, (l + xor(w, w >> 13)) % a FROM (
  SELECT *, xor(v, v >> 15) * {MIX_B} % {MIX_MOD} AS w FROM (SELECT *, {FOLD_SQL} AS v FROM walk, side WHERE k = 0 OR k % {M.ROUNDS} <> 0 OR l * a + r >= n))),
sent AS (SELECT i, p, l * a + r AS q FROM walk, side WHERE k > 0 AND k % {M.ROUNDS} = 0 AND l * a + r < n),
x AS (SELECT p, y, pred, coef, [{', '.join(f'x{i}' for i in range(K))}] AS v FROM pos)
SELECT [{', '.join(f"'{f}'" for f in META)}][s.i + 1] AS feature, corr(o.pred, o.y) - coalesce(corr(o.pred + o.coef[s.i + 1] * (d.v[s.i + 1] - o.v[s.i + 1]), o.y), 0) AS ic_drop
FROM sent s JOIN x d ON d.p = s.p JOIN x o ON o.p = s.q GROUP BY s.i""")
def permutation_importance(spark, sf):
    rows = meta_rows(spark, sf)
    models = cut_lineage(G.fit_bayes_ridge(rows, META, "fwd_ret"))
    return M.permutation_importance(G.score_linear(rows, models, META), models, META, "fwd_ret")


@register("apply_scaler", "entity:i dt:d " + " ".join(f"{f}:f" for f in META), "er", f"""
SELECT entity, dt, {', '.join(f'least(3, greatest(-3, (x{i} - m{i}) / s{i})) AS {f}' for i, f in enumerate(META))} FROM er, (
 SELECT {', '.join(f'avg(x{i}) AS m{i}, CASE WHEN stddev_pop(x{i}) > 1e-9 THEN stddev_pop(x{i}) ELSE 1 END AS s{i}' for i in range(K))} FROM er)""")
def apply_scaler(spark, sf):
    rows = meta_rows(spark, sf)
    return G.apply_scaler(rows, G.fit_scaler(rows, META), META)


# --- leak-free reads -------------------------------------------------------------------------

cte("egram", "gram efold", f"SELECT f.fold_id, {', '.join(f'sum(g.{n}) AS {n}' for n in GRAM_NAMES)} FROM gram g JOIN efold f USING (dt) WHERE f.role = 'train' GROUP BY 1")
OOS = f"""{sql_bayes('egram', 'fold_id')},
oos AS (SELECT 'all' AS model, e.entity, e.dt, e.y, f.fold_id, {sql_value()} AS pred FROM er e JOIN efold f ON f.dt = e.dt AND f.role = 'test' JOIN model m USING (fold_id))"""


def sql_read(source: str, key: str, y: str = "y") -> str:
    return f"""
SELECT p.{key}, p.ic AS pooled_ic, p.n, x.xsec_ic, x.n_dates, f.n_folds, CASE WHEN p.n < 10 THEN 'insufficient_folds' ELSE 'ok' END AS status
FROM ({sql_ic(source, 'pred', y, key, 10)}) p JOIN (SELECT {key}, count(DISTINCT fold_id) AS n_folds FROM {source} GROUP BY 1) f USING ({key})
LEFT JOIN (SELECT {key}, avg(ic) AS xsec_ic, count(*) AS n_dates FROM ({sql_ic(source, 'pred', y, key + ', dt')}) WHERE ic IS NOT NULL GROUP BY 1) x USING ({key})"""


READ = "xsec_ic:f n_dates:i pooled_ic:f n:i n_folds:i status:s"


@register("leakfree_oos_ic", READ + " ci_lo:f ci_hi:f", "er egram efold", OOS + sql_dates("oos", "pred", "y", "model") +
          f" SELECT r.*, c.ci_lo, c.ci_hi FROM ({sql_read('oos', 'model')}) r JOIN ({sql_bootstrap('oos', 'pred', 'y', BOOT, 42, 'model')}) c USING (model)")
def leakfree_oos_ic(spark, sf):
    return M.leakfree_oos_ic(meta_frame(spark, sf), META, "fwd_ret", 4, n_iter=BOOT, group_bound=bound(spark, sf))


@register("leakfree_decile", "bin:i mean_actual:f n_dates:i", "er egram efold", OOS + """
SELECT bin, avg(m) AS mean_actual, count(*) AS n_dates FROM (SELECT dt, ((r - 1) * 10) // n AS bin, avg(y) AS m FROM (
 SELECT dt, y, row_number() OVER (PARTITION BY dt ORDER BY round(pred, 10), entity) AS r, count(*) OVER (PARTITION BY dt) AS n FROM oos) WHERE n >= 10 GROUP BY 1, 2) GROUP BY 1""")
def leakfree_decile(spark, sf):
    rows = meta_rows(spark, sf)
    preds = M.oos_predictions(rows, META, "fwd_ret", FD.expanding_folds(rows, 4))
    return E.decile_spread(preds, "pred", "fwd_ret", group_bound=bound(spark, sf))


cte("cgram", "gram cfold", f"SELECT f.fold_id, {', '.join(f'sum(g.{n}) AS {n}' for n in GRAM_NAMES)} FROM gram g JOIN cfold f USING (dt) WHERE f.role = 'train' GROUP BY 1")
CPCV = f"""{sql_bayes('cgram', 'fold_id')},
oos AS (SELECT f.fold_id, e.entity, e.dt, e.y, {sql_value()} AS pred FROM er e JOIN cfold f ON f.dt = e.dt AND f.role = 'test' JOIN model m USING (fold_id)),
paths AS (SELECT fold_id, avg(ic) AS ic, count(*) AS n_dates FROM ({sql_ic('oos', 'pred', 'y', 'fold_id, dt')}) WHERE ic IS NOT NULL GROUP BY 1)"""


@register("cpcv_ic", "fold_id:i ic:f n_dates:i", "er cgram cfold", CPCV + " SELECT * FROM paths")
def cpcv_ic(spark, sf):
    return M.cpcv_ic(meta_frame(spark, sf), META, "fwd_ret", 4, group_bound=bound(spark, sf))


@register("cpcv_summary", "n_combos:i n_paths:i mean_ic:f std_ic:f p05_ic:f p50_ic:f p95_ic:f min_ic:f max_ic:f frac_positive:f", "er cgram cfold", CPCV + """
SELECT count(*) AS n_combos, 5 AS n_paths, avg(ic) AS mean_ic, stddev_samp(ic) AS std_ic, quantile_cont(ic, 0.05) AS p05_ic, quantile_cont(ic, 0.5) AS p50_ic, quantile_cont(ic, 0.95) AS p95_ic,
 min(ic) AS min_ic, max(ic) AS max_ic, avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0.0 END) AS frac_positive FROM paths""")
def cpcv_summary(spark, sf):
    ics = M.cpcv_ic(meta_frame(spark, sf), META, "fwd_ret", 4, group_bound=bound(spark, sf))
    return M.cpcv_summary(ics, 6, 2)


@register("promotion_series", "source:s n:i mean_ic:f downside_deviation:f sortino:f frac_negative:f worst:f passes:b", "er cgram cfold", CPCV + """
SELECT *, n >= 5 AND (CASE WHEN sortino IS NULL THEN mean_ic > 0 ELSE sortino >= 0 END) AS passes FROM (SELECT *, CASE WHEN n >= 5 AND downside_deviation > 1e-12 THEN mean_ic / downside_deviation END AS sortino FROM (
 SELECT 'cpcv' AS source, count(*) AS n, avg(ic) AS mean_ic, coalesce(sqrt(avg(CASE WHEN ic < 0 THEN ic * ic END)), 0) AS downside_deviation,
  avg(CASE WHEN ic < 0 THEN 1.0 ELSE 0.0 END) AS frac_negative, min(ic) AS worst FROM paths))""")
def promotion_series(spark, sf):
    combos = M.cpcv_ic(meta_frame(spark, sf), META, "fwd_ret", 4, group_bound=bound(spark, sf))
    forward = E.ic_series(eval_rows(spark, sf), "mom_4", "fwd_ret", group_bound=bound(spark, sf))
    return E.downside_stats(E.promotion_series(combos, forward), by=["source"])


ADDED = ["momentum_score", "regime_intensity_z"]
BASE = [f for f in META if f not in ADDED]
LEAVE = {"full": META} | {f"without_{f}": [g for g in META if g != f] for f in META}
ADD = {"base": BASE} | {f"with_{f}": [*BASE, f] for f in ADDED}


def sql_variants(variants: dict) -> str:
    """SQL text: out-of-fold predictions of every variant, each with its own rows, dates and folds."""
    values = ", ".join(f"('{name}', [{', '.join(str(int(f in use)) for f in META)}])" for name, use in variants.items())
    fill = ", ".join(f"coalesce(x{i}, 0) AS x{i}" for i in range(K))
    known = " AND ".join(f"(v.u[{i + 1}] = 0 OR x{i} IS NOT NULL)" for i in range(K))
    return f"""
, vs AS (SELECT * FROM (VALUES {values}) v(variant, u)),
vrow AS (SELECT v.variant, v.u, r.entity, r.dt, {fill}, r.y, 1.0::DOUBLE AS w FROM mrow r JOIN vs v ON {known}),
vidx AS (SELECT variant, dt, row_number() OVER (PARTITION BY variant ORDER BY dt) - 1 AS idx, count(*) OVER (PARTITION BY variant) AS n FROM (SELECT DISTINCT variant, dt FROM vrow)),
vfold AS ({sql_expanding('vidx', 4, key='variant,')}),
vday AS (SELECT variant, dt, any_value(u) AS u, {GRAM_SUMS} FROM vrow GROUP BY 1, 2),
vg AS (SELECT d.variant || '|' || f.fold_id AS vf, any_value(u) AS u, {SUMMED} FROM vday d JOIN vfold f USING (variant, dt) WHERE f.role = 'train' GROUP BY 1)
{sql_bayes('vg', 'vf', 'u')},
oos AS (SELECT e.variant, e.entity, e.dt, e.y, f.fold_id, {sql_value()} AS pred FROM vrow e JOIN vfold f ON f.variant = e.variant AND f.dt = e.dt AND f.role = 'test' JOIN model m ON m.vf = e.variant || '|' || f.fold_id),
rd AS ({sql_read('oos', 'variant')})"""


@register("leave_one_out", "variant:s ic_added:f " + READ, "mrow", sql_variants(LEAVE) + """
SELECT *, (SELECT xsec_ic FROM rd WHERE variant = 'full') - xsec_ic AS ic_added FROM rd""")
def leave_one_out(spark, sf):
    return M.leave_one_out(meta_frame(spark, sf), META, "fwd_ret", 4, group_bound=bound(spark, sf))


@register("add_one_in", "variant:s " + READ, "mrow", sql_variants(ADD) + " SELECT * FROM rd")
def add_one_in(spark, sf):
    return M.add_one_in(meta_frame(spark, sf), BASE, ADDED, "fwd_ret", 4, group_bound=bound(spark, sf))


HC = [1, 4, 8]
cte("hcrow", "feat", "SELECT entity, dt, " + ", ".join(
    f"lead(close, {h}) OVER w / close - 1 - (lead(bench, {h}) OVER w / bench - 1) AS fwd_{h}" for h in HC)
    + " FROM feat WINDOW w AS (PARTITION BY entity ORDER BY dt)")
cte("hclong", "hcrow mfeat", f"SELECT entity, dt, {XS}, h.horizon, h.y FROM (SELECT entity, dt, CAST(substr(h, 5) AS INTEGER) AS horizon, y FROM (UNPIVOT hcrow ON fwd_1, fwd_4, fwd_8 INTO NAME h VALUE y)) h JOIN mfeat USING (entity, dt) WHERE "
    + " AND ".join(f"{f} IS NOT NULL" for f in META))
cte("hcidx", "hclong", "SELECT horizon, dt, row_number() OVER (PARTITION BY horizon ORDER BY dt) - 1 AS idx, count(*) OVER (PARTITION BY horizon) AS n FROM (SELECT DISTINCT horizon, dt FROM hclong)")
cte("hcfold", "hcidx", sql_expanding("hcidx", "horizon", key="horizon,"))


@register("horizon_curve", "horizon:i " + READ, "hclong hcfold", f"""
, hg AS (SELECT f.horizon || '|' || f.fold_id AS hf, {GRAM_SUMS} FROM (SELECT *, 1.0::DOUBLE AS w FROM hclong) l JOIN hcfold f USING (horizon, dt) WHERE f.role = 'train' GROUP BY 1)
{sql_bayes('hg', 'hf')},
oos AS (SELECT e.horizon, e.entity, e.dt, e.y, f.fold_id, {sql_value()} AS pred FROM hclong e JOIN hcfold f ON f.horizon = e.horizon AND f.dt = e.dt AND f.role = 'test' JOIN model m ON m.hf = f.horizon || '|' || f.fold_id)
{sql_read('oos', 'horizon')}""")
def horizon_curve(spark, sf):
    staged = staged_panel(spark, sf)
    returns = W.multi_horizon_returns(staged[1], HC).select("entity", "dt", *[f"fwd_{h}" for h in HC])
    rows = meta_inputs(spark, sf, staged).join(returns, ["entity", "dt"])
    return M.horizon_curve(rows, META, HC, group_bound=bound(spark, sf))


# --- estimators ------------------------------------------------------------------------------


@register("nonlinear_oos_ic", READ)
def nonlinear_oos_ic(spark, sf):
    return M.nonlinear_oos_ic(eval_rows(spark, sf), ["mom_4", "ret_13", "stale"], "fwd_ret", 4, group_bound=bound(spark, sf))


@register("estimator_oos_ic", READ, "er egram efold", f"""
, s AS (SELECT fold_id, y / w AS my, [{', '.join(f'x{i} / w' for i in range(K))}] AS mx, [{', '.join(f'xy{i} - x{i} * y / w' for i in range(K))}] AS bv,
  [{', '.join('[' + ', '.join(f'xx{min(i, j)}_{max(i, j)} - x{i} * x{j} / w' for j in range(K)) + ']' for i in range(K))}] AS g FROM egram),
{sql_solver('s', 'fold_id', 'g', K, 'o')},
m AS (SELECT *, my - list_dot_product(c, mx) AS b FROM (SELECT s.*, list_transform(inv, lambda row: list_dot_product(row, s.bv)) AS c FROM s JOIN oinverse USING (fold_id))),
oos AS (SELECT 'all' AS model, e.entity, e.dt, e.y, f.fold_id, {sql_value()} AS pred FROM er e JOIN efold f ON f.dt = e.dt AND f.role = 'test' JOIN m USING (fold_id))
{sql_read('oos', 'model')}""")
def estimator_oos_ic(spark, sf):
    """The same walk-forward with an injected estimator, here plain least squares."""
    return M.leakfree_oos_ic(meta_frame(spark, sf), META, "fwd_ret", 4, group_bound=bound(spark, sf),
                             estimator=LinearRegression(labelCol="label", regParam=0.0, solver="normal"))


@register("fit_gbt", "feature:s importance:f")
def fit_gbt(spark, sf):
    rows = eval_rows(spark, sf)
    return M.fit_gbt(rows, ["mom_1", "mom_4", "ret_13", "rsi"], "fwd_ret", F.col("dt") >= "2000-01-01", max_iter=10)[1]


@register("relevance_grades", "entity:i dt:d grade:i", "ev", """
SELECT entity, dt, (fwd_ret >= q[1])::INT + (fwd_ret >= q[2])::INT + (fwd_ret >= q[3])::INT + (fwd_ret >= q[4])::INT AS grade FROM ev, (SELECT quantile_cont(fwd_ret, [0.2, 0.4, 0.6, 0.8]) AS q FROM ev)""")
def relevance_grades(spark, sf):
    return M.relevance_grades(eval_rows(spark, sf), "fwd_ret")


cte("bucket", "outc", """
SELECT b AS bucket, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) >= 3 THEN r ELSE o END AS rate, o AS overall FROM range(6) t(b), (SELECT avg(beat) AS o FROM outc WHERE horizon_days = 28 AND beat IS NOT NULL)
LEFT JOIN (SELECT CASE WHEN score < 40 THEN 0 WHEN score < 55 THEN 1 WHEN score < 65 THEN 2 WHEN score < 75 THEN 3 WHEN score < 85 THEN 4 WHEN score < 100 THEN 5 END AS k, count(*) AS n, avg(beat) AS r
 FROM outc WHERE horizon_days = 28 AND beat IS NOT NULL GROUP BY 1) ON k = b""")


def score_hits(spark, sf, base=None, uni=None):
    from panelith.operators.joins import outcome_join
    scores, outcomes = score_tables(spark, sf, base, uni)
    return outcome_join(scores, outcomes, 28)


@register("bucket_calibrator", "bucket:i n:i rate:f overall:f", "bucket", "SELECT * FROM bucket")
def bucket_calibrator(spark, sf):
    return M.fit_bucket_calibrator(score_hits(spark, sf), "score", "beat")


@register("apply_bucket_calibrator", "symbol:i score_date:d prob:f", "outc bucket", """
SELECT symbol, score_date, coalesce(b.rate, CASE WHEN o.overall = 0 THEN 0.5 ELSE o.overall END) AS prob FROM outc
LEFT JOIN bucket b ON b.bucket = CASE WHEN score < 40 THEN 0 WHEN score < 55 THEN 1 WHEN score < 65 THEN 2 WHEN score < 75 THEN 3 WHEN score < 85 THEN 4 WHEN score < 100 THEN 5 END, (SELECT max(overall) AS overall FROM bucket) o
WHERE horizon_days = 28 AND beat IS NOT NULL""")
def apply_bucket_calibrator(spark, sf):
    rows = score_hits(spark, sf)
    return M.apply_bucket_calibrator(rows, M.fit_bucket_calibrator(rows, "score", "beat"), "score")


@register("holdout_gate", "n:i n_total:i component_ic:f baseline_ic:f passed:b skipped:b", "outc", """
, k AS (SELECT *, CASE WHEN score < 40 THEN 0 WHEN score < 55 THEN 1 WHEN score < 65 THEN 2 WHEN score < 75 THEN 3 WHEN score < 85 THEN 4 WHEN score < 100 THEN 5 END AS b,
  row_number() OVER (ORDER BY score_date, symbol) AS r, count(*) OVER () AS n FROM outc WHERE horizon_days = 28 AND beat IS NOT NULL),
f AS (SELECT *, r <= n - least(greatest(round(n * 0.2), 30), n - 30) AS fit FROM k),
o AS (SELECT avg(beat) AS o FROM f WHERE fit), t AS (SELECT b, CASE WHEN count(*) >= 3 THEN avg(beat) ELSE (SELECT o FROM o) END AS rate FROM f WHERE fit AND b IS NOT NULL GROUP BY b),
p AS (SELECT f.*, CASE WHEN f.b IS NULL THEN CASE WHEN o = 0 THEN 0.5 ELSE o END ELSE coalesce(t.rate, o) END AS p FROM f LEFT JOIN t USING (b), o WHERE NOT fit)
SELECT count(*) AS n, max(n) AS n_total, coalesce(corr(p, beat), 0) AS component_ic, coalesce(corr(score / 100, beat), 0) AS baseline_ic,
 max(n) < 60 OR round(coalesce(corr(p, beat), 0), 10) >= round(coalesce(corr(score / 100, beat), 0), 10) AS passed, max(n) < 60 AS skipped FROM p""")
def holdout_gate(spark, sf):
    return M.holdout_gate(score_hits(spark, sf), "score", "beat", "score_date", tiebreak="symbol")


def binary_rows(spark, sf):
    rows = W.forward_return(predictions(spark, sf), 4)
    return rows.withColumn("up", (F.round("fwd_ret", 10) >= 0).cast("int"))


@register("fit_calibrator", "method:s ece_before:f ece_after:f")
def fit_calibrator(spark, sf):
    rows, out = binary_rows(spark, sf), []
    for method in ("isotonic", "logistic"):
        _, before, after = M.fit_calibrator(rows, "predicted_alpha", "up", method)
        out.append((method, before, after))
    return spark.createDataFrame(out, "method string, ece_before double, ece_after double")


@register("calibrator_gate", "batch:s n:i n_unique:i modal_fraction:f std:f direction_skew:f failed_check:s passed:b")
def calibrator_gate(spark, sf):
    score, _, _ = M.fit_calibrator(binary_rows(spark, sf), "predicted_alpha", "up")
    return D.calibrator_gate(spark, score, (-CLIP, CLIP))


@register("auc_brier", "n:i base_rate:f brier:f auc:f", "pred fwd", """
, b AS (SELECT p_up AS p, CASE WHEN round(fwd_ret, 10) >= 0 THEN 1.0 ELSE 0.0 END AS y FROM pred JOIN fwd USING (entity, dt)),
r AS (SELECT *, rank() OVER (ORDER BY round(p, 10)) + (count(*) OVER (PARTITION BY round(p, 10)) - 1) / 2.0 AS k FROM b)
SELECT count(*) AS n, avg(y) AS base_rate, avg((p - y) * (p - y)) AS brier, (sum(CASE WHEN y = 1 THEN k END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS auc FROM r""")
def auc_brier(spark, sf):
    return M.auc_brier(binary_rows(spark, sf), "p_up", "up")


@register("fit_meta_label", "n:i base_rate:f brier:f auc:f")
def fit_meta_label(spark, sf):
    """Which barrier is touched first, from momentum features."""
    touch = L.triple_barrier_touch(barriers(spark, sf), "resid", 8, "barrier", "sign").select("entity", "dt", F.col("tb_touch").cast("int").alias("touch"))
    rows = eval_rows(spark, sf).join(touch, ["entity", "dt"]).where("touch IS NOT NULL")
    score = M.fit_meta_label(rows, ["mom_4", "ret_13", "stale"], "touch")
    return M.auc_brier(score(rows), "prob", "touch")


@register("fit_research_gbt", "n:i mean_prob:f brier:f auc:f")
def fit_research_gbt(spark, sf):
    hits = score_hits(spark, sf).select(F.col("symbol").alias("entity"), F.col("score_date").alias("dt"), "score", "beat")
    rows = hits.withColumn("sector_mod", F.month("dt"))
    scored, _ = M.fit_research_gbt(rows, ["score", "sector_mod"], "beat")
    out = M.auc_brier(scored, "research_calibrator_prob", "beat")
    return out.crossJoin(scored.agg(F.avg("research_calibrator_prob").alias("mean_prob")))


@register("fit_state_classifier", "state:i n:i mean_p0:f mean_p1:f mean_p2:f")
def fit_state_classifier(spark, sf):
    rows = cut_lineage(class_rows_source(spark, sf))
    score = M.fit_state_classifier(rows, ["back", "breadth"], "label", classes=3)
    return score(rows).groupBy("state").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"p{i}").alias(f"mean_p{i}") for i in range(3)])


# --- factor model ----------------------------------------------------------------------------

# The loadings of the factor model, momentum to quality. Price over its long average stands in for
# the price-earnings ratio and trading volume over its average for the return on equity.
LOADINGS = [
    "momentum_20d_zscore", "return_60d_zscore", "beta_60d_zscore", "idio_vol_60d_zscore", "realized_vol_63d_zscore",
    "dist_from_52w_high_zscore", "pe_ratio_zscore", "roe_zscore",
]
FACTORS = ["market", *LOADINGS]
cte("loadraw", "feat", """
SELECT entity, dt, mom_4 AS l0, ret_13 AS l1, beta AS l2, sqrt(greatest(vr - beta * cv, 0)) AS l3, CASE WHEN nl = 13 THEN sl * sqrt(52.0) END AS l4,
 CASE WHEN nh = 52 THEN close / hi - 1 END AS l5, vs_ma40 AS l6, CASE WHEN nv = 13 THEN volume / mv END AS l7, nxt AS r FROM (
 SELECT *, CASE WHEN nr = 13 AND vb > 0 THEN cv / vb END AS beta FROM (
  SELECT *, count(r0) OVER w AS nr, var_samp(r0) OVER w AS vr, var_samp(rb) OVER w AS vb, covar_samp(r0, rb) OVER w AS cv, count(lr) OVER w AS nl, stddev_samp(lr) OVER w AS sl,
   count(close) OVER y AS nh, max(close) OVER y AS hi, count(volume) OVER w AS nv, avg(volume) OVER w AS mv FROM (
   SELECT *, close / lag(close) OVER e - 1 AS r0, bench / lag(bench) OVER e - 1 AS rb, ln(close / lag(close) OVER e) AS lr, lead(close) OVER e / close - 1 AS nxt FROM feat WINDOW e AS (PARTITION BY entity ORDER BY dt))
  WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), y AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 51 PRECEDING AND CURRENT ROW)))""")
cte("fm", "loadraw", "SELECT r.entity, r.dt, " + ", ".join(f"CASE WHEN s{i} > 1e-9 THEN (l{i} - m{i}) / s{i} END AS x{i}" for i in range(8))
    + ", r AS y FROM loadraw r JOIN (SELECT dt, " + ", ".join(f"avg(l{i}) AS m{i}, stddev_pop(l{i}) AS s{i}" for i in range(8)) + " FROM loadraw GROUP BY dt) USING (dt)")
cte("fsum", "fm", f"SELECT * FROM (SELECT dt, {sql_gram(8)} FROM (SELECT *, 1.0::DOUBLE AS w FROM fm) WHERE y IS NOT NULL AND "
    + " AND ".join(f"x{i} IS NOT NULL" for i in range(8)) + " GROUP BY dt) WHERE n >= 30")
cte("fcen", "fsum", f"""
SELECT dt, y / w AS my, [{', '.join(f'x{i} / w' for i in range(8))}] AS mx, [{', '.join(f'xy{i} - x{i} * y / w' for i in range(8))}] AS bv,
 [{', '.join('[' + ', '.join(f'xx{min(i, j)}_{max(i, j)} - x{i} * x{j} / w' for j in range(8)) + ']' for i in range(8))}] AS g FROM fsum""")
FSOLVE = sql_solver("fcen", "dt", "g", 8, "f") + """,
fret AS (SELECT dt, my - list_dot_product(c, mx) AS market, c FROM (SELECT s.*, list_transform(inv, lambda row: list_dot_product(row, s.bv)) AS c FROM fcen s JOIN finverse USING (dt)))"""


def factor_rows(spark, sf):
    """(entity, dt, loadings, r): loadings as z-scores of their date, and the next week's return."""
    e = W.by_entity()
    close, volume = F.col("close"), F.col("volume")
    rows = features(spark, sf).withColumns({
        "r0": close / F.lag("close").over(e) - 1, "rb": F.col("bench") / F.lag("bench").over(e) - 1,
        "lr": F.log(close / F.lag("close").over(e)), "r": F.lead("close").over(e) / close - 1})
    w, y = e.rowsBetween(-12, 0), e.rowsBetween(-51, 0)
    beta = F.when((F.count("r0").over(w) == 13) & (F.var_samp("rb").over(w) > 0), F.covar_samp("r0", "rb").over(w) / F.var_samp("rb").over(w))
    rows = rows.withColumns({"beta": beta, "cv": F.covar_samp("r0", "rb").over(w), "vr": F.var_samp("r0").over(w)})
    raw = [
        F.col("mom_4"), F.col("ret_13"), F.col("beta"), F.when(F.col("beta").isNotNull(), F.sqrt(F.greatest(F.col("vr") - F.col("beta") * F.col("cv"), F.lit(0.0)))),
        full_frame(F.col("lr"), F.stddev_samp("lr"), w, 13) * 52.0**0.5, close / full_frame(close, F.max("close"), y, 52) - 1,
        F.col("vs_ma40"), volume / full_frame(volume, F.avg("volume"), w, 13)]
    rows = cut_lineage(rows.select("entity", "dt", "r", *[c.alias(n) for c, n in zip(raw, LOADINGS)]))
    moments = rows.groupBy("dt").agg(*[a(n).alias(f"{n}_{t}") for n in LOADINGS for t, a in (("m", F.avg), ("s", F.stddev_pop))])
    rows = rows.join(moments, "dt")
    scored = {n: F.when(F.col(f"{n}_s") > 1e-9, (F.col(n) - F.col(f"{n}_m")) / F.col(f"{n}_s")) for n in LOADINGS}
    return cut_lineage(rows.withColumns(scored).select("entity", "dt", "r", *LOADINGS))


@register("factor_returns", "dt:d factor:s value:f", "fcen", ", " + FSOLVE + """
SELECT dt, 'market' AS factor, market AS value FROM fret""" + "".join(f" UNION ALL SELECT dt, '{n}', c[{i + 1}] FROM fret" for i, n in enumerate(LOADINGS)))
def factor_returns(spark, sf):
    return G.factor_returns(factor_rows(spark, sf), LOADINGS, "r")


SQL_FACTORS = ["market", *[f"c[{i + 1}]" for i in range(8)]]


@register("factor_covariance", "a:s b:s cov:f", "fcen", ", " + FSOLVE + " UNION ALL ".join(
    f" SELECT '{x}' AS a, '{y}' AS b, covar_samp({cx}, {cy}) AS cov FROM fret HAVING count(*) >= 60"
    for x, cx in zip(FACTORS, SQL_FACTORS) for y, cy in zip(FACTORS, SQL_FACTORS)))
def factor_covariance(spark, sf):
    return G.factor_covariance(G.factor_returns(factor_rows(spark, sf), LOADINGS, "r"), FACTORS)


@register("idio_variance", "entity:i n:i idio_var:f", "fm fcen", ", " + FSOLVE + f"""
SELECT entity, count(e) AS n, var_samp(e) AS idio_var FROM (SELECT entity, y - market - ({' + '.join(f'c[{i + 1}] * x{i}' for i in range(8))}) AS e FROM fm JOIN fret USING (dt)) GROUP BY 1 HAVING count(e) >= 60""")
def idio_variance(spark, sf):
    rows = factor_rows(spark, sf)
    return G.idio_variance(rows, G.factor_returns(rows, LOADINGS, "r"), LOADINGS, "r")


# --- scoring and training rows ---------------------------------------------------------------

FIT_BEFORE = "2000-05-01"
#: a Monday a month after the fit
DAYS = ["2000-05-08", "2000-06-05", "2000-07-03", "2000-08-07", "2000-09-04", "2000-10-02", "2000-11-06", "2000-12-04"]
SQL_DAYS = ", ".join(f"DATE '{d}'" for d in DAYS)
# The market as one series: its run-length latch forces protection, and the candidates' book against the
# mean book gives the drawdown tiers.
MARKET_STATE = f"""
, mz AS (SELECT 0 AS entity, dt, z, row_number() OVER (ORDER BY dt) AS rn FROM (
  SELECT dt, CASE WHEN count(*) OVER w >= 13 THEN (market_close - avg(market_close) OVER w) / stddev_samp(market_close) OVER w END AS z FROM market
  WINDOW w AS (ORDER BY dt ROWS BETWEEN 26 PRECEDING AND 1 PRECEDING)) WHERE z IS NOT NULL)
{CP_SQL[: CP_SQL.rindex("SELECT entity, dt, z, cc")].replace("zseries", "mz")},
bk AS (SELECT 0 AS entity, m.dt, m.mkt AS close, n.nav FROM (SELECT dt, avg(close) AS mkt FROM smooth GROUP BY dt) m LEFT JOIN (SELECT dt, avg(close) AS nav FROM smooth SEMI JOIN cand USING (entity) GROUP BY dt) n USING (dt))
{TIER_SQL[: TIER_SQL.rindex("SELECT entity, dt, dd AS drawdown")].replace("FROM nav)", "FROM bk)")},
ms AS (SELECT r.dt, r.regime, i.intensity_z, coalesce(l.forced, false) AS forced_bear,
  greatest(CASE t.tier WHEN 'caution' THEN 1 WHEN 'risk_off' THEN 2 ELSE 0 END, CASE t.xt WHEN 'alpha_bleed' THEN 2 ELSE 0 END) AS severity
 FROM (SELECT dt, CASE WHEN m > 0.03 THEN 'bull' WHEN m < -0.03 THEN 'bear' ELSE 'neutral' END AS regime FROM (SELECT dt, market_close / lag(market_close, 4) OVER (ORDER BY dt) - 1 AS m FROM market)) r
 LEFT JOIN (SELECT dt, CASE WHEN pos <= 4 THEN 0 ELSE z END AS intensity_z FROM intens) i USING (dt) LEFT JOIN la l ON l.dt = r.dt LEFT JOIN step t ON t.dt = r.dt)"""


def market_state(spark, sf):
    """(dt, regime, intensity_z, forced_bear, protective_severity) of the market and the candidates' book."""
    w = W.Window.orderBy("dt")
    market = P.market_series(panel(spark, sf))
    rows = market.select("dt", X.classify_regime(F.col("market_close") / F.lag("market_close", 4).over(w) - 1).alias("regime"))
    series = market.select(F.lit(0).alias("entity"), "dt", F.col("market_close").alias("close"))
    latch = S.change_points(zscores(spark, sf, series)).select("dt", F.col("latched").alias("forced_bear"))
    book = smooth(spark, sf)
    nav = book.join(candidates(spark, sf), "entity", "left_semi").groupBy("dt").agg(F.avg("close").alias("nav"))
    line = book.groupBy("dt").agg(F.avg("close").alias("close")).join(nav, "dt", "left").withColumn("entity", F.lit(0))
    tiers = S.drawdown_tiers(line.select("entity", "dt", "close", "nav")).select("dt", "tier", "excess_tier")
    z = W.intensity_series(daily_macro_panel(spark, sf)).select("dt", "intensity_z")
    rows = rows.join(z, "dt", "left").join(latch, "dt", "left").join(tiers, "dt", "left").withColumn("macro_regime", F.col("regime"))
    return X.effective_regime(rows).select("dt", "regime", "intensity_z", "forced_bear", "protective_severity")


@register("market_state", "dt:d regime:s intensity_z:f forced_bear:b protective_severity:i", "market smooth cand intens", MARKET_STATE + " SELECT dt, regime, intensity_z, forced_bear, severity AS protective_severity FROM ms")
def market_state_query(spark, sf):
    return market_state(spark, sf).withColumn("forced_bear", F.coalesce("forced_bear", F.lit(False)))


@register("score_cross_section", "entity:i dt:d source:s predicted_alpha_raw:f predicted_alpha:f p_up:f predicted_direction:s prediction_confidence:f combined_rank:i n_missing:i failed_check:s gate_passed:b veto_threshold:f veto:b", "er mfeat market smooth cand pop intens", f"""
, st AS (SELECT 'all' AS model, {GRAM_SUMS} FROM (SELECT *, 1.0::DOUBLE AS w FROM er WHERE dt < DATE '{FIT_BEFORE}'))
{sql_bayes('st', 'model')}{MARKET_STATE},
un AS (SELECT entity, CASE WHEN entity IN (SELECT entity FROM pop) AND entity IN (SELECT entity FROM cand) THEN 'both' WHEN entity IN (SELECT entity FROM pop) THEN 'population' ELSE 'buy_candidate' END AS source
 FROM (SELECT entity FROM pop UNION SELECT entity FROM cand)),
ft AS (SELECT entity, dt, source, {', '.join(f'coalesce({f}, 0) AS x{i}' for i, f in enumerate(META))} FROM mfeat JOIN un USING (entity) WHERE dt IN ({SQL_DAYS})),
al AS (SELECT e.entity, e.dt, e.source, least({CLIP}, greatest(-{CLIP}, {sql_value()})) AS al FROM ft e, model m),
rk AS (SELECT *, count(*) OVER d AS n, al - avg(al) OVER d AS ce, row_number() OVER (PARTITION BY dt ORDER BY round(al, 10) DESC, entity) AS combined_rank FROM al WINDOW d AS (PARTITION BY dt)),
fin AS (SELECT *, CASE WHEN n >= 2 THEN round(ce, 6) ELSE al END AS pa, CASE WHEN n >= 2 THEN 0.5 + least({CLIP}, greatest(-{CLIP}, round(ce, 10))) / {2 * CLIP}
  ELSE least(1, greatest(0, 0.5 + al / (2 * greatest(abs(al), 0.05)))) END AS p FROM rk),
gt AS (SELECT dt, n, nf, mo, sk, sat, (SELECT count(*) FROM cand) - cov AS n_missing FROM (SELECT dt, count(*) AS n, count(pa) AS nf, greatest(sum((pa > 0)::INT), sum((pa < 0)::INT)) / nullif(sum((pa <> 0)::INT), 0)::DOUBLE AS sk,
   avg((round(p, 4) <= 0.011 OR round(p, 4) >= 0.989)::INT) AS sat, sum((source <> 'population')::INT) AS cov FROM fin GROUP BY dt)
  JOIN (SELECT dt, max(c) / sum(c)::DOUBLE AS mo FROM (SELECT dt, round(pa, 9), count(*) AS c FROM fin GROUP BY 1, 2) GROUP BY 1) USING (dt)),
th AS (SELECT dt, least(greatest(0, least(0.8, 0.3 + CASE WHEN intensity_z IS NOT NULL THEN least(0.2, greatest(-0.2, intensity_z * 0.1)) ELSE CASE regime WHEN 'bear' THEN -0.2 WHEN 'bull' THEN 0.1 ELSE 0 END END)),
  CASE WHEN forced_bear THEN 0.3 - 0.2 ELSE 1 END, CASE WHEN severity >= 2 THEN 0.3 - 0.2 WHEN severity >= 1 THEN 0.3 - 0.1 ELSE 1 END) AS veto_threshold FROM ms)
SELECT f.entity, f.dt, f.source, round(al, 6) AS predicted_alpha_raw, pa AS predicted_alpha, round(p, 4) AS p_up, CASE WHEN round(p, 10) >= 0.5 THEN 'UP' ELSE 'DOWN' END AS predicted_direction,
 round(abs(p - 0.5) * 2, 4) AS prediction_confidence, combined_rank, g.n_missing, fc AS failed_check, fc IS NULL AS gate_passed, t.veto_threshold,
 pa < 0 AND combined_rank > f.n / 2.0 AND round(abs(p - 0.5) * 2, 4) >= t.veto_threshold AS veto
FROM fin f JOIN (SELECT *, CASE WHEN n < 5 THEN NULL WHEN nf >= 5 AND mo >= 0.9 THEN 'alpha_collapse' WHEN nf >= 5 AND sk >= 0.97 THEN 'alpha_sign_skew' WHEN n >= 5 AND sat > 0.25 THEN 'saturation_rate' END AS fc FROM gt) g USING (dt) JOIN th t USING (dt)""")
def score_cross_section(spark, sf):
    staged = staged_panel(spark, sf)
    outcome = W.forward_return(staged[1], 4).select("entity", "dt", "fwd_ret")
    rows = cut_lineage(meta_inputs(spark, sf, staged).join(outcome, ["entity", "dt"], "left"))
    fitted = G.fit_bayes_ridge(rows.where(F.col("dt") < FIT_BEFORE), META, "fwd_ret")
    who = J.universe_with_source(population(spark, sf), candidates(spark, sf))
    return PL.score_cross_section(
        rows, DAYS, fitted, META, CLIP, universe=who, macro=market_state(spark, sf), continuous=True,
        forced_enabled=True, drawdown_enabled=True, group_bound=bound(spark, sf))


@register("score_versions", "version_id:i entity:i dt:d predicted_alpha:f p_up:f predicted_direction:s", "er egram mfeat", f"""
{sql_bayes('egram', 'fold_id')},
f AS (SELECT * FROM (SELECT entity, dt, {XS} FROM mfeat) WHERE {' AND '.join(f'x{i} IS NOT NULL' for i in range(K))}),
a AS (SELECT fold_id AS version_id, e.entity, e.dt, least({CLIP}, greatest(-{CLIP}, {sql_value()})) AS predicted_alpha FROM f e, model m)
SELECT *, round(0.5 + predicted_alpha / {2 * CLIP}, 4) AS p_up, CASE WHEN round(0.5 + predicted_alpha / {2 * CLIP}, 10) >= 0.5 THEN 'UP' ELSE 'DOWN' END AS predicted_direction FROM a""")
def score_versions(spark, sf):
    """Each fold's model as a registered version, all scored on the same rows at once."""
    staged = staged_panel(spark, sf)
    known = meta_rows(spark, sf, staged)
    grams = G.fold_gram(G.gram_table(known, META, "fwd_ret", ["dt"]), FD.expanding_folds(known, 4), K, ["fold_id"])
    fitted = G.solve_rows(grams, ["fold_id"], K).withColumnRenamed("fold_id", "version_id")
    rows = meta_inputs(spark, sf, staged).dropna(subset=META)
    return M.score_versions(rows.select("entity", "dt", *META), fitted, META, CLIP)


@register("build_oos_rows", "entity:i dt:d fold_id:i momentum_score:f residual_momentum_score:f research_composite_score:f market_breadth:f fwd_4:f fwd_8:f canonical_alpha:f tb_alpha:f tb_touch:f", "momsc residsc eidx snapjoin breadth hcrow basket walk", f"""
, k AS (SELECT CAST(k AS INTEGER) AS k, 104 + CAST(k AS INTEGER) * 26 AS s FROM range(100) r(k) WHERE 104 + k * 26 < (SELECT max(n) FROM eidx) AND (SELECT max(n) FROM eidx) - (104 + k * 26) >= 13),
ft AS (SELECT k AS fold_id, dt FROM eidx, k WHERE idx BETWEEN s AND s + 25)
SELECT m.entity, m.dt, ft.fold_id, m.momentum_score, r.residual_momentum_score, a.score / 100 AS research_composite_score, b.market_breadth, h.fwd_4, h.fwd_8, fl.log_fwd - bk.basket AS canonical_alpha,
 CASE WHEN w.steps = 8 AND w.sigma IS NOT NULL THEN CASE w.hit WHEN 1 THEN 1.5 * w.sigma WHEN -1 THEN -1.5 * w.sigma ELSE w.cum END END AS tb_alpha,
 CASE WHEN w.steps = 8 AND w.sigma IS NOT NULL THEN CASE w.hit WHEN 1 THEN 1.0 WHEN -1 THEN 0.0 END END AS tb_touch
FROM momsc m JOIN ft USING (dt) JOIN residsc r USING (entity, dt) JOIN snapjoin a ON a.entity = m.entity AND a.dt = m.dt AND a.score IS NOT NULL LEFT JOIN breadth b ON b.dt = m.dt
JOIN hcrow h ON h.entity = m.entity AND h.dt = m.dt AND h.fwd_4 IS NOT NULL LEFT JOIN cohorts c ON c.entity = m.entity AND c.dt = m.dt LEFT JOIN fwdlog fl ON fl.entity = m.entity AND fl.dt = m.dt
LEFT JOIN basket bk ON bk.dt = m.dt AND bk.cohort = c.cohort LEFT JOIN walk w ON w.entity = m.entity AND w.dt = m.dt""")
def build_oos_rows(spark, sf):
    prices, base = staged = staged_panel(spark, sf)
    feats = features(spark, sf, base).withColumn("momentum_score", X.momentum_score("mom_1", "mom_4", "vs_ma10", "rsi"))
    feats = feats.join(residual_score(spark, sf, base).select("entity", "dt", "residual_momentum_score"), ["entity", "dt"])
    touch = L.triple_barrier_alpha(barriers(spark, sf, base), "resid", 8, "barrier")
    touch = L.triple_barrier_touch(touch, "resid", 8, "barrier").select("entity", "dt", "tb_alpha", "tb_touch")
    labels = W.multi_horizon_returns(base, [4, 8]).select("entity", "dt", "fwd_4", "fwd_8")
    alpha = L.canonical_alpha(base.drop("bench"), 4, 8, 52, 5, bound(spark, sf)).select("entity", "dt", "canonical_alpha")
    labels = labels.join(alpha, ["entity", "dt"], "left").join(touch, ["entity", "dt"], "left")
    snaps = asof_rows(spark, sf, base).where("score IS NOT NULL").select("entity", "dt", (F.col("score") / 100).alias("research_composite_score"))
    folds = FD.walk_forward_folds(meta_rows(spark, sf, staged), 26, 104, 4)
    breadth = cut_lineage(weekly_breadth(spark, sf, prices))  # a row per week
    return PL.build_oos_rows(feats, labels, cut_lineage(folds), snaps, breadth, ["momentum_score", "residual_momentum_score"],
                             ["fwd_4", "fwd_8", "canonical_alpha", "tb_alpha", "tb_touch"])
