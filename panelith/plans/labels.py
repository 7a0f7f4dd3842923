"""Queries over labels, cohorts, drawdown states and change points."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelith.operators import labels as L
from panelith.operators import states as S
from panelith.operators import windows as W
from panelith.plans.base import aligned, panel
from panelith.plans.registry import cte, register
from panelith.sources import panel as P

FORWARD = 8

cte("resid", "aligned", """
SELECT *, ln(close / lag(close) OVER w) - ln(bench / lag(bench) OVER w) AS resid, row_number() OVER w AS rn
FROM aligned WINDOW w AS (PARTITION BY entity ORDER BY dt)""")
cte("sig", "resid", """
SELECT r.entity, r.dt, r.rn, r.resid, s.sigma FROM resid r LEFT JOIN (
  SELECT entity, rn, CASE WHEN n >= 10 THEN sqrt((sxx / sw - (sx / sw) * (sx / sw)) * sw * sw / (sw * sw - sww)) END AS sigma FROM (
    SELECT i.entity, i.rn, count(*) AS n, sum(pow(19/21.0::DOUBLE, i.rn - j.rn)) AS sw,
      sum(pow(19/21.0::DOUBLE, i.rn - j.rn) * j.resid) AS sx, sum(pow(19/21.0::DOUBLE, i.rn - j.rn) * j.resid * j.resid) AS sxx,
      sum(pow(19/21.0::DOUBLE, 2 * (i.rn - j.rn))) AS sww
    FROM resid i JOIN resid j ON i.entity = j.entity AND j.rn <= i.rn AND j.resid IS NOT NULL GROUP BY 1, 2)) s USING (entity, rn)""")


def sql_walk(up: str, down: str) -> str:
    """SQL text: running sums ahead of each row and the first one beyond a barrier."""
    return f"""
SELECT entity, dt, sigma, count(*) FILTER (WHERE ahead) AS steps, arg_max(cum, j) AS cum,
  arg_min(CASE WHEN cum >= {up} THEN 1 ELSE -1 END, j) FILTER (WHERE cum >= {up} OR cum <= -({down})) AS hit
FROM (SELECT a.entity, a.dt, a.sigma, b.rn - a.rn AS j, b.rn IS NOT NULL AS ahead,
    sum(coalesce(b.resid, 0)) OVER (PARTITION BY a.entity, a.rn ORDER BY b.rn) AS cum
  FROM sig a LEFT JOIN sig b ON a.entity = b.entity AND b.rn BETWEEN a.rn + 1 AND a.rn + {FORWARD})
GROUP BY entity, dt, sigma"""


cte("walk", "sig", sql_walk("1.5 * sigma", "1.5 * sigma"))
cte("walkfix", "sig", sql_walk("0.5", "0.5"))


def barriers(spark, sf, base=None):
    return L.vol_scaled_barriers(aligned(spark, sf) if base is None else base, 1.5, 20, 10)


@register("ewm_std", "entity:i dt:d resid:f sigma:f", "sig", "SELECT * FROM sig")
def ewm_std(spark, sf):
    return barriers(spark, sf)


@register("triple_barrier_class", "entity:i dt:d tb_class:i", "walkfix", f"""
SELECT entity, dt, CASE WHEN steps < {FORWARD} THEN -1 WHEN hit = 1 OR (hit IS NULL AND cum > 0.25) THEN 2
  WHEN hit = -1 OR (hit IS NULL AND cum < -0.25) THEN 0 ELSE 1 END AS tb_class FROM walkfix""")
def triple_barrier_class(spark, sf):
    rows = L.residual_log_return(aligned(spark, sf))
    return L.triple_barrier_class(rows, "resid", FORWARD, 0.5, 0.5)


@register("triple_barrier_alpha", "entity:i dt:d tb_alpha:f", "walk", f"""
SELECT entity, dt, CASE WHEN steps = {FORWARD} AND sigma IS NOT NULL THEN
  CASE hit WHEN 1 THEN 1.5 * sigma WHEN -1 THEN -1.5 * sigma ELSE cum END END AS tb_alpha FROM walk""")
def triple_barrier_alpha(spark, sf):
    return L.triple_barrier_alpha(barriers(spark, sf), "resid", FORWARD, "barrier")


@register("triple_barrier_touch", "entity:i dt:d tb_touch:f tb_sign:f", "walk", f"""
SELECT entity, dt, CASE WHEN steps = {FORWARD} AND sigma IS NOT NULL THEN CASE hit WHEN 1 THEN 1.0 WHEN -1 THEN 0.0 END END AS tb_touch,
 CASE WHEN steps = {FORWARD} AND sigma IS NOT NULL THEN CASE hit WHEN 1 THEN 1.0 WHEN -1 THEN 0.0 ELSE CASE WHEN cum > 0 THEN 1.0 ELSE 0.0 END END END AS tb_sign FROM walk""")
def triple_barrier_touch(spark, sf):
    rows = L.triple_barrier_touch(barriers(spark, sf), "resid", FORWARD, "barrier")
    return L.triple_barrier_touch(rows, "resid", FORWARD, "barrier", "sign", "tb_sign")


cte("winlab", "panel", "SELECT entity, dt, date_diff('day', DATE '1990-01-01', dt) AS start, 21 AS length FROM panel")


@register("uniqueness_weights", "entity:i dt:d weight:f", "winlab", """
, cells AS (SELECT entity, dt, start, unnest(generate_series(start, start + 20)) AS t FROM winlab),
conc AS (SELECT entity, t, count(*) AS c FROM cells GROUP BY 1, 2)
SELECT entity, dt, avg(1.0::DOUBLE / c) AS weight FROM cells JOIN conc USING (entity, t) GROUP BY 1, 2""")
def uniqueness_weights(spark, sf):
    return L.uniqueness_weights(window_labels(spark, sf), group=["entity"])


@register("uniqueness_weights_shared", "entity:i dt:d weight:f", "winlab", """
, cells AS (SELECT start, unnest(generate_series(start, start + 20)) AS t, count(*) AS n FROM winlab GROUP BY start),
conc AS (SELECT t, sum(n) AS c FROM cells GROUP BY 1)
SELECT entity, dt, w AS weight FROM winlab JOIN (SELECT start, avg(1.0::DOUBLE / c) AS w FROM cells JOIN conc USING (t) GROUP BY 1) USING (start)""")
def uniqueness_weights_shared(spark, sf):
    return L.uniqueness_weights(window_labels(spark, sf))


def window_labels(spark, sf):
    return panel(spark, sf).select(
        "entity", "dt", F.datediff("dt", F.lit("1990-01-01").cast("date")).alias("start"), F.lit(21).alias("length"))


cte("cohorts", "vol", """
SELECT entity, dt, close, realized_vol, CASE WHEN n > 1 THEN greatest(ceil(round((r - 1) * 5.0::DOUBLE / (n - 1), 9)), 1) - 1 END AS cohort FROM (
  SELECT *, row_number() OVER (PARTITION BY dt ORDER BY round(realized_vol, 10), entity) AS r, count(*) OVER (PARTITION BY dt) AS n
  FROM vol WHERE realized_vol IS NOT NULL)""")
cte("fwdlog", "panel", "SELECT entity, dt, ln(lead(close, 4) OVER (PARTITION BY entity ORDER BY dt) / close) AS log_fwd FROM panel")
cte("basket", "cohorts fwdlog", """
SELECT dt, cohort, CASE WHEN count(*) >= 2 THEN avg(log_fwd) END AS basket, count(*) AS members
FROM cohorts JOIN fwdlog USING (entity, dt) WHERE cohort IS NOT NULL GROUP BY 1, 2""")


def cohort_rows(spark, sf):
    rows = W.realized_vol(panel(spark, sf), 8, 52)
    rows = rows.withColumn("log_fwd", F.ln(F.lead("close", 4).over(W.by_entity()) / F.col("close")))
    return W.vol_cohort(rows, 5, P.entity_bound(spark, sf))


@register("vol_cohort", "entity:i dt:d realized_vol:f cohort:i", "cohorts", "SELECT * FROM cohorts")
def vol_cohort(spark, sf):
    return W.vol_cohort(W.realized_vol(panel(spark, sf), 8, 52), 5, P.entity_bound(spark, sf))


@register("vol_cohort_unbounded", "entity:i dt:d realized_vol:f cohort:i", "cohorts", "SELECT * FROM cohorts")
def vol_cohort_unbounded(spark, sf):
    return W.vol_cohort(W.realized_vol(panel(spark, sf), 8, 52), 5, None)


@register("cohort_basket", "dt:d cohort:i basket:f members:i", "basket", "SELECT * FROM basket")
def cohort_basket(spark, sf):
    return L.cohort_basket(cohort_rows(spark, sf), 4)


@register("canonical_alpha", "entity:i dt:d cohort:i canonical_alpha:f", "basket", """
SELECT c.entity, c.dt, c.cohort, f.log_fwd - b.basket AS canonical_alpha
FROM cohorts c JOIN fwdlog f USING (entity, dt) LEFT JOIN basket b ON b.dt = c.dt AND b.cohort = c.cohort""")
def canonical_alpha(spark, sf):
    return L.canonical_alpha(panel(spark, sf), 4, 8, 52, 5, P.entity_bound(spark, sf))


@register("label_distribution", "n:i share_up:f share_down:f mean:f std:f", "fwd", """
SELECT count(*) AS n, avg(CASE WHEN round(fwd_ret, 10) >= 0 THEN 1.0 ELSE 0.0 END) AS share_up,
 avg(CASE WHEN round(fwd_ret, 10) < 0 THEN 1.0 ELSE 0.0 END) AS share_down, avg(fwd_ret) AS mean, stddev_samp(fwd_ret) AS std FROM fwd""")
def label_distribution(spark, sf):
    return L.label_distribution(W.forward_return(aligned(spark, sf), 4))


# --- states ----------------------------------------------------------------------------------

# The weekly prices are far noisier than an index, so stretches are read off a 13-week mean.
cte("smooth", "panel", """
SELECT * FROM (SELECT entity, dt, CASE WHEN count(*) OVER w = 13 THEN avg(close) OVER w END AS close, close AS spot
 FROM panel WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)) WHERE close IS NOT NULL""")


def smooth(spark, sf):
    w = W.by_entity().rowsBetween(-12, 0)
    rows = panel(spark, sf).select(
        "entity", "dt", W.full_frame(F.col("close"), F.avg("close"), w, 13).alias("m"), F.col("close").alias("spot"))
    return rows.where("m IS NOT NULL").withColumnRenamed("m", "close")


cte("ddrow", "smooth", """
SELECT *, round(close / max(close) OVER (PARTITION BY entity ORDER BY dt) - 1, 12) AS dd FROM smooth""")
cte("ddstate", "ddrow", """
SELECT *, coalesce(last_value(CASE WHEN dd <= -0.1 THEN 1 WHEN dd >= -0.05 THEN 0 END IGNORE NULLS)
  OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING), 0) AS s FROM ddrow""")
cte("stretches", "ddstate", """
SELECT entity, min(dt) AS start_dt, coalesce(min(CASE WHEN s = 0 THEN dt END), max(last_dt)) AS end_dt FROM (
  SELECT *, sum(b) OVER (PARTITION BY entity ORDER BY dt ROWS UNBOUNDED PRECEDING) AS id, max(dt) OVER (PARTITION BY entity) AS last_dt FROM (
    SELECT *, CASE WHEN s = 1 AND coalesce(lag(s) OVER (PARTITION BY entity ORDER BY dt), 0) = 0 THEN 1 ELSE 0 END AS b FROM ddstate))
WHERE id > 0 GROUP BY entity, id""")


@register("drawdown_stretches", "entity:i start_dt:d end_dt:d", "stretches", "SELECT * FROM stretches")
def drawdown_stretches(spark, sf):
    return S.drawdown_stretches(smooth(spark, sf))


cte("nav", "smooth panel", """
SELECT s.entity, s.dt, m.mkt AS close, s.close AS nav FROM smooth s JOIN (
  SELECT dt, avg(close) AS mkt FROM smooth GROUP BY dt) m USING (dt)""")


def nav_rows(spark, sf):
    """Each entity as a book against the mean book of the date."""
    book = smooth(spark, sf)
    market = book.groupBy("dt").agg(F.avg("close").alias("mkt"))
    return book.withColumnRenamed("close", "nav").join(market, "dt").select(
        "entity", "dt", F.col("mkt").alias("close"), "nav")


TIER_SQL = """
, d AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) AS rn,
    close / max(close) OVER (PARTITION BY entity ORDER BY dt) - 1 AS dd, nav / max(nav) OVER (PARTITION BY entity ORDER BY dt) - 1 AS ndd FROM nav),
step AS (
  SELECT entity, dt, rn, dd, greatest(dd - ndd, 0) AS ex, CASE WHEN round(-dd, 12) >= 0.1 THEN 'risk_off' WHEN round(-dd, 12) >= 0.05 THEN 'caution' ELSE 'risk_on' END AS tier,
    CASE WHEN round(greatest(dd - ndd, 0), 12) >= 0.05 THEN 'alpha_bleed' ELSE 'risk_on' END AS xt FROM d WHERE rn = 1
  UNION ALL
  SELECT d.entity, d.dt, d.rn, d.dd, greatest(d.dd - d.ndd, 0),
    CASE s.tier WHEN 'risk_off' THEN CASE WHEN round(-d.dd, 12) <= 0.07 THEN CASE WHEN round(-d.dd, 12) <= 0.03 THEN 'risk_on' ELSE 'caution' END ELSE 'risk_off' END
      WHEN 'caution' THEN CASE WHEN round(-d.dd, 12) >= 0.1 THEN 'risk_off' WHEN round(-d.dd, 12) <= 0.03 THEN 'risk_on' ELSE 'caution' END
      ELSE CASE WHEN round(-d.dd, 12) >= 0.1 THEN 'risk_off' WHEN round(-d.dd, 12) >= 0.05 THEN 'caution' ELSE 'risk_on' END END,
    CASE s.xt WHEN 'alpha_bleed' THEN CASE WHEN round(greatest(d.dd - d.ndd, 0), 12) <= 0.02 THEN 'risk_on' ELSE 'alpha_bleed' END
      ELSE CASE WHEN round(greatest(d.dd - d.ndd, 0), 12) >= 0.05 THEN 'alpha_bleed' ELSE 'risk_on' END END
  FROM step s JOIN d ON d.entity = s.entity AND d.rn = s.rn + 1)
SELECT entity, dt, dd AS drawdown, tier, ex AS excess, xt AS excess_tier FROM step"""


@register("drawdown_tiers", "entity:i dt:d drawdown:f tier:s excess:f excess_tier:s", "nav", TIER_SQL)
def drawdown_tiers(spark, sf):
    return S.drawdown_tiers(nav_rows(spark, sf))


# The same with a gate of two observations: tp and xp are the tiers that wait for a second proposal.
GATED_SQL = """
, d AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) AS rn, round(-dd, 12) AS depth, round(ex, 12) AS lv FROM (
  SELECT *, greatest(dd - ndd, 0) AS ex FROM (SELECT *, close / max(close) OVER (PARTITION BY entity ORDER BY dt) - 1 AS dd, nav / max(nav) OVER (PARTITION BY entity ORDER BY dt) - 1 AS ndd FROM nav))),
step AS (
  SELECT entity, 0::BIGINT AS rn, NULL::DATE AS dt, NULL::DOUBLE AS dd, NULL::DOUBLE AS ex, 'risk_on' AS tier, NULL::VARCHAR AS tp, 'risk_on' AS xt, NULL::VARCHAR AS xp FROM (SELECT DISTINCT entity FROM d)
  UNION ALL
  SELECT entity, rn, dt, dd, ex, CASE WHEN pt = tier OR tp = pt THEN pt ELSE tier END, CASE WHEN pt = tier OR tp = pt THEN NULL ELSE pt END,
    CASE WHEN px = xt OR xp = px THEN px ELSE xt END, CASE WHEN px = xt OR xp = px THEN NULL ELSE px END FROM (
   SELECT d.entity, d.rn, d.dt, d.dd, d.ex, s.tier, s.tp, s.xt, s.xp,
    CASE WHEN depth >= 0.1 THEN 'risk_off' WHEN depth <= 0.03 THEN 'risk_on' WHEN s.tier = 'risk_off' THEN CASE WHEN depth <= 0.07 THEN 'caution' ELSE 'risk_off' END
     WHEN s.tier = 'risk_on' THEN CASE WHEN depth >= 0.05 THEN 'caution' ELSE 'risk_on' END ELSE 'caution' END AS pt,
    CASE WHEN s.xt = 'alpha_bleed' THEN CASE WHEN lv <= 0.02 THEN 'risk_on' ELSE s.xt END WHEN lv >= 0.05 THEN 'alpha_bleed' ELSE s.xt END AS px
   FROM step s JOIN d ON d.entity = s.entity AND d.rn = s.rn + 1))
SELECT entity, dt, dd AS drawdown, tier, ex AS excess, xt AS excess_tier FROM step WHERE rn > 0"""


@register("drawdown_tiers_gated", "entity:i dt:d drawdown:f tier:s excess:f excess_tier:s", "nav", GATED_SQL)
def drawdown_tiers_gated(spark, sf):
    """The ladder with a two-observation persistence gate."""
    return S.drawdown_tiers(nav_rows(spark, sf), S.DrawdownBands(min_persist=2))


cte("flagrow", "feat", "SELECT entity, dt, mom_4 < -0.05 AS weak FROM feat WHERE mom_4 IS NOT NULL")


def flag_rows(spark, sf):
    from panelith.plans.base import features
    return features(spark, sf).where("mom_4 IS NOT NULL").select("entity", "dt", (F.col("mom_4") < -0.05).alias("weak"))


cte("eps", "flagrow", """
SELECT entity, min(dt) AS start_dt, max(dt) AS end_dt, count(*) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) - row_number() OVER (PARTITION BY entity, weak ORDER BY dt) AS g FROM flagrow)
WHERE weak GROUP BY entity, g""")


@register("episodes", "entity:i start_dt:d end_dt:d n_rows:i", "eps", "SELECT * FROM eps")
def episodes(spark, sf):
    return S.episodes(flag_rows(spark, sf), "weak")


@register("episode_stats", "entity:i n_days:i n_on:i n_episodes:i mean_dwell:f share_short:f toggles_per_year:f", "eps", """
SELECT r.entity, r.n_days, r.n_on, coalesce(e.n, 0) AS n_episodes, coalesce(e.d, 0) AS mean_dwell, coalesce(e.s, 0) AS share_short,
  coalesce(e.n, 0) / greatest(r.n_days / 52.0::DOUBLE, 1e-9) AS toggles_per_year
FROM (SELECT entity, count(*) AS n_days, sum(CASE WHEN weak THEN 1 ELSE 0 END) AS n_on FROM flagrow GROUP BY 1) r
LEFT JOIN (SELECT entity, count(*) AS n, avg(date_diff('day', start_dt, end_dt) * (52.0::DOUBLE / 365)) AS d,
   avg(CASE WHEN date_diff('day', start_dt, end_dt) * (52.0::DOUBLE / 365) < 4 THEN 1.0 ELSE 0.0 END) AS s FROM eps GROUP BY 1) e USING (entity)""")
def episode_stats(spark, sf):
    return S.episode_stats(flag_rows(spark, sf), "weak", periods=52.0)


@register("state_run_length", "entity:i dt:d weak:b run_length:i", "flagrow", """
SELECT entity, dt, weak, row_number() OVER (PARTITION BY entity, weak, g ORDER BY dt) AS run_length FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dt) - row_number() OVER (PARTITION BY entity, weak ORDER BY dt) AS g FROM flagrow)""")
def state_run_length(spark, sf):
    return S.state_run_length(flag_rows(spark, sf), "weak")


# Payments: the mean taxed unit price per entity and quarter, ex on the quarter's first day.
cte("divs", "", """
SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS ex_dt, sum(l_extendedprice * l_tax) / sum(l_quantity) AS amount
FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2""")


@register("adjust_dividends", "entity:i dt:d close:f adj_close:f", "panel divs", """
, f AS (SELECT d.entity, d.ex_dt, 1 - d.amount / p.close AS ratio FROM divs d ASOF JOIN panel p ON p.entity = d.entity AND p.dt < d.ex_dt
  JOIN (SELECT entity, max(dt) AS last_dt FROM panel GROUP BY 1) l ON l.entity = d.entity AND d.ex_dt <= l.last_dt
  WHERE 1 - d.amount / p.close > 0 AND 1 - d.amount / p.close <= 1)
SELECT p.entity, p.dt, p.close, p.close * coalesce((SELECT product(f.ratio) FROM f WHERE f.entity = p.entity AND f.ex_dt > p.dt), 1) AS adj_close FROM panel p""")
def adjust_dividends(spark, sf):
    lines = P.table(spark, sf, "lineitem").where("l_quantity > 0")
    quarter = F.to_date(F.date_trunc("quarter", F.col("l_shipdate")))
    pay = lines.groupBy(F.col("l_suppkey").alias("entity"), quarter.alias("ex_dt")).agg(
        (F.sum(F.col("l_extendedprice") * F.col("l_tax")) / F.sum("l_quantity")).alias("amount"))
    return S.adjust_dividends(panel(spark, sf), pay)


def zscores(spark, sf, rows=None):
    """Trailing half-year z of each entity's price."""
    w = W.by_entity().rowsBetween(-26, -1)
    rows = panel(spark, sf) if rows is None else rows
    z = (F.col("close") - F.avg("close").over(w)) / F.stddev_samp("close").over(w)
    return rows.select("entity", "dt", F.when(F.count("close").over(w) >= 13, z).alias("z")).where("z IS NOT NULL")


cte("zseries", "panel", """
SELECT entity, dt, z, row_number() OVER (PARTITION BY entity ORDER BY dt) AS rn FROM (
  SELECT entity, dt, CASE WHEN count(*) OVER w >= 13 THEN (close - avg(close) OVER w) / stddev_samp(close) OVER w END AS z FROM panel
  WINDOW w AS (PARTITION BY entity ORDER BY dt ROWS BETWEEN 26 PRECEDING AND 1 PRECEDING)) WHERE z IS NOT NULL""")
# The run-length posterior as a recursion over lists: slot k has kappa 1 + k and shape 1 + k / 2.
CP_SQL = """
, cp AS (
  SELECT entity, 0::BIGINT AS rn, NULL::DATE AS dt, NULL::DOUBLE AS z, [1.0::DOUBLE] AS p, [0.0::DOUBLE] AS mu, [1.0::DOUBLE] AS be FROM (SELECT DISTINCT entity FROM zseries)
  UNION ALL
  SELECT entity, rn, dt, z, list_transform(raw, lambda v: v / list_sum(raw)) AS p, mu, be FROM (
    SELECT entity, rn, dt, z, list_concat([0.002::DOUBLE * list_sum(jo)], list_transform(jo, lambda v: 0.998::DOUBLE * v)) AS raw,
      list_concat([0.0::DOUBLE], list_transform(mu, lambda m, i: (i * m + z) / (i + 1))) AS mu,
      list_concat([1.0::DOUBLE], list_transform(be, lambda b, i: b + i * (z - mu[i]) * (z - mu[i]) / (2.0::DOUBLE * (i + 1)))) AS be FROM (
      SELECT c.entity, o.rn, o.dt, o.z, c.mu, c.be, list_transform(c.p, lambda q, i:
        q * exp(lgamma(1 + (i - 1) / 2.0::DOUBLE + 0.5) - lgamma(1 + (i - 1) / 2.0::DOUBLE) - 0.5 * ln(2 * (1 + (i - 1) / 2.0::DOUBLE) * pi())
          - (1 + (i - 1) / 2.0::DOUBLE + 0.5) * ln(1 + (o.z - c.mu[i]) * (o.z - c.mu[i]) / (c.be[i] * (i + 1) / ((1 + (i - 1) / 2.0::DOUBLE) * i)) / (2 * (1 + (i - 1) / 2.0::DOUBLE))))
          / sqrt(c.be[i] * (i + 1) / ((1 + (i - 1) / 2.0::DOUBLE) * i))) AS jo
      FROM cp c JOIN zseries o ON o.entity = c.entity AND o.rn = c.rn + 1))),
sm AS (SELECT entity, rn, dt, z, list_sum(p[1:5]) AS cc, list_max(p) AS mp FROM cp WHERE rn > 0),
la AS (
  SELECT entity, rn, dt, z, cc, mp, false AS forced, CASE WHEN cc > 0.5 AND z < -1 THEN 1 ELSE 0 END AS ch, CASE WHEN cc > 0.5 AND z < -1 THEN 0 ELSE 1 END AS cl FROM sm WHERE rn = 1
  UNION ALL
  SELECT entity, rn, dt, z, cc, mp, CASE WHEN rn < 5 THEN false WHEN NOT forced AND ch >= 2 THEN true WHEN forced AND cl >= 4 AND z > -0.3 THEN false ELSE forced END, ch, cl FROM (
    SELECT s.*, l.forced, CASE WHEN s.cc > 0.5 AND s.z < -1 THEN l.ch + 1 ELSE 0 END AS ch, CASE WHEN s.cc > 0.5 AND s.z < -1 THEN 0 ELSE l.cl + 1 END AS cl
    FROM la l JOIN sm s ON s.entity = l.entity AND s.rn = l.rn + 1))
SELECT entity, dt, z, cc AS change_confidence, mp AS max_run_prob, cc > 0.5 AS change_signal, forced AS latched FROM la"""


@register("change_points", "entity:i dt:d z:f change_confidence:f max_run_prob:f change_signal:b latched:b", "zseries", CP_SQL)
def change_points(spark, sf):
    return S.change_points(zscores(spark, sf))


CP_GRID = CP_SQL[: CP_SQL.index("sm AS (")].replace("SELECT entity, 0::BIGINT AS rn", "SELECT entity, hazard, 0::BIGINT AS rn").replace(
    "FROM (SELECT DISTINCT entity FROM zseries)", f"FROM (SELECT DISTINCT entity FROM zseries), (SELECT unnest([{', '.join(f'{h!r}::DOUBLE' for h in S.HAZARDS)}]) AS hazard)"
).replace("SELECT entity, rn", "SELECT entity, hazard, rn").replace("SELECT c.entity, o.rn", "SELECT c.entity, c.hazard, o.rn").replace(
    "0.002::DOUBLE * list_sum(jo)", "hazard * list_sum(jo)").replace("0.998::DOUBLE * v", "(1 - hazard) * v")
GRID_KEYS = "entity, hazard, min_run"
GRID_SQL = CP_GRID + f"""lg AS (SELECT entity, hazard, CAST(m AS INTEGER) AS min_run, rn, dt, z, list_sum(p[1:m]) AS cc FROM cp, (VALUES {', '.join(f'({m})' for m in S.MIN_RUNS)}) v(m) WHERE rn > 0),
la AS (
  SELECT {GRID_KEYS}, rn, dt, false AS forced, CASE WHEN cc > 0.5 AND z < -1 THEN 1 ELSE 0 END AS ch, CASE WHEN cc > 0.5 AND z < -1 THEN 0 ELSE 1 END AS cl FROM lg WHERE rn = 1
  UNION ALL
  SELECT {GRID_KEYS}, rn, dt, CASE WHEN rn < min_run THEN false WHEN NOT forced AND ch >= 2 THEN true WHEN forced AND cl >= 4 AND z > -0.3 THEN false ELSE forced END, ch, cl FROM (
    SELECT s.*, l.forced, CASE WHEN s.cc > 0.5 AND s.z < -1 THEN l.ch + 1 ELSE 0 END AS ch, CASE WHEN s.cc > 0.5 AND s.z < -1 THEN 0 ELSE l.cl + 1 END AS cl
    FROM la l JOIN lg s ON s.entity = l.entity AND s.hazard = l.hazard AND s.min_run = l.min_run AND s.rn = l.rn + 1)),
ge AS (SELECT {GRID_KEYS}, min(dt) AS start_dt, max(dt) AS end_dt FROM (
  SELECT *, rn - row_number() OVER (PARTITION BY {GRID_KEYS}, forced ORDER BY dt) AS g FROM la) WHERE forced GROUP BY {GRID_KEYS}, g),
gs AS (SELECT {GRID_KEYS}, count(*) AS n, avg(date_diff('day', start_dt, end_dt) * (52.0::DOUBLE / 365)) AS d, avg(CASE WHEN date_diff('day', start_dt, end_dt) * (52.0::DOUBLE / 365) < 4 THEN 1.0 ELSE 0.0 END) AS s,
  avg(CASE WHEN EXISTS (SELECT 1 FROM stretches x WHERE x.entity = ge.entity AND ge.start_dt <= x.end_dt AND x.start_dt <= ge.end_dt) THEN 0.0 ELSE 1.0 END) AS fpr FROM ge GROUP BY {GRID_KEYS}),
gl AS (SELECT {GRID_KEYS}, median(d * (52.0::DOUBLE / 365)) AS median_lead FROM (
  SELECT {', '.join('e.' + k for k in GRID_KEYS.split(', '))}, s.start_dt, arg_min(date_diff('day', e.start_dt, s.start_dt), abs(date_diff('day', e.start_dt, s.start_dt)) * 1000000 + date_diff('day', DATE '1970-01-01', e.start_dt)) AS d
  FROM stretches s JOIN ge e ON e.entity = s.entity AND date_diff('day', e.start_dt, s.start_dt) BETWEEN -31 AND 90 GROUP BY 1, 2, 3, 4) GROUP BY {GRID_KEYS})
SELECT {GRID_KEYS}, r.n_days, r.n_on, coalesce(n, 0) AS n_episodes, coalesce(d, 0) AS mean_dwell, coalesce(s, 0) AS share_short, coalesce(n, 0) / greatest(r.n_days / 52.0::DOUBLE, 1e-9) AS toggles_per_year,
  median_lead, coalesce(fpr, 0) AS false_positive_rate
FROM (SELECT {GRID_KEYS}, count(*) AS n_days, sum(CASE WHEN forced THEN 1 ELSE 0 END) AS n_on FROM la GROUP BY {GRID_KEYS}) r LEFT JOIN gs USING ({GRID_KEYS}) LEFT JOIN gl USING ({GRID_KEYS})"""


@register("latch_grid", "entity:i hazard:f min_run:i n_days:i n_on:i n_episodes:i mean_dwell:f share_short:f toggles_per_year:f median_lead:f false_positive_rate:f", "zseries stretches", GRID_SQL)
def latch_grid(spark, sf):
    """Replay of every grid point on every entity against its own drawdown stretches."""
    return S.latch_grid(zscores(spark, sf), S.drawdown_stretches(smooth(spark, sf)), periods=52.0)


@register("episode_leads", "entity:i median_lead:f false_positive_rate:f", "eps stretches", """
SELECT f.entity, l.median_lead, f.fpr AS false_positive_rate FROM (
  SELECT entity, avg(CASE WHEN EXISTS (SELECT 1 FROM stretches s WHERE s.entity = e.entity AND e.start_dt <= s.end_dt AND s.start_dt <= e.end_dt) THEN 0.0 ELSE 1.0 END) AS fpr
  FROM eps e GROUP BY 1) f
LEFT JOIN (SELECT entity, median(d * (52.0::DOUBLE / 365)) AS median_lead FROM (
  SELECT s.entity, s.start_dt, arg_min(date_diff('day', e.start_dt, s.start_dt), abs(date_diff('day', e.start_dt, s.start_dt)) * 1000000 + date_diff('day', DATE '1970-01-01', e.start_dt)) AS d
  FROM stretches s JOIN eps e ON e.entity = s.entity AND date_diff('day', e.start_dt, s.start_dt) BETWEEN -31 AND 90 GROUP BY 1, 2) GROUP BY 1) l USING (entity)""")
def episode_leads(spark, sf):
    return S.episode_leads(S.episodes(flag_rows(spark, sf), "weak"), S.drawdown_stretches(smooth(spark, sf)), ["entity"], periods=52.0)
