"""Queries over snapshots, outcomes, coverage, upserts, realised returns, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelith.functions import scalars as X
from panelith.functions.columns import by_entity
from panelith.operators import joins as J
from panelith.operators import states as S
from panelith.operators import windows as W
from panelith.plans.base import aligned, features, panel, sql_rank_norm
from panelith.plans.evaluation import sql_ic, versions
from panelith.plans.registry import cte, register
from panelith.plans.scoring import CLIP, predictions
from panelith.session import cut_lineage, scratch_path
from panelith.sources import files as FS
from panelith.sources import panel as P

SQL_TICKER = "'S' || CAST(entity AS VARCHAR)"


def named(rows):
    """Entities as texts."""
    return rows.withColumn("entity", F.concat(F.lit("S"), F.col("entity").cast("string")))


# --- snapshots: quarterly volume percentile as score, its change as conviction, region share as modifier ---

cte("uni", "panel", f"""
SELECT entity, sector, CAST(dt + INTERVAL 3 MONTH AS DATE) AS snapshot_dt, 100 * score AS score,
 CASE WHEN vol > lag(vol) OVER w THEN 'rising' WHEN vol < lag(vol) OVER w THEN 'declining' ELSE 'stable' END AS conviction FROM (
  SELECT entity, sector, dt, vol, {sql_rank_norm('vol', 'score')} FROM (
   SELECT entity, sector, CAST(date_trunc('quarter', dt) AS DATE) AS dt, sum(volume) AS vol FROM panel GROUP BY 1, 2, 3)) WINDOW w AS (PARTITION BY entity ORDER BY dt)""")
cte("modif", "panel", """
SELECT CAST(q + INTERVAL 3 MONTH AS DATE) AS snapshot_dt, sector, v / avg(v) OVER (PARTITION BY q) AS modifier FROM (
 SELECT CAST(date_trunc('quarter', dt) AS DATE) AS q, sector, sum(volume) AS v FROM panel GROUP BY 1, 2)""")


def quarterly(spark, sf, base=None):
    base = panel(spark, sf) if base is None else base
    return base.groupBy("entity", "sector", F.to_date(F.date_trunc("quarter", "dt")).alias("dt")).agg(F.sum("volume").alias("vol"))


def universe(spark, sf, base=None):
    rows = quarterly(spark, sf, base).withColumn("score", F.col("vol"))
    rows = W.rank_normalize(rows, ["score"], P.entity_bound(spark, sf))
    last = F.lag("vol").over(by_entity())
    word = F.when(F.col("vol") > last, "rising").when(F.col("vol") < last, "declining").otherwise("stable")
    return rows.select("entity", "sector", F.add_months("dt", 3).alias("snapshot_dt"), (100 * F.col("score")).alias("score"), word.alias("conviction"))


def modifiers(spark, sf, base=None):
    sums = quarterly(spark, sf, base).groupBy("dt", "sector").agg(F.sum("vol").alias("v"))
    # five sectors per quarter
    share = F.col("v") / F.avg("v").over(W.Window.partitionBy("dt"))
    return sums.select(F.add_months("dt", 3).alias("snapshot_dt"), "sector", share.alias("modifier"))


def regimes(spark, sf):
    """A quarter's word from the whole market's volume against the quarter before."""
    sums = quarterly(spark, sf).groupBy("dt").agg(F.sum("vol").alias("v"))
    last = F.lag("v").over(W.Window.orderBy("dt"))  # a row per quarter
    word = F.when(F.col("v") > last, "bull").when(F.col("v") < last, "bear")
    return sums.select(F.add_months("dt", 3).alias("snapshot_dt"), word.alias("market_regime"))


def snapshots(spark, sf):
    return FS.build_snapshots(universe(spark, sf), modifiers(spark, sf), 64, regimes(spark, sf))


@register("read_snapshots", "snapshot_dt:d entity:i score:f conviction:s sector:s modifier:f", "uni modif", """
SELECT u.snapshot_dt, u.entity, u.score, u.conviction, CAST(u.sector AS VARCHAR) AS sector, m.modifier FROM uni u JOIN modif m USING (snapshot_dt, sector)""")
def read_snapshots(spark, sf):
    """Documents written as JSON and read back; a corrupt file beside them is skipped."""
    path = FS.write_snapshots(snapshots(spark, sf), scratch_path(spark, "snapshots"))
    spark.range(1).select(F.lit("{broken").alias("value")).write.mode("append").text(f"{path}/day=1990-01-01")
    rows = FS.explode_universe(FS.read_snapshots(spark, path))
    return rows.withColumn("modifier", F.try_element_at("sector_modifiers", F.col("sector")))


@register("snapshot_features", "entity:i snapshot_dt:d research_calibrator_prob:f research_composite_score:f research_conviction:f sector_macro_modifier:f", "uni modif", """
SELECT u.entity, u.snapshot_dt, u.score / 100 AS research_calibrator_prob, u.score / 100 AS research_composite_score,
 CASE u.conviction WHEN 'rising' THEN 1.0 WHEN 'declining' THEN -1.0 ELSE 0.0 END AS research_conviction, coalesce(m.modifier, 1) - 1 AS sector_macro_modifier
FROM uni u LEFT JOIN modif m USING (snapshot_dt, sector)""")
def snapshot_features(spark, sf):
    rows = FS.explode_universe(snapshots(spark, sf)).where("score IS NOT NULL")
    return rows.withColumns(X.snapshot_features(F.col("score"), F.col("conviction"), F.col("sector"), F.col("sector_modifiers")))


@register("regime_calls", "dt:d call:s", "uni", """
SELECT * FROM (SELECT snapshot_dt AS dt, CASE WHEN v > lag(v) OVER (ORDER BY snapshot_dt) THEN 'bull' WHEN v < lag(v) OVER (ORDER BY snapshot_dt) THEN 'bear' ELSE 'neutral' END AS call
 FROM (SELECT CAST(CAST(date_trunc('quarter', dt) AS DATE) + INTERVAL 3 MONTH AS DATE) AS snapshot_dt, sum(volume) AS v FROM panel GROUP BY 1)) WHERE dt BETWEEN DATE '2000-06-30' - 364 AND DATE '2000-06-30'""")
def regime_calls(spark, sf):
    return FS.regime_calls(snapshots(spark, sf), "2000-06-30", 52)


cte("snapjoin", "panel uni", """
SELECT p.entity, p.dt, p.close, s.snapshot_dt, u.score, u.conviction FROM panel p
ASOF LEFT JOIN (SELECT DISTINCT snapshot_dt FROM uni) s ON p.dt >= s.snapshot_dt
LEFT JOIN uni u ON u.entity = p.entity AND u.snapshot_dt = s.snapshot_dt""")


def asof_rows(spark, sf, base=None, uni=None):
    base = (panel(spark, sf) if base is None else base).select("entity", "dt", "close")
    uni = (universe(spark, sf) if uni is None else uni).select("entity", "snapshot_dt", "score", "conviction")
    # both sides by entity: joins on (entity, dt) that follow need no further shuffle
    rows = base.repartition("entity").join(J.asof_snapshot(base, uni), "dt", "left")
    return rows.join(uni.repartition("entity"), ["entity", "snapshot_dt"], "left")


@register("asof_snapshot", "entity:i dt:d snapshot_dt:d score:f conviction:s", "snapjoin", "SELECT * FROM snapjoin")
def asof_snapshot(spark, sf):
    return asof_rows(spark, sf)


@register("join_coverage", "reason:s n:i share:f", "snapjoin", """
SELECT reason, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM (
 SELECT CASE WHEN snapshot_dt IS NULL THEN 'no_snapshot' WHEN score IS NULL THEN 'missing' ELSE 'kept' END AS reason FROM snapjoin) GROUP BY 1""")
def join_coverage(spark, sf):
    return J.join_coverage(asof_rows(spark, sf), "snapshot_dt", "score")


@register("snapshot_for_date", "dt:d snapshot_dt:d source:s", "daypanel uni", """
, d AS (SELECT DISTINCT dt FROM daypanel), s AS (SELECT DISTINCT snapshot_dt FROM uni),
t AS (SELECT dt, dt - CAST(k AS INTEGER) AS c, k FROM d, range(8) r(k)),
w AS (SELECT *, sum(CASE WHEN isodow(c) < 6 AND k > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY dt ORDER BY k) AS n FROM t),
h AS (SELECT dt, max(c) AS hit FROM w JOIN s ON s.snapshot_dt = w.c WHERE k = 0 OR (isodow(c) < 6 AND n <= 5) GROUP BY 1)
SELECT d.dt, coalesce(h.hit, (SELECT max(snapshot_dt) FROM s)) AS snapshot_dt, CASE WHEN h.hit = d.dt THEN 'today' WHEN h.hit IS NOT NULL THEN 'recent' ELSE 'latest' END AS source
FROM d LEFT JOIN h USING (dt)""")
def snapshot_for_date(spark, sf):
    days = P.price_panel(spark, sf, "day").select("dt")
    return J.snapshot_for_date(days, universe(spark, sf))


# --- outcomes --------------------------------------------------------------------------------

cte("outc", "uni aligned", """
SELECT u.entity AS symbol, u.snapshot_dt AS score_date, u.score, f.h AS horizon_days, f.beat FROM uni u JOIN (
 SELECT entity, dt, 28 AS h, CASE WHEN lead(close, 4) OVER w IS NOT NULL THEN (round(lead(close, 4) OVER w / close - lead(bench, 4) OVER w / bench, 10) >= 0)::INT END AS beat FROM aligned WINDOW w AS (PARTITION BY entity ORDER BY dt)
 UNION ALL SELECT entity, dt, 56, CASE WHEN lead(close, 8) OVER w IS NOT NULL THEN (round(lead(close, 8) OVER w / close - lead(bench, 8) OVER w / bench, 10) >= 0)::INT END FROM aligned WINDOW w AS (PARTITION BY entity ORDER BY dt)) f
ON f.entity = u.entity AND f.dt = CAST(date_trunc('week', u.snapshot_dt) AS DATE)""")


def score_tables(spark, sf, base=None, uni=None):
    """(scores, outcomes) as two relational tables keyed by symbol and date."""
    uni = (universe(spark, sf) if uni is None else uni).select(F.col("entity").alias("symbol"), F.col("snapshot_dt").alias("score_date"), "score")
    keyed = uni.withColumn("dt", F.to_date(F.date_trunc("week", "score_date")))
    rows = W.multi_horizon_returns(aligned(spark, sf) if base is None else base, [4, 8]).select("entity", "dt", "fwd_4", "fwd_8")
    # the weeks of the snapshots: a few a year
    rows = rows.join(F.broadcast(keyed.select("dt").distinct()), "dt", "left_semi")
    long = rows.unpivot(["entity", "dt"], ["fwd_4", "fwd_8"], "h", "r").select(
        F.col("entity").alias("symbol"), "dt", F.when(F.col("h") == "fwd_4", 28).otherwise(56).alias("horizon_days"),
        (F.round("r", 10) >= 0).cast("int").alias("beat"))
    return uni, keyed.drop("score").join(long, ["symbol", "dt"]).drop("dt")


@register("outcome_join", "symbol:i score_date:d score:f beat:i", "outc", "SELECT * FROM outc WHERE horizon_days = 28 AND beat IS NOT NULL AND score IS NOT NULL")
def outcome_join(spark, sf):
    scores, outcomes = score_tables(spark, sf)
    return J.outcome_join(scores, outcomes, 28)


# --- coverage, provenance, upsert ------------------------------------------------------------

cte("cand", "uni", "SELECT entity FROM uni WHERE snapshot_dt = DATE '2000-01-01' AND score >= 50")
cte("pop", "uni", "SELECT entity FROM uni WHERE snapshot_dt = DATE '1999-10-01' AND score < 75")
cte("predday", "pred", "SELECT * FROM pred WHERE dt = DATE '2000-01-03'")
WEEK = "2000-01-03"


def candidates(spark, sf):
    return universe(spark, sf).where("snapshot_dt = DATE'2000-01-01' AND score >= 50").select("entity")


def population(spark, sf):
    return universe(spark, sf).where("snapshot_dt = DATE'1999-10-01' AND score < 75").select("entity")


def day_predictions(spark, sf, day=WEEK):
    return predictions(spark, sf).where(F.col("dt") == F.lit(day).cast("date"))


@register("coverage_missing", "entity:s", "cand predday", "SELECT CAST(entity AS VARCHAR) AS entity FROM cand WHERE entity NOT IN (SELECT entity FROM predday)")
def coverage_missing(spark, sf):
    return J.coverage_delta(candidates(spark, sf), day_predictions(spark, sf))[0]


@register("coverage_delta", "n_candidates:i n_covered:i n_missing:i n_predictions:i has_gap:b", "cand predday", """
SELECT count(*) AS n_candidates, count(p.entity) AS n_covered, count(*) - count(p.entity) AS n_missing, (SELECT count(*) FROM predday) AS n_predictions, count(*) > count(p.entity) AS has_gap
FROM cand c LEFT JOIN predday p USING (entity)""")
def coverage_delta(spark, sf):
    return J.coverage_delta(candidates(spark, sf), day_predictions(spark, sf))[1]


@register("universe_with_source", "entity:i source:s", "cand pop", """
SELECT entity, CASE WHEN entity IN (SELECT entity FROM pop) AND entity IN (SELECT entity FROM cand) THEN 'both' WHEN entity IN (SELECT entity FROM pop) THEN 'population' ELSE 'buy_candidate' END AS source
FROM (SELECT entity FROM pop UNION SELECT entity FROM cand)""")
def universe_with_source(spark, sf):
    return J.universe_with_source(population(spark, sf), candidates(spark, sf))


@register("upsert_predictions", "dt:d entity:i predicted_alpha:f combined_rank:i", "pred cand", """
SELECT dt, entity, a AS predicted_alpha, row_number() OVER (PARTITION BY dt ORDER BY round(a, 10) DESC, entity) AS combined_rank FROM (
 SELECT dt, entity, CASE WHEN entity IN (SELECT entity FROM cand) THEN -predicted_alpha ELSE predicted_alpha END AS a FROM pred)""")
def upsert_predictions(spark, sf):
    old = predictions(spark, sf).select("dt", "entity", "predicted_alpha")
    new = old.join(candidates(spark, sf), "entity", "left_semi").withColumn("predicted_alpha", -F.col("predicted_alpha"))
    return J.upsert_predictions(old, new, group_bound=P.entity_bound(spark, sf))


@register("overlay_fields", "entity:i dt:d score:f conviction:s", "snapjoin", """
SELECT a.entity, a.dt, coalesce(b.score, a.score) AS score, coalesce(b.conviction, a.conviction) AS conviction
FROM snapjoin a LEFT JOIN (SELECT entity, dt, 100.0 AS score, NULL AS conviction FROM snapjoin WHERE close > 2000) b USING (entity, dt)""")
def overlay_fields(spark, sf):
    rows = asof_rows(spark, sf)
    fresh = rows.where("close > 2000").select("entity", "dt", F.lit(100.0).alias("score"), F.lit(None).cast("string").alias("conviction"))
    return J.overlay_fields(rows, fresh, ["entity", "dt"], ["score", "conviction"])


@register("dedupe_versions", "version_id:s model_version:s dt:d", "vers", "SELECT * FROM vers")
def dedupe_versions(spark, sf):
    rows = versions(spark, sf)
    return J.dedupe_versions(rows.unionByName(rows.withColumn("created", F.date_sub("created", 1))))


@register("read_catalogue", "version_id:s model_version:s dt:d", "vers", "SELECT version_id, model_version, dt FROM vers")
def read_catalogue(spark, sf):
    """Version folders discovered below a path."""
    path = scratch_path(spark, "catalogue")
    rows = versions(spark, sf).select("version_id", "model_version", F.col("dt").cast("string").alias("dt"))
    rows.write.partitionBy("version_id").json(path)
    return FS.read_catalogue(spark, path)


@register("list_versions", "version_id:s dt:d stage:s", "vers", "SELECT *, 'challenger' AS stage FROM vers WHERE mean_ic < 0")
def list_versions(spark, sf):
    rows = versions(spark, sf).withColumn("stage", F.when(F.col("mean_ic") < 0, "challenger").otherwise("live"))
    return FS.list_versions(rows, "challenger")


# --- realised returns and pairings -----------------------------------------------------------

cte("ownret", "panel", "SELECT entity, dt, ln(lead(close, 4) OVER (PARTITION BY entity ORDER BY dt) / close) AS r FROM panel")
cte("secret", "sbench", "SELECT sector, dt, ln(lead(bench_close, 4) OVER (PARTITION BY sector ORDER BY dt) / bench_close) AS r FROM sbench")
cte("mktret", "market", "SELECT dt, ln(lead(market_close, 4) OVER (ORDER BY dt) / market_close) AS r FROM market")
cte("midweek", "pred", "SELECT entity, sector, dt + 3 AS dt, predicted_alpha FROM pred")
cte("realized", "ownret secret mktret midweek", """
SELECT q.entity, q.sector, q.dt, q.predicted_alpha, o.r - CASE WHEN q.entity % 4 = 3 THEN k.r ELSE b.r END AS realized_alpha
FROM midweek q ASOF JOIN ownret o ON q.entity = o.entity AND q.dt >= o.dt ASOF LEFT JOIN secret b ON q.sector = b.sector AND q.dt >= b.dt ASOF LEFT JOIN mktret k ON q.dt >= k.dt""")


def realized(spark, sf):
    """Pairs dated midweek, so every leg snaps back; some entities follow a benchmark that has no series."""
    base = cut_lineage(panel(spark, sf))
    bench = P.sector_series(base).select(F.col("sector").cast("string").alias("symbol"), "dt", F.col("bench_close").alias("close"))
    market = P.market_series(base).select(F.lit("market").alias("symbol"), "dt", F.col("market_close").alias("close"))
    entities = P.entity_bound(spark, sf)
    pairs = predictions(spark, sf, J.deal_entities(base.select("entity", "sector", "dt", "close"), entities)).select("entity", "sector", F.date_add("dt", 3).alias("dt"), "predicted_alpha")
    dim = P.dim_entity(spark, sf).select("entity", F.when(F.col("entity") % 4 == 3, "none").otherwise(F.col("sector").cast("string")).alias("symbol"))
    # a row per symbol and week: written, so that the planner knows how small it is
    series = cut_lineage(bench.unionByName(market))
    return J.realized_alpha(pairs, base.select("entity", "dt", "close"), series, 4, dim, entities=entities)


@register("realized_alpha", "entity:i dt:d predicted_alpha:f realized_alpha:f", "realized", "SELECT * FROM realized")
def realized_alpha(spark, sf):
    return realized(spark, sf)


@register("realized_monitor", "sector:i ic:f n:i n_weeks:i chasing_noise:b reason:s", "realized", f"""
SELECT *, round(ic, 10) <= 0 AS chasing_noise, CASE WHEN round(ic, 10) <= 0 THEN 'noise_watch' ELSE 'healthy' END AS reason FROM ({sql_ic("realized", "predicted_alpha", "realized_alpha", "sector", 10)})
JOIN (SELECT sector, count(DISTINCT isoyear(dt) * 100 + weekofyear(dt)) AS n_weeks FROM realized WHERE realized_alpha IS NOT NULL GROUP BY 1) USING (sector)""")
def realized_monitor(spark, sf):
    """History to verdict: pairs, realised outcome, pooled read and monitor per sector."""
    from panelith.operators import evaluation as E
    return E.champion_monitor(E.realized_read(realized(spark, sf), "predicted_alpha", "realized_alpha", ["sector"]))


cte("calls", "market", """
SELECT dt + 2 AS dt, CASE WHEN b > 0.03 THEN ' Bull ' WHEN b < -0.1 THEN 'BEAR' WHEN b < -0.03 THEN 'caution' WHEN b < 0 THEN 'unclear' ELSE 'neutral' END AS call
FROM (SELECT dt, market_close / lag(market_close, 4) OVER (ORDER BY dt) - 1 AS b FROM market) WHERE b IS NOT NULL""")
cte("pairs", "calls market", """
SELECT dt, call, label, call = label AS agreed, label = 'bear' AND call <> 'bear' AS bear_miss, call = 'bear' AND label <> 'bear' AS bull_miss FROM (
 SELECT c.dt, CASE lower(trim(c.call)) WHEN 'bull' THEN 'bull' WHEN 'neutral' THEN 'neutral' WHEN 'caution' THEN 'bear' WHEN 'bear' THEN 'bear' END AS call, l.label, l.k
 FROM calls c ASOF JOIN (SELECT dt, CASE WHEN f < -0.03 THEN 'bear' WHEN f > 0.03 THEN 'bull' ELSE 'neutral' END AS label, row_number() OVER (ORDER BY dt DESC) AS k FROM (
   SELECT dt, lead(market_close, 4) OVER (ORDER BY dt) / market_close - 1 AS f FROM market)) l ON c.dt >= l.dt) WHERE k > 8 AND call IS NOT NULL""")


def call_pairs(spark, sf):
    market = P.market_series(panel(spark, sf))
    w = W.Window.orderBy("dt")
    back = F.col("market_close") / F.lag("market_close", 4).over(w) - 1
    calls = market.withColumn("b", back).where("b IS NOT NULL").select(
        F.date_add("dt", 2).alias("dt"),
        F.when(F.col("b") > 0.03, " Bull ").when(F.col("b") < -0.1, "BEAR").when(F.col("b") < -0.03, "caution")
        .when(F.col("b") < 0, "unclear").otherwise("neutral").alias("call"))
    names = F.array(F.lit("bear"), F.lit("neutral"), F.lit("bull"))
    labels = W.regime_labels(market, 4).select("dt", F.get(names, F.col("label")).alias("label"))
    return J.pair_calls(calls, labels, 8)


@register("pair_calls", "dt:d call:s label:s agreed:b bear_miss:b bull_miss:b", "pairs", "SELECT * FROM pairs")
def pair_calls(spark, sf):
    return call_pairs(spark, sf)


@register("agreement_score", "n:i symmetric:f asymmetric:f rolling:f bear_misses:i bull_misses:i other_misses:i", "pairs", """
SELECT count(*) AS n, avg(agreed::INT) AS symmetric, 1 - avg(c) / 2 AS asymmetric, 1 - avg(CASE WHEN k <= 26 THEN c END) / 2 AS rolling, sum(bear_miss::INT) AS bear_misses, sum(bull_miss::INT) AS bull_misses,
 sum((NOT agreed AND NOT bear_miss AND NOT bull_miss)::INT) AS other_misses FROM (SELECT *, CASE WHEN agreed THEN 0.0 WHEN bear_miss THEN 2.0 ELSE 1.0 END AS c, row_number() OVER (ORDER BY dt DESC) AS k FROM pairs)""")
def agreement_score(spark, sf):
    from panelith.operators import evaluation as E
    return E.agreement_score(call_pairs(spark, sf), 26)


# --- files -----------------------------------------------------------------------------------


@register("panel_roundtrip", "entity:i dt:d close:f high:f low:f volume:f", "panel", "SELECT * FROM panel")
def panel_roundtrip(spark, sf):
    path = FS.write_panel(panel(spark, sf), scratch_path(spark, "panel"), 8)
    return FS.read_prices(spark, path)


@register("panel_roundtrip_named", "entity:s dt:d close:f high:f low:f volume:f", "panel", f"SELECT * REPLACE ({SQL_TICKER} AS entity) FROM panel")
def panel_roundtrip_named(spark, sf):
    """The same with a text key, as tickers are."""
    path = FS.write_panel(named(panel(spark, sf)), scratch_path(spark, "panel"))
    return FS.read_prices(spark, path)


@register("read_snapshots_named", "snapshot_dt:d entity:s score:f conviction:s sector:s", "uni", f"""
SELECT snapshot_dt, {SQL_TICKER} AS entity, score, conviction, CAST(sector AS VARCHAR) AS sector FROM uni""")
def read_snapshots_named(spark, sf):
    docs = FS.build_snapshots(named(universe(spark, sf)), modifiers(spark, sf), 64)
    path = FS.write_snapshots(docs, scratch_path(spark, "snapshots"))
    return FS.explode_universe(FS.read_snapshots(spark, path, "string"))


@register("prediction_documents_named", "dt:d version_id:s entity:s predicted_alpha:f p_up:f", "pred", f"""
SELECT dt, 'live-1' AS version_id, {SQL_TICKER} AS entity, predicted_alpha, p_up FROM pred""")
def prediction_documents_named(spark, sf):
    path = FS.write_predictions(named(predictions(spark, sf)), scratch_path(spark, "predictions"), "live-1", part_size=50)
    return FS.flatten_predictions(FS.read_predictions(spark, path, "string"))


@register("upsert_predictions_named", "dt:d entity:s predicted_alpha:f combined_rank:i", "pred cand", f"""
SELECT dt, entity, a AS predicted_alpha, row_number() OVER (PARTITION BY dt ORDER BY round(a, 10) DESC, entity) AS combined_rank FROM (
 SELECT dt, {SQL_TICKER} AS entity, CASE WHEN entity IN (SELECT entity FROM cand) THEN -predicted_alpha ELSE predicted_alpha END AS a FROM pred)""")
def upsert_predictions_named(spark, sf):
    """Text keys through the plan for cross-sections of unknown size."""
    old = named(predictions(spark, sf).select("dt", "entity", "predicted_alpha"))
    new = old.join(named(candidates(spark, sf)), "entity", "left_semi").withColumn("predicted_alpha", -F.col("predicted_alpha"))
    return J.upsert_predictions(old, new)


@register("read_window", "entity:i dt:d close:f", "panel", """
SELECT entity, dt, close FROM panel WHERE dt BETWEEN DATE '2000-06-30' - 730 AND DATE '2000-06-30'""")
def read_window(spark, sf):
    path = FS.write_panel(panel(spark, sf), scratch_path(spark, "panel"), 8)
    return FS.read_window(spark, path, P.dim_entity(spark, sf), "2000-06-30")


@register("read_price_map", "entity:i dt:d close:f", "panel cand", "SELECT entity, dt, close FROM panel WHERE entity IN (SELECT entity FROM cand)")
def read_price_map(spark, sf):
    path = FS.write_panel(panel(spark, sf), scratch_path(spark, "panel"), 8)
    return FS.read_price_map(spark, path, candidates(spark, sf))


@register("read_dim_entity", "entity:i sector:s", "dim", "SELECT * FROM dim")
def read_dim_entity(spark, sf):
    path = scratch_path(spark, "sectors")
    P.dim_entity(spark, sf).withColumn("sector", F.col("sector").cast("string")).write.json(path)
    return FS.read_dim_entity(spark, [f"{path}-absent", path])


@register("read_series", "symbol:s dt:d close:f", "", """
SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS dt, avg(o_totalprice) AS close FROM orders GROUP BY 1, 2""")
def read_series(spark, sf):
    path = scratch_path(spark, "series")
    P.macro_series(spark, sf, "day").withColumnRenamed("dt", "date").withColumn("volume", F.lit(0)).write.parquet(path)
    return FS.read_series(spark, path)


@register("prediction_documents", "dt:d version_id:s entity:i predicted_alpha:f p_up:f predicted_direction:s prediction_confidence:f", "pred", """
SELECT dt, 'live-1' AS version_id, entity, predicted_alpha, p_up, predicted_direction, prediction_confidence FROM pred""")
def prediction_documents(spark, sf):
    """Written as nested documents in parts, read back and flattened."""
    path = FS.write_predictions(predictions(spark, sf), scratch_path(spark, "predictions"), "live-1", part_size=50)
    return FS.flatten_predictions(FS.read_predictions(spark, path))


@register("read_existing", "dt:d entity:i predicted_alpha:f", "predday", "SELECT dt, entity, predicted_alpha FROM predday")
def read_existing(spark, sf):
    path = FS.write_predictions(predictions(spark, sf), scratch_path(spark, "predictions"), "live-1", part_size=50)
    return FS.read_existing(spark, path, WEEK)


@register("read_latest", "entity:i dt:d close:f", "panel", "SELECT entity, dt, close FROM panel WHERE dt = (SELECT max(dt) FROM panel)")
def read_latest(spark, sf):
    path = FS.write_dated_latest(panel(spark, sf).select("entity", "dt", "close"), scratch_path(spark, "dated"))
    return FS.read_latest(spark, path)


@register("read_nav_csv", "dt:d nav:f", "daymarket", "SELECT dt, market_close AS nav FROM daymarket")
def read_nav_csv(spark, sf):
    market = P.market_series(P.price_panel(spark, sf, "day"))
    rows = market.select("dt", F.col("market_close").alias("EOD_NAV"), F.lit("x").alias("note")).withColumnRenamed("dt", "Trade Date")
    return FS.read_nav_csv(spark, FS.export_csv(rows, scratch_path(spark, "nav"), ["Trade Date", "EOD_NAV"]))


@register("append_manifest", "run_id:s dt:d n_rows:i", "panel", """
SELECT r AS run_id, dt, count(*) AS n_rows FROM panel, (VALUES ('r1'), ('r2')) t(r) GROUP BY 1, 2""")
def append_manifest(spark, sf):
    path, rows = scratch_path(spark, "manifest"), panel(spark, sf)
    FS.append_manifest(rows, path, "r1")
    FS.append_manifest(rows, path, "r2")
    return spark.read.parquet(path)


@register("upstream_staleness", "module:s age_hours:f stale:b", "", """
SELECT m.module, date_diff('second', t.ts, TIMESTAMP '2024-01-31 00:00:00') / 3600.0 AS age_hours, coalesce(date_diff('second', t.ts, TIMESTAMP '2024-01-31 00:00:00') / 3600.0 > 24.5, true) AS stale
FROM (SELECT DISTINCT event_type AS module FROM events UNION ALL SELECT 'never') m LEFT JOIN (SELECT event_type AS module, date_trunc('second', max(ts)) AS ts FROM events GROUP BY 1) t USING (module)""")
def upstream_staleness(spark, sf):
    events = P.table(spark, sf, "events").select(F.col("event_type").alias("module"), F.col("ts").cast("timestamp").alias("ts"))
    modules = events.select("module").distinct().unionByName(spark.createDataFrame([("never",)], "module string"))
    return FS.upstream_staleness(modules, events, F.lit("2024-01-31 00:00:00").cast("timestamp"), 24.5)


@register("data_age", "entity:i last_dt:d age_days:i", "panel", "SELECT entity, max(dt) AS last_dt, date_diff('day', max(dt), DATE '2001-12-31') AS age_days FROM panel GROUP BY 1")
def data_age(spark, sf):
    return FS.data_age(panel(spark, sf), "2001-12-31")


@register("missing_dates", "dt:d status:s", "daypanel", """
SELECT CAST(d AS DATE) AS dt, CASE WHEN CAST(d AS DATE) IN (SELECT dt FROM daypanel) THEN 'skipped' ELSE 'to_build' END AS status
FROM generate_series(DATE '1994-12-31', DATE '2002-03-30', INTERVAL 7 DAY) t(d)""")
def missing_dates(spark, sf):
    return FS.missing_dates(P.price_panel(spark, sf, "day").select("dt"), "1994-12-25", "2002-03-31")
