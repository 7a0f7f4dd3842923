"""Keyed joins: outcomes, coverage, provenance, upserts, realised returns, pairings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.functions.columns import by_entity, finite, map_lookup
from panelith.operators.align import asof_values
from panelith.operators.windows import combined_rank
from panelith.session import cut_lineage

#: entities whose series one task holds
ENTITIES_A_TASK = 1000


def outcome_join(scores: DataFrame, outcomes: DataFrame, horizon: int) -> DataFrame:
    """Scores with the outcome of one horizon; rows missing either drop out."""
    known = outcomes.where((F.col("horizon_days") == horizon) & F.col("beat").isNotNull())
    return scores.where("score IS NOT NULL AND score_date IS NOT NULL").join(
        known.drop("horizon_days"), ["symbol", "score_date"]
    )


def asof_snapshot(dates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(dt, snapshot_dt): the newest snapshot date at or before each date, NULL before the first.
    Both sides are reduced to distinct dates first."""
    marks = snapshots.select(F.col("snapshot_dt").alias("dt"), F.lit(0).alias("_k")).distinct()
    marks = marks.withColumn("_v", F.lit(1))
    needed = dates.select("dt").distinct().withColumn("_k", F.lit(0))
    return asof_values(needed, marks, ["_k"], ["_v"], source_dt="snapshot_dt").select("dt", "snapshot_dt")


def snapshot_for_date(dates: DataFrame, snapshots: DataFrame, back_days: int = 5) -> DataFrame:
    """(dt, snapshot_dt, source): same day, else the newest of the five weekdays before, else the
    newest snapshot there is."""
    marks = snapshots.select("snapshot_dt").distinct()
    newest = marks.agg(F.max("snapshot_dt").alias("_newest"))
    steps = F.sequence(F.lit(0), F.lit(back_days + 2))
    tries = (
        dates.select("dt").distinct()
        .withColumn("_s", F.explode(steps))
        .withColumn("snapshot_dt", F.date_sub("dt", F.col("_s")))
    )
    # the first back_days weekdays before dt, and dt itself
    weekday = ~F.dayofweek("snapshot_dt").isin(1, 7)
    order = Window.partitionBy("dt").orderBy("_s")
    before = F.sum((weekday & (F.col("_s") > 0)).cast("int")).over(order)
    tries = tries.withColumn("_w", before).where(
        (F.col("_s") == 0) | (weekday & (F.col("_w") <= back_days))
    )
    hits = tries.join(marks, "snapshot_dt").groupBy("dt").agg(F.max("snapshot_dt").alias("_hit"))
    out = dates.select("dt").distinct().join(hits, "dt", "left").crossJoin(F.broadcast(newest))
    source = (
        F.when(F.col("_hit") == F.col("dt"), "today").when(F.col("_hit").isNotNull(), "recent").otherwise("latest")
    )
    return out.select("dt", F.coalesce("_hit", "_newest").alias("snapshot_dt"), source.alias("source"))


def coverage_delta(candidates: DataFrame, predictions: DataFrame, key: str = "entity") -> tuple[DataFrame, DataFrame]:
    """(missing keys, one summary row): candidates without a prediction, compared upper-case."""

    def keys(df: DataFrame) -> DataFrame:
        return df.select(F.upper(F.trim(F.col(key).cast("string"))).alias(key)).distinct()

    want, have = keys(candidates), keys(predictions)
    tagged = want.join(have.withColumn("_have", F.lit(1)), key, "left")
    missing = tagged.where("_have IS NULL").select(key)
    covered = tagged.agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count("_have").alias("n_covered"),
        F.sum(F.col("_have").isNull().cast("int")).alias("n_missing"),
    )
    n_pred = have.agg(F.count(F.lit(1)).alias("n_predictions"))
    summary = covered.crossJoin(F.broadcast(n_pred)).withColumn("has_gap", F.col("n_missing") > 0)
    return missing, summary


def require_coverage(candidates: DataFrame, predictions: DataFrame, key: str = "entity") -> None:
    """The failing form: raises with the number of candidates that have no prediction."""
    _, summary = coverage_delta(candidates, predictions, key)
    row = summary.first()
    if row["has_gap"]:
        raise ValueError(f"{row['n_missing']} of {row['n_candidates']} candidates have no prediction")


def universe_with_source(population: DataFrame, candidates: DataFrame, key: str = "entity") -> DataFrame:
    a = population.select(key).distinct().withColumn("_p", F.lit(True))
    b = candidates.select(key).distinct().withColumn("_c", F.lit(True))
    source = (
        F.when(F.col("_p") & F.col("_c"), "both").when(F.col("_p"), "population").otherwise("buy_candidate")
    )
    return a.join(b, key, "full_outer").select(key, source.alias("source"))


def upsert_predictions(
    existing: DataFrame, new: DataFrame, by: list[str] | None = None, group_bound: int | None = None
) -> DataFrame:
    """Union by upper-cased key with the new row winning, ranked again. At most two rows meet per
    key once each side is unique on it."""
    by = by or ["dt"]
    both = existing.withColumn("_prio", F.lit(1)).unionByName(
        new.withColumn("_prio", F.lit(0)), allowMissingColumns=True
    ).withColumn("_key", F.upper(F.col("entity").cast("string")))
    cols = [c for c in both.columns if c not in (*by, "_prio", "_key")]
    best = both.groupBy(*by, "_key").agg(F.min_by(F.struct(*cols), F.col("_prio")).alias("r"))
    rows = best.select(*by, "r.*").drop("combined_rank")
    return combined_rank(rows, by=by, group_bound=group_bound)


def overlay_fields(base: DataFrame, canonical: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Non-null canonical fields replace the base's."""
    other = canonical.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    out = base.join(other, keys, "left")
    return out.withColumns({f: F.coalesce(F.col(f"_{f}"), F.col(f)) for f in fields}).drop(
        *[f"_{f}" for f in fields]
    )


def deal_entities(rows: DataFrame, entities: int) -> DataFrame:
    """Rows hash-partitioned by entity, into more parts the more entities there are."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-entities // ENTITIES_A_TASK))
    return rows.repartition(parts, "entity")


def realized_alpha(
    pairs: DataFrame, prices: DataFrame, benchmarks: DataFrame, horizon: int, dim: DataFrame,
    market: str = "market", entities: int | None = None,
) -> DataFrame:
    """Adds ``realized_alpha``: log return over ``horizon`` rows of the entity's own series minus the
    same of its benchmark's own series, both snapped back to the last row at or before the pair's
    date. Windows still open and non-positive prices give NULL.

    prices: (entity, dt, close); benchmarks: (symbol, dt, close); dim: (entity, symbol); entities
    without a benchmark use ``market``. ``entities`` (a bound on their number) sets how many parts the
    entities' own rows are dealt to, so that a task holds no more of them on larger tables.
    """
    if entities:
        prices = deal_entities(prices, entities)

    def ahead(df: DataFrame, key: str, out: str) -> DataFrame:
        w = Window.partitionBy(key).orderBy("dt")
        later, now = F.lead("close", horizon).over(w), F.col("close")
        ret = F.when((later > 0) & (now > 0), F.ln(later / now))
        # a struct keeps "row found, window open" apart from "no row yet"
        return df.where("close IS NOT NULL").select(key, "dt", F.struct(ret.alias("r")).alias(out))

    known = benchmarks.select("symbol").distinct().withColumn("_k", F.lit(True))
    tagged = pairs.join(dim, "entity", "left").join(F.broadcast(known), "symbol", "left").withColumn(
        "symbol", F.when(F.col("_k"), F.col("symbol")).otherwise(F.lit(market))
    ).drop("_k")
    tagged = cut_lineage(tagged)
    dealt = deal_entities(tagged, entities) if entities else tagged
    own = asof_values(dealt, ahead(prices, "entity", "_own"), ["entity"], ["_own"])
    # symbols x dates: bounded by the calendar
    ref = cut_lineage(asof_values(tagged, ahead(benchmarks, "symbol", "_ref"), ["symbol"], ["_ref"]))
    out = dealt.join(own, ["entity", "dt"], "left").join(ref, ["symbol", "dt"], "left")
    return out.withColumn("realized_alpha", F.col("_own.r") - F.col("_ref.r")).drop("_own", "_ref", "symbol")


# Agent words and the three-class label they stand for.
CALL_LABELS = {"bull": "bull", "neutral": "neutral", "caution": "bear", "bear": "bear"}


def pair_calls(calls: DataFrame, labels: DataFrame, lag_rows: int) -> DataFrame:
    """Calls joined to the label of the newest label date at or before them, leaving out the last
    ``lag_rows`` label dates; unparseable calls are skipped.

    calls: (dt, call); labels: (dt, label), one row per date each.
    """
    newest = Window.partitionBy(F.lit(1)).orderBy(F.col("dt").desc())
    mature = labels.withColumn("_k", F.row_number().over(newest)).select(
        "dt", F.struct("label", F.col("_k")).alias("_l"), F.lit(0).alias("_s")
    )
    needed = calls.select("dt").withColumn("_s", F.lit(0))
    found = asof_values(needed, mature, ["_s"], ["_l"]).where(F.col("_l._k") > lag_rows)
    word = map_lookup(CALL_LABELS, F.lower(F.trim("call")))
    out = calls.join(found, "dt").withColumns({"call": word, "label": F.col("_l.label")})
    out = out.where("call IS NOT NULL AND label IS NOT NULL")
    return out.select(
        "dt", "call", "label",
        (F.col("call") == F.col("label")).alias("agreed"),
        ((F.col("label") == "bear") & (F.col("call") != "bear")).alias("bear_miss"),
        ((F.col("call") == "bear") & (F.col("label") != "bear")).alias("bull_miss"),
    )


def join_coverage(rows: DataFrame, snapshot_dt: str, score: str) -> DataFrame:
    """Counts per outcome of a snapshot join and the share kept."""
    reason = (
        F.when(F.col(snapshot_dt).isNull(), "no_snapshot").when(F.col(score).isNull(), "missing").otherwise("kept")
    )
    counts = rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    # three rows at most
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def admission_report(rows: DataFrame, min_rows: int, required: list[str], label: str) -> DataFrame:
    """Entities and rows per reason of acceptance or rejection."""
    per = rows.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(finite(label)).alias("_labels"),
        *[F.count(finite(c)).alias(f"_r{i}") for i, c in enumerate(required)],
    )
    missing = F.lit(False)
    for i in range(len(required)):
        missing = missing | (F.col(f"_r{i}") == 0)
    reason = (
        F.when(F.col("n") < min_rows, "insufficient_history").when(missing, "missing_features")
        .when(F.col("_labels") == 0, "no_labels").otherwise("admitted")
    )
    return per.groupBy(reason.alias("reason")).agg(
        F.count(F.lit(1)).alias("n_entities"), F.sum("n").alias("n_rows")
    )


def dedupe_versions(versions: DataFrame) -> DataFrame:
    """The newest row per version id."""
    cols = [c for c in versions.columns if c != "version_id"]
    best = versions.groupBy("version_id").agg(F.max_by(F.struct(*cols), F.struct("dt", "created")).alias("r"))
    return best.select("version_id", "r.*")
