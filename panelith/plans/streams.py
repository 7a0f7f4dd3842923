"""Queries that run a stream to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelith.operators import drift as D
from panelith.operators import states as S
from panelith.plans.base import panel
from panelith.plans.evaluation import sql_gate
from panelith.plans.labels import CP_SQL, TIER_SQL, nav_rows, zscores
from panelith.plans.registry import register
from panelith.plans.scoring import predictions
from panelith.session import cut_lineage, scratch_path
from panelith.streaming import stateful as ST

HALF = "1998-06-29"


def halves(spark, rows, name):
    """Two micro-batches split by date, so state is carried from one to the next."""
    rows = cut_lineage(rows)
    return ST.Replay(spark, [rows.where(F.col("dt") < HALF), rows.where(F.col("dt") >= HALF)], name)


@register("stream_bars", "entity:i dt:d close:f mean_value:f n_events:i", "", """
SELECT user_id AS entity, CAST(ts AS DATE) AS dt, arg_max(value, ts) AS close, avg(value) AS mean_value, count(*) AS n_events FROM events
WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY 1, 2""")
def stream_bars(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = events.select(F.col("user_id").alias("entity"), F.col("ts").cast("timestamp").alias("ts"), "value")
    return ST.drain(ST.stream_bars(rows), "bars")


@register("dedupe_stream", "entity:i dt:d close:f", "panel", "SELECT * FROM panel")
def dedupe_stream(spark, sf):
    """Every row arrives twice, in two micro-batches."""
    rows = cut_lineage(panel(spark, sf).select("entity", "dt", "close"))
    twice = ST.Replay(spark, [rows, rows], "twice")
    return ST.drain(ST.dedupe_stream(twice.stream), "deduped", twice)


TIERS = "entity:i dt:d drawdown:f tier:s excess:f excess_tier:s"


@register("stream_drawdown", TIERS, "nav", TIER_SQL)
def stream_drawdown(spark, sf):
    replay = halves(spark, nav_rows(spark, sf), "nav")
    return ST.drain(ST.stream_drawdown(replay.stream), "tiers", replay)


@register("stream_drawdown_seeded", TIERS, "nav", TIER_SQL + f" WHERE dt >= DATE '{HALF}'")
def stream_drawdown_seeded(spark, sf):
    """Later dates only, started from the batch replay of the earlier ones."""
    rows = cut_lineage(nav_rows(spark, sf))
    early = rows.where(F.col("dt") < HALF)
    seed = ST.seed_state(early, S.drawdown_tiers(early))
    late = ST.Replay(spark, [rows.where(F.col("dt") >= HALF)], "late")
    return ST.drain(ST.stream_drawdown(late.stream, initial=seed), "tiers", late)


@register("state_version_guard", TIERS, "nav", TIER_SQL.replace("FROM nav)", f"FROM nav WHERE dt >= DATE '{HALF}')"))
def state_version_guard(spark, sf):
    """A seed of another schema version is ignored: the later dates start cold."""
    rows = cut_lineage(nav_rows(spark, sf))
    early = rows.where(F.col("dt") < HALF)
    seed = ST.seed_state(early, S.drawdown_tiers(early), version=0)
    late = ST.Replay(spark, [rows.where(F.col("dt") >= HALF)], "late")
    return ST.drain(ST.stream_drawdown(late.stream, initial=seed), "tiers", late)


@register("stream_latch", "entity:i dt:d z:f change_confidence:f max_run_prob:f change_signal:b latched:b", "zseries", CP_SQL)
def stream_latch(spark, sf):
    replay = halves(spark, zscores(spark, sf), "z")
    return ST.drain(ST.stream_latch(replay.stream), "latch", replay)


@register("gated_stream_sink", "entity:i dt:d predicted_alpha:f p_up:f", "pred", f"""
SELECT p.* FROM pred p JOIN ({sql_gate("pred", "p_up", "predicted_direction", "dt")}) g USING (dt) WHERE g.passed""")
def gated_stream_sink(spark, sf):
    rows = predictions(spark, sf).select("entity", "dt", "predicted_alpha", "p_up", "predicted_direction")
    path = scratch_path(spark, "gated")
    replay = halves(spark, rows, "preds")
    ST.gated_stream_sink(
        replay.stream, lambda b: D.distribution_gate(b, ["dt"]), path, f"{path}-checkpoint", replay
    )
    return spark.read.parquet(f"{path}/accepted")
