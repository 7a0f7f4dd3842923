"""Online operators: bars from events, deduplication, drawdown tiers, change-point latch, gated sink.

State lives in the state store of the query's checkpoint, one small struct per entity. Batch replays
in ``operators.states`` share the step functions, so both give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from panelith.operators.states import (
    NEW_LATCH, ChangePointPrior, DrawdownBands, LatchRules, RunLengthPosterior, latch_step, tier_walk,
)
from panelith.session import scratch_path

STATE_VERSION = 1
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_bars(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Daily bars per entity from (entity, ts, value): last value, mean, count. A day is final once
    the watermark has passed its end."""
    bars = events.withWatermark("ts", late).groupBy("entity", F.window("ts", "1 day")).agg(
        F.max_by("value", "ts").alias("close"), F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n_events")
    )
    return bars.select("entity", F.to_date("window.start").alias("dt"), "close", "mean_value", "n_events")


def dedupe_stream(rows: DataFrame, late: str = "30 days", keys: tuple[str, ...] = ("entity", "dt")) -> DataFrame:
    """First row per key within the watermark; later ones and late rows disappear."""
    timed = rows.withColumn("_ts", F.col("dt").cast("timestamp")).withWatermark("_ts", late)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_ts")


class _Keyed(StatefulProcessor):
    """Sorts an entity's rows of one micro-batch and carries one versioned struct between batches.
    A stored struct of another version is ignored: the entity starts cold."""

    state_schema: T.StructType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("state", self.state_schema)

    def load(self) -> dict | None:
        if not self._state.exists():
            return None
        values = dict(zip(self.state_schema.names, self._state.get()))
        return values if values["version"] == STATE_VERSION else None

    def save(self, values: dict) -> None:
        full = {**values, "version": STATE_VERSION}
        self._state.update(tuple(full[n] for n in self.state_schema.names))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("dt")
        out, state = self.advance(batch, self.load())
        if state is not None:
            self.save(state)
        out.insert(0, "entity", key[0])
        yield out

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0].to_dict()
        self._state.update(
            tuple(None if pd.isna(row[n]) else _plain(row[n], f) for n, f in zip(self.state_schema.names, self.state_schema))
        )

    def close(self) -> None:
        pass


def _plain(value, field: T.StructField):
    if isinstance(field.dataType, T.DateType):
        return pd.Timestamp(value).date()
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return int(value)
    if isinstance(field.dataType, T.DoubleType):
        return float(value)
    return value


DRAWDOWN_STATE = T.StructType(
    [
        T.StructField("version", T.IntegerType()), T.StructField("tier", T.StringType()),
        T.StructField("excess_tier", T.StringType()), T.StructField("peak", T.DoubleType()),
        T.StructField("nav_peak", T.DoubleType()), T.StructField("pend", T.StringType()),
        T.StructField("pend_n", T.IntegerType()), T.StructField("ex_pend", T.StringType()),
        T.StructField("ex_pend_n", T.IntegerType()), T.StructField("last_dt", T.DateType()),
        T.StructField("seen", T.LongType()),
    ]
)


class DrawdownProcessor(_Keyed):
    state_schema = DRAWDOWN_STATE

    def __init__(self, bands: DrawdownBands = DrawdownBands()):
        self.bands = bands

    def advance(self, batch: pd.DataFrame, state: dict | None):
        batch = batch.assign(dt=pd.to_datetime(batch["dt"]).dt.date)
        return tier_walk(batch, self.bands, state)


LATCH_STATE = T.StructType(
    [
        T.StructField("version", T.IntegerType()), T.StructField("mass", T.ArrayType(T.DoubleType())),
        T.StructField("mean", T.ArrayType(T.DoubleType())), T.StructField("scale", T.ArrayType(T.DoubleType())),
        T.StructField("on", T.BooleanType()), T.StructField("changes", T.IntegerType()),
        T.StructField("clears", T.IntegerType()), T.StructField("seen", T.LongType()),
        T.StructField("last_dt", T.DateType()),
    ]
)


class LatchProcessor(_Keyed):
    state_schema = LATCH_STATE

    def __init__(self, prior: ChangePointPrior = ChangePointPrior(), rules: LatchRules = LatchRules()):
        self.prior, self.rules = prior, rules

    def advance(self, batch: pd.DataFrame, state: dict | None):
        if state is None:
            posterior, latch, last = RunLengthPosterior(self.prior), dict(NEW_LATCH), None
        else:
            posterior = RunLengthPosterior(self.prior, state["mass"], state["mean"], state["scale"])
            latch = {k: state[k] for k in NEW_LATCH}
            last = state["last_dt"]
        out = []
        for dt, z in zip(pd.to_datetime(batch["dt"]).dt.date, batch["z"].to_numpy(float)):
            if last is not None and dt <= last:
                continue
            posterior.observe(z)
            short = posterior.short_mass(self.rules.min_run)
            latch = latch_step(latch, z, short, self.rules)
            last = dt
            out.append((dt, z, short, posterior.top_mass(), short > self.rules.change_threshold, latch["on"]))
        names = ["dt", "z", "change_confidence", "max_run_prob", "change_signal", "latched"]
        new = {
            **latch, "mass": posterior.mass.tolist(), "mean": posterior.mean.tolist(),
            "scale": posterior.scale.tolist(), "last_dt": last,
        }
        return pd.DataFrame(out, columns=names), new


def _run_keyed(rows: DataFrame, processor: _Keyed, fields: str, initial: DataFrame | None) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    schema = T.StructType([rows.schema["entity"], *T._parse_datatype_string(fields).fields])
    grouped = initial.groupBy("entity") if initial is not None else None
    return rows.groupBy("entity").transformWithStateInPandas(processor, schema, "Append", "None", grouped)


def stream_drawdown(
    rows: DataFrame, bands: DrawdownBands = DrawdownBands(), initial: DataFrame | None = None
) -> DataFrame:
    """Tiers of a stream of (entity, dt, close, nav). A date seen before changes nothing. ``initial``
    seeds entities from a batch replay (see ``seed_state``)."""
    fields = "dt date, drawdown double, tier string, excess double, excess_tier string"
    return _run_keyed(rows.select("entity", "dt", "close", "nav"), DrawdownProcessor(bands), fields, initial)


def seed_state(history: DataFrame, tiers: DataFrame, version: int = STATE_VERSION) -> DataFrame:
    """One state row per entity after a batch replay: history (entity, dt, close, nav), tiers as the
    batch ladder returns them."""
    peaks = history.groupBy("entity").agg(
        F.max("close").alias("peak"), F.max("nav").alias("nav_peak"), F.max("dt").alias("last_dt"),
        F.count(F.lit(1)).alias("seen"),
    )
    last = tiers.groupBy("entity").agg(
        F.max_by("tier", "dt").alias("tier"), F.max_by("excess_tier", "dt").alias("excess_tier")
    )
    none = F.lit(None).cast("string")
    rows = peaks.join(last, "entity").withColumns(
        {"version": F.lit(version), "pend": none, "ex_pend": none, "pend_n": F.lit(0), "ex_pend_n": F.lit(0)}
    )
    return rows.select("entity", *DRAWDOWN_STATE.names)


def stream_latch(
    rows: DataFrame, prior: ChangePointPrior = ChangePointPrior(), rules: LatchRules = LatchRules()
) -> DataFrame:
    """Change-point mass and latch of a stream of (entity, dt, z)."""
    fields = "dt date, z double, change_confidence double, max_run_prob double, change_signal boolean, latched boolean"
    return _run_keyed(rows.select("entity", "dt", "z"), LatchProcessor(prior, rules), fields, None)


# --- running a stream to its end -----------------------------------------------------------------


class Replay:
    """A file stream whose micro-batches are the given tables, in order.

    A table arrives as all the files its partitions write. The next one is written once the query has
    taken up everything before it: the same checkpointed query runs once per arrival.
    """

    def __init__(self, spark: SparkSession, parts: list[DataFrame], name: str):
        self.path, self.parts = scratch_path(spark, f"{name}-source"), list(parts)
        self.arrived = 0
        self.arrive()
        self.stream = spark.readStream.schema(parts[0].schema).parquet(self.path)

    def arrive(self) -> bool:
        """Writes the next table; False if there is none left."""
        if self.arrived == len(self.parts):
            return False
        self.parts[self.arrived].write.mode("append").parquet(self.path)
        self.arrived += 1
        return True


def run_available(writer, replay: Replay | None = None) -> None:
    """Starts a checkpointed query over everything available, again after each arrival."""
    while True:
        writer().trigger(availableNow=True).start().awaitTermination()
        if replay is None or not replay.arrive():
            return


def drain(stream: DataFrame, name: str, replay: Replay | None = None) -> DataFrame:
    """Runs an append query over everything available and returns what it wrote. Output and
    checkpoint are below the shared folder, so a restart continues where it stopped."""
    spark = stream.sparkSession
    out, check = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    run_available(
        lambda: stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", check).option("path", out),
        replay,
    )
    return spark.read.schema(stream.schema).parquet(out)


def gated_stream_sink(preds: DataFrame, gate, path: str, checkpoint: str, replay: Replay | None = None) -> None:
    """Writes each micro-batch's dates that pass ``gate`` (a function to rows with dt, passed) and
    lists the refused ones. Both writes carry the batch number, so a repeated batch overwrites
    itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            verdict = gate(batch).select("dt", "passed", "failed_check")
            good = batch.join(verdict.where("passed").select("dt"), "dt", "left_semi")
            good.write.mode("overwrite").parquet(f"{path}/accepted/batch={number}")
            verdict.where("NOT passed").write.mode("overwrite").parquet(f"{path}/refused/batch={number}")
        finally:
            batch.unpersist()

    run_available(lambda: preds.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), replay)
