"""Readers and writers: panels, series, nested documents, dated tables, manifests.

Every reader takes an explicit schema; column pruning and date filters reach the files. Documents
that nest a whole batch are written in parts of bounded size, so no task holds a batch. An entity key
may be of any type: tables bring theirs along, and readers of JSON documents take it as ``key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelith.functions.columns import null_hygiene

PRICE_FIELDS = ("high", "low", "close", "volume")
KEY = "bigint"
SERIES_SCHEMA = "symbol string, dt date, close double"
PREDICTION_FIELDS = {
    "predicted_alpha": "double", "p_up": "double", "p_down": "double", "predicted_direction": "string",
    "prediction_confidence": "double", "combined_rank": "bigint", "realized_alpha": "double",
}


def snapshot_schema(key: str = KEY) -> str:
    return (
        "snapshot_dt date, market_regime string, sector_modifiers map<string,double>, "
        f"universe array<struct<entity:{key},score:double,conviction:string,sector:string>>, "
        f"buy_candidates array<struct<entity:{key}>>, _corrupt string"
    )


def prediction_schema(key: str = KEY) -> str:
    fields = ",".join(f"{n}:{t}" for n, t in {"entity": key, **PREDICTION_FIELDS}.items())
    return f"date date, version_id string, part int, n_predictions bigint, predictions array<struct<{fields}>>"


# --- panels and series ------------------------------------------------------------------------


def assert_unique(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate keys are an error, never silently merged."""
    dup = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).take(1)
    if dup:
        raise ValueError(f"duplicate key {[dup[0][k] for k in keys]} in {keys}")
    return rows


def write_panel(panel: DataFrame, path: str, buckets: int | None = None) -> str:
    """Panel files partitioned by year; rows of one entity and year share a file. ``buckets``: writing
    tasks, by default the session's shuffle partitions. Empty input writes nothing but the schema."""
    buckets = buckets or int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = panel.withColumn("year", F.year("dt")).repartition(buckets, "year", "entity")
    out.sortWithinPartitions("year", "entity", "dt").write.mode("overwrite").partitionBy("year").parquet(path)
    return path


def read_prices(spark: SparkSession, path: str, optional: list[str] | None = None) -> DataFrame:
    """(entity, dt, bar fields) with NaN and infinities as NULL; optional columns may be absent."""
    raw = spark.read.parquet(path)
    cols = [F.col("entity"), F.to_date("dt").alias("dt")]
    for name in [*PRICE_FIELDS, *(optional or [])]:
        known = F.col(name).cast("double") if name in raw.columns else F.lit(None).cast("double")
        cols.append(known.alias(name))
    return null_hygiene(raw.select(*cols), [*PRICE_FIELDS, *(optional or [])])


def read_window(
    spark: SparkSession, path: str, universe: DataFrame, as_of: str, look_back_days: int = 730,
    columns: list[str] | None = None, max_missing: float = 0.05,
) -> DataFrame:
    """Date range and columns of a universe. More than ``max_missing`` absent entities is an error."""
    day = F.lit(as_of).cast("date")
    raw = spark.read.parquet(path)
    # the partition column prunes folders, the date the row groups
    rows = raw.where(
        (F.col("dt") <= day) & (F.col("dt") >= F.date_sub(day, look_back_days))
        & (F.col("year") <= F.year(day)) & (F.col("year") >= F.year(F.date_sub(day, look_back_days)))
    ).select("entity", "dt", *(columns or ["close"]))
    rows = rows.join(universe.select("entity").distinct(), "entity", "left_semi")
    have = rows.select("entity").distinct().count()
    want = universe.select("entity").distinct().count()
    if want and (want - have) / want > max_missing:
        raise ValueError(f"{want - have} of {want} entities have no rows in the window")
    return rows


def read_series(spark: SparkSession, path: str, date_column: str = "date") -> DataFrame:
    """(symbol, dt, close) only; the date may be called ``dt`` or ``date_column``. A missing path is
    an empty series."""
    try:
        raw = spark.read.parquet(path)
    except Exception as exc:  # a path without files
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER" not in str(exc):
            raise
        return spark.createDataFrame([], SERIES_SCHEMA)
    dates = [F.to_date(c) for c in ("dt", date_column) if c in raw.columns]
    return raw.select("symbol", F.coalesce(*dates).alias("dt"), F.col("close").cast("double").alias("close"))


def read_price_map(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Close series of the given entities; absent ones are simply not there."""
    rows = spark.read.parquet(path).select("entity", "dt", "close")
    return rows.join(keys.select("entity").distinct(), "entity", "left_semi")


def read_dim_entity(spark: SparkSession, paths: list[str], key: str = KEY) -> DataFrame:
    """entity -> sector from the first location that exists."""
    for path in paths:
        try:
            return spark.read.schema(f"entity {key}, sector string").json(path).where("entity IS NOT NULL")
        except Exception as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    raise FileNotFoundError(f"no sector map in {paths}")


# --- nested documents -------------------------------------------------------------------------


def in_parts(rows: DataFrame, by: list[str], part_size: int, key: str = "entity") -> DataFrame:
    """Adds ``part`` so that every (by, part) holds about ``part_size`` rows."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / part_size).cast("int").alias("_parts"))
    joined = rows.join(sizes, by)
    return joined.withColumn("part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).drop("_parts")


def build_snapshots(
    universe: DataFrame, modifiers: DataFrame, part_size: int = 10_000, regimes: DataFrame | None = None
) -> DataFrame:
    """Nested snapshot documents. universe: (snapshot_dt, entity, score, conviction, sector);
    modifiers: (snapshot_dt, sector, modifier), a few rows per snapshot; regimes: (snapshot_dt,
    market_regime), one row per snapshot, neutral where it has none."""
    maps = modifiers.groupBy("snapshot_dt").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("sector").cast("string"), "modifier"))).alias("sector_modifiers")
    )
    parts = in_parts(universe, ["snapshot_dt"], part_size).groupBy("snapshot_dt", "part").agg(
        F.collect_list(F.struct("entity", "score", "conviction", F.col("sector").cast("string").alias("sector"))).alias("universe")
    )
    docs = parts.join(maps, "snapshot_dt", "left")
    if regimes is None:
        docs = docs.withColumn("market_regime", F.lit(None).cast("string"))
    else:
        docs = docs.join(regimes.select("snapshot_dt", "market_regime"), "snapshot_dt", "left")
    return docs.select(
        "snapshot_dt", F.coalesce("market_regime", F.lit("neutral")).alias("market_regime"), "sector_modifiers", "universe",
        F.transform(F.filter("universe", lambda u: u["score"] >= 80), lambda u: F.struct(u["entity"].alias("entity"))).alias("buy_candidates"),
    )


def write_snapshots(docs: DataFrame, path: str) -> str:
    docs.withColumn("day", F.col("snapshot_dt")).write.mode("overwrite").partitionBy("day").json(path)
    return path


def read_snapshots(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    """Dated documents; corrupt ones are skipped, no document at all is an error. The date comes from
    the folder name when the document lacks one."""
    raw = (
        spark.read.schema(snapshot_schema(key)).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt").json(f"{path}/*")
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    day = F.to_date(F.regexp_extract("_file", r"(\d{4}-\d{2}-\d{2})", 1))
    good = raw.where("_corrupt IS NULL").withColumn("snapshot_dt", F.coalesce("snapshot_dt", day))
    good = good.where("snapshot_dt IS NOT NULL").drop("_corrupt", "_file")
    if not good.limit(1).take(1):
        raise ValueError(f"no readable snapshot below {path}")
    return good


def explode_universe(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(
        "snapshot_dt", "market_regime", "sector_modifiers", F.explode("universe").alias("u")
    ).select("snapshot_dt", "market_regime", "sector_modifiers", "u.*")


def regime_calls(snapshots: DataFrame, as_of: str, window_weeks: int) -> DataFrame:
    """(dt, call): one regime word per document date in a trailing window."""
    day = F.lit(as_of).cast("date")
    rows = snapshots.where((F.col("snapshot_dt") <= day) & (F.col("snapshot_dt") >= F.date_sub(day, 7 * window_weeks)))
    return rows.groupBy(F.col("snapshot_dt").alias("dt")).agg(F.max("market_regime").alias("call"))


def prediction_documents(preds: DataFrame, version: Column, part_size: int = 10_000) -> DataFrame:
    cols = [
        (F.col(f) if f in preds.columns else F.lit(None)).cast(t).alias(f) for f, t in PREDICTION_FIELDS.items()
    ]
    rows = preds.select("dt", version.alias("version_id"), "entity", *cols)
    parts = in_parts(rows, ["dt", "version_id"], part_size)
    return parts.groupBy(F.col("dt").alias("date"), "version_id", "part").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.sort_array(F.collect_list(F.struct("entity", *PREDICTION_FIELDS))).alias("predictions"),
    )


def write_predictions(
    preds: DataFrame, path: str, version_id: str, gate: DataFrame | None = None, part_size: int = 10_000
) -> str:
    """Dated documents plus a copy of the newest date; refused when ``gate`` has a failed row."""
    if gate is not None:
        failed = gate.where("NOT passed").limit(1).take(1)
        if failed:
            raise ValueError(f"predictions refused by the gate: {failed[0].asDict()}")
    docs = prediction_documents(preds, F.lit(version_id), part_size)
    write_dated_latest(docs, path, "date", fmt="json")
    return path


def write_dated_latest(rows: DataFrame, path: str, date_column: str = "dt", fmt: str = "parquet") -> str:
    """One folder per date (others stay untouched) and a mirror of the newest date, which is read back
    from the files just written rather than computed again."""
    spark = rows.sparkSession
    # one file set per date; adaptive execution splits a date that is far larger than the others
    dated = rows.withColumn("_day", F.col(date_column).cast("string")).hint("rebalance", "_day")
    (
        dated.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("_day").save(f"{path}/dated")
    )
    back = spark.read.format(fmt).schema(rows.schema.add("_day", "string")).load(f"{path}/dated")
    newest = back.agg(F.max("_day").alias("d")).first()["d"]
    if newest is not None:
        back.where(F.col("_day") == newest).drop("_day").write.format(fmt).mode("overwrite").save(f"{path}/latest")
    return path


def read_latest(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """The newest dated partition, or the one of ``as_of``."""
    rows = spark.read.parquet(f"{path}/dated")
    if as_of is not None:
        return rows.where(F.col("_day") == as_of).drop("_day")
    newest = rows.agg(F.max("_day").alias("_day"))
    return rows.join(F.broadcast(newest), "_day").drop("_day")


def read_predictions(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    return spark.read.schema(prediction_schema(key)).json(f"{path}/dated/*")


def flatten_predictions(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("date").alias("dt"), "version_id", F.explode("predictions").alias("p"))
    return rows.select("dt", "version_id", "p.*")


def read_existing(spark: SparkSession, path: str, day: str, key: str = KEY) -> DataFrame:
    """Predictions already written for a date; an empty table when there are none."""
    try:
        docs = read_predictions(spark, path, key).where(F.col("date") == F.lit(day).cast("date"))
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        docs = spark.createDataFrame([], prediction_schema(key))
    return flatten_predictions(docs)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The versions found below ``path`` as folders ``version_id=...`` of JSON files, each with its own
    fields; the folder names the version."""
    return spark.read.option("basePath", path).option("recursiveFileLookup", False).json(f"{path}/version_id=*")


def list_versions(catalogue: DataFrame, stage: str | None = None) -> DataFrame:
    """Version catalogue, newest first by (dt, created)."""
    rows = catalogue if stage is None else catalogue.where(F.col("stage") == stage)
    return rows.orderBy(F.col("dt").desc(), F.col("created").desc(), "version_id")


def export_csv(rows: DataFrame, path: str, columns: list[str]) -> str:
    rows.select(*columns).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_nav_csv(spark: SparkSession, path: str) -> DataFrame:
    """(dt, nav) from a CSV whose NAV and date columns are found by name; fewer than two usable rows
    count as absent (empty)."""
    raw = spark.read.option("header", True).csv(path)
    nav = next((c for c in raw.columns if "nav" in c.lower()), None)
    day = next((c for c in raw.columns if "date" in c.lower() or c.lower() == "dt"), None)
    if nav is None or day is None:
        return spark.createDataFrame([], "dt date, nav double")
    rows = raw.select(
        F.expr(f"try_cast(`{day}` as date)").alias("dt"), F.expr(f"try_cast(`{nav}` as double)").alias("nav")
    ).dropna()
    enough = rows.limit(2).count() == 2
    return rows if enough else rows.limit(0)


# --- freshness and manifests --------------------------------------------------------------------


def append_manifest(rows: DataFrame, path: str, run_id: str) -> str:
    """Appends (run_id, dt, n_rows) for every date of ``rows``."""
    counts = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"))
    counts.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
    return path


def upstream_staleness(modules: DataFrame, health: DataFrame, as_of: Column, max_age_hours: float) -> DataFrame:
    """(module, age_hours, stale) for every required module; never seen counts as stale.
    health: (module, ts)."""
    last = health.groupBy("module").agg(F.max("ts").alias("_ts"))
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("_ts")) / 3600.0
    return modules.join(last, "module", "left").select(
        "module", age.alias("age_hours"), F.coalesce(age > max_age_hours, F.lit(True)).alias("stale")
    )


def data_age(prices: DataFrame, as_of: str) -> DataFrame:
    return prices.groupBy("entity").agg(F.max("dt").alias("last_dt")).withColumn(
        "age_days", F.datediff(F.lit(as_of).cast("date"), "last_dt")
    )


def assert_fresh(series: DataFrame, last_session: str) -> None:
    """Raises when the market series ends before the last closed session."""
    newest = series.agg(F.max("dt").alias("d")).first()["d"]
    if newest is None or str(newest) < last_session:
        raise ValueError(f"market series ends {newest}, last session was {last_session}")


def missing_dates(
    written: DataFrame, start: str, end: str, force: bool = False
) -> DataFrame:
    """(dt, status) for every Saturday of a range: to_build, or skipped where output exists."""
    spark = written.sparkSession
    first = F.next_day(F.date_sub(F.lit(start).cast("date"), 1), "SAT")
    days = spark.range(1).select(
        F.explode(F.sequence(first, F.lit(end).cast("date"), F.expr("interval 7 days"))).alias("dt")
    )
    have = written.select("dt").distinct().withColumn("_have", F.lit(True))
    status = F.when(F.col("_have") & F.lit(not force), "skipped").otherwise("to_build")
    return days.join(have, "dt", "left").select("dt", status.alias("status"))
