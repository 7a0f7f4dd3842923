"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: shuffle files of an execution go when it ends, not when the driver happens to collect its garbage
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName("panelith")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (a local test session) gets one of its own.
    """
    configured = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(
        CHECKPOINT_KEY, None
    )
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelith-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def session_dir(spark: SparkSession) -> str:
    """This session's own folder below the shared one. It goes when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/panelith-{spark.sparkContext.applicationId}"
    if path not in _OWN:
        _OWN.add(path)
        atexit.register(clear_scratch, spark)
    return path


_OWN: set[str] = set()


def clear_scratch(spark: SparkSession) -> None:
    """Removes what queries of this session have staged; results not yet read are lost with it."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's folder."""
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes the rows below the shared folder and reads them back.

    For inputs that several branches of one plan use: they are computed once, the files outlive any
    executor, and their sizes are known to the planner (join strategies are chosen from them). What was shuffled for
    the write alone goes with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP_KEY) if before is None else spark.conf.set(CLEANUP_KEY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Removes the files of staged rows that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        own = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
        fs = own.getFileSystem(spark._jsc.hadoopConfiguration())
        top = fs.makeQualified(own).toUri().getPath() + "/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if target.toUri().getPath().startswith(top):
                fs.delete(target, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions for per-group Python work. The number is given explicitly because adaptive
    coalescing sizes partitions by bytes, which starves CPU-bound steps on compact rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
