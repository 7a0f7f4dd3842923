"""Fold tables (fold_id, dt, role) from the distinct dates; their size is bounded by the calendar."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_index(rows: DataFrame, dt: str = "dt", by: list[str] | None = None) -> DataFrame:
    """(by, dt, idx, n_rows, n_dates) with a dense zero-based index."""
    dates = rows.groupBy(*(by or []), dt).agg(F.count(F.lit(1)).alias("n_rows"))
    whole = Window.partitionBy(*(by or [F.lit(1)]))
    return dates.withColumns(
        {"idx": F.row_number().over(whole.orderBy(dt)) - 1, "n_dates": F.count(F.lit(1)).over(whole)}
    )


def walk_forward_folds(
    rows: DataFrame, test_window: int, min_train: int, purge: int, min_train_rows: int = 1000,
    min_test_rows: int = 100, dt: str = "dt",
) -> DataFrame:
    """Growing train, consecutive test windows. A last window under half size is left out, and so
    are folds with too few dates or rows."""
    dates = date_index(rows, dt)
    size = dates.agg(F.max("n_dates").alias("_n"))
    starts = size.select(
        "_n",
        F.explode(F.sequence(F.lit(0), F.greatest(F.floor((F.col("_n") - min_train - 1) / test_window), F.lit(0)))).alias("k"),
    ).withColumn("_s", (F.col("k") * test_window + min_train).cast("int"))
    starts = starts.where(
        (F.col("_s") < F.col("_n"))
        & (F.col("_n") - F.col("_s") >= test_window // 2)
        & (F.col("_s") - purge >= min_train // 2)
    )
    cells = dates.crossJoin(F.broadcast(starts))
    role = F.when(F.col("idx").between(F.col("_s"), F.col("_s") + test_window - 1), "test").when(
        F.col("idx") <= F.col("_s") - purge, "train"
    )
    cells = cells.withColumn("role", role).where("role IS NOT NULL")
    fold = Window.partitionBy("k")

    def total(which: str):
        return F.sum(F.when(F.col("role") == which, F.col("n_rows")).otherwise(0)).over(fold)

    cells = cells.withColumns({"_tr": total("train"), "_te": total("test")}).where(
        (F.col("_tr") >= min_train_rows) & (F.col("_te") >= min_test_rows)
    )
    number = F.dense_rank().over(Window.partitionBy(F.lit(1)).orderBy("k")) - 1
    return cells.select(number.alias("fold_id"), dt, "role")


def expanding_folds(
    rows: DataFrame, forward: int, embargo: int | None = None, n_folds: int = 5, min_test: int = 21,
    dt: str = "dt", by: list[str] | None = None,
) -> DataFrame:
    """The last dates cut into equal test blocks; train is everything before, purged by ``forward``
    dates. Short histories get fewer folds. An embargo (default: the horizon) removes train dates
    after a test block, which never occur here. ``by`` names keys that have dates of their own."""
    by = by or []
    dates = date_index(rows, dt, by)
    m = max(min_test, 1)
    size = dates.groupBy(*by).agg(F.max("n_dates").cast("int").alias("_n"))
    shrunk = F.greatest(F.lit(1), F.floor(F.col("_n") / m).cast("int") - 1)
    size = size.withColumn("_f", F.when(F.col("_n") < (n_folds + 1) * m, shrunk).otherwise(n_folds))
    size = size.withColumn("_t", F.greatest(F.lit(min_test), F.floor(F.col("_n") / (F.col("_f") + 1)).cast("int")))
    folds = size.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_f") - 1))).withColumn(
        "_s", F.col("_n") - (F.col("_f") - F.col("k")) * F.col("_t")
    )
    folds = folds.withColumn("_e", F.least(F.col("_s") + F.col("_t"), F.col("_n"))).where(
        (F.col("_s") - forward > min_test) & (F.col("_e") - F.col("_s") >= 2)
    )
    # a handful of folds per key
    cells = dates.join(F.broadcast(folds), by) if by else dates.crossJoin(F.broadcast(folds))
    role = F.when((F.col("idx") >= F.col("_s")) & (F.col("idx") < F.col("_e")), "test").when(
        F.col("idx") < F.col("_s") - forward, "train"
    )
    return cells.select(*by, F.col("k").alias("fold_id"), dt, role.alias("role")).where("role IS NOT NULL")


def cpcv_folds(
    rows: DataFrame, forward: int, embargo: int | None = None, n_groups: int = 6, k_test: int = 2,
    dt: str = "dt",
) -> DataFrame:
    """Every choice of ``k_test`` of the contiguous date groups as test; train leaves out the dates
    from ``forward`` before to ``embargo`` after each of them."""
    embargo = forward if embargo is None else embargo
    dates = date_index(rows, dt)
    spark = rows.sparkSession
    combos = list(combinations(range(n_groups), k_test))
    table = spark.createDataFrame(
        [(i, g) for i, c in enumerate(combos) for g in c], "fold_id int, g int"
    )
    n = dates.agg(F.max("n_dates").alias("_n"))
    spans = table.crossJoin(F.broadcast(n)).select(
        "fold_id",
        F.floor(F.col("g") * F.col("_n") / n_groups).alias("_a"),
        (F.floor((F.col("g") + 1) * F.col("_n") / n_groups) - 1).alias("_b"),
    )
    # a fold's test spans as an array: dates x folds stays the size of the result
    spans = spans.groupBy("fold_id").agg(F.collect_list(F.struct("_a", "_b")).alias("_spans"))
    cells = dates.crossJoin(F.broadcast(spans))
    inside = F.exists("_spans", lambda s: (F.col("idx") >= s["_a"]) & (F.col("idx") <= s["_b"]))
    near = F.exists(
        "_spans",
        lambda s: (F.col("idx") >= s["_a"] - forward) & (F.col("idx") <= s["_b"] + embargo),
    )
    role = F.when(inside, "test").when(~near, "train")
    return cells.select("fold_id", dt, role.alias("role")).where("role IS NOT NULL")


def time_split(rows: DataFrame, train: float = 0.70, val: float = 0.15, dt: str = "dt") -> DataFrame:
    """(dt, role): whole dates by the position of their first row in date order."""
    dates = date_index(rows, dt)
    earlier = Window.partitionBy(F.lit(1)).orderBy(dt).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    dates = dates.withColumns(
        {"_p": F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)), "_t": F.sum("n_rows").over(whole)}
    )
    role = (
        F.when(F.col("_p") < F.floor(F.col("_t") * train), "train")
        .when(F.col("_p") < F.floor(F.col("_t") * (train + val)), "val").otherwise("test")
    )
    return dates.select(dt, role.alias("role"))
