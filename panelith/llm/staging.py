"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelith.session import scratch_path


class Stage:
    """Writes intermediate tables below ``spark.checkpoint.dir`` and removes those no longer needed.

    A written table is computed once, survives any executor and tells the planner its size. ``drop``
    removes a table once whatever was derived from it has itself been written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        # keeps the frame alive, so that its id stays its own
        self.__dict__.setdefault("frames", []).append(back)
        return back

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for frame in frames:
            path = self.paths.pop(id(frame), None)
            if path:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)


def spread_count(spark: SparkSession) -> int:
    """Partitions for a shuffle whose rows cost more CPU than their bytes suggest."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` has them (names are compared without case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
