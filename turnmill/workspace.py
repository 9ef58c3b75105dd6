"""Shared-storage tables that cut lineage between steps of a job.

Iterative operators write intermediate results as Parquet below the folder named
by ``spark.checkpoint.dir``, so a lost executor only replays the current step.
"""

from __future__ import annotations

import atexit
import uuid
import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, else one below the warehouse.

    Both are shared by all executors; a machine-local folder is never chosen here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/turnmill-scratch").rstrip("/")


def write_observed(df: DataFrame, path: str, metrics: Sequence[Column]) -> dict:
    """Write ``df`` and return the aggregates ``metrics`` of what was written, without another scan.

    Empty where the plan was reduced to nothing and no row passed the metrics.
    """
    seen = Observation()
    df.observe(seen, *metrics).write.mode("overwrite").parquet(path)
    return dict(seen.get)


_OPEN: "weakref.WeakSet[Workspace]" = weakref.WeakSet()


class Workspace:
    """A private subfolder of the checkpoint folder holding step tables.

    Lazy results read these tables, so they stay until ``drop`` or the end of the program.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or checkpoint_root(spark)}/turnmill-{uuid.uuid4().hex}"
        self._n = 0
        _OPEN.add(self)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:04d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a reader over the written table."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def observed(self, df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, dict]:
        """Write ``df`` once, as ``table`` does, and return the metrics that were taken on the way."""
        path = self.path(name)
        values = write_observed(df, path, metrics)
        table = self.spark.read.schema(df.schema).parquet(path)
        return table, values or table.agg(*metrics).first().asDict()

    def drop(self) -> None:
        """Delete every table written here; call when no result reads them any more."""
        _OPEN.discard(self)
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)


@atexit.register
def drop_open() -> None:
    """Remove the tables of every open workspace, while its session still runs."""
    for space in list(_OPEN):
        if space.spark.sparkContext._jsc is not None:
            space.drop()
