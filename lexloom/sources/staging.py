"""Intermediate tables in the shared folder of the cluster.

A table that several jobs read is written once and read back: its lineage ends there, it
needs no executor memory, and losing executors does not lose it. A table is removed by
`drop` once nothing reads it any more; what a returned table still reads goes when the
Python process of the driver ends. The shuffle files behind a table go as soon as it is
written, not when the driver happens to collect its garbage.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_left_at_exit: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; where the session names none, its warehouse."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get(WAREHOUSE_DIR)).rstrip("/")


def application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lexloom/{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; absent ones are fine."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before, in a folder of this application's own."""
    folder = application_dir(spark)
    if folder not in _left_at_exit:
        _left_at_exit.add(folder)
        atexit.register(_remove_at_exit, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        remove(spark, folder)
    except Exception:  # noqa: BLE001  the session has ended, and its JVM with it
        pass


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: they go when their query has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and return a scan of it."""
    return Staging(df.sparkSession).write(df, name, by)


class Staging:
    """The staged tables of one operator; on leaving the `with` block all of them go.

    A table that a returned, still unread DataFrame needs is written by `stage` instead.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        path = new_path(self.spark, name)
        with shuffles_removed(self.spark):
            (df.write.partitionBy(*by) if by else df.write).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = (table, path)
        return table

    def drop(self, table: DataFrame) -> None:
        """Remove a table that `write` returned."""
        _, path = self._paths.pop(id(table))
        remove(self.spark, path)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *raised) -> None:
        for table, _ in list(self._paths.values()):
            self.drop(table)
