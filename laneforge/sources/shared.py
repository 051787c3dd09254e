"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``; without it this raises an error there. On one machine
    (tests) a temporary folder is made where it is unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if named:
        if current.isEmpty():
            context.setCheckpointDir(named)
        return named
    if current.isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    store, path = file_system(spark, folder)
    store.deleteOnExit(path)
    return folder


def file_system(spark: SparkSession, folder: str):
    """The store that holds ``folder``, and ``folder`` as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern finds, sorted."""
    store, path = file_system(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in store.globStatus(path) or ())


def remove(spark: SparkSession, folder: str) -> None:
    store, path = file_system(spark, folder)
    store.delete(path, True)


def move(spark: SparkSession, folder: str, target: str) -> None:
    """Renames a folder; what lay at ``target`` is removed."""
    store, path = file_system(spark, folder)
    there = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.delete(there, True)
    store.mkdirs(there.getParent())
    if not store.rename(path, there):
        raise OSError(f"{folder} can't be moved to {target}")


class Owner:
    """Tables in the shared folder that go when their owner is closed, as a context manager or by ``close``.

    What is never closed goes when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._folders = spark, []

    def stored(self, df: DataFrame, name: str = "rows") -> DataFrame:
        folder = scratch(self._spark, name)
        self._folders.append(folder)
        return written(df, folder)

    def close(self) -> None:
        while self._folders:
            remove(self._spark, self._folders.pop())

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.close()


def written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written to the shared folder and read from there.

    Its work is done once however many branches read it, an executor's loss doesn't undo it, and the planner knows its size.
    """
    return written(df, scratch(df.sparkSession, name))
