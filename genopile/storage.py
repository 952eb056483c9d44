"""Intermediate tables in the shared folder the cluster names, and their life cycle."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else the warehouse.

    Both are read from the session.  On a cluster a local path is visible to one machine only,
    so it is refused there when the cluster has named no checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and base.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return base


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{shared_folder(spark)}/genopile/{name}-{uuid.uuid4().hex}"


class Tables:
    """Records the tables that are stored while it is entered, so that they can go together.

    ``with Tables(spark) as made: ...`` around the work that reads them, ``made.release()`` once
    every result of that work is written.  Of nested ones the inner records.
    """

    _open: list[Tables] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Tables:
        Tables._open.append(self)
        return self

    def __exit__(self, *error) -> None:
        Tables._open.remove(self)

    def release(self) -> None:
        _delete(self.spark, self.paths)
        self.paths.clear()


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a table once and read it back, so that its rows and ids are fixed.

    ``compression`` is Parquet's, else the session's.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    if Tables._open:
        Tables._open[-1].paths.append(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once all that is read from them is written."""
    if tables:
        _delete(tables[0].sparkSession, [t.stored_at for t in tables])


def free_shuffles(spark: SparkSession) -> None:
    """Let shuffle files go whose plans are gone; else they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders, and shuffle files of plans that are gone."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    free_shuffles(spark)
