"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared folder that the session names.

    Where the setting is absent (tests), a folder in the session's warehouse, which
    all machines of a cluster share too.
    """
    base = spark.conf.get(SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/ridelake-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` written to a new shared folder and read again: computed once, lineage ends."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Folders directly below `folder`, which may not exist."""
    path, files = _files(spark, folder)
    if not files.exists(path):
        return []
    return [s.getPath().toString() for s in files.listStatus(path) if s.isDirectory()]


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder and what is in it, wherever Spark writes to."""
    path, files = _files(spark, folder)
    files.delete(path, True)
