"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, or below the warehouse where that is unset.

    It goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete their shuffle files as soon as they are through: what follows reads what they wrote."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame) -> DataFrame:
    """The rows of `df`, computed once and read back: later steps don't repeat its work."""
    path = shared_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table(folder: str) -> str:
    return folder.replace("-", "_")


def bucketed(df: DataFrame, buckets: int, keys: list[str]) -> DataFrame:
    """The rows of `df`, computed once, bucketed and sorted by `keys`: such tables of equal buckets meet without a shuffle."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    name = _table(path.rsplit("/", 1)[1])
    with shuffles_freed(spark):
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def remove(df: DataFrame) -> None:
    """Delete the files of a `written` table that nothing needs any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        spark.sql(f"drop table if exists `{_table(folder.getName())}`")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
