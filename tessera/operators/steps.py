"""Written steps: a stage that later ones read more than once, or that a rerun should find, is a Parquet table in a shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share; only a session of one machine may do without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/tessera-{what}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def is_whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def move(spark: SparkSession, source: str, target: str) -> bool:
    files, there = _files(spark, source)
    return files.rename(there, _files(spark, target)[1])


def remove(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """`df` as a table at `path`; if a whole one is there already, that one, and nothing is computed."""
    spark = df.sparkSession
    if not is_whole(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
