"""Caches of answers as versioned tables: a merge with what is there, where the newest entry of a key wins, and a swap.

A version is a table under `data` and a pointer file `v-<number>` with its name. A writer reads the newest version, writes the
merged table, and then publishes it by renaming a finished pointer to the next number, which fails if that number is taken.
Readers see the old version until then. A writer that dies leaves a table that nothing points to; one that comes second
merges again with what the first one wrote. Applying the same entries again changes nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import steps

SCHEMA = "key string, value string, seq bigint"
#: Times that a writer merges again because another one was first.
RETRIES = 20


def _jvm(spark: SparkSession, folder: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, folder: str) -> list[int]:
    hadoop, files = _jvm(spark, folder)
    if not files.exists(hadoop.Path(folder)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(hadoop.Path(folder))]
    return sorted(int(n[2:]) for n in names if n.startswith("v-"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """key, value, seq of the newest version; empty without any."""
    versions = _versions(spark, folder)
    if not versions:
        return spark.createDataFrame([], SCHEMA)
    table = spark.read.text(f"{folder}/v-{versions[-1]}").first()[0]
    return spark.read.schema(SCHEMA).parquet(f"{folder}/{table}")


def newest(entries: DataFrame) -> DataFrame:
    """One entry a key: that of the largest seq, and of equals the largest value. Null keys are left out."""
    return entries.filter("key is not null").groupBy("key").agg(F.max_by("value", F.struct("seq", "value")).alias("value"), F.max("seq").alias("seq"))


def upsert(entries: DataFrame, folder: str) -> int:
    """Merge `entries` (key, value, seq) into the cache; the number of the version that has them."""
    spark = entries.sparkSession
    hadoop, files = _jvm(spark, folder)
    some = entries.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("seq").cast("bigint"))
    for _ in range(RETRIES):
        last = max(_versions(spark, folder), default=0)
        table = f"data/{uuid.uuid4().hex}"
        newest(read(spark, folder).unionByName(some)).write.parquet(f"{folder}/{table}")
        if publish(spark, folder, table, last + 1):
            return last + 1
        steps.remove(spark, f"{folder}/{table}")
    raise RuntimeError(f"other writers were first {RETRIES} times")


def publish(spark: SparkSession, folder: str, table: str, version: int) -> bool:
    """Point version `version` to a table; False if that version is there already."""
    hadoop, files = _jvm(spark, folder)
    draft, target = hadoop.Path(f"{folder}/draft-{uuid.uuid4().hex}"), hadoop.Path(f"{folder}/v-{version}")
    out = files.create(draft, False)
    out.write(bytearray(table.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        files.delete(draft, False)
        return False
    return True


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a cache that is one JSON object in a file; a missing or broken file is an empty cache."""
    empty = spark.createDataFrame([], "key string, value string")
    if not steps.exists(spark, path):
        return empty
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("m"))
    return whole.select(F.explode("m").alias("key", "value"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of JSON logs as columns with `place`, an order of lines: file, block of the file, line in it. Broken lines are left out.

    A block's lines are rows of one task in their order, so a running number tells them apart."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    place = F.struct(F.col("file_path").alias("file"), F.col("file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    parsed = lines.select(place.alias("place"), F.from_json("value", schema).alias("x"), "value")
    return parsed.filter(F.try_parse_json("value").isNotNull()).select("x.*", "place")
