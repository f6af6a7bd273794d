"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Contract remainder: rows whose crc32(doc_id as text) mod 5 is 0 are held out from every fit.
FOLDS = 5


#: Rows of an Arrow batch: texts are long, and a batch lies in the executor, on its way and in the worker at once.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ARROW_ROWS rows, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session of one machine gets
    a temporary folder, and a cluster an error: a folder of one of its machines would be lost to the others."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame, what: str = "step") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/tessera/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame | None) -> None:
    """Delete the files of a materialised step that nothing reads any more."""
    if df is None:
        return
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def bloom_joins(spark: SparkSession) -> Iterator[None]:
    """Joins planned meanwhile send only rows through a shuffle that a Bloom filter of the smaller side's keys lets through.

    Spark does this by itself for sides of the default sizes; here it holds from the first byte. The filter has 8 MB at
    most (spark.sql.optimizer.runtime.bloomFilter.maxNumBits): beyond that it lets more rows through, never fewer."""
    names = ("applicationSideScanSizeThreshold", "creationSideThreshold")
    keys = [f"spark.sql.optimizer.runtime.bloomFilter.{n}" for n in names]
    before = [spark.conf.get(k) for k in keys]
    for key, value in zip(keys, ("0", "256m"), strict=True):
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are written: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def held_out(doc_id: str = "doc_id"):
    """True for the rows that no model may learn from; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """One (doc_id, label) row per labelled document: null ids and labels go, the larger of several labels stays."""
    return (
        labels.select(F.col("doc_id"), F.col(column).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, bound: int) -> list[tuple[int, str, int]]:
    """At most `bound` labelled (doc_id, whole text, label) rows that are not held out, in doc_id order.

    The ids with the smallest hashes are taken, from the narrow labels table alone, so the choice is the same on every
    run and at every size; their count bounds what is broadcast and what reaches the driver. Of several rows with one id
    the executors keep the smallest text."""
    ids = (
        one_label(labels, column)
        .filter(~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter(F.col("text").isNotNull())
    rows = found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    return sorted((int(r["doc_id"]), r["text"], int(r["label"])) for r in rows)


def behind_plain_names(docs: DataFrame, step: Callable[[DataFrame], DataFrame], appended: Iterable[str]) -> DataFrame:
    """`step` applied to `docs`, with columns that are named like one it appends under generated names meanwhile; of its
    result the columns of `docs` come out, as they were."""
    taken = {c.lower() for c in appended}
    names = {c: f"__kept_{i}" if c.lower() in taken else c for i, c in enumerate(docs.columns)}
    out = step(docs.toDF(*names.values()))
    return out.select(*[F.col(hidden).alias(c) for c, hidden in names.items()])


def id_text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each Arrow batch with its `text` column as Python strings, null as ''.

    A worker process lives on after its task: what this one has freed goes back to the machine at its end."""
    try:
        for batch in batches:
            yield batch, [t or "" for t in batch.column("text").to_pylist()]
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the C library of most Linux machines has it
            trim(0)
