"""Sinks: workbook parts as directories, cell sanitation, checks, reports, resumable checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
MARKER = " ...[truncated]"


def sanitize(c: Column, most: int = 32_000) -> Column:
    """No control characters; text over `most` characters is cut 48 before the limit and marked."""
    t = F.regexp_replace(c, ILLEGAL, "")
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 48), F.lit(MARKER))).otherwise(t)


def sanitize_table(df: DataFrame, most: int = 32_000) -> DataFrame:
    """Every text column sanitised; arrays, maps and structs become JSON."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "string":
            out[name] = sanitize(F.col(name), most)
        elif kind.startswith(("array", "map", "struct")):
            out[name] = sanitize(F.to_json(F.col(name)), most)
    return df.withColumns(out)


def bad_cells(df: DataFrame, key: str, most: int = 32_000) -> DataFrame:
    """(key, column, problem) of cells with illegal characters or too much text."""
    columns = [c for c, kind in df.dtypes if kind == "string" and c != key]
    long = df.unpivot([key], columns, "column", "cell")
    problem = F.when(F.col("cell").rlike(ILLEGAL), "illegal_character").when(F.length("cell") > most, "too_long")
    return long.select(key, "column", problem.alias("problem")).filter("problem is not null")


def grid_warnings(df: DataFrame, rows: int = 1_048_576, columns: int = 16_384) -> list[str]:
    """What exceeds a spreadsheet's grid."""
    out = []
    if len(df.columns) > columns:
        out.append(f"{len(df.columns)} columns exceed {columns}")
    if (n := df.count()) > rows:
        out.append(f"{n} rows exceed {rows}")
    return out


def write_workbook(sheets: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """A directory for each sheet, in order."""
    for name, df in sheets.items():
        writer = sanitize_table(df).write.mode("overwrite")
        writer.option("header", True).csv(f"{path}/{name}") if fmt == "csv" else writer.parquet(f"{path}/{name}")


def partition_by_status(df: DataFrame, status: str, path: str) -> None:
    """One directory for each status; a reader of one status reads nothing else."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def append_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def pending(df: DataFrame, key: str, path: str) -> DataFrame:
    """Rows that a checkpoint does not hold yet; all, if there is none."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return df
    return df.join(spark.read.parquet(path).select(key), key, "left_anti")


def report(df: DataFrame, status: str) -> str:
    """Row count and counts by status as JSON."""
    counts = df.groupBy(status).agg(F.count("*").alias("n"))
    return counts.agg(F.to_json(F.struct(F.sum("n").alias("rows"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(status, "n")))).alias("status")))).first()[0]
