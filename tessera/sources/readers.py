"""Sources: tables in several encodings, zip archives of documents, append logs."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import norm_key, norm_text

ENCODINGS = ["utf-8-sig", "utf-8", "gbk", "gb18030", "latin-1"]


def decode(data: bytes) -> str:
    """The text under the first encoding that fits the whole of it."""
    for encoding in ENCODINGS:
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "ignore")


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A table of text columns; a single column of a tab-separated file is read again with tabs."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).option("quote", '"').option("escape", '"')
    df = reader.csv(path)
    return reader.option("sep", "\t").csv(path) if len(df.columns) == 1 and "\t" in df.columns[0] else df


def separator(header: str) -> str:
    """A tab where a header line has tabs and no comma, else a comma."""
    return "\t" if "\t" in header and "," not in header else ","


def read_csv_any(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all files under a path as text columns, each file in the first encoding that decodes it, with its own separator.

    A file is one record of one task. Headers are aligned by name: the columns are those of all files in the order in which they are
    first met, by file name and place, and a file without a column has nulls there; cells beyond a header are left out. The
    names of columns are all that reaches the driver."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"], strict=True):
                text = decode(bytes(data)).removeprefix("\ufeff")
                lines = csv.reader(io.StringIO(text), delimiter=separator(text.partition("\n")[0]))
                header = [h.strip() for h in next(lines, [])]
                held: list[dict] = []
                for line in lines:
                    if line:
                        held.append(dict(zip(header, line, strict=False)))
                    if len(held) == 5000:
                        yield pd.DataFrame({"file": file, "header": [header] * len(held), "cells": held})
                        held = []
                yield pd.DataFrame({"file": file, "header": [header] * len(held), "cells": held}) if held else pd.DataFrame({"file": [file], "header": [header], "cells": [None]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parsed = files.mapInPandas(rows, "file string, header array<string>, cells map<string,string>")
    named = parsed.select("file", "header").distinct().select("file", F.posexplode("header").alias("at", "name")).filter("name <> ''")
    names = named.groupBy("name").agg(F.min(F.struct("file", "at")).alias("first")).orderBy("first").select("name").collect()
    return parsed.filter("cells is not null").select(*[F.col("cells")[r["name"]].alias(r["name"]) for r in names])


def read_table(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """By suffix: csv, parquet, or a spreadsheet (which needs its reader library on the driver)."""
    low = path.lower()
    if low.endswith(".csv"):
        return read_csv_any(spark, path)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet, dtype=str).fillna(""))


def read_sheets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Every sheet that has columns."""
    return {name: spark.createDataFrame(df.fillna("")) for name, df in pd.read_excel(path, sheet_name=None, dtype=str).items() if len(df.columns)}


def read_archive(spark: SparkSession, path: str, suffix: str = ".md") -> DataFrame:
    """(archive, member, text) of the documents in zip files, each archive by one task, each member whole."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, data in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
                    for name in z.namelist():
                        if name.lower().endswith(suffix):
                            yield pd.DataFrame({"archive": [archive], "member": [name], "text": [decode(z.read(name))]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(members, "archive string, member string, text string")


def read_log(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The newest line of each key of JSON lines, by file and position."""
    lines = spark.read.schema(schema).json(path).withColumn("__at", F.monotonically_increasing_id())
    columns = [c for c in lines.columns if c not in (key, "__at")]
    return lines.groupBy(key).agg(*[F.max_by(c, "__at").alias(c) for c in columns])


def find_column(df: DataFrame, aliases: list[str]) -> str | None:
    """The column whose normalised name equals an alias, else one that contains it or lies in it."""
    fold = lambda s: " ".join(s.lower().split())
    by_name = {fold(c): c for c in df.columns}
    for alias in aliases:
        if fold(alias) in by_name:
            return by_name[fold(alias)]
    for alias in aliases:
        for name, column in by_name.items():
            if name and (fold(alias) in name or name in fold(alias)):
                return column
    return None


def first_nonblank(df: DataFrame, columns: list[str]):
    """The first of the columns that is not blank, else ''."""
    there = [F.nullif(norm_text(F.col(c)), F.lit("")) for c in columns if c in df.columns]
    return F.coalesce(*there, F.lit(""))


def named_rows(df: DataFrame, aliases: list[str], index: str) -> DataFrame:
    """(index, name) of the rows that have a name; the index is a column of the table."""
    column = find_column(df, aliases) or df.columns[0]
    return df.select(F.col(index), norm_text(F.col(column)).alias("name")).filter(~norm_key(F.col("name")).isin("", "nan"))
