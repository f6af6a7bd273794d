"""Compounds from registries: the best of several numbers for a name, and names that only a second service can translate.

Services are tables. A service row with a null answer is a negative answer that was kept: it ends the search in that
service like a missing row. Each hop is one equi-join of what is still open; nothing is looped over but the services."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import text

#: Numbers that a name is given at most, in order; what a compound without a name scores, and one whose name holds the query gains.
MOST, UNNAMED, HOLDS = 10, 0.15, 0.08
#: Length from which the exact ratio treats frequent letters as noise, so that no bound of it is known.
NOISY = 200


def best_number(asked: DataFrame, keys: list[str], query: str, numbers: str, properties: DataFrame) -> DataFrame:
    """`keys`, cid, iupac, formula, score: of each row's first MOST numbers the one whose name is most like the query, the first of equals.

    `properties` has cid, iupac, formula. The exact ratio is computed last: a ratio is at most 2 * shorter / both lengths, and just
    that where one name lies in the other, so rows that cannot reach a score that is known already go before it.
    A row's numbers are at most MOST, so the best of them is found in a window and not joined back."""
    tried = asked.select(*keys, F.lower(F.col(query)).alias("q"), F.posexplode(F.slice(F.col(numbers), 1, MOST)).alias("at", "cid"))
    # sorted, since a side that looks small in a shuffle's compressed blocks would be collected and hashed by the driver
    known = tried.join(properties.select("cid", "iupac", "formula").hint("merge"), "cid").withColumn("name", F.lower(F.coalesce("iupac", F.lit(""))))
    a, b = F.length("q"), F.length("name")
    bound = 2.0 * F.least(a, b) / F.greatest(a + b, F.lit(1))
    holds = F.when(F.contains("name", F.col("q")), HOLDS).otherwise(0.0)
    sure = F.when(F.col("name") == "", UNNAMED).when((F.contains("name", F.col("q")) | F.contains("q", F.col("name"))) & (a < NOISY) & (b < NOISY), bound + holds)
    rated = known.withColumns({"sure": sure, "most": F.coalesce(sure, bound + holds), "holds": holds})
    reached = F.max("sure").over(W.partitionBy(*keys))
    left = rated.withColumn("reached", reached).filter(F.coalesce(F.col("most") >= F.col("reached"), F.lit(True)))
    open_ = F.col("sure").isNull()
    ratio = text.similarity(F.when(open_, F.col("q")), F.when(open_, F.col("name")))
    every = left.withColumn("ratio", ratio).withColumn("score", F.coalesce("sure", F.col("ratio") + F.col("holds")))
    best = every.groupBy(*keys).agg(F.max_by(F.struct("cid", "iupac", "formula", "score"), F.struct("score", -F.col("at"))).alias("x"))
    return best.select(*keys, "x.*")


def resolve_deep(names: DataFrame, row: str, candidates: str, services: list[tuple[str, DataFrame]], numbers: DataFrame, properties: DataFrame) -> DataFrame:
    """(row, status, source, query, cid, iupac, formula) of names (row, candidates: array of spellings) that no registry knew.

    The services (label, table of name and structure) are asked one after another, each only for the rows that are still
    open; the structure is the key of `numbers` (structure, cids), and of those the best is taken. In one service the first
    spelling that leads to a compound counts."""
    open_, found = names.select(F.col(row).alias("row"), F.col(candidates).alias("tries")), None
    for label, service in services:
        tried = open_.select("row", F.posexplode("tries").alias("place", "query"))
        structures = tried.join(service.filter("structure is not null").select(F.col("name").alias("query"), "structure"), "query")
        numbered = structures.join(numbers.select("structure", "cids"), "structure")
        best = best_number(numbered.select("row", "place", "query", "cids"), ["row", "place", "query"], "query", "cids", properties)
        hit = best.groupBy("row").agg(F.min_by(F.struct("query", "cid", "iupac", "formula"), "place").alias("x")).select("row", F.lit(label).alias("source"), "x.*")
        found = hit if found is None else found.unionByName(hit)
        open_ = open_.join(hit.select("row"), "row", "left_anti")
    status = F.when(F.col("cid").isNotNull(), "FOUND").otherwise("FAILED")
    return names.select(F.col(row).alias("row")).join(found, "row", "left").select("row", status.alias("status"), "source", "query", "cid", "iupac", "formula")
