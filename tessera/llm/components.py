"""Distributed connected components with alternating large-star and small-star steps; DataFrame operations only.

Every edge list is kept as (u, v) with u > v. A large-star step links the larger neighbours of each node to its smallest
neighbour, a small-star step the smaller ones; components end as stars around their smallest node after a number of
rounds that grows with the logarithm of their size. Minima are aggregated before they are shuffled, and nothing is
collected but two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    # the larger neighbours of u are the u-sides of its edges
    return edges.join(least, edges.v == least.w).select(F.col("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionAll(least.select("u", F.col("m").alias("v")))
        .filter("u > v")
        .distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of `edges` (u, v of one orderable type), the smallest node that it reaches.

    Edges with a null end and loops link nothing; repeated edges count once; no edges give an empty result. Nodes
    without edges are not listed: each is its own component."""
    tidy = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), *[F.col(c).isNull().alias(f"no_{c}") for c in "uv"])
    now = materialise(tidy.filter("not no_u and not no_v and u <> v").select("u", "v").distinct(), "edges")
    seen = _digest(now)
    while seen[0]:
        then = now
        now = materialise(_small_star(_large_star(then)), "edges")
        discard(then)
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
