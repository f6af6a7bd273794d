"""Lookups: keep-first, ordered first success, identity tables with three key spaces."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import predicates, text
from tessera.functions.numbers import parse_number


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark keeps a group's rank-1 rows before the shuffle (WindowGroupLimit)."""
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).filter("__nth = 1").drop("__nth")


def dealt(df: DataFrame) -> DataFrame:
    """`df` dealt to all cores: a file is read by as many tasks as it has row groups, often one, which is too few where each row is much work."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def merged(df: DataFrame) -> DataFrame:
    """`df` for a join by a merge, so that neither side goes through the driver: before a query runs, Spark knows the size of its files alone, and
    broadcasts rows that were exploded from a small file, however many they are."""
    return df.hint("merge")


def once_each(df: DataFrame, inputs: list[str], name: str, value: Column, few: bool = False) -> DataFrame:
    """`df` with the column `name`: `value`, which reads only `inputs`, is computed once for each distinct row of these and joined back.

    For values that cost more than a join, of inputs that repeat. Few inputs may still be much work, so they are dealt to all cores.
    They are joined by a merge, unless the inputs are known to be `few`: then Spark may broadcast them."""
    keys = {c: f"__{c}" for c in inputs}
    told = dealt(df.select(*inputs).distinct()).withColumn(name, value).select(*[F.col(c).alias(k) for c, k in keys.items()], name)
    return df.join(told if few else merged(told), reduce(and_, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])).drop(*keys.values())


def top_k(df: DataFrame, keys: list[Column], order: list[Column], k: int) -> DataFrame:
    """The k first rows of each key, with their rank."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def first_success(rows: DataFrame, key: str, candidates: Column, table: DataFrame, table_key: str, values: list[str]) -> DataFrame:
    """(key, query, values) of the first candidate that the table knows; a row without a hit keeps nulls.

    Candidates are exploded with their position, joined with the table on equality, and the hit of smallest position is
    kept by a partial aggregate, so nothing is looped over."""
    tried = rows.select(F.col(key), F.posexplode(candidates).alias("__at", "query"))
    hit = tried.join(table.select(F.col(table_key).alias("query"), *values), "query")
    best = hit.groupBy(key).agg(F.min_by(F.struct("query", *values), F.col("__at")).alias("__best"))
    return rows.select(key).distinct().join(best, key, "left").select(key, F.col("__best.query"), *[F.col(f"__best.{v}").alias(v) for v in values])


def last_wins(log: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """The newest value of each key of an append log."""
    return log.groupBy(key).agg(*[F.max_by(v, order).alias(v) for v in values])


def build_identity(table: DataFrame) -> DataFrame:
    """(space, key, standard, iupac, formula, cid, mw): the lookup of an identity table (row, original, standard, iupac, formula, cid, mw).

    Each row offers four names in order; in each key space (exact, abbr, simplified) the first row and name with a key win."""
    standard = F.coalesce(*[F.nullif(text.norm_text(F.col(c)), F.lit("")) for c in ("standard", "iupac", "original", "formula")])
    named = table.select(
        "row",
        F.coalesce(standard, F.lit("")).alias("standard"),
        *[text.norm_text(F.col(c)).alias(c) for c in ("iupac", "formula", "cid")],
        parse_number(F.col("mw").cast("string")).alias("mw"),
        text.norm_text(F.col("original")).alias("original"),
    )
    names = named.select("*", F.posexplode(F.array("original", "standard", "iupac", "formula")).alias("at", "name")).filter("name <> ''")
    keys = F.array(
        F.struct(F.lit("exact").alias("space"), text.norm_key(F.col("name")).alias("key")),
        F.struct(F.lit("abbr").alias("space"), F.when(predicates.is_short_abbreviation(F.col("name")), text.abbr_key(F.col("name"))).alias("key")),
        F.struct(F.lit("simplified").alias("space"), F.when(predicates.allows_simplified(F.col("name")), text.simplify_key(F.col("name"))).alias("key")),
    )
    spread = names.withColumn("k", F.explode(keys)).filter("k.key is not null and k.key <> ''")
    kept = spread.groupBy("k.space", "k.key").agg(F.min_by(F.struct("standard", "iupac", "formula", "cid", "mw"), F.struct("row", "at")).alias("v"))
    return kept.select("space", "key", "v.*")


def resolve_identity(rows: DataFrame, name: str, lookup: DataFrame, exempt_abbreviations: bool = False) -> DataFrame:
    """`rows` with standard, iupac, formula, cid, mw, identity_source, identity_rejected.

    Short abbreviations are looked up as abbreviations, then exactly; other names exactly, then without separators. A hit
    that is implausible for the name is rejected and the name kept, unless it is an abbreviation and these are exempt.
    The three key spaces are one table joined once on (space, key) pairs in order of priority."""
    n = F.col(name)
    short = predicates.is_short_abbreviation(n)
    pair = lambda space, key: F.struct(F.lit(space).alias("space"), key.alias("key"))
    tries = F.when(short, F.array(pair("abbr", text.abbr_key(n)), pair("exact", text.norm_key(n)))).otherwise(
        F.array(pair("exact", text.norm_key(n)), pair("simplified", text.simplify_key(n)))
    )
    columns = ["standard", "iupac", "formula", "cid", "mw"]
    # all that is told depends on the name alone, so it is found and judged once for each distinct name
    names = rows.select(n).distinct()
    tried = names.select(n.alias("__name"), F.posexplode(tries).alias("at", "k")).select("__name", "at", "k.space", "k.key").filter("key <> ''")
    hit = tried.join(merged(lookup), ["space", "key"]).groupBy("__name").agg(F.min_by(F.struct("space", *columns), F.col("at")).alias("hit"))
    joined = names.join(merged(hit), n == F.col("__name"), "left").drop("__name")
    blank = text.norm_text(n) == ""
    found = F.when(~blank, F.col("hit"))
    source = (
        F.when(blank, "EMPTY_SOLUTE")
        .when(found["space"] == "abbr", "IDENTITY_TABLE_ABBR_EXACT")
        .when(found["space"] == "exact", "IDENTITY_TABLE_EXACT")
        .when(found["space"] == "simplified", "IDENTITY_TABLE_SIMPLIFIED")
        .when(short, "UNRESOLVED_ABBREVIATION")
        .otherwise("UNRESOLVED")
    )
    verdict = predicates.identity_verdict(n, found["standard"], found["iupac"], found["formula"])
    rejected = found.isNotNull() & ~verdict.startswith("ok_")
    if exempt_abbreviations:
        rejected &= found["space"] != "abbr"
    out = joined.withColumns({"identity_rejected": F.coalesce(rejected, F.lit(False)), "identity_source": source})
    keep = F.col("hit").isNotNull() & ~F.col("identity_rejected")
    resolved = out.select(
        n.alias("__name"),
        "identity_rejected",
        F.when(F.col("identity_rejected"), "IDENTITY_TABLE_REJECTED_SIMILARITY").otherwise(F.col("identity_source")).alias("identity_source"),
        F.when(keep, F.col("hit.standard")).otherwise(text.norm_text(n)).alias("standard"),
        *[F.when(keep, F.col(f"hit.{c}")).otherwise("").alias(c) for c in ("iupac", "formula", "cid")],
        F.when(keep, F.col("hit.mw")).alias("mw"),
    )
    told = [c for c in resolved.columns if c != "__name"]
    return rows.drop(*told).join(merged(resolved), n.eqNullSafe(F.col("__name"))).drop("__name")


def fuzzy_identity(names: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """(name, original): exact match, else the first table row that contains the name or lies in it. `table` (row, original) must
    be small: it is broadcast only if Spark's own size check allows it, and compared with distinct names."""
    n, o = text.norm_key(F.col(name)), text.norm_key(F.col("original"))
    each = names.select(name).distinct().withColumn("__n", n).filter("__n <> ''")
    known = table.select("row", "original", o.alias("__o")).filter("__o <> ''")
    met = each.join(known, F.expr("__n = __o or contains(__n, __o) or contains(__o, __n)"))
    return met.groupBy(name).agg(F.min_by("original", F.struct((F.col("__n") != F.col("__o")).cast("int"), "row")).alias("original"))
