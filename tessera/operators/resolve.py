"""Name resolution against provider tables, and merging what was traced in documents.

External services are tables here: a provider is a DataFrame keyed by query; an empty one is the mode without a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays, fixed, predicates, text
from tessera.operators.lookup import first_success


def resolve(names: DataFrame, row: str, name: str, registry: DataFrame) -> DataFrame:
    """(row, status, category, query, cid, formula): SKIPPED with its class, FOUND by the first candidate the registry knows, else FAILED.

    `registry` has name_key, cid, formula; candidates are looked up by their lower-case text. Each distinct name is resolved once."""
    each = names.select(text.or_empty(F.col(name)).alias("__raw")).distinct().withColumn("name", text.unify_ascii(F.col("__raw")))
    judged = each.withColumn("skip", predicates.skip_class(F.col("name")))
    tried = judged.filter("skip is null").select("__raw", F.transform(text.candidate_names(F.col("__raw")), lambda x: F.lower(x)).alias("tries"))
    found = first_success(tried, "__raw", F.col("tries"), registry, "name_key", ["cid", "formula"])
    status = F.when(F.col("skip").isNotNull(), "SKIPPED").when(F.col("cid").isNotNull(), "FOUND").otherwise("FAILED")
    failed = F.when(F.col("name").rlike(r"^[A-Z0-9\-]{2,10}$"), "ABBREVIATION_ONLY").otherwise("NOT_FOUND_FAST")
    told = judged.join(found, "__raw", "left").withColumn("status", status)
    told = told.select("__raw", "status", F.coalesce("skip", F.when(F.col("status") == "FAILED", failed), F.lit("")).alias("category"), "query", "cid", "formula")
    return names.select(F.col(row).alias("row"), text.or_empty(F.col(name)).alias("__raw")).join(told, "__raw").drop("__raw")


def enrich(names: DataFrame, row: str, name: str, code: Column, registry: DataFrame) -> DataFrame:
    """Records of each name by its category code: one single entity, the parts of a mixture, an abbreviation, or a non-entity.

    (row, record_type, rank, query, status, cid): mixtures are split and each part is looked up; single entities too."""
    n = text.norm_text_doc(F.col(name))
    forced = predicates.forced_mixture(F.col(name)) != ""
    kind = (
        F.when(code.isin("PROCESS", "NON_ENTITY") | predicates.is_non_entity(F.col(name)), "non_entity")
        .when((code == "MIXTURE") | forced, "mixture_component")
        .when((code == "ABBR") | predicates.is_valid_abbreviation(n), "abbr_candidate")
        .otherwise("single_entity")
    )
    typed = names.select(F.col(row).alias("row"), n.alias("name"), kind.alias("record_type"), code.alias("code"))
    parts = F.when(F.col("record_type") == "mixture_component", F.transform(arrays.mixture_parts(F.col("name")), lambda s: s["name"])).otherwise(F.array(F.col("name")))
    records = typed.select("row", "record_type", "code", F.posexplode(parts).alias("at", "query")).withColumn("rank", F.col("at") + 1).drop("at")
    hit = registry.groupBy("name_key").agg(F.min("cid").alias("cid"))
    joined = records.join(hit, F.lower(F.col("query")) == F.col("name_key"), "left")
    status = (
        F.when(F.col("record_type") == "non_entity", "SKIP_NON_ENTITY")
        .when(F.col("query") == "", "EMPTY_QUERY")
        .when(F.col("code") == "POLYMER", "Polymer")
        .when(F.col("cid").isNotNull(), "OK")
        .otherwise("NO_HIT")
    )
    return joined.select("row", "record_type", "rank", "query", status.alias("status"), F.when(status == "OK", F.col("cid")).alias("cid"))


def report(records: DataFrame) -> DataFrame:
    """(metric, value): records by type and by status."""
    grouped = records.groupingSets([["record_type"], ["status"]], "record_type", "status").agg(F.count("*").alias("value"))
    return grouped.select(F.coalesce("record_type", "status").alias("metric"), "value")


def status_rank(status: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*reduce(lambda a, kv: a + [F.lit(kv[0]), F.lit(kv[1])], fixed.BACKTRACE_RANK.items(), [])), status), F.lit(-1))


def best_source(traced: DataFrame, entity: str, position: str, status: str, tries: int = 3) -> DataFrame:
    """(entity, position, status): of an entity's first sources the one with the best status, the earlier of equals."""
    some = traced.filter(F.col(position) <= tries)
    best = F.max_by(F.struct(F.col(position).alias("position"), F.col(status).alias("status")), F.struct(status_rank(F.col(status)), -F.col(position)))
    return some.groupBy(entity).agg(best.alias("x")).select(entity, "x.position", "x.status")


def merge_backtrace(entities: DataFrame, traced: DataFrame, key: str) -> DataFrame:
    """Entities (key, formula, cid, standardized_query, lookup_status) with what was traced (key, bt_status, bt_formula, bt_cid, bt_query) written over.

    Only hits overwrite formula and cid, and only with values; hits and trusted names overwrite the query."""
    joined = entities.join(traced, key, "left")
    hit = F.coalesce(F.col("bt_status").isin("BACKTRACE_HIT", "BACKTRACE_OK"), F.lit(False))
    named = F.coalesce(F.col("bt_status") == "BACKTRACE_NAME_OK", F.lit(False))
    value = lambda dest, src: F.when(hit & (F.coalesce(F.col(src).cast("string"), F.lit("")) != ""), F.col(src)).otherwise(F.col(dest))
    trusted = ~predicates.is_bad_candidate(F.col("bt_query")) & ~predicates.is_generic_name(F.col("bt_query"))
    return joined.select(
        key,
        value("formula", "bt_formula").alias("formula"),
        value("cid", "bt_cid").alias("cid"),
        F.when((hit | named) & trusted, F.col("bt_query")).otherwise(F.col("standardized_query")).alias("standardized_query"),
        F.when(hit, "BACKTRACE_HIT").when(named, "BACKTRACE_NAME_OK").otherwise(F.col("lookup_status")).alias("lookup_status"),
        "bt_status",
    )


#: Statuses that a person looks at.
REVIEW_STATUSES = [
    "TOKEN_NOT_IN_MD", "MD_NOT_FOUND", "CONTEXT_FOUND_BUT_NO_EXPANSION", "EXPANSION_FOUND_BUT_PUBCHEM_NO_HIT", "LLM_EXPANSION_BUT_PUBCHEM_NO_HIT", "BACKTRACE_CLASS_HINT",
    "RAW_ROW_NOT_FOUND", "MISSING_SOURCE_RECORDINDEX", "NOT_PROCESSED",
]


def review_needed(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("bt_status").isin(REVIEW_STATUSES))
