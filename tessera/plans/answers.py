"""Queries over judges' answers, registries of several hops, and caches, on data derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import answers, text
from tessera.operators import cache, compounds, lookup, steps
from tessera.plans.adapters import pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}
c = F.col


def query(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = (f, sql)
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ answers
ANSWERS = [
    '{"components": [{"name": " TMC ", "role": "primary", "rank": 1}, "MPD", {"name": ""}, {"role": "x"}, 7], "abbr_candidates": ["PIP", {"query": "piperazine", "confidence": "0.9"}, {"query": ""}]}',
    '```json\n{"action": "query_pubchem", "pubchem_query_name": " urea ", "confidence": 0.8, "review_flag": false, "entity_type": "small_molecule"}\n```',
    'Sure: {"action": "drop", "pubchem_query_name": "gone", "components": [{"name": "Water"}, {"name": "KCl", "pubchem": "potassium chloride"}, {"name": "KCl", "pubchem": "potassium chloride"}]} as asked.',
    '{"action": "fly", "entity_type": "bird", "note": {"deep": [1, {"x": "}"}]}, "components": "none", "confidence": "high"}', "{broken", "[1, 2]", "", '{"a": 1} {"action": "drop"}',
]


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, object of each part's answer."""
    k = c("p_partkey")
    told = pick(ANSWERS, k)
    return read(spark, sf_dir, "part").select(k.alias("id"), c("p_name").alias("name"), told.alias("answer"))


#: What each answer of ANSWERS says, by its place, written by hand.
_SAMPLE = f"a AS (SELECT p_partkey AS id, p_name AS name, p_partkey % {len(ANSWERS)} AS k FROM part)"


@query("x_json_loose", f"WITH {_SAMPLE}, e(k, kind, action, first_action) AS (VALUES (0, true, NULL, NULL), (1, true, 'query_pubchem', 'query_pubchem'), (2, true, 'drop', 'drop'), (3, true, 'fly', 'fly'), (4, false, NULL, NULL), (5, false, NULL, NULL), (6, false, NULL, NULL), (7, false, NULL, NULL)) SELECT id, kind AS is_object, action, first_action FROM a JOIN e USING (k)")
def x_json_loose(spark, sf_dir):
    loose = lambda v: F.struct(v.isNotNull().alias("is_object"), F.try_variant_get(v, "$.action", "string").alias("action"))
    first = lambda v: F.try_variant_get(v, "$.action", "string")
    told = F.struct(text.bound(answers.loose_object(c("answer")), loose).alias("v"), text.bound(answers.first_object(c("answer")), first).alias("first_action"))
    return lookup.once_each(answered(spark, sf_dir).select("id", "answer"), ["answer"], "x", told).select("id", "x.v.*", "x.first_action")


@query("x_components_norm", f"""WITH {_SAMPLE}, e(k, name, role, rank, equivalent_group) AS (VALUES (0, 'TMC', 'primary', 1::BIGINT, ''), (0, 'MPD', 'co_component', 2, ''), (0, '7', 'co_component', 5, ''),
  (2, 'Water', 'co_component', 1, ''), (2, 'KCl', 'co_component', 2, ''), (2, 'KCl', 'co_component', 3, '')) SELECT id, e.name, role, rank, equivalent_group FROM a JOIN e USING (k)""")
def x_components_norm(spark, sf_dir):
    return answered(spark, sf_dir).select("id", F.explode(answers.components(answers.loose_object(c("answer")))).alias("x")).select("id", "x.*")


@query("x_abbr_norm", f"WITH {_SAMPLE}, e(k, query, confidence) AS (VALUES (0, 'PIP', 0.4::DOUBLE), (0, 'piperazine', 0.9)) SELECT id, query, confidence FROM a JOIN e USING (k)")
def x_abbr_norm(spark, sf_dir):
    return answered(spark, sf_dir).select("id", F.explode(answers.abbreviation_candidates(answers.loose_object(c("answer")))).alias("x")).select("id", "x.*")


@query("x_coerce", f"""WITH {_SAMPLE}, e(k, action, entity_type, pubchem_query_name, confidence, review_flag) AS (VALUES (1, 'query_pubchem', 'small_molecule', 'urea', 0.8::DOUBLE, false), (2, 'drop', 'unknown', '', 0.0, true))
  SELECT id, name AS raw_name, coalesce(action, 'queue_material') AS action, name AS normalized_input, coalesce(entity_type, 'unknown') AS entity_type, '' AS expanded_abbreviation, coalesce(pubchem_query_name, '') AS pubchem_query_name,
    coalesce(confidence, 0.0) AS confidence, coalesce(review_flag, true) AS review_flag FROM a LEFT JOIN e USING (k)""")
def x_coerce(spark, sf_dir):
    return answered(spark, sf_dir).select("id", answers.judged_name(c("name"), answers.loose_object(c("answer"))).alias("x")).select("id", "x.*").drop("note")


@query("x_components_table", f"WITH {_SAMPLE}, e(k, component_name, component_query) AS (VALUES (0, 'TMC', 'TMC'), (0, 'MPD', 'MPD'), (0, '7', '7'), (2, 'KCl', 'potassium chloride')) SELECT id, component_name, component_query FROM a JOIN e USING (k)")
def x_components_table(spark, sf_dir):
    return answered(spark, sf_dir).select("id", F.explode(answers.component_rows(answers.loose_object(c("answer")))).alias("x")).select("id", "x.*")


# ------------------------------------------------------------------ registries
def numbered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names with the numbers that a registry offers for them, and the properties of numbers; some have no name."""
    p, k = read(spark, sf_dir, "part"), c("p_partkey")
    asked = p.select(k.alias("row"), c("p_name").alias("name"), F.transform(F.sequence(F.lit(0), F.lit(12)), lambda i: (k * 7 + i * 13) % 200).alias("cids"))
    named = F.when(k % 9 == 0, "").otherwise(F.concat("p_name", F.when(k % 4 == 0, F.lit(" hydrate")).otherwise("")))
    return asked, p.select(k.alias("cid"), named.alias("iupac"), c("p_type").alias("formula"))


@query("w_best_cid")
def w_best_cid(spark, sf_dir):
    asked, properties = numbered(spark, sf_dir)
    return compounds.best_number(asked, ["row"], "name", "cids", properties).withColumn("score", F.round("score", 9))


@query("st_resolve_deep", """WITH tries AS (SELECT p_partkey AS "row", unnest([0, 1, 2]) AS place, unnest([p_name, string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]]) AS query FROM part),
  words AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)), opsin AS (SELECT w AS name, 'S' || length(w) AS structure FROM words WHERE length(w) IN (3, 5)), cir AS (SELECT w AS name, 'S' || (length(w) + 20) AS structure FROM words WHERE length(w) = 4),
  numbers AS (SELECT 'S' || (s_suppkey % 30) AS structure, min(s_suppkey) AS cid FROM supplier WHERE s_suppkey % 30 IN (3, 24) GROUP BY 1), props AS (SELECT s_suppkey AS cid, s_name AS iupac, CAST(s_nationkey AS VARCHAR) AS formula FROM supplier),
  hits AS (SELECT "row", 0 AS g, place, query, cid, 'opsin_smiles' AS source FROM tries JOIN opsin ON name = query JOIN numbers USING (structure) UNION ALL SELECT "row", 1, place, query, cid, 'cir_smiles' FROM tries JOIN cir ON name = query JOIN numbers USING (structure)),
  n AS (SELECT *, row_number() OVER (PARTITION BY "row" ORDER BY g, place) AS nth FROM hits)
  SELECT p_partkey AS "row", CASE WHEN n.cid IS NULL THEN 'FAILED' ELSE 'FOUND' END AS status, n.source, n.query, n.cid, iupac, formula FROM part LEFT JOIN n ON n."row" = p_partkey AND nth = 1 LEFT JOIN props ON props.cid = n.cid""")
def st_resolve_deep(spark, sf_dir):
    p, s = read(spark, sf_dir, "part"), read(spark, sf_dir, "supplier")
    words = F.split("p_name", " ")
    names = p.select(c("p_partkey").alias("row"), F.array("p_name", F.get(words, 0), F.get(words, 1)).alias("tries"))
    each = p.select(F.explode(words).alias("name")).distinct()
    structure = lambda size, plus: each.select("name", F.when(size, F.concat(F.lit("S"), (F.length("name") + plus).cast("string"))).alias("structure"))
    services = [("opsin_smiles", structure(F.length("name").isin(3, 5), 0)), ("cir_smiles", structure(F.length("name") == 4, 20))]
    numbers = s.filter("s_suppkey % 30 in (3, 24)").groupBy(F.concat(F.lit("S"), (c("s_suppkey") % 30).cast("string")).alias("structure")).agg(F.array(F.min("s_suppkey")).alias("cids"))
    properties = s.select(c("s_suppkey").alias("cid"), c("s_name").alias("iupac"), c("s_nationkey").cast("string").alias("formula"))
    return compounds.resolve_deep(names, "row", "tries", services, numbers, properties)


# ------------------------------------------------------------------ caches
@query("src_json_cache", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS \"value\" FROM supplier")
def src_json_cache(spark, sf_dir):
    """A cache that is one JSON object, written and read again."""
    path = steps.shared_folder(spark, "json-cache")
    s = read(spark, sf_dir, "supplier")
    entries = F.collect_list(F.struct(c("s_suppkey").cast("string"), "s_name"))
    s.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)
    return cache.json_map(spark, path)


@query("src_jsonl_cache", "SELECT CAST(user_id AS BIGINT) AS key, arg_max(event_type, event_id) AS \"value\" FROM events GROUP BY user_id")
def src_jsonl_cache(spark, sf_dir):
    """A log of JSON lines, written in order of events and read again: the last line of a key wins."""
    path = steps.shared_folder(spark, "json-lines")
    e = read(spark, sf_dir, "events").select("event_id", c("user_id").cast("bigint").alias("key"), c("event_type").alias("value"))
    e.orderBy("event_id").select(F.to_json(F.struct("key", "value"), {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    return lookup.last_wins(cache.json_lines(spark, path, "key bigint, value string").filter("key is not null"), "key", "place", "value")


@query("src_bt_resume", "SELECT CAST(user_id AS VARCHAR) AS key, max(event_type || '|' || event_id) FILTER (event_id = m) AS \"value\", m AS seq FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id, m")
def src_bt_resume(spark, sf_dir):
    """A cache that three overlapping writers filled, the last of them twice."""
    folder = steps.shared_folder(spark, "cache")
    e = read(spark, sf_dir, "events").select(c("user_id").cast("string").alias("key"), F.concat("event_type", F.lit("|"), c("event_id").cast("string")).alias("value"), c("event_id").cast("bigint").alias("seq"))
    for part in (e.filter("seq % 3 <> 0"), e.filter("seq % 3 <> 1"), e.filter("seq % 3 <> 1")):
        cache.upsert(part, folder)
    return cache.read(spark, folder)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
