"""Queries over joins, aggregations, deduplication, set operations and stages, on adapters over the driver's tables.

The SQL beside each query is written by hand for DuckDB; None where it has no counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays, fixed, predicates, text, units
from tessera.operators import delivery, dictionary, documents, lineage, lookup, resolve
from tessera.plans import scalars as q
from tessera.plans.adapters import CELLS_SQL, UNITS, cells, pick, sql_list, sql_pick

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


# ------------------------------------------------------------------ adapters
WT_UNITS = ["wt%", "g/L", "mg/L", "M", "mM", "v/v%", "ppm", "w/v%", "%", "mg/mL", "g/kg", "ppb", "drops", "mL/L"]
SLOT_LIST = [name for name, _ in fixed.SLOTS]


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item for each line of an order: row_id, slot, item_index, value, unit, family, wt, status, review."""
    line = read(spark, sf_dir, "lineitem")
    ok = (c("l_partkey") % 4 != 0)
    return line.select(
        c("l_orderkey").alias("row_id"),
        pick(SLOT_LIST, c("l_linenumber")).alias("slot"),
        c("l_linenumber").cast("long").alias("item_index"),
        pick(UNITS, c("l_partkey")).alias("unit"),
        pick(["mass_fraction", "molarity", "ppm_family", "unsupported"], c("l_partkey")).alias("unit_family"),
        F.when(ok, c("l_quantity")).alias("wt"),
        F.when(ok, "RULE_NORMALIZED_CONVERTED").otherwise(pick(["CANNOT_CONVERT", "FAILED_PARSE", "NEED_TRACEBACK"], c("l_suppkey"))).alias("status"),
        (c("l_suppkey") % 3 == 0).alias("review"),
    )


MEASURED = f"""measured AS (SELECT l_orderkey AS row_id, {sql_pick(SLOT_LIST, 'l_linenumber')} AS slot, CAST(l_linenumber AS BIGINT) AS item_index, {sql_pick(UNITS, 'l_partkey')} AS unit,
  {sql_pick(['mass_fraction', 'molarity', 'ppm_family', 'unsupported'], 'l_partkey')} AS unit_family, CASE WHEN l_partkey % 4 <> 0 THEN l_quantity END AS wt,
  CASE WHEN l_partkey % 4 <> 0 THEN 'RULE_NORMALIZED_CONVERTED' ELSE {sql_pick(['CANNOT_CONVERT', 'FAILED_PARSE', 'NEED_TRACEBACK'], 'l_suppkey')} END AS status,
  l_suppkey % 3 = 0 AS review FROM lineitem)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each order with two cells of names."""
    o = read(spark, sf_dir, "orders")
    k = c("o_orderkey")
    return o.select(k.alias("record"), F.concat(pick(NAMES_SIMPLE, k), F.lit("; "), pick(NAMES_SIMPLE, k * 3 + 1)).alias("monomer"), pick(NAMES_SIMPLE, k * 5 + 2).alias("additive"))


NAMES_SIMPLE = ["TMC", "MPD", "n/a", "Piperazine", "sodium dodecyl sulfate", "poly vinyl alcohol", "NaCl", "ethanol", "n-hexane", "DMF", "-", "camphorsulfonic acid", "tmc"]
RECORDS = f"""records AS (SELECT o_orderkey AS record, {sql_pick(NAMES_SIMPLE, 'o_orderkey')} || '; ' || {sql_pick(NAMES_SIMPLE, 'o_orderkey * 3 + 1')} AS monomer, {sql_pick(NAMES_SIMPLE, 'o_orderkey * 5 + 2')} AS additive FROM orders)"""
LONG = f"""{RECORDS}, melted AS (SELECT record, 'monomer' AS "column", monomer AS cell FROM records UNION ALL SELECT record, 'additive', additive FROM records),
parts AS (SELECT record, "column", list_filter(list_transform(string_split(cell, ';'), lambda x: trim(x)), lambda x: NOT list_contains(['', 'nan', 'none', 'null', 'n/a', 'na', '-', '--'], lower(x))) AS p
  FROM melted WHERE NOT list_contains(['', 'n/a', '-'], lower(trim(cell)))),
uniq AS (SELECT record, "column", list_filter(p, lambda x, i: list_position(list_transform(p, lambda y: lower(y)), lower(x)) = i) AS p FROM parts),
long AS (SELECT record, "column", unnest(range(1, len(p) + 1)) AS item, len(p) AS n_items, unnest(p) AS name, lower(unnest(p)) AS key FROM uniq WHERE len(p) > 0)"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(c("p_partkey").alias("entity"), pick(NAMES_SIMPLE, c("p_partkey") * 7).alias("name"), c("p_name"))


ENTITIES = f"entities AS (SELECT p_partkey AS entity, {sql_pick(NAMES_SIMPLE, 'p_partkey * 7')} AS name, p_name FROM part)"


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compound registry: the first part of each name."""
    p = read(spark, sf_dir, "part")
    return p.groupBy(F.lower("p_name").alias("name_key")).agg(F.min("p_partkey").alias("cid"), F.min_by("p_type", "p_partkey").alias("formula"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


# ------------------------------------------------------------------ joins
INDEX = "ix AS (SELECT key, count(*) AS n_items, count(DISTINCT record) AS n_records, min(record) AS first_record, max(record) AS last_record FROM long GROUP BY key)"


FULL_INDEX = f"{INDEX}, cell AS (SELECT key, array_to_string(list_sort(list(DISTINCT record)), '|') AS records FROM long GROUP BY key)"
CLASSES = "classes AS (SELECT *, lower(trim(name)) AS key, min(entity) OVER (PARTITION BY lower(trim(name))) AS same_as FROM entities)"


@query("j_lineage_attach", f"""WITH {LONG}, {ENTITIES}, {FULL_INDEX}, {CLASSES}
  SELECT entity, name, coalesce(n_items, 0) AS n_items, coalesce(n_records, 0) AS n_records, first_record, last_record, same_as, CASE WHEN entity = same_as THEN coalesce(records, '') END AS records FROM classes c LEFT JOIN ix ON c.key = ix.key LEFT JOIN cell ON cell.key = ix.key""")
def j_lineage_attach(spark, sf_dir):
    long = lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"])
    return lineage.attach(entities(spark, sf_dir).select("entity", "name"), "entity", "name", lineage.full_index(long))


@query("j_lineage_match", f"""WITH {LONG}, {ENTITIES}, {CLASSES}
  SELECT entity, same_as, record, "column", item FROM classes c LEFT JOIN long l ON c.key = l.key AND c.entity = c.same_as WHERE NOT list_contains(['n/a', '-'], c.name)""")
def j_lineage_match(spark, sf_dir):
    long = lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"])
    return lineage.pairs(entities(spark, sf_dir).select("entity", "name"), "entity", "name", long)


@query("j_lineage_items", f"WITH {LONG}, {ENTITIES} SELECT key, record, \"column\", item, name AS source_name FROM long WHERE key IN (SELECT lower(trim(name)) FROM entities WHERE NOT list_contains(['n/a', '-'], name))")
def j_lineage_items(spark, sf_dir):
    """The items that entities match, each once: with the entities' keys they are the whole match."""
    long = lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"])
    return lineage.match(entities(spark, sf_dir).select("entity", "name"), "name", long)[1]


IDENTITY = [("MPD", "m-phenylenediamine", 108.14), ("TMC", "trimesoyl chloride", 265.48), ("sodium dodecyl sulfate", "sodium dodecyl sulfate", 288.38), ("NaCl", "sodium chloride", 58.44), ("camphorsulfonic-acid", "camphorsulfonic acid", 232.3), ("n hexane", "n-hexane", 86.18)]


def identity(spark: SparkSession) -> DataFrame:
    rows = [(i, o, s, "", "", str(i), str(mw)) for i, (o, s, mw) in enumerate(IDENTITY)]
    return lookup.build_identity(spark.createDataFrame(rows, "row int, original string, standard string, iupac string, formula string, cid string, mw string"))


@query("j_identity_build", None)
def j_identity_build(spark, sf_dir):
    return identity(spark)


IDENTITY_SQL = "t(original, standard) AS (VALUES " + ", ".join(f"('{o}', '{n}')" for o, n, _ in IDENTITY) + ")"


@query("j_identity", f"""WITH {ENTITIES}, {IDENTITY_SQL}, keys AS (SELECT lower(original) AS key, standard FROM t UNION SELECT lower(standard), standard FROM t)
  SELECT entity, CASE WHEN standard IS NULL THEN CASE WHEN regexp_full_match(name, '[A-Z]{{2,5}}') THEN 'UNRESOLVED_ABBREVIATION' ELSE 'UNRESOLVED' END
    WHEN lower(name) = lower(standard) THEN 'IDENTITY_TABLE_EXACT' ELSE 'IDENTITY_TABLE_REJECTED_SIMILARITY' END AS identity_source
  FROM entities LEFT JOIN keys ON key = lower(trim(name))""")
def j_identity(spark, sf_dir):
    return lookup.resolve_identity(entities(spark, sf_dir).select("entity", "name"), "name", identity(spark)).select("entity", "identity_source")


@query("j_identity_fuzzy", "WITH t(\"row\", original) AS (VALUES (0, 'small'), (1, 'ring'), (2, 'large blue')), n AS (SELECT DISTINCT p_name FROM part), m AS (SELECT p_name, original, \"row\", CASE WHEN lower(p_name) = original THEN 0 ELSE 1 END AS e FROM n, t WHERE contains(lower(p_name), original) OR contains(original, lower(p_name))) SELECT p_name, arg_min(original, e * 10 + \"row\") AS original FROM m GROUP BY p_name")
def j_identity_fuzzy(spark, sf_dir):
    table = spark.createDataFrame([(0, "small"), (1, "ring"), (2, "large blue")], "row int, original string")
    return lookup.fuzzy_identity(read(spark, sf_dir, "part"), "p_name", table)


@query("j_source_row", f"WITH {ENTITIES} SELECT entity, CASE WHEN o_orderkey IS NULL THEN 'RAW_ROW_NOT_FOUND' ELSE 'FOUND' END AS status FROM entities LEFT JOIN orders ON o_orderkey = entity * 20")
def j_source_row(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("source"))
    e = entities(spark, sf_dir).select("entity", (c("entity") * 20).alias("source"))
    return e.join(o.withColumn("here", F.lit(True)), "source", "left").select("entity", F.when(c("here"), "FOUND").otherwise("RAW_ROW_NOT_FOUND").alias("status"))


def doc_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return documents.catalog(d, "doc_id", F.concat(F.lit("paper-"), c("doc_id").cast("string"), F.lit(".md")), "text")


WORDS_SQL = "ix AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents)"
ASKED_WORDS = [["the", "blue", "idiot"], ["que", "las"], ["der", "und", "die"], ["oncology", "membrane"], ["email", "com"]]


@query("j_doc_score", f"WITH {WORDS_SQL}, {ENTITIES}, a AS (SELECT entity, unnest(({'[' + ', '.join(sql_list(x) for x in ASKED_WORDS) + ']'})[entity % 5 + 1]) AS word FROM entities), s AS (SELECT entity, doc_id, count(*) * 12 AS score FROM a JOIN ix USING (word) GROUP BY ALL), r AS (SELECT entity AS \"row\", doc_id, score, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank FROM s) SELECT * FROM r WHERE rank <= 8")
def j_doc_score(spark, sf_dir):
    return documents.score(asked_words(spark, sf_dir), "entity", "keywords", documents.words(read(spark, sf_dir, "documents"), "doc_id", "text"))


def asked_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(spark, sf_dir).select("entity", F.element_at(F.array(*[F.array(*map(F.lit, x)) for x in ASKED_WORDS]), (c("entity") % 5 + 1).cast("int")).alias("keywords"))


@query("j_doc_any", "WITH p AS (SELECT DISTINCT trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS phrase FROM benchmark), d AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') || ' ' AS t FROM documents) SELECT doc_id, phrase FROM d JOIN p ON contains(t, ' ' || phrase || ' ')")
def j_doc_any(spark, sf_dir):
    phrases = read(spark, sf_dir, "benchmark").select(F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " ")).alias("p")).distinct()
    return documents.containing(read(spark, sf_dir, "documents"), "doc_id", "text", phrases, "p")


@query("j_abbr_known", f"WITH {ENTITIES} SELECT entity, CASE upper(name) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dictionary.KNOWN.items()) + " ELSE '' END AS full_name FROM entities")
def j_abbr_known(spark, sf_dir):
    return entities(spark, sf_dir).select("entity", F.coalesce(units.lookup(F.upper(text.core_name(c("name"))), dictionary.KNOWN), F.lit("")).alias("full_name"))


@query("j_anti_resume", "SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events d WHERE d.event_id = e.event_id AND d.event_type = 'error')")
def j_anti_resume(spark, sf_dir):
    done = events(spark, sf_dir).filter("event_type = 'error'").select("event_id")
    return events(spark, sf_dir).select("event_id").join(done, "event_id", "left_anti")


@query("j_llm_results", "WITH u AS (SELECT DISTINCT p_type FROM part) SELECT p_partkey, lower(u.p_type) AS judged FROM part JOIN u USING (p_type)")
def j_llm_results(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    judged = p.select("p_type").distinct().withColumn("judged", F.lower("p_type"))
    return p.join(judged, "p_type", "left").select("p_partkey", "judged")


@query("j_components", "SELECT a.p_partkey, min(b.p_partkey) AS hit FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) a LEFT JOIN (SELECT p_partkey, string_split(p_name, ' ')[1] AS w FROM part) b USING (w) GROUP BY a.p_partkey")
def j_components(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    table = p.groupBy(F.get(F.split("p_name", " "), 0).alias("w")).agg(F.min("p_partkey").alias("hit"))
    return p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("w")).join(table, "w", "left").groupBy("p_partkey").agg(F.min("hit").alias("hit"))


# ------------------------------------------------------------------ aggregations
@query("agg_slot_delivery", f"""WITH {MEASURED} SELECT row_id, slot, coalesce(string_agg(format('{{:g}}', wt), ';' ORDER BY item_index, format('{{:g}}', wt)) FILTER (wt IS NOT NULL), '') AS wt_values, count(*) AS n_items, count(wt) AS n_ok,
  coalesce(string_agg(CAST(item_index AS VARCHAR), ';' ORDER BY item_index) FILTER (wt IS NULL), '') AS failed_items, bool_or(review) AS need_review,
  CASE WHEN count(wt) = 0 THEN 'FAIL' WHEN bool_or(review) THEN 'REVIEW' WHEN count(wt) < count(*) THEN 'PARTIAL' ELSE 'OK' END AS slot_status FROM measured GROUP BY row_id, slot""")
def agg_slot_delivery(spark, sf_dir):
    return delivery.slot_delivery(measured(spark, sf_dir))


_WIDE = ", ".join(f"coalesce(max(CASE WHEN slot = '{s}' THEN n END), 0) AS {s}_items, coalesce(max(CASE WHEN slot = '{s}' THEN k END), 0) AS {s}_ok, coalesce(max(CASE WHEN slot = '{s}' THEN st END), '') AS {s}_status, coalesce(max(CASE WHEN slot = '{s}' THEN w END), '') AS {s}_wt, coalesce(max(CASE WHEN slot = '{s}' THEN f END), '') AS {s}_failed, coalesce(bool_or(CASE WHEN slot = '{s}' THEN r END), false) AS {s}_review" for s in SLOT_LIST)


@query("agg_delivery_main", f"""WITH {MEASURED}, d AS (SELECT row_id, slot, coalesce(string_agg(format('{{:g}}', wt), ';' ORDER BY item_index, format('{{:g}}', wt)) FILTER (wt IS NOT NULL), '') AS w, count(*) AS n, count(wt) AS k,
  coalesce(string_agg(CAST(item_index AS VARCHAR), ';' ORDER BY item_index) FILTER (wt IS NULL), '') AS f, bool_or(review) AS r,
  CASE WHEN count(wt) = 0 THEN 'FAIL' WHEN bool_or(review) THEN 'REVIEW' WHEN count(wt) < count(*) THEN 'PARTIAL' ELSE 'OK' END AS st FROM measured GROUP BY row_id, slot)
  SELECT o_orderkey AS row_id, {_WIDE} FROM orders LEFT JOIN d ON row_id = o_orderkey GROUP BY o_orderkey""")
def agg_delivery_main(spark, sf_dir):
    return delivery.delivery_main(read(spark, sf_dir, "orders").select(c("o_orderkey").alias("row_id")), agg_slot_delivery(spark, sf_dir))


@query("agg_summary", f"""WITH {MEASURED} SELECT 'total' AS metric, CAST(count(*) AS DOUBLE) AS "value" FROM measured UNION ALL SELECT 'converted', CAST(count(wt) AS DOUBLE) FROM measured UNION ALL SELECT 'coverage', round(CAST(count(wt) AS DOUBLE) / count(*), 6) FROM measured
  UNION ALL SELECT 'manual_review', CAST(count(*) FILTER (review) AS DOUBLE) FROM measured UNION ALL SELECT 'status:' || status, CAST(count(*) AS DOUBLE) FROM measured GROUP BY status UNION ALL SELECT 'family:' || unit_family, CAST(count(*) AS DOUBLE) FROM measured GROUP BY unit_family""")
def agg_summary(spark, sf_dir):
    return delivery.summary(measured(spark, sf_dir))


DOMAIN = ["RULE_NORMALIZED_CONVERTED", "CANNOT_CONVERT", "FAILED_PARSE", "NEED_TRACEBACK", "NEED_MANUAL_REVIEW"]


@query("agg_summary_domain", f"WITH {MEASURED}, d(status) AS (SELECT unnest({sql_list(DOMAIN)})) SELECT d.status, count(m.row_id) AS n FROM d LEFT JOIN measured m ON m.status = d.status GROUP BY d.status")
def agg_summary_domain(spark, sf_dir):
    return delivery.summary_domain(measured(spark, sf_dir), DOMAIN)


@query("agg_summary_linked", f"WITH {MEASURED} SELECT slot, count(*) AS n, count(DISTINCT row_id) AS n_rows FROM measured GROUP BY slot")
def agg_summary_linked(spark, sf_dir):
    return measured(spark, sf_dir).groupBy("slot").agg(F.count("*").alias("n"), F.countDistinct("row_id").alias("n_rows"))


@query("agg_unit_catalog", f"WITH {CELLS_SQL}, {MEASURED}, s AS (SELECT unnest({q.split_multi('units')}) AS unit FROM cells UNION ALL SELECT unnest({q.split_multi('unit')}) FROM measured), n AS (SELECT unit, count(*) AS n FROM s GROUP BY unit) SELECT unit, n, {q.U} AS canonical_unit, {q.FAM} AS unit_family FROM n")
def agg_unit_catalog(spark, sf_dir):
    return delivery.unit_catalog(cells(spark, sf_dir).select(c("units").alias("unit")), measured(spark, sf_dir).select("unit"))


@query("agg_unit_catalog_distinct", f"WITH {CELLS_SQL}, u AS (SELECT DISTINCT unnest({q.split_multi('units')}) AS unit FROM cells) SELECT unit, {q.FAM} AS unit_family FROM u")
def agg_unit_catalog_distinct(spark, sf_dir):
    tokens = cells(spark, sf_dir).select(F.explode(arrays.split_multi(c("units"))).alias("unit")).distinct()
    return tokens.select("unit", units.normalize_unit(c("unit"))["family"].alias("unit_family")).orderBy("unit")


@query("agg_dup_pairs", f"WITH {MEASURED}, n AS (SELECT slot, unit, count(*) AS n_same FROM measured GROUP BY slot, unit) SELECT row_id, item_index, m.slot, n_same, n_same >= 25 AS suspicious FROM measured m JOIN n ON n.slot = m.slot AND n.unit = m.unit")
def agg_dup_pairs(spark, sf_dir):
    return delivery.duplicate_pairs(measured(spark, sf_dir), ["slot", "unit"]).select("row_id", "item_index", "slot", "n_same", "suspicious")


@query("w_dup_count", f"WITH {MEASURED} SELECT row_id, item_index, slot, count(*) OVER (PARTITION BY row_id, slot) AS n_same FROM measured")
def w_dup_count(spark, sf_dir):
    return delivery.duplicate_pairs(measured(spark, sf_dir), ["row_id", "slot"]).select("row_id", "item_index", "slot", "n_same")


@query("agg_name_index", f"WITH {LONG}, {FULL_INDEX} SELECT ix.*, records FROM ix JOIN cell USING (key)")
def agg_name_index(spark, sf_dir):
    return lineage.full_index(lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"]))


@query("agg_source_cells", f"WITH {LONG} SELECT record, \"column\", len(p) AS n_items, array_to_string(p, ' | ') AS joined FROM uniq WHERE len(p) > 0")
def agg_source_cells(spark, sf_dir):
    return lineage.source_cells(records(spark, sf_dir), "record", ["monomer", "additive"]).select("record", "column", "n_items", "joined")


@query("agg_trace_summary", f"WITH {LONG}, {ENTITIES}, m AS (SELECT entity, record FROM entities e LEFT JOIN long l ON lower(trim(e.name)) = l.key WHERE NOT list_contains(['n/a', '-'], e.name)) SELECT 'items' AS metric, (SELECT count(*) FROM long) AS \"value\" UNION ALL SELECT 'keys', (SELECT count(DISTINCT key) FROM long) UNION ALL SELECT 'entities', (SELECT count(DISTINCT entity) FROM m) UNION ALL SELECT 'traced', (SELECT count(DISTINCT entity) FROM m WHERE record IS NOT NULL)")
def agg_trace_summary(spark, sf_dir):
    long = lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"])
    traced = lineage.matched(entities(spark, sf_dir).select("entity", "name"), "name", long)
    return lineage.trace_summary(long, traced, "entity")


def bound_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select(c("id").alias("row"), "name")


@query("agg_abbr_lexicon", None)
def agg_abbr_lexicon(spark, sf_dir):
    return dictionary.abbreviation_lexicon(bound_names(spark, sf_dir), "name")


@query("agg_abbr_map_first", None)
def agg_abbr_map_first(spark, sf_dir):
    return dictionary.first_expansion(bound_names(spark, sf_dir), "name")


@query("agg_alias_dict", None)
def agg_alias_dict(spark, sf_dir):
    seed = spark.createDataFrame(dictionary.SEED, "alias string, canonical_name string, category string")
    return dictionary.alias_dictionary(bound_names(spark, sf_dir), "name", seed)


@query("j_abbr_not_known", None)
def j_abbr_not_known(spark, sf_dir):
    seed = spark.createDataFrame(dictionary.SEED, "alias string, canonical_name string, category string")
    return dictionary.frequent_tokens(bound_names(spark, sf_dir), "name").join(seed, "alias", "left_anti")


@query("w_best_alias", None)
def w_best_alias(spark, sf_dir):
    return dictionary.best_pairs(dictionary.mined_pairs(bound_names(spark, sf_dir), "name"))


@query("agg_join_final", f"WITH {MEASURED} SELECT row_id, slot, string_agg(unit, '; ' ORDER BY item_index, unit) AS unit FROM measured GROUP BY row_id, slot")
def agg_join_final(spark, sf_dir):
    return delivery.join_final(measured(spark, sf_dir), "unit")


@query("agg_main_row", f"WITH {MEASURED} SELECT row_id, max(review) AS any_review, count(*) FILTER (review) AS n_review, count(*) AS n FROM measured GROUP BY row_id")
def agg_main_row(spark, sf_dir):
    return measured(spark, sf_dir).groupBy("row_id").agg(F.max("review").alias("any_review"), F.count(F.when(c("review"), 1)).alias("n_review"), F.count("*").alias("n"))


@query("agg_review_count", f"WITH {MEASURED} SELECT row_id, CAST(sum(CASE WHEN review THEN 1 ELSE 0 END) AS BIGINT) AS n_review FROM measured GROUP BY row_id")
def agg_review_count(spark, sf_dir):
    return measured(spark, sf_dir).groupBy("row_id").agg(F.sum(c("review").cast("long")).alias("n_review"))


@query("agg_report", "SELECT event_type AS metric, count(*) AS n, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS review_ratio FROM events GROUP BY event_type")
def agg_report(spark, sf_dir):
    return events(spark, sf_dir).groupBy(c("event_type").alias("metric")).agg(F.count("*").alias("n"), F.round(F.avg((c("value") > 50).cast("double")), 6).alias("review_ratio"))


STATUSES = list(fixed.BACKTRACE_RANK)


def traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(c("user_id").alias("entity"), (c("event_id") % 5 + 1).alias("position"), pick(STATUSES, c("event_id")).alias("status"), "event_id")


TRACED = f"traced AS (SELECT user_id AS entity, event_id % 5 + 1 AS position, {sql_pick(STATUSES, 'event_id')} AS status, event_id FROM events)"
RANK = "CASE status " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.BACKTRACE_RANK.items()) + " ELSE -1 END"


@query("agg_bt_report", f"WITH {TRACED} SELECT status, count(*) AS n FROM traced GROUP BY status")
def agg_bt_report(spark, sf_dir):
    return traced(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@query("w_best_status", f"WITH {TRACED}, r AS (SELECT entity, {RANK} AS k, position FROM traced WHERE position <= 3) SELECT entity, max(k * 10 - position) AS best FROM r GROUP BY entity")
def w_best_status(spark, sf_dir):
    best = resolve.best_source(traced(spark, sf_dir), "entity", "position", "status")
    return best.select("entity", (resolve.status_rank(c("status")).cast("long") * 10 - c("position")).alias("best"))


# ------------------------------------------------------------------ dedup, order, sets
@query("w_keep_first", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def w_keep_first(spark, sf_dir):
    return lookup.keep_first(events(spark, sf_dir), [c("user_id"), c("event_type")], [c("event_id")]).select("user_id", "event_type", "event_id")


@query("w_keep_first_key", f"WITH {CELLS_SQL}, t AS (SELECT id, name, lower(name) AS k FROM cells), f AS (SELECT k, min(id) AS id FROM t WHERE name <> '' GROUP BY k) SELECT id FROM f WHERE NOT regexp_matches(trim(k), '^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)(e[+-]?\\d+)?$') AND regexp_matches(k, '[a-z0-9一-鿿]')")
def w_keep_first_key(spark, sf_dir):
    named = cells(spark, sf_dir).select("id", "name").filter("name <> ''")
    first = lookup.keep_first(named, [F.lower("name")], [c("id")])
    return first.filter(~predicates.is_numeric_only(c("name")) & ~predicates.is_symbol_only(c("name"))).select("id")


@query("w_best_cand", "WITH b AS (SELECT user_id, event_type, max(value) AS score FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) AS rank FROM b) SELECT user_id, event_type, score, rank FROM r WHERE rank <= 5")
def w_best_cand(spark, sf_dir):
    best = events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.max("value").alias("score"))
    return lookup.top_k(best, [c("user_id")], [F.desc("score"), c("event_type")], 5)


@query("w_top_docs", None)
def w_top_docs(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    names = d.select("doc_id", F.concat(F.lit("paper-"), c("doc_id").cast("string"), F.lit(".md")).alias("name"))
    return documents.score(asked_words(spark, sf_dir), "entity", "keywords", documents.words(d, "doc_id", "text"), names=names)


@query("w_priority", "SELECT user_id, arg_min(event_type, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) AS best FROM events GROUP BY user_id")
def w_priority(spark, sf_dir):
    order = units.lookup(c("event_type"), {"purchase": 0, "click": 1, "view": 2, "signup": 3, "error": 4})
    return events(spark, sf_dir).groupBy("user_id").agg(F.min_by("event_type", order).alias("best"))


@query("o_sort", f"WITH {MEASURED} SELECT row_id, item_index, slot FROM measured ORDER BY row_id, item_index, slot")
def o_sort(spark, sf_dir):
    return measured(spark, sf_dir).select("row_id", "item_index", "slot").orderBy("row_id", "item_index", "slot")


@query("o_limit", "SELECT event_id FROM events ORDER BY event_id LIMIT 50")
def o_limit(spark, sf_dir):
    return events(spark, sf_dir).select("event_id").orderBy("event_id").limit(50)


@query("u_concat_full", "SELECT event_id, value, NULL AS reason FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, NULL, 'dropped' FROM events WHERE event_type = 'error'")
def u_concat_full(spark, sf_dir):
    e = events(spark, sf_dir)
    kept = e.filter("event_type <> 'error'").select("event_id", "value")
    dropped = e.filter("event_type = 'error'").select("event_id", F.lit("dropped").alias("reason"))
    return kept.unionByName(dropped, allowMissingColumns=True)


@query("u_concat_cols", "SELECT p_partkey, p_name, s_name FROM part JOIN supplier ON s_suppkey = p_partkey")
def u_concat_cols(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(c("s_suppkey").alias("p_partkey"), "s_name")
    return read(spark, sf_dir, "part").select("p_partkey", "p_name").join(s, "p_partkey")


@query("u_distinct_names", f"WITH {LONG} SELECT DISTINCT name FROM long")
def u_distinct_names(spark, sf_dir):
    return lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"]).select("name").distinct().orderBy("name")


@query("u_except", "SELECT DISTINCT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase'")
def u_except(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.filter("event_type = 'click'").select("user_id").subtract(e.filter("event_type = 'purchase'").select("user_id"))


@query("u_intersect", "SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase'")
def u_intersect(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.filter("event_type = 'click'").select("user_id").intersect(e.filter("event_type = 'purchase'").select("user_id"))


@query("f_only_unresolved", f"WITH {CELLS_SQL} SELECT id, status FROM cells WHERE {q.one_of('upper(status)', fixed.UNRESOLVED)}")
def f_only_unresolved(spark, sf_dir):
    return cells(spark, sf_dir).filter(F.upper("status").isin(fixed.UNRESOLVED)).select("id", "status")


@query("f_review_needed", f"WITH {TRACED} SELECT event_id, status AS bt_status FROM traced WHERE {q.one_of('status', resolve.REVIEW_STATUSES)}")
def f_review_needed(spark, sf_dir):
    return resolve.review_needed(traced(spark, sf_dir).select("event_id", c("status").alias("bt_status")))


@query("f_review_queue", f"WITH {MEASURED} SELECT row_id, slot, item_index FROM measured WHERE review")
def f_review_queue(spark, sf_dir):
    return delivery.review_queue(measured(spark, sf_dir)).select("row_id", "slot", "item_index")


@query("proj_core_audit", f"WITH {MEASURED} SELECT row_id, item_index, 'core' AS part, to_json({{'wt': wt, 'status': status}}) AS cells FROM measured UNION ALL SELECT row_id, item_index, 'audit', to_json({{'slot': slot, 'unit': unit, 'unit_family': unit_family, 'review': review}}) FROM measured")
def proj_core_audit(spark, sf_dir):
    """Both parts, each row's cells as JSON."""
    keys, parts = ["row_id", "item_index"], delivery.core_and_audit(measured(spark, sf_dir).withColumn("wt", c("wt").cast("double")), ["row_id", "item_index"], ["wt", "status"])
    shown = [p.select(*keys, F.lit(n).alias("part"), F.to_json(F.struct(*[x for x in p.columns if x not in keys]), {"ignoreNullFields": "false"}).alias("cells")) for n, p in zip(("core", "audit"), parts, strict=True)]
    return shown[0].unionAll(shown[1])


@query("x_melt", "SELECT p_partkey, 'p_name' AS field, p_name AS raw FROM part UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part")
def x_melt(spark, sf_dir):
    return read(spark, sf_dir, "part").unpivot(["p_partkey"], ["p_name", "p_brand", "p_type"], "field", "raw")


@query("x_long", f"WITH {LONG} SELECT record, \"column\", item, n_items, name FROM long")
def x_long(spark, sf_dir):
    return lineage.long_table(records(spark, sf_dir), "record", ["monomer", "additive"]).select("record", "column", "item", "n_items", "name")


# ------------------------------------------------------------------ conversion and stages
def wt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c("l_quantity").alias("v"), pick(WT_UNITS, c("l_partkey")).alias("unit"), pick(SLOT_LIST, c("l_suppkey")).alias("slot"), F.when(c("l_suppkey") % 3 > 0, c("l_extendedprice") / 1000).alias("mw"))


@query("n_wt", f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS v, {sql_pick(WT_UNITS, 'l_partkey')} AS unit, {sql_pick(SLOT_LIST, 'l_suppkey')} AS slot, CASE WHEN l_suppkey % 3 > 0 THEN l_extendedprice / 1000 END AS mw FROM lineitem),
  p AS (SELECT *, slot IN ('aqueous_monomer', 'test_nacl') AS wet FROM r), d AS (SELECT *, CASE WHEN wet THEN 1.0::DOUBLE END AS rho FROM p)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE unit WHEN 'wt%' THEN round(v, 6) WHEN 'g/L' THEN round(v / (10.0::DOUBLE * rho), 6) WHEN 'mg/mL' THEN round(v / (10.0::DOUBLE * rho), 6) WHEN 'mg/L' THEN round(v / (10000.0::DOUBLE * rho), 6)
    WHEN 'M' THEN round(v * mw / (rho * 10.0::DOUBLE), 6) WHEN 'mM' THEN round(v / 1000.0::DOUBLE * mw / (rho * 10.0::DOUBLE), 6) WHEN 'ppm' THEN CASE WHEN wet THEN round(v / 10000.0::DOUBLE, 6) END WHEN 'ppb' THEN CASE WHEN wet THEN round(v / 1e7, 6) END
    WHEN 'w/v%' THEN round(v / rho, 6) WHEN '%' THEN round(v / rho, 6) WHEN 'g/kg' THEN round(v / 10.0::DOUBLE, 6) END AS wt FROM d""")
def n_wt(spark, sf_dir):
    rows = units.with_unit_names(wt_rows(spark, sf_dir), "unit")
    wet = c("slot").isin("aqueous_monomer", "test_nacl")
    wt = units.weight_percent(c("v"), c("unit_family"), c("canonical_unit"), F.lit("WV_PERCENT"), F.when(wet, "aqueous").otherwise("unknown"), c("slot"), c("mw"), F.when(wet, 1.0), F.lit(None).cast("double"), F.lit(True))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", wt["wt"].alias("wt"))


@query("n_remap", f"WITH {MEASURED} SELECT row_id, item_index, slot, status AS remapped FROM measured")
def n_remap(spark, sf_dir):
    early = F.when(c("status") == "RULE_NORMALIZED_CONVERTED", "SAFE_CONVERTED").otherwise(c("status"))
    return measured(spark, sf_dir).select("row_id", "item_index", "slot", units.remap_status(early, F.lit("RULE")).alias("remapped"))


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five slots for each part, with multi-valued cells."""
    base = lookup.dealt(cells(spark, sf_dir).select("id", "cell", "values", "units", "sample"))
    each = base.select("id", F.posexplode(F.array(*map(F.lit, SLOT_LIST))).alias("at", "slot"), "cell", "values", "units", "sample")
    return each.select(c("id").alias("row_id"), "slot", F.when(c("at") % 2 == 0, c("cell")).otherwise(pick(NAMES_SIMPLE, c("id") + c("at"))).alias("solutes"), "values", "units", "sample")


@query("x_slot_items", None)
def x_slot_items(spark, sf_dir):
    return delivery.items(slots(spark, sf_dir))


@query("st_review", None)
def st_review(spark, sf_dir):
    return delivery.review(slots(spark, sf_dir), identity(spark), context="sample")


@query("st_identity_guard", f"""WITH {ENTITIES}, {IDENTITY_SQL}, keys AS (SELECT lower(original) AS key, standard FROM t UNION SELECT lower(standard), standard FROM t)
  SELECT entity, name, trim(name) AS standard, '' AS iupac, '' AS formula, '' AS cid, CAST(NULL AS DOUBLE) AS mw, true AS identity_rejected, 'IDENTITY_TABLE_REJECTED_SIMILARITY' AS identity_source
  FROM entities JOIN keys ON key = lower(trim(name)) WHERE lower(name) <> lower(standard)""")
def st_identity_guard(spark, sf_dir):
    return lookup.resolve_identity(entities(spark, sf_dir).select("entity", "name"), "name", identity(spark)).filter("identity_rejected")


@query("st_delivery", None)
def st_delivery(spark, sf_dir):
    reviewed = st_review(spark, sf_dir)
    return delivery.delivery_main(cells(spark, sf_dir).select(c("id").alias("row_id")), delivery.slot_delivery(reviewed))


@query("st_resolve_fast", None)
def st_resolve_fast(spark, sf_dir):
    return resolve.resolve(cells(spark, sf_dir), "id", "name", registry(spark, sf_dir))


@query("st_lookup", f"""WITH {CELLS_SQL}, r AS (SELECT lower(p_name) AS name_key, min(p_partkey) AS cid FROM part GROUP BY 1), v AS (SELECT id, {q.DISTINCT_VARIANTS} AS tries FROM cells),
  t AS (SELECT id, unnest(range(len(tries))) AS place, lower(unnest(tries)) AS query FROM v), n AS (SELECT id, query, cid, row_number() OVER (PARTITION BY id ORDER BY place) AS nth FROM t JOIN r ON name_key = query)
  SELECT cells.id, query, cid FROM cells LEFT JOIN n ON n.id = cells.id AND nth = 1""")
def st_lookup(spark, sf_dir):
    rows = cells(spark, sf_dir).select("id", text.query_variants(c("name")).alias("tries"))
    return lookup.first_success(rows, "id", F.transform(c("tries"), lambda x: F.lower(x)), registry(spark, sf_dir), "name_key", ["cid"])


@query("st_enrich", None)
def st_enrich(spark, sf_dir):
    code = pick(["SINGLE", "MIXTURE", "ABBR", "PROCESS", "POLYMER"], c("id"))
    return resolve.enrich(cells(spark, sf_dir), "id", "name", code, registry(spark, sf_dir))


@query("e_name_cid", "WITH r AS (SELECT lower(p_name) AS k, min(p_partkey) AS cid FROM part GROUP BY 1) SELECT p_partkey, cid FROM part LEFT JOIN r ON r.k = lower(p_name)")
def e_name_cid(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("name_key"))
    return p.join(registry(spark, sf_dir).select("name_key", "cid"), "name_key", "left").select("p_partkey", "cid")


@query("j_bt_merge", f"""WITH {TRACED}, t AS (SELECT event_id AS entity, status, 'C' || event_id AS f, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE '' END AS cid FROM traced) SELECT p_partkey AS entity,
  CASE WHEN status IN ('BACKTRACE_HIT', 'BACKTRACE_OK') THEN f ELSE p_type END AS formula, CASE WHEN status IN ('BACKTRACE_HIT', 'BACKTRACE_OK') AND cid <> '' THEN cid ELSE '' END AS cid,
  CASE WHEN status IN ('BACKTRACE_HIT', 'BACKTRACE_OK') THEN 'BACKTRACE_HIT' WHEN status = 'BACKTRACE_NAME_OK' THEN 'BACKTRACE_NAME_OK' ELSE 'NO_HIT' END AS lookup_status FROM part LEFT JOIN t ON t.entity = p_partkey""")
def j_bt_merge(spark, sf_dir):
    t = traced(spark, sf_dir).select(c("event_id").alias("entity"), c("status").alias("bt_status"), F.concat(F.lit("C"), c("event_id").cast("string")).alias("bt_formula"), F.when(c("event_id") % 2 == 0, c("event_id").cast("string")).otherwise("").alias("bt_cid"), F.lit("sodium chloride").alias("bt_query"))
    e = read(spark, sf_dir, "part").select(c("p_partkey").alias("entity"), c("p_type").alias("formula"), F.lit("").alias("cid"), c("p_name").alias("standardized_query"), F.lit("NO_HIT").alias("lookup_status"))
    return resolve.merge_backtrace(e, t, "entity").select("entity", "formula", "cid", "lookup_status")


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select(c("doc_id").alias("record"), "text", pick(["the", "idiot", "que", "zz9"], c("doc_id")).alias("token"))


@query("s_sentences", r"""WITH d AS (SELECT doc_id AS record, text, (['the', 'idiot', 'que', 'zz9'])[doc_id % 4 + 1] AS token FROM documents),
  s AS (SELECT record, token, list_transform(regexp_extract_all(text, '[^.!?。；;\n]*[.!?。；;\n]|[^.!?。；;\n]+$'), lambda x: trim(x)) AS p FROM d),
  h AS (SELECT record, p, unnest(list_filter(range(1, len(p) + 1), lambda i: regexp_matches(p[i], '(?i)(^|[^A-Za-z0-9])' || token || '([^A-Za-z0-9]|$)'))) AS i FROM s),
  w AS (SELECT record, i, trim(regexp_replace(translate(array_to_string(list_filter(p[greatest(i - 1, 1):i + 1], lambda x: x <> ''), ' '), '（），；：｜–—−', '(),;:|---'), '\s+', ' ', 'g')) AS w FROM h),
  f AS (SELECT record, i, w, row_number() OVER (PARTITION BY record, lower(w) ORDER BY i) AS n FROM w WHERE w <> ''),
  g AS (SELECT record, list(substr(w, 1, 1400) ORDER BY i)[1:6] AS windows FROM f WHERE n = 1 GROUP BY record)
  SELECT record, coalesce(windows, []) AS windows FROM d LEFT JOIN g USING (record)""")
def s_sentences(spark, sf_dir):
    return document_tokens(spark, sf_dir).select("record", text.sentence_windows(c("text"), c("token")).alias("windows"))


@query("s_windows", r"""WITH d AS (SELECT doc_id AS record, text, (['the', 'idiot', 'que', 'zz9'])[doc_id % 4 + 1] AS token FROM documents),
  s AS (SELECT record, token, list_transform(regexp_extract_all(text, '[^.!?。；;\n]*[.!?。；;\n]|[^.!?。；;\n]+$'), lambda x: trim(x)) AS p FROM d),
  h AS (SELECT record, p, unnest(list_filter(range(1, len(p) + 1), lambda i: regexp_matches(p[i], '(?i)(^|[^A-Za-z0-9])' || token || '([^A-Za-z0-9]|$)'))) AS i FROM s),
  w AS (SELECT record, i, trim(regexp_replace(translate(array_to_string(list_filter(p[greatest(i - 1, 1):i + 1], lambda x: x <> ''), ' '), '（），；：｜–—−', '(),;:|---'), '\s+', ' ', 'g')) AS w FROM h),
  f AS (SELECT record, i, w, row_number() OVER (PARTITION BY record, lower(w) ORDER BY i) AS n FROM w WHERE w <> ''),
  sent AS (SELECT record, list(substr(w, 1, 1400) ORDER BY i)[1:6] AS a FROM f WHERE n = 1 GROUP BY record),
  cut AS (SELECT record, text, token, string_split(lower(text), token) AS pieces, length(token) AS n FROM d),
  spots AS (SELECT record, text, n, list_filter(list_transform(range(1, len(pieces)), lambda k: CAST(list_sum(list_transform(pieces[1:k], lambda p: length(p))) AS BIGINT) + (k - 1) * n + 1),
    lambda i: NOT regexp_matches(substr(lower(text), i - 1, CASE WHEN i = 1 THEN 0 ELSE 1 END), '[a-z0-9]') AND NOT regexp_matches(substr(lower(text), i + n, 1), '[a-z0-9]')) AS places FROM cut),
  sp AS (SELECT record, list_filter(list_transform(places, lambda i: trim(regexp_replace(translate(substr(text, greatest(i - 300, 1), least(i - 1, 300) + n + 300), '（），；：｜–—−', '(),;:|---'), '\s+', ' ', 'g'))), lambda x: x <> '') AS w FROM spots),
  span AS (SELECT record, list_filter(w, lambda x, i: list_position(list_transform(w, lambda y: lower(y)), lower(x)) = i)[1:6] AS b FROM sp),
  every AS (SELECT d.record, d.token, coalesce(a, []) || coalesce(b, []) AS e FROM d LEFT JOIN sent USING (record) LEFT JOIN span USING (record))
  SELECT record, token, list_filter(e, lambda x, i: list_position(e, x) = i)[1:20] AS windows FROM every""")
def s_windows(spark, sf_dir):
    return documents.windows(document_tokens(spark, sf_dir), ["record", "token"], "text", "token")


@query("st_audit", "WITH d AS (SELECT doc_id AS record, text, (['the', 'idiot', 'que', 'zz9'])[doc_id % 4 + 1] AS token FROM documents) SELECT record, CASE WHEN regexp_matches(text, '(?i)(^|[^a-z0-9])' || token || '([^a-z0-9]|$)') THEN 'EXACT_TOKEN_IN_MD' WHEN regexp_matches(text, '(?i)(^|[^a-z0-9])(der)([^a-z0-9]|$)') THEN 'NORMALIZED_TOKEN_IN_MD' ELSE 'MD_FOUND_BUT_TOKEN_NOT_FOUND' END AS verdict FROM d")
def st_audit(spark, sf_dir):
    rows = document_tokens(spark, sf_dir).withColumn("standard", F.lit("der"))
    return documents.audit(rows, ["record"], "text", "token", "standard", F.array(F.lit("zzq")))


@query("agg_audit_summary", "WITH d AS (SELECT text, (['the', 'idiot', 'que', 'zz9'])[doc_id % 4 + 1] AS token FROM documents) SELECT CASE WHEN regexp_matches(text, '(?i)(^|[^a-z0-9])' || token || '([^a-z0-9]|$)') THEN 'EXACT_TOKEN_IN_MD' WHEN regexp_matches(text, '(?i)(^|[^a-z0-9])(der)([^a-z0-9]|$)') THEN 'NORMALIZED_TOKEN_IN_MD' ELSE 'MD_FOUND_BUT_TOKEN_NOT_FOUND' END AS verdict, count(*) AS n FROM d GROUP BY 1")
def agg_audit_summary(spark, sf_dir):
    return documents.audit_summary(st_audit(spark, sf_dir))


@query("src_zip_catalog", None)
def src_zip_catalog(spark, sf_dir):
    return doc_catalog(spark, sf_dir)


@query("src_sample", None)
def src_sample(spark, sf_dir):
    # by a hash of the key: the same rows however the table is partitioned
    return read(spark, sf_dir, "part").orderBy(F.xxhash64("p_partkey", F.lit(42)), "p_partkey").limit(80)


@query("j_density", None)
def j_density(spark, sf_dir):
    d = units.density(F.lit(None).cast("double"), c("slot"), F.lit("organic"), c("other"), c("name"), c("other"))
    told = lookup.once_each(cells(spark, sf_dir).select("id", "slot", "other", "name"), ["slot", "other", "name"], "d", d)
    return told.select("id", c("d.solution").alias("rho"), c("d.solute").alias("rho_solute"), c("d.source").alias("source"))


@query("snk_sanitize", "SELECT doc_id, CASE WHEN length(t) > 32000 THEN substr(t, 1, 31952) || ' ...[truncated]' ELSE t END AS cell FROM (SELECT doc_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g') AS t FROM documents)")
def snk_sanitize(spark, sf_dir):
    from tessera.sources.sinks import sanitize

    return read(spark, sf_dir, "documents").select("doc_id", sanitize(c("text")).alias("cell"))


@query("snk_risk_scan", None)
def snk_risk_scan(spark, sf_dir):
    from tessera.sources.sinks import bad_cells

    return bad_cells(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id", 30_000)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}


