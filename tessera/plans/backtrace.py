"""Queries over the backtrace of names through documents, on papers, records and entities derived from the driver's tables.

A paper is a document under a file name of its own, with a sentence that defines, mentions or classes a name and a line with
its DOI. A record cites a paper in one of several ways, or none. An entity is a part with a name and up to four records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fixed, gates, predicates, text
from tessera.operators import backtrace, documents, lookup, resolve, steps
from tessera.plans import scalars as q
from tessera.plans.adapters import CELLS_SQL, cells, pick, sql_pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}
c = F.col


def query(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = (f, sql)
        return f

    return keep


# ------------------------------------------------------------------ adapters
SENTENCES = [
    "In brief, sodium dodecyl sulfate (SDS) was added to the bath.", "TMC (trimesoyl chloride) reacts at once.", "Here MPD stands for m-phenylenediamine in all cases.",
    "ZIF-8 is a commercial framework of that series.", "Then PEI was weighed twice.", "camphorsulfonic acid, abbreviated as CSA, buffers it.",
    "TEA, also known as triethylamine, was kept dry.", "The graphene oxide (GO-2) sheets stayed flat.", "Sulfuric acid (98 g, H2SO4 grade) was weighed.", "Nothing of note happened here.",
]
ENTITY_NAMES = ["SDS", "TMC", "MPD", "ZIF-8", "PEI", "CSA", "TEA", "GO-2", "H2SO4", "xylitol", "the", "sodium-dodecyl"]
QUERIES_ASKED = ["", "sodium dodecyl sulfate", "piperazine", ""]
KNOWN = {"SODIUM DODECYL SULFATE": "sodium lauryl sulfate", "EDA": "ethylenediamine"}


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, name, text."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    n = F.lpad(c("doc_id").cast("string"), 9, "0")
    said = pick(SENTENCES, c("doc_id") * 7 + 3)
    return d.select("doc_id", F.concat(F.lit("library/Paper-"), n, F.lit(".md")).alias("name"), F.concat("body", F.lit("\n"), said, F.lit("\nDOI: 10.1234/tessera"), n, F.lit("\n")).alias("text"))


_N = "lpad(CAST(doc_id AS VARCHAR), 9, '0')"
PAPERS = f"papers AS (SELECT doc_id, 'library/Paper-' || {_N} || '.md' AS name, coalesce(text, '') || chr(10) || {sql_pick(SENTENCES, 'doc_id * 7 + 3')} || chr(10) || 'DOI: 10.1234/tessera' || {_N} || chr(10) AS text FROM documents)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record, file, title, doi: a record cites the paper of its own number by DOI, file name, a longer file name, the start of its text, a few letters of it, or not at all."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    k, n = c("doc_id") % 7, F.lpad(c("doc_id").cast("string"), 9, "0")
    return d.select(
        c("doc_id").alias("record"),
        F.when(k == 1, F.concat(F.lit("Paper "), n, F.lit(".md"))).when(k == 2, F.concat(F.lit("papers/Paper-"), n, F.lit("-v2.md"))).otherwise("").alias("file"),
        F.when(k.isin(3, 5), F.substring("body", 1, 70)).when(k == 4, F.substring("body", 1, 14)).otherwise("").alias("title"),
        F.when(k.isin(0, 5), F.concat(F.lit("https://doi.org/10.1234/tessera"), n)).otherwise("").alias("doi"),
    )


RECORDS = f"""records AS (SELECT doc_id AS record, CASE doc_id % 7 WHEN 1 THEN 'Paper ' || {_N} || '.md' WHEN 2 THEN 'papers/Paper-' || {_N} || '-v2.md' ELSE '' END AS file,
  CASE WHEN doc_id % 7 IN (3, 5) THEN substr(coalesce(text, ''), 1, 70) WHEN doc_id % 7 = 4 THEN substr(coalesce(text, ''), 1, 14) ELSE '' END AS title,
  CASE WHEN doc_id % 7 IN (0, 5) THEN 'https://doi.org/10.1234/tessera' || {_N} ELSE '' END AS doi FROM documents)"""


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, name, query, sources."""
    p, k = spark.read.parquet(f"{sf_dir}/part.parquet"), c("p_partkey")
    sources = F.when(k % 11 == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0).cast("bigint"), k % 4), lambda i: (k * 3 + i * 17) % 1200))
    return p.select(k.alias("entity"), pick(ENTITY_NAMES, k).alias("name"), pick(QUERIES_ASKED, k * 5).alias("query"), sources.alias("sources"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name_key, cid, formula: compounds under the names of parts, and a few that papers define."""
    some = ["sodium lauryl sulfate", "trimesoyl chloride", "m-phenylenediamine", "triethylamine"]
    p = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.lower("p_name").alias("name_key")).agg(F.min("p_partkey").cast("string").alias("cid"), F.min_by("p_type", "p_partkey").alias("formula"))
    fixed_rows = spark.createDataFrame([(n, f"9{i}", f"F{i}") for i, n in enumerate(some)], "name_key string, cid string, formula string")
    return p.unionByName(fixed_rows)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.catalog(papers(spark, sf_dir), "doc_id", c("name"), "text")


# ------------------------------------------------------------------ documents of a record
def _clean(x: str) -> str:
    return q.drop(f"lower({q.doc(x)})", "https?://(dx\\.)?doi\\.org/", "\\.md$", "\\.[a-z0-9]{1,6}$", "[^a-z0-9一-鿿]+")


_TITLE = "list_filter(list_transform(string_split(text, chr(10))[1:40], lambda x: trim(regexp_replace({0}, '^[# ]+', ''))), lambda x: length(x) >= 12)[1]".format(q.doc("x"))
_STEM = "regexp_replace({0}, '(.)\\.[^.]*$', '\\1')"
_EITHER = "((contains({k}, {a}) AND length({a}) >= {r} * length({k})) OR (contains({a}, {k}) AND length({k}) >= {r} * length({a})))"
CANDIDATES = f"""{PAPERS}, {RECORDS}, t AS (SELECT doc_id, regexp_replace(name, '^.*/', '') AS base, coalesce({_TITLE}, '') AS title, regexp_extract(text, '(?i)\\b10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+') AS doi FROM papers),
cat AS (SELECT doc_id, {_clean('base')} AS file_key, {_clean(_STEM.format('base'))} AS stem_key, {_clean('title')} AS title_key, {_clean('doi')} AS doi_key FROM t),
r AS (SELECT record AS "row", list_distinct(list_filter([{_clean('file')}, {_clean("regexp_replace(file, '^.*/', '')")}, {_clean(_STEM.format("regexp_replace(file, '^.*/', '')"))}], lambda x: x <> '')) AS unordered,
  [{_clean('file')}, {_clean("regexp_replace(file, '^.*/', '')")}, {_clean(_STEM.format("regexp_replace(file, '^.*/', '')"))}] AS files, {_clean('title')} AS title, {_clean('doi')} AS doi FROM records),
a AS (SELECT *, substr(trim(regexp_replace(title, '[^a-z0-9]+', ' ', 'g')), 1, 60) AS start FROM r),
dix AS (SELECT doi_key AS k, min(doc_id) AS doc_id FROM cat WHERE doi_key <> '' GROUP BY 1), tix AS (SELECT title_key AS k, min(doc_id) AS doc_id FROM cat WHERE title_key <> '' GROUP BY 1),
fix AS (SELECT k, min(doc_id) AS doc_id FROM (SELECT file_key AS k, doc_id FROM cat UNION ALL SELECT stem_key, doc_id FROM cat) WHERE k <> '' GROUP BY 1),
fk AS (SELECT "row", unnest(files) AS f, unnest(range(len(files))) AS nth FROM a),
hits AS (SELECT "row", doc_id, 0 AS g, 0 AS nth, 'doi' AS method FROM a JOIN dix ON length(doi) >= 6 AND (doi = k OR (length(doi) >= 8 AND length(k) >= 8 AND {_EITHER.format(k='k', a='doi', r=0.55)}))
  UNION ALL SELECT "row", doc_id, 1, nth, 'filename' FROM fk JOIN fix ON f = k WHERE length(f) >= 4
  UNION ALL SELECT "row", doc_id, 1, nth, 'filename_stem' FROM fk JOIN fix ON {_EITHER.format(k='k', a='f', r=0.6)} WHERE length(f) >= 4 AND f NOT IN (SELECT k FROM fix)
  UNION ALL SELECT "row", doc_id, 2, 0, 'title_partial' FROM a JOIN tix ON length(k) >= 12 AND {_EITHER.format(k='k', a='start', r=0.3)} WHERE length(title) >= 12 AND length(start) >= 12),
sure AS (SELECT "row", doc_id, arg_min(method, g * 10 + nth) AS method, min(g * 10 + nth) AS place FROM hits GROUP BY 1, 2),
keys AS (SELECT "row", f FROM fk UNION SELECT "row", title FROM a), fields AS (SELECT doc_id, unnest([file_key, stem_key, title_key]) AS k FROM cat),
like_ AS (SELECT "row", doc_id, max(least(length(f), length(k))) AS score FROM keys JOIN fields ON (contains(k, f) OR contains(f, k)) AND length(f) >= 8 AND length(k) >= 8 GROUP BY 1, 2),
fuzzy AS (SELECT "row", arg_max(doc_id, score * 1000000000 - doc_id) AS doc_id FROM like_ l WHERE NOT EXISTS (SELECT 1 FROM sure s WHERE s."row" = l."row" AND s.doc_id = l.doc_id) GROUP BY 1),
found AS (SELECT "row", doc_id, method, place FROM sure UNION ALL SELECT "row", doc_id, 'fuzzy', 30 FROM fuzzy)"""


@query("j_doc_candidates", f'WITH {CANDIDATES} SELECT "row", doc_id, method FROM found')
def j_doc_candidates(spark, sf_dir):
    return documents.placed_candidates(records(spark, sf_dir), "record", "file", "title", "doi", catalog(spark, sf_dir)).drop("place")


@query("j_doc_first", f'WITH {CANDIDATES}, n AS (SELECT *, row_number() OVER (PARTITION BY "row" ORDER BY place, doc_id) AS nth FROM found) SELECT "row", doc_id, method FROM n WHERE nth = 1')
def j_doc_first(spark, sf_dir):
    return documents.first_candidate(documents.placed_candidates(records(spark, sf_dir), "record", "file", "title", "doi", catalog(spark, sf_dir)))


def _audit_sql() -> str:
    low, doi = (lambda x: f"lower({q.doc(x)})"), (lambda x: f"regexp_replace(regexp_replace(lower({q.doc(x)}), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', ''), '[\\s.,;]+$', '')")
    base = lambda x: f"regexp_replace({low(x)}, '^.*/', '')"
    return f"""WITH {PAPERS}, {RECORDS}, named AS (SELECT doc_id, regexp_replace(name, 'Paper-0', '10.1234/tessera0') AS name FROM papers),
m AS (SELECT doc_id, {low('name')} AS member, {base('name')} AS base, {_STEM.format(base('name'))} AS stem, {doi(base('name'))} AS doi FROM named),
r AS (SELECT record AS "row", {doi('doi')} AS doi, {base('file')} AS base, {_STEM.format(base('file'))} AS stem, substr(trim(regexp_replace({low('title')}, '[^a-z0-9]+', ' ', 'g')), 1, 40) AS start FROM records),
h AS (SELECT "row", doc_id, 0 AS tier, 'doi' AS method FROM r JOIN m ON r.doi <> '' AND (r.doi = m.doi OR (length(r.doi) >= 3 AND contains(m.member, r.doi)))
  UNION ALL SELECT "row", doc_id, 1, 'filename' FROM r JOIN m ON r.base <> '' AND r.base = m.base
  UNION ALL SELECT "row", doc_id, 2, 'filename_stem' FROM r JOIN m ON r.stem <> '' AND m.stem <> '' AND (r.stem = m.stem OR (least(length(r.stem), length(m.stem)) >= 3 AND (contains(m.stem, r.stem) OR contains(r.stem, m.stem))))
  UNION ALL SELECT "row", doc_id, 3, 'title_partial' FROM r JOIN m ON length(r.start) >= 12 AND contains(m.member, r.start)),
n AS (SELECT *, row_number() OVER (PARTITION BY "row" ORDER BY tier, doc_id) AS nth FROM h) SELECT "row", doc_id, method FROM n WHERE nth = 1"""


@query("j_doc_audit", _audit_sql())
def j_doc_audit(spark, sf_dir):
    named = papers(spark, sf_dir).withColumn("name", F.regexp_replace("name", "Paper-0", "10.1234/tessera0"))
    return documents.audited_document(records(spark, sf_dir), "record", "file", "title", "doi", named, "doc_id", "name")


# ------------------------------------------------------------------ names, queries, gates
PHRASES = [
    "and the sodium dodecyl sulfate solution", "solution of trimesoyl chloride, purity 99%", "m-phenylenediamine purchased from Sigma-Aldrich", "polyamide membrane", "TMC", "Piperazine",
    "triethylamine (99%)", "camphorsulfonic acid which was dried over silica", "graphene oxide", "x ethylene glycol", "aqueous NaCl 2 wt%", "n-hexane, anhydrous", "glass", "acid", "urea",
    "benzene-1,3,5-tricarbonyl trichloride", "followed by rinsing", "copper sulfate > 98% pure", "poly(vinyl alcohol)", "dopamine hydrochloride", "Beijing, China", "MOF-5", "calcium chloride", "(open bracket",
    "zinc nitrate hexahydrate reagent grade", "of ethanol", "hexane that boils", "commercial BW30 series", "$x$ toluene #3", "nitric acid (Aldrich, USA)", "1,4-dioxane", "an organic role",
]


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select("id", F.when(c("id") % 3 == 0, c("name")).otherwise(pick(PHRASES, c("id"))).alias("phrase"))


PHRASES_SQL = f"{CELLS_SQL}, phrases AS (SELECT id, CASE WHEN id % 3 = 0 THEN name ELSE {sql_pick(PHRASES, 'id')} END AS phrase FROM cells)"


def _asked(source: str, column: str, target: str) -> str:
    """CTEs that turn `column` of `source` into a registry's query, step by step."""
    cut = q.candidate(column)
    for p in fixed.QUERY_CUTS:
        cut = f"regexp_replace({cut}, '(?i){p}', '', 'g')"
    clauses = "q2"
    for w in fixed.QUERY_CLAUSES:
        clauses = q.edge(f"regexp_split_to_array({clauses}, '(?i)\\b{w}\\b')[1]")
    return f"""{target}_1 AS (SELECT *, {cut} AS q0 FROM {source}),
{target}_2 AS (SELECT *, trim(regexp_replace(regexp_replace({q.edge('q0')}, '(?i)^of\\s+', ''), '\\s+', ' ', 'g')) AS q1 FROM {target}_1),
{target}_3 AS (SELECT *, CASE WHEN contains(q1, ',') AND length(trim(split_part(q1, ',', 1))) >= 4 THEN trim(split_part(q1, ',', 1)) ELSE q1 END AS q2 FROM {target}_2),
{target} AS (SELECT * EXCLUDE (q0, q1, q2), {q.doc(clauses)} AS asked FROM {target}_3)"""


def _trusted(x: str) -> str:
    low, n = f"lower({x})", q.words(x)
    bad = " OR ".join(f"regexp_matches({low}, '{p}')" for p in fixed.QUERY_BAD_PATTERNS)
    ends = "(" + "|".join(fixed.CHEMICAL_ENDINGS) + ")$"
    return f"""(length({x}) BETWEEN 4 AND 120 AND NOT {q.has_any(low, fixed.BAD_CANDIDATE_PHRASES + fixed.BAD_QUERY_PHRASES)} AND {n} <= 8 AND NOT regexp_matches({x}, '^[A-Z0-9\\-_/]+$')
  AND NOT regexp_matches({x}, '^[A-Z][a-z]+$') AND NOT {q.generic(low)} AND NOT ({bad}) AND NOT regexp_matches({x}, ',\\s*[A-Z][a-z]+$') AND {q.keep(x, '(')} = {q.keep(x, ')')}
  AND NOT ({n} = 1 AND (length({x}) < 5 OR (regexp_matches({x}, '^[a-z]+$') AND NOT regexp_matches({low}, '{ends}')))))"""


def _expansion(x: str) -> str:
    """Over columns s (normalised), cut (without one or two letters before a name)."""
    hinted = q.has_any("lower(cut)", fixed.CHEMICAL_ENDINGS)
    one, ends = f"{q.words('cut')} = 1", "(" + "|".join(fixed.CHEMICAL_ENDINGS) + ")$"
    starts = " OR ".join(f"starts_with(lower(s), '{p}')" for p in fixed.EXPANSION_BAD_PREFIXES)
    early = " OR ".join(f"regexp_matches(lower(s), '{p}')" for p in fixed.EXPANSION_BAD_PATTERNS)
    late = " OR ".join(f"regexp_matches(lower(cut), '{p}')" for p in fixed.EXPANSION_LATE_PATTERNS)
    return f"""(length(s) BETWEEN 4 AND 120 AND NOT ({starts}) AND NOT {q.has_any('lower(s)', fixed.BAD_CANDIDATE_PHRASES)} AND NOT ({early}) AND NOT regexp_matches(s, '^[A-Z0-9\\-_/]+$') AND {q.keep('s', '(')} = {q.keep('s', ')')}
  AND {q.words('cut')} <= 8 AND NOT ({one} AND {q.one_of('lower(cut)', fixed.GENERIC_SINGLE_WORDS)}) AND NOT ({late}) AND NOT regexp_matches(cut, ',\\s*[A-Z][a-z]+$')
  AND NOT ({one} AND (length(cut) < 5 OR NOT regexp_matches(lower(cut), '{ends}'))) AND ({hinted} OR (regexp_matches(cut, '[A-Z]') AND regexp_matches(cut, '[a-z]')) OR contains(cut, '(') OR {q.words('cut')} >= 2))"""


def _with_cut(source: str, column: str, target: str) -> str:
    inner = "regexp_extract(lower(s), '^[a-z]{1,2}\\s+([a-z].+)$', 1)"
    return f"{target}_0 AS (SELECT *, {q.doc(column)} AS s FROM {source}), {target} AS (SELECT *, CASE WHEN {inner} <> '' AND {q.has_any(inner, fixed.CHEMICAL_ENDINGS)} THEN {inner} ELSE s END AS cut FROM {target}_0)"


_ONE = f"({_trusted('asked')} AND NOT {q.has_any('lower(asked)', fixed.MATERIAL_KEYWORDS)} AND NOT {q.has_any('lower(asked)', fixed.MATERIAL_CLASSES)} AND NOT regexp_matches(lower(asked), '\\b(series|model|grade|commercial|product|membrane)\\b'))"
_NEVER = "(?i)\\b(?:" + "|".join(fixed.NOT_WORTH_ASKING) + ")\\b"
#: RE2 has no lookahead: words that may not be followed by another one are cut with it first.
_ALWAYS = "(?i)\\b(?:" + "|".join(fixed.WORTH_ASKING).replace("(?!\\s+membrane)", "").replace("(?!\\s+sulfone)", "") + ")\\b"


@query("s_query_norm", f"WITH {PHRASES_SQL}, {_asked('phrases', 'phrase', 'told')} SELECT id, asked FROM told")
def s_query_norm(spark, sf_dir):
    return phrases(spark, sf_dir).select("id", gates.registry_query(c("phrase")).alias("asked"))


@query("p_trusted_std", f"WITH {PHRASES_SQL}, s AS (SELECT id, {q.doc('phrase')} AS s FROM phrases) SELECT id, {_trusted('s')} AS trusted FROM s")
def p_trusted_std(spark, sf_dir):
    return phrases(spark, sf_dir).select("id", gates.is_trusted_query(c("phrase")).alias("trusted"))


@query("p_trusted_exp", f"WITH {PHRASES_SQL}, {_with_cut('phrases', 'phrase', 'told')} SELECT id, {_expansion('s')} AS trusted FROM told")
def p_trusted_exp(spark, sf_dir):
    return phrases(spark, sf_dir).select("id", gates.is_trusted_expansion(c("phrase")).alias("trusted"))


@query("p_single_cid", f"WITH {PHRASES_SQL}, {_asked('phrases', 'phrase', 'told')} SELECT id, {_ONE} AS one FROM told")
def p_single_cid(spark, sf_dir):
    return phrases(spark, sf_dir).select("id", gates.may_have_one_compound(c("phrase")).alias("one"))


@query("p_chase", f"""WITH {PHRASES_SQL}, named AS (SELECT id, CASE WHEN {q.doc('phrase')} = '' THEN '' ELSE {q.core('phrase')} END AS core FROM phrases), {_asked('named', 'core', 'told')}
  SELECT id, CASE WHEN length(core) <= 1 OR regexp_matches(core, '{_NEVER}') THEN false
    WHEN regexp_matches(regexp_replace(core, '(?i)(oxide\\s+membrane|ether\\s+sulfone)', '', 'g'), '{_ALWAYS}') OR regexp_matches(trim(core), '^[A-Z][A-Z0-9]{{1,5}}$') THEN true
    WHEN {q.words('core')} = 1 AND length(core) < 4 THEN false ELSE {_ONE} END AS worth FROM told""")
def p_chase(spark, sf_dir):
    return phrases(spark, sf_dir).select("id", gates.worth_asking(c("phrase")).alias("worth"))


@query("st_align_gate", f"""WITH {PHRASES_SQL}, {_asked('phrases', 'phrase', 'told')}, {_with_cut('told', 'asked', 'cuts')},
  j AS (SELECT id, asked, {_trusted('asked')} AND (id % 2 = 1 OR {_expansion('s')}) AS accepted, {_ONE} AS one FROM cuts)
  SELECT id, accepted, CASE WHEN accepted THEN asked ELSE '' END AS clean_name, CASE WHEN NOT accepted THEN 'NO_CLUE' WHEN one THEN 'SPECIFIC_CHEMICAL' ELSE 'NO_SPECIFIC_CHEMICAL' END AS entity_type, CASE WHEN accepted THEN 0.62::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM j""")
def st_align_gate(spark, sf_dir):
    asked = phrases(spark, sf_dir).withColumn("abbreviation", c("id") % 2 == 0)
    return lookup.once_each(asked, ["phrase", "abbreviation"], "x", gates.aligned(c("phrase"), c("abbreviation"))).select("id", "x.*")


@query("s_tokens_bt")
def s_tokens_bt(spark, sf_dir):
    asked = cells(spark, sf_dir).select("id", "name", "other")
    return lookup.once_each(asked, ["name", "other"], "tokens", F.array_join(gates.search_tokens(c("name"), c("other")), "|")).select("id", "tokens")


def _audit_tokens_sql() -> str:
    s = q.doc("name")
    some = [s, q.doc("other"), f"replace({s}, '-', '')", f"replace({s}, '-', ' ')", f"regexp_replace({s}, '^\\d+\\s*-\\s*', '')", f"regexp_replace({s}, '\\((.*?)\\)', '\\1', 'g')"]
    aliases = " || ".join(f"CASE WHEN contains({s}, '{k}') THEN [{', '.join(x for a in v for x in (repr(a), f'replace({s}, {k!r}, {a!r})'))}] ELSE [] END" for k, v in fixed.TOKEN_ALIASES.items())
    return f"""WITH {CELLS_SQL}, t AS (SELECT id, list_filter(list_transform([{', '.join(some)}] || list_filter(list_transform(regexp_split_to_array({s}, '[-_/]'), lambda p: trim(p)), lambda p: length(p) >= 3) || {aliases}, lambda x: {q.doc('x')}), lambda x: x <> '') AS x FROM cells),
  l AS (SELECT id, x, list_transform(x, lambda y: lower(y)) AS low FROM t) SELECT id, array_to_string(list_filter(x, lambda y, i: list_position(low, lower(y)) = i)[1:12], '|') AS tokens FROM l"""


@query("s_tokens_audit", _audit_tokens_sql())
def s_tokens_audit(spark, sf_dir):
    return cells(spark, sf_dir).select("id", F.array_join(gates.audit_tokens(c("name"), c("other")), "|").alias("tokens"))


TOKENS = ["the", "que", "und", "MPD"]
#: Occurrences of a word of letters in DuckDB: pieces between them, told apart by what stands beside.
_PLACES = """d AS (SELECT doc_id, text, {token} AS token FROM papers),
  low AS (SELECT doc_id, text, lower(token) AS token, length(token) AS n, lower(text) AS t FROM d),
  cut AS (SELECT *, string_split(t, token) AS pieces FROM low),
  spots AS (SELECT doc_id, n, text, list_filter(list_transform(range(1, len(pieces)), lambda k: CAST(list_sum(list_transform(pieces[1:k], lambda p: length(p))) AS BIGINT) + (k - 1) * n + 1), lambda i: NOT regexp_matches(substr(t, i - 1, CASE WHEN i = 1 THEN 0 ELSE 1 END), '[a-z0-9]') AND NOT regexp_matches(substr(t, i + n, 1), '[a-z0-9]')) AS places FROM cut)"""


def tokened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).select("doc_id", "text", pick(TOKENS, c("doc_id")).alias("token"))


@query("s_first_occ", f"""WITH {PAPERS}, {_PLACES.format(token=sql_pick(TOKENS, 'doc_id'))},
  taken AS (SELECT doc_id, n, text, list_reduce(places, lambda s, i: CASE WHEN len(s) <= 3 AND i - 1 - s[len(s)] >= 100 AND length({q.doc('substr(text, greatest(i - 400, 1), least(i - 1, 400) + n + 400)')}) > 20 THEN s || [i - 1 + n] ELSE s END, [-999::BIGINT]) AS ends FROM spots)
  SELECT doc_id, list_transform(list_filter(ends, lambda e: e > 0), lambda e: substr({q.doc('substr(text, greatest(e - n - 399, 1), least(e - n, 400) + n + 400)')}, 1, 1400)) AS windows FROM taken""")
def s_first_occ(spark, sf_dir):
    return tokened(spark, sf_dir).select("doc_id", gates.first_occurrences(c("text"), c("token")).alias("windows"))


@query("s_spans", f"""WITH {PAPERS}, {_PLACES.format(token=sql_pick(TOKENS, 'doc_id'))},
  w AS (SELECT doc_id, list_filter(list_transform(places, lambda i: {q.doc('substr(text, greatest(i - 300, 1), least(i - 1, 300) + n + 300)')}), lambda x: x <> '') AS w FROM spots),
  l AS (SELECT doc_id, w, list_transform(w, lambda x: lower(x)) AS low FROM w) SELECT doc_id, list_filter(w, lambda x, i: list_position(low, lower(x)) = i)[1:6] AS windows FROM l""")
def s_spans(spark, sf_dir):
    return tokened(spark, sf_dir).select("doc_id", text.span_windows(c("text"), c("token")).alias("windows"))


# ------------------------------------------------------------------ candidates in a context
def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, token, context: the end of each paper, where its sentence stands, with the name that it is about."""
    p = papers(spark, sf_dir)
    said = c("doc_id") * 7 + 3
    return p.select(c("doc_id").alias("id"), pick(ENTITY_NAMES[:9] + ["note"], said).alias("token"), text.norm_text_doc(F.substring("text", F.greatest(F.length("text") - 400, F.lit(1)), F.lit(2000))).alias("context"))


def _captures_sql() -> str:
    parts = []
    for n, (pattern, score, rule) in enumerate(fixed.CONTEXT_RULES):
        p = "'(?i)" + pattern.replace("'", "''").replace("{token}", "' || token || '") + "'"
        parts.append(f"SELECT id, {n} AS rule_no, {score}::DOUBLE AS score, '{rule}' AS rule, unnest(regexp_extract_all(context, {p}, 1)) AS raw, unnest(regexp_extract_all(context, {p})) AS evidence, unnest(range(1000)[:len(regexp_extract_all(context, {p}))]) AS nth FROM ctx")
    hint = "'(?i)(^|[^A-Za-z0-9])' || token || '[^A-Za-z0-9].{0,149}?" + fixed.CLASS_HINTS + "'"
    return f"""WITH {PAPERS}, ctx AS (SELECT doc_id AS id, {sql_pick(ENTITY_NAMES[:9] + ['note'], 'doc_id * 7 + 3')} AS token, {q.doc('substr(text, greatest(length(text) - 400, 1), 2000)')} AS context FROM papers),
caught AS ({' UNION ALL '.join(parts)}), named AS (SELECT *, {q.candidate('raw')} AS whole FROM caught),
tails AS (SELECT *, trim(regexp_extract(whole, '[^,]*$')) AS tail FROM named),
cands AS (SELECT *, CASE WHEN contains(whole, ',') AND length(tail) BETWEEN 4 AND length(whole) THEN tail ELSE whole END AS candidate FROM tails),
good AS (SELECT * FROM cands WHERE NOT {_bad('candidate')}), nth AS (SELECT *, row_number() OVER (PARTITION BY id, lower(candidate) ORDER BY rule_no, nth) AS first FROM good)
SELECT id, candidate, score, rule, substr({q.doc('evidence')}, 1, 700) AS evidence FROM nth WHERE first = 1
UNION ALL SELECT id, '', 0.35::DOUBLE, 'class_hint', substr(trim(regexp_replace({q.doc('e')}, '^[^A-Za-z0-9]', '')), 1, 700) FROM (SELECT id, unnest(regexp_extract_all(context, {hint})) AS e FROM ctx)"""


def _bad(x: str) -> str:
    t = q.doc(x)
    return (
        f"(length({t}) NOT BETWEEN 4 AND 120 OR {q.words(f'lower({t})')} > 8 OR regexp_matches({t}, '^[A-Z0-9\\-_/]+$') OR {q.has_any(f'lower({t})', fixed.BAD_CANDIDATE_PHRASES)} "
        f"OR regexp_matches(lower({t}), '{predicates.one_of_patterns(fixed.CANDIDATE_BAD_STARTS)}') OR {q.keep(t, '(')} <> {q.keep(t, ')')} OR regexp_matches(lower({t}), '{predicates.one_of_patterns(fixed.CANDIDATE_BAD_PARTS)}'))"
    )


@query("x_candidates_ctx", _captures_sql())
def x_candidates_ctx(spark, sf_dir):
    return lookup.dealt(contexts(spark, sf_dir)).select("id", F.explode(gates.context_candidates(c("token"), c("context"))).alias("x")).select("id", "x.*")


# ------------------------------------------------------------------ the program
@query("st_bt_source")
def st_bt_source(spark, sf_dir):
    """Every entity with a source, traced through the first of them."""
    folder = steps.shared_folder(spark, "source")
    first = entities(spark, sf_dir).select(c("entity").alias("row"), "name", "query", F.get("sources", 0).alias("source")).filter("source is not null")
    known = records(spark, sf_dir)
    cited = known.join(first.select(c("source").alias("record")).distinct(), "record", "left_semi")
    found = backtrace.record_candidates(cited, catalog(spark, sf_dir), folder)
    asked = first.join(known.select(c("record").alias("source"), "record"), "source", "left")
    return backtrace.trace_source(asked, papers(spark, sf_dir), found, registry(spark, sf_dir), KNOWN, folder)


def traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtrace.backtrace(entities(spark, sf_dir), records(spark, sf_dir), papers(spark, sf_dir), catalog(spark, sf_dir), registry(spark, sf_dir), KNOWN, steps.shared_folder(spark, "backtrace"))


@query("st_bt_pipeline")
def st_bt_pipeline(spark, sf_dir):
    return traced(spark, sf_dir)


def merged(spark: SparkSession, sf_dir: str, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entities as a main table, and that with the trace merged in."""
    main = entities(spark, sf_dir).select("entity", "name", c("query").alias("standardized_query"), F.lit("").alias("formula"), F.lit("").alias("cid"), F.lit("NO_HIT").alias("lookup_status"))
    told = found.select("entity", c("status").alias("bt_status"), c("formula").alias("bt_formula"), c("cid").alias("bt_cid"), c("resolved").alias("bt_query"))
    over = resolve.merge_backtrace(main.drop("name"), told, "entity").drop("bt_status")
    rest = found.select("entity", c("source").alias("matched_source"), *backtrace.EVIDENCE, c("status").alias("bt_status"), c("cid").alias("bt_cid"))
    return main, over.join(main.select("entity", "name"), "entity").join(rest, "entity")


@query("proj_final_main")
def proj_final_main(spark, sf_dir):
    main, over = merged(spark, sf_dir, traced(spark, sf_dir))
    return backtrace.final_main(main, over)


@query("proj_evidence")
def proj_evidence(spark, sf_dir):
    _, over = merged(spark, sf_dir, traced(spark, sf_dir))
    return backtrace.evidence(over, ["entity", "name"])


@query("snk_bt_outputs")
def snk_bt_outputs(spark, sf_dir):
    """The rows of each delivered table, written and read again."""
    found = traced(spark, sf_dir)
    main, over = merged(spark, sf_dir, found)
    folder = steps.shared_folder(spark, "outputs")
    tables = backtrace.outputs(main, over, found, ["entity", "name"], resolve.REVIEW_STATUSES)
    backtrace.write_outputs(tables, folder)
    out = None
    for name in tables:
        n = spark.read.parquet(f"{folder}/{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = n if out is None else out.unionAll(n)
    return out


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
