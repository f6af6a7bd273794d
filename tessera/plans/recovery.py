"""Queries over concentrations that texts state, and over rows whose columns are known by their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import fixed
from tessera.operators import judge, lookup, recovery
from tessera.plans import scalars as q
from tessera.plans.adapters import pick, sql_list, sql_pick

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}
c = F.col


def query(name: str, sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[name] = (f, sql)
        return f

    return keep


# ------------------------------------------------------------------ adapters
STATED = [
    "First MPD at 2.0 wt% in water and TMC 0.15 % (w/v) in hexane were cast.", "SDS (0.1 wt%) and 1.1 wt % TEA; see doi: 10.1016/5 ppm there.", "Flux of 2000 ppm NaCl feed, MPD 0.5 mol/L, 15 mM SDS.",
    "The purity of MPD was 99 %, purchased from a store. It held TMC at 120 g/L.", "Nothing was weighed.", "PIP 2% and CSA 4 %; then 2% PIP again and 114169 mol/L MPD.", "TMC, TMC and 0.05 % (w/v) TMC.",
]
WORDS = [["MPD", "m-phenylenediamine"], ["TMC"], ["SDS", "TEA"], ["the", "PIP"], []]


def stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, content, words: each document with two sentences on concentrations, one before it and one behind."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    words = F.element_at(F.array(*[F.array(*map(F.lit, w)) if w else F.array().cast("array<string>") for w in WORDS]), (c("doc_id") % len(WORDS) + 1).cast("int"))
    return d.select("doc_id", F.concat(pick(STATED, c("doc_id")), F.lit(" "), "body", F.lit("\n"), pick(STATED, c("doc_id") * 3 + 1)).alias("content"), words.alias("words"))


_WORDS = "([" + ", ".join(sql_list(w) if w else "[]" for w in WORDS) + f"])[doc_id % {len(WORDS)} + 1]"
STATED_SQL = f"stated AS (SELECT doc_id, {sql_pick(STATED, 'doc_id')} || ' ' || coalesce(text, '') || chr(10) || {sql_pick(STATED, 'doc_id * 3 + 1')} AS content, {_WORDS} AS words FROM documents)"


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, snippets, words: the first and the last 300 characters of each text."""
    return stated(spark, sf_dir).select("doc_id", F.array(F.substring("content", 1, 300), F.substr("content", F.greatest(F.length("content") - 299, F.lit(1)), F.lit(300))).alias("snippets"), "words")


_UNITS = [u.replace("(?<![A-Za-z0-9])M(?![A-Za-z])", "M\\b") for u in fixed.TEXT_UNITS]
_PATTERN = "(?i)" + fixed.TEXT_NUMBER + "(" + "|".join(_UNITS) + ")"


def _numbers_sql(source: str, keys: str) -> str:
    """num: keys, start, stop, value, unit of the concentrations in `content` of `source`."""
    whole = f"regexp_extract_all(content, '{_PATTERN}')"
    return f"""cut AS (SELECT {keys}, content, {whole} AS m, regexp_extract_all(content, '{_PATTERN}', 1) AS v, regexp_extract_all(content, '{_PATTERN}', 2) AS u, regexp_split_to_array(content, '{_PATTERN}') AS pieces FROM {source}),
each AS (SELECT {keys}, content, unnest(range(1, len(m) + 1)) AS k, m, v, u, pieces FROM cut),
placed AS (SELECT {keys}, content, CAST(list_sum(list_transform(pieces[1:k], lambda p: length(p))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda p: length(p))), 0) AS BIGINT) AS start, length(m[k]) AS size, v[k] AS "value", trim(regexp_replace(u[k], '\\s+', ' ', 'g')) AS unit, m[k] AS whole FROM each),
num AS (SELECT {keys}, content, start, start + size AS stop, "value", unit FROM placed WHERE NOT (lower(unit) = 'm' AND regexp_matches(whole, '[0-9][mM]$')))"""


def _all_places(word: str, text: str) -> str:
    pieces = f"string_split(lower({text}), lower({word}))"
    return f"list_transform(range(1, len({pieces})), lambda k: CAST(list_sum(list_transform({pieces}[1:k], lambda p: length(p))) AS BIGINT) + (k - 1) * length({word}))"


@query("w_top_snippets", f"""WITH {STATED_SQL}, {_numbers_sql('stated', 'doc_id, words')},
spots AS (SELECT doc_id, list_sort(flatten(list_transform(words, lambda w: {_all_places('w', 'content')}))) AS places FROM stated),
s AS (SELECT doc_id, content, start, stop, unit, list_min(list_transform(places, lambda a: abs(start - a))) AS near FROM num JOIN spots USING (doc_id)),
scored AS (SELECT doc_id, start, CASE WHEN near <= 260 THEN greatest(1, 260 - near) ELSE 0 END + CASE WHEN regexp_matches(lower(unit), 'w/v|m/v|v/v|w/w|wt') THEN 40 ELSE 0 END AS score,
  trim(regexp_replace(substr(content, greatest(start - 260, 0) + 1, stop + 260 - greatest(start - 260, 0)), '\\s+', ' ', 'g')) AS snippet FROM s),
one AS (SELECT doc_id, snippet, score, start, row_number() OVER (PARTITION BY doc_id, snippet ORDER BY score DESC, start) AS n FROM scored WHERE score > 0),
r AS (SELECT doc_id AS key, snippet, CAST(score AS BIGINT) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, start) AS rank FROM one WHERE n = 1)
SELECT * FROM r WHERE rank <= 3""")
def w_top_snippets(spark, sf_dir):
    return recovery.top_snippets(stated(spark, sf_dir), "doc_id", "content", "words").withColumn("score", c("score").cast("long"))


_NOISE = "\\bdoi\\b|doi:|pmid|isbn|\\bpp\\.\\s*\\d|\\bpage\\b|\\bpages\\b|\\bvol\\.?\\s*\\d|issue\\s*\\d|fig\\.?\\s*\\d|table\\s*\\d|\\bref\\.?\\s*\\d|references?\\b|\\[\\d+\\]|copyright|accepted\\b|published\\b|received\\b|revised\\b|available online|http|www\\.|crossref|elsvier|wiley|springer"


@query("n_md_score", f"""WITH {STATED_SQL}, snips AS (SELECT doc_id, words, unnest([0, 1]) AS place, unnest([substr(content, 1, 300), substr(content, greatest(length(content) - 299, 1), 300)]) AS content FROM stated),
{_numbers_sql('snips', 'doc_id, place, words')}, kinds AS (SELECT *, {q.U} AS cu, {q.FAM} AS fam, TRY_CAST("value" AS DOUBLE) AS v FROM num),
real AS (SELECT *, list_filter(list_transform(words, lambda w: strpos(lower(content), lower(w)) - 1), lambda a: a >= 0) AS places FROM kinds
  WHERE NOT regexp_matches(lower(substr(content, greatest(start - 100, 0) + 1, stop + 100 - greatest(start - 100, 0))), '{_NOISE}')),
s AS (SELECT *, 1 + CASE WHEN fam <> 'unsupported' THEN 8 ELSE 0 END + CASE WHEN fam = 'percent_ambiguous' THEN 1 ELSE 0 END + CASE WHEN cu <> '%' THEN 2 ELSE 0 END
  - CASE WHEN regexp_matches(lower(substr(content, greatest(start - 40, 0) + 1, stop + 40 - greatest(start - 40, 0))), 'sigma|aldrich|purity|purchased|supplied by|>|≥') THEN 8 ELSE 0 END
  + coalesce(18 - least(list_min(list_transform(places, lambda a: abs(start - a))), 18), 0) AS score,
  CASE WHEN v IS NULL THEN 'unparseable_value' WHEN fam = 'molarity' AND regexp_matches(ltrim("value", '+-'), '^\\d{{5,}}$') THEN 'huge_integer_with_molarity_unit_likely_ref_id' WHEN fam = 'molarity' AND lower(cu) IN ('m', 'mol/l') AND abs(v) > 55 THEN 'molarity_M_out_of_sane_lab_range'
    WHEN fam = 'molarity' AND lower(cu) IN ('mm', 'mmol/l') AND abs(v) > 5e5 THEN 'mmolarity_out_of_range' WHEN cu = 'ppm' AND abs(v) > 1e9 THEN 'ppm_absurdly_high'
    WHEN (fam IN ('mass_fraction', 'mass_volume_percent', 'volume_fraction') OR lower(cu) IN ('%', 'wt%')) AND abs(v) > 100.000001 THEN 'percent_over_100' WHEN fam = 'mass_concentration' AND abs(v) > 1e12 THEN 'mass_conc_absurdly_high' ELSE 'ok' END AS sanity FROM real),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sanity = 'ok' DESC, score DESC, place, start) AS nth, count(*) OVER (PARTITION BY doc_id) AS candidates FROM s)
SELECT d.doc_id AS key, coalesce(sanity = 'ok', false) AS found, "value", unit, cu AS canonical_unit, fam AS unit_family, CAST(score AS BIGINT) AS score, sanity, coalesce(candidates, 0) AS candidates FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id AND nth = 1""")
def n_md_score(spark, sf_dir):
    return recovery.recovered(snippets(spark, sf_dir), "doc_id", "snippets", "words").drop("keyword").withColumn("score", c("score").cast("long"))


# ------------------------------------------------------------------ rows with named columns
def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, slot, phase and columns under the names that laboratories give them."""
    p, k = lookup.dealt(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand")), c("p_partkey")
    slots = [n for n, _ in fixed.SLOTS]
    return p.select(
        k.alias("id"), pick(slots, k).alias("slot"), pick([f for _, f in fixed.SLOTS], k).alias("phase"),
        F.when(k % 3 == 0, c("p_name")).otherwise("").alias("Sample Name"), F.when(k % 4 > 0, F.concat(F.lit(" 10.1/"), k.cast("string"))).alias("DOI"),
        F.when(k % 5 > 1, c("p_name")).otherwise("").alias("Paper Title"), F.concat(c("p_brand"), F.lit(".md")).alias("File"),
        pick(["0.99", "", "7.2", "1.05 g/mL", "-1"], k).alias("Aqueous density"), pick(["", "0.659", "abc", "0.8"], k).alias("organic Density"), pick(["1.2", "", "0"], k).alias("density of solution"),
        pick(["water", "", "ethanol"], k).alias("Aqueous solvent"), pick(["", "n-hexane", "toluene", ""], k * 3).alias("organic solvent"), pick(["", "DMF", "water"], k * 5 + 1).alias("solvent"),
    )


_K = "p_partkey"
WIDE_SQL = f"""wide AS (SELECT p_partkey AS id, {sql_pick([n for n, _ in fixed.SLOTS], _K)} AS slot, {sql_pick([f for _, f in fixed.SLOTS], _K)} AS phase, CASE WHEN {_K} % 3 = 0 THEN p_name ELSE '' END AS sample, CASE WHEN {_K} % 4 > 0 THEN '10.1/' || {_K} ELSE '' END AS doi,
  CASE WHEN {_K} % 5 > 1 THEN p_name ELSE '' END AS title, p_brand || '.md' AS file, {sql_pick(['0.99', '', '7.2', '1.05 g/mL', '-1'], _K)} AS da, {sql_pick(['', '0.659', 'abc', '0.8'], _K)} AS dorg, {sql_pick(['1.2', '', '0'], _K)} AS ds,
  {sql_pick(['water', '', 'ethanol'], _K)} AS sa, {sql_pick(['', 'n-hexane', 'toluene', ''], _K + ' * 3')} AS so, {sql_pick(['', 'dmf', 'water'], _K + ' * 5 + 1')} AS sg FROM part)"""


def named(df: DataFrame) -> dict:
    return {n: F.col(f"`{n}`") for n in df.columns if n not in ("id", "slot", "phase")}


@query("s_sample_text", f"WITH {WIDE_SQL}, l AS (SELECT id, list_filter([sample, title, file], lambda x: x <> '') AS x FROM wide) SELECT id, array_to_string(list_filter(x, lambda y, i: list_position(x, y) = i), ' | ') AS sample FROM l")
def s_sample_text(spark, sf_dir):
    df = wide(spark, sf_dir)
    return df.select("id", recovery.sample_text(named(df)).alias("sample"))


@query("s_meta", f"WITH {WIDE_SQL} SELECT id, doi, title, file AS filename_hint FROM wide")
def s_meta(spark, sf_dir):
    df = wide(spark, sf_dir)
    return df.select("id", recovery.row_metadata(named(df)).alias("m")).select("id", "m.*")


@query("n_density_col", f"""WITH {WIDE_SQL}, v AS (SELECT *, TRY_CAST(regexp_extract(da, '[-+]?[0-9.]+') AS DOUBLE) AS a, TRY_CAST(regexp_extract(dorg, '[0-9.]+') AS DOUBLE) AS o, TRY_CAST(regexp_extract(ds, '[0-9.]+') AS DOUBLE) AS s FROM wide),
  l AS (SELECT id, unnest(['Aqueous density', 'organic Density', 'density of solution']) AS col, unnest([0, 1, 2]) AS nr, unnest([a, o, s]) AS rho,
    unnest([1 + CASE WHEN slot = 'aqueous_monomer' THEN 2 WHEN slot IN ('additive', 'modifier') THEN 2 WHEN slot = 'test_nacl' THEN 2 ELSE 0 END, 1 + CASE WHEN slot = 'organic_monomer' THEN 2 WHEN slot IN ('additive', 'modifier') THEN 2 ELSE 0 END,
      1 + CASE WHEN slot IN ('additive', 'modifier') THEN 4 WHEN slot = 'test_nacl' THEN 2 ELSE 0 END]) AS score FROM v),
  n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, nr) AS nth FROM l WHERE rho > 0 AND rho <= 5)
  SELECT w.id, rho, CASE WHEN rho IS NULL THEN '' ELSE 'ROW_COLUMN::' || col END AS source FROM wide w LEFT JOIN n ON n.id = w.id AND nth = 1""")
def n_density_col(spark, sf_dir):
    df = wide(spark, sf_dir)
    return df.select("id", recovery.row_density(named(df), c("slot")).alias("d")).select("id", "d.*")


@query("n_solvent_row", f"""WITH {WIDE_SQL}, g AS (SELECT *, list_filter([sg, CASE WHEN sa = 'water' OR sg = 'water' THEN 'water' WHEN so = 'n-hexane' THEN so WHEN so = 'toluene' THEN so WHEN sa = 'ethanol' THEN sa WHEN sg = 'dmf' THEN sg ELSE '' END], lambda x: x <> '') AS every FROM wide)
  SELECT id, CASE WHEN phase = 'aqueous' THEN CASE WHEN sa <> '' THEN sa ELSE 'water' END WHEN phase = 'organic' THEN CASE WHEN so <> '' THEN so ELSE coalesce(list_filter(every, lambda x: x <> 'water')[1], '') END
    WHEN sa <> '' THEN sa WHEN len(list_distinct(every)) = 1 AND every[1] = 'water' THEN 'water' ELSE '' END AS solvent FROM g""")
def n_solvent_row(spark, sf_dir):
    df = wide(spark, sf_dir)
    return df.select("id", recovery.row_solvent(named(df), c("phase")).alias("solvent"))


REQUIRED = [["MW", "rho_solution"], ["Molar mass", "solute density", ""], ["temperature"], ["rho_solute", "viscosity", "density of solution"]]


@query("n_params", f"""WITH r AS (SELECT p_partkey AS id, ([{', '.join(sql_list(x) for x in REQUIRED)}])[p_partkey % 4 + 1] AS need, p_partkey % 3 > 0 AS mw, p_partkey % 5 > 0 AS rs, p_partkey % 2 = 0 AS ru, p_partkey % 7 > 3 AS assumed FROM part),
  s AS (SELECT id, list_filter(need, lambda x: x <> '') AS need, mw, rs, ru, assumed FROM r),
  t AS (SELECT id, need, rs AND assumed AS held, list_transform(need, lambda x: CASE WHEN x IN ('MW', 'Molar mass') THEN mw WHEN x IN ('rho_solution', 'density of solution') THEN rs WHEN x IN ('solute density', 'rho_solute') THEN ru ELSE false END) AS ok FROM s)
  SELECT id, array_to_string(list_filter(need, lambda x, i: ok[i]), '|') AS found, array_to_string(list_filter(need, lambda x, i: NOT ok[i]), '|') AS missing,
    array_to_string(list_transform(list_filter(need, lambda x: held AND x IN ('rho_solution', 'density of solution')), lambda x: x || ' (rho_solution assumed)'), '|') AS assumed FROM t""")
def n_params(spark, sf_dir):
    k = c("p_partkey")
    need = F.element_at(F.array(*[F.array(*map(F.lit, x)) for x in REQUIRED]), (k % 4 + 1).cast("int"))
    when = lambda test: F.when(test, F.lit(1.0))
    found = recovery.parameters(need, when(k % 3 > 0), when(k % 5 > 0), when(k % 2 == 0), k % 7 > 3, F.lit("g/L"))
    told = spark.read.parquet(f"{sf_dir}/part.parquet").select(k.alias("id"), found.alias("x"))
    return told.select("id", *[F.array_join(f"x.{n}", "|").alias(n) for n in ("found", "missing", "assumed")])


@query("st_mw", """WITH r AS (SELECT p_partkey AS id, p_partkey % 5 = 0 AS own, p_partkey % 2 = 0 AS trusted, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS cid, lower(p_name) AS n, CASE WHEN p_partkey % 11 = 0 THEN 'UNRESOLVED_ABBREVIATION' ELSE 'IDENTITY_TABLE_EXACT' END AS src FROM part),
  cache AS (SELECT 'cid::' || s_suppkey AS key, CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END AS mw FROM supplier WHERE s_suppkey % 6 = 0), cids AS (SELECT CAST(s_suppkey AS VARCHAR) AS cid, s_acctbal AS mw FROM supplier),
  names AS (SELECT lower(p_name) AS name_key, min(p_retailprice) AS mw FROM part WHERE p_size > 45 GROUP BY 1)
  SELECT r.id, CASE WHEN own AND trusted THEN 18.02 WHEN c.key IS NOT NULL THEN c.mw WHEN src = 'UNRESOLVED_ABBREVIATION' THEN NULL WHEN i.cid IS NOT NULL THEN i.mw ELSE m.mw END AS mw,
    CASE WHEN own AND trusted THEN 'IDENTITY_TABLE' WHEN c.key IS NOT NULL THEN 'PUBCHEM_CACHE' WHEN src = 'UNRESOLVED_ABBREVIATION' THEN 'MW_SKIPPED_UNRESOLVED_ABBREVIATION' WHEN i.cid IS NOT NULL THEN 'PUBCHEM_CID' WHEN m.mw IS NOT NULL THEN 'PUBCHEM_ORIGINAL_NAME' ELSE 'PUBCHEM_NOT_FOUND' END AS source
  FROM r LEFT JOIN cache c ON r.cid <> '' AND c.key = 'cid::' || r.cid LEFT JOIN cids i ON r.cid <> '' AND i.cid = r.cid LEFT JOIN names m ON m.name_key = r.n""")
def st_mw(spark, sf_dir):
    k = c("p_partkey")
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    rows = p.select(
        k.alias("id"), F.when(k % 5 == 0, 18.02).alias("mw"), (k % 2 == 0).alias("trusted"), F.when(k % 3 == 0, k.cast("string")).otherwise("").alias("cid"), F.lit("").alias("iupac"), F.lit("").alias("standard"),
        c("p_name").alias("solute"), F.when(k % 11 == 0, "UNRESOLVED_ABBREVIATION").otherwise("IDENTITY_TABLE_EXACT").alias("identity_source"),
    )
    cache = s.filter("s_suppkey % 6 = 0").select(F.concat(F.lit("cid::"), c("s_suppkey").cast("string")).alias("key"), F.when(c("s_suppkey") % 4 > 0, c("s_acctbal")).alias("mw"), F.lit(None).cast("string").alias("source"))
    by_name = p.filter("p_size > 45").groupBy(F.lower("p_name").alias("name_key")).agg(F.min("p_retailprice").alias("mw"))
    return recovery.molecular_weight(rows, "id", cache, s.select(c("s_suppkey").alias("cid"), c("s_acctbal").alias("mw")), by_name).withColumnRenamed("row", "id")


JUDGED = ["wt%", "%", "ppm", "g/L", "mg/L", "M", "v/v%", "w/v%", "furlongs", ""]


@query("st_mock_judge", f"""WITH i AS (SELECT p_partkey AS id, {sql_pick([n for n, _ in fixed.SLOTS], 'p_partkey * 3')} AS slot, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_name END AS solute, {sql_pick(['2.5', '', '1:4', 'lots', '40', '7', '8'], 'p_partkey')} AS v,
    {sql_pick(JUDGED, 'p_partkey')} AS unit, p_partkey % 13 = 5 AS multi, p_partkey % 2 = 0 AS wet FROM part),
  s AS (SELECT *, TRY_CAST(v AS DOUBLE) AS n, CASE WHEN solute = '' AND v = '' AND unit = '' THEN 'A' WHEN slot <> 'test_nacl' AND solute = '' THEN 'S' WHEN v = '' THEN 'V' WHEN unit = '' THEN 'U' WHEN multi THEN 'M' WHEN TRY_CAST(v AS DOUBLE) IS NULL THEN 'N' ELSE 'K' END AS st FROM i)
  SELECT id, CASE st WHEN 'K' THEN CASE WHEN unit = 'wt%' THEN n WHEN wet AND unit = 'ppm' THEN n / 10000.0 WHEN wet AND unit = 'g/L' THEN n / 10.0 WHEN wet AND unit = 'mg/L' THEN n / 10000.0 WHEN wet AND unit = 'w/v%' THEN n END END AS wt,
    CASE st WHEN 'A' THEN 'EMPTY_ALL' WHEN 'S' THEN 'EMPTY_SOLUTE' WHEN 'V' THEN 'EMPTY_VALUE' WHEN 'U' THEN 'EMPTY_UNIT' WHEN 'M' THEN 'MULTI_COUNT_MISMATCH' WHEN 'N' THEN CASE WHEN v = '1:4' THEN 'UNSUPPORTED_FORMAT' ELSE 'NON_NUMERIC_VALUE' END ELSE 'OK' END AS parse_status,
    CASE WHEN st IN ('M', 'N') THEN 'FAILED_PARSE' WHEN st <> 'K' THEN '' WHEN unit = 'wt%' THEN 'DIRECT_WT' WHEN unit IN ('%', 'M') THEN 'NEED_TRACEBACK' WHEN unit IN ('ppm', 'g/L', 'mg/L', 'w/v%') THEN CASE WHEN wet THEN 'ASSUMED_CONVERTED' ELSE 'NEED_TRACEBACK' END ELSE 'CANNOT_CONVERT' END AS status,
    CASE WHEN st = 'M' THEN 'MAPPING_RELATION' WHEN st <> 'K' OR unit IN ('wt%', 'v/v%') THEN '' WHEN unit = '%' THEN CASE WHEN slot = 'test_nacl' THEN 'PERCENT_TYPE|ORIGINAL_UNIT' WHEN slot IN ('aqueous_monomer', 'organic_monomer') THEN 'PERCENT_TYPE' ELSE 'PERCENT_TYPE|PHASE_TYPE' END
      WHEN unit = 'M' THEN CASE WHEN slot IN ('additive', 'modifier') THEN 'MOLECULAR_WEIGHT|DENSITY|SOLUTE_IDENTITY' ELSE 'MOLECULAR_WEIGHT|DENSITY' END WHEN unit = 'furlongs' THEN 'ORIGINAL_UNIT' WHEN wet THEN '' WHEN unit = 'ppm' THEN 'PHASE_TYPE|SOLVENT_TYPE' WHEN unit = 'w/v%' THEN 'DENSITY|PHASE_TYPE|SOLVENT_TYPE' ELSE 'PHASE_TYPE|DENSITY|SOLVENT_TYPE' END AS targets,
    CASE st WHEN 'A' THEN 0 WHEN 'V' THEN CASE WHEN solute = '' THEN 0 ELSE 1 END WHEN 'K' THEN CASE WHEN unit = 'wt%' THEN 0 WHEN wet AND unit IN ('ppm', 'g/L', 'mg/L', 'w/v%') THEN 1 ELSE 2 END ELSE 2 END AS review_flag FROM s""")
def st_mock_judge(spark, sf_dir):
    k = c("p_partkey")
    value = pick(["2.5", "", "1:4", "lots", "40", "7", "8"], k)
    slots = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        k.alias("id"), pick([n for n, _ in fixed.SLOTS], k * 3).alias("slot"), F.when(k % 6 == 0, "").otherwise(c("p_name")).alias("solute"), value.alias("value"), pick(JUDGED, k).alias("unit"),
        F.when(k % 13 == 5, "MULTI_UNRESOLVED").otherwise("ONE_TO_ONE").alias("mapping"), value.try_cast("double").alias("number"), pick(JUDGED, k).alias("canonical_unit"), F.when(k % 2 == 0, "aqueous").otherwise("organic").alias("phase"),
    )
    return judge.judge(slots, ["id"]).select("id", "wt", "parse_status", "status", F.array_join("targets", "|").alias("targets"), "review_flag")


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}
