"""Queries over the rules of tessera.functions.cleaning. The SQL is written by hand and holds its own copies of short lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import cleaning
from tessera.plans.adapters import pick, sql_list, sql_pick

Query = Callable[[SparkSession, str], DataFrame]
c = F.col

# ---- example cells ----
RAW_NAMES = [
    "(+)-camphor-10-sulfonic acid", "(±)-BINOL", "rac-lactide", "DL-alanine", "d-xyl", "L-Cl", "(-)-rac-menthol", " l- glucose ", "2.5% chitosan solution",
    "10 mg GO (graphene oxide) dispersion", "水溶液 PVA（聚乙烯醇）", "NaCl (sodium chloride)", "Nafion™ 117", "ESPA2 Model No. 4040", "water (aq)", "thin-film composite membrane", "GO@TiO2",
    "PVA/PEG blend", "ZIF-8", "PEBAX-1657A", "Kapton 300", "porous SiO2 nanoparticles", "sulfonated PEEK-15", "Drying at 20°C", "blowing dry", "post treatment", "stirring for 2 h",
    "room temperature", "plain", "", "  ", "gold", "Water", "TMC", "tmc", "zeta potential", "zeta-potential", "anti fouling", "a", "x y", "the gold film", "some resin", "gold film",
    "m-phenylenediamine", "ethanol", "NaCl salt", "fatty alcohol", "APTES silane", "copper nitrate", "resin", "various additives", "Casting", "0.5 mL H2O", "Porousmembrane",
]
MEMBRANES = [
    "RO", "reverse osmosis; NF", "polyamide ro membrane", "NF;UF; nf", "microfiltration；MD", "Forward Osmosis", "profile", "", " ; ", "unknown type", "TFC RO ", "mf module", "gas  separation",
    "membrane distillation", "ultrafiltration;pervaporation",
]
TEXTS = ["MPD ", "  ", "", "2  wt％", "x;y", "TMC"]
SOLVENTS = ["", "water", "ethanol", "n-hexane"]
CONTEXTS = ["", "in water phase", "Aqueous bath", "dry", "水相"]
SLOTS = ["aqueous_monomer", "organic_monomer", "additive", "modifier", "test_nacl"]
KEYWORDS = ["license", "EMAIL", "blue"]


def number(k: Column) -> Column:
    return F.when(k % 11 != 0, F.sqrt(k.cast("double")) / pick_double(k) * F.when(k % 4 == 0, -1.0).otherwise(1.0))


def pick_double(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, [1.0, 10.0, 1000.0, 100000.0, 10000000.0, 0.00001])), (k % 6 + 1).cast("int"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each part: id, name, membrane, first, second, slot, aqueous, organic, context, value."""
    k = c("p_partkey")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        k.alias("id"),
        F.when(k % 13 == 0, c("p_name")).otherwise(pick(RAW_NAMES, k)).alias("name"),
        pick(MEMBRANES, k).alias("membrane"),
        pick(TEXTS, k).alias("first"),
        pick(TEXTS, k * 5 + 1).alias("second"),
        pick(SLOTS, k * 3).alias("slot"),
        pick(SOLVENTS, k).alias("aqueous"),
        pick(SOLVENTS, k * 3 + 1).alias("organic"),
        pick(CONTEXTS, F.floor(k / 5)).alias("context"),
        number(k).alias("x"),
    )


RAW = f"""raw AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 13 = 0 THEN p_name ELSE {sql_pick(RAW_NAMES, 'p_partkey')} END AS name, {sql_pick(MEMBRANES, 'p_partkey')} AS membrane,
  {sql_pick(TEXTS, 'p_partkey')} AS "first", {sql_pick(TEXTS, 'p_partkey * 5 + 1')} AS "second", {sql_pick(SLOTS, 'p_partkey * 3')} AS slot, {sql_pick(SOLVENTS, 'p_partkey')} AS aqueous,
  {sql_pick(SOLVENTS, 'p_partkey * 3 + 1')} AS organic, {sql_pick(CONTEXTS, 'p_partkey // 5')} AS context,
  CASE WHEN p_partkey % 11 <> 0 THEN sqrt(CAST(p_partkey AS DOUBLE)) / ([1e0, 10e0, 1000e0, 100000e0, 10000000e0, 0.00001e0])[p_partkey % 6 + 1] * CASE WHEN p_partkey % 4 = 0 THEN -1e0 ELSE 1e0 END END AS x
  FROM part)"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def drop(x: str, *patterns: str) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def has(x: str, words: str) -> str:
    """x contains one of the words, which '|' separates."""
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words.split("|")) + ")"


def cut_stereo(x: str, pattern: str) -> str:
    cut = f"regexp_replace({x}, '(?i){pattern}', '')"
    return f"CASE WHEN length({cut}) >= 4 THEN {cut} ELSE {x} END"


def membrane(x: str, rules: str) -> str:
    items = f"list_filter(list_transform(regexp_split_to_array({x}, '[;；]+'), lambda t: lower({strip('t')})), lambda t: t <> '')"
    hits = f"list_filter(list_transform({items}, lambda t: CASE {rules} END), lambda t: t IS NOT NULL)"
    return f"list_filter({hits}, lambda t, i: list_position({hits}, t) = i)"


TYPES = [("reverse osmosis", "ro"), ("nanofiltration", "nf"), ("ultrafiltration", "uf"), ("microfiltration", "mf"), ("membrane distillation", "md"), ("forward osmosis", "fo")]
BY_WORD = " ".join(f"WHEN contains(t, '{w}') OR contains(' ' || t || ' ', ' {s} ') THEN '{s.upper()}'" for w, s in TYPES)
BY_PART = " ".join(f"WHEN contains(t, '{s}') OR contains(t, '{w}') THEN '{s.upper()}'" for w, s in TYPES)
TRIMMED = f"translate({strip('membrane')}, '　', ' ')"
SINGLE = f"regexp_replace({strip('membrane')}, '\\s+', ' ', 'g')"
STEREO = cut_stereo(cut_stereo(strip("name"), "^\\((\\+|-|±)\\)-\\s*"), "^(rac|dl|d|l)-\\s*")
BARE = drop(strip("name"), "\\d+(\\.\\d+)?%", "(?i)\\d+(\\.\\d+)?\\s*(mg|g|ml|mM|μM|nM|L|nm)", "(?i)溶液|solution|水溶液|aqueous|suspension|dispersion")
ENGLISH = strip(f"regexp_extract({BARE}, '\\(([A-Za-z\\s\\-,\\.0-9]+)\\)', 1)")
COMPONENT = drop(
    "name", "(?i)\\b(modified|crosslinked|sulfonated|nitro|anhydrous|free|mixed|aromatic|thin-film|composite|support|membrane|nanoparticles|netting|fabric|substrate|bilayer|self-standing|amorphous|porous)\\b",
    "@.*", "/.*", "-\\d+[A-Z]?$", "\\s+\\d+$",
)
# ---- fixed values: conditions of a process, one entry a rule ----
PROCESS = "|".join([
    "\\bdrying\\b", "\\bblowing\\b", "\\bwithout\\b", "\\bwith\\b", "\\bpost[- ]treatment\\b", "\\bpretreatment\\b", "\\bcuring\\b", "\\baging\\b", "\\bannealing\\b",
    "\\bcalcination\\b", "\\bsoaking\\b", "\\bimmersion\\b", "\\brinsing\\b", "\\bwashing\\b", "\\bstir(ring)?\\b", "\\bsonication\\b", "\\bultrasonic\\b", "\\bvacuum\\b", "\\bair\\b",
    "\\bnatural\\b", "°c", "℃", "\\btemperature\\b", "\\brt\\b", "\\broom temperature\\b", "\\bmin\\b", "\\bh\\b", "\\bhour(s)?\\b", "\\bday(s)?\\b",
])
LOW = f"lower({strip('name')})"
WORDS = f"regexp_split_to_array({LOW}, '\\s+')"
GENERAL, PROPERTY, METHOD = (sql_list(x) for x in (cleaning.GENERAL_WORDS, cleaning.PROPERTY_WORDS, cleaning.METHOD_WORDS))
TOO_GENERAL = f"""({LOW} = '' OR len({WORDS}) = 1 AND (list_contains({GENERAL} || {PROPERTY} || {METHOD}, regexp_replace({LOW}, '[^a-z]', '', 'g'))
    OR length(regexp_replace({LOW}, '[^a-z]', '', 'g')) <= 3 AND NOT regexp_full_match({strip('name')}, '[A-Z]{{2,3}}'))
  OR list_contains({PROPERTY} || {METHOD}, {LOW}) OR list_contains(list_transform({PROPERTY}, lambda w: regexp_replace(w, '[-\\s]', '', 'g')), regexp_replace({LOW}, '[-\\s]', '', 'g'))
  OR len({WORDS}) <= 2 AND len(list_filter({WORDS}, lambda w: length(w) >= 2 AND NOT list_contains({GENERAL}, regexp_replace(w, '[^a-z]', '', 'g')))) = 0
  OR regexp_full_match({LOW}, '(the|a|an|this|these|some|other|various|several)\\s+\\w+'))"""
LIQUID = "ethanol|methanol|isopropanol|propanol|butanol|glycerol|glycerin|acetone|acetonitrile|dmf|dmac|nmp|hexane|heptane|toluene|xylene|isopar|cyclohexanone|triethylamine|tea|aptes|teos|silane|iptes|mptms|tms|dopamine solution"
# ---- fixed values: words of solids, then parts of words ----
SOLID_WORDS = [
    "nacl", "licl", "sls", "sds", "mpd", "m-phenylenediamine", "piperazine", "pip", "tmc", "trimesoyl chloride", "camphorsulfonic acid", "csa", "pvp", "peg", "pei",
    "dopamine hydrochloride", "go", "graphene oxide", "nanoparticle", "nanotube", "oxide", "zeolite", "mof", "salt", "powder", "particle", "chloride", "sulfate",
]
SOLID_PARTS = ["chloride", "sulfate", "nitrate", "oxide", "nanoparticle", "powder", "salt"]
SOLID = "|".join(SOLID_WORDS + SOLID_PARTS)
FORM = f"CASE WHEN slot = 'test_nacl' THEN 'solid' WHEN {has(LOW, LIQUID)} THEN 'liquid' WHEN {has(LOW, SOLID)} THEN 'solid' WHEN {has(LOW, 'alcohol|amine')} THEN 'liquid' ELSE 'unknown' END"
PHASE = f"""CASE slot WHEN 'aqueous_monomer' THEN 'aqueous|column_hint|' || coalesce(nullif(aqueous, ''), 'water') WHEN 'organic_monomer' THEN 'organic|column_hint|' || organic
  WHEN 'test_nacl' THEN 'test_aqueous|column_hint|water' ELSE CASE WHEN {has('lower(context)', 'aqueous|water|水相')} THEN 'aqueous|row_context|' || coalesce(nullif(aqueous, ''), 'water')
  WHEN organic <> '' THEN 'organic|row_context|' || organic ELSE 'unknown|unknown' END END"""

SPECS: dict[str, tuple[Callable[[], Column], str]] = {
    "s_strip_stereo": (lambda: cleaning.strip_stereo(c("name")), STEREO),
    "s_preprocess_v0": (lambda: cleaning.without_amounts(c("name")), strip(drop(f"CASE WHEN length({ENGLISH}) > 2 THEN {ENGLISH} ELSE {BARE} END", "[\\(（].*?[\\)）]", "™|®|©", "(?i)Model\\s+No\\..*"))),
    "s_main_component_v0": (lambda: cleaning.main_component(c("name")), strip(COMPONENT)),
    "p_process_llm": (lambda: cleaning.is_process_condition(c("name")), f"({LOW} = '' OR regexp_matches({LOW}, '{PROCESS}'))"),
    "p_too_generic": (lambda: cleaning.is_too_general(c("name")), TOO_GENERAL),
    "s_join_texts": (
        lambda: cleaning.join_texts(F.array("first", "second", "slot")),
        "array_to_string(list_filter(list_transform([\"first\", \"second\", slot], lambda t: trim(regexp_replace(replace(t, '％', '%'), '\\s+', ' ', 'g'))), lambda t: t <> ''), ';')",
    ),
    "s_membrane": (lambda: cleaning.membrane_type(c("membrane")), f"CASE WHEN len({membrane(TRIMMED, BY_WORD)}) > 0 THEN array_to_string({membrane(TRIMMED, BY_WORD)}, '; ') ELSE nullif({TRIMMED}, '') END"),
    "s_membrane_v3": (lambda: cleaning.membrane_type_by_map(c("membrane")), f"CASE WHEN {SINGLE} = '' THEN membrane WHEN len({membrane(SINGLE, BY_PART)}) > 0 THEN array_to_string({membrane(SINGLE, BY_PART)}, '; ') ELSE {SINGLE} END"),
    "n_format_6g": (lambda: cleaning.format_six(c("x")), "CASE WHEN abs(x - trunc(x)) < 1e-12 THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE format('{:.6g}', x) END"),
    "n_phase_v1": (lambda: F.concat_ws("|", *[cleaning.phase_of_slot(c("slot"), c("aqueous"), c("organic"), c("context"))[f] for f in ("phase", "source", "solvent")]), PHASE),
    "n_form_v2": (lambda: cleaning.form_of_solute(c("name"), c("slot"))["form"], FORM),
}


def _query(name: str) -> Query:
    return lambda spark, sf_dir: raw(spark, sf_dir).select("id", SPECS[name][0]().alias("value"))


def s_evidence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cleaning.evidence_lines(c("text"), KEYWORDS)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.posexplode(found).alias("nth", "lines"))


EVIDENCE = r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), h AS (SELECT doc_id, l, unnest(list_filter(range(1, len(l) + 1), lambda i: regexp_matches(lower(l[i]), 'license|email|blue'))) AS i FROM d)
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS nth, array_to_string(l[greatest(i - 3, 1):i + 3], chr(10)) AS lines FROM h"""


def queries() -> dict[str, Query]:
    return {name: _query(name) for name in SPECS} | {"s_evidence_lines": s_evidence_lines}


def oracle_sql() -> dict[str, str]:
    return {name: f'WITH {RAW} SELECT id, {sql} AS "value" FROM raw' for name, (_, sql) in SPECS.items()} | {"s_evidence_lines": EVIDENCE}
