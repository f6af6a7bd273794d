"""Queries over scalar functions: each applies one to a row for every part. The SQL is written by hand, apart from the engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays, fixed, numbers, predicates, text, units
from tessera.plans.adapters import CELLS_SQL, cells, sql_list

c = F.col
SPECS: dict[str, tuple[Callable[[], Column], str | None]] = {}


def spec(name: str, make: Callable[[], Column], sql: str | None) -> None:
    """A query `name`: id and value; sql is DuckDB's expression for the value, None where it has none."""
    SPECS[name] = (make, sql)


# ---------------------------------------------------------------- SQL pieces
def norm(x: str) -> str:
    return f"trim(regexp_replace(translate(coalesce({x}, ''), chr(12288) || chr(160) || '％μµ', '  %uu'), '\\s+', ' ', 'g'))"


def key(x: str) -> str:
    return f"trim(regexp_replace(translate(lower({norm(x)}), '（），；', '(),;'), '\\s+', ' ', 'g'))"


def simple(x: str) -> str:
    return f"regexp_replace({key(x)}, '[\\s\\-_.,;:()\\[\\]{{}}/\\\\]+', '', 'g')"


def compact(x: str) -> str:
    return f"regexp_replace({norm(x)}, '[\\s\\-_/\\\\.()]+', '', 'g')"


def doc(x: str) -> str:
    return f"trim(regexp_replace(translate(coalesce({x}, ''), '（），；：｜–—−', '(),;:|---'), '\\s+', ' ', 'g'))"


def quote_off(x: str) -> str:
    return f"CASE WHEN regexp_matches({norm(x)}, '^[''’‘].') THEN trim(substr({norm(x)}, 2)) ELSE {norm(x)} END"


def keep(x: str, kept: str) -> str:
    return f"length(regexp_replace({x}, '[^{kept}]', '', 'g'))"


def has_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(x, w.replace("'", "''")) for w in words) + ")"


def one_of(x: str, words: list[str]) -> str:
    return f"list_contains({sql_list(words)}, {x})"


def tokens(x: str) -> str:
    stop = sql_list(fixed.SIMILARITY_STOP)
    return f"list_distinct(list_filter(regexp_extract_all({key(x)}, '[a-z0-9]{{2,}}'), lambda t: NOT list_contains({stop}, t)))"


def jaccard(x: str, y: str) -> str:
    a, b = tokens(x), tokens(y)
    both = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END"


def short_abbr(x: str) -> str:
    t = compact(x)
    return f"(regexp_matches({t}, '^[A-Za-z0-9]{{1,6}}$') AND {keep(t, 'A-Za-z')} > 0 AND {keep(t, 'A-Z')} * 5 >= {keep(t, 'A-Za-z')} * 3)"


NUM = "[-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?"
RANGE = f"^\\s*({NUM})\\s*[-~～至到–—]\\s*({NUM})\\s*$"
POWER = "^\\s*(?:([-+]?\\d*\\.?\\d+)\\s*x\\s*)?10\\s*\\^\\s*([+-]?\\d+)\\s*$"
MONTHS = "(?i)\\b(january|february|march|april|may|june|july|august|september|october|november|december)\\b"


def date_junk(x: str) -> str:
    return f"(regexp_matches({norm(x)}, '\\d+\\s*月\\s*\\d+\\s*日') OR (regexp_matches({norm(x)}, '{MONTHS}') AND regexp_matches({norm(x)}, '\\d')))"


def ratio_only(x: str) -> str:
    return f"regexp_matches({norm(x)}, '^\\d+(\\s*:\\s*|(?i:\\s+and\\s+))\\d+$')"


def power(x: str) -> str:
    t = f"translate(regexp_replace({quote_off(x)}, '[−–—⁻]', '-', 'g'), '×X', 'xx')"
    factor = f"coalesce(TRY_CAST(nullif(regexp_extract({t}, '{POWER}', 1), '') AS DOUBLE), 1.0)"
    return f"CASE WHEN regexp_matches({t}, '{POWER}') THEN {factor} * pow(10.0, TRY_CAST(regexp_extract({t}, '{POWER}', 2) AS DOUBLE)) END"


def middle(x: str) -> str:
    t = f"replace({quote_off(x)}, ',', '')"
    ends = [f"TRY_CAST(regexp_extract({t}, '{RANGE}', {i}) AS DOUBLE)" for i in (1, 2)]
    return f"CASE WHEN regexp_matches({t}, '{RANGE}') AND NOT {date_junk(t)} AND NOT {ratio_only(t)} THEN ({ends[0]} + {ends[1]}) / 2.0 END"


def number(x: str) -> str:
    t = f"replace({quote_off(x)}, ',', '')"
    many = f"(regexp_matches({t}, '(^|[^eE])[~～至到–—]|(^|[^eE\\s])\\s*[-–—]\\s*|^\\s*[-]') AND len(regexp_extract_all({t}, '{NUM}')) > 1)"
    return f"coalesce({power(x)}, CASE WHEN NOT {many} AND NOT {ratio_only(t)} THEN TRY_CAST(nullif(regexp_extract({t}, '{NUM}'), '') AS DOUBLE) END)"


def edge(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[ ,;:\\-]+', ''), '[ ,;:\\-]+$', '')"


def marks(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[ ;,]+', ''), '[ ;,]+$', '')"


def drop(x: str, *patterns: str) -> str:
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    return x


def unit_fixed(x: str) -> str:
    t = f"translate({norm(x)}, '％μµ−–—⁻·．／', '%uu----../')"
    t = f"regexp_replace({t}, '([A-Za-z])\\?1\\b', '\\1-1', 'g')"
    t = f"regexp_replace({t}, '(?i)\\b(g|mg|ug|ng|mol|mmol|monomoles)(?:\\.|\\s+)L-1\\b', '\\1/L', 'g')"
    t = f"regexp_replace({t}, '(?i)\\b(mg|g)(?:\\.|\\s+)mL-1\\b', '\\1/mL', 'g')"
    t = f"trim(regexp_replace({t}, '(?i)\\b(of|in)\\b.*$', '', 'g'))"
    t = f"regexp_replace({t}, '(?i)w\\s*/\\s*v\\s*\\.\\s*%', 'w/v%', 'g')"
    t = f"regexp_replace({t}, '(?i)wt\\s*/\\s*v(?:ol)?\\s*%', 'wt/v%', 'g')"
    return f"trim(regexp_replace(CASE WHEN regexp_matches({t}, '(?i)^%\\s*\\(aqueous\\)$') THEN '%' ELSE {t} END, '\\s+', ' ', 'g'))"


def sql_map(values: dict[str, str], k: str) -> str:
    return "CASE " + k + " " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in values.items()) + " END"


def unit_parts(x: str) -> tuple[str, str]:
    """(canonical unit, family) expressions."""
    raw = unit_fixed(x)
    k = f"translate(regexp_replace(lower({raw}), '\\s+', '', 'g'), '[]{{}}', '()()')"
    rules = [
        (f"{raw} = ''", "''", "unsupported"),
        (one_of(k, ["%", "percent"]), "'%'", "percent_ambiguous"),
        (f"({one_of(k, fixed.MASS_FRACTION)} OR regexp_matches({k}, 'bymass|w/w|m/m'))", "'wt%'", "mass_fraction"),
        (one_of(k, fixed.GRAMS_PER_100ML), "'g/100mL'", "mass_volume_percent"),
        (one_of(k, fixed.MASS_VOLUME), "'w/v%'", "mass_volume_percent"),
        (one_of(k, list(fixed.MASS_CONCENTRATION)), sql_map(fixed.MASS_CONCENTRATION, k), "mass_concentration"),
        (one_of(raw, ["M", "mM"]), raw, "molarity"),
        (one_of(k, list(fixed.MOLARITY)), sql_map(fixed.MOLARITY, k), "molarity"),
        (one_of(k, list(fixed.VOLUME_FRACTION)), sql_map(fixed.VOLUME_FRACTION, k), "volume_fraction"),
        (one_of(k, list(fixed.PPM_FAMILY)), sql_map(fixed.PPM_FAMILY, k), "ppm_family"),
    ]
    unit = "CASE " + " ".join(f"WHEN {test} THEN {u}" for test, u, _ in rules) + f" ELSE {raw} END"
    family = "CASE " + " ".join(f"WHEN {test} THEN '{f}'" for test, _, f in rules) + " ELSE 'unsupported' END"
    return unit, family


def split_multi(x: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({norm(x)}, '[;；]+'), lambda t: trim(t)), lambda t: t <> '')"


def solvent(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {has_any(key(x), aliases)} THEN '{name}'" for name, aliases in fixed.SOLVENT_ALIASES) + " ELSE '' END"


def phase_tags(x: str) -> str:
    t = drop(f"coalesce({x}, '')", "(?i)\\((water phase|aqueous phase|oil phase|organic phase)\\)\\s*$", "(?i)\\((water|aqueous|oil|organic)\\)\\s*$")
    return marks(drop(t, "[（(]\\s*(水相|油相|有机相)\\s*[)）]\\s*$", "\\s*(水相|油相|有机相)\\s*$"))


def concentration(x: str) -> str:
    t = drop(f"coalesce({x}, '')", "(?i)^\\s*\\d+(\\.\\d+)?\\s*(wt%|vol%|mol%|%|ppm|ppb)\\s*", "(?i)^\\s*\\d+(\\.\\d+)?\\s*(mg/l|g/l|mg|g|kg|ml|l|mM|uM|μM|nM|M)\\s*")
    t = drop(phase_tags(t), "(?i)\\b(aqueous solution|solution|suspension|dispersion|buffer)\\b\\s*$")
    b = "^(.*\\S)\\s*\\(([^()]*)\\)\\s*$"
    inner = f"trim(regexp_extract({t}, '{b}', 2))"
    out = f"(regexp_matches({inner}, '^[A-Za-z0-9+\\-]{{1,18}}$') OR {has_any(f'lower({inner})', ['water phase', 'aqueous phase', 'water', 'aqueous', 'oil', '水相', '油相', '有机相', '水溶液', '溶液'])})"
    return marks(f"regexp_replace(CASE WHEN regexp_matches({t}, '{b}') AND {out} THEN trim(regexp_extract({t}, '{b}', 1)) ELSE {t} END, '\\s+', ' ', 'g')")


def core(x: str) -> str:
    s = f"trim(coalesce({x}, ''))"
    t = f"trim({drop(s, chr(92) + 's*' + chr(92) + '([^)]*' + chr(92) + ')' + chr(92) + 's*$')})"
    for p in (fixed.CORE_QUANTITY, fixed.CORE_SUFFIXES, "(?i)^(?:" + "|".join(fixed.CORE_PREFIXES) + ")*"):
        t = f"trim(regexp_replace({t}, '{p}', ''))"
    return f"CASE WHEN {t} = '' THEN {s} ELSE {t} END"


def candidate(x: str) -> str:
    t = doc(x)
    for p in fixed.CANDIDATE_STARTS:
        t = f"regexp_replace({t}, '{p}', '')"
    t = edge(f"regexp_replace({edge(t)}, '{fixed.CANDIDATE_VERBS}', '')")
    t = f"regexp_replace(regexp_replace({t}, '{fixed.CANDIDATE_LEADS}', ''), '^[a-z]{{1,2}}\\s+([a-z].*)$', '\\1')"
    return edge(t)


def words(x: str) -> str:
    return f"CASE WHEN trim({x}) = '' THEN 0 ELSE len(regexp_split_to_array(trim({x}), '\\s+')) END"


def abbr_like(x: str) -> str:
    t = doc(x)
    shapes = "^([A-Z]{2,10}|[A-Z0-9]{3,16}|[A-Za-z0-9]+(-[A-Za-z0-9]+){1,5}|[0-9,]+-[A-Za-z0-9]+(-[A-Za-z0-9]+)*)$"
    return f"(length({t}) > 2 AND (regexp_matches({t}, '{shapes}') OR (contains({t}, '(') AND contains({t}, ')') AND {keep(t, 'A-Z')} >= 2)))"


def generic(x: str) -> str:
    t = f"lower({doc(x)})"
    return f"({t} = '' OR {one_of(t, fixed.GENERIC_NAMES + fixed.GENERIC_SINGLE_WORDS)})"


def process(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    timed = "\\b(at|for|during)\\b.*\\b\\d+(\\.\\d+)?\\s*(min|h|hr|hrs|hour|hours|day|days)\\b"
    return f"({has_any(t, predicates.PROCESS_WORDS)} OR regexp_matches({t}, '\\b\\d+(\\.\\d+)?\\s*°\\s*c\\b') OR regexp_matches({t}, '{timed}'))"


def brand(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    return f"({has_any(t, predicates.BRANDS)} OR regexp_matches({t}, '\\b(sw30|bw30|tw30)\\w*\\b'))"


def model(x: str) -> str:
    return f"(regexp_matches({x}, '(?i)\\b(TW30|BW30|SW30|XLE|NF90|NF270|RO)\\b') OR regexp_matches({x}, '^[A-Za-z]{{1,5}}\\d[\\w\\-]{{2,}}$'))"


def measure(x: str) -> str:
    return f"(regexp_matches({x}, '\\d') AND {has_any(f'lower({x})', predicates.MEASURE_UNITS)})"


def listed(x: str) -> str:
    n = lambda m: f"len(list_filter(string_split({x}, '{m}'), lambda p: trim(p) <> '')) >= 2"
    return f"(CASE WHEN regexp_matches({x}, '^\\d+,\\d+[-(]') THEN false WHEN contains({x}, '/') AND NOT regexp_matches({x}, '\\d+/\\d+') THEN {n('/')} WHEN contains({x}, ';') THEN {n(';')} ELSE regexp_matches({x}, '(?i)\\band\\b|\\b\\+\\b') END)"


def likeness(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '\\d+,\\d+|\\d+-') THEN 0.7 ELSE 0.0 END::DOUBLE + CASE WHEN {has_any(f'lower({x})', predicates.CHEM_HINTS)} THEN 0.6 ELSE 0.0 END::DOUBLE + CASE WHEN length({x}) >= 8 THEN 0.2 ELSE 0.0 END::DOUBLE)"


def skip(x: str) -> str:
    low = f"lower({x})"
    return (
        f"CASE WHEN {x} = '' THEN 'EMPTY' WHEN {process(x)} THEN 'PROCESS_CONDITION' WHEN {brand(x)} THEN 'BRAND_OR_PRODUCT' WHEN {model(x)} THEN 'MODEL_CODE' "
        f"WHEN {measure(x)} THEN 'MEASUREMENT' WHEN {listed(x)} THEN 'MULTI_COMPONENT' WHEN {has_any(low, predicates.POLYMER_HINTS)} AND {likeness(x)} < 0.6 THEN 'POLYMER_OR_BIOMATERIAL' "
        f"WHEN {has_any(low, predicates.MATERIAL_HINTS)} AND {likeness(x)} < 0.4 THEN 'MATERIAL_OR_SYSTEM' END"
    )


def sanity(v: str, family: str, unit: str) -> str:
    n, u = number(v), f"lower({unit})"
    digits = f"regexp_replace({norm(v)}, '^[+-]+', '')"
    molar = f"({family} = 'molarity' OR {one_of(u, ['m', 'mm', 'mol/l', 'mmol/l'])})"
    percent = f"({one_of(family, ['mass_fraction', 'mass_volume_percent', 'volume_fraction'])} OR {one_of(u, ['%', 'wt%'])})"
    return (
        f"CASE WHEN {n} IS NULL THEN 'unparseable_value' WHEN {molar} AND regexp_matches({digits}, '^\\d{{5,}}$') THEN 'huge_integer_with_molarity_unit_likely_ref_id' "
        f"WHEN {molar} AND {one_of(u, ['m', 'mol/l'])} AND abs({n}) > 55.0 THEN 'molarity_M_out_of_sane_lab_range' WHEN {molar} AND {one_of(u, ['mm', 'mmol/l'])} AND abs({n}) > 5e5 THEN 'mmolarity_out_of_range' "
        f"WHEN {family} = 'ppm_family' AND {u} = 'ppm' AND abs({n}) > 1e9 THEN 'ppm_absurdly_high' WHEN {percent} AND abs({n}) > 100.000001 THEN 'percent_over_100' "
        f"WHEN {family} = 'mass_concentration' AND abs({n}) > 1e12 THEN 'mass_conc_absurdly_high' ELSE 'ok' END"
    )


U, FAM = unit_parts("unit")

# ---------------------------------------------------------------- text
spec("s_norm_text", lambda: text.norm_text(c("name")), norm("name"))
spec("s_norm_key", lambda: text.norm_key(c("name")), key("name"))
spec("s_simpl_key", lambda: text.simplify_key(c("name")), simple("name"))
spec("s_abbr_key", lambda: text.abbr_key(c("name")), f"upper({compact('name')})")
spec("s_excel_quote", lambda: text.strip_leading_quote(c("value")), quote_off('"value"'))
spec("s_norm_text_bt", lambda: text.norm_text_doc(c("name")), doc("name"))
spec("s_clean_key", lambda: text.clean_key(c("doi")), drop(f"lower({doc('doi')})", "https?://(dx\\.)?doi\\.org/", "\\.md$", "\\.[a-z0-9]{1,6}$", "[^a-z0-9一-鿿]+"))
spec("s_unify", lambda: text.unify(c("name")), None)
spec("s_spelling", lambda: text.normalize_spelling(c("name")), "regexp_replace(regexp_replace(regexp_replace(regexp_replace(name, '(?i)sulph', 'sulf', 'g'), '(?i)aluminium', 'aluminum', 'g'), '(?i)caesium', 'cesium', 'g'), '(?i)fibre', 'fiber', 'g')")
spec("s_strip_phase", lambda: text.strip_phase_tags(c("name")), phase_tags("name"))
spec("s_strip_conc", lambda: text.strip_concentration(c("name")), concentration("name"))
spec("s_strip_nano", lambda: text.strip_nano(c("name")), marks(f"regexp_replace({drop('regexp_replace(name, ' + chr(39) + '纳米颗粒|纳米粒子' + chr(39) + ', ' + chr(39) + 'nanoparticles' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')', '[-_]' + chr(92) + 's*(NPs?|nps?)' + chr(92) + 'b', '(?i)' + chr(92) + 'b(nanoparticles?|nanosheets?|nanofillers?|nanorods?)' + chr(92) + 'b')}, '\\s+', ' ', 'g')"))
spec("s_cleanup_cand", lambda: text.cleanup_candidate(c("name")), candidate("name"))
spec("s_core_name", lambda: text.core_name(c("name")), core("name"))
VARIANTS = (
    f"[{doc('name')}, trim(regexp_replace(regexp_replace(regexp_replace({doc('name')}, '(?i)\\b(nanoparticles?|nps?)\\b', '', 'g'), '纳米颗粒', '', 'g'), '[-\\s]+$', '')), "
    f"trim(regexp_extract({doc('name')}, '^(.+?)\\s*\\([^()]+\\)\\s*$', 1)), CASE WHEN contains({doc('name')}, '·') THEN replace({doc('name')}, '·', '.') ELSE '' END]"
)
DISTINCT_VARIANTS = f"list_filter({VARIANTS}, lambda x, i: x <> '' AND list_position({VARIANTS}, x) = i)"
spec("s_variants", lambda: F.array_join(text.query_variants(c("name")), "|"), f"array_to_string({DISTINCT_VARIANTS}, '|')")
spec("s_candidates", lambda: F.array_join(text.candidate_names(c("name")), "|"), None)
spec("s_tok_set", lambda: F.array_join(F.array_sort(text.similarity_tokens(c("name"))), "|"), f"array_to_string(list_sort({tokens('name')}), '|')")
spec("s_tok_set3", lambda: F.array_join(F.array_sort(text.match_tokens(c("name"))), "|"), f"array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower({doc('name')}), '[a-z]{{3,}}'), lambda t: NOT list_contains(['with', 'from', 'into', 'acid'], t)))), '|')")
spec("s_jaccard", lambda: F.round(text.token_jaccard(c("name"), c("other")), 9), f"round({jaccard('name', 'other')}, 9)")
spec("s_similarity", lambda: F.round(text.similarity(c("name"), c("other")), 9), None)
spec("s_likeness", lambda: F.round(predicates.chemical_likeness(c("name")), 6), f"round({likeness('name')}, 6)")
spec("s_cell_text", lambda: text.cell_text(c("cell")), "trim(regexp_replace(translate(cell, chr(12288) || '（）【】；，', ' ()[];,'), '\\s+', ' ', 'g'))")
spec("s_match_key", lambda: text.match_key(c("name")), "lower(trim(regexp_replace(translate(name, '（）；，–—−', '();,---'), '\\s+', ' ', 'g')))")
spec("s_clean_token", lambda: text.clean_token(c("name")), "trim(regexp_replace(regexp_replace(trim(regexp_replace(name, '\\s+', ' ', 'g')), '^[\\s,，;；、:：.\\-–—]+', ''), '[\\s,，;；、:：.\\-–—]+$', ''))")
spec("s_doi", lambda: text.clean_doi(c("doi")), "regexp_replace(regexp_replace(lower(" + doc("doi") + "), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', ''), '[\\s.,;]+$', '')")
spec("s_notes", lambda: text.merge_notes(c("name"), c("sample"), c("unit")), f"concat_ws('; ', nullif({doc('name')}, ''), nullif({doc('sample')}, ''), nullif({doc('unit')}, ''))")
spec("s_row_text", lambda: text.row_text({"name": c("name"), "unit": c("unit"), "value": c("value")}), f"concat_ws(' | ', CASE WHEN {norm('name')} <> '' THEN 'name: ' || {norm('name')} END, CASE WHEN {norm('unit')} <> '' THEN 'unit: ' || {norm('unit')} END, CASE WHEN " + norm('"value"') + " <> '' THEN 'value: ' || " + norm('"value"') + " END)")
spec("s_join", lambda: text.join_in_order(arrays.split_multi(c("cell"))), f"array_to_string({split_multi('cell')}, ';')")
spec("s_snippet", lambda: text.snippet(c("name"), F.lit("an"), 5), "CASE WHEN strpos(lower(name), 'an') > 0 THEN trim(regexp_replace(substr(name, greatest(strpos(lower(name), 'an') - 5, 1), strpos(lower(name), 'an') + 7 - greatest(strpos(lower(name), 'an') - 5, 1)), '\\s+', ' ', 'g')) ELSE '' END")
# ---------------------------------------------------------------- predicates
spec("p_short_abbr", lambda: predicates.is_short_abbreviation(c("name")), short_abbr("name"))
spec("p_allow_simpl", lambda: predicates.allows_simplified(c("name")), f"({simple('name')} <> '' AND NOT {short_abbr('name')} AND (length({simple('name')}) >= 7 OR regexp_matches({norm('name')}, '[ \\-,()/]')))")
spec("p_date_junk", lambda: predicates.is_date_junk(c("value")), date_junk('"value"'))
spec("p_ratio_only", lambda: predicates.is_ratio_only(c("value")), ratio_only('"value"'))
spec("p_ocr4", lambda: predicates.is_four_digits(c("value")), f"regexp_matches({norm(chr(34) + 'value' + chr(34))}, '^\\d{{4}}$')")
spec("p_identity_ok", lambda: predicates.identity_verdict(c("name"), c("other"), c("doi"), c("unit")), (
    f"CASE WHEN {norm('name')} = '' OR {norm('other')} = '' THEN 'ok_empty' WHEN {key('name')} = {key('other')} THEN 'ok_exact_same' "
    f"WHEN regexp_matches({norm('name')}, '(?i)graphene|氧化石墨烯|石墨烯') AND regexp_matches({norm('other')}, '(?i)\\bmethane\\b|\\bethane\\b') THEN 'conflict_keyword_pair' "
    f"WHEN regexp_matches({norm('name')}, '(?i)oxide|氧化') AND regexp_matches({norm('other')}, '(?i)\\bmethane\\b') THEN 'conflict_keyword_pair' "
    f"WHEN {jaccard('name', 'other')} >= 0.35 THEN 'ok_token_jaccard' "
    f"WHEN regexp_matches({norm('name')}, '{fixed.MATERIAL_CONTEXT}') AND {jaccard('name', 'other')} < 0.2 AND (regexp_matches({norm('other')}, '{fixed.SMALL_MOLECULES}') OR length({key('other')}) <= 12) THEN 'material_context_vs_unrelated_small_molecule' "
    f"WHEN length({key('name')}) >= 18 AND length({key('other')}) <= 12 AND {jaccard('name', 'other')} < 0.15 THEN 'length_mismatch_low_overlap' "
    f"WHEN trim({norm('doi')} || ' ' || {norm('unit')}) <> '' AND greatest({jaccard('name', 'other')}, {jaccard('name', norm('doi') + ' || chr(32) || ' + norm('unit'))}) >= 0.25 THEN 'ok_token_jaccard_with_extra' "
    f"WHEN {jaccard('name', 'other')} < 0.12 THEN 'token_overlap_too_low' ELSE 'ok_token_jaccard_marginal' END"
))
spec("p_should_llm", lambda: predicates.should_judge(units.normalize_unit(c("unit"))["family"], units.phase(c("slot"), c("name"), c("name"), F.lit("")), c("name")), (
    f"({FAM} = 'percent_ambiguous' OR ({FAM} = 'molarity' AND {norm('name')} = '') OR (slot NOT IN ('aqueous_monomer', 'test_nacl', 'organic_monomer') AND NOT {one_of(key('name'), fixed.AQUEOUS_SOLUTES)} AND NOT {one_of(key('name'), fixed.ORGANIC_SOLUTES)}))"
))
spec("p_wt_sane", lambda: predicates.within_weight_percent(numbers.parse_number(c("value"))), f"coalesce({number(chr(34) + 'value' + chr(34))} BETWEEN 0.0 AND 100.0001, false)")
spec("p_tb_sane", lambda: text.bound(units.normalize_unit(c("unit")), lambda u: numbers.number_sanity(c("value"), u["family"], u["unit"])), sanity('"value"', FAM, U))
spec("p_tb_noise", lambda: predicates.is_reference_noise(c("doi"), F.lit(0), F.lit(5)), "regexp_matches(lower(substr(doi, 1, 105)), 'doi|http')")
spec("p_abbr_like", lambda: predicates.looks_like_abbreviation(c("name")), abbr_like("name"))
spec("p_abbr_like_dic", lambda: predicates.looks_like_alias(c("name")), f"(regexp_matches(trim(name), '^[A-Za-z0-9\\-]{{2,10}}$') AND {keep('name', 'A-Z')} >= 2)")
spec("p_generic", lambda: predicates.is_generic_name(c("name")), generic("name"))
spec("p_blank", lambda: predicates.is_blank(c("unit")), f"list_contains(['', 'nan'], lower({doc('unit')}))")
spec("p_recheck", lambda: predicates.is_recheck_candidate(c("name"), c("status")), f"({doc('name')} <> '' AND {one_of('upper(status)', fixed.UNRESOLVED)} AND ({abbr_like('name')} OR (NOT {generic('name')} AND (list_contains(['NO_HIT', 'NO_SPECIFIC_CHEMICAL'], upper(status)) OR (length({doc('name')}) >= 8 AND regexp_matches({doc('name')}, '\\pL'))))))")
spec("p_bad_cand", lambda: predicates.is_bad_candidate(c("name")), (
    f"(length({doc('name')}) NOT BETWEEN 4 AND 120 OR {words('lower(' + doc('name') + ')')} > 8 OR regexp_matches({doc('name')}, '^[A-Z0-9\\-_/]+$') OR {has_any('lower(' + doc('name') + ')', fixed.BAD_CANDIDATE_PHRASES)} "
    f"OR regexp_matches(lower({doc('name')}), '{predicates.one_of_patterns(fixed.CANDIDATE_BAD_STARTS)}') OR {keep(doc('name'), '(')} <> {keep(doc('name'), ')')} OR regexp_matches(lower({doc('name')}), '{predicates.one_of_patterns(fixed.CANDIDATE_BAD_PARTS)}'))"
))
spec("p_material", lambda: predicates.mentions_material(c("name")), has_any(f"lower({doc('name')})", fixed.MATERIAL_KEYWORDS))
spec("p_material_q", lambda: predicates.mentions_material(text.cleanup_candidate(c("name"))), has_any(f"lower({doc(candidate('name'))})", fixed.MATERIAL_KEYWORDS))
spec("p_valid_abbr", lambda: predicates.is_valid_abbreviation(c("name")), (
    f"(regexp_matches(upper({doc('name')}), '^[A-Z][A-Z0-9\\-]{{1,12}}$') AND {keep(doc('name'), 'A-Za-z')} >= 2 AND NOT {one_of('lower(' + doc('name') + ')', predicates.ABBREVIATION_CONTEXT)} "
    f"AND NOT regexp_matches(lower({doc('name')}), '%|wt|vol|mol/l|molar|buffer') AND (length({doc('name')}) <= 6 OR {one_of('lower(' + doc('name') + ')', ['cell', 'pei', 'danc', 'dadmac'])}))"
))
spec("p_valid_full", lambda: predicates.is_valid_full_name(c("name")), (
    f"(length({doc('name')}) BETWEEN 4 AND 120 AND NOT regexp_matches({doc('name')}, '^[A-Z]{{1,4}}\\d{{1,4}}[A-Za-z]?$') AND NOT regexp_matches({doc('name')}, '^[A-Z0-9\\-_/]+$') "
    f"AND NOT {one_of('lower(' + doc('name') + ')', predicates.ABBREVIATION_CONTEXT)} AND NOT regexp_matches(lower({doc('name')}), 'solution|phase|水相|油相') AND regexp_matches({doc('name')}, '[A-Za-z一-鿿]'))"
))
spec("p_chem_hint", lambda: predicates.has_chemistry_word(c("name")), has_any(f"lower({doc('name')})", predicates.CHEMISTRY_WORDS))
spec("p_likely_abbr", lambda: ~F.trim(c("name")).contains(" ") & predicates.is_valid_abbreviation(c("name")), f"(NOT contains(trim(name), ' ') AND {SPECS['p_valid_abbr'][1]})")
spec("p_forced_mix", lambda: predicates.forced_mixture(c("name")), f"CASE WHEN {has_any('lower(' + doc('name') + ')', predicates.SOLUTION_WORDS)} THEN 'solution context' WHEN {has_any('lower(' + doc('name') + ')', predicates.MIXTURE_WORDS)} THEN 'mixture keyword' WHEN regexp_matches({doc('name')}, '(?i)\\s*(?:/|\\+|,|;| and )\\s*') THEN 'mixture connector' ELSE '' END")
spec("p_non_entity", lambda: predicates.is_non_entity(c("name")), one_of(f"lower({doc('name')})", predicates.NON_ENTITIES))
spec("p_cjk", lambda: predicates.has_cjk(c("name")), "regexp_matches(name, '[一-鿿]')")
spec("p_overlap", lambda: predicates.overlaps(c("name"), c("other")), f"(regexp_matches(name, '[一-鿿]') OR len(list_filter(regexp_extract_all(lower({doc('name')}), '[a-z]{{3,}}'), lambda t: NOT list_contains(['with', 'from', 'into', 'acid'], t))) = 0 OR list_has_any(list_filter(regexp_extract_all(lower({doc('name')}), '[a-z]{{3,}}'), lambda t: NOT list_contains(['with', 'from', 'into', 'acid'], t)), list_filter(regexp_extract_all(lower({doc('other')}), '[a-z]{{3,}}'), lambda t: NOT list_contains(['with', 'from', 'into', 'acid'], t))))")
spec("p_material_like", lambda: predicates.is_material_like(c("name")), f"(regexp_matches(lower({doc('name')}), '#\\s*\\d+[a-z]?\\s*$') OR {has_any('lower(' + doc('name') + ')', predicates.SAMPLE_WORDS)})")
spec("p_model_code", lambda: predicates.is_model_code(c("name")), model("name"))
spec("p_measure", lambda: predicates.is_measurement(c("name")), measure("name"))
spec("p_mixture", lambda: predicates.is_mixture_list(c("name")), listed("name"))
spec("p_process", lambda: predicates.is_process_text(c("name")), process("name"))
spec("p_brand", lambda: predicates.is_brand(c("name")), brand("name"))
spec("p_formula", lambda: predicates.looks_like_formula(c("name")), "regexp_matches(translate(name, '·', '.'), '^\\s*([A-Z][a-z]?\\d*){2,}\\s*(\\.\\s*(\\d*([A-Z][a-z]?\\d*)+)?\\s*)*$')")
spec("p_chinese", lambda: predicates.has_cjk(c("cell")), "regexp_matches(cell, '[一-鿿]')")
spec("p_fragment", lambda: predicates.is_fragment(c("name")), one_of("name", predicates.FRAGMENTS))
spec("p_numeric_only", lambda: predicates.is_numeric_only(c("value")), "regexp_matches(trim(\"value\"), '^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?$')")
spec("p_symbol_only", lambda: predicates.is_symbol_only(c("name")), "NOT regexp_matches(name, '[A-Za-z0-9一-鿿]')")
spec("p_skip_value", lambda: predicates.is_placeholder(c("name")), one_of("lower(trim(name))", predicates.PLACEHOLDERS))
spec("st_classify", lambda: predicates.skip_class(text.unify_ascii(c("name"))), skip("trim(regexp_replace(translate(name, '（）【】，；：—–', '()[],;:--'), '\\s+', ' ', 'g'))"))
# ---------------------------------------------------------------- numbers and units
V = '"value"'
spec("n_sci", lambda: F.round(numbers.scientific(c("value")), 9), f"round({power(V)}, 9)")
spec("n_range_mid", lambda: numbers.range_midpoint(c("value")), middle(V))
spec("n_parse", lambda: numbers.parse_number(c("value")), number(V))
spec("n_parse_strict", lambda: numbers.parse_single(c("value")), f"CASE WHEN regexp_matches(trim(replace({norm(V)}, ',', '')), '^{NUM}$') THEN TRY_CAST(trim(replace({norm(V)}, ',', '')) AS DOUBLE) END")
spec("n_preprocess", lambda: numbers.value_cell(c("value"), c("unit"))["kind"], f"CASE WHEN {quote_off(V)} = '' THEN 'empty' WHEN {date_junk(V)} THEN 'date' WHEN {ratio_only(V)} THEN 'ratio' WHEN {middle(V)} IS NOT NULL THEN 'range' WHEN {power(V)} IS NOT NULL THEN 'scientific' ELSE 'plain' END")
spec("n_format_g", lambda: numbers.format_g(numbers.parse_number(c("value"))), f"coalesce(format('{{:g}}', round({number(V)}, 6)), '')")
spec("n_format_strip", lambda: numbers.format_fixed(numbers.parse_number(c("value"))), f"regexp_replace(regexp_replace(printf('%.6f', {number(V)}), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')")
spec("n_indices", lambda: F.array_join(numbers.indices(c("value")).cast("array<string>"), "|"), "array_to_string(list_filter(list_transform(regexp_extract_all(\"value\", '[0-9]+'), lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), lambda x, i: list_position(list_transform(regexp_extract_all(\"value\", '[0-9]+'), lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), x) = i), '|')")
spec("n_unit_repair", lambda: units.repair_unit(c("unit")), unit_fixed("unit"))
spec("n_unit_norm", lambda: F.concat_ws("|", units.normalize_unit(c("unit"))["unit"], units.normalize_unit(c("unit"))["family"]), f"concat_ws('|', {U}, {FAM})")
spec("n_inline_unit", lambda: F.concat_ws("|", units.inline_unit(c("value"), F.lit(""))["value"], units.inline_unit(c("value"), F.lit(""))["unit"]), (
    f"CASE WHEN regexp_matches(regexp_extract({norm(V)}, '^\\s*([-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?)\\s*(.+?)\\s*$', 2), '[A-Za-z%/]') THEN regexp_extract({norm(V)}, '^\\s*([-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?)\\s*(.+?)\\s*$', 1) || '|' || trim(regexp_extract({norm(V)}, '^\\s*([-+]?\\d*\\.?\\d+(?:[eE][-+]?\\d+)?)\\s*(.+?)\\s*$', 2)) ELSE {norm(V)} || '|' END"
))
spec("n_solvent", lambda: text.solvent_name(c("name")), solvent("name"))
spec("j_percent_alias", lambda: text.solvent_name(c("other")), solvent("other"))
spec("n_phase", lambda: units.phase(c("slot"), c("name"), c("other"), c("cell")), (
    f"CASE WHEN slot IN ('aqueous_monomer', 'test_nacl') THEN 'aqueous' WHEN slot = 'organic_monomer' THEN 'organic' WHEN {one_of(key('name'), fixed.AQUEOUS_SOLUTES)} OR {one_of(key('other'), fixed.AQUEOUS_SOLUTES)} THEN 'aqueous' "
    f"WHEN {one_of(key('name'), fixed.ORGANIC_SOLUTES)} OR {one_of(key('other'), fixed.ORGANIC_SOLUTES)} THEN 'organic' WHEN {key('cell')} = 'water' THEN 'aqueous' ELSE 'unknown' END"
))
spec("n_form", lambda: units.physical_form(c("name"), c("other")), (
    f"CASE WHEN {one_of(key('name'), fixed.LIQUIDS + list(fixed.SOLUTE_DENSITY))} OR {one_of(key('other'), fixed.LIQUIDS + list(fixed.SOLUTE_DENSITY))} THEN 'liquid' WHEN {one_of(key('name'), fixed.SOLIDS)} OR {one_of(key('other'), fixed.SOLIDS)} THEN 'solid' "
    f"WHEN {has_any(key('name') + ' || chr(32) || ' + key('other'), fixed.SOLID_HINTS)} AND NOT {has_any(key('name') + ' || chr(32) || ' + key('other'), fixed.LIQUID_HINTS)} THEN 'solid' ELSE 'unknown' END"
))
spec("n_percent", lambda: units.percent_type(units.normalize_unit(c("unit"))["family"], c("slot"), units.phase(c("slot"), c("name"), c("name"), F.lit("")), units.physical_form(c("name"), c("name")), F.lit(""), c("unit"), c("sample"))["type"], None)
spec("n_density", lambda: units.density(numbers.parse_number(c("value")), c("slot"), F.lit("organic"), c("other"), c("name"), c("name"))["source"], None)
spec("n_sample_ratio", lambda: F.concat_ws("|", numbers.sample_ratio(c("sample"), c("item"))["value"], numbers.sample_ratio(c("sample"), c("item"))["unit"]), (
    "concat_ws('|', (regexp_split_to_array(regexp_extract(sample, '(?i)\\(([-+]?\\d*\\.?\\d+(?:\\s*[:：]\\s*[-+]?\\d*\\.?\\d+){1,5})\\s*(%(?:\\s*\\((?:w/v|m/v|w/w|v/v|wt)\\))?)\\)', 1), '\\s*[:：]\\s*'))[item] "
    ", CASE WHEN (regexp_split_to_array(nullif(regexp_extract(sample, '(?i)\\(([-+]?\\d*\\.?\\d+(?:\\s*[:：]\\s*[-+]?\\d*\\.?\\d+){1,5})\\s*(%(?:\\s*\\((?:w/v|m/v|w/w|v/v|wt)\\))?)\\)', 1), ''), '\\s*[:：]\\s*'))[item] IS NOT NULL THEN regexp_extract(sample, '(?i)\\(([-+]?\\d*\\.?\\d+(?:\\s*[:：]\\s*[-+]?\\d*\\.?\\d+){1,5})\\s*(%(?:\\s*\\((?:w/v|m/v|w/w|v/v|wt)\\))?)\\)', 2) END)"
))
# ---------------------------------------------------------------- arrays
spec("x_split_multi", lambda: F.array_join(arrays.split_multi(c("cell")), "|"), f"array_to_string({split_multi('cell')}, '|')")
spec("x_split_brackets", lambda: F.array_join(arrays.split_components(c("cell")), "~"), None)
spec("x_align", lambda: F.array_join(arrays.align(arrays.split_multi(c("cell")), c("item"), F.lit("-")), "|"), (
    f"array_to_string(list_transform(range(1, item + 1), lambda i: CASE WHEN len({split_multi('cell')}) = 1 THEN ({split_multi('cell')})[1] WHEN i <= len({split_multi('cell')}) THEN ({split_multi('cell')})[i] ELSE '-' END), '|')"
))
spec("x_align_cycle", lambda: F.array_join(arrays.align_cycle(arrays.split_multi(c("cell")), c("item")), "|"), (
    f"coalesce(array_to_string(list_filter(list_transform(range(0, item), lambda i: ({split_multi('cell')})[i % greatest(len({split_multi('cell')}), 1) + 1]), lambda x: x IS NOT NULL), '|'), '')"
))
spec("x_zip_short", lambda: F.array_join(F.transform(arrays.zip_shortest(arrays.split_multi(c("cell")).alias("a"), arrays.split_multi(c("values")).alias("b")), lambda s: F.concat(s["0"], F.lit("="), s["1"])), "|"), (
    f"coalesce(array_to_string(list_transform(range(1, least(len({split_multi('cell')}), len({split_multi(chr(34) + 'values' + chr(34))})) + 1), lambda i: ({split_multi('cell')})[i] || '=' || ({split_multi(chr(34) + 'values' + chr(34))})[i]), '|'), '')"
))
spec("x_mixture", lambda: F.array_join(F.transform(arrays.mixture_parts(c("name")), lambda s: F.concat(s["rank"].cast("string"), F.lit(":"), s["name"])), "|"), None)
spec("x_chunk", lambda: F.floor(c("id") / 25).cast("long"), "CAST(floor(id / 25.0) AS BIGINT)")


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: cells(spark, sf_dir).select("id", SPECS[name][0]().alias("value"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name) for name in SPECS}


def oracle_sql() -> dict[str, str]:
    return {name: f'WITH {CELLS_SQL} SELECT id, {sql} AS "value" FROM cells' for name, (_, sql) in SPECS.items() if sql is not None}
