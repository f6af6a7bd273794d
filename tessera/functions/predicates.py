"""Text predicates, all pure boolean columns; null input counts as ''."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import fixed
from tessera.functions.text import bound, compact, match_key, match_tokens, norm_key, norm_text, norm_text_doc, or_empty, similarity_tokens, simplify_key, token_jaccard


def any_of(c: Column, words: list[str]) -> Column:
    """The text contains one of the words."""
    return c.rlike("|".join(re.escape(w) for w in words))


def count_of(c: Column, kept: str) -> Column:
    """Characters of a class, by the length of what is left."""
    return F.length(F.regexp_replace(c, f"[^{kept}]", ""))


def is_short_abbreviation(c: Column, most: int = 6) -> Column:
    """Up to `most` letters and digits without separators, three fifths of the letters in upper case."""
    short = lambda t, letters: t.rlike(f"^[A-Za-z0-9]{{1,{most}}}$") & (letters > 0) & (count_of(t, "A-Z") * 5 >= letters * 3)
    return bound(compact(c), lambda t: bound(count_of(t, "A-Za-z"), lambda letters: short(t, letters)))


def allows_simplified(c: Column) -> Column:
    """May be matched without separators: no short abbreviation, and long or with a separator."""
    return bound(simplify_key(c), lambda simple: (simple != "") & ~is_short_abbreviation(c) & ((F.length(simple) >= 7) | norm_text(c).rlike(r"[ \-,()/]")))


def is_date_junk(c: Column) -> Column:
    months = r"(?i)\b(january|february|march|april|may|june|july|august|september|october|november|december)\b"
    return bound(norm_text(c), lambda t: t.rlike(r"\d+\s*月\s*\d+\s*日") | (t.rlike(months) & t.rlike(r"\d")))


def is_ratio_only(c: Column) -> Column:
    return norm_text(c).rlike(r"(?i)^\d+(\s*:\s*|\s+and\s+)\d+$")


def is_four_digits(c: Column) -> Column:
    return norm_text(c).rlike(r"^\d{4}$")


def looks_like_abbreviation(c: Column) -> Column:
    """One of five shapes of abbreviations, over two characters."""
    t = norm_text_doc(c)
    shapes = r"^([A-Z]{2,10}|[A-Z0-9]{3,16}|[A-Za-z0-9]+(-[A-Za-z0-9]+){1,5}|[0-9,]+-[A-Za-z0-9]+(-[A-Za-z0-9]+)*)$"
    bracketed = t.contains("(") & t.contains(")") & (count_of(t, "A-Z") >= 2)
    return (F.length(t) > 2) & (t.rlike(shapes) | bracketed)


def looks_like_alias(c: Column) -> Column:
    """Two to ten letters, digits or hyphens, two of them upper case."""
    t = F.trim(or_empty(c))
    return t.rlike(r"^[A-Za-z0-9\-]{2,10}$") & (count_of(t, "A-Z") >= 2)


def is_generic_name(c: Column) -> Column:
    t = F.lower(norm_text_doc(c))
    return (t == "") | t.isin(fixed.GENERIC_NAMES + fixed.GENERIC_SINGLE_WORDS)


def is_blank(c: Column) -> Column:
    return F.lower(norm_text_doc(c)).isin("", "nan")


def is_recheck_candidate(name: Column, status: Column) -> Column:
    """An unresolved name worth another look."""
    n = norm_text_doc(name)
    state = F.upper(norm_text_doc(status))
    worthy = state.isin("NO_HIT", "NO_SPECIFIC_CHEMICAL") | ((F.length(n) >= 8) & n.rlike(r"\p{L}"))
    return (n != "") & state.isin(fixed.UNRESOLVED) & (looks_like_abbreviation(n) | (~is_generic_name(n) & worthy))


def unbalanced(c: Column) -> Column:
    return count_of(c, "(") != count_of(c, ")")


def word_count(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(c), r"\s+")))


def one_of_patterns(patterns: list[str]) -> str:
    """A pattern that fits where any of these does."""
    return "|".join(f"(?:{p})" for p in patterns)


def ascii_edges(pattern: str) -> str:
    """A pattern whose word boundaries know ASCII letters, digits and _ alone, as in most engines; Java's depend on its version."""
    return pattern.replace(r"\b", r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))")


def matches_any(c: Column, patterns: list[str]) -> Column:
    return c.rlike(one_of_patterns(patterns))


def is_bad_candidate(c: Column) -> Column:
    """A candidate phrase that cannot be a name: length, process words, verbs, quantities, brackets."""
    t = norm_text_doc(c)
    low = F.lower(t)
    return (
        ~F.length(low).between(4, 120)
        | (word_count(low) > 8)
        | t.rlike(r"^[A-Z0-9\-_/]+$")
        | any_of(low, fixed.BAD_CANDIDATE_PHRASES)
        | matches_any(low, fixed.CANDIDATE_BAD_STARTS)
        | unbalanced(t)
        | matches_any(low, fixed.CANDIDATE_BAD_PARTS)
    )


def mentions_material(c: Column) -> Column:
    return any_of(F.lower(norm_text_doc(c)), fixed.MATERIAL_KEYWORDS)


def has_chemical_ending(c: Column) -> Column:
    """A lower-case name that ends like a chemical's."""
    return c.rlike("(" + "|".join(re.escape(e) for e in fixed.CHEMICAL_ENDINGS) + ")$")


def has_cjk(c: Column) -> Column:
    return or_empty(c).rlike(r"[一-鿿]")


def overlaps(source: Column, candidate: Column) -> Column:
    """Shared words; CJK sources and sources without words pass."""
    s = match_tokens(source)
    return has_cjk(source) | (F.size(s) == 0) | F.arrays_overlap(s, match_tokens(candidate))


#: Fixed values of the name classes.
BRANDS = ["dow", "filmtec", "dupont", "hydranautics", "toray", "lg chem", "ge osmonics", "vontron", "koch", "lanxess", "toyobo", "microdyn", "nadir", "sepro"]
PROCESS_WORDS = [
    "dry", "drying", "storage", "stored", "aging", "soaking", "rinsing", "washing", "blowing", "annealing", "curing", "heating", "cooling", "stirring", "ultrasonication",
    "sonication", "exposure", "treatment", "plasma", "vacuum", "air drying", "oven", "freeze-drying", "lyophil", "calcination",
]
CHEM_HINTS = [
    "acid", "chloride", "bromide", "iodide", "fluoride", "nitrate", "sulfate", "phosphate", "amine", "diamine", "triamine", "aniline", "pyridine", "benzene", "phenyl",
    "aldehyde", "ketone", "ester", "ether", "alcohol", "thiol", "sulfonyl", "sulfone", "isocyanate", "epoxide", "urea",
]
MATERIAL_HINTS = [
    "membrane", "substrate", "support", "composite", "nanosheet", "nanoparticle", "hydrogel", "thin-film", "tfc", "tfm", "layer", "mesh", "filter", "fabric",
    "asymmetric membrane", "reverse osmosis", "ro membrane", "ro膜", "膜",
]
POLYMER_HINTS = ["poly(", "poly ", "poly-", "polyamide", "cellulose", "chitosan", "alginate", "sericin", "protein", "gelatin", "starch"]
MEASURE_UNITS = ["wt%", "vol%", "mol%", "%", "ppm", "ppb", "mg/l", "g/l", "khz", "hz", "µm", "um", "°c"]
SOLUTION_WORDS = ["水相", "水溶液", "aqueous", "in water", "solution"]
MIXTURE_WORDS = ["complex", "complexes", "composite", "nanocomposite", "mixture", "blend"]
PLACEHOLDERS = ["", "nan", "none", "null", "n/a", "na", "-", "--"]
NON_ENTITIES = ["", "sample", "code", "condition", "unknown", "blank", "na", "n/a", "none", "null"]
FRAGMENTS = ["-Cl", "-F", "-H", "-OH", "-CH2COO-", "-CH2NH3+"]
ABBREVIATION_CONTEXT = [
    "water", "in water", "aqueous", "solution", "phase", "water phase", "aqueous phase", "organic phase", "oil phase", "air", "rt", "room temperature", "ph", "neutral",
    "acidic", "basic", "水相", "油相", "有机相", "水溶液", "溶液", "室温", "中性", "酸性", "碱性",
]
CHEMISTRY_WORDS = [
    "acid", "amine", "amide", "alcohol", "dopamine", "cellulose", "nanocellulose", "polymer", "resin", "oxide", "chloride", "acetate", "acrylate", "sulfate", "hydroxide",
    "nanoparticle", "nanofiber", "复合", "纤维素", "聚",
]
SAMPLE_WORDS = [
    "nanofiber", "nanofibers", "fiber", "fibers", "nanoparticle", "nanoparticles", "composite", "nanocomposite", "liposome", "liposomes", "material", "sample", "specimen",
]
# signs of references, pages and dates, in lower case
REFERENCE_NOISE = [
    r"\bdoi\b", r"doi:", r"pmid", r"isbn", r"\bpp\.\s*\d", r"\bpage\b", r"\bpages\b", r"\bvol\.?\s*\d", r"issue\s*\d", r"fig\.?\s*\d", r"table\s*\d", r"\bref\.?\s*\d",
    r"references?\b", r"\[\d+\]", r"copyright", r"accepted\b", r"published\b", r"received\b", r"revised\b", r"available online", r"http", r"www\.", r"crossref",
    r"elsvier", r"wiley", r"springer",
]


def is_model_code(c: Column) -> Column:
    t = or_empty(c)
    return t.rlike(r"(?i)\b(TW30|BW30|SW30|XLE|NF90|NF270|RO)\b") | t.rlike(r"^[A-Za-z]{1,5}\d[\w\-]{2,}$")


def is_measurement(c: Column) -> Column:
    t = F.lower(or_empty(c))
    return t.rlike(r"\d") & any_of(t, MEASURE_UNITS)


def is_mixture_list(c: Column) -> Column:
    """Several names in one cell: by slash, semicolon or 'and'; locants such as 1,4- are exempt."""
    t = or_empty(c)
    parts = lambda mark: F.size(F.filter(F.split(t, mark), lambda p: F.trim(p) != "")) >= 2
    return (
        F.when(t.rlike(r"^\d+,\d+[-(]"), False)
        .when(t.contains("/") & ~t.rlike(r"\d+/\d+"), parts("/"))
        .when(t.contains(";"), parts(";"))
        .otherwise(t.rlike(r"(?i)\band\b|\b\+\b"))
    )


def is_process_text(c: Column) -> Column:
    t = F.lower(or_empty(c))
    timed = r"\b(at|for|during)\b.*\b\d+(\.\d+)?\s*(min|h|hr|hrs|hour|hours|day|days)\b"
    return any_of(t, PROCESS_WORDS) | t.rlike(r"\b\d+(\.\d+)?\s*°\s*c\b") | t.rlike(timed)


def is_brand(c: Column) -> Column:
    t = F.lower(or_empty(c))
    return any_of(t, BRANDS) | t.rlike(r"\b(sw30|bw30|tw30)\w*\b")


def chemical_likeness(c: Column) -> Column:
    """0.7 for a locant, 0.6 for a chemical word, 0.2 for eight characters or more."""
    t = or_empty(c)
    part = lambda test, points: F.when(test, F.lit(points)).otherwise(F.lit(0.0))
    return part(t.rlike(r"\d+,\d+|\d+-"), 0.7) + part(any_of(F.lower(t), CHEM_HINTS), 0.6) + part(F.length(t) >= 8, 0.2)


def looks_like_formula(c: Column) -> Column:
    """Two or more element symbols, with hydrate parts after dots."""
    t = F.translate(or_empty(c), "·", ".")
    return t.rlike(r"^\s*([A-Z][a-z]?\d*){2,}\s*(\.\s*(\d*([A-Z][a-z]?\d*)+)?\s*)*$")


def is_numeric_only(c: Column) -> Column:
    return F.trim(or_empty(c)).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")


def is_symbol_only(c: Column) -> Column:
    return ~or_empty(c).rlike(r"[A-Za-z0-9一-鿿]")


def is_placeholder(c: Column) -> Column:
    return match_key(c).isin(PLACEHOLDERS)


def is_fragment(c: Column) -> Column:
    """A functional group written alone, such as -OH."""
    return or_empty(c).isin(FRAGMENTS)


def is_valid_abbreviation(c: Column) -> Column:
    """A compact token: a letter, then letters, digits or hyphens, two letters at least, six characters at most."""
    t = norm_text_doc(c)
    low = F.lower(t)
    return (
        F.upper(t).rlike(r"^[A-Z][A-Z0-9\-]{1,12}$")
        & (count_of(t, "A-Za-z") >= 2)
        & ~low.isin(ABBREVIATION_CONTEXT)
        & ~low.rlike("%|wt|vol|mol/l|molar|buffer")
        & ((F.length(t) <= 6) | low.isin("cell", "pei", "danc", "dadmac"))
    )


def is_valid_full_name(c: Column) -> Column:
    t = norm_text_doc(c)
    return (
        F.length(t).between(4, 120)
        & ~t.rlike(r"^[A-Z]{1,4}\d{1,4}[A-Za-z]?$")
        & ~t.rlike(r"^[A-Z0-9\-_/]+$")
        & ~F.lower(t).isin(ABBREVIATION_CONTEXT)
        & ~F.lower(t).rlike("solution|phase|水相|油相")
        & t.rlike(r"[A-Za-z一-鿿]")
    )


def forced_mixture(c: Column) -> Column:
    """Why a name must be a mixture: solution context, mixture keyword or mixture connector; else ''."""
    t = norm_text_doc(c)
    low = F.lower(t)
    return (
        F.when(any_of(low, SOLUTION_WORDS), "solution context")
        .when(any_of(low, MIXTURE_WORDS), "mixture keyword")
        .when(t.rlike(r"(?i)\s*(?:/|\+|,|;| and )\s*"), "mixture connector")
        .otherwise("")
    )


def within_weight_percent(x: Column, loose: bool = False) -> Column:
    """0 to 100 (and a rounding error); up to 10,000 where `loose`."""
    return F.coalesce(x.between(0.0, 10_000.0 if loose else 100.0001), F.lit(False))


def identity_verdict(original: Column, standard: Column, iupac: Column, formula: Column) -> Column:
    """ok_..., or why a table's identity is implausible for the name; the first rule that applies decides."""
    extra = F.concat_ws(" ", norm_text(iupac), norm_text(formula))
    seen = F.struct(
        norm_text(original).alias("o"), norm_text(standard).alias("s"), norm_key(original).alias("ko"), norm_key(standard).alias("ks"), token_jaccard(original, standard).alias("j"),
        extra.alias("extra"), token_jaccard(original, extra).alias("other"),
    )

    def judge(x: Column) -> Column:
        o, s, ko, ks, j = (x[n] for n in ("o", "s", "ko", "ks", "j"))
        graphene = o.rlike("(?i)graphene|氧化石墨烯|石墨烯") & s.rlike(r"(?i)\bmethane\b|\bethane\b")
        oxide = o.rlike("(?i)oxide|氧化") & s.rlike(r"(?i)\bmethane\b")
        return (
            F.when((o == "") | (s == ""), "ok_empty")
            .when(ko == ks, "ok_exact_same")
            .when(graphene | oxide, "conflict_keyword_pair")
            .when(j >= 0.35, "ok_token_jaccard")
            .when(o.rlike(fixed.MATERIAL_CONTEXT) & (j < 0.2) & (s.rlike(fixed.SMALL_MOLECULES) | (F.length(ks) <= 12)), "material_context_vs_unrelated_small_molecule")
            .when((F.length(ko) >= 18) & (F.length(ks) <= 12) & (j < 0.15), "length_mismatch_low_overlap")
            .when((F.trim(x["extra"]) != "") & (F.greatest(j, x["other"]) >= 0.25), "ok_token_jaccard_with_extra")
            .when(j < 0.12, "token_overlap_too_low")
            .otherwise("ok_token_jaccard_marginal")
        )

    return bound(seen, judge)


def skip_class(c: Column) -> Column:
    """The class that keeps a name from being looked up; null if none does. The first rule that applies decides."""
    low, like = F.lower(c), chemical_likeness(c)
    return (
        F.when(c == "", "EMPTY")
        .when(is_process_text(c), "PROCESS_CONDITION")
        .when(is_brand(c), "BRAND_OR_PRODUCT")
        .when(is_model_code(c), "MODEL_CODE")
        .when(is_measurement(c), "MEASUREMENT")
        .when(is_mixture_list(c), "MULTI_COMPONENT")
        .when(any_of(low, POLYMER_HINTS) & (like < 0.6), "POLYMER_OR_BIOMATERIAL")
        .when(any_of(low, MATERIAL_HINTS) & (like < 0.4), "MATERIAL_OR_SYSTEM")
    )


def has_similarity_tokens(c: Column) -> Column:
    return F.size(similarity_tokens(c)) > 0


def is_non_entity(c: Column) -> Column:
    return F.lower(norm_text_doc(c)).isin(NON_ENTITIES)


def has_chemistry_word(c: Column) -> Column:
    return any_of(F.lower(norm_text_doc(c)), CHEMISTRY_WORDS)


def is_material_like(c: Column) -> Column:
    """A sample number at the end, or a word for a material."""
    t = F.lower(norm_text_doc(c))
    return t.rlike(r"#\s*\d+[a-z]?\s*$") | any_of(t, SAMPLE_WORDS)


def is_reference_noise(text: Column, start: Column, stop: Column, window: int = 100) -> Column:
    """References, pages or dates within `window` characters of the 0-based range [start, stop)."""
    low = F.greatest(start - window, F.lit(0))
    return F.lower(F.substring(text, low + 1, stop + window - low)).rlike(ascii_edges(one_of_patterns(REFERENCE_NOISE)))


def should_judge(family: Column, phase: Column, standard: Column) -> Column:
    """A judge is asked for bare percents, unknown phases and molarities without a name."""
    return (family == "percent_ambiguous") | (phase == "unknown") | ((family == "molarity") & (norm_text(standard) == ""))
