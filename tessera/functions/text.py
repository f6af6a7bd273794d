"""Text normalisation and name functions. Missing text is ''; a null input gives what '' gives."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import fixed

def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def bound(value: Column, step) -> Column:
    """step(value), with the value computed once however often the step reads it (an expression is copied to each of its uses)."""
    return F.get(F.transform(F.array(value), step), 0)


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_text(c: Column) -> Column:
    """Trim, fold wide spaces, percent and micro signs, collapse white space."""
    return _squeeze(F.translate(or_empty(c), "　 ％μµ", "  %uu"))


def norm_key(c: Column) -> Column:
    """norm_text in lower case with narrow brackets, commas and semicolons."""
    return _squeeze(F.translate(F.lower(norm_text(c)), "（），；", "(),;"))


def simplify_key(c: Column) -> Column:
    """norm_key without separators."""
    return F.regexp_replace(norm_key(c), r"[\s\-_.,;:()\[\]{}/\\]+", "")


def compact(c: Column) -> Column:
    return F.regexp_replace(norm_text(c), r"[\s\-_/\\.()]+", "")


def abbr_key(c: Column) -> Column:
    """Upper case without separators."""
    return F.upper(compact(c))


def strip_leading_quote(c: Column) -> Column:
    """Drop one quote at the start of two or more characters."""
    return bound(norm_text(c), lambda s: F.when(s.rlike(r"^['’‘]."), F.trim(F.substring(s, 2, 2**31 - 1))).otherwise(s))


def norm_text_doc(c: Column) -> Column:
    """Narrow punctuation and plain dashes, for names and documents."""
    return _squeeze(F.translate(or_empty(c), "（），；：｜–—−", "(),;:|---"))


def clean_key(c: Column) -> Column:
    """Key of a file name, title or DOI: no resolver address, no extension, letters, digits and CJK only."""
    t = F.regexp_replace(F.lower(norm_text_doc(c)), r"https?://(dx\.)?doi\.org/", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\.md$", ""), r"\.[a-z0-9]{1,6}$", "")
    return F.regexp_replace(t, r"[^a-z0-9一-鿿]+", "")


def unify_ascii(c: Column) -> Column:
    """Brackets, dashes and marks of names in one spelling; the compatibility folding before it is `unify`."""
    t = F.regexp_replace(F.translate(or_empty(c), "（）【】，；：—–™®©", "()[],;:--"), "℃", "°C")
    return _squeeze(t)


def unify(c: Column) -> Column:
    """unify_ascii after compatibility composition (NFKC), which has no built-in: an Arrow UDF."""
    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKC")

    return unify_ascii(fold(F.trim(or_empty(c))))


def similarity(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio in lower case; no built-in has it, so an Arrow UDF."""
    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(F.lower(or_empty(a)), F.lower(or_empty(b)))


def normalize_spelling(c: Column) -> Column:
    """British to American spellings of sulphur, aluminium, caesium and fibre."""
    t = or_empty(c)
    for british, american in (("sulph", "sulf"), ("aluminium", "aluminum"), ("caesium", "cesium"), ("fibre", "fiber")):
        t = F.regexp_replace(t, f"(?i){british}", american)
    return t


def trim_marks(c: Column) -> Column:
    """Without spaces, semicolons and commas at the ends."""
    return F.regexp_replace(c, r"^[ ;,]+|[ ;,]+$", "")


def strip_phase_tags(c: Column) -> Column:
    """Without a phase tag at the end, in brackets or not."""
    t = F.regexp_replace(or_empty(c), r"(?i)\((water phase|aqueous phase|oil phase|organic phase)\)\s*$", "")
    t = F.regexp_replace(t, r"(?i)\((water|aqueous|oil|organic)\)\s*$", "")
    t = F.regexp_replace(t, r"[（(]\s*(水相|油相|有机相)\s*[)）]\s*$", "")
    return trim_marks(F.regexp_replace(t, r"\s*(水相|油相|有机相)\s*$", ""))


def strip_concentration(c: Column) -> Column:
    """Without a leading amount, phase tags, solution words at the end, and a short alias or phase in a last bracket."""
    t = F.regexp_replace(or_empty(c), r"(?i)^\s*\d+(\.\d+)?\s*(wt%|vol%|mol%|%|ppm|ppb)\s*", "")
    t = F.regexp_replace(t, r"(?i)^\s*\d+(\.\d+)?\s*(mg/l|g/l|mg|g|kg|ml|l|mM|uM|μM|nM|M)\s*", "")
    t = F.regexp_replace(strip_phase_tags(t), r"(?i)\b(aqueous solution|solution|suspension|dispersion|buffer)\b\s*$", "")
    bracket = r"^(.*\S)\s*\(([^()]*)\)\s*$"

    def without_alias(t: Column) -> Column:
        inner = F.trim(F.regexp_extract(t, bracket, 2))
        drop = inner.rlike(r"^[A-Za-z0-9+\-]{1,18}$") | F.lower(inner).rlike("water phase|aqueous phase|oil phase|organic phase|water|aqueous|oil|水相|油相|有机相|水溶液|溶液")
        return F.when(t.rlike(bracket) & drop, F.trim(F.regexp_extract(t, bracket, 1))).otherwise(t)

    return trim_marks(F.regexp_replace(bound(t, without_alias), r"\s+", " "))


def strip_nano(c: Column) -> Column:
    """The core of a name with nano words and suffixes."""
    t = F.regexp_replace(or_empty(c), "纳米颗粒|纳米粒子", "nanoparticles")
    t = F.regexp_replace(t, r"[-_]\s*(NPs?|nps?)\b", "")
    t = F.regexp_replace(t, r"(?i)\b(nanoparticles?|nanosheets?|nanofillers?|nanorods?)\b", "")
    return trim_marks(F.regexp_replace(t, r"\s+", " "))


def query_variants(c: Column) -> Column:
    """Distinct spellings to look up: as is, without nano words, before a bracket, with a full stop for a middle dot."""
    q = norm_text_doc(c)
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(q, r"(?i)\b(nanoparticles?|nps?)\b", ""), "纳米颗粒", ""), r"[-\s]+$", ""))
    left = F.trim(F.regexp_extract(q, r"^(.+?)\s*\([^()]+\)\s*$", 1))
    dotted = F.when(F.instr(q, "·") > 0, F.translate(q, "·", ".")).otherwise(F.lit(""))
    return F.array_distinct(F.filter(F.array(q, plain, left, dotted), lambda x: x != ""))


def candidate_names(c: Column, most: int = 10) -> Column:
    """Names to try in order, distinct in any letter case: raw, without context, without nano words, the full name before an
    abbreviation, and each of them with plain hyphens and commas."""
    named = r"^(.*\S)\s*\(([A-Za-z][A-Za-z0-9+\-]{1,20})\)\s*$"
    tidy = lambda x: trim_marks(F.regexp_replace(strip_phase_tags(normalize_spelling(x)), r"\s+", " "))
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, r"\s*-\s*", "-"), r"\s*,\s*", ",")

    def spelled(base: Column) -> Column:
        return first_distinct(F.concat(base, F.transform(base, plain)), F.lower, lambda x: x, most, least=0)

    def from_both(raw: Column, context: Column) -> Column:
        full = F.when(raw.rlike(named), strip_concentration(F.trim(F.regexp_extract(raw, named, 1)))).otherwise(F.lit(""))
        every = F.transform(F.array(raw, context, strip_nano(context), strip_nano(raw), full), tidy)
        return bound(F.filter(every, lambda x: F.length(x) >= 2), spelled)

    nothing = F.array().cast("array<string>")
    return bound(unify_ascii(c), lambda raw: F.when(raw == "", nothing).otherwise(bound(strip_concentration(raw), lambda context: from_both(raw, context))))


def cell_text(c: Column) -> Column:
    """A table cell with narrow brackets, semicolons and commas."""
    return _squeeze(F.translate(or_empty(c), "　（）【】；，", " ()[];,"))


def match_key(c: Column) -> Column:
    """Key under which names match: narrow punctuation, plain dashes, lower case."""
    return F.lower(_squeeze(F.translate(or_empty(c), "（）；，–—−", "();,---")))


def clean_token(c: Column) -> Column:
    """Collapse white space and strip punctuation at both ends."""
    return F.trim(F.regexp_replace(_squeeze(or_empty(c)), r"^[\s,，;；、:：.\-–—]+|[\s,，;；、:：.\-–—]+$", ""))


def clean_doi(c: Column) -> Column:
    t = F.regexp_replace(F.lower(norm_text_doc(c)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.regexp_replace(t, r"[\s.,;]+$", "")


def similarity_tokens(c: Column) -> Column:
    """Distinct alphanumeric tokens of two characters or more, without stop words."""
    found = F.array_distinct(F.regexp_extract_all(norm_key(c), F.lit(r"([a-z0-9]{2,})"), 1))
    return F.array_except(found, F.array(*map(F.lit, fixed.SIMILARITY_STOP)))


def match_tokens(c: Column) -> Column:
    """Distinct words of three letters or more, without stop words."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(norm_text_doc(c)), F.lit(r"([a-z]{3,})"), 1))
    return F.array_except(found, F.array(*map(F.lit, ["with", "from", "into", "acid"])))


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens; 0 if either has none."""
    def share(x: Column, y: Column) -> Column:
        part = lambda both: F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(both / (F.size(x) + F.size(y) - both))
        return bound(F.size(F.array_intersect(x, y)), part)

    return bound(similarity_tokens(a), lambda x: bound(similarity_tokens(b), lambda y: share(x, y)))


def core_name(c: Column) -> Column:
    """The name inside its wrapping: no bracket at the end, no quantity, no shell words, no leading descriptors."""
    def unwrapped(s: Column) -> Column:
        t = F.trim(F.regexp_replace(s, r"\s*\([^)]*\)\s*$", ""))
        t = F.trim(F.regexp_replace(t, fixed.CORE_QUANTITY, ""))
        t = F.trim(F.regexp_replace(t, fixed.CORE_SUFFIXES, ""))
        t = F.trim(F.regexp_replace(t, "(?i)^(?:" + "|".join(fixed.CORE_PREFIXES) + ")*", ""))
        return bound(t, lambda x: F.when(x == "", s).otherwise(x))

    return bound(F.trim(or_empty(c)), unwrapped)


def edge(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ ,;:\-]+|[ ,;:\-]+$", "")


def cleanup_candidate(c: Column) -> Column:
    """A candidate phrase without determiners, connectors and what comes before its naming verb."""
    t = norm_text_doc(c)
    for pattern in fixed.CANDIDATE_STARTS:
        t = F.regexp_replace(t, pattern, "")
    t = edge(F.regexp_replace(edge(t), fixed.CANDIDATE_VERBS, ""))
    t = F.regexp_replace(F.regexp_replace(t, fixed.CANDIDATE_LEADS, ""), r"^[a-z]{1,2}\s+([a-z].*)$", "$1")
    return edge(t)


def merge_notes(*parts: Column) -> Column:
    """'; ' between the parts that are not blank."""
    return F.concat_ws("; ", *[F.nullif(norm_text_doc(p), F.lit("")) for p in parts])


def join_in_order(values: Column, separator: str = ";") -> Column:
    """Array of strings to one string, blanks kept, nulls left out."""
    return F.array_join(values, separator)


def unique_keep_order(values: Column) -> Column:
    """Distinct non-blank texts, first occurrence first."""
    return F.array_distinct(F.filter(F.transform(values, norm_text), lambda x: x != ""))


def row_text(columns: dict[str, Column]) -> Column:
    """`name: value` of every column that is not blank, between ' | '."""
    shown = lambda name: lambda t: F.when(t != "", F.concat(F.lit(f"{name}: "), t))
    return F.concat_ws(" | ", *[bound(norm_text(c), shown(name)) for name, c in columns.items()])


def solvent_name(c: Column) -> Column:
    """The first solvent, in the table's order, one of whose aliases the text contains; else ''."""
    def first(t: Column) -> Column:
        out = None
        for name, aliases in fixed.SOLVENT_ALIASES:
            found = reduce(or_, [t.contains(a) for a in aliases if not any(b in a for b in aliases if b != a)])  # an alias that holds another adds nothing
            out = F.when(found, F.lit(name)) if out is None else out.when(found, F.lit(name))
        return out.otherwise(F.lit(""))

    return bound(norm_key(c), first)


def token_regex(token: Column) -> Column:
    """A pattern for the whole token in any letter case; null for tokens under two characters."""
    t = norm_text_doc(token)
    return F.when(F.length(t) >= 2, F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])\Q"), t, F.lit(r"\E(?![A-Za-z0-9])")))


def snippet(text: Column, keyword: Column, window: int) -> Column:
    """The text around the first occurrence of the keyword in any letter case, `window` characters on both sides; else ''."""
    at = F.instr(F.lower(text), F.lower(keyword))
    start = F.greatest(at - window, F.lit(1))
    cut = F.substring(text, start, at + F.length(keyword) + window - start)
    return F.when((at > 0) & (keyword != ""), _squeeze(cut)).otherwise(F.lit(""))


def first_distinct(windows: Column, key, shown, most: int, least: int = 1) -> Column:
    """The first `most` of the non-blank texts with distinct keys, each as shown: one pass that holds only what it found."""
    nothing = F.array().cast("array<string>")
    add = lambda acc, w: F.struct(F.array_append(acc["keys"], key(w)).alias("keys"), F.array_append(acc["out"], shown(w)).alias("out"))
    wanted = lambda acc, w: (F.length(w) >= least) & (F.size(acc["out"]) < most) & ~F.array_contains(acc["keys"], key(w))
    return F.aggregate(windows, F.struct(nothing.alias("keys"), nothing.alias("out")), lambda acc, w: F.when(wanted(acc, w), add(acc, w)).otherwise(acc), lambda acc: acc["out"])


def sentence_windows(text: Column, token: Column, most: int = 6, width: int = 1400) -> Column:
    """Each sentence that holds the token with its neighbours, distinct in any letter case.

    Sentences are split once; every one carries its neighbours before the hits are kept."""
    none = F.array(F.lit(""))

    def windows(parts: Column, pattern: Column) -> Column:
        beside = F.arrays_zip(F.concat(none, parts).alias("before"), parts.alias("own"), F.concat(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), none).alias("after"))
        hits = F.filter(beside, lambda x: x["own"].isNotNull() & F.rlike(x["own"], pattern))
        merged = F.transform(hits, lambda x: norm_text_doc(F.concat_ws(" ", *[F.nullif(x[c], F.lit("")) for c in ("before", "own", "after")])))
        return first_distinct(merged, F.lower, lambda w: F.substring(w, 1, width), most)

    parts = F.transform(F.split(or_empty(text), r"(?<=[.!?。；;\n])"), lambda x: F.trim(x))  # F.trim itself would take the index, too
    found = bound(token_regex(token), lambda pattern: bound(parts, lambda p: windows(p, pattern)))
    return F.when(token_regex(token).isNull(), F.array().cast("array<string>")).otherwise(found)


def span_windows(text: Column, token: Column, most: int = 6, radius: int = 300) -> Column:
    """The text around each occurrence of the token, up to `radius` characters on both sides, distinct.

    One pass over the pieces between occurrences with a running offset, until `most` windows are found."""
    t, pattern = or_empty(text), token_regex(token)
    pieces = F.split(t, pattern)
    size = F.length(norm_text_doc(token))
    window = lambda a: norm_text_doc(F.substring(t, F.greatest(a - radius, F.lit(0)) + 1, F.least(a, F.lit(radius)) + size + radius))

    def step(acc: Column, piece: Column) -> Column:
        at = acc["at"] + F.length(piece)
        found = F.when(F.size(acc["out"]) < most, F.array_union(acc["out"], F.array(window(at)))).otherwise(acc["out"])
        return F.struct((at + size).alias("at"), found.alias("out"))

    before_tokens = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    found = F.aggregate(before_tokens, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: acc["out"])
    return F.when(pattern.isNull(), F.array().cast("array<string>")).otherwise(found)
