"""Gates between a document's text and a registry: spellings to seek, names that a context defines, and which of them to trust and to ask for.

Missing text is ''. Names are columns; those that are read several times should be columns of a table and not long
expressions, since every rule repeats them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import fixed
from tessera.functions.predicates import any_of, has_chemical_ending, is_bad_candidate, is_generic_name, matches_any, mentions_material, unbalanced, word_count
from tessera.functions.text import bound, cleanup_candidate, core_name, edge, first_distinct, norm_text_doc, sentence_windows, span_windows, token_regex


def _distinct_spellings(found: Column, least: int, most: int) -> Column:
    """Normalised texts of at least `least` characters, the first of each in any letter case, at most `most`."""
    shown = F.filter(F.transform(found, norm_text_doc), lambda x: F.length(x) >= least)
    return first_distinct(shown, F.lower, lambda x: x, most)


def _spellings(t: Column) -> Column:
    """What a name may look like in a text, from its normalised form."""
    bare = F.regexp_replace(t, r"^[\d,]+\s*-\s*", "")
    open_brackets = F.regexp_replace(t, r"\((.*?)\)", "$1")
    parts = F.filter(F.split(t, r"[-_/]"), lambda p: p != "")
    rest = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    upper = F.upper(t)
    compact = F.regexp_replace(upper, r"[^A-Z0-9]+", "")
    several = lambda x: F.when(F.size(parts) >= 2, x)
    out = [F.array(t, F.replace(t, F.lit("-"), F.lit("")), F.replace(t, F.lit("-"), F.lit(" ")), F.replace(t, F.lit("_"), F.lit(" ")), F.replace(t, F.lit("/"), F.lit(" ")), bare, open_brackets)]
    out.append(F.filter(parts, lambda p: (F.length(p) >= 2) & ~p.rlike(r"^\d+$")))
    out.append(F.array(several(F.array_join(rest, "-")), several(F.array_join(rest, " ")), several(F.array_join(F.reverse(parts), "-"))))
    for key, aliases in fixed.TOKEN_ALIASES.items():
        out.append(F.when(upper == key, F.array(*map(F.lit, aliases))))
    for key, words in fixed.ABBR_SEARCH.items():
        tried = [x for w in words for x in (F.lit(w), F.replace(t, F.lit(key), F.lit(w)), F.replace(bare, F.lit(key), F.lit(w)))]
        out.append(F.when(compact.contains(key) | upper.contains(key), F.array(*tried)))
    for key, aliases in fixed.TOKEN_ALIASES.items():
        out.append(F.when(upper.contains(key) | compact.contains(key), F.array(*map(F.lit, aliases))))
    none = F.array().cast("array<string>")
    return F.when(t == "", none).otherwise(F.concat(*[F.coalesce(x, none) for x in out]))


def search_tokens(name: Column, query: Column, most: int = 24) -> Column:
    """The spellings under which a name and its query are sought in a document, in order."""
    n = norm_text_doc(name)
    shorter = F.regexp_replace(n, r"[-_]?\d+$", "")
    dashed = F.when(n.contains("-"), F.array(F.substring_index(n, "-", 1), F.regexp_replace(n, r"-[^-]*$", "")))
    own = F.concat(F.array(F.regexp_replace(n, r"[-_\s]+", ""), F.when(shorter != n, shorter)), F.coalesce(dashed, F.array().cast("array<string>")))
    found = F.concat(bound(n, _spellings), bound(norm_text_doc(query), _spellings), own)
    return _distinct_spellings(F.filter(found, lambda x: x.isNotNull()), 2, most)


def audit_tokens(name: Column, query: Column, most: int = 12) -> Column:
    """The spellings that an audit of sources tries, in order."""
    s = norm_text_doc(name)
    parts = F.filter(F.transform(F.split(s, r"[-_/]"), lambda p: F.trim(p)), lambda p: F.length(p) >= 3)
    some = F.array(F.replace(s, F.lit("-"), F.lit("")), F.replace(s, F.lit("-"), F.lit(" ")), F.regexp_replace(s, r"^\d+\s*-\s*", ""), F.regexp_replace(s, r"\((.*?)\)", "$1"))
    out = [F.array(s, norm_text_doc(query)), F.when(s != "", some), F.when(s != "", parts)]
    for key, aliases in fixed.TOKEN_ALIASES.items():
        out.append(F.when(s.contains(key), F.array(*[x for a in aliases for x in (F.lit(a), F.replace(s, F.lit(key), F.lit(a)))])))
    return _distinct_spellings(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in out]), 1, most)


def context_windows(text: Column, tokens: Column, most: int = 20) -> Column:
    """struct(windows, matched): the distinct windows of each token in turn, and the tokens found, until there are `most` windows of two tokens."""
    none = F.array().cast("array<string>")

    def step(acc: Column, token: Column) -> Column:
        some = F.concat(acc["windows"], sentence_windows(text, token), span_windows(text, token))
        distinct = first_distinct(some, F.lower, lambda w: w, 2**31 - 1)
        full = (F.size(acc["windows"]) >= most) & (F.size(acc["matched"]) >= 2)
        hit = ~full & F.coalesce(F.rlike(text, token_regex(token)), F.lit(False))
        return F.when(hit, F.struct(distinct.alias("windows"), F.array_append(acc["matched"], token).alias("matched"))).otherwise(acc)

    start = F.struct(none.alias("windows"), none.alias("matched"))
    return F.aggregate(tokens, start, step, lambda acc: F.struct(F.slice(acc["windows"], 1, most).alias("windows"), acc["matched"].alias("matched")))


def first_occurrences(text: Column, token: Column, most: int = 3, radius: int = 400, apart: int = 100, width: int = 1400) -> Column:
    """The text around the first occurrences of a token that begin at least `apart` characters after the end of the last one taken.

    A greedy choice in one pass over the pieces between occurrences, which holds only a running offset and what it took."""
    t, pattern = F.coalesce(text, F.lit("")), token_regex(token)
    pieces = F.split(t, pattern)
    size = F.length(norm_text_doc(token))

    def step(acc: Column, piece: Column) -> Column:
        at = acc["at"] + F.length(piece)
        cut = F.substring(t, F.greatest(at - radius, F.lit(0)) + 1, F.least(at, F.lit(radius)) + size + radius)
        taken = F.transform(F.filter(F.array(norm_text_doc(cut)), lambda w: F.length(w) > 20), lambda w: F.substring(w, 1, width))
        some = F.when((at - acc["end"] >= apart) & (F.size(acc["out"]) < most), taken).otherwise(F.array().cast("array<string>"))
        return F.struct((at + size).alias("at"), F.when(F.size(some) > 0, at + size).otherwise(acc["end"]).alias("end"), F.concat(acc["out"], some).alias("out"))

    before = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    start = F.struct(F.lit(0).alias("at"), F.lit(-999).alias("end"), F.array().cast("array<string>").alias("out"))
    return F.when(pattern.isNull(), F.array().cast("array<string>")).otherwise(F.aggregate(before, start, step, lambda acc: acc["out"]))


def context_captures(token: Column, context: Column) -> Column:
    """array of struct(raw, score, rule, evidence): what each rule's pattern, built from the row's own token, captures in the
    context; rules in order of score, captures in order of place. Class hints come last, with an empty `raw`.

    A pattern that begins with a name tries every letter of the context as its start, so what follows the name is sought first."""
    t = norm_text_doc(token)
    quoted = F.concat(F.lit(r"\Q"), t, F.lit(r"\E"))
    told = lambda score, rule: lambda x: F.struct(x["raw"].alias("raw"), F.lit(score).alias("score"), F.lit(rule).alias("rule"), x["evidence"].alias("evidence"))
    nothing = F.array().cast("array<struct<raw:string,score:double,rule:string,evidence:string>>")

    def of_token(pattern: str) -> Column:
        before, *after = pattern.split("{token}")
        return F.concat(F.lit("(?i)" + before), quoted, F.lit("{token}".join(after)))

    found = []
    for pattern, score, rule in fixed.CONTEXT_RULES:
        p = of_token(pattern)
        pairs = F.arrays_zip(F.regexp_extract_all(context, p, F.lit(1)).alias("raw"), F.regexp_extract_all(context, p, F.lit(0)).alias("evidence"))
        caught = F.transform(pairs, told(score, rule))
        rest = pattern.removeprefix(fixed.NAME_TEXT)
        found.append(caught if rest == pattern else F.when(F.rlike(context, of_token(rest)), caught).otherwise(nothing))
    hint = F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])"), quoted, F.lit(r"(?![A-Za-z0-9]).{0,150}?" + fixed.CLASS_HINTS))
    hints = F.regexp_extract_all(context, hint, F.lit(0))
    found.append(F.transform(hints, lambda x: F.struct(F.lit("").alias("raw"), F.lit(0.35).alias("score"), F.lit("class_hint").alias("rule"), x.alias("evidence"))))
    return F.when((t != "") & (F.coalesce(context, F.lit("")) != ""), F.concat(*found)).otherwise(nothing)


def captured_name(raw: Column) -> Column:
    """A capture as a candidate: cleaned, and what follows its last comma where that is long enough."""
    def tail(c: Column) -> Column:
        last = F.trim(F.substring_index(c, ",", -1))
        return F.when(c.contains(",") & F.length(last).between(4, F.length(c)), last).otherwise(c)

    return bound(cleanup_candidate(raw), tail)


def context_candidates(token: Column, context: Column) -> Column:
    """array of struct(candidate, score, rule, evidence): the captures that may be names, each name once, best rule first, then class hints."""
    named = F.transform(context_captures(token, context), lambda x: F.struct(
        F.when(x["rule"] == "class_hint", "").otherwise(captured_name(x["raw"])).alias("candidate"), x["score"].alias("score"), x["rule"].alias("rule"),
        F.substring(norm_text_doc(x["evidence"]), 1, 700).alias("evidence")))
    hinted = lambda x: x["rule"] == "class_hint"
    good = F.filter(named, lambda x: hinted(x) | ~bound(x["candidate"], is_bad_candidate))
    lowered = lambda good: F.transform(good, lambda x: F.lower(x["candidate"]))
    # each step is bound: a filter that reads a step itself would compute it again for each of its elements
    return bound(good, lambda good: bound(lowered(good), lambda low: F.filter(good, lambda x, i: hinted(x) | (F.array_position(low, F.lower(x["candidate"])) == i + 1))))


def registry_query(c: Column) -> Column:
    """A name as a registry should be asked for it: wrapping, purposes, quantities, suppliers and clauses cut, one after another."""
    q = cleanup_candidate(c)
    for cut in fixed.QUERY_CUTS:
        q = F.regexp_replace(q, "(?i)" + cut, "")
    q = F.trim(F.regexp_replace(F.regexp_replace(edge(q), r"(?i)^of\s+", ""), r"\s+", " "))
    head = lambda x: F.trim(F.substring_index(x, ",", 1))
    q = bound(q, lambda x: F.when(x.contains(",") & (F.length(head(x)) >= 4), head(x)).otherwise(x))
    for word in fixed.QUERY_CLAUSES:
        q = edge(F.get(F.split(q, rf"(?i)\b{word}\b"), 0))
    return norm_text_doc(q)


def is_trusted_query(c: Column) -> Column:
    """A query that reads like a name."""
    return bound(norm_text_doc(c), _reads_like_a_name)


def _reads_like_a_name(s: Column) -> Column:
    low, words = F.lower(s), word_count(s)
    one = words == 1
    return ~(
        ~F.length(s).between(4, 120)
        | any_of(low, fixed.BAD_CANDIDATE_PHRASES + fixed.BAD_QUERY_PHRASES)
        | (words > 8)
        | s.rlike(r"^[A-Z0-9\-_/]+$")
        | s.rlike(r"^[A-Z][a-z]+$")
        | is_generic_name(low)
        | matches_any(low, fixed.QUERY_BAD_PATTERNS)
        | s.rlike(r",\s*[A-Z][a-z]+$")
        | unbalanced(s)
        | (one & (F.length(s) < 5))
        | (one & s.rlike(r"^[a-z]+$") & ~has_chemical_ending(low))
    )


def is_trusted_expansion(c: Column) -> Column:
    """A full name that a document may define an abbreviation by."""
    hinted = lambda x: any_of(x, fixed.CHEMICAL_ENDINGS)

    def late(t: Column, low: Column) -> Column:
        one = word_count(low) == 1
        return (
            (word_count(low) > 8)
            | (one & low.isin(fixed.GENERIC_SINGLE_WORDS))
            | matches_any(low, fixed.EXPANSION_LATE_PATTERNS)
            | t.rlike(r",\s*[A-Z][a-z]+$")
            | (one & ((F.length(low) < 5) | ~has_chemical_ending(low)))
            | ~(hinted(low) | (t.rlike("[A-Z]") & t.rlike("[a-z]")) | t.contains("(") | (word_count(low) >= 2))
        )

    def early(s: Column, low: Column) -> Column:
        return (
            ~F.length(s).between(4, 120)
            | reduce(lambda a, b: a | b, [low.startswith(p) for p in fixed.EXPANSION_BAD_PREFIXES])
            | any_of(low, fixed.BAD_CANDIDATE_PHRASES)
            | matches_any(low, fixed.EXPANSION_BAD_PATTERNS)
            | s.rlike(r"^[A-Z0-9\-_/]+$")
            | unbalanced(s)
        )

    # a letter or two before a name of a compound are cut
    inner = lambda s: bound(F.regexp_extract(F.lower(s), r"^[a-z]{1,2}\s+([a-z].+)$", 1), lambda x: F.when((x != "") & hinted(x), x).otherwise(s))
    judge = lambda s: bound(F.lower(s), lambda low: early(s, low)) | bound(inner(s), lambda t: bound(F.lower(t), lambda low: late(t, low)))
    return ~bound(norm_text_doc(c), judge)


def may_have_one_compound(c: Column) -> Column:
    """A trusted query that names no material, class, series or product."""
    def judge(q: Column) -> Column:
        low = F.lower(q)
        return is_trusted_query(q) & ~mentions_material(q) & ~any_of(low, fixed.MATERIAL_CLASSES) & ~low.rlike(r"\b(series|model|grade|commercial|product|membrane)\b")

    return bound(registry_query(c), judge)


def worth_asking(c: Column) -> Column:
    """Whether a registry may know one compound of this name: never for classes, always for signs of a compound, else for codes and trusted names."""
    def judge(core: Column) -> Column:
        never = core.rlike(r"(?i)\b(?:" + "|".join(fixed.NOT_WORTH_ASKING) + r")\b")
        always = core.rlike(r"(?i)\b(?:" + "|".join(fixed.WORTH_ASKING) + r")\b")
        short = (word_count(F.lower(core)) == 1) & (F.length(core) < 4)
        return F.when((F.length(core) <= 1) | never, False).when(always | F.trim(core).rlike(r"^[A-Z][A-Z0-9]{1,5}$"), True).when(short, False).otherwise(may_have_one_compound(core))

    return bound(F.when(norm_text_doc(c) == "", "").otherwise(core_name(c)), judge)


def aligned(candidate: Column, is_abbreviation: Column) -> Column:
    """struct(accepted, clean_name, entity_type, confidence) of a candidate."""
    def judge(q: Column) -> Column:
        told = lambda ok: F.struct(
            ok.alias("accepted"),
            F.when(ok, q).otherwise("").alias("clean_name"),
            F.when(~ok, "NO_CLUE").when(may_have_one_compound(q), "SPECIFIC_CHEMICAL").otherwise("NO_SPECIFIC_CHEMICAL").alias("entity_type"),
            F.when(ok, 0.62).otherwise(0.0).alias("confidence"),
        )
        return bound(is_trusted_query(q) & (~is_abbreviation | is_trusted_expansion(q)), told)

    return bound(registry_query(candidate), judge)


def strong_hit(matched: Column, name: Column) -> Column:
    """Whether tokens that were found are the name itself or a close form of it: for documents that only a title or a likeness suggests."""
    n = F.lower(norm_text_doc(name))
    parts = F.filter(F.split(n, r"[-_/]"), lambda p: p != "")
    longest = F.aggregate(parts, F.lit(""), lambda a, p: F.when(F.length(p) > F.length(a), p).otherwise(a))
    forms = [n]
    for ch in ("-", "_", " ", "/"):
        forms += [F.replace(n, F.lit(ch), F.lit("")), F.trim(F.replace(n, F.lit(ch), F.lit(" ")))]
    short = F.regexp_replace(n, r"[-_]?\d+$", "")
    forms += [F.regexp_replace(n, r"^[\d,]+\s*-\s*", ""), F.when((short == n) | (F.length(short) >= 3), short), F.when(F.length(longest) >= 3, longest)]
    for key, aliases in fixed.TOKEN_ALIASES.items():
        forms += [F.when(F.upper(n).contains(key), F.lit(a.lower())) for a in aliases]
    known = F.filter(F.array(*forms), lambda x: x.isNotNull() & (x != ""))
    near = lambda tok: F.exists(known, lambda f: (f == tok) | ((F.length(tok) >= 3) & (f.contains(tok) | ((F.length(f) >= 3) & tok.contains(f)))))
    return F.when(F.length(n) <= 5, F.size(matched) > 0).otherwise(F.exists(matched, lambda t: near(F.lower(t))))
