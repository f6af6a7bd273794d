"""Concentrations that a text states: numbers with units and names by their positions, and which number belongs to a name.

A text becomes a table of positions: one row for each number with a unit (start, stop, value, unit) and one for each
occurrence of a name. Each number's nearest name is found in one ordered pass over both, which holds the last name before
and the first after, so the work grows with the positions and not with their pairs. Null texts and empty keyword lists
give no rows; ties go to what stands first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import fixed, numbers, predicates, text, units
from tessera.operators.lookup import keep_first, top_k

PATTERN = predicates.ascii_edges("(?i)" + fixed.TEXT_NUMBER + "(" + "|".join(fixed.TEXT_UNITS) + ")")
#: Characters beside a number that are read for purchases; points that a name at hand is worth at most.
BESIDE, AT_HAND = 40, 18
#: Marks around a match and between its groups, of no meaning in any text.
MARK, PART = "\ue000", "\ue001"


def spans(content: Column, pattern: str, groups: int) -> Column:
    """array of struct(start, stop, g1, ...): where a pattern matches (from 0), and its groups, in order of place.

    One pass of the pattern sets marks around each match and its groups, and the text is cut at them; a text that holds such marks of its
    own is searched for each group. A running offset over the pieces gives the places."""
    plain = F.arrays_zip(*[F.regexp_extract_all(content, F.lit(pattern), F.lit(i)).alias(f"g{i}") for i in range(groups + 1)])
    marked = F.regexp_replace(content, pattern, MARK + PART.join(f"${i}" for i in range(groups + 1)) + MARK)
    told = lambda g: F.struct(*[F.get(g, i).alias(f"g{i}") for i in range(groups + 1)])

    def place(pieces: Column, found: Column) -> Column:
        sizes = F.zip_with(pieces, F.transform(found, lambda m: F.length(m["g0"])), lambda p, m: F.struct(F.length(p).alias("p"), F.coalesce(m, F.lit(0)).alias("m")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x["p"] + x["m"]).alias("at"), F.array_append(acc["out"], acc["at"] + x["p"]).alias("out"))
        starts = F.aggregate(sizes, start, step, lambda acc: acc["out"])
        named = lambda m, s: F.struct(s.alias("start"), (s + F.length(m["g0"])).alias("stop"), *[m[f"g{i}"].alias(f"g{i}") for i in range(1, groups + 1)])
        return F.filter(F.zip_with(found, starts, lambda m, s: F.when(m.isNotNull(), named(m, s))), lambda x: x.isNotNull())

    def cut(parts: Column) -> Column:
        found = F.transform(F.filter(parts, lambda x, i: i % 2 == 1), lambda x: text.bound(F.split(x, PART), told))
        return text.bound(found, lambda found: place(F.filter(parts, lambda x, i: i % 2 == 0), found))

    searched = text.bound(F.split(content, pattern), lambda pieces: text.bound(plain, lambda found: place(pieces, found)))
    return F.when(content.contains(MARK) | content.contains(PART), searched).otherwise(text.bound(F.split(marked, MARK), cut))


def stated(rows: DataFrame, keys: list[str], content: str) -> DataFrame:
    """`keys`, start, stop, value, unit, canonical_unit, unit_family of every concentration in a text."""
    found = rows.filter(F.col(content).isNotNull()).select(*keys, F.explode(spans(F.col(content), PATTERN, 2)).alias("x"))
    told = found.select(*keys, "x.start", "x.stop", text.norm_text(F.col("x.g1")).alias("value"), text.norm_text(F.col("x.g2")).alias("unit"))
    return units.with_unit_names(told, "unit")


def occurrences(rows: DataFrame, keys: list[str], content: str, words: str, every: bool) -> DataFrame:
    """`keys`, word, start: where each of a row's words occurs in any letter case, every time without overlaps or only at first."""
    low = F.lower(F.col(content))
    each = rows.select(*keys, low.alias("__low"), F.explode(F.array_distinct(F.col(words))).alias("word")).filter("word <> ''")
    word = F.lower("word")
    if not every:
        return each.select(*keys, "word", (F.instr(F.col("__low"), word) - 1).alias("start")).filter("start >= 0")
    pieces = F.split(F.col("__low"), F.concat(F.lit(r"\Q"), word, F.lit(r"\E")))
    size = F.length(word)
    grow = lambda acc, p: F.struct((acc["at"] + F.length(p) + size).alias("at"), F.array_append(acc["out"], acc["at"] + F.length(p)).alias("out"))
    starts = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), grow, lambda acc: F.slice(acc["out"], 1, F.size(acc["out"]) - 1))
    return each.select(*keys, "word", F.explode(starts).alias("start"))


def with_nearest(found: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """`found` with `near` and `near_word`: how far the nearest name of the same text begins from a number's start, and that name; null without any."""
    side = found.withColumns({"__name": F.lit(None).cast("int"), "__word": F.lit(None).cast("string"), "__is": F.lit(True)})
    other = names.select(*keys, "start", F.col("start").alias("__name"), F.col("word").alias("__word"), F.lit(False).alias("__is"))
    both = side.unionByName(other, allowMissingColumns=True)
    before, after = W.partitionBy(*keys).orderBy("start", F.col("__is")), W.partitionBy(*keys).orderBy(F.desc("start"), F.col("__is"))
    last = lambda w: F.last(F.when(F.col("__name").isNotNull(), F.struct("__name", "__word")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    told = both.withColumns({"__b": last(before), "__a": last(after)}).filter("__is")
    back, ahead = F.col("start") - F.col("__b.__name"), F.col("__a.__name") - F.col("start")
    nearer = F.coalesce(back <= ahead, back.isNotNull())
    return told.withColumns({"near": F.when(nearer, back).otherwise(ahead), "near_word": F.when(nearer, F.col("__b.__word")).otherwise(F.col("__a.__word"))}).drop("__name", "__word", "__is", "__a", "__b")


def top_snippets(rows: DataFrame, key: str, content: str, words: str, window: int = 260, most: int = 3) -> DataFrame:
    """(key, snippet, score, rank): of each text, the pieces around concentrations near a word, and of those whose unit tells its kind, best first, distinct."""
    base = rows.select(F.col(key).alias("key"), F.col(content).alias("content"), F.coalesce(F.col(words), F.array().cast("array<string>")).alias("words"))
    found = stated(base, ["key"], "content")
    near = with_nearest(found, occurrences(base, ["key"], "content", "words", True), ["key"])
    close = F.when(F.col("near") <= window, F.greatest(F.lit(1), window - F.col("near"))).otherwise(0)
    typed = F.when(predicates.any_of(F.lower("unit"), fixed.TYPED_UNITS), 40).otherwise(0)
    scored = near.select("key", "start", "stop", (close + typed).alias("score")).filter("score > 0")
    cut = scored.join(base.select("key", "content"), "key")
    begin = F.greatest(F.col("start") - window, F.lit(0))
    shown = cut.select("key", "start", "score", F.trim(F.regexp_replace(F.substr("content", begin + 1, F.col("stop") + window - begin), r"\s+", " ")).alias("snippet"))
    first = keep_first(shown, [F.col("key"), F.col("snippet")], [F.desc("score"), F.col("start")])
    return top_k(first, [F.col("key")], [F.desc("score"), F.col("start")], most).select("key", "snippet", "score", "rank")


def recovered(rows: DataFrame, key: str, snippets: str, words: str) -> DataFrame:
    """(key, found, value, unit, canonical_unit, unit_family, score, keyword, sanity, candidates): the concentration that a row's snippets state for its words.

    A number scores by its unit, by how near the first mention of a word stands, and loses by talk of purchases; what stands among
    references is passed over. The best credible one is found; without one, the best of the others is shown with its fault."""
    base = rows.select(F.col(key).alias("key"), F.posexplode(F.col(snippets)).alias("place", "snippet"), F.coalesce(F.col(words), F.array().cast("array<string>")).alias("words"))
    keys = ["key", "place"]
    near = with_nearest(stated(base, keys, "snippet"), occurrences(base, keys, "snippet", "words", False), keys).join(base.select(*keys, "snippet"), keys)
    real = near.filter(~predicates.is_reference_noise(F.col("snippet"), F.col("start"), F.col("stop")))
    begin = F.greatest(F.col("start") - BESIDE, F.lit(0))
    around = F.lower(F.substr("snippet", begin + 1, F.col("stop") + BESIDE - begin))
    score = (
        F.lit(1)
        + F.when(F.col("unit_family") != "unsupported", 8).otherwise(0)
        + F.when(F.col("unit_family") == "percent_ambiguous", 1).otherwise(0)
        + F.when(F.col("canonical_unit") != "%", 2).otherwise(0)
        - F.when(predicates.any_of(around, fixed.PURCHASE_WORDS), 8).otherwise(0)
        + F.coalesce(AT_HAND - F.least("near", F.lit(AT_HAND)), F.lit(0))
    )
    told = real.withColumns({"score": score, "sanity": numbers.number_sanity(F.col("value"), F.col("unit_family"), F.col("canonical_unit"))})
    order = F.struct((F.col("sanity") == "ok").alias("ok"), "score", -F.col("place"), -F.col("start"))
    shown = F.struct("value", "unit", "canonical_unit", "unit_family", "score", F.coalesce("near_word", F.lit("")).alias("keyword"), "sanity")
    best = told.groupBy("key").agg(F.max_by(shown, order).alias("x"), F.count("*").alias("candidates"))
    every = rows.select(F.col(key).alias("key")).join(best, "key", "left")
    return every.select("key", F.coalesce(F.col("x.sanity") == "ok", F.lit(False)).alias("found"), "x.*", F.coalesce("candidates", F.lit(0)).alias("candidates"))


# ------------------------------------------------------------------ rows with named columns
def _mentions(name: str, words: list[str]) -> bool:
    """Whether a column's name, as a key, holds one of the words."""
    key = " ".join(name.lower().replace("（", "(").replace("）", ")").split())
    return any(w in key for w in words)


def _first_of(columns: dict[str, Column], words: list[str]) -> Column:
    some = [F.nullif(text.norm_text(v), F.lit("")) for n, v in columns.items() if _mentions(n, words)]
    return F.coalesce(*some, F.lit(""))


def sample_text(columns: dict[str, Column]) -> Column:
    """The distinct texts of a row's columns for samples, files and titles, between ' | '."""
    some = [v for n, v in columns.items() if _mentions(n, fixed.SAMPLE_COLUMNS)]
    return F.array_join(text.unique_keep_order(F.array(*some)), " | ") if some else F.lit("")


def row_metadata(columns: dict[str, Column]) -> Column:
    """struct(doi, title, filename_hint): the first of a row's columns for each that is not blank."""
    return F.struct(_first_of(columns, ["doi"]).alias("doi"), _first_of(columns, fixed.TITLE_COLUMNS).alias("title"), _first_of(columns, fixed.FILE_COLUMNS).alias("filename_hint"))


def row_density(columns: dict[str, Column], slot: Column) -> Column:
    """struct(rho, source): the credible density of the column that fits the slot best, the first of equals; nulls and '' without one."""
    offers = []
    for at, (n, v) in enumerate((n, v) for n, v in columns.items() if _mentions(n, fixed.DENSITY_COLUMNS)):
        rho = numbers.parse_number(v.cast("string"))
        score = F.lit(1)
        for s, words in fixed.DENSITY_WORDS.items():
            score = score + F.when(slot == s, 2 * sum(_mentions(n, [w]) for w in words)).otherwise(0)
        offers.append(F.when((rho > 0) & (rho <= 5), F.struct(score.alias("score"), F.lit(-at).alias("at"), rho.alias("rho"), F.lit(f"ROW_COLUMN::{n}").alias("source"))))
    none = F.struct(F.lit(None).cast("double").alias("rho"), F.lit("").alias("source"))
    if not offers:
        return none
    best = F.array_max(F.array(*offers))
    return F.when(best.isNotNull(), F.struct(best["rho"].alias("rho"), best["source"].alias("source"))).otherwise(none)


def row_solvent(columns: dict[str, Column], phase: Column) -> Column:
    """The solvent of a slot of that default phase: from columns for its phase, then from general ones and the whole row, with care for unknown phases."""
    water, oil, general = [], [], []
    for n, v in columns.items():
        if _mentions(n, fixed.SOLVENT_COLUMNS):
            (water if _mentions(n, fixed.WATER_COLUMNS) else oil if _mentions(n, fixed.OIL_COLUMNS) else general).append(text.solvent_name(v))
    filled = lambda some: F.filter(F.array(*some) if some else F.array().cast("array<string>"), lambda x: x != "")
    last = lambda some: F.coalesce(F.get(filled(reversed(some) if some else []), 0), F.lit(""))
    # the whole row is read only where its own columns leave the phase open, and once
    every = lambda step: text.bound(F.array_distinct(filled([*general, text.solvent_name(text.row_text(columns))])), step)
    dry = every(lambda e: F.coalesce(F.get(F.filter(e, lambda x: x != "water"), 0), F.lit("")))
    only_water = every(lambda e: (F.size(e) == 1) & (F.get(e, 0) == "water"))
    by_phase = lambda wet: (
        F.when(phase == "aqueous", F.when(wet != "", wet).otherwise("water"))
        .when(phase == "organic", text.bound(last(oil), lambda x: F.when(x != "", x).otherwise(dry)))
        .when(wet != "", wet)
        .when(only_water, "water")
        .otherwise("")
    )
    return text.bound(last(water), by_phase)


def parameters(required: Column, mw: Column, solution: Column, solute: Column, assumed: Column, unit: Column) -> Column:
    """struct(found, missing, assumed) of the parameters that a conversion requires: none is made up."""
    def state(raw: Column) -> Column:
        t = text.norm_key(raw)
        has = lambda *words: predicates.any_of(t, list(words))
        there = (
            F.when(has("mw", "molecular", "molar mass"), mw.isNotNull())
            .when(has("rho_solution", "solution density", "density of solution"), solution.isNotNull())
            .when(has("rho_solute", "solute density"), solute.isNotNull())
            .when(has("temperature"), text.norm_key(unit).contains("temp"))
            .otherwise(False)
        )
        held = ~has("mw", "molecular", "molar mass") & has("rho_solution", "solution density", "density of solution") & there & assumed
        return F.struct(raw.alias("raw"), there.alias("there"), held.alias("held"))

    def sort_out(states: Column) -> Column:
        names = lambda test: F.transform(F.filter(states, test), lambda s: s["raw"])
        told = F.transform(F.filter(states, lambda s: s["held"]), lambda s: F.concat(s["raw"], F.lit(" (rho_solution assumed)")))
        return F.struct(names(lambda s: s["there"]).alias("found"), names(lambda s: ~s["there"]).alias("missing"), told.alias("assumed"))

    return text.bound(F.transform(F.filter(required, lambda r: text.norm_key(r) != ""), state), sort_out)


def molecular_weight(rows: DataFrame, row: str, cache: DataFrame, by_cid: DataFrame, by_name: DataFrame, enabled: bool = True) -> DataFrame:
    """(row, mw, source) of `rows` (row, mw, trusted, cid, iupac, standard, solute, identity_source): the first that knows it of the
    identity table (if trusted), the cache (key, mw, source; a null weight there is an answer), and, unless the name is an
    unresolved abbreviation, the registry by number (cid, mw) and by name (name_key, mw; never for short abbreviations).

    All keys of a row are tried in one equi-join with the three tables as one; the hit of the first key stays."""
    blank = lambda c: text.norm_text(F.col(c))
    names = ["iupac", "standard", "solute"]
    entry = lambda space, key, label: F.when(key.isNotNull(), F.struct(F.lit(space).alias("space"), key.alias("key"), F.lit(label).alias("label")))
    filled = lambda c: F.when(blank(c) != "", blank(c))
    cached = [entry("cache", F.concat(F.lit("cid::"), filled("cid")), "")] + [entry("cache", F.concat(F.lit("name::"), text.norm_key(filled(c))), "") for c in names]
    cached = [F.when(filled(c).isNotNull(), e) for c, e in zip(["cid", *names], cached, strict=True)]
    online = [entry("cid", filled("cid"), "PUBCHEM_CID")]
    for c, label in zip(names, ("PUBCHEM_IUPAC_NAME", "PUBCHEM_STANDARDIZED_NAME", "PUBCHEM_ORIGINAL_NAME"), strict=True):
        online.append(F.when((blank(c) != "") & ~predicates.is_short_abbreviation(F.col(c)), entry("name", F.lower(filled(c)), label)))
    skipped = F.col("identity_source") == "UNRESOLVED_ABBREVIATION"
    asked = F.array(*cached) if not enabled else F.concat(F.array(*cached), F.when(skipped, F.array().cast("array<struct<space:string,key:string,label:string>>")).otherwise(F.array(*online)))
    known = F.when(F.col("trusted"), F.col("mw"))
    base = rows.select(F.col(row).alias("row"), known.alias("own"), skipped.alias("skipped"), F.filter(asked, lambda e: e.isNotNull()).alias("tries"))
    tables = (
        cache.select(F.lit("cache").alias("space"), "key", "mw", "source")
        .unionByName(by_cid.select(F.lit("cid").alias("space"), F.col("cid").cast("string").alias("key"), "mw", F.lit(None).cast("string").alias("source")))
        .unionByName(by_name.select(F.lit("name").alias("space"), F.col("name_key").alias("key"), "mw", F.lit(None).cast("string").alias("source")))
        .filter("space = 'cache' or mw is not null")
    )
    tried = base.filter("own is null").select("row", F.posexplode("tries").alias("at", "e")).select("row", "at", "e.space", "e.key", "e.label")
    hit = tried.join(tables, ["space", "key"]).groupBy("row").agg(F.min_by(F.struct("mw", F.coalesce("source", F.when(F.col("space") == "cache", "PUBCHEM_CACHE"), F.col("label")).alias("source")), F.struct("at", "mw")).alias("hit"))
    nothing = F.lit("PUBCHEM_DISABLED") if not enabled else F.when(F.col("skipped"), "MW_SKIPPED_UNRESOLVED_ABBREVIATION").otherwise("PUBCHEM_NOT_FOUND")
    out = base.join(hit, "row", "left")
    return out.select("row", F.coalesce("own", "hit.mw").alias("mw"), F.when(F.col("own").isNotNull(), "IDENTITY_TABLE").when(F.col("hit").isNotNull(), F.col("hit.source")).otherwise(nothing).alias("source"))
