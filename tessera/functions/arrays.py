"""Multi-valued cells: splitting, aligning and taking apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.predicates import PLACEHOLDERS, is_placeholder
from tessera.functions.text import bound, cell_text, match_key, norm_text, norm_text_doc


def split_multi(c: Column) -> Column:
    """Items between runs of semicolons, trimmed, blanks left out."""
    return F.filter(F.transform(F.split(norm_text(c), "[;；]+"), lambda x: F.trim(x)), lambda x: x != "")


def split_components(c: Column) -> Column:
    """Items between ; | ｜ outside brackets, edges cleaned, placeholders left out, distinct by match key."""
    plain = lambda text: F.split(text, "[;|｜]")
    clean = lambda x: F.trim(F.regexp_replace(x, r"^[,;\s]+|[,;\s]+$", ""))
    keyed = lambda x: F.struct(x.alias("x"), match_key(x).alias("k"))

    def distinct(items: Column) -> Column:
        first = lambda keys: F.filter(items, lambda s, i: F.array_position(keys, s["k"]) == i + 1)
        return F.transform(bound(F.transform(items, lambda s: s["k"]), first), lambda s: s["x"])

    def items(text: Column) -> Column:
        # a walk over the characters is needed only where there are brackets
        pieces = F.when(text.rlike(r"[(\[{]"), _outside_brackets(text)).otherwise(plain(text))
        told = F.filter(F.transform(pieces, lambda x: bound(clean(x), keyed)), lambda s: ~s["k"].isin(PLACEHOLDERS))
        return F.when(is_placeholder(text), F.array().cast("array<string>")).otherwise(bound(told, distinct))

    return bound(cell_text(c), items)


def _outside_brackets(text: Column) -> Column:
    start = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"), F.lit("").alias("buf"), F.array().cast("array<string>").alias("items"))

    def step(s: Column, ch: Column) -> Column:
        depth = lambda n, up, down: F.when(ch == up, s[n] + 1).when(ch == down, F.greatest(s[n] - 1, F.lit(0))).otherwise(s[n])
        a, b, d = depth("a", "(", ")"), depth("b", "[", "]"), depth("c", "{", "}")
        cut = ch.isin(";", "|", "｜") & (a == 0) & (b == 0) & (d == 0)
        return F.struct(
            a.alias("a"),
            b.alias("b"),
            d.alias("c"),
            F.when(cut, F.lit("")).otherwise(F.concat(s["buf"], ch)).alias("buf"),
            F.when(cut, F.concat(s["items"], F.array(s["buf"]))).otherwise(s["items"]).alias("items"),
        )

    return F.aggregate(F.split(text, ""), start, step, lambda s: F.concat(s["items"], F.array(s["buf"])))


def align(items: Column, n: Column, fill: Column, broadcast: bool = True) -> Column:
    """n items: one is repeated (where `broadcast`), fewer are padded with `fill`, more are cut."""
    one = F.size(items) == 1 if broadcast else F.lit(False)
    padded = F.slice(F.concat(items, F.array_repeat(fill, n)), 1, n)
    return F.when(one, F.array_repeat(F.element_at(items, 1), n)).otherwise(padded)


def align_note(items: Column, n: Column, field: str, broadcast: bool = True) -> Column:
    """What align does: '' if nothing."""
    have = F.size(items)
    note = lambda what: F.concat(F.lit(f"{field}:{what}_"), have.cast("string"), F.lit("_to_"), n.cast("string"))
    return (
        F.when(have == 0, F.concat(F.lit(f"{field}:empty_to_"), n.cast("string")))
        .when(have == n, F.lit(""))
        .when((have == 1) & F.lit(broadcast), note("broadcast"))
        .when(have < n, note("padded"))
        .otherwise(note("truncated"))
    )


def align_cycle(items: Column, n: Column) -> Column:
    """n items, the list repeated from its start; nothing gives nulls."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(F.size(items) > 0, F.get(items, (i % F.greatest(F.size(items), F.lit(1))).cast("int"))))


def zip_shortest(*lists: Column) -> Column:
    """Structs up to the end of the shortest list."""
    return F.arrays_zip(*[F.slice(x, 1, F.least(*map(F.size, lists))) for x in lists])


#: Fixed value: what connects the parts of a mixture; a comma inside a locant such as 1,3- or N,N- does not.
CONNECTOR = r"(?i)\s*(?:/|\+|;|(?<![0-9NO]),|,(?![0-9NO])| and )\s*"
CONNECTOR_ANY = r"(?i)\s*(?:/|\+|,|;| and )\s*"
POLYMER_WORDS = ["poly(", "poly-", "poly ", "polymer", "cellulose", "纤维素", "树脂", "membrane", "nanocellulose"]


def mixture_parts(c: Column, locants_apart: bool = False) -> Column:
    """Distinct parts of a mixture: array of struct(rank, name, role, equivalent_group). Without a connector, a polymer of three
    words or more gives its head and the rest. Commas in locants do not connect unless `locants_apart`."""
    import re

    t = norm_text_doc(c)
    pattern = CONNECTOR_ANY if locants_apart else CONNECTOR
    words = F.split(t, r"\s+")
    polymer = F.lower(t).rlike("|".join(re.escape(w) for w in POLYMER_WORDS)) & (F.size(words) >= 3)
    split = F.filter(F.transform(F.split(t, pattern), lambda x: F.trim(x)), lambda x: x != "")
    parts = (
        F.when(t.rlike(pattern), split)
        .when(polymer, F.array(F.element_at(words, 1), F.array_join(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))), " ")))
        .otherwise(F.filter(F.array(t), lambda x: x != ""))
    )
    low = F.transform(parts, F.lower)
    first = F.filter(F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.array_position(low, F.lower(s["x"])) == s["i"] + 1)
    return F.transform(
        first,
        lambda s, i: F.struct((i + 1).alias("rank"), s["x"].alias("name"), F.when(i == 0, "primary").otherwise("co_component").alias("role"), F.concat(F.lit("G"), (i + 1).cast("string")).alias("equivalent_group")),
    )


def json_object(c: Column) -> Column:
    """The outermost braces of a text, with or without a fence around them; '' without any."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"(?s)\{.*\}", 0)
