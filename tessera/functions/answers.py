"""Answers of judges as text: objects found in them, and their fields in one shape whatever was answered.

Objects are VARIANT values: fields may be missing, of another type or nested, and nothing fails. A text without an object
gives null, from which all fields take their defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import bound, norm_text_doc


def _end(t: Column) -> Column:
    """Where the object that a text begins with ends (from 1): the braces are even again there; 0 without such a place.

    Braces are counted in one pass over the pieces between them; those inside quoted strings do not count."""
    marks = F.regexp_extract_all(t, F.lit(r'("(?:[^"\\]|\\.)*"|[{}]|[^"{}]+|")'), F.lit(1))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(acc: Column, m: Column) -> Column:
        depth = acc["depth"] + F.when(m == "{", 1).when(m == "}", -1).otherwise(0)
        at = acc["at"] + F.length(m)
        closed = (acc["end"] == 0) & (m == "}") & (depth == 0)
        return F.struct(depth.alias("depth"), at.alias("at"), F.when(closed, at).otherwise(acc["end"]).alias("end"))

    return F.aggregate(marks, zero, step, lambda acc: acc["end"])


def _object(text: Column) -> Column:
    """The text as an object; null if it is none, or if more than white space follows it (which the parser would pass over)."""
    whole = lambda t: bound(F.try_parse_json(t), lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT") & (_end(t) == F.length(t)), v))
    return bound(F.trim(text, F.lit(" \n\t\r")), whole)


def loose_object(c: Column) -> Column:
    """The object that a text is: as it stands, without a fence around it, or from its first opening to its last closing brace."""
    def sought(s: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(s, r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")
        first, last = F.instr(bare, "{"), F.length(bare) - F.instr(F.reverse(bare), "}") + 1
        inner = F.when((first > 0) & (F.instr(bare, "}") > 0) & (last > first), F.substr(bare, first, last - first + 1))
        return F.coalesce(_object(s), _object(bare), _object(inner))

    return bound(F.trim(F.coalesce(c.cast("string"), F.lit("")), F.lit(" \n\t\r")), sought)


def first_object(c: Column) -> Column:
    """The first object of a text that holds several: from its first opening brace to where the braces are even again."""
    def sought(t: Column) -> Column:
        rest = F.substr(t, F.instr(t, "{"))
        return F.when(F.instr(t, "{") > 0, bound(_end(rest), lambda e: F.when(e > 0, _object(F.substr(rest, F.lit(1), e)))))

    return bound(F.coalesce(c.cast("string"), F.lit("")), sought)


def _text(v: Column, path: str, default: Column | str = "") -> Column:
    found = F.try_variant_get(v, path, "string")
    other = F.lit(default) if isinstance(default, str) else default
    return F.when(F.coalesce(found, F.lit("")) == "", other).otherwise(found)


def _items(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def components(v: Column, path: str = "$.components") -> Column:
    """array of struct(name, role, rank, equivalent_group): the named components of an answer, plain texts too."""
    def one(e: Column, i: Column) -> Column:
        plain = ~_is_object(e)
        return F.struct(
            norm_text_doc(F.when(plain, F.try_variant_get(e, "$", "string")).otherwise(F.try_variant_get(e, "$.name", "string"))).alias("name"),
            F.when(plain, "co_component").otherwise(_text(e, "$.role", "co_component")).alias("role"),
            F.coalesce(F.when(~plain, F.try_variant_get(e, "$.rank", "bigint")), (i + 1).cast("bigint")).alias("rank"),
            F.when(plain, "").otherwise(_text(e, "$.equivalent_group")).alias("equivalent_group"),
        )

    return F.filter(F.transform(_items(v, path), one), lambda s: s["name"] != "")


def abbreviation_candidates(v: Column, path: str = "$.abbr_candidates") -> Column:
    """array of struct(query, confidence): the candidates of an answer; a plain text counts 0.4."""
    def one(e: Column) -> Column:
        plain = ~_is_object(e)
        query = norm_text_doc(F.when(plain, F.try_variant_get(e, "$", "string")).otherwise(F.try_variant_get(e, "$.query", "string")))
        return F.struct(query.alias("query"), F.when(plain, 0.4).otherwise(F.coalesce(F.try_variant_get(e, "$.confidence", "double"), F.lit(0.0))).alias("confidence"))

    return F.filter(F.transform(_items(v, path), one), lambda s: s["query"] != "")


#: What a judge may answer.
ENTITY_TYPES = ["small_molecule", "salt_or_inorganic", "polymer", "composite_material", "surface_modified_material", "nanomaterial", "brand_or_product", "membrane_material", "unknown"]
ACTIONS = ["drop", "query_pubchem", "queue_material"]
IGNORED_COMPONENTS = ["water", "h2o", "air"]


def judged_name(raw_name: Column, v: Column) -> Column:
    """struct of a judged name: every field there, of its type and domain; only names to be asked for carry a query."""
    action, kind = F.trim(_text(v, "$.action", "queue_material")), F.trim(_text(v, "$.entity_type", "unknown"))
    action = F.when(action.isin(ACTIONS), action).otherwise("queue_material")
    return F.struct(
        raw_name.alias("raw_name"),
        action.alias("action"),
        F.trim(_text(v, "$.normalized_input", raw_name)).alias("normalized_input"),
        F.when(kind.isin(ENTITY_TYPES), kind).otherwise("unknown").alias("entity_type"),
        F.trim(_text(v, "$.expanded_abbreviation")).alias("expanded_abbreviation"),
        F.when(action == "query_pubchem", F.trim(_text(v, "$.pubchem_query_name"))).otherwise("").alias("pubchem_query_name"),
        F.coalesce(F.try_variant_get(v, "$.confidence", "double"), F.lit(0.0)).alias("confidence"),
        F.coalesce(F.try_variant_get(v, "$.review_flag", "boolean"), F.lit(True)).alias("review_flag"),
        F.trim(_text(v, "$.note")).alias("note"),
    )


def component_rows(v: Column, path: str = "$.components") -> Column:
    """array of struct(component_name, component_query) of the components that are worth a query, each once."""
    def one(e: Column) -> Column:
        plain = ~_is_object(e)
        name = F.trim(F.coalesce(F.when(plain, F.try_variant_get(e, "$", "string")).otherwise(F.try_variant_get(e, "$.name", "string")), F.lit("")))
        query = F.when(plain, name).otherwise(F.trim(_text(e, "$.pubchem", name)))
        return F.struct(name.alias("component_name"), query.alias("component_query"))

    kept = F.filter(F.transform(_items(v, path), one), lambda s: (s["component_name"] != "") & ~F.lower(s["component_name"]).isin(IGNORED_COMPONENTS))
    return F.array_distinct(kept)
