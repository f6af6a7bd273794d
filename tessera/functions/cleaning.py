"""Cleaning rules of the first versions of the cleaner, kept beside the present ones. Null text counts as '' unless said otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.predicates import any_of
from tessera.functions.text import norm_text, or_empty

# ---- fixed values: stereo signs at the start, in order ----
STEREO_STARTS = [r"^\((\+|-|±)\)-\s*", r"^(rac|dl|d|l)-\s*"]

# ---- fixed values: patterns of amounts, solution words, marks and models ----
AMOUNT_PERCENT = r"\d+(\.\d+)?%"
AMOUNT_UNIT = r"(?iu)\d+(\.\d+)?\s*(mg|g|ml|mM|μM|nM|L|nm)"
SOLUTION_WORDS = r"(?i)溶液|solution|水溶液|aqueous|suspension|dispersion"
BRACKET_ENGLISH = r"\(([A-Za-z\s\-,\.0-9]+)\)"
BRACKETS = r"[\(（].*?[\)）]"
TRADE_MARKS = "™|®|©"
MODEL_NUMBER = r"(?i)Model\s+No\..*"

# ---- fixed values: words that modify a component ----
MODIFIERS = [
    "modified", "crosslinked", "sulfonated", "nitro", "anhydrous", "free", "mixed", "aromatic", "thin-film", "composite", "support", "membrane", "nanoparticles", "netting",
    "fabric", "substrate", "bilayer", "self-standing", "amorphous", "porous",
]

# ---- fixed values: process conditions ----
PROCESS_PATTERNS = [
    r"\bdrying\b", r"\bblowing\b", r"\bwithout\b", r"\bwith\b", r"\bpost[- ]treatment\b", r"\bpretreatment\b", r"\bcuring\b", r"\baging\b", r"\bannealing\b",
    r"\bcalcination\b", r"\bsoaking\b", r"\bimmersion\b", r"\brinsing\b", r"\bwashing\b", r"\bstir(ring)?\b", r"\bsonication\b", r"\bultrasonic\b", r"\bvacuum\b", r"\bair\b",
    r"\bnatural\b", r"°c", r"℃", r"\btemperature\b", r"\brt\b", r"\broom temperature\b", r"\bmin\b", r"\bh\b", r"\bhour(s)?\b", r"\bday(s)?\b",
]

# ---- fixed values: membrane types (words, short name, result), in order ----
MEMBRANE_WORDS = [
    ("reverse osmosis", "ro", "RO"), ("nanofiltration", "nf", "NF"), ("ultrafiltration", "uf", "UF"), ("microfiltration", "mf", "MF"), ("membrane distillation", "md", "MD"),
    ("forward osmosis", "fo", "FO"),
]

# ---- fixed values: form of a solute, by words, then by parts of words ----
LIQUID_WORDS = [
    "ethanol", "methanol", "isopropanol", "propanol", "butanol", "glycerol", "glycerin", "acetone", "acetonitrile", "dmf", "dmac", "nmp", "hexane", "heptane", "toluene", "xylene",
    "isopar", "cyclohexanone", "triethylamine", "tea", "aptes", "teos", "silane", "iptes", "mptms", "tms", "dopamine solution",
]
SOLID_WORDS = [
    "nacl", "licl", "sls", "sds", "mpd", "m-phenylenediamine", "piperazine", "pip", "tmc", "trimesoyl chloride", "camphorsulfonic acid", "csa", "pvp", "peg", "pei",
    "dopamine hydrochloride", "go", "graphene oxide", "nanoparticle", "nanotube", "oxide", "zeolite", "mof", "salt", "powder", "particle", "chloride", "sulfate",
]
SOLID_PARTS = ["chloride", "sulfate", "nitrate", "oxide", "nanoparticle", "powder", "salt"]
LIQUID_PARTS = ["alcohol", "amine", "silane"]

# ---- fixed values: names too general to be traced ----
GENERAL_WORDS = [
    "membrane", "membranes", "glass", "water", "support", "substrate", "gold", "silver", "copper", "iron", "zinc", "nickel", "platinum", "acid", "base", "salt", "solvent", "oil", "gas",
    "air", "solution", "mixture", "sample", "surface", "coating", "layer", "film", "fiber", "fibre", "tube", "rod", "wire", "bead", "particle", "powder", "crystal", "liquid", "solid",
    "gel", "additive", "filler", "dopant", "catalyst", "reagent", "monomer", "surfactant", "plasticizer", "stabilizer", "initiator", "sand", "clay", "carbon", "nitrogen", "oxygen",
    "hydrogen", "rubber", "plastic", "metal", "ceramic", "concrete", "wood", "paper", "fabric", "foam", "sponge", "mesh", "grid",
]
PROPERTY_WORDS = [
    "hydrophilicity", "hydrophobicity", "roughness", "permeability", "wettability", "porosity", "viscosity", "conductivity", "resistance", "selectivity", "rejection", "fouling",
    "antifouling", "anti-fouling", "crosslinking", "cross-linking", "degradation", "aging", "ageing", "stability", "durability", "flexibility", "rigidity", "elasticity", "adsorption",
    "absorption", "desorption", "diffusion", "osmosis", "compaction", "swelling", "shrinkage", "corrosion", "erosion", "turbidity", "hardness", "softness", "brightness", "opacity",
    "transparency", "adhesion", "cohesion", "friction", "abrasion", "flux", "recovery", "retention", "leaching", "bleeding", "crystallinity", "amorphousness", "morphology", "topology",
    "zeta potential", "contact angle", "surface energy",
]
METHOD_WORDS = [
    "filtration", "distillation", "evaporation", "condensation", "precipitation", "centrifugation", "sonication", "ultrasonication", "extrusion", "casting", "spinning", "electrospinning",
    "coating", "dipping", "spraying", "sputtering", "annealing", "sintering", "calcination", "pyrolysis", "polymerization", "copolymerization", "grafting", "blending", "mixing",
    "stirring", "heating", "cooling", "drying", "washing", "rinsing", "etching", "oxidation", "reduction", "functionalization", "modification", "treatment", "preparation",
    "fabrication", "synthesis", "characterization", "measurement", "analysis", "testing", "evaluation", "optimization", "comparison",
]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_stereo(c: Column) -> Column:
    """Without signs of stereochemistry at the start, where four characters or more are left."""
    out = strip(or_empty(c))
    for pattern in STEREO_STARTS:
        cut = F.regexp_replace(out, f"(?i){pattern}", "")
        out = F.when(F.length(cut) >= 4, cut).otherwise(out)
    return out


def without_amounts(c: Column) -> Column:
    """A raw name without amounts, solution words, brackets, trade marks and model numbers; English in brackets replaces the whole. Null stays null."""
    t = strip(c.cast("string"))
    for pattern in (AMOUNT_PERCENT, AMOUNT_UNIT, SOLUTION_WORDS):
        t = F.regexp_replace(t, pattern, "")
    english = strip(F.regexp_extract(t, BRACKET_ENGLISH, 1))
    t = F.when(F.length(english) > 2, english).otherwise(t)
    for pattern in (BRACKETS, TRADE_MARKS, MODEL_NUMBER):
        t = F.regexp_replace(t, pattern, "")
    return strip(t)


def main_component(c: Column) -> Column:
    """A name without modifiers, what follows @ or /, and numbers at the end. Null stays null."""
    t = F.regexp_replace(c.cast("string"), r"(?iU)\b(" + "|".join(MODIFIERS) + r")\b", "")
    for pattern in ("@.*", "/.*", r"-\d+[A-Z]?$", r"(?U)\s+\d+$"):
        t = F.regexp_replace(t, pattern, "")
    return strip(t)


def is_process_condition(c: Column) -> Column:
    """A condition of a process instead of a name; blanks count as one."""
    t = F.lower(strip(or_empty(c)))
    return (t == "") | t.rlike("(?U)" + "|".join(PROCESS_PATTERNS))


def join_texts(values: Column, separator: str = ";") -> Column:
    """The normalised texts of an array that are not blank, in order; a null array gives ''."""
    return F.coalesce(F.array_join(F.filter(F.transform(values, norm_text), lambda x: x != ""), separator), F.lit(""))


def format_six(x: Column) -> Column:
    """Whole numbers as they are, others in six significant digits as %g writes them; null and what is not finite give null."""
    v = x.cast("double")
    size = F.abs(v)
    # doubles from 2 ** 53 on are whole; floor gives a long, which larger ones overflow
    whole = (size >= 2.0**53) | (size - F.floor(size) < 1e-12)
    power = F.format_string("%.5e", v)
    exponent = F.regexp_extract(power, "e(.*)$", 1).try_cast("int")
    tidy = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    plain = tidy(power.try_cast("decimal(38,18)").cast("string"))
    scientific = F.concat(tidy(F.regexp_extract(power, "^(.*)e", 1)), F.regexp_extract(power, "(e.*)$", 1))
    as_whole = F.when(size < 9e18, F.when(size < 9e18, v).cast("long").cast("string")).otherwise(F.format_string("%.0f", v))
    shown = F.when(whole, as_whole).when(exponent.between(-4, 5), plain).otherwise(scientific)
    return F.when(v.isNotNull() & ~F.isnan(v) & (size < float("inf")), shown)


def _membrane(c: Column, kind) -> tuple[Column, Column]:
    """The distinct types found in the items of a cell, '; ' between them, and whether there are any."""
    items = F.filter(F.transform(F.split(c, "[;；]+"), lambda x: F.lower(strip(x))), lambda x: x != "")
    types = F.array_distinct(F.filter(F.transform(items, kind), lambda x: x.isNotNull()))
    return F.array_join(types, "; "), F.size(types) > 0


def _first(rules: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for test, result in reversed(rules):
        out = F.when(test, F.lit(result)).otherwise(out)
    return out


def membrane_type(c: Column) -> Column:
    """RO, NF, UF, MF, MD, FO, by full words or by the short name as a word of its own; else the trimmed text, null for blanks."""
    t = F.translate(strip(or_empty(c)), "　", " ")
    padded = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    found, some = _membrane(t, lambda x: _first([(x.contains(words) | padded(x).contains(f" {short} "), name) for words, short, name in MEMBRANE_WORDS]))
    return F.when(some, found).when(t != "", t)


def membrane_type_by_map(c: Column) -> Column:
    """The same types by the first short name or words found anywhere in an item; else the text with single spaces; blanks stay."""
    t = F.regexp_replace(strip(or_empty(c)), r"(?U)\s+", " ")
    found, some = _membrane(t, lambda x: _first([(x.contains(part), name) for words, short, name in MEMBRANE_WORDS for part in (short, words)]))
    return F.when(t == "", c).when(some, found).otherwise(t)


def phase_of_slot(slot: Column, aqueous: Column, organic: Column, context: Column) -> Column:
    """Struct of phase, source and solvent, by the slot, else by words of the context, else by the organic solvent."""
    water = F.coalesce(F.nullif(aqueous, F.lit("")), F.lit("water"))
    low = F.lower(or_empty(context))
    as_struct = lambda phase, source, solvent: F.struct(F.lit(phase).alias("phase"), F.lit(source).alias("source"), solvent.cast("string").alias("solvent"))
    return (
        F.when(slot == "aqueous_monomer", as_struct("aqueous", "column_hint", water))
        .when(slot == "organic_monomer", as_struct("organic", "column_hint", organic))
        .when(slot == "test_nacl", as_struct("test_aqueous", "column_hint", F.lit("water")))
        .when(any_of(low, ["aqueous", "water", "水相"]), as_struct("aqueous", "row_context", water))
        .when(or_empty(organic) != "", as_struct("organic", "row_context", organic))
        .otherwise(as_struct("unknown", "unknown", F.lit(None)))
    )


def form_of_solute(solute: Column, slot: Column) -> Column:
    """Struct of liquid, solid or unknown and where that is known from."""
    s = F.lower(strip(or_empty(solute)))
    as_struct = lambda form, source: F.struct(F.lit(form).alias("form"), F.lit(source).alias("source"))
    return (
        F.when(slot == "test_nacl", as_struct("solid", "chemical_knowledge"))
        .when(any_of(s, LIQUID_WORDS), as_struct("liquid", "chemical_knowledge"))
        .when(any_of(s, SOLID_WORDS + SOLID_PARTS), as_struct("solid", "chemical_knowledge"))
        .when(any_of(s, LIQUID_PARTS), as_struct("liquid", "chemical_knowledge"))
        .otherwise(as_struct("unknown", "unknown"))
    )


def is_too_general(c: Column) -> Column:
    """Not worth tracing: general words, properties, methods, very short names, or a determiner and one word."""
    t = strip(or_empty(c))
    low = F.lower(t)
    words = F.split(low, r"(?U)\s+")
    bare = F.regexp_replace(low, "[^a-z]", "")
    joined = [re.sub(r"[-\s]", "", w) for w in PROPERTY_WORDS]
    letters = F.transform(F.filter(words, lambda w: F.length(w) >= 2), lambda w: F.regexp_replace(w, "[^a-z]", ""))
    single = bare.isin(GENERAL_WORDS + PROPERTY_WORDS + METHOD_WORDS) | ((F.length(bare) <= 3) & ~t.rlike("^[A-Z]{2,3}$"))
    return (
        (low == "")
        | ((F.size(words) == 1) & single)
        | low.isin(PROPERTY_WORDS + METHOD_WORDS)
        | F.regexp_replace(low, r"(?U)[-\s]", "").isin(joined)
        | ((F.size(words) <= 2) & F.forall(letters, lambda w: w.isin(GENERAL_WORDS)))
        | low.rlike(r"(?U)^(the|a|an|this|these|some|other|various|several)\s+\w+$")
    )


def evidence_lines(text: Column, keywords: list[str], around: int = 3) -> Column:
    """For every line with a keyword, in any case: the line with `around` lines on both sides. Null text gives no lines."""
    low = [k.lower() for k in keywords]

    # the outer transform binds the lines, so that they are split once
    def of_lines(lines: Column) -> Column:
        def window(line: Column, i: Column) -> Column:
            first = F.greatest(i - around, F.lit(0))
            hit = F.when(any_of(F.lower(line), low), F.array_join(F.slice(lines, first + 1, i + around + 1 - first), "\n"))
            return hit

        return F.filter(F.transform(lines, window), lambda x: x.isNotNull())

    return F.get(F.transform(F.array(F.split(or_empty(text), "\n", -1)), of_lines), 0)
