"""Concentration units: repair of spellings, canonical unit and family, conversion to weight percent."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import fixed
from tessera.functions.predicates import any_of
from tessera.functions.text import bound, norm_key, norm_text, solvent_name


def lookup(c: Column, table: dict[str, object]) -> Column:
    """The value of a key in a small fixed table, else null."""
    return F.element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), c)


def repair_unit(c: Column) -> Column:
    """One spelling for dashes, dots, exponents and volume percents; what follows 'of' or 'in' goes."""
    t = F.translate(norm_text(c), "％μµ−–—⁻·．／", "%uu----../")
    t = F.regexp_replace(t, r"([A-Za-z])\?1\b", "$1-1")
    t = F.regexp_replace(t, r"(?i)\b(g|mg|ug|ng|mol|mmol|monomoles)(?:\.|\s+)L-1\b", "$1/L")
    t = F.regexp_replace(t, r"(?i)\b(mg|g)(?:\.|\s+)mL-1\b", "$1/mL")
    t = F.trim(F.regexp_replace(t, r"(?i)\b(of|in)\b.*$", ""))
    t = F.regexp_replace(t, r"(?i)w\s*/\s*v\s*\.\s*%", "w/v%")
    t = F.regexp_replace(t, r"(?i)wt\s*/\s*v(?:ol)?\s*%", "wt/v%")
    return bound(t, lambda x: F.trim(F.regexp_replace(F.when(x.rlike(r"(?i)^%\s*\(aqueous\)$"), "%").otherwise(x), r"\s+", " ")))


def normalize_unit(c: Column) -> Column:
    """struct(unit, family, detail) of a unit text; the first family that knows the spelling decides."""
    key = lambda raw: F.translate(F.regexp_replace(F.lower(raw), r"\s+", ""), "[]{}", "()()")
    return bound(repair_unit(c), lambda raw: bound(key(raw), lambda k: bound(F.lower(raw), lambda low: _unit_of(raw, k, low))))


def _unit_of(raw: Column, key: Column, low: Column) -> Column:
    out = lambda unit, family, detail="": F.struct(unit.alias("unit"), F.lit(family).alias("family"), F.lit(detail).alias("detail"))
    table = lambda values: lookup(key, values)
    return (
        F.when(raw == "", out(F.lit(""), "unsupported", "empty unit string"))
        .when(key.isin("%", "percent"), out(F.lit("%"), "percent_ambiguous"))
        .when(key.isin(fixed.MASS_FRACTION) | key.rlike("bymass|w/w|m/m"), out(F.lit("wt%"), "mass_fraction"))
        .when(key.isin(fixed.GRAMS_PER_100ML), out(F.lit("g/100mL"), "mass_volume_percent"))
        .when(key.isin(fixed.MASS_VOLUME), out(F.lit("w/v%"), "mass_volume_percent"))
        .when(table(fixed.MASS_CONCENTRATION).isNotNull(), out(table(fixed.MASS_CONCENTRATION), "mass_concentration"))
        .when(raw.isin("M", "mM"), out(raw, "molarity"))
        .when(table(fixed.MOLARITY).isNotNull(), out(table(fixed.MOLARITY), "molarity"))
        .when(table(fixed.VOLUME_FRACTION).isNotNull(), out(table(fixed.VOLUME_FRACTION), "volume_fraction"))
        .when(table(fixed.PPM_FAMILY).isNotNull(), out(table(fixed.PPM_FAMILY), "ppm_family"))
        .when(low.rlike(r"\b(molar\s*ratio|monomer\s*ratio|feed\s*ratio|mol\s*ratio|mole\s*ratio)\b"), out(raw, "unsupported", "ratio_label_not_a_concentration_unit"))
        .when(low.rlike(r"\b(degree\s*of\s*polymeri[sz]ation|dp\b)\b"), out(raw, "unsupported", "polymerization_degree_not_concentration"))
        .when(raw.rlike(r"^\d+\s*:\s*\d+$"), out(raw, "unsupported", "numeric_ratio_not_concentration"))
        .when(key.isin(fixed.BARE_AMOUNTS), out(raw, "unsupported", "bare_mass_or_volume_without_per_solution_not_concentration"))
        .otherwise(out(raw, "unsupported", "unrecognized_unit_spelling"))
    )


def inline_unit(value: Column, unit: Column) -> Column:
    """struct(value, unit): a unit written behind the number of a value cell moves to an empty unit cell."""
    v, u = norm_text(value), norm_text(unit)
    pattern = r"^\s*([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)\s*(.+?)\s*$"
    rest = F.regexp_extract(v, pattern, 2)
    moves = (u == "") & rest.rlike("[A-Za-z%/]")
    return F.struct(F.when(moves, F.regexp_extract(v, pattern, 1)).otherwise(v).alias("value"), F.when(moves, F.trim(rest)).otherwise(u).alias("unit"))


def phase(slot: Column, standard: Column, original: Column, solvent: Column) -> Column:
    """aqueous, organic or unknown: fixed by the slot, else by known solutes, else by water as the solvent."""
    return phase_of_keys(slot, norm_key(standard), norm_key(original), norm_key(solvent))


def phase_of_keys(slot: Column, s: Column, o: Column, solvent: Column) -> Column:
    """phase of keys that are normalised already."""
    known = lambda names: s.isin(names) | o.isin(names)
    default = lookup(slot, dict(fixed.SLOTS))
    return (
        F.when(default.isin("aqueous", "organic"), default)
        .when(known(fixed.AQUEOUS_SOLUTES), "aqueous")
        .when(known(fixed.ORGANIC_SOLUTES), "organic")
        .when(solvent == "water", "aqueous")
        .otherwise("unknown")
    )


def physical_form(standard: Column, original: Column) -> Column:
    """liquid, solid or unknown, by known solutes, then by words."""
    return form_of_keys(norm_key(standard), norm_key(original))


def form_of_keys(s: Column, o: Column) -> Column:
    """physical_form of keys that are normalised already."""
    both = F.concat(s, F.lit(" | "), o)
    liquids = fixed.LIQUIDS + list(fixed.SOLUTE_DENSITY)
    return (
        F.when(s.isin(liquids) | o.isin(liquids), "liquid")
        .when(s.isin(fixed.SOLIDS) | o.isin(fixed.SOLIDS), "solid")
        .when(any_of(both, fixed.SOLID_HINTS) & ~any_of(both, fixed.LIQUID_HINTS), "solid")
        .otherwise("unknown")
    )


def percent_type(family: Column, slot: Column, phase_: Column, form: Column, solvent: Column, unit: Column, context: Column) -> Column:
    """What a bare percent means: struct(type, confidence). Explicit words in unit or context decide first, then the slot, a
    shared percent in the context, and at last phase and physical form."""
    text = F.concat_ws(" ", norm_key(unit), F.lower(F.coalesce(context, F.lit(""))))
    sample = F.lower(F.coalesce(context, F.lit("")))
    side = slot.isin("aqueous_monomer", "additive", "modifier")
    out = lambda t, c: F.struct(F.lit(t).alias("type"), F.lit(c).alias("confidence"))
    by_family = lookup(family, {"mass_fraction": "WT_PERCENT", "mass_volume_percent": "WV_PERCENT", "volume_fraction": "VOL_PERCENT"})
    shared = F.instr(sample, "%") > 0
    return (
        F.when(family != "percent_ambiguous", F.struct(F.coalesce(by_family, F.lit("")).alias("type"), F.when(by_family.isNotNull(), "n/a").otherwise("").alias("confidence")))
        .when(text.rlike(r"%\s*\((w/v|m/v)\)|\bw/v\b|\bm/v\b|wt/vol|wt\s*/\s*v"), out("WV_PERCENT", "high"))
        .when(text.rlike(r"%\s*\(v/v\)|\bv/v\b|\bvol\.?%?\b"), out("VOL_PERCENT", "high"))
        .when(text.rlike(r"%\s*\((w/w|wt)\)|\bw/w\b|\bwt%\b|\bmass%\b|%\s*by\s*mass"), out("WT_PERCENT", "high"))
        .when(slot == "test_nacl", out("WT_PERCENT", "medium"))
        .when(shared & side & phase_.isin("aqueous", "unknown") & (form != "liquid"), out("WV_PERCENT", "medium"))
        .when(shared & (form != "liquid") & sample.rlike("graft|crosslink|polymeriz|persulfate|naoh"), out("WV_PERCENT", "low"))
        .when(shared & (phase_ == "organic") & (form == "liquid"), out("VOL_PERCENT", "medium"))
        .when(side & (phase_ == "aqueous") & (form != "liquid"), out("WV_PERCENT", "medium"))
        .when(side & (phase_ == "aqueous") & (solvent_name(solvent) == "water"), out("WV_PERCENT", "low"))
        .when((phase_ == "organic") & (form == "liquid"), out("VOL_PERCENT", "medium"))
        .when((phase_ == "organic") & (form == "solid"), out("WT_PERCENT", "low"))
        .otherwise(out("PERCENT_UNKNOWN", "low"))
    )


def density(explicit: Column, slot: Column, phase_: Column, solvent: Column, standard: Column, original: Column) -> Column:
    """struct(solution, solute, source, assumed): an explicit density, else water's, else the organic solvent's, else none."""
    return density_of_keys(explicit, slot, phase_, solvent_name(solvent), norm_key(standard), norm_key(original), solvent_name(standard), solvent_name(original))


def density_of_keys(explicit: Column, slot: Column, phase_: Column, liquid: Column, s: Column, o: Column, s_solvent: Column, o_solvent: Column) -> Column:
    """density of keys that are normalised already, with the solvents they name."""
    named = F.coalesce(F.nullif(s_solvent, F.lit("")), F.nullif(o_solvent, F.lit("")))
    solute = F.coalesce(lookup(s, fixed.SOLUTE_DENSITY), lookup(o, fixed.SOLUTE_DENSITY), lookup(named, fixed.SOLVENT_DENSITY))
    usable = explicit.isNotNull() & (explicit > 0) & (explicit <= 5)
    of_solvent = F.when(phase_ == "organic", lookup(F.nullif(liquid, F.lit("")), fixed.SOLVENT_DENSITY))
    out = lambda rho, source, assumed: F.struct(rho.cast("double").alias("solution"), solute.cast("double").alias("solute"), source.alias("source"), assumed.alias("assumed"))
    return (
        F.when(usable, out(explicit, F.lit("ROW_COLUMN"), F.lit(False)))
        .when((phase_ == "aqueous") | (slot == "test_nacl"), out(F.lit(1.0), F.lit("ASSUMED_AQUEOUS_RHO_1.0"), F.lit(True)))
        .when(of_solvent.isNotNull(), out(of_solvent, F.concat(F.lit("SOLVENT_DICT::"), liquid), F.lit(True)))
        .otherwise(out(F.lit(None), F.lit("NO_RELIABLE_SOLUTION_DENSITY"), solute.isNotNull()))
    )


def with_unit_names(rows: DataFrame, unit: str) -> DataFrame:
    """`rows` with unit_family and canonical_unit. Each distinct spelling is normalised once and joined back: units are few,
    and the ladder of `normalize_unit` must not be written out wherever a later expression reads its result."""
    known = rows.select(F.col(unit).alias("__unit")).distinct().withColumn("__u", normalize_unit(F.col("__unit")))
    joined = rows.join(known, F.col(unit).eqNullSafe(F.col("__unit")), "left")
    return joined.withColumns({"unit_family": F.col("__u.family"), "canonical_unit": F.col("__u.unit")}).drop("__unit", "__u")


#: Units of a mass concentration that make one weight percent at density 1.
MASS_DIVISOR = {"g/L": 10.0, "mg/L": 1e4, "ug/L": 1e7, "ng/L": 1e10, "mg/mL": 10.0, "ug/mL": 1e4}


def weight_percent(value: Column, family: Column, unit: Column, percent: Column, phase_: Column, slot: Column, mw: Column, rho: Column, rho_solute: Column, assumed: Column) -> Column:
    """struct(wt, status, formula) of a parsed value; `family` and `unit` are plain
    columns of what normalize_unit gives (see with_unit_names), `percent` the type of a bare percent."""
    bare = family == "percent_ambiguous"
    fam = F.when(bare, lookup(percent, {"WT_PERCENT": "mass_fraction", "WV_PERCENT": "mass_volume_percent", "VOL_PERCENT": "volume_fraction"})).otherwise(family)
    u = F.when(bare, lookup(percent, {"WT_PERCENT": "wt%", "WV_PERCENT": "w/v%", "VOL_PERCENT": "v/v%"})).otherwise(unit)
    wet = (phase_ == "aqueous") | (slot == "test_nacl")
    by_density = F.when(assumed, "ASSUMED_CONVERTED").otherwise("SAFE_CONVERTED")

    def out(wt: Column | None, status: Column | str, formula: str) -> Column:
        number = F.lit(None).cast("double") if wt is None else F.round(wt, 6)
        return F.struct(number.alias("wt"), (F.lit(status) if isinstance(status, str) else status).alias("status"), F.lit(formula).alias("formula"))

    divisor = lookup(u, MASS_DIVISOR)
    moles = F.when(u.isin("M", "mol/L"), value).otherwise(value / 1000.0)
    volume = F.when(u == "mL/L", value / 10.0).otherwise(value)
    return (
        F.when(value.isNull(), out(None, "FAILED_PARSE", "PARSE_FAIL"))
        .when(fam.isNull(), out(None, "NEED_TRACEBACK", "AMBIGUOUS_PERCENT"))
        .when((fam == "mass_fraction") & ~bare, out(value, "DIRECT_WT", "DIRECT_WT"))
        .when(fam == "mass_fraction", out(value, "ASSUMED_CONVERTED", "PERCENT_TO_WT"))
        .when(u.isin("ppm") & wet, out(value / 1e4, "ASSUMED_CONVERTED", "PPM_TO_WT"))
        .when(u == "ppm", out(None, "CANNOT_CONVERT", "PPM_BLOCKED"))
        .when(u.isin("ppb") & wet, out(value / 1e7, "ASSUMED_CONVERTED", "PPB_TO_WT"))
        .when(u == "ppb", out(None, "CANNOT_CONVERT", "PPB_BLOCKED"))
        .when(u == "g/kg", out(value / 10.0, "SAFE_CONVERTED", "G_PER_KG_TO_WT"))
        .when(u == "mg/kg", out(value / 1e4, "SAFE_CONVERTED", "MG_PER_KG_TO_WT"))
        .when((fam == "mass_concentration") & rho.isNull(), out(None, "NEED_TRACEBACK", "MASS_CONC_NEEDS_RHO"))
        .when((fam == "mass_concentration") & (u == "g/mL"), out(value * 100.0 / rho, by_density, "MASS_CONC_TO_WT"))
        .when(fam == "mass_concentration", out(value / (divisor * rho), by_density, "MASS_CONC_TO_WT"))
        .when((fam == "mass_volume_percent") & rho.isNull(), out(None, "NEED_TRACEBACK", "WV_NEEDS_RHO"))
        .when(fam == "mass_volume_percent", out(value / rho, by_density, "WV_TO_WT"))
        .when((fam == "molarity") & mw.isNull(), out(None, "NEED_TRACEBACK", "MOLARITY_NEEDS_MW"))
        .when((fam == "molarity") & rho.isNull(), out(None, "NEED_TRACEBACK", "MOLARITY_NEEDS_RHO"))
        .when(fam == "molarity", out(moles * mw / (rho * 10.0), by_density, "MOLARITY_TO_WT"))
        .when((fam == "volume_fraction") & rho_solute.isNull(), out(None, "NEED_TRACEBACK", "VV_NEEDS_RHO_SOLUTE"))
        .when((fam == "volume_fraction") & rho.isNull(), out(None, "NEED_TRACEBACK", "VV_NEEDS_RHO_SOLUTION"))
        .when(fam == "volume_fraction", out(volume * rho_solute / rho, by_density, "VV_TO_WT"))
        .otherwise(out(None, "CANNOT_CONVERT", "UNSUPPORTED_UNIT"))
    )


def remap_status(status: Column, path: Column) -> Column:
    """A success by the way its unit was understood (RULE, LLM_REPAIR, LLM_FORMULA); failures stay."""
    won = status.isin(fixed.SUCCESS)
    return (
        F.when(~won, status)
        .when((path == "RULE") & status.isin("DIRECT_WT", "SAFE_CONVERTED", "ASSUMED_CONVERTED"), "RULE_NORMALIZED_CONVERTED")
        .when(path == "LLM_REPAIR", "LLM_UNIT_REPAIRED_CONVERTED")
        .when(path == "LLM_FORMULA", "LLM_FORMULA_CONVERTED")
        .otherwise(status)
    )
