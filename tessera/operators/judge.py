"""The rule judge of concentration slots: rules are a table, with conditions, a priority and what they decide.

A rule fits where each of its conditions that is not null does; of those that fit, the first counts. Rules are met by the few
distinct combinations of state, unit, slot and phase, and the decisions are joined back to the slots by equality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import norm_text

WATERY = "assumed_water_like_density_1.0_g_per_mL"
SCHEMA = (
    "priority int, state string, unit string, slots array<string>, wet boolean, parse_status string, percent_type string, status string, divisor double, method string, "
    "targets array<string>, needs_density boolean, needs_weight boolean, density_source string, review_flag int, confidence string, reason string"
)


def rule(state="OK", unit=None, slots=None, wet=None, parse="OK", percent="", status="", divisor=None, method="", targets=(), density=False, weight=False, source="", review=2, confidence="LOW", reason=""):
    return (state, unit, slots, wet, parse, percent, status, divisor, method, list(targets), density, weight, source, review, confidence, reason)


MOLAR = dict(percent="NOT_PERCENT_UNIT", status="NEED_TRACEBACK", density=True, weight=True, reason="molar concentration needs molecular weight and density for wt% conversion")
DRY = dict(wet=False, percent="NOT_PERCENT_UNIT", status="NEED_TRACEBACK")
DILUTE = dict(wet=True, percent="NOT_PERCENT_UNIT", status="ASSUMED_CONVERTED", review=1, confidence="MEDIUM")
PLAIN = dict(unit="%", percent="PERCENT_UNKNOWN", status="NEED_TRACEBACK")
# ---- fixed values: the rules in order of priority ----
RULES = [
    rule("EMPTY_ALL", parse="EMPTY_ALL", review=0, confidence="", reason="empty slot"),
    rule("EMPTY_SOLUTE", parse="EMPTY_SOLUTE", confidence="", reason="solute missing"),
    rule("EMPTY_VALUE", parse="EMPTY_VALUE", review=1, confidence="", reason="value missing"),
    rule("EMPTY_VALUE_AND_SOLUTE", parse="EMPTY_VALUE", review=0, confidence="", reason="value missing"),
    rule("EMPTY_UNIT", parse="EMPTY_UNIT", confidence="", reason="unit missing"),
    rule("MULTI_UNRESOLVED", parse="MULTI_COUNT_MISMATCH", status="FAILED_PARSE", targets=["MAPPING_RELATION"], confidence="", reason="multi-value mapping unresolved"),
    rule("UNSUPPORTED_FORMAT", parse="UNSUPPORTED_FORMAT", status="FAILED_PARSE", confidence="", reason="value is not reliably numeric"),
    rule("NON_NUMERIC_VALUE", parse="NON_NUMERIC_VALUE", status="FAILED_PARSE", confidence="", reason="value is not reliably numeric"),
    rule(unit="wt%", percent="WT_PERCENT", status="DIRECT_WT", divisor=1.0, method="direct_standardization", review=0, confidence="HIGH", reason="original unit already expresses mass fraction"),
    rule(slots=["test_nacl"], targets=["PERCENT_TYPE", "ORIGINAL_UNIT"], reason="plain percent is ambiguous without source context", **PLAIN),
    rule(slots=["aqueous_monomer", "organic_monomer"], targets=["PERCENT_TYPE"], reason="plain percent may be wt% but source confirmation is needed", **PLAIN),
    rule(targets=["PERCENT_TYPE", "PHASE_TYPE"], reason="plain percent is ambiguous", **PLAIN),
    rule(unit="ppm", divisor=10000.0, method="ppm_to_wtpercent_dilute_aqueous_approx", reason="ppm converted using dilute aqueous approximation", **DILUTE),
    rule(unit="ppm", targets=["PHASE_TYPE", "SOLVENT_TYPE"], reason="ppm conversion needs phase/solution context", **DRY),
    rule(unit="g/L", divisor=10.0, method="g_per_L_to_wtpercent_rho1_approx", density=True, source=WATERY, reason="g/L converted assuming density≈1 g/mL", **DILUTE),
    rule(unit="g/L", targets=["PHASE_TYPE", "DENSITY", "SOLVENT_TYPE"], reason="g/L conversion requires density and phase context", **DRY),
    rule(unit="mg/L", divisor=10000.0, method="mg_per_L_to_wtpercent_rho1_approx", density=True, source=WATERY, reason="mg/L converted assuming density≈1 g/mL", **DILUTE),
    rule(unit="mg/L", targets=["PHASE_TYPE", "DENSITY", "SOLVENT_TYPE"], reason="mg/L conversion requires density and phase context", **DRY),
    *[rule(unit=u, slots=["additive", "modifier"], targets=["MOLECULAR_WEIGHT", "DENSITY", "SOLUTE_IDENTITY"], **MOLAR) for u in ("M", "mM", "mol/L")],
    *[rule(unit=u, targets=["MOLECULAR_WEIGHT", "DENSITY"], **MOLAR) for u in ("M", "mM", "mol/L")],
    rule(unit="v/v%", percent="VOL_PERCENT", status="CANNOT_CONVERT", density=True, reason="v/v% cannot be safely converted without density and formulation details"),
    rule(unit="w/v%", wet=True, percent="WV_PERCENT", status="ASSUMED_CONVERTED", divisor=1.0, method="wv_percent_to_wtpercent_rho1_approx", density=True, source=WATERY, review=1, confidence="MEDIUM", reason="w/v% approximated as wt% under rho≈1 g/mL"),
    rule(unit="w/v%", wet=False, percent="WV_PERCENT", status="NEED_TRACEBACK", targets=["DENSITY", "PHASE_TYPE", "SOLVENT_TYPE"], reason="w/v% conversion requires density and solution context"),
    rule(percent="NOT_PERCENT_UNIT", status="CANNOT_CONVERT", targets=["ORIGINAL_UNIT"], reason="unit is unsupported or requires source-specific interpretation"),
]
DECIDED = ["parse_status", "percent_type", "status", "method", "targets", "needs_density", "needs_weight", "density_source", "review_flag", "confidence", "reason"]


def rules(spark, table: list[tuple] = RULES) -> DataFrame:
    """The rule table: one row a rule, its place its priority."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(table)], SCHEMA)


def judge(slots: DataFrame, keys: list[str], table: DataFrame | None = None) -> DataFrame:
    """`keys`, wt, need_traceback and the columns of DECIDED for `slots` (slot, solute, value, unit, mapping, number, canonical_unit, phase).

    `number` is what the value parses to, `canonical_unit` the unit in one spelling; null cells are blank."""
    blank = lambda c: norm_text(F.col(c)) == ""
    odd = F.lower(norm_text(F.col("value"))).rlike(r"[:/]|trace|few|excess|small amount|saturated")
    state = (
        F.when(blank("solute") & blank("value") & blank("unit"), "EMPTY_ALL")
        .when((F.col("slot") != "test_nacl") & blank("solute"), "EMPTY_SOLUTE")
        .when(blank("value"), F.when(blank("solute"), "EMPTY_VALUE_AND_SOLUTE").otherwise("EMPTY_VALUE"))
        .when(blank("unit"), "EMPTY_UNIT")
        .when(F.col("mapping") == "MULTI_UNRESOLVED", "MULTI_UNRESOLVED")
        .when(F.col("number").isNull(), F.when(odd, "UNSUPPORTED_FORMAT").otherwise("NON_NUMERIC_VALUE"))
        .otherwise("OK")
    )
    wet = F.coalesce(F.col("phase").isin("aqueous", "test_aqueous"), F.lit(False))
    told = slots.select(*keys, "number", state.alias("s"), F.coalesce("canonical_unit", F.lit("")).alias("u"), F.coalesce("slot", F.lit("")).alias("p"), wet.alias("w"))
    kinds = told.select("s", "u", "p", "w").distinct()
    r = table if table is not None else rules(slots.sparkSession)
    fits = (F.col("s") == F.col("state")) & (F.col("unit").isNull() | (F.col("unit") == F.col("u"))) & (F.col("slots").isNull() | F.array_contains("slots", F.col("p"))) & (F.col("wet").isNull() | (F.col("wet") == F.col("w")))
    first = kinds.join(r, fits).groupBy("s", "u", "p", "w").agg(F.min_by(F.struct("divisor", *DECIDED), "priority").alias("x"))
    out = told.join(first, ["s", "u", "p", "w"])
    return out.select(*keys, (F.col("number") / F.col("x.divisor")).alias("wt"), (F.size("x.targets") > 0).alias("need_traceback"), *[f"x.{c}" for c in DECIDED]).withColumn("need_traceback", F.col("need_traceback") | (F.col("status") == "NEED_TRACEBACK"))
