"""Abbreviations: mined pairs, lexicon with evidence, merged alias dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import predicates, text

BOUND = r"^\s*(.+?)\s*[(（]\s*([A-Za-z][A-Za-z0-9\-]{1,20})\s*[)）]\s*$"
BOUND_REVERSE = r"^\s*([A-Za-z][A-Za-z0-9\-]{1,20})\s*[(（]\s*(.+?)\s*[)）]\s*$"
PAIR = r"^(.*?)\s*\(([A-Za-z0-9\-]{2,10})\)\s*$"

# ---- fixed values: seed dictionary (alias, canonical name, category) ----
SEED = [
    ("MPD", "m-phenylenediamine", "monomer"), ("PIP", "piperazine", "monomer"), ("PEI", "polyethyleneimine", "monomer"), ("EDA", "ethane-1,2-diamine", "monomer"),
    ("TMC", "benzene-1,3,5-tricarbonyl trichloride", "monomer"), ("TPC", "terephthaloyl chloride", "monomer"), ("PSF", "polysulfone", "substrate"),
    ("PES", "polyethersulfone", "substrate"), ("PAN", "polyacrylonitrile", "substrate"), ("PVDF", "poly(vinylidene fluoride)", "substrate"),
    ("CA", "cellulose acetate", "substrate"), ("CTA", "cellulose triacetate", "substrate"), ("PA", "polyamide", "polymer"), ("PEG", "polyethylene glycol", "additive"),
    ("PVP", "polyvinylpyrrolidone", "additive"), ("SDS", "sodium dodecyl sulfate", "additive"), ("TEA", "triethylamine", "additive"),
    ("DMAc", "N,N-dimethylacetamide", "solvent"), ("DMF", "N,N-dimethylformamide", "solvent"), ("DMSO", "dimethyl sulfoxide", "solvent"),
    ("NMP", "1-methyl-2-pyrrolidinone", "solvent"),
]
# ---- fixed values: abbreviations known without evidence ----
KNOWN = {
    "DA": "dopamine", "CYS": "cysteamine", "CA": "cystamine dihydrochloride", "EDA": "ethylenediamine", "ETOH": "ethanol", "DMSO": "dimethyl sulfoxide",
    "DMF": "dimethylformamide", "DMA": "dimethylacetamide", "DMAC": "dimethylacetamide", "DMC": "dimethyl carbonate", "DEG": "diethylene glycol",
    "MEK": "methyl ethyl ketone", "DADMAC": "diallyldimethylammonium chloride", "DANC": "dialdehyde nanocellulose", "CDA": "cellulose diacetate", "PEI": "polyethylenimine",
}


def category(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.contains("poly"), "polymer")
        .when(low.rlike("chloride|diamine|amine|acid|acyl|anhydride"), "monomer")
        .when(low.rlike("sulfone|vinylidene fluoride|acrylonitrile|cellulose"), "substrate")
        .when(low.rlike("glycol|surfactant|triethylamine"), "additive")
        .otherwise("other")
    )


def full_name(c: Column) -> Column:
    """Without context words and edges."""
    t = F.regexp_replace(text.norm_text_doc(c), r"(?i)\b(aqueous solution|solution|suspension|dispersion|membrane|substrate)\b", "")
    return text.edge(F.regexp_replace(t, r"\s+", " "))


def mined_pairs(names: DataFrame, name: str) -> DataFrame:
    """(alias, canonical_name, frequency, examples): 'full name (ABBR)' pairs; three examples, the smallest by row."""
    t = text.norm_text_doc(F.col(name))
    pairs = names.select("row", t.alias("t"), F.regexp_extract(t, PAIR, 2).alias("alias"), full_name(F.regexp_extract(t, PAIR, 1)).alias("canonical_name"))
    kept = pairs.filter(predicates.looks_like_alias(F.col("alias")) & (F.length("canonical_name") >= 4))
    return kept.groupBy("alias", "canonical_name").agg(F.count("*").alias("frequency"), F.min_by("t", "row").alias("example"))


def best_pairs(mined: DataFrame) -> DataFrame:
    """The most frequent full name of each alias, ties to the smaller name."""
    ordered = mined.groupBy("alias").agg(F.min_by(F.struct("canonical_name", "frequency"), F.struct(-F.col("frequency"), F.col("canonical_name"))).alias("x"))
    return ordered.select("alias", "x.canonical_name", "x.frequency")


def frequent_tokens(names: DataFrame, name: str, least: int = 3) -> DataFrame:
    """(alias, frequency) of abbreviation tokens that occur often enough."""
    found = F.regexp_extract_all(text.norm_text_doc(F.col(name)), F.lit(r"(\b[A-Za-z][A-Za-z0-9\-]{1,9}\b)"), 1)
    tokens = names.select(F.explode(F.filter(found, lambda x: predicates.looks_like_alias(x))).alias("alias"))
    return tokens.groupBy("alias").agg(F.count("*").alias("frequency")).filter(F.col("frequency") >= least)


def alias_dictionary(names: DataFrame, name: str, seed: DataFrame) -> DataFrame:
    """One line per alias: seed before mined before frequent. `seed` has alias, canonical_name, category."""
    mined = best_pairs(mined_pairs(names, name)).select("alias", "canonical_name", category(F.col("canonical_name")).alias("category"), F.lit("auto_mined").alias("source"), "frequency")
    often = frequent_tokens(names, name).join(mined, "alias", "left_anti").join(seed, "alias", "left_anti")
    often = often.select("alias", F.lit("").alias("canonical_name"), F.lit("unknown").alias("category"), F.lit("high_freq_abbr").alias("source"), "frequency")
    seeds = seed.select("alias", "canonical_name", "category", F.lit("seed_manual").alias("source"), F.lit(0).cast("long").alias("frequency"))
    priority = F.when(F.col("source") == "seed_manual", 0).when(F.col("source") == "auto_mined", 1).otherwise(2)
    every = seeds.unionByName(mined).unionByName(often)
    return every.groupBy("alias").agg(F.min_by(F.struct("canonical_name", "category", "source", "frequency"), F.struct(priority, -F.col("frequency"))).alias("x")).select("alias", "x.*")


def abbreviation_lexicon(names: DataFrame, name: str) -> DataFrame:
    """(abbr, fulls, evidence): bound abbreviations that are known, seen twice or bound to a chemical name; full names in order."""
    t = text.norm_text_doc(F.col(name))
    forward = F.struct(F.upper(F.regexp_extract(t, BOUND, 2)).alias("abbr"), text.norm_text_doc(F.regexp_extract(t, BOUND, 1)).alias("full"), F.lit(False).alias("reverse"))
    backward = F.struct(F.upper(F.regexp_extract(t, BOUND_REVERSE, 1)).alias("abbr"), text.norm_text_doc(F.regexp_extract(t, BOUND_REVERSE, 2)).alias("full"), F.lit(True).alias("reverse"))
    bound = names.select(F.explode(F.array(forward, backward)).alias("x")).select("x.*")
    valid = bound.filter(predicates.is_valid_abbreviation(F.col("abbr")) & predicates.is_valid_full_name(F.col("full")) & ~(F.col("reverse") & (F.upper("full") == F.col("abbr"))))
    grouped = valid.groupBy("abbr").agg(F.array_join(F.array_sort(F.collect_set("full")), "|").alias("fulls"), F.count("*").alias("evidence"), F.bool_or(predicates.has_chemistry_word(F.col("full"))).alias("hinted"))
    return grouped.filter(F.col("abbr").isin(*KNOWN) | (F.col("evidence") >= 2) | F.col("hinted")).select("abbr", "fulls", "evidence")


def first_expansion(names: DataFrame, name: str) -> DataFrame:
    """(abbr, full): the first full name bound to each abbreviation, in row order."""
    t = text.unify_ascii(F.col(name))
    bound = r"^(.*\S)\s*\(([A-Za-z][A-Za-z0-9+\-]{1,20})\)\s*$"
    pairs = names.select("row", F.regexp_extract(t, bound, 2).alias("abbr"), text.strip_concentration(F.regexp_extract(t, bound, 1)).alias("full")).filter("abbr <> '' and length(full) >= 4")
    kept = pairs.filter(~(predicates.is_process_text(F.col("full")) & (predicates.chemical_likeness(F.col("full")) < 0.4)))
    return kept.groupBy("abbr").agg(F.min_by("full", "row").alias("full"))
