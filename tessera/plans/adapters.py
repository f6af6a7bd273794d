"""Deterministic adapters: the driver's tables hold no chemistry, so fixed example cells are dealt out over their rows.

Each adapter is a DataFrame and the same rows as SQL text, written side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- example cells ----
NAMES = [
    "m-phenylenediamine (MPD)", "TMC", " trimesoyl  chloride ", "Graphene oxide", "0.5 wt% NaCl solution", "SW30HR-380", "poly(vinyl alcohol) membrane", "SiO2 nanoparticles",
    "DMF/NMP", "ethanol and water", "1,3,5-benzenetricarbonyl trichloride", "Sulphuric acid", "plasma treatment for 30 min", "25 °C", "2000 ppm", "CuSO4.5H2O", "-OH", "12.5",
    "---", "n/a", "HNT-COOH", "ZIF-8", "PEI", "Polyethylenimine (PEI)", "PVA (polyvinyl alcohol)", "the m-phenylenediamine", "was dissolved in water", "sample #3", "water phase",
    "TiO2-NPs", "methane", "Aluminium fibre", "BW30", "cellulose acetate blend", "水相单体", "MPD（间苯二胺）", "piperazine； TMC", "A", "", "acid, strong", "Dow FilmTec", "MCM-41",
    "[a;b] c; d", "camphorsulfonic acid (water)", "commercial series membrane", "N,N-dimethylformamide", "isopropanol (aqueous phase)", "Cl-", "chitosan", "aqueous MPD solution 2 wt% fresh",
]
VALUES = [
    "0.5", "2000-4000", "1:10", "10^-2", "1×10^-3", "'3.4", "1072", "3 月 5 日", "0.1 wt%", "", "abc", "1,500", "2 and 3", "5e-3", "-4", "12 to 13", "0.25~0.75", "1.5 M", "99.9%",
    "March 2020", "120", "3.0", "0.000012", "1234567", "60000", "7;8", "2.5E2", "+6", "55.6", "1–2",
]
UNITS = [
    "wt%", "%", "g/L", "mg.L-1", "M", "mM", "mol L-1", "v/v%", "ppm", "w/v.%", "g L?1", "% (w/v)", "vol%", "mL/L", "mg/mL", "μg/mL", "ppb", "g/kg", "mg/kg", "drops", "", "molar ratio",
    "wt/vol%", "% (aqueous)", "w/v% of acetone", "g/100mL", "1:2", "mmol/L", "ng/L", "％", "mass fraction", "DP", "furlongs",
]
CELLS = [
    "MPD; TMC", "MPD；PIP ;; SDS", "", "TMC", "a; b; c; d", "poly(a;b); c | d", "NaCl", "n/a; x", "X; x ;X", " ; ", "[p;q]; r｜s", "ethanol; water", "TEA,CSA", "{k;l};m", "(open; paren",
]
DOIS = ["https://doi.org/10.1016/j.memsci.2020.118", "10.1021/ACS.EST.9b01", "doi: 10.1002/app.123.", "", "paper-12.md", "Nano Membranes (2019).pdf", "http://dx.doi.org/10.1039/C5TA"]
SAMPLES = ["(0.1:0.013%) N-IPAAm/MBAAm", "PA-TFC (1:2:3 % (w/v))", "plain", "", "M1 (0.5:1%)", "(2：4%) blend", "graft 5%"]


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], n: Column) -> Column:
    """The element of a fixed list that a whole number chooses."""
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def sql_pick(values: list[str], n: str) -> str:
    return f"({sql_list(values)})[({n}) % {len(values)} + 1]"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each part: id, name, other, value, unit, cell, cell2, doi, sample, item, status."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    return p.select(
        k.alias("id"),
        F.when(k % 7 == 0, F.col("p_name")).otherwise(pick(NAMES, k)).alias("name"),
        pick(NAMES, k * 3 + 1).alias("other"),
        pick(VALUES, k).alias("value"),
        pick(UNITS, k * 5 + 2).alias("unit"),
        pick(CELLS, k).alias("cell"),
        pick(VALUES, k * 7).alias("value2"),
        F.concat(pick(VALUES, k), F.lit("; "), pick(VALUES, k * 3 + 4)).alias("values"),
        F.concat(pick(UNITS, k), F.when(k % 3 == 0, F.concat(F.lit(";"), pick(UNITS, k + 1))).otherwise(F.lit(""))).alias("units"),
        pick(DOIS, k).alias("doi"),
        pick(SAMPLES, k).alias("sample"),
        (k % 4 + 1).cast("int").alias("item"),
        pick(["aqueous_monomer", "organic_monomer", "additive", "modifier", "test_nacl"], k).alias("slot"),
        pick(["NO_HIT", "OK", "NO_SPECIFIC_CHEMICAL", "CID_ONLY", "Polymer"], k * 2).alias("status"),
    )


CELLS_SQL = f"""cells AS (SELECT p_partkey AS id,
  CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE {sql_pick(NAMES, 'p_partkey')} END AS name,
  {sql_pick(NAMES, 'p_partkey * 3 + 1')} AS other,
  {sql_pick(VALUES, 'p_partkey')} AS "value",
  {sql_pick(UNITS, 'p_partkey * 5 + 2')} AS unit,
  {sql_pick(CELLS, 'p_partkey')} AS cell,
  {sql_pick(VALUES, 'p_partkey * 7')} AS value2,
  {sql_pick(VALUES, 'p_partkey')} || '; ' || {sql_pick(VALUES, 'p_partkey * 3 + 4')} AS "values",
  {sql_pick(UNITS, 'p_partkey')} || CASE WHEN p_partkey % 3 = 0 THEN ';' || {sql_pick(UNITS, 'p_partkey + 1')} ELSE '' END AS units,
  {sql_pick(DOIS, 'p_partkey')} AS doi,
  {sql_pick(SAMPLES, 'p_partkey')} AS sample,
  CAST(p_partkey % 4 + 1 AS INTEGER) AS item,
  {sql_pick(['aqueous_monomer', 'organic_monomer', 'additive', 'modifier', 'test_nacl'], 'p_partkey')} AS slot,
  {sql_pick(['NO_HIT', 'OK', 'NO_SPECIFIC_CHEMICAL', 'CID_ONLY', 'Polymer'], 'p_partkey * 2')} AS status
  FROM part)"""
