"""Rules of the first versions on cells whose results were worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import cleaning


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "rule, cells",
    [
        (cleaning.strip_stereo, {"(+)-camphor-10-sulfonic acid": "camphor-10-sulfonic acid", "(-)-rac-menthol": "menthol", "d-xyl": "d-xyl", " DL-alanine ": "alanine", None: ""}),
        (cleaning.without_amounts, {"2.5% chitosan solution": "chitosan", "10 mg GO (graphene oxide) dispersion": "graphene oxide", "Nafion™ 117": "Nafion 117", "PVA（聚乙烯醇）": "PVA", "water (aq)": "water", None: None}),
        (cleaning.main_component, {"GO@TiO2": "GO", "PVA/PEG blend": "PVA", "PEBAX-1657A": "PEBAX", "Kapton 300": "Kapton", "porous SiO2 nanoparticles": "SiO2", None: None}),
        (cleaning.is_process_condition, {"Drying at 20°C": True, "post-treatment": True, "piperazine": False, " ": True, None: True}),
        (cleaning.is_too_general, {"gold": True, "gold film": True, "TMC": False, "tmc": True, "zeta-potential": True, "some resin": True, "m-phenylenediamine": False, "the gold film": False, None: True}),
        (cleaning.membrane_type, {"polyamide ro membrane; NF; nf": "RO; NF", "profile": "profile", " ": None, "a  b": "a  b", None: None}),
        (cleaning.membrane_type_by_map, {"microfiltration": "RO", "profile": "RO", "Forward Osmosis": "FO", " ": " ", "a  b": "a b", None: None}),
    ],
)
def test_cells(spark, rule, cells):
    assert values(spark, rule(F.col("x")), list(cells)) == list(cells.values())


def test_six_digits(spark):
    rows = [0.000123456789, 1234567.8, 5.0, 1e-5, -0.25, 999999.7, 0.0, 1e20, None, float("nan"), float("inf")]
    assert values(spark, cleaning.format_six(F.col("x")), rows, "double") == ["0.000123457", "1.23457e+06", "5", "1e-05", "-0.25", "1e+06", "0", "100000000000000000000", None, None, None]


def test_texts_phase_and_form(spark):
    assert values(spark, cleaning.join_texts(F.col("x")), [[" a  b", "", None, "c"], [], None], "array<string>") == ["a b;c", "", ""]
    phase = cleaning.phase_of_slot(F.lit("additive"), F.lit(""), F.lit("hexane"), F.col("x"))
    assert [tuple(p) for p in values(spark, phase, ["in Water", "dry", None])] == [("aqueous", "row_context", "water"), ("organic", "row_context", "hexane"), ("organic", "row_context", "hexane")]
    form = cleaning.form_of_solute(F.col("x"), F.lit("additive"))
    assert [p[0] for p in values(spark, form, ["n-Hexane", "NaCl", "copper nitrate", "fatty alcohol", "resin", None])] == ["liquid", "solid", "solid", "liquid", "unknown", "unknown"]


def test_evidence_lines(spark):
    text = "a\nb\nKEY one\nc\nd\ne\nkey"
    got = values(spark, cleaning.evidence_lines(F.col("x"), ["Key"], around=1), [text, "", None])
    assert got == [["b\nKEY one\nc", "e\nkey"], [], []]
