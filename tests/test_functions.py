"""Example cells with known results."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays, numbers, predicates, text, units


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (text.norm_text, {" a　b ％ μL": "a b % uL", None: "", "": ""}),
        (text.clean_key, {"https://doi.org/10.1016/J.X": "101016j", "Paper-12.md": "paper12", None: ""}),
        (text.core_name, {"TMC solution": "TMC", "PIP (0.2 wt%)": "PIP", "cross-linked PVA membrane": "PVA", "NaCl buffer (2000 ppm)": "NaCl", None: ""}),
        (text.cleanup_candidate, {"the MPD,": "MPD", "followed by  piperazine": "piperazine", None: ""}),
        (numbers.parse_number, {"0.5": 0.5, "10^-2": 0.01, "1×10^-3": 0.001, "1-5": None, "1:10": None, "1,500 mg": 1500.0, "": None, None: None, "-4": -4.0}),
        (numbers.range_midpoint, {"2000-4000": 3000.0, "0.25~0.75": 0.5, "5": None, "1:2": None, None: None}),
        (units.repair_unit, {"mg.L-1": "mg/L", "g L?1": "g/L", "w/v% of acetone": "w/v%", "% (aqueous)": "%", None: ""}),
        (predicates.is_short_abbreviation, {"TMC": True, "Mpd": False, "trimesoyl": False, "": False, None: False}),
        (predicates.skip_class, {"plasma treatment": "PROCESS_CONDITION", "SW30HR-380": "BRAND_OR_PRODUCT", "2000 ppm": "MEASUREMENT", "a/b": "MULTI_COMPONENT", "TMC": None, "": "EMPTY"}),
        (arrays.split_multi, {"MPD；PIP ;; SDS": ["MPD", "PIP", "SDS"], "": [], None: []}),
        (arrays.split_components, {"poly(a;b); c | d": ["poly(a;b)", "c", "d"], "X; x ;X": ["X"], "n/a": [], None: []}),
    ],
)
def test_cells(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_format_g_is_percent_g(spark):
    numbers_in = [0.1, 1e-5, 1234567.0, 100000.0, 0.0, -2.5, 123.456789, 999999.5, 0.000123456, 60000.0, 3.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers_in)], "i int, x double")
    got = [r["y"] for r in df.select("i", numbers.format_g(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [f"{round(x, 6):g}" for x in numbers_in]


def test_units(spark):
    cases = {"wt%": ("wt%", "mass_fraction"), "g/L": ("g/L", "mass_concentration"), "M": ("M", "molarity"), "m": ("m", "unsupported"), "%": ("%", "percent_ambiguous"), "g/100mL": ("g/100mL", "mass_volume_percent"), "": ("", "unsupported"), "v/v": ("v/v%", "volume_fraction"), "ppm": ("ppm", "ppm_family"), None: ("", "unsupported")}
    got = values(spark, units.normalize_unit, list(cases))
    assert [(r["unit"], r["family"]) for r in got] == list(cases.values())


def test_sentence_windows(spark):
    got = values(spark, lambda c: text.sentence_windows(c, F.lit("MPD")), ["One. The mpd is two. Three. Four.", "no hit", None, "MPDX."])
    assert got == [["One. The mpd is two. Three."], [], [], []]


def test_span_windows(spark):
    got = values(spark, lambda c: text.span_windows(c, F.lit("ab"), radius=3), ["xx ab yyyy ab", "none", None])
    assert got == [["xx ab yy", "yy ab"], [], []]
