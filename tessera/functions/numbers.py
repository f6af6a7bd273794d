"""Numbers in cells: scientific notation, ranges, first numbers, number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.predicates import is_date_junk, is_four_digits, is_ratio_only
from tessera.functions.text import bound, norm_text, strip_leading_quote

NUMBER = r"[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?"
RANGE = rf"^\s*({NUMBER})\s*[-~～至到–—]\s*({NUMBER})\s*$"
POWER = r"(?i)^\s*(?:([-+]?\d*\.?\d+)\s*x\s*)?10\s*\^\s*([+-]?\d+)\s*$"


def scientific(c: Column) -> Column:
    """The value of 10^-2 or 1×10^-2, else null."""
    def power(t: Column) -> Column:
        factor = F.when(F.regexp_extract(t, POWER, 1) == "", F.lit(1.0)).otherwise(F.regexp_extract(t, POWER, 1).try_cast("double"))
        return F.when(t.rlike(POWER), factor * F.pow(F.lit(10.0), F.regexp_extract(t, POWER, 2).try_cast("double")))

    return bound(F.translate(F.regexp_replace(strip_leading_quote(c), "[−–—⁻]", "-"), "×X", "xx"), power)


def range_midpoint(c: Column) -> Column:
    """The middle of a range such as 1-5 or 2000~4000; null for dates, ratios and all else."""
    def middle(t: Column) -> Column:
        low, high = (F.regexp_extract(t, RANGE, i).try_cast("double") for i in (1, 2))
        return F.when(t.rlike(RANGE) & ~is_date_junk(t) & ~is_ratio_only(t), (low + high) / 2.0)

    return bound(F.regexp_replace(strip_leading_quote(c), ",", ""), middle)


def parse_number(c: Column) -> Column:
    """The first number of the text; null for ranges, ratios and texts without one."""
    def first(t: Column) -> Column:
        several = t.rlike(r"(?<![eE])[~～至到]|(?<![eE])\s*[-–—]\s*") & (F.size(F.regexp_extract_all(t, F.lit(f"({NUMBER})"), 1)) > 1)
        plain = F.when(~several & ~is_ratio_only(t), F.nullif(F.regexp_extract(t, f"({NUMBER})", 1), F.lit("")).try_cast("double"))
        return F.coalesce(scientific(t), plain)

    return bound(F.regexp_replace(strip_leading_quote(c), ",", ""), first)


def parse_single(c: Column) -> Column:
    """The number if the text is one and nothing else."""
    t = F.trim(F.regexp_replace(norm_text(c), ",", ""))
    return F.when(t.rlike(f"^{NUMBER}$"), t.try_cast("double"))


def value_cell(c: Column, unit: Column) -> Column:
    """struct(value, blocked, ratio, force, kind): what a value cell says before conversion.

    The first of date, ratio, range and scientific notation that applies decides; four digits without a unit are suspect."""
    def cell(v: Column, x: Column) -> Column:
        kind = F.when(v == "", "empty").when(x["date"], "date").when(x["ratio"], "ratio").when(x["middle"].isNotNull(), "range").when(x["power"].isNotNull(), "scientific").otherwise("plain")
        number = F.when(x["date"] | x["ratio"], None).otherwise(F.coalesce(x["middle"], x["power"], parse_number(v)))
        suspect = is_four_digits(v) & (norm_text(unit) == "")
        return F.struct(number.alias("value"), x["date"].alias("blocked"), x["ratio"].alias("ratio"), (x["date"] | x["ratio"] | suspect).alias("force"), kind.alias("kind"))

    seen = lambda v: F.struct(is_date_junk(v).alias("date"), is_ratio_only(v).alias("ratio"), range_midpoint(v).alias("middle"), scientific(v).alias("power"))
    return bound(strip_leading_quote(c), lambda v: bound(seen(v), lambda x: cell(v, x)))


def format_g(x: Column, digits: int = 6) -> Column:
    """A number as %g writes it (six significant digits, no zeros at the end), after rounding to `digits` places; null gives ''."""
    tidy = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    scale = lambda size, e: F.round(size / F.pow(F.lit(10.0), e.cast("double")), 5)

    def shown(v: Column, size: Column, exponent: Column, scaled: Column) -> Column:
        # six significant digits may round up to the next power of ten
        up = scaled >= 10
        return bound(F.when(up, exponent + 1).otherwise(exponent), lambda e: written(v, size, e, F.when(up, scaled / 10).otherwise(scaled)))

    def written(v: Column, size: Column, exponent: Column, scaled: Column) -> Column:
        small = tidy(F.format_string("%.10f", F.round(size, 10)))
        places = F.pow(F.lit(10.0), F.greatest(F.lit(0), F.lit(5) - exponent).cast("double"))
        fixed_text = F.when(exponent >= 0, bound(places, lambda p: tidy(F.format_string("%.5f", F.round(size * p) / p)))).otherwise(small)
        power = F.concat(tidy(F.format_string("%.5f", scaled)), F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0"))
        return F.concat(F.when(v < 0, "-").otherwise(""), F.when((exponent < -4) | (exponent >= 6), power).otherwise(fixed_text))

    first = lambda size: F.when(size == 0, F.lit(0)).otherwise(F.floor(F.log10(size)).cast("int"))
    told = lambda v: bound(F.abs(v), lambda size: bound(first(size), lambda e: bound(scale(size, e), lambda s: shown(v, size, e, s))))
    return bound(F.round(x.cast("double"), digits), lambda v: F.when(v.isNull() | F.isnan(v), F.lit("")).otherwise(told(v)))


def format_fixed(x: Column, digits: int = 6) -> Column:
    """Fixed places without zeros at the end."""
    t = F.format_string(f"%.{digits}f", F.round(x.cast("double"), digits))
    return F.when(x.isNotNull(), F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def indices(c: Column) -> Column:
    """Distinct whole numbers of the text, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(norm_text(c), F.lit(r"(\d+)"), 1), lambda x: x.try_cast("long")))


def number_sanity(value: Column, family: Column, unit: Column) -> Column:
    """ok, or why a value is not credible for its unit; the first rule that applies decides."""
    molar = lambda u: (family == "molarity") | u.isin("m", "mm", "mol/l", "mmol/l")
    percent = lambda u: family.isin("mass_fraction", "mass_volume_percent", "volume_fraction") | u.isin("%", "wt%")
    verdict = lambda v, digits, u: (
        F.when(v.isNull(), "unparseable_value")
        .when(molar(u) & digits.rlike(r"^\d{5,}$"), "huge_integer_with_molarity_unit_likely_ref_id")
        .when(molar(u) & u.isin("m", "mol/l") & (F.abs(v) > 55.0), "molarity_M_out_of_sane_lab_range")
        .when(molar(u) & u.isin("mm", "mmol/l") & (F.abs(v) > 5e5), "mmolarity_out_of_range")
        .when((family == "ppm_family") & (u == "ppm") & (F.abs(v) > 1e9), "ppm_absurdly_high")
        .when(percent(u) & (F.abs(v) > 100.000001), "percent_over_100")
        .when((family == "mass_concentration") & (F.abs(v) > 1e12), "mass_conc_absurdly_high")
        .otherwise("ok")
    )
    digits = F.regexp_replace(norm_text(value), r"^[+-]+", "")
    return bound(parse_number(value), lambda v: bound(digits, lambda d: bound(F.lower(F.coalesce(unit, F.lit(""))), lambda u: verdict(v, d, u))))


SAMPLE_RATIO = r"(?i)\(([-+]?\d*\.?\d+(?:\s*[:：]\s*[-+]?\d*\.?\d+){1,5})\s*(%(?:\s*\((?:w/v|m/v|w/w|v/v|wt)\))?)\)"


def sample_ratio(sample: Column, item: Column) -> Column:
    """struct(value, unit): the item-th value of a ratio such as (0.1:0.013%) in a sample name; nulls without one."""
    values = F.split(F.regexp_extract(sample, SAMPLE_RATIO, 1), r"\s*[:：]\s*")
    value = F.when(sample.rlike(SAMPLE_RATIO), F.get(values, F.greatest(item - 1, F.lit(0)).cast("int")))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), F.regexp_extract(sample, SAMPLE_RATIO, 2)).alias("unit"))
