"""Label cleaning, ordered label → code rules, composite labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIFECYCLE = r"(?i)\s*-\s*(Start|End)\s+Q\d+\s+\d{4}\s*$"


def snake_case(col: Column) -> Column:
    """``Total (GWh)`` → ``total_gwh``."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(col)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def squeeze(col: Column) -> Column:
    """Trim and collapse runs of whitespace; NULL becomes an empty label."""
    return F.coalesce(F.regexp_replace(F.trim(col.cast("string")), r"\s+", " "), F.lit(""))


def normalised(col: Column) -> Column:
    """Lower-case, trimmed text."""
    return F.lower(F.trim(col))


def strip_lifecycle(col: Column) -> Column:
    """Drop a trailing ``- Start Q1 2020`` / ``- End Q4 2020`` remark from a name."""
    return F.trim(F.regexp_replace(F.trim(col), _LIFECYCLE, ""))


def _first_rule(label: Column, rules: Mapping[str, object], substring: bool, value_of) -> Column:
    """WHEN chain in rule order, so that the first matching rule wins."""
    text = F.trim(label)
    chain: Column | None = None
    for key, outcome in rules.items():
        test = F.lower(text).contains(key.lower()) if substring else text == key
        value = value_of(outcome)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain if chain is not None else F.lit(None)


def match_label(label: Column, rules: Mapping[str, str], substring: bool = False) -> Column:
    """Canonical name of a label: exact match, or the first rule whose key occurs in the label."""
    return _first_rule(label, rules, substring, F.lit).cast("string")


def match_dimensions(
    label: Column, rules: Mapping[str, Mapping[str, str]], dimensions: Sequence[str], substring: bool = False
) -> Column:
    """Struct of dimension values a label stands for; NULL struct when no rule matches."""

    def as_struct(dims: Mapping[str, str]) -> Column:
        return F.struct(*[F.lit(dims.get(d)).cast("string").alias(d) for d in dimensions])

    chain = _first_rule(label, rules, substring, as_struct)
    return chain.cast("struct<" + ",".join(f"{d}:string" for d in dimensions) + ">")


def code_for(col: Column, codes: Mapping[str, str]) -> Column:
    """Replace long names by codes; anything else stays as it is."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def classify(col: Column, codes: Mapping[str, str], other: str | None = None) -> Column:
    """Map a code to a class, ``other`` when unknown."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(other).cast("string"))


def like_any(col: Column, patterns: Sequence[str]) -> Column:
    """True when the lower-cased text matches one of the LIKE patterns."""
    text = F.lower(col)
    test = text.like(patterns[0])
    for pattern in patterns[1:]:
        test = test | text.like(pattern)
    return test


def composite_label(parts: Sequence[Column], separator: str = " | ") -> Column:
    """Join the non-empty parts of a label, whole: a cut label would merge series."""
    return F.concat_ws(separator, *[F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts])


def obligation_period(metric: Column, period_label: Column) -> Column:
    """Obligation period of a certificate row: behind the bar of ``Apr|2019-20``, or the label itself."""
    behind_bar = F.split_part(period_label, F.lit("|"), F.lit(2))
    return F.when(
        (metric == "rocs_monthly_millions") & period_label.contains("|"), behind_bar
    ).when(
        metric.isin("rocs_issued_millions", "accredited_capacity_mw") & period_label.rlike(r"^\d{4}-\d{2}$"),
        period_label,
    )


# Illustrative emission factors, kg CO2e per MWh.
EMISSION_FACTORS = {
    "coal": 850.0,
    "gas": 400.0,
    "ccgt": 400.0,
    "nuclear": 12.0,
    "wind": 11.0,
    "offshore_wind": 11.0,
    "onshore_wind": 11.0,
    "solar": 45.0,
    "hydro": 24.0,
    "biomass": 120.0,
    "other": 300.0,
    "oil": 650.0,
    "pumped_storage": 120.0,
    "imports": 350.0,
    "total": 350.0,
}


def fuel_key(col: Column) -> Column:
    """Fuel name as a lookup key: lower case, underscores, without the series prefix."""
    return F.regexp_replace(F.translate(F.lower(col), " -", "__"), r"^generation_share_twh_", "")


def emission_factor(fuel: Column, factors: Mapping[str, float] = EMISSION_FACTORS) -> Column:
    """Emission factor of a fuel, the ``other`` factor when the fuel is unknown."""
    pairs = [F.lit(x) for item in factors.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), fuel_key(fuel)), F.lit(factors["other"]))


def section_letter(col: Column) -> Column:
    """A one-letter industry section as it stands, else NULL (to be looked up by name)."""
    text = F.upper(F.trim(col))
    return F.when(text.rlike("^[A-Z]$"), text)
