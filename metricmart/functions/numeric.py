"""Numbers out of text, safe arithmetic and unit conversion."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal or exponent number. Checked before casting because a Java cast also takes "1d" and "1f".
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def lenient_number(col: Column) -> Column:
    """Number from a cell; blank, ``null`` and ``-`` are NULL, thousands commas are dropped."""
    return _to_double(F.replace(F.trim(col.cast("string")), F.lit(","), F.lit("")))


def bracket_number(col: Column) -> Column:
    """Number from a statistical-table cell: ``[x]`` and ``x`` are NULL, notes such as ``[note 3]`` are dropped."""
    text = F.regexp_replace(F.trim(col.cast("string")), r"\[.*?\]", "")
    return lenient_number(text)


def marked_number(col: Column) -> Column:
    """Number from a cell, NULL when the cell carries an ``[x]`` mark anywhere."""
    text = F.trim(col.cast("string"))
    return F.when(~F.lower(text).contains("[x]"), _to_double(text))


def year_token(col: Column, low: int = 1990, high: int = 2035) -> Column:
    """Calendar year held in a cell (numbers are rounded), NULL outside ``low..high``."""
    year = F.bround(bracket_number(col)).try_cast("int")
    return F.when(year.between(low, high), year)


def rounded_int(col: Column) -> Column:
    """Integer from numeric text, rounding half away from zero."""
    return F.round(col.try_cast("decimal(38,6)")).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def percent_change(first: Column, last: Column) -> Column:
    """``(last - first) / |first|`` in percent, NULL for a zero start."""
    return F.try_divide((last - first).cast("double"), F.abs(first).cast("double")) * 100.0


def present_count(*cols: Column) -> Column:
    """How many of the columns are not NULL."""
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def any_present(*cols: Column) -> Column:
    """True when at least one column is not NULL."""
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in cols])


def present_mean(*cols: Column) -> Column:
    """Mean of the columns that are not NULL; NULL when none is."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    return F.try_divide(total, present_count(*cols).cast("double"))


# Energy units in TWh per unit (1 Mtoe = 11.63 TWh).
TWH_PER_UNIT = {
    "mtoe": 11.63,
    "ktoe": 0.01163,
    "twh": 1.0,
    "gwh": 0.001,
    "mwh": 0.000001,
}

# Power units in kW per unit.
KW_PER_UNIT = {"kw": 1.0, "mw": 1_000.0, "gw": 1_000_000.0}


def convert(value: Column, source: str, target: str, factors: Mapping[str, float] = TWH_PER_UNIT) -> Column:
    """Convert between two units of one factor table."""
    return value * F.lit(factors[source.lower()]) / F.lit(factors[target.lower()])


def convert_by_unit(value: Column, unit: Column, target: str, factors: Mapping[str, float] = TWH_PER_UNIT) -> Column:
    """Convert each row from the unit named in ``unit``; NULL for a unit the factor table lacks."""
    pairs = [F.lit(x) for name, factor in factors.items() for x in (name, factor / factors[target.lower()])]
    return value * F.try_element_at(F.create_map(*pairs), F.lower(unit))


def scaled_percent(share: Column, group_max: Column) -> Column:
    """Shares as percentages: a group whose largest share is at most 1 holds fractions and is multiplied by 100."""
    return F.when(group_max <= 1.0 + 1e-9, share * 100.0).otherwise(share)


def bubble_size(value: Column, largest: Column, low: float = 10.0, span: float = 40.0, flat: float = 12.0) -> Column:
    """Marker size ``low .. low+span`` proportional to the value; ``flat`` when nothing is positive."""
    filled = F.coalesce(value.cast("double"), F.lit(0.0))
    return F.when(largest > 0, low + span * (filled / largest)).otherwise(F.lit(flat))
