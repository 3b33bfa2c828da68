"""The period grammar: years, quarters, half-years, months, ISO weeks and regulatory years out of text tokens."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_TYPE = "struct<period_date:date,period_label:string,year:int,quarter:int>"
YEAR_QUARTER_TYPE = "struct<year:int,quarter:int>"

# Month abbreviations in calendar order.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Calendar year that ends the first year of each regulatory scheme.
SCHEME_FIRST_END_YEAR = {"T1": 2014, "ED1": 2016, "GD1": 2014}


def _part(text: Column, pattern: str, group: int) -> Column:
    """A regex group, NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _year_quarter(year: Column, quarter: Column) -> Column:
    return F.struct(year.cast("int").alias("year"), quarter.cast("int").alias("quarter"))


def _month_number(text: Column) -> Column:
    """1..12 for a name starting with a month abbreviation."""
    position = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.initcap(F.left(F.trim(text), F.lit(3))))
    return F.nullif(position, F.lit(0)).cast("int")


def _end_year(first: Column, second: Column) -> Column:
    """End year of a span like 2013-14, 1999-00 or 2013-2014: the next year with these last two digits."""
    return first + F.pmod(second - first, F.lit(100))


def label_year(col: Column) -> Column:
    """Calendar year of a label: the end year of a span, else the first four-digit number."""
    text = F.trim(col.cast("string"))
    span = r"(\d{4})\s*[-/\s]\s*(\d{2,4})"
    end = _end_year(_int(_part(text, span, 1)), _int(_part(text, span, 2)))
    return F.coalesce(end, _int(_part(text, r"(\d{4})", 1)))


def year_quarter(col: Column) -> Column:
    """(year, quarter) of ``Q1 2013``, ``2013 Q1`` or ``Quarter 1 2013``; NULL fields otherwise.

    The token is first brought into the form ``2013 Q1``; the pattern that accepts it also checks the ranges.
    """
    text = F.trim(col.cast("string"))
    turned = F.regexp_replace(text, r"(?i)^(?:Q|Quarter\s+)(\d)\s+(\d{4})$", "$2 Q$1")
    pattern = r"(?i)^(19\d\d|20\d\d|2100)\s+Q([1-4])$"
    return _year_quarter(_int(_part(turned, pattern, 1)), _int(_part(turned, pattern, 2)))


def date_quarter(col: Column) -> Column:
    """(year, quarter) of a date."""
    return _year_quarter(F.year(col), F.quarter(col))


def half_year(col: Column) -> Column:
    """(year, quarter) of ``2018/19 winter`` (first quarter of the end year) or ``2019 summer`` (third quarter)."""
    text = F.trim(col.cast("string"))
    winter = r"(?i)^(\d{4})\s*/\s*(\d{2,4})\s+winter\s*\*?$"
    summer = r"(?i)^(\d{4})\s+summer\s*\*?$"
    year = F.coalesce(
        _end_year(_int(_part(text, winter, 1)), _int(_part(text, winter, 2))), _int(_part(text, summer, 1))
    )
    return _year_quarter(year, F.when(text.rlike(winter), F.lit(1)).when(text.rlike(summer), F.lit(3)))


def bracket_quarter(col: Column) -> Column:
    """(year, quarter) of a label that carries ``(Quarter 2 2019)``, or of the label itself."""
    text = F.trim(F.replace(col.cast("string"), F.lit('"'), F.lit("")))
    inner = _part(text, r"(?i)\(\s*(Quarter\s+\d\s+\d{4})\s*\)", 1)
    return year_quarter(F.coalesce(inner, F.regexp_replace(text, r"Quarter\s+(?=\d)", "Q")))


def _date(text: Column, pattern: str) -> Column:
    """Parse a date. The shape is checked first: a failed parse is an exception inside Spark, and dear per row."""
    shape = pattern
    for letters, digits in (("yyyy", r"\d{4}"), ("yy", r"\d{2}"), ("MMM", "[A-Za-z]{3}")):
        shape = shape.replace(letters, digits)
    shape = re.sub(r"(?<![\\A-Za-z])[dMHms](?![A-Za-z])", lambda _: r"\d{1,2}", shape)
    return F.when(text.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(pattern)).cast("date"))


def _first_of_quarter(yq: Column) -> Column:
    return F.make_date(yq["year"], (yq["quarter"] - 1) * 3 + 1, F.lit(1))


def _short_month_date(text: Column, pivot: int) -> Column:
    """First day of the month of ``Apr-15``; two-digit years from ``pivot`` on belong to the 1900s."""
    date = _date(F.initcap(text), "MMM-yy")  # reads 00..99 as 2000..2099
    return F.when(F.year(date) >= 2000 + pivot, F.add_months(date, -1200)).otherwise(date)


# Date patterns tried in order for each format hint.
DATE_PATTERNS = {
    "us_dayfirst": ["M/d/yyyy", "M-d-yyyy"],
    "dayfirst": ["d/M/yyyy", "d-M-yyyy", "yyyy-M-d"],
    "default": ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "<short month>", "d/M/yyyy H:m:s"],
}


def parse_date(col: Column, hint: str | None = None) -> Column:
    """Date of a cell under a format hint; the first pattern that parses wins."""
    text = F.trim(col.cast("string"))
    if hint == "month_year_short":
        return _short_month_date(text, 69)
    if hint == "quarterly":
        return _first_of_quarter(year_quarter(text))
    if hint == "half_year":
        return _first_of_quarter(half_year(text))
    patterns = DATE_PATTERNS.get(hint or "default", DATE_PATTERNS["default"])
    return F.coalesce(*[_short_month_date(text, 69) if p.startswith("<") else _date(text, p) for p in patterns])


def resolve_period(col: Column, kind: str = "auto") -> Column:
    """Struct (period_date, period_label, year, quarter) of a period token.

    ``kind`` is ``year``, ``quarterly``, ``half_year``, ``month_year_short``, ``us_dayfirst``, ``dayfirst`` or
    ``auto``, which tries quarter, month, both day formats and half-year in that order, then a bare year.
    """
    text = F.trim(col.cast("string"))
    no_date, no_int = F.lit(None).cast("date"), F.lit(None).cast("int")
    if kind == "year":
        date, year, quarter = no_date, label_year(text), no_int
    elif kind in ("quarterly", "half_year"):
        yq = year_quarter(text) if kind == "quarterly" else half_year(text)
        date, year, quarter = _first_of_quarter(yq), yq["year"], yq["quarter"]
    elif kind in ("month_year_short", "us_dayfirst", "dayfirst"):
        date = parse_date(text, kind)
        year, quarter = F.year(date), F.quarter(date)
    else:
        order = ["quarterly", "month_year_short", "us_dayfirst", "dayfirst", "half_year"]
        date = F.coalesce(*[parse_date(text, hint) for hint in order])
        year, quarter = F.coalesce(F.year(date), label_year(text)), F.quarter(date)
    # Typed field by field: a cast of the whole struct would keep Spark from computing only the fields in use.
    return F.struct(
        date.cast("date").alias("period_date"), text.alias("period_label"), year.cast("int").alias("year"),
        quarter.cast("int").alias("quarter"),
    )


def regulatory_year(
    period: Column | None,
    financial_year: Column | None,
    scheme: str | None,
    starts: Mapping[str, int] = SCHEME_FIRST_END_YEAR,
) -> Column:
    """Calendar year that ends a regulatory year, from ``Year N`` counts or a ``13/14``-like token."""
    parts = []
    if period is not None and scheme in starts:
        parts.append(_int(period) + F.lit(starts[scheme] - 1))
    if financial_year is not None:
        token = r"(\d{2,4})\s*[-/]\s*(\d{2,4})"
        first, second = _part(financial_year, token, 1), _part(financial_year, token, 2)
        start = F.when(F.length(first) == 4, _int(first)).otherwise(
            _int(first) + F.when(_int(first) >= 50, F.lit(1900)).otherwise(F.lit(2000))
        )
        short_end = F.when(F.length(second) == 2, start + 1).otherwise(_int(second))
        if period is not None:
            short_end = F.when(period.isNull(), short_end)
        parts.append(short_end)
    return F.coalesce(*parts).cast("int") if parts else F.lit(None).cast("int")


def obligation_start_year(col: Column) -> Column:
    """2019 of ``2019-20``."""
    text = F.trim(F.replace(F.trim(col), F.lit('"'), F.lit("")))
    return _int(_part(text, r"^(\d{4})-\d{2}$", 1))


def month_of_obligation(month: Column, obligation: Column) -> Column:
    """(calendar year, quarter) of a month within an April-to-March obligation period."""
    start = obligation_start_year(obligation)
    number = _month_number(month)
    year = start + (number < 4).cast("int")
    return _year_quarter(year, F.when(start.isNotNull(), F.ceil(number / 3)))


def short_month_quarter(col: Column) -> Column:
    """(year, quarter) of ``Apr-02*`` or ``Apr - 19``; two-digit years below 70 belong to the 2000s."""
    text = F.regexp_replace(F.replace(col, F.lit('"'), F.lit("")), r"\s+|\*$", "")
    return date_quarter(_short_month_date(text, 70))


def iso_week_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week; NULL for week numbers the year does not have."""
    first = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    weeks = F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))
    return F.when(week.between(1, weeks), F.date_add(first, ((week - 1) * 7).cast("int")))


def iso_week_label_number(label: Column) -> Column:
    """10 of ``isoweek_10``."""
    return _int(_part(label, r"(?i)^isoweek_(\d+)", 1))


def scheme_year(col: Column) -> Column:
    """Number of a scheme year token such as ``Scheme year 12`` or ``SY12``."""
    return _int(_part(F.trim(col.cast("string")), r"(\d{1,2})", 1))


def scheme_calendar_year(col: Column, base: int = 2010) -> Column:
    """Calendar year of a scheme year token; falls back to a year inside the label."""
    number = scheme_year(col)
    return F.when(number.between(1, 30), number + base).otherwise(label_year(col))


def title_year(col: Column) -> Column:
    """First 19xx or 20xx number in a title."""
    return _int(_part(col, r"((?:19|20)\d{2})", 1))


def backfilled_period(period_date: Column, year: Column, quarter: Column) -> Column:
    """The period date, or the first day of the last month of (year, quarter)."""
    return F.coalesce(period_date, F.make_date(year, quarter * 3, F.lit(1)))
