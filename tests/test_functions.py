"""The token grammar and cleaning functions on literal fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from metricmart.functions import labels as L
from metricmart.functions import numeric as N
from metricmart.functions import periods as P
from metricmart.functions.documents import has_keys, with_fields


def one(spark, column):
    value = spark.range(1).select(column.alias("v")).first()[0]
    return tuple(value) if hasattr(value, "asDict") else value


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "token, expected",
    [("1,234", 1234.0), ("-", None), ("null", None), ("", None), (" 7.5 ", 7.5), ("1d", None), ("abc", None), ("-3e2", -300.0)],
)
def test_lenient_number(spark, token, expected):
    assert one(spark, N.lenient_number(text(token))) == expected


@pytest.mark.parametrize("token, expected", [("[x]", None), ("x", None), ("12 [note 3]", 12.0), ("1,000[r]", 1000.0)])
def test_bracket_number(spark, token, expected):
    assert one(spark, N.bracket_number(text(token))) == expected


def test_marked_number_and_year_token(spark):
    assert one(spark, N.marked_number(text("5 [X]"))) is None
    assert one(spark, N.marked_number(text("5.5"))) == 5.5
    assert one(spark, N.year_token(text("2013.0"))) == 2013
    assert one(spark, N.year_token(text("1970"))) is None
    assert one(spark, N.year_token(text("1970"), 1950, 2100)) == 1970


def test_rounded_int_is_half_away_from_zero(spark):
    assert one(spark, N.rounded_int(text("2021.5"))) == 2022


@pytest.mark.parametrize("token, expected", [("2013-14", 2014), ("2013", 2013), ("1999-00", 2000), ("2013/2014", 2014), ("x", None)])
def test_label_year(spark, token, expected):
    assert one(spark, P.label_year(text(token))) == expected


@pytest.mark.parametrize(
    "token, expected",
    [("Q1 2013", (2013, 1)), ("2013 Q1", (2013, 1)), ("Quarter 1 2013", (2013, 1)), ("Q5 2013", (None, None)),
     ("q3 2019", (2019, 3)), ("2013", (None, None)), ("Q1 1800", (None, None))],
)
def test_year_quarter(spark, token, expected):
    assert one(spark, P.year_quarter(text(token))) == expected


@pytest.mark.parametrize("token, expected", [("2018/19 winter", (2019, 1)), ("2019 summer*", (2019, 3)), ("2019", (None, None))])
def test_half_year(spark, token, expected):
    assert one(spark, P.half_year(text(token))) == expected


@pytest.mark.parametrize(
    "token, hint, expected",
    [
        ("Apr-15", "month_year_short", datetime.date(2015, 4, 1)),
        ("Apr-72", "month_year_short", datetime.date(1972, 4, 1)),
        ("12/28/2015", "us_dayfirst", datetime.date(2015, 12, 28)),
        ("01/04/2010", "dayfirst", datetime.date(2010, 4, 1)),
        ("2010-04-01", "dayfirst", datetime.date(2010, 4, 1)),
        ("Q2 1998", "quarterly", datetime.date(1998, 4, 1)),
        ("13/13/2013", "dayfirst", None),
        ("2020-02-30", None, None),
    ],
)
def test_parse_date(spark, token, hint, expected):
    assert one(spark, P.parse_date(text(token), hint)) == expected


def test_resolve_period_auto_tries_formats_in_order(spark):
    assert one(spark, P.resolve_period(text("2018/19 winter"))) == (datetime.date(2019, 1, 1), "2018/19 winter", 2019, 1)
    assert one(spark, P.resolve_period(text("Feb-20"))) == (datetime.date(2020, 2, 1), "Feb-20", 2020, 1)
    assert one(spark, P.resolve_period(text("2013-14"), "year")) == (None, "2013-14", 2014, None)


@pytest.mark.parametrize("token, expected", [("13/14", 2014), ("2013-14", 2014), ("98/99", 1999), ("99/00", 2000)])
def test_regulatory_year_from_token(spark, token, expected):
    assert one(spark, P.regulatory_year(None, text(token), None)) == expected


def test_regulatory_year_from_count(spark):
    assert one(spark, P.regulatory_year(text("3"), None, "T1")) == 2016
    assert one(spark, P.regulatory_year(text("3"), None, "unknown")) is None


def test_obligation_month(spark):
    assert one(spark, P.month_of_obligation(text("Feb"), text("2019-20"))) == (2020, 1)
    assert one(spark, P.month_of_obligation(text("December"), text("2019-20"))) == (2019, 4)
    assert one(spark, P.short_month_quarter(text("Apr - 02*"))) == (2002, 2)
    assert one(spark, P.bracket_quarter(text("Household (Quarter 2 2019)"))) == (2019, 2)


def test_iso_week(spark):
    assert one(spark, P.iso_week_monday(F.lit(2021), P.iso_week_label_number(text("isoweek_10")))) == datetime.date(2021, 3, 8)
    assert one(spark, P.iso_week_monday(F.lit(2021), F.lit(53))) is None
    assert one(spark, P.iso_week_monday(F.lit(2020), F.lit(53))) == datetime.date(2020, 12, 28)


def test_scheme_and_title_year(spark):
    assert one(spark, P.scheme_calendar_year(text("Scheme year 12"))) == 2022
    assert one(spark, P.title_year(text("Energy flows, 2021 edition"))) == 2021
    assert one(spark, P.backfilled_period(F.lit(None).cast("date"), F.lit(2020), F.lit(2))) == datetime.date(2020, 6, 1)


def test_labels(spark):
    assert one(spark, L.snake_case(text(" Total (GWh) "))) == "total_gwh"
    assert one(spark, L.strip_lifecycle(text("Acme - End Q4 2020"))) == "Acme"
    assert one(spark, L.match_label(text("Big Gas thing"), {"gas": "first", "big": "second"}, True)) == "first"
    assert one(spark, L.match_label(text("none"), {"gas": "first"}, True)) is None
    assert one(spark, L.code_for(text("Gas Transmission"), {"Gas Transmission": "GT"})) == "GT"
    assert one(spark, L.code_for(text("GT"), {"Gas Transmission": "GT"})) == "GT"
    assert one(spark, L.obligation_period(text("rocs_monthly_millions"), text("Apr|2019-20"))) == "2019-20"
    assert one(spark, L.emission_factor(text("Offshore Wind"))) == 11.0
    assert one(spark, L.emission_factor(text("fusion"))) == 300.0
    assert one(spark, L.composite_label([text("a"), text(""), text("b")])) == "a | b"
    assert one(spark, L.section_letter(text(" c "))) == "C"


def test_ratios(spark):
    assert one(spark, N.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, N.positive_ratio(F.lit(1.0), F.lit(-2.0))) is None
    assert one(spark, N.present_mean(F.lit(2.0), F.lit(None), F.lit(4.0))) == 3.0
    assert one(spark, N.present_mean(F.lit(None), F.lit(None))) is None
    assert one(spark, N.percent_change(F.lit(-2.0), F.lit(2.0))) == 200.0
    assert one(spark, N.convert(F.lit(1.0), "mtoe", "ktoe")) == pytest.approx(1000.0)
    assert one(spark, N.convert_by_unit(F.lit(3.0), F.lit("MW"), "kw", N.KW_PER_UNIT)) == 3000.0
    assert one(spark, N.bubble_size(F.lit(5.0), F.lit(10.0))) == 30.0
    assert one(spark, N.scaled_percent(F.lit(0.5), F.lit(1.0))) == 50.0


def test_documents(spark):
    docs = spark.createDataFrame([('{"year": "2021.0", "v": "", "date": null}',), ('{"year": 7}',)], "payload string")
    got = with_fields(docs, {"year": "int", "v": "double"}).orderBy("year").collect()
    assert [(r.year, r.v) for r in got] == [(7, None), (2021, None)]
    keyed = docs.select(has_keys(F.col("payload"), ["year", "date"]).alias("k")).collect()
    assert [r.k for r in keyed] == [True, False]
