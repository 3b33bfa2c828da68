"""Chart tables embedded in stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions import delimited


def unescaped(html: Column) -> Column:
    """Decode the entities that occur inside quoted attributes."""
    text = html
    for entity, char in (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def chart_csv(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """CSV text of the chart in each page: the ``csv`` string of the page's options object, escapes resolved."""
    literal = F.nullif(F.regexp_extract(html, r'"csv"\s*:\s*("(?:[^"\\]|\\.)*")', 1), F.lit(""))
    as_document = F.concat(F.lit('{"csv":'), literal, F.lit("}"))
    return pages.select(page, F.get_json_object(as_document, "$.csv").alias("csv")).filter(F.col("csv").isNotNull())


def modal_data(pages: DataFrame, fields: list[str], page: str = "page_id", html: str = "html") -> DataFrame:
    """Fields of the chart-modal attribute, an entity-escaped JSON object."""
    raw = F.nullif(F.regexp_extract(html, r"data-js-chart-modal-data='([^']+)'", 1), F.lit(""))
    document = unescaped(raw)
    picked = [F.get_json_object(document, f"$.{f}").alias(f) for f in fields]
    return pages.select(page, raw.isNotNull().alias("_has"), *picked).filter("_has").drop("_has")


def csv_cells(tables: DataFrame, page: str = "page_id", csv: str = "csv") -> DataFrame:
    """Cells (page, row, col, text) of CSV texts; the separator is whichever of comma and semicolon occurs more.

    Quoted cells may hold separators, line breaks and doubled quotes. ``row`` counts records, blank ones too.
    """
    lines = tables.select(
        page, delimited.separator(F.col(csv)).alias("_sep"), F.posexplode(delimited.records(delimited.held_quotes(F.col(csv)))).alias("row", "_line")
    )
    return lines.filter(F.trim("_line") != "").select(page, "row", F.posexplode(delimited.cells(F.col("_line"), F.col("_sep"))).alias("col", "text"))


def links(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """Targets of the links in each page, in order."""
    targets = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(page, F.posexplode(targets).alias("position", "href"))
