"""Delimited text: separators, quotes and line breaks, in time linear in the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for comma, semicolon, line feed, carriage return, blank and tab inside quotes while a text is
# cut up (characters for private use), and what for an escaped quote.
HELD = ",;\n\r \t"
HELD_AS = "\ue000\ue001\ue002\ue003\ue004\ue005"
QUOTE_AS = "\ue006"


def held_quotes(text: Column) -> Column:
    """The text without its quotes, everything special inside them replaced by stand-ins; ``released`` turns these back.

    Cut at the quotes, every second part lies inside a pair of them; an empty part between two such is an escaped quote.
    One pass, whatever the number of separators.
    """
    parts = F.split(text, '"')
    last = F.size(parts) - 1

    def part(p: Column, i: Column) -> Column:
        escaped = (p == "") & (i > 0) & (i < last)
        return F.when(i % 2 == 1, F.translate(p, HELD, HELD_AS)).when(escaped, F.lit(QUOTE_AS)).otherwise(p)

    return F.array_join(F.transform(parts, part), "")


def released(cell: Column) -> Column:
    """A trimmed cell with its own characters back."""
    return F.translate(F.trim(cell), HELD_AS + QUOTE_AS, HELD + '"')


def records(held: Column) -> Column:
    """Lines of a text whose quotes are held; line breaks inside quotes are no ends of lines."""
    return F.split(held, "\r?\n")


def separator(text: Column) -> Column:
    """Semicolon where there are more of them than commas, else comma."""

    def count(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    return F.when(count(";") > count(","), F.lit(";")).otherwise(F.lit(","))


def cells(line: Column, sep: Column) -> Column:
    """Cells of a line whose quotes are held."""
    found = F.when(sep == ";", F.split(line, ";")).otherwise(F.split(line, ","))
    return F.transform(found, released)
