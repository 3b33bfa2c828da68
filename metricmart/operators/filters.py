"""Row selection: metric lists, year ranges, optional user choices and grain selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.sources.literals import literal_table


def metrics(df: DataFrame, names: Sequence[str], column: str = "metric_name") -> DataFrame:
    """Rows of the listed metrics."""
    return df.filter(F.col(column).isin(list(names)))


def years(df: DataFrame, first: int, last: int, column: str = "year", keep_null: bool = False) -> DataFrame:
    """Rows of a year range, with or without rows that carry no year."""
    test = F.col(column).between(first, last)
    return df.filter(F.col(column).isNull() | test if keep_null else test)


def chosen(df: DataFrame, column: str, values: Sequence[object] | None) -> DataFrame:
    """Rows of the chosen values, by a semi-join with the list; no choice keeps everything."""
    if not values:
        return df
    kind = df.schema[column].dataType.simpleString()
    wanted = literal_table(df.sparkSession, [(v,) for v in values], f"`{column}` {kind}")
    return df.join(wanted, column, "left_semi")


def commodity(df: DataFrame, choice: str, column: str = "commodity") -> DataFrame:
    """Rows of one commodity, compared without case; ``both`` keeps all."""
    return df if choice == "both" else df.filter(F.lower(F.col(column)) == choice.lower())


def differs_or_null(column: Column, value: object) -> Column:
    """True where the column is NULL or not equal to the value."""
    return column.isNull() | (column != value)


def equals_or_null(column: Column, value: object) -> Column:
    """True where the column is NULL or equal to the value."""
    return column.isNull() | (column == value)


def payment(df: DataFrame, choice: str | None, keep_null: bool = False) -> DataFrame:
    """Rows of a payment method; ``all`` or no choice keeps everything."""
    if not choice or choice == "all":
        return df
    column = F.col("payment_method")
    return df.filter(equals_or_null(column, choice) if keep_null else column == choice)


def grain(df: DataFrame, present: Sequence[str] = (), absent: Sequence[str] = ()) -> DataFrame:
    """Rows of one grain: ``present`` columns set, ``absent`` columns NULL."""
    test = F.lit(True)
    for name in present:
        test = test & F.col(name).isNotNull()
    for name in absent:
        test = test & F.col(name).isNull()
    return df.filter(test)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values for a picker, sorted."""
    return df.select(*columns).distinct().orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def conform(df: DataFrame, schema: Sequence[tuple[str, str]], **literals: object) -> DataFrame:
    """Project to a fixed shape: ``literals`` fill constants, columns the frame lacks become typed NULLs."""
    have = set(df.columns)

    def field(name: str, kind: str) -> Column:
        if name in literals:
            return F.lit(literals[name]).cast(kind).alias(name)
        if name in have:
            return F.col(name).cast(kind).alias(name)
        return F.lit(None).cast(kind).alias(name)

    return df.select(*[field(n, k) for n, k in schema])
