"""Long → wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.aggregates import metric_columns
from metricmart.operators.ranking import top_entities


def pivot_metrics(df: DataFrame, keys: Sequence[str], spec: Mapping[str, tuple], *extra: Column) -> DataFrame:
    """One column per metric spec, in one aggregation with map-side combine."""
    return df.groupBy(*keys).agg(*metric_columns(spec), *extra)


def pivot_dynamic(
    df: DataFrame, index: Sequence[str], column: str, value: str, how: str = "avg", limit: int = 500
) -> DataFrame:
    """Columns from the data. Runs one distinct query; more than ``limit`` columns is an error, never a cut.

    Rows with a NULL column label have no column to go to and are left out, as in a spreadsheet pivot.
    """
    rows = df.filter(F.col(column).isNotNull())
    labels = [r[0] for r in rows.select(column).distinct().orderBy(column).limit(limit + 1).collect()]
    if len(labels) > limit:
        raise ValueError(f"{column} has more than {limit} values: choose a coarser column or raise the limit")
    return pivot_listed(rows, index, column, labels, value, how)


def pivot_listed(
    df: DataFrame, index: Sequence[str], column: str, labels: Sequence[object], value: str, how: str = "avg"
) -> DataFrame:
    """Columns from a known list of labels."""
    return df.groupBy(*index).pivot(column, list(labels)).agg({"sum": F.sum, "avg": F.avg, "max": F.max,
                                                               "min": F.min, "first": F.min}[how](value))


def zero_filled_area(df: DataFrame, period: str, category: str, labels: Sequence[object], value: str) -> DataFrame:
    """Sum per period and category in columns, gaps as zero."""
    wide = pivot_listed(df, [period], category, labels, value, "sum")
    return wide.fillna(0)


def heat_grid(df: DataFrame, date: str, value: str, weeks: Sequence[int] = tuple(range(1, 54))) -> DataFrame:
    """Mean value per year (rows) and ISO week (columns)."""
    rows = df.select(F.year(date).alias("year"), F.weekofyear(date).alias("week"), F.col(value))
    wide = pivot_listed(rows, ["year"], "week", list(weeks), value, "avg")
    return wide.select("year", *[F.col(f"`{w}`").alias(f"week_{w:02d}") for w in weeks])


def top_series_pivot(df: DataFrame, index: str, series: str, value: str, n: int) -> DataFrame:
    """The n series with the largest mean absolute value, one column each."""
    kept = top_entities(df, [series], F.avg(F.abs(F.col(value))), n)
    return pivot_dynamic(kept, [index], series, value, "first")


def entity_or_mean_series(df: DataFrame, period: str, entity: str, value: str) -> DataFrame:
    """Long series per entity when any entity is named, else the mean per period under the name ``_all``."""
    rows = df.filter(F.col(period).isNotNull() & F.col(value).isNotNull())
    name = F.nullif(F.trim(F.col(entity)), F.lit(""))
    # the aggregate with NULL for no entity has both answers; whether any is named is read off it
    summary = rows.groupBy(period, name.alias("_entity")).agg(F.avg(value).alias("_mean"), F.min(value).alias("_first"))
    named = summary.agg(F.count("_entity") > 0).scalar()
    kept = summary.filter(F.col("_entity").isNotNull() | ~named)
    picked = F.when(F.col("_entity").isNull(), F.col("_mean")).otherwise(F.col("_first"))
    return kept.select(period, F.coalesce("_entity", F.lit("_all")).alias(entity), picked.alias(value))
