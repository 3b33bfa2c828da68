"""Top-n, ranks, standard scores and ordered output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.operators.quantiles import column_quantiles


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest value; runs as one take-ordered step, each partition sends n rows."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]).limit(n)


def top_entities(df: DataFrame, entity: Sequence[str], score: Column, n: int) -> DataFrame:
    """All rows of the n entities with the largest aggregated score."""
    scored = df.groupBy(*entity).agg(score.alias("_score"))
    best = top_n(scored, "_score", n, entity).select(*entity)
    return df.join(best, list(entity), "left_semi")


def leaderboard(df: DataFrame, label: str, value: str, n: int = 20) -> DataFrame:
    """The n best rows with their rank; the rank window only sees those n rows."""
    best = top_n(df.select(label, value).dropna(), value, n, [label])
    order = Window.orderBy(F.col(value).desc_nulls_last(), F.col(label).asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order))


def z_scores(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Standard scores with the population deviation; 0 for a column with fewer than two distinct values.

    The statistics of all columns come from one aggregation, as a scalar subquery.
    """
    facts = df.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd"), (F.min(c) < F.max(c)).alias("varies")
                ).alias(c)
                for c in columns
            ]
        )
    ).scalar()
    scores = {}
    for c in columns:
        fact = facts.getField(c)
        score = F.try_divide(F.col(c) - fact.getField("mean"), fact.getField("sd"))
        scores[c] = F.when(F.coalesce(fact.getField("varies"), F.lit(False)), score).otherwise(F.lit(0.0))
    return scores


def composite_score(df: DataFrame, weights: Mapping[str, float], name: str = "score") -> DataFrame:
    """Add the weighted sum of standard scores."""
    scores = z_scores(df, list(weights))
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + scores[column] * F.lit(float(weight))
    return df.withColumn(name, total)


def median_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill gaps of each column with its exact median. Runs the job that finds the medians: one number per column."""
    medians = {r["column_name"]: r["m"] for r in column_quantiles(df, columns, {"m": 0.5}).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns})


def sorted_by_case(df: DataFrame, column: str, order: Sequence[str], *then: str) -> DataFrame:
    """Order rows by a list of labels, other labels last."""
    pairs = [F.lit(x) for i, label in enumerate(order) for x in (label, i)]
    place = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(len(order)))
    return df.orderBy(place, *then)


def columns_by_total(df: DataFrame, index: Sequence[str]) -> DataFrame:
    """Wide table with its value columns ordered by their totals, largest first. Runs one small aggregation."""
    values = [c for c in df.columns if c not in index]
    totals = df.agg(*[F.sum(f"`{c}`").alias(c) for c in values]).first()
    ordered = sorted(values, key=lambda c: (-(totals[c] if totals[c] is not None else float("-inf")), c))
    return df.select(*index, *[f"`{c}`" for c in ordered])
