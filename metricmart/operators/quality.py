"""Data-quality rules, reconciliation and profiles. Each returns a small report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricmart.operators.ranking import sorted_by_case


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Contract columns a table lacks."""
    return [c for c in expected if c not in df.columns]


def require_columns(df: DataFrame, expected: Sequence[str], table: str) -> DataFrame:
    """The table itself, or an error that names the missing columns."""
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"{table}: missing expected columns {missing}")
    return df


def negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative values per column, counted in one pass."""
    have = [c for c in columns if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in have])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("negatives")) for c in have]))
    )


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys included."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_rows(name: str, severity: str, df: DataFrame, violation: Column) -> DataFrame:
    """One report row: how many rows break a rule."""
    return df.agg(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.count_if(F.coalesce(violation, F.lit(False))).alias("violations"), F.count("*").alias("checked"),
    )


def check_keys(name: str, severity: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One report row: how many keys are duplicated."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return grouped.agg(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.count_if(F.col("n") > 1).alias("violations"), F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
    )


def check_counts(name: str, severity: str, violations: int, checked: int, spark: SparkSession) -> DataFrame:
    """One report row from counts that were taken while a table was written."""
    return spark.range(1).select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), F.lit(violations).cast("long").alias("violations"), F.lit(checked).cast("long").alias("checked")
    )


def check_unmatched(name: str, severity: str, df: DataFrame, reference: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """One report row: rows whose key the reference lacks; ``on`` maps columns of the table to the reference's."""
    known = reference.select(*[F.col(r).alias(f"_r{i}") for i, r in enumerate(on.values())]).distinct()
    condition = reduce(lambda a, b: a & b, [df[c] == known[f"_r{i}"] for i, c in enumerate(on)])
    marked = df.join(known.withColumn("_hit", F.lit(True)), condition, "left")
    return marked.agg(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.count_if(F.col("_hit").isNull()).alias("violations"), F.count("*").alias("checked"),
    )


def report(checks: Sequence[DataFrame], warn_above_pct: float = 0.0) -> DataFrame:
    """Union of checks with the share of violations and a status: hard rules fail, soft rules warn."""
    rows = reduce(lambda a, b: a.unionByName(b), checks)
    share = F.coalesce(F.try_divide(F.col("violations") * 100.0, F.col("checked").cast("double")), F.lit(0.0))
    broken = F.col("violations") > 0
    status = F.when(broken & (F.col("severity") == "hard"), F.lit("fail")).when(
        broken & (share > warn_above_pct), F.lit("warn")
    )
    return rows.withColumns({"violation_pct": share, "status": F.coalesce(status, F.lit("ok"))})


def enforce(checks: DataFrame) -> None:
    """Run a report and raise when a hard rule is broken."""
    failed = checks.filter("status = 'fail'").select("check_name", "violations").collect()
    if failed:
        raise ValueError("quality checks failed: " + ", ".join(f"{r[0]} ({r[1]})" for r in failed))


def reconcile(source: DataFrame, result: DataFrame, keys: Sequence[str], source_value: str, result_value: str) -> DataFrame:
    """Sums of both sides per key and their difference."""
    left = source.groupBy(*keys).agg(F.sum(F.coalesce(source_value, F.lit(0.0))).alias("source_total"))
    right = result.groupBy(*keys).agg(F.sum(F.coalesce(result_value, F.lit(0.0))).alias("result_total"))
    joined = left.join(right, list(keys), "left")
    return joined.withColumn("difference", F.col("result_total") - F.col("source_total"))


def incomplete_keys(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """How many rows carry a value but lack a key."""
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    has_value = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])
    return df.agg(F.count_if(no_key & has_value).alias("bad_rows"))


def grain_profile(df: DataFrame, grain: str, entity: str, year: str = "year", unresolved: str | None = None) -> DataFrame:
    """Rows, entities, year range and unresolved keys per grain."""
    columns = [
        F.count("*").alias("row_count"), F.countDistinct(entity).alias("entities"), F.min(year).alias("year_min"),
        F.max(year).alias("year_max"),
    ]
    if unresolved:
        columns.append(F.count_if(F.col(unresolved).isNull()).alias("unresolved_rows"))
    return df.groupBy(grain).agg(*columns)


def metric_presence(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per listed metric."""
    return df.filter(F.col("metric_name").isin(list(names))).groupBy("metric_name").agg(F.count("*").alias("rows"))


# Order of the layers in the health report.
LAYERS = ["raw_xlsx", "staging", "core", "mart"]


def layer_counts(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Row counts of (layer, name, table), ordered by layer and name."""
    rows = [
        df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for layer, name, df in tables
    ]
    return sorted_by_case(reduce(lambda a, b: a.unionByName(b), rows), "layer", LAYERS, "table_name")


def alerts(rules: Sequence[tuple[str, DataFrame, Column, str, float]]) -> DataFrame:
    """Threshold rules (name, table, aggregate, ``<`` or ``>``, limit) → observed value and whether it fires."""
    rows = []
    for name, df, aggregate, comparison, limit in rules:
        observed = df.agg(aggregate.cast("double").alias("observed"))
        fires = F.col("observed") < limit if comparison == "<" else F.col("observed") > limit
        rows.append(
            observed.select(
                F.lit(name).alias("alert"), "observed", F.lit(float(limit)).alias("threshold"),
                F.coalesce(fires, F.lit(False)).alias("fires"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b), rows)
