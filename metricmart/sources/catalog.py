"""Which tables exist and how many rows they have."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricmart.sources.literals import literal_table


def existing(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Names the catalog knows, as table or view."""
    return [n for n in names if spark.catalog.tableExists(n)]


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row counts of those tables that exist."""
    counts = [
        spark.table(n).agg(F.lit(n).alias("obj"), F.count("*").alias("n")) for n in existing(spark, names)
    ]
    if not counts:
        return literal_table(spark, [], "obj string, n bigint")
    return reduce(lambda a, b: a.unionByName(b), counts)


def status(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Every name with whether it exists and its rows."""
    wanted = literal_table(spark, [(n,) for n in names], "object_name string")
    counts = row_counts(spark, names).select(F.col("obj").alias("object_name"), F.col("n").alias("rows"))
    return wanted.join(counts, "object_name", "left").withColumn("exists", F.col("rows").isNotNull())
