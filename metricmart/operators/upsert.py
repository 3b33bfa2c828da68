"""Merging new rows into a table, without MERGE: the result is the next snapshot of the table.

Keys compare null-safe everywhere (NULL equals NULL). A source must be unique on the keys, as for a MERGE; see
``quality.duplicates`` and ``audit.assert_unique``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.joins import null_safe_join


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    only_where: Column | None = None,
    keep_old_when_null: bool = False,
) -> DataFrame:
    """Update matching rows, insert the others.

    A source with all columns replaces whole rows: target rows without a partner, plus the source. The source is the
    small side (a batch against a table), so Spark broadcasts it when its size allows and the target is not shuffled.
    A source with fewer columns, or ``keep_old_when_null``, merges column by column in a full-outer join.
    ``only_where`` limits the target rows that may be matched; the others pass through.
    """
    if only_where is not None:
        test = F.coalesce(only_where, F.lit(False))
        rest = target.filter(~test)
        return rest.unionByName(upsert(target.filter(test), source, keys, None, keep_old_when_null))
    columns = target.columns
    new = [c for c in source.columns if c in columns and c not in keys]
    if not keep_old_when_null and set(columns) <= set(source.columns):
        kept = null_safe_join(target, source.select(*keys), keys, "left_anti")
        return kept.unionByName(source.select(*columns))
    incoming = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in new]).withColumn("_in_source", F.lit(True))
    joined = null_safe_join(target, incoming, keys, "full_outer")

    def merged(c: str) -> Column:
        if c not in new:
            return F.col(c)
        if keep_old_when_null:
            return F.coalesce(f"_new_{c}", c).alias(c)
        return F.when(F.col("_in_source"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) for c in columns])


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add source rows whose key the target lacks; existing rows stay as they are."""
    added = null_safe_join(source, target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(added.dropDuplicates(list(keys)), allowMissingColumns=True)


def empty_like(df: DataFrame) -> DataFrame:
    """An empty target for a first load."""
    return df.filter(F.lit(False))


def upsert_all(target: DataFrame, batches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Apply several batches in order."""
    return reduce(lambda t, b: upsert(t, b, keys), batches, target)
