"""Conforming entities and choosing between competing sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.functions.labels import normalised


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under an explicit order.

    Written as ``row_number() = 1``: Spark keeps one row per key on the map side before the shuffle, so a key that
    holds most of the rows costs one row per input partition, not a full group in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key under ascending order of the named columns."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns a branch lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Sequence[DataFrame], tag: str = "prio") -> DataFrame:
    """UNION ALL with the position of each source as its priority, 1 first."""
    return union_all([f.withColumn(tag, F.lit(i)) for i, f in enumerate(frames, start=1)])


def prioritise(frames: Sequence[DataFrame], keys: Sequence[str], require: Sequence[str] = ()) -> DataFrame:
    """One row per key from the best source that has it; ties inside a source break on all other columns."""
    both = tagged_union(frames)
    for name in require:
        both = both.filter(F.col(name).isNotNull())
    rest = [c for c in both.columns if c not in keys and c != "prio"]
    order = [F.col("prio"), *[F.col(c).asc_nulls_last() for c in rest]]
    return first_per_key(both, keys, order).drop("prio")


def resolve_alias(
    df: DataFrame,
    alias: DataFrame,
    column: str,
    source: str,
    canonical: str,
    sector: tuple[str, str] | None = None,
) -> DataFrame:
    """Replace raw names by canonical ones, keeping the raw name where no alias matches.

    ``sector`` is (column of ``df``, column of ``alias``): an alias row that names a sector only applies to that
    sector, one without a sector applies to all, and the specific one wins. The alias table is reduced to one row per
    key first, so no row of ``df`` can multiply.
    """
    names = alias.select(
        F.col(source).alias("_source"),
        F.col(canonical).alias("_canonical"),
        *([F.col(sector[1]).alias("_sector")] if sector else []),
    ).filter(F.col("_source").isNotNull())
    if sector is None:
        lookup = names.groupBy("_source").agg(F.max("_canonical").alias("_canonical"))
        joined = df.join(lookup, df[column] == lookup["_source"], "left")
        return joined.withColumn(column, F.coalesce("_canonical", column)).drop("_source", "_canonical")
    exact = names.filter(F.col("_sector").isNotNull()).groupBy("_source", "_sector")
    general = names.filter(F.col("_sector").isNull()).groupBy(F.col("_source").alias("_source_any"))
    exact, general = exact.agg(F.max("_canonical").alias("_exact")), general.agg(F.max("_canonical").alias("_any"))
    joined = df.join(
        exact, (df[column] == exact["_source"]) & (df[sector[0]] == exact["_sector"]), "left"
    ).join(general, df[column] == general["_source_any"], "left")
    resolved = joined.withColumn(column, F.coalesce("_exact", "_any", column))
    return resolved.drop("_source", "_sector", "_source_any", "_exact", "_any")


def canonical_lookup(alias: DataFrame, prefer_sector: str | None = None, position: str | None = None) -> DataFrame:
    """Lookup (name key → canonical name) with ordered fallbacks.

    Source name in the preferred sector, source name, canonical name in the preferred sector, canonical name. Inside
    one step the first alias row wins: by ``position`` when the table has one, else by canonical name.
    """
    in_sector = F.lit(False) if prefer_sector is None else F.coalesce(
        F.col("network_sector_code") == prefer_sector, F.lit(False)
    )
    place = F.col(position) if position else F.lit(0)

    def step(column: str, base: int) -> DataFrame:
        return alias.select(
            normalised(F.col(column)).alias("name_key"),
            F.col("company_name").alias("canonical_name"),
            F.when(in_sector, F.lit(base)).otherwise(F.lit(base + 1)).alias("_step"),
            place.alias("_place"),
        )

    steps = step("source_company_name", 1).unionByName(step("company_name", 3))
    ranked = first_per_key(
        steps.filter(F.col("name_key").isNotNull()),
        ["name_key"],
        [F.col("_step"), F.col("_place").asc_nulls_last(), F.col("canonical_name").asc_nulls_last()],
    )
    return ranked.select("name_key", "canonical_name")


def with_canonical_name(df: DataFrame, lookup: DataFrame, column: str, target: str | None = None) -> DataFrame:
    """Add the canonical name of a raw name; unknown names stay, trimmed."""
    keyed = df.withColumn("_key", normalised(F.col(column)))
    joined = keyed.join(lookup.withColumnRenamed("name_key", "_key"), "_key", "left")
    return joined.withColumn(
        target or column, F.coalesce("canonical_name", F.trim(F.col(column)))
    ).drop("_key", "canonical_name")


def first_nonempty(
    candidates: Sequence[DataFrame],
    value: str | None = None,
    min_rows: int | Sequence[int] = 1,
    tag: str | None = None,
    known: Sequence[int | None] | None = None,
) -> DataFrame:
    """Rows of the first candidate that has enough rows (with a non-NULL ``value``, when given).

    The choice is made at once, and the plan holds the chosen one only. Where ``known`` has a candidate's rows, as the run
    log recorded them (``audit.recorded_rows``), it is judged by them and no job runs; a filtered candidate of an empty
    table may be known as 0 too. Others are probed in order, each until it has given the rows needed. The columns are
    those of all candidates; with ``tag`` the position chosen is a column.
    """
    recorded = list(known) if known is not None and value is None else [None] * len(candidates)
    needed = [min_rows] * len(candidates) if isinstance(min_rows, int) else list(min_rows)
    for i, (df, n) in enumerate(zip(candidates, needed, strict=True), start=1):
        have = recorded[i - 1]
        if have is None:
            have = (df if value is None else df.filter(F.col(value).isNotNull())).limit(n).count()
        if have >= n:
            break
    else:
        i, df = 0, candidates[0].filter(F.lit(False))
    shape = union_all([c.limit(0) for c in candidates]).schema
    own = set(df.columns)
    chosen = df.select(*[(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])
    return chosen.withColumn(tag, F.lit(i)) if tag else chosen


def in_range_else_latest(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    """Rows of the year range; when the range is empty, rows of the latest year."""
    year = F.col(column)
    facts = df.agg(
        F.struct(F.count_if(year.between(first, last)).alias("hits"), F.max(year).alias("latest")).alias("f")
    ).scalar()
    fallback = (facts.getField("hits") == 0) & (year == facts.getField("latest"))
    return df.filter(year.between(first, last) | fallback)


def latest_only(df: DataFrame, column: str = "year") -> DataFrame:
    """Rows of the latest value of a column (a snapshot)."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())
