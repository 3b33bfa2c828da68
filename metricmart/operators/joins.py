"""Joins the warehouse needs beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.conform import first_nonempty, first_per_key
from metricmart.session import stored

# Rows and periods that are paired at a time where the result is far larger than both sides.
ROWS_BLOCK, PERIODS_BLOCK = 64, 256


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys match NULL keys; the result has each key once.

    ``<=>`` keeps the hash or sort-merge join, and cannot collide with a real value as a sentinel would.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "full_outer", "outer", "right", "right_outer"):
        # With NULL keys on both sides the two columns agree, so taking whichever is set is exact.
        joined = joined.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
    return joined.drop(*[f"_r_{k}" for k in keys])


def _in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], most: int, name: str) -> DataFrame:
    """Rows of the same keys as arrays of at most ``most`` rows, for partitions that hold all rows of their keys.

    Rows with a NULL key are left out. A block is a run of consecutive rows of a sorted partition, so no key has to fit in an array.
    """
    df = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).sortWithinPartitions(*keys, *order)
    df = df.withColumn("_block", F.floor(F.monotonically_increasing_id() / most))
    return df.groupBy(*keys, "_block").agg(F.collect_list(F.struct(*columns)).alias(name)).drop("_block")


def member_interval_join(
    df: DataFrame,
    periods: DataFrame,
    member: str,
    at: str,
    members: str = "network_sectors",
    start: str = "start_year",
    end: str = "end_year",
    how: str = "left",
    bin_width: int = 16,
    tasks: int | None = None,
) -> DataFrame:
    """Match rows to periods whose member array holds the row's member and whose interval holds its year.

    The axis is cut into bins; a period takes one row for each of its members and bins, so that member and bin are an
    equi-join and the interval a check on the rows that meet: a row meets a period in one bin at most. As written with
    array_contains and BETWEEN it would be a nested loop over both sides. The bins also split a member with most of the
    rows or periods over many tasks. Choose them about as wide as the usual period. A bin of one unit leaves no pair to be
    checked in vain; that pays where the result is far larger than both sides. There, also deal both sides to a number of
    ``tasks``: adaptive execution counts the input only, and leaves a large result of it to a few. An inner join then also
    pairs both sides block by block, so that values repeat at short distances and the result is stored in fewer bytes a row.
    """
    bin_of = lambda c: F.floor(c / bin_width).cast("long")
    exploded = (
        periods.withColumn("_member", F.explode(members)).filter(F.col(start) <= F.col(end))
        .withColumn("_bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end)))))
        .drop(members)
    )
    if tasks:
        df = df.repartition(tasks, df[member], bin_of(df[at]))
        exploded = exploded.repartition(tasks, "_member", "_bin")
        if how == "inner":
            rows = _in_blocks(df.withColumn("_at", bin_of(F.col(at))), [member, "_at"], [at], df.columns, ROWS_BLOCK, "_rows")
            columns = [c for c in exploded.columns if c not in ("_member", "_bin")]
            packed = _in_blocks(exploded, ["_member", "_bin"], [start, end], columns, PERIODS_BLOCK, "_periods")
            met = packed.hint("merge").join(rows, (F.col("_member") == F.col(member)) & (F.col("_bin") == F.col("_at")))
            # Generated code holds what it makes of a row until the row is done: coalesce keeps the join, with all blocks that
            # a block meets, apart from the pairs, of which so only those of two blocks are held.
            pairs = met.select("_rows", "_periods").coalesce(tasks).select(F.explode("_rows").alias("_row"), "_periods")
            pairs = pairs.select("_row", F.explode("_periods").alias("_period"))
            return pairs.filter(F.col("_row")[at].between(F.col("_period")[start], F.col("_period")[end])).select("_row.*", "_period.*")
    holds = (df[at] >= exploded[start]) & (df[at] <= exploded[end])
    joined = df.join(exploded, (df[member] == exploded["_member"]) & (bin_of(df[at]) == exploded["_bin"]) & holds, how)
    return joined.drop("_member", "_bin")


def first_match_fill(
    df: DataFrame, other: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]
) -> DataFrame:
    """Fill a NULL value from the first matching row of another table."""
    found = first_per_key(other, keys, order).select(*keys, F.col(value).alias("_found"))
    return df.join(found, list(keys), "left").withColumn(value, F.coalesce(value, "_found")).drop("_found")


def same_year_else_max(
    df: DataFrame, other: DataFrame, entity: Sequence[str], value: str, year: str = "year"
) -> DataFrame:
    """Add a value from the same year, or the largest value the entity has in any year."""
    yearly = other.groupBy(year, *entity).agg(F.max(value).alias("_same"))
    overall = other.groupBy(*entity).agg(F.max(value).alias("_any"))
    joined = df.join(yearly, [year, *entity], "left").join(overall, list(entity), "left")
    return joined.withColumn(value, F.coalesce("_same", "_any")).drop("_same", "_any")


def spine_join(spine: DataFrame, frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left join several aggregates of unique keys to a key spine."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), frames, spine)


def universe_join(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All keys of any frame, with the columns of every frame.

    One chain of full-outer joins instead of a distinct union joined back: every frame is read and shuffled once.
    """
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)


def unmatched(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner in the reference."""
    return df.join(reference.select(*keys).distinct(), list(keys), "left_anti")


def lagged_pairs(
    left: DataFrame,
    right: DataFrame,
    entity: str,
    x: str,
    y: str,
    shift: int = 1,
    same_year_fallback: bool = True,
    year: str = "year",
) -> DataFrame:
    """Pairs of x in year t and the mean of y in year t + shift; pairs of the same year when there is no such pair.

    Both sides are reduced to one row per entity and year first, and with the fallback stored: the probe of the first
    pairs and the pairs taken read them, not the tables above.
    """
    xs = left.groupBy(entity, year).agg(F.sum(x).alias(x))
    ys = right.groupBy(entity, year).agg(F.avg(y).alias(y))
    if same_year_fallback:
        xs, ys = stored(xs), stored(ys)
    shifted = xs.join(ys.withColumn(year, F.col(year) - shift), [entity, year]).select(entity, year, x, y)
    if not same_year_fallback:
        return shifted
    return first_nonempty([shifted, xs.join(ys, [entity, year]).select(entity, year, x, y)])


def outer_merge_fill(
    left: DataFrame, right: DataFrame, keys: Sequence[str], fill: dict[str, float] | float = 0.0
) -> DataFrame:
    """Full-outer merge of two aggregates with gaps filled."""
    return left.join(right, list(keys), "full_outer").fillna(fill)


def pair_or_latest(left: DataFrame, right: DataFrame, entity: str, x: str, y: str, year: str = "year") -> DataFrame:
    """x and y of the same entity and year; when nothing meets, the entity's mean x with its latest y.

    Both sides are stored once reduced, as the probes and the result read them.
    """
    xs = stored(left.groupBy(entity, year).agg(F.avg(x).alias(x)))
    ys = stored(right.groupBy(entity, year).agg(F.avg(y).alias(y)))
    matched = xs.join(ys, [entity, year]).select(entity, year, x, y)
    means = xs.groupBy(entity).agg(F.avg(x).alias(x))
    latest = ys.groupBy(entity).agg(F.max(year).alias(year), F.max_by(y, year).alias(y))
    return first_nonempty([matched, means.join(latest, entity).select(entity, year, x, y)])
