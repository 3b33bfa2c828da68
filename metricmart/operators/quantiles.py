"""Exact percentiles of groups that need not fit into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.session import stored


# Rank error of a percentile sketch, and how far (as a share of the rows) the first cuts lie from a wanted rank: an error
# that grew while sketches were merged still leaves the rank between its cuts.
SKETCH_ACCURACY = 10_000
MARGIN = 5 / SKETCH_ACCURACY


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    task_rows: int = 1_000_000,
    parts: int = 64,
) -> DataFrame:
    """Interpolated percentiles per group, exact for any group size. Runs a counting job, and a few more for large groups.

    ``percentile`` keeps every distinct value of a group in one task. Here a group is one region at first. Regions with
    more than ``task_rows`` rows and more than one value are cut by an approximate pass: first close to both sides of
    every wanted rank, later into ``parts`` equal ones. The values equal to a cut and those between cuts are counted
    exactly, and only what holds a wanted rank goes on; each round takes at least the values of one cut out of a region.
    Then each region is ordered in one task. Bad cuts make a region larger, never the result wrong.

    Rows are never shuffled for a cut: there is at most one region per ``task_rows`` rows to cut, so its cuts are broadcast.
    """
    keys = list(keys)
    region = [*keys, "_offset"]
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"), F.lit(0).cast("long").alias("_offset"))
    totals = stored(rows.groupBy(*keys).agg(F.count("*").alias("_n"), (F.min("_v") < F.max("_v")).alias("_varies")))

    def ranks(p: float) -> tuple[Column, Column, Column]:
        position = F.lit(p) * (F.col("_n") - 1)
        return F.floor(position), F.ceil(position), position

    def inside(rank: Column, low: Column, size: Column) -> Column:
        return (rank >= low) & (rank < low + size)

    regions = totals.select(*keys, F.lit(0).cast("long").alias("_offset"), F.col("_n").alias("_size"), "_varies", "_n")
    too_large = F.coalesce("_varies", F.lit(False)) & (F.col("_size") > task_rows)
    grid = sorted({min(max(p + side, 0.0), 1.0) for p in quantiles.values() for side in (-MARGIN, MARGIN)})
    accuracy = SKETCH_ACCURACY
    counts, candidates = [], rows
    while not regions.filter(too_large).isEmpty():
        large = regions.filter(too_large)
        if not regions.filter(~too_large).isEmpty():
            counts.append(_value_counts(_join_on(candidates, F.broadcast(large.select(*region)), region, "left_anti"), region))
        inner = _join_on(candidates, F.broadcast(large.select(*region)), region)
        cuts = stored(inner.groupBy(*region).agg(F.percentile_approx("_v", grid, accuracy).alias("_cuts")))
        # Part of a row: even between cuts, odd at a cut. A sum of comparisons stays in generated code, and is in the
        # order of the values for any cuts.
        cut = [F.col("_cuts")[i] for i in range(len(grid))]
        part = reduce(lambda a, b: a + b, [(F.col("_v") > c).cast("int") + (F.col("_v") >= c).cast("int") for c in cut])
        placed = _join_on(candidates, F.broadcast(cuts), region).withColumn("_part", part).drop("_cuts")
        counted = placed.groupBy(*region, "_part").agg(
            F.count("*").alias("_size"), F.min("_v").alias("_low"), (F.min("_v") < F.max("_v")).alias("_varies")
        )
        before = Window.partitionBy(*region).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = counted.withColumn("_start", F.col("_offset") + F.coalesce(F.sum("_size").over(before), F.lit(0)))
        wanted = reduce(
            lambda a, b: a | b,
            [inside(r, F.col("_start"), F.col("_size")) for p in quantiles.values() for r in ranks(p)[:2]],
        )
        kept = stored(_join_on(starts, F.broadcast(large.select(*region, "_n")), region).filter(wanted))
        settled = kept.filter(~F.col("_varies"))
        counts.append(settled.select(*keys, F.col("_start").alias("_offset"), F.col("_low").alias("_v"), F.col("_size").alias("_c")))
        varying = kept.filter("_varies")
        found = _join_on(placed, F.broadcast(varying.select(*region, "_part", "_start")), [*region, "_part"])
        candidates = stored(found.select(*keys, "_v", F.col("_start").alias("_offset")))
        regions = varying.select(*keys, F.col("_start").alias("_offset"), "_size", "_varies", "_n")
        grid, accuracy = [i / parts for i in range(1, parts)], 32 * parts
    counted = reduce(DataFrame.unionByName, [*counts, _value_counts(candidates, region)])
    upto = Window.partitionBy(*region).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _join_on(counted.withColumn("_start", F.col("_offset") + F.sum("_c").over(upto) - F.col("_c")), totals.drop("_varies"), keys)

    picks = []
    for name, p in quantiles.items():
        low, high, _ = ranks(p)
        here = F.col("_start"), F.col("_c")
        picks += [
            F.max(F.when(inside(low, *here), F.col("_v"))).alias(f"_lo_{name}"),
            F.max(F.when(inside(high, *here), F.col("_v"))).alias(f"_hi_{name}"),
        ]
    picked = ranked.groupBy(*keys, "_n").agg(*picks)

    def interpolated(name: str, p: float) -> Column:
        low, _, position = ranks(p)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (position - low)).alias(name)

    return picked.select(*keys, *[interpolated(n, p) for n, p in quantiles.items()])


def _value_counts(rows: DataFrame, region: Sequence[str]) -> DataFrame:
    return rows.groupBy(*region, "_v").agg(F.count("*").alias("_c"))


def column_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Exact percentiles of several columns, one row per column: the columns become groups of one long table."""
    values = [F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    long = df.select(*values).unpivot([], list(columns), "column_name", "value")
    return exact_quantiles(long, ["column_name"], "value", quantiles)


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys match; without keys, the right side is one row for all."""
    if not keys:
        facts = right.select(F.struct("*").alias("_f")).scalar()
        return left.withColumns({c: facts.getField(c) for c in right.columns})
    renamed = right.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_g_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_g_{k}" for k in keys])


def approximate_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float], accuracy: int = 10000
) -> DataFrame:
    """The cheaper, opt-in variant: one pass, rank error at most 1/accuracy."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, p, accuracy).cast("double").alias(n) for n, p in quantiles.items()]
    )
