"""Aggregations: filtered aggregates, totals, concentration, monitoring, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions.labels import emission_factor, fuel_key
from metricmart.functions.numeric import ratio, scaled_percent
from metricmart.operators.quantiles import exact_quantiles
from metricmart.session import stored_small

AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def metric(how: str, name: str, value: str = "value", where: Column | None = None) -> Column:
    """``how(value)`` over the rows of one metric, optionally under a further condition."""
    test = F.col("metric_name") == name
    return AGGREGATES[how](F.when(test if where is None else test & where, F.col(value)))


def metric_columns(spec: Mapping[str, tuple], value: str = "value") -> list[Column]:
    """Aggregate columns from ``{column: (how, metric)}`` or ``{column: (how, metric, condition)}``.

    All of them run in one pass over the fact, however many columns a mart has.
    """
    out = []
    for column, (how, name, *rest) in spec.items():
        out.append(metric(how, name, value, rest[0] if rest else None).alias(column))
    return out


def parts_and_totals(
    df: DataFrame, keys: Sequence[str], item: str, value: str, total_label: str = "TOTAL"
) -> DataFrame:
    """Sums per (keys, item) and a total row per keys.

    The raw rows are aggregated once; the totals come from the parts by grouping sets over the reduced rows.
    """
    parts = df.groupBy(*keys, item).agg(F.sum(value).alias(value)).withColumnRenamed(item, "_item")
    sets = [[*[F.col(k) for k in keys], F.col("_item")], [F.col(k) for k in keys]]
    both = parts.groupingSets(sets, *keys, "_item").agg(
        F.sum(value).alias(value), F.grouping("_item").alias("is_total")
    )
    label = F.when(F.col("is_total") == 1, F.lit(total_label)).otherwise(F.col("_item"))
    return both.select(*keys, label.alias(item), value, F.col("is_total").cast("boolean").alias("is_total"))


def dedupe_average(df: DataFrame, keys: Sequence[str], value: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """One row per key: mean value, smallest text of the carried columns."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value), *[F.min(c).alias(c) for c in carry])


def concentration(df: DataFrame, market: Sequence[str], share_pct: str) -> DataFrame:
    """Herfindahl index on the 0-1 scale per market from shares in percent."""
    return df.groupBy(*market).agg(F.sum(F.pow(F.col(share_pct) / 100.0, F.lit(2.0))).alias("hhi_0_1"))


def mean_concentration(df: DataFrame, period: str, commodity: str, share_pct: str) -> DataFrame:
    """Mean over commodities of the 0-1 index, per period."""
    per_market = concentration(df, [period, commodity], share_pct)
    return per_market.groupBy(period).agg(F.avg("hhi_0_1").alias("hhi_0_1"))


def concentration_10000(df: DataFrame, market: Sequence[str], share: str) -> DataFrame:
    """Herfindahl index on the 0-10,000 scale; a market whose shares are fractions is scaled up first.

    The scale is a factor of the whole group, so sum of squares and maximum come from one aggregation; no window.
    """
    squares = df.groupBy(*market).agg(
        F.sum(F.pow(F.col(share).cast("double"), F.lit(2.0))).alias("_squares"), F.max(share).alias("_max")
    )
    scale = scaled_percent(F.lit(1.0), F.col("_max"))
    return squares.select(*market, (F.col("_squares") * scale * scale).alias("hhi_0_10000"))


def monitor(df: DataFrame, keys: Sequence[str], date: str, value: str, spike_quantile: float = 0.95) -> DataFrame:
    """Level, spread, range and spike days (values at or above the group's percentile) per group."""
    rows = df.filter(F.col(value).isNotNull())
    limits = exact_quantiles(rows, keys, value, {"_limit": spike_quantile})
    joined = rows.join(stored_small(limits), list(keys))
    return joined.groupBy(*keys).agg(
        F.count("*").alias("observation_count"),
        F.min(date).alias("first_observation_date"),
        F.max(date).alias("last_observation_date"),
        F.avg(value).alias("avg_daily_value"),
        F.min(value).alias("min_daily_value"),
        F.max(value).alias("max_daily_value"),
        F.stddev_pop(value).alias("volatility_stddev"),
        F.count_if(F.col(value) >= F.col("_limit")).alias("spike_days_ge_p95"),
    )


def coverage(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, rows with a value, mean and percentage covered."""
    counted = df.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count(value).alias("rows_with_value"), F.avg(value).alias("avg_value")
    )
    return counted.withColumn("coverage_pct", 100.0 * F.col("rows_with_value") / F.col("rows"))


def emission_intensity(
    df: DataFrame, keys: Sequence[str], fuel: str, value: str, skip: Sequence[str] = ("total",)
) -> DataFrame:
    """Mean emission factor weighted by output; totals and zero rows do not count."""
    rows = df.filter(~fuel_key(F.col(fuel)).isin(list(skip)) & (F.coalesce(F.col(value), F.lit(0.0)) != 0))
    sums = rows.groupBy(*keys).agg(
        F.sum(F.col(value) * emission_factor(F.col(fuel))).alias("_weighted"), F.sum(value).alias("_total")
    )
    return sums.select(*keys, ratio(F.col("_weighted"), F.col("_total")).alias("kg_co2_per_mwh"))


def share_of_matching(
    df: DataFrame, keys: Sequence[str], value: str, matching: Column, name: str = "share_pct"
) -> DataFrame:
    """Percentage of the total that matching rows hold."""
    sums = df.groupBy(*keys).agg(
        F.sum(F.when(matching, F.col(value))).alias("_part"), F.sum(value).alias("_total")
    )
    return sums.select(*keys, (ratio(F.col("_part"), F.col("_total")) * 100.0).alias(name))


def first_and_last(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """First and last non-NULL value of a series and its change in percent."""
    from metricmart.functions.numeric import percent_change

    rows = df.filter(F.col(value).isNotNull())
    ends = rows.groupBy(*keys).agg(
        F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value")
    )
    return ends.withColumn("change_pct", percent_change(F.col("first_value"), F.col("last_value")))


def null_rates(df: DataFrame) -> DataFrame:
    """Share of NULLs per column, highest first; one pass over the table."""
    rates = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in df.columns])
    long = rates.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.coalesce(f"`{c}`", F.lit(0.0)).alias("null_rate"))
                    for c in df.columns
                ]
            )
        )
    )
    return long.orderBy(F.col("null_rate").desc(), "column_name")
