"""Regression, correlation, trends and distribution statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.quantiles import column_quantiles
from metricmart.session import stored


def simple_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least squares of y on x with r, R² and the t-statistic; no row for under two points or a constant x.

    ``with_p_values`` adds the p-value.
    """
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    points = df.filter(xs.isNotNull() & ys.isNotNull())
    fitted = points.groupBy(*keys).agg(
        F.regr_count(ys, xs).cast("bigint").alias("n"),
        F.regr_slope(ys, xs).alias("slope"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.corr(ys, xs).alias("r"),
        F.min(xs).alias("_low"),
        F.max(xs).alias("_high"),
    )
    fitted = fitted.filter((F.col("n") >= 2) & (F.col("_low") < F.col("_high"))).drop("_low", "_high")
    return fitted.withColumns({"r2": F.col("r") * F.col("r"), "t_stat": t_statistic(F.col("r"), F.col("n"))})


def t_statistic(r: Column, n: Column) -> Column:
    """t of a correlation; NULL where it is perfect or has no degrees of freedom."""
    return r * F.sqrt(F.try_divide((n - 2).cast("double"), F.greatest(1 - r * r, F.lit(0.0))))


def pearson(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Correlation, number of pairs and t-statistic."""
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    result = pairs.groupBy(*keys).agg(F.corr(x, y).alias("pearson_r"), F.count("*").alias("pair_count"))
    return result.withColumn("t_stat", t_statistic(F.col("pearson_r"), F.col("pair_count")))


def _log_half_step(a: Column, shift: int = 16) -> Column:
    """ln of Γ(a + 1/2) / Γ(a): its series at ``a + shift``, carried back by the recurrence."""
    z = a + F.lit(shift)
    total = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * F.pow(z, F.lit(3))) - 1 / (640 * F.pow(z, F.lit(5)))
    for k in range(shift):
        total = total + F.log((a + F.lit(k)) / (a + F.lit(k + 0.5)))
    return total


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """Continued fraction of the incomplete beta function, two terms a step."""
    d0 = 1 / (1 - (a + b) * x / (a + 1))

    def step(state: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d1, c1 = 1 / (1 + even * state["d"]), 1 + even / state["c"]
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d2, c2 = 1 / (1 + odd * d1), 1 + odd / c1
        return F.struct(c2.alias("c"), d2.alias("d"), (state["h"] * d1 * c1 * d2 * c2).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda state: state["h"])


def student_two_sided(t: Column, dof: Column, steps: int = 100) -> Column:
    """Two-sided p-value of Student's t: a fixed number of steps for any number of degrees of freedom.

    The regularised incomplete beta function of dof/2 and 1/2 by its continued fraction, on the side where that
    converges. NULL without a degree of freedom. Beyond some 10^9 degrees of freedom about five digits are right.
    """
    nu, square = dof.cast("double") / 2, t * t
    x = 2 * nu / (2 * nu + square)
    rest = square / (2 * nu + square)
    front = F.exp(_log_half_step(nu) - F.lit(math.log(math.pi) / 2) - nu * F.log1p(square / (2 * nu))) * F.sqrt(rest)
    half = F.lit(0.5)
    direct = x < (nu + 1) / (nu + 2.5)
    tail = F.when(direct, front * _beta_fraction(nu, half, x, steps) / nu).otherwise(1 - front * _beta_fraction(half, nu, rest, steps) / half)
    return F.when(dof >= 1, F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def with_p_values(df: DataFrame, n: str = "n", t: str = "t_stat") -> DataFrame:
    """Add the p-value to fitted rows."""
    return df.withColumn("p_value", student_two_sided(F.col(t), F.col(n) - 2))


def trend_forecast(
    df: DataFrame, keys: Sequence[str], period: str, value: str, last: int, ahead: int = 3, min_points: int = 3
) -> DataFrame:
    """Linear trend per entity (gaps count as zero) and its next ``ahead`` periods after ``last``."""
    filled = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    x = F.col(period).cast("double")
    fitted = df.groupBy(*keys).agg(
        F.regr_slope(filled, x).alias("slope"),
        F.regr_intercept(filled, x).alias("intercept"),
        F.count("*").alias("_points"),
    )
    fitted = fitted.filter(F.col("_points") >= min_points).drop("_points")
    future = fitted.withColumn(period, F.explode(F.sequence(F.lit(last + 1), F.lit(last + ahead))))
    return future.withColumn("forecast", F.col("intercept") + F.col("slope") * F.col(period))


def shock(df: DataFrame, keys: Sequence[str], value: str, percent: float) -> DataFrame:
    """Group sums and the same sums scaled by a percentage."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("baseline"))
    return sums.withColumn("shocked", F.col("baseline") * F.lit(1.0 + percent / 100.0))


def missing_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("missing"))
                           for c in df.columns]))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles of each column, one row per column."""
    values = [F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    long = df.select(*values).unpivot([], list(columns), "column_name", "value")
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev("value").alias("sd"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )
    return moments.join(column_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}), "column_name", "left")


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value; empty bins are listed too."""
    value = F.col(column).cast("double")
    facts = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("f")).scalar()
    low, width = facts.getField("low"), (facts.getField("high") - facts.getField("low")) / bins
    bin_no = F.least(F.floor(F.try_divide(value - low, width)) + 1, F.lit(bins)).cast("int")
    counts = df.filter(value.isNotNull()).groupBy(F.coalesce(bin_no, F.lit(1)).alias("bin")).agg(
        F.count("*").alias("n")
    )
    axis = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return axis.join(counts, "bin", "left").select(
        "bin", (low + width * (F.col("bin") - 1)).alias("bin_low"), (low + width * F.col("bin")).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def box_plot(df: DataFrame, columns: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside the fences, one row per column. Runs the jobs of the quartiles."""
    boxes = column_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    boxes = boxes.withColumns(
        {"low_fence": F.col("q1") - whisker * spread, "high_fence": F.col("q3") + whisker * spread}
    )
    boxes = stored(boxes)
    # The fences are one row for all: values are counted where they are read, neither turned long nor joined.
    fence = {(c, f): F.max(F.when(F.col("column_name") == c, F.col(f))) for c in columns for f in ("low_fence", "high_fence")}
    facts = boxes.agg(F.struct(*[v.alias(f"{f} {c}") for (c, f), v in fence.items()])).scalar()
    counts = df.agg(*[
        F.count_if((v < facts.getField(f"low_fence {c}")) | (v > facts.getField(f"high_fence {c}"))).alias(c)
        for c in columns for v in [F.col(f"`{c}`").cast("double")]
    ])
    outliers = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("outliers")) for c in columns])))
    return boxes.join(outliers, "column_name")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the correlation matrix as long rows, from one aggregation."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"c{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric correlation matrix as long rows."""
    upper = correlation_pairs(df, columns)
    both = F.array(
        F.struct(F.col("column_a"), F.col("column_b"), F.col("r")),
        F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), F.col("r")),
    )
    mirrored = upper.select(F.inline(both))
    diagonal = df.agg(*[F.count(c).alias(c) for c in columns]).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_a"), F.lit(c).alias("column_b"),
                             F.when(F.col(f"`{c}`") > 0, F.lit(1.0)).alias("r"))
                    for c in columns
                ]
            )
        )
    )
    return mirrored.unionByName(diagonal)


def correlated_groups(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """For each column, the other columns correlated with it at least that strongly."""
    strong = correlation_matrix(df, columns).filter(
        (F.col("column_a") != F.col("column_b")) & (F.abs("r") >= threshold)
    )
    return strong.groupBy(F.col("column_a").alias("column_name")).agg(
        F.concat_ws(",", F.array_sort(F.collect_list("column_b"))).alias("correlated_with")
    )
