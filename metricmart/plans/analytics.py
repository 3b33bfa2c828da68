"""Analytic post-processing over reads and marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricmart.functions.labels import composite_label
from metricmart.functions.numeric import bubble_size, present_mean
from metricmart.functions.periods import backfilled_period
from metricmart.operators import filters
from metricmart.operators.aggregates import coverage, emission_intensity
from metricmart.operators.conform import canonical_lookup, latest_only, with_canonical_name
from metricmart.operators.joins import lagged_pairs, pair_or_latest
from metricmart.operators.pivot import entity_or_mean_series, pivot_dynamic, top_series_pivot
from metricmart.operators.quality import alerts
from metricmart.operators.ranking import composite_score, median_filled, top_n
from metricmart.operators.stats import pearson, shock, simple_fit, trend_forecast
from metricmart.session import stored


def threshold_alerts(availability: DataFrame, losses: DataFrame) -> DataFrame:
    """Mean availability under 99 %, or a yearly loss above 100 GWh."""
    up = filters.metrics(availability, ["network_availability_pct"])
    return alerts(
        [
            ("availability_below_guide", up, F.avg("value"), "<", 99.0),
            ("loss_above_100_gwh", losses, F.max("ens_mwh"), ">", 100_000.0),
        ]
    )


def churn_against_volatility(churn: DataFrame, volatility: DataFrame) -> DataFrame:
    """Mean churn and baseload volatility of the same month."""
    level = churn.groupBy("period_date").agg(F.avg("value").alias("churn"))
    rows = filters.metrics(volatility, ["volatility_electricity_baseload"])
    return level.join(rows.groupBy("period_date").agg(F.avg("value").alias("volatility")), "period_date")


def share_against_price(share: DataFrame, price: DataFrame) -> DataFrame:
    """Renewable share and power price of the same year."""
    return share.join(price, "year")


def ratio_against_cost(primary: DataFrame, proxy: DataFrame) -> DataFrame:
    """Energy ratio and the mean network cost over the network types present."""
    columns = ["elec_tx_avg_gbp", "elec_dx_avg_gbp", "gas_tx_avg_gbp", "gas_dx_avg_gbp"]
    joined = primary.select("year", "energy_ratio").join(proxy, "year")
    return joined.withColumn("avg_network_gbp", present_mean(*[F.col(c) for c in columns]))


def underperformers(regulatory: DataFrame, return_loss: DataFrame, n: int = 3) -> DataFrame:
    """Companies with high return and losses and low satisfaction; gaps take the median."""
    losses = return_loss.groupBy("company_name").agg(F.avg("ens_mwh").alias("ens"))
    means = regulatory.groupBy("company_name").agg(
        F.avg("rore_pct").alias("rore"), F.avg("satisfaction_score").alias("sat")
    )
    # One row per company, read by the medians, the scores and the result.
    rows = median_filled(stored(means.join(losses, "company_name", "left")), ["rore", "ens", "sat"])
    scored = composite_score(rows, {"rore": 1.0, "ens": 1.0, "sat": -1.0}, "bad")
    return top_n(scored.select("company_name", "rore", "ens", "sat", "bad"), "bad", n, ["company_name"])


def input_share_coverage(impact: DataFrame) -> DataFrame:
    """How many impact rows carry an input share, per year."""
    return coverage(impact, ["year"], "intermediate_consumption_share")


def loss_forecast(series: DataFrame, last: int, ahead: int = 3) -> DataFrame:
    """Linear trend of a company's losses and the next years."""
    return trend_forecast(series, ["metric_name"], "year", "ens_mwh", last, ahead)


def risk_shock(impact: DataFrame, percent: float) -> DataFrame:
    """Output at risk per industry under a scenario."""
    return shock(impact, ["industry_name"], "output_at_risk_gbp", percent)


def strongest_series(digest: DataFrame, n: int) -> DataFrame:
    """The n strongest series of a statistical table, one column each."""
    label = composite_label([F.col("row_label"), F.col("column_label")])
    rows = digest.filter("period_year is not null and value is not null").withColumn(
        "series", F.coalesce(F.nullif(label, F.lit("")), F.lit("_series"))
    )
    return top_series_pivot(rows, "period_year", "series", "value", n)


def undergrounding_pairs(cables: DataFrame, minutes: DataFrame) -> DataFrame:
    """Cable length and minutes lost a year later, else of the same year."""
    return lagged_pairs(cables, minutes, "company_name", "value", "minutes_lost", shift=1)


def connection_spend_pairs(connections: DataFrame, spend: DataFrame) -> DataFrame:
    """Connection activity and the spend of the year before."""
    return lagged_pairs(
        connections, spend, "company_name", "connections_activity", "actual_totex_million_gbp", shift=-1,
        same_year_fallback=False,
    )


def risk_against_loss(risk: DataFrame, lost: DataFrame) -> DataFrame:
    """Risk metric and gas lost of the same company and year, else the latest loss."""
    rows = risk.withColumnRenamed("value", "risk_metric")
    return pair_or_latest(rows, lost, "company_name", "risk_metric", "gas_lost_volume")


def implied_intensity(mix: DataFrame) -> DataFrame:
    """Implied emission intensity per period of a generation mix."""
    return emission_intensity(mix, ["period_date"], "fuel_source", "twh")


def sized_points(df: DataFrame, value: str) -> DataFrame:
    """Marker sizes relative to the largest value."""
    largest = df.agg(F.max(F.coalesce(F.col(value).cast("double"), F.lit(0.0)))).scalar()
    return df.withColumn("marker_size", bubble_size(F.col(value), largest))


def latest_snapshot(df: DataFrame, metrics: Sequence[str], year: str = "year") -> DataFrame:
    """Rows of the latest year that carry at least one of the metrics."""
    return latest_only(df, year).dropna(how="all", subset=list(metrics))


def with_period(df: DataFrame) -> DataFrame:
    """Quarterly rows with a period date, back-filled from year and quarter."""
    return df.withColumn("period", backfilled_period(F.col("period_date"), F.col("year"), F.col("quarter")))


def operator_means(fuel: DataFrame, minutes: DataFrame, alias: DataFrame, sector: str = "GD") -> DataFrame:
    """Mean fuel-poor connections and minutes lost of operators that have both."""
    lookup = canonical_lookup(alias, sector)

    def mean(df: DataFrame, column: str, name: str) -> DataFrame:
        named = with_canonical_name(df, lookup, "company_name", "operator_key")
        return named.groupBy("operator_key").agg(F.avg(column).alias(name))

    return mean(fuel, "value", "fuel_poor_avg").join(mean(minutes, "minutes_lost", "minutes_lost_avg"), "operator_key")


def scheme_series(rows: DataFrame) -> DataFrame:
    """Scheme metric per year: by entity when entities are named, else the mean."""
    return entity_or_mean_series(rows, "calendar_year", "entity", "value")


def obligation_matrix(suppliers: DataFrame) -> DataFrame:
    """Obligation amounts by supplier and method in columns."""
    rows = suppliers.filter("obligation_amount_mgbp is not null and supplier_name is not null")
    return pivot_dynamic(rows, ["supplier_name"], "obligation_method", "obligation_amount_mgbp", "sum")


def redistribution(suppliers: DataFrame) -> DataFrame:
    """Money redistributed per supplier, smallest first."""
    rows = suppliers.filter("redistributed_mgbp is not null and supplier_name is not null")
    sums = rows.groupBy("supplier_name").agg(F.sum("redistributed_mgbp").alias("redistributed_mgbp"))
    return sums.orderBy("redistributed_mgbp", "supplier_name")


def changes_present(cost: DataFrame) -> DataFrame:
    """Yearly component changes, without years that have none."""
    columns = ["wholesale_yoy_change", "network_yoy_change", "policy_yoy_change", "total_yoy_change"]
    return cost.select("year", *columns).dropna(how="all", subset=columns)


def spread_complaints_fit(volatility: DataFrame) -> DataFrame:
    return simple_fit(volatility, "spark_spread_avg", "complaints_received_per_100k_avg")


def margin_satisfaction_fit(quality: DataFrame) -> DataFrame:
    return simple_fit(quality, "pretax_domestic_margin_pct", "satisfaction_pct_avg")


def indicators_of_year(indicators: DataFrame, year: int | None = None) -> DataFrame:
    """Indicators of a reference year (the latest by default) with composite labels."""
    rows = latest_only(indicators, "reference_year") if year is None else indicators.filter(
        F.col("reference_year") == year
    )
    label = F.concat(F.col("row_code"), F.lit(" — "), F.coalesce("row_label", F.lit("")))
    return rows.withColumn("label", label).orderBy(F.col("row_no").asc_nulls_last(), "row_code")


def metrics_by_period(df: DataFrame) -> DataFrame:
    """Mean of each metric per period, one column per metric."""
    return pivot_dynamic(df.filter("period_start_date is not null"), ["period_start_date"], "metric_name", "value", "avg")


def promoter_scores(satisfaction: DataFrame) -> DataFrame:
    """Promoter score per supplier."""
    rows = filters.metrics(satisfaction, ["nps_score"])
    return rows.select("supplier_name", "value").dropna()


def risk_loss_correlation(pairs: DataFrame) -> DataFrame:
    return pearson(pairs, "risk_metric", "gas_lost_volume")
