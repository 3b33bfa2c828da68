"""Core facts: staging rows → dimension ids → (mean per key where the source may repeat) → upsert.

Dimension lookups are plain equi-joins on unique keys. Dimensions are small against facts and Spark broadcasts them
while their size allows; past that, adaptive execution splits skewed keys. A row that a required lookup finds nothing for
stays with a mark until the load, which leaves it out, counts it and keeps it apart (``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.aggregates import dedupe_average
from metricmart.operators.audit import assert_unique
from metricmart.operators.upsert import empty_like, upsert
from metricmart.session import stored
from metricmart.sources.versions import PartitionedFact, loadable, noted

Target = DataFrame | PartitionedFact | None


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables the loads look ids up in."""

    dates: DataFrame
    geographies: DataFrame
    sectors: DataFrame
    companies: DataFrame
    industries: DataFrame
    suppliers: DataFrame
    payment_methods: DataFrame
    supplier_sizes: DataFrame


def lookup(df: DataFrame, dimension: DataFrame, on: Mapping[str, str], id_column: str, how: str = "inner") -> DataFrame:
    """Add the id of a dimension row; ``on`` maps fact columns to dimension columns. ``inner`` marks rows without one."""
    keys = dimension.select(F.col(id_column), *[F.col(d).alias(f"_k_{d}") for d in on.values()])
    condition = None
    for fact, dim in on.items():
        test = df[fact] == keys[f"_k_{dim}"]
        condition = test if condition is None else condition & test
    found = df.join(keys, condition, "left").drop(*[f"_k_{d}" for d in on.values()])
    return found if how == "left" else noted(found, F.col(id_column), "/".join(on))


def annual(df: DataFrame, dims: Dimensions, how: str = "inner") -> DataFrame:
    """Add the id of the annual date row."""
    return lookup(df, dims.dates.filter(F.col("quarter").isNull()), {"year": "year"}, "date_id", how)


def dated(df: DataFrame, dims: Dimensions, how: str = "inner") -> DataFrame:
    """Add the id of the quarterly row, or of the annual row where the quarter is NULL."""
    dates = dims.dates.select("date_id", F.col("year").alias("_y"), F.col("quarter").alias("_q"))
    found = df.join(dates, (df["year"] == dates["_y"]) & df["quarter"].eqNullSafe(dates["_q"]), "left").drop("_y", "_q")
    return found if how == "left" else noted(found, F.col("date_id"), "year/quarter")


def at_home(df: DataFrame, dims: Dimensions, code: str = "GB") -> DataFrame:
    """Add the id of the one home geography: a scalar, not a join."""
    home = dims.geographies.filter(F.col("geography_code") == code).agg(F.max("geography_id")).scalar()
    return noted(df.withColumn("geography_id", home), F.col("geography_id"), "home geography")


def company(df: DataFrame, dims: Dimensions, how: str = "inner") -> DataFrame:
    return lookup(df, dims.companies, {"company_name": "company_name"}, "company_id", how)


def sector(df: DataFrame, dims: Dimensions, how: str = "inner") -> DataFrame:
    return lookup(df, dims.sectors, {"network_sector": "sector_code"}, "network_sector_id", how)


def industry(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims.industries, {"sic_code": "sic_code"}, "industry_id")


def supplier(df: DataFrame, dims: Dimensions, how: str = "left") -> DataFrame:
    return lookup(df, dims.suppliers, {"supplier_name": "supplier_name"}, "supplier_id", how)


def payment_method(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims.payment_methods, {"payment_method": "payment_method"}, "payment_method_id", "left")


def supplier_size(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims.supplier_sizes, {"supplier_size": "size_band"}, "supplier_size_id", "left")


def store(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], target: Target, only_where: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert the loaded rows into the existing fact, or start it. A key that repeats in the rows is an error.

    ``prepare`` makes one row a key where the source may repeat. A ``PartitionedFact`` is merged in place, partition by
    partition; a table gives its next snapshot. Runs one job: the rows are stored before their keys are checked.
    """
    if isinstance(target, PartitionedFact):
        return target.merge(rows, keys, columns, only_where, prepare)
    accepted = loadable(rows)
    source = stored((prepare(accepted) if prepare else accepted).select(*columns))
    assert_unique(source, keys, "the rows to load")
    return upsert(target if target is not None else empty_like(source), source, keys, only_where)


def network_reliability(
    staged: DataFrame, context: DataFrame, dims: Dimensions, target: Target = None
) -> DataFrame:
    """Reliability with national totals: demand for electricity sectors, supply for gas sectors."""

    def national(commodity: str, metric: str, name: str) -> DataFrame:
        total = context.filter(
            (F.col("commodity") == commodity) & (F.col("fuel_source") == "TOTAL") & (F.col("metric_name") == metric)
        )
        return total.select("year", F.col("value").alias(name))

    sectors = dims.sectors.select("network_sector_id", "commodity")
    rows = sector(company(at_home(annual(staged, dims), dims), dims), dims).join(sectors, "network_sector_id", "left")
    rows = rows.join(national("electricity", "generation_total_twh", "_twh"), "year", "left")
    rows = rows.join(national("gas", "gas_supply_total", "_supply"), "year", "left")
    rows = rows.withColumns(
        {
            "total_demand_mwh": F.when(F.col("commodity") == "electricity", F.col("_twh") * 1_000_000.0),
            "total_gas_supply": F.when(F.col("commodity") == "gas", F.col("_supply")),
        }
    )
    keys = ["date_id", "geography_id", "company_id", "network_sector_id"]
    measures = [
        "ens_mwh", "customer_interruptions", "minutes_lost", "gas_interruption_volume", "gas_lost_volume",
        "total_demand_mwh", "total_gas_supply",
    ]
    return store(rows, keys, [*keys, *measures], target)


def _per_company(
    staged: DataFrame, dims: Dimensions, measures: Sequence[str], target: Target
) -> DataFrame:
    keys = ["date_id", "company_id", "network_sector_id"]
    return store(sector(company(annual(staged, dims), dims), dims), keys, [*keys, *measures], target)


def financial_performance(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    measures = ["totex_allowance_million_gbp", "actual_totex_million_gbp", "rore_pct"]
    return _per_company(staged, dims, measures, target)


def emissions(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    return _per_company(staged, dims, ["sf6_kg", "carbon_footprint_tco2e"], target)


def customer_metrics(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    """Customer metrics; a company or sector the dimensions lack stays as NULL and still matches NULL."""
    rows = annual(staged, dims)
    rows = lookup(rows, dims.geographies, {"geography_code": "geography_code"}, "geography_id")
    rows = sector(company(rows, dims, "left"), dims, "left")
    keys = ["date_id", "geography_id", "company_id", "network_sector_id"]
    return store(rows, keys, [*keys, "cost_per_customer_gbp", "satisfaction_score"], target)


def energy_intensity(
    staged: DataFrame, fuel_use: DataFrame, dims: Dimensions, target: Target = None
) -> DataFrame:
    """Intensity with the fuel mix of the same year and industry."""
    mix = fuel_use.select(
        "year", "sic_code", F.col("electricity_pct").alias("electricity_pct_of_total_energy"),
        F.col("gas_pct").alias("gas_pct_of_total_energy"),
    )
    rows = industry(annual(staged.join(mix, ["year", "sic_code"], "left"), dims), dims)
    keys = ["date_id", "industry_id"]
    measures = [
        "kwh_per_gva", "electricity_pct_of_total_energy", "gas_pct_of_total_energy", "energy_intensity_index",
    ]
    return store(rows, keys, [*keys, *measures], target)


def regional_gva(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    rows = lookup(annual(staged, dims), dims.geographies, {"region_code": "geography_code"}, "geography_id")
    keys = ["date_id", "geography_id", "industry_id"]
    return store(industry(rows, dims), keys, [*keys, "gva_million_gbp"], target)


def input_output(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["date_id", "industry_id", "commodity"]
    measures = ["intermediate_consumption_share", "intermediate_consumption_value"]
    return store(industry(annual(staged, dims), dims), keys, [*keys, *measures], target)


def market_prices(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    """Annual price rows. Only target rows without a period label are annual, so only those may be updated."""
    rows = at_home(annual(staged, dims), dims).withColumns(
        {"value": F.col("avg_value"), "period_label": F.lit(None).cast("string")}
    )
    keys = ["year", "commodity", "instrument", "metric_name"]
    columns = ["date_id", "geography_id", *keys, "period_label", "value", "unit"]
    return store(rows, keys, columns, target, F.col("period_label").isNull())


def market_context(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["year", "commodity", "fuel_source", "metric_name"]
    rows = at_home(annual(staged, dims), dims)
    return store(rows, keys, ["date_id", "geography_id", *keys, "value", "unit"], target)


def market_share(staged: DataFrame, target: Target = None) -> DataFrame:
    keys = ["year", "commodity", "company_name"]
    return store(staged, keys, [*keys, "share_pct", "source_file"], target)


def daily_prices(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["period_date", "commodity", "source_name", "metric_name"]
    rows = at_home(annual(staged, dims), dims)
    return store(rows, keys, ["date_id", "geography_id", *keys, "value", "unit"], target)


# Retail facts: name → (id lookups, natural key behind date_id, whether repeats are averaged). Fixed values.
RETAIL_FACTS = {
    "supplier_financial": (["supplier"], ["supplier_id", "segment", "metric_name"], False),
    "consumer_debt": (
        ["payment_method", "supplier"],
        ["commodity", "payment_method_id", "supplier_id", "component", "metric_name"],
        False,
    ),
    "consumer_disconnections": (
        ["payment_method", "supplier"],
        ["commodity", "payment_method_id", "supplier_id", "metric_name"],
        False,
    ),
    "switching_activity": (["supplier_size"], ["commodity", "supplier_size_id", "metric_name"], True),
    "tariff_benchmarks": (
        ["supplier", "payment_method"],
        ["commodity", "supplier_group", "supplier_id", "payment_method_id", "tariff_type", "metric_name"],
        True,
    ),
    "bill_breakdown": (
        ["payment_method"],
        ["commodity", "payment_method_id", "supplier_group", "component", "metric_name"],
        True,
    ),
    "complaints_resolution": (["supplier", "supplier_size"], ["supplier_id", "supplier_size_id", "metric_name"], True),
    "satisfaction_scores": (
        ["supplier", "supplier_size"],
        ["supplier_id", "supplier_size_id", "commodity", "aspect", "metric_name"],
        True,
    ),
    "market_structure": ([], ["commodity", "metric_name"], True),
}
_LOOKUPS = {"supplier": supplier, "payment_method": payment_method, "supplier_size": supplier_size}


def averaging(keys: Sequence[str], value: str = "value", rest: Sequence[str] = ("unit", "source_file")) -> Callable[[DataFrame], DataFrame]:
    """One row a key: the mean of the values."""
    return lambda rows: dedupe_average(rows, keys, value, rest)


def retail_fact(name: str, staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    """Any of the long retail facts: date and id lookups, means of repeats, null-safe upsert."""
    lookups, rest, averaged = RETAIL_FACTS[name]
    rows = staged
    if name == "supplier_financial":
        rows = rows.filter(F.col("segment").isNotNull())
    rows = dated(rows, dims)
    for step in lookups:
        rows = _LOOKUPS[step](rows, dims)
    keys = ["date_id", *rest]
    return store(rows, keys, [*keys, "value", "unit", "source_file"], target, prepare=averaging(keys) if averaged else None)


def market_share_retail(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    """Retail shares; a missing segment is domestic, unknown suppliers are left out."""
    rows = supplier(dated(staged, dims), dims, "inner").withColumn(
        "segment", F.coalesce("segment", F.lit("domestic"))
    )
    keys = ["date_id", "commodity", "supplier_id", "segment"]
    return store(rows, keys, [*keys, "share_pct", "source_file"], target, prepare=averaging(keys, "share_pct", ["source_file"]))


def household_spend(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["date_id", "segment"]
    return store(annual(staged, dims), keys, [*keys, "value_pct", "source_file"], target)


def customer_accounts(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["date_id", "supplier_id", "commodity", "segment", "tariff_type"]
    return store(supplier(annual(staged, dims), dims), keys, [*keys, "value", "unit", "source_file"], target, prepare=averaging(keys))


def heating_systems(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    keys = ["date_id", "component"]
    return store(dated(staged, dims), keys, [*keys, "value", "unit", "source_file"], target, prepare=averaging(keys))


def renewables_obligation(staged: DataFrame, dims: Dimensions, target: Target = None) -> DataFrame:
    """Certificate rows; a period the date dimension lacks keeps its row without a date id."""
    keys = ["obligation_period", "period_label", "technology", "metric_name"]
    rest = ["date_id", "unit", "source_file"]
    return store(dated(staged, dims, "left"), keys, ["date_id", *keys, "value", "unit", "source_file"], target, prepare=averaging(keys, rest=rest))


def scheme_metric(staged: DataFrame, target: Target = None) -> DataFrame:
    """Scheme rows keyed by source, period, scheme, entity and metric."""
    rows = staged.withColumnsRenamed({"year": "calendar_year", "month": "calendar_month"})
    keys = ["source_file", "period_label", "scheme_key", "entity", "metric_name"]
    rest = ["period_date", "calendar_year", "calendar_month", "quarter"]
    return store(rows, keys, [*rest, *keys, "value", "unit"], target, prepare=averaging(keys, rest=[*rest, "unit"]))
