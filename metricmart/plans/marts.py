"""Marts over the core tables. Each fact is read once: a pivot is one conditional aggregation, however wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions.labels import classify
from metricmart.functions.numeric import any_present, positive_ratio, present_count, ratio
from metricmart.operators import filters
from metricmart.operators.aggregates import mean_concentration, metric, metric_columns, monitor
from metricmart.operators.conform import union_all
from metricmart.operators.joins import member_interval_join, null_safe_join, spine_join, universe_join
from metricmart.operators.pivot import pivot_metrics
from metricmart.operators.ranking import top_n
from metricmart.operators.windows import (
    allocate,
    change_per_change,
    positive_shares,
    with_changes,
    with_lags,
    with_running_totals,
)

Tables = Mapping[str, DataFrame]


def _dates(tables: Tables, *columns: str) -> DataFrame:
    return tables["core_dim_date"].select("date_id", *columns)


def _with_year(df: DataFrame, tables: Tables) -> DataFrame:
    return df.join(_dates(tables, "year"), "date_id")


def _with_names(df: DataFrame, tables: Tables) -> DataFrame:
    companies = tables["core_dim_company"].select("company_id", "company_name", "owner_group")
    sectors = tables["core_dim_network_sector"].select("network_sector_id", "sector_name", "sector_code", "commodity")
    return _with_year(df, tables).join(companies, "company_id").join(sectors, "network_sector_id")


# Column → (aggregate, metric) of the annual price view.
PRICE_COLUMNS = {
    "gas_day_ahead_avg_price": ("avg", "gas_day_ahead_price"),
    "spark_spread_avg": ("avg", "spark_spread_central"),
    "dark_spread_avg": ("avg", "dark_spread"),
    "power_baseload_avg": ("avg", "power_price_baseload"),
    "bid_offer_avg": ("avg", "bid_offer_spread"),
    "summer_winter_spread_avg": ("avg", "summer_winter_spread"),
}
VOLATILITY_COLUMNS = {
    "elec_baseload_volatility": ("avg", "volatility_electricity_baseload"),
    "elec_peakload_volatility": ("avg", "volatility_electricity_peakload"),
    "gas_volatility": ("avg", "volatility_gas"),
}
FUEL_METRICS = ["generation_twh", "generation_total_twh", "gas_supply_mcm_year_sum", "gas_supply_total"]


def market_context(tables: Tables) -> DataFrame:
    """Fuel mix with shares of the positive parts, annual prices, volatility and trading; share rows appended."""
    prices = tables["core_fact_market_prices"]
    keys = ["year", "commodity"]
    fuel = filters.metrics(tables["core_fact_market_context"], FUEL_METRICS).select(
        *keys, "fuel_source", F.col("value").alias("fuel_value"), F.col("unit").alias("fuel_unit")
    )
    mix = positive_shares(fuel, keys, "fuel_value", "fuel_source", name="fuel_share_of_total")
    traded = F.col("commodity").isin("electricity", "gas")
    churn = F.col("instrument") == "churn"
    annual = prices.groupBy(*keys).agg(
        *metric_columns(PRICE_COLUMNS),
        metric("sum", "trading_volume_twh", where=traded & ~churn).alias("trading_volume_total"),
        metric("avg", "trading_volume_twh", where=traded & churn).alias("churn_ratio_avg"),
    )
    volatility = prices.groupBy("year").agg(*metric_columns(VOLATILITY_COLUMNS))
    context = mix.join(annual, keys, "left").join(volatility, "year", "left")
    shares = tables["core_fact_market_share"].select(
        *keys, F.col("company_name").alias("fuel_source"), F.col("share_pct").alias("market_share_pct_2024")
    )
    columns = [
        *keys, "fuel_source", "fuel_value", "fuel_unit", "fuel_share_of_total", "gas_day_ahead_avg_price",
        *VOLATILITY_COLUMNS, *[c for c in PRICE_COLUMNS if c != "gas_day_ahead_avg_price"], "trading_volume_total",
        "churn_ratio_avg", "market_share_pct_2024",
    ]
    return union_all([context, shares]).select(*columns)


def cost_reliability(tables: Tables) -> DataFrame:
    """Loss per spend, reliability, cost efficiency and the regulatory period of each company and year."""
    keys = ["date_id", "company_id", "network_sector_id"]
    facts = tables["core_fact_network_reliability"].select(
        *keys, "ens_mwh", "total_demand_mwh", "minutes_lost", "customer_interruptions"
    ).join(tables["core_fact_financial_performance"], keys)
    named = _with_names(facts, tables)
    spend, allowance = F.col("actual_totex_million_gbp"), F.col("totex_allowance_million_gbp")
    loss = F.col("ens_mwh") / F.col("total_demand_mwh")
    lossy = (F.col("total_demand_mwh") > 0) & (F.col("ens_mwh") > 0) & (allowance > 0)
    base = named.withColumns(
        {
            "ens_per_million_gbp_spend": positive_ratio(F.col("ens_mwh"), spend),
            "reliability_rate": 1 - positive_ratio(F.col("ens_mwh"), F.col("total_demand_mwh")),
            "cost_efficiency_score": F.when(lossy, (spend / allowance) / loss),
            "totex_variance_million_gbp": spend - allowance,
            "totex_actual_to_allowance_ratio": positive_ratio(spend, allowance),
        }
    )
    periods = tables["core_dim_riio_period"].select(
        F.col("scheme").alias("riio_scheme"), "network_sectors", F.col("start_year").alias("riio_start_year"),
        F.col("end_year").alias("riio_end_year"),
    )
    placed = member_interval_join(
        base, periods, "sector_name", "year", start="riio_start_year", end="riio_end_year"
    )
    return placed.select(
        "year", "company_name", "owner_group", "sector_name", "sector_code", "commodity", "actual_totex_million_gbp",
        "totex_allowance_million_gbp", "rore_pct", "ens_mwh", "total_demand_mwh", "minutes_lost",
        "customer_interruptions", "ens_per_million_gbp_spend", "reliability_rate", "cost_efficiency_score",
        "riio_scheme", "riio_start_year", "riio_end_year", "totex_variance_million_gbp",
        "totex_actual_to_allowance_ratio",
    )


# Commodities whose input share counts.
INPUT_COMMODITIES = ["energy", "electricity", "gas", "total_intermediate"]


def economic_impact(tables: Tables) -> DataFrame:
    """The national yearly loss, allocated to regions and industries by their share of value added."""
    loss = _with_year(tables["core_fact_network_reliability"], tables).groupBy("year").agg(
        F.sum(F.coalesce("ens_mwh", F.lit(0.0))).alias("ens_mwh_year_national")
    )
    gva = _with_year(tables["core_fact_regional_gva"], tables)
    spread = allocate(
        gva, loss, ["year"], "gva_million_gbp", "ens_mwh_year_national", "ens_mwh_in_region_industry"
    ).withColumnRenamed("share_of_total", "gva_share_of_national")
    inputs = tables["core_fact_input_output"].filter(F.col("commodity").isin(INPUT_COMMODITIES))
    inputs = inputs.groupBy("date_id", "industry_id").agg(
        F.max("intermediate_consumption_share").alias("intermediate_consumption_share")
    )
    keys = ["date_id", "industry_id"]
    intensity = tables["core_fact_energy_intensity"].select(
        *keys, "kwh_per_gva", "electricity_pct_of_total_energy", "energy_intensity_index"
    )
    rows = spread.join(intensity, keys, "left").join(inputs, keys, "left")
    per_unit = ratio(F.col("gva_million_gbp") * 1_000_000, F.col("kwh_per_gva"))
    rows = rows.withColumns(
        {
            "allocation_method": F.lit("national_gva_share_v1"),
            "industry_gva_per_mwh_weighted": per_unit,
            "output_at_risk_gbp": F.col("ens_mwh_in_region_industry")
            * per_unit
            * F.coalesce("intermediate_consumption_share", F.lit(1.0)),
            "sector_exposure_score": F.coalesce("electricity_pct_of_total_energy", F.lit(0.0))
            * F.coalesce("energy_intensity_index", F.lit(0.0)),
        }
    )
    places = tables["core_dim_geography"].select("geography_id", "geography_code", "geography_name")
    industries = tables["core_dim_industry"].select("industry_id", "sic_code", "industry_name")
    return rows.join(places, "geography_id").join(industries, "industry_id").select(
        "year", "geography_code", "geography_name", "sic_code", "industry_name", "ens_mwh_in_region_industry",
        "ens_mwh_year_national", "gva_share_of_national", "allocation_method", "gva_million_gbp", "kwh_per_gva",
        "intermediate_consumption_share", "industry_gva_per_mwh_weighted", "output_at_risk_gbp",
        "sector_exposure_score",
    )


def cross_commodity_risk(tables: Tables) -> DataFrame:
    """Losses, gas disruption, mean reliability and gas vulnerability per year, region and sector."""
    facts = tables["core_fact_network_reliability"]
    sectors = tables["core_dim_network_sector"].select("network_sector_id", "commodity", "sector_name")
    places = tables["core_dim_geography"].select("geography_id", "geography_name")

    def filled(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    rows = _with_year(facts, tables).join(places, "geography_id").join(sectors, "network_sector_id")
    return rows.groupBy("year", "geography_name", "commodity", "sector_name").agg(
        F.sum(filled("ens_mwh")).alias("ens_mwh"),
        F.sum(filled("gas_interruption_volume") + filled("gas_lost_volume")).alias("gas_disruption_volume"),
        F.avg(1 - positive_ratio(F.col("ens_mwh"), F.col("total_demand_mwh"))).alias("avg_reliability_rate"),
        F.avg(positive_ratio(F.col("gas_interruption_volume"), F.col("total_gas_supply"))).alias(
            "gas_vulnerability_index"
        ),
    )


def regulatory_performance(tables: Tables) -> DataFrame:
    """Spend and return with customer metrics and emissions where they exist."""
    keys = ["date_id", "company_id", "network_sector_id"]
    customers = tables["core_fact_customer_metrics"].select(*keys, "satisfaction_score", "cost_per_customer_gbp")
    emitted = tables["core_fact_emissions"].select(*keys, "sf6_kg", "carbon_footprint_tco2e")
    facts = tables["core_fact_financial_performance"].join(customers, keys, "left").join(emitted, keys, "left")
    variance = F.col("actual_totex_million_gbp") - F.col("totex_allowance_million_gbp")
    return _with_names(facts, tables).select(
        "year", "company_name", "sector_name", "totex_allowance_million_gbp", "actual_totex_million_gbp",
        variance.alias("totex_variance_million_gbp"), "rore_pct", "satisfaction_score", "cost_per_customer_gbp",
        "sf6_kg", "carbon_footprint_tco2e",
    )


def decarbonisation_narrative(tables: Tables) -> DataFrame:
    """Yearly loss and low-carbon turnover with their changes."""
    yearly = _with_year(tables["core_fact_network_reliability"], tables).groupBy("year").agg(
        F.sum(F.coalesce("ens_mwh", F.lit(0.0))).alias("total_ens_mwh"),
        F.avg(1 - positive_ratio(F.col("ens_mwh"), F.col("total_demand_mwh"))).alias("avg_reliability_rate"),
    )
    turnover = tables["stg_lcree"].select("year", "lcree_turnover_million_gbp")
    rows = with_changes(
        yearly.join(turnover, "year", "left"), [], "year",
        {"lcree_turnover_change_million_gbp": "lcree_turnover_million_gbp", "ens_change_mwh": "total_ens_mwh"},
    )
    return rows.withColumn(
        "interpretation_note", F.lit("Narrative and correlation only. No causal inference.")
    )


_DEPLOYED = {"capacity_kw": ("max", "capacity_kw"), "installations": ("max", "installations")}


def _cumulative(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    wide = pivot_metrics(df, ["year", *keys], _DEPLOYED)
    return with_running_totals(
        wide, keys, "year", {"cumulative_capacity_kw": "capacity_kw", "cumulative_installations": "installations"}
    )


def renewables_deployment(tables: Tables) -> DataFrame:
    """Four grains in one table: annual, quarterly, regional and by installation type."""
    quarterly = pivot_metrics(
        tables["stg_renewables_quarterly"], ["year", "quarter", "period_date", "technology"],
        {"capacity_kw_quarter": ("max", "capacity_kw"), "installations_quarter": ("max", "installations")},
    )
    regional = pivot_metrics(
        tables["stg_renewables_regional"], ["year", "region", "technology"],
        {"share_pct": ("max", "share_pct"), **_DEPLOYED},
    )
    grains = {
        "annual_gb": _cumulative(tables["stg_renewables_capacity"], ["technology"]),
        "quarterly_gb": quarterly,
        "regional": regional,
        "by_installation_type": _cumulative(
            tables["stg_renewables_installation_type"], ["technology", "installation_type"]
        ),
    }
    shape = [
        ("grain", "string"), ("year", "int"), ("quarter", "int"), ("period_date", "date"), ("technology", "string"),
        ("region", "string"), ("installation_type", "string"), ("capacity_kw", "double"), ("installations", "double"),
        ("cumulative_capacity_kw", "double"), ("cumulative_installations", "double"),
        ("capacity_kw_quarter", "double"), ("installations_quarter", "double"), ("share_pct", "double"),
    ]
    return union_all([filters.conform(df, shape, grain=name) for name, df in grains.items()])


# Statistical table → grain.
DIGEST_GRAINS = {
    "6.1": "commodity_balance",
    "6.2": "capacity_generation_shares",
    "6.3": "load_factors",
    "6.4": "renewable_use_by_vector",
    "6.5": "gross_final_consumption",
    "6.6": "overseas_trade",
    "6.7": "station_counts",
}


def official_renewables(digest: DataFrame) -> DataFrame:
    """Statistical rows with the grain of their table."""
    return digest.withColumn("grain", classify(F.col("dukes_table"), DIGEST_GRAINS, "other"))


def supplier_health(tables: Tables) -> DataFrame:
    """Annual supplier result with the market's entries, exits, active suppliers and concentration."""
    suppliers = tables["core_dim_supplier"].select(
        "supplier_id", "supplier_name", "supplier_group", "supplier_size", "exited_quarter"
    )
    domestic = F.coalesce("segment", F.lit("domestic")) == "domestic"
    # Ids are enough to aggregate; names join the few result rows.
    results = _with_year(tables["core_fact_supplier_financial"], tables).groupBy("year", "supplier_id").agg(
        metric("sum", "profit_million_gbp", where=domestic).alias("profit_million_gbp"),
        metric("avg", "pretax_domestic_margin_pct").alias("pretax_margin_pct"),
    ).join(suppliers, "supplier_id", "left")
    structure = pivot_metrics(
        _with_year(tables["core_fact_market_structure"], tables), ["year"],
        {
            "supplier_entries": ("sum", "supplier_entries"),
            "supplier_exits": ("sum", "supplier_exits"),
            "active_suppliers_avg": ("avg", "active_suppliers"),
            "continuing_active_avg": ("avg", "continuing_active"),
        },
    )
    index = mean_concentration(
        _with_year(tables["core_fact_market_share_retail"], tables), "year", "commodity", "share_pct"
    ).withColumnRenamed("hhi_0_1", "hhi")
    return spine_join(results, [structure, index], ["year"]).select(
        "year", "supplier_id", "supplier_name", "supplier_group", "supplier_size",
        F.lit("domestic").alias("segment"), F.lit("all").alias("commodity"), "exited_quarter", "profit_million_gbp",
        "pretax_margin_pct", "supplier_entries", "supplier_exits", "active_suppliers_avg", "continuing_active_avg",
        "hhi",
    )


# Column → (aggregate, metric) of the vulnerability view.
DEBT_COLUMNS = {
    "avg_debt_no_arrangement_gbp": ("avg", "avg_debt_no_arrangement_gbp"),
    "avg_debt_with_arrangement_gbp": ("avg", "avg_debt_with_arrangement_gbp"),
    "accounts_in_arrears": ("avg", "accounts_in_arrears_no_arrangement"),
    "accounts_repaying_debt": ("avg", "accounts_repaying_debt"),
    "ppm_debt_repayment_share_pct": ("avg", "ppm_debt_repayment_share_pct"),
}
AGED_DEBT = "debt_value_gt91_days_billion_gbp"
AGED_DEBT_COLUMNS = {
    "debt_gt91_days_bn_gbp": "debt",
    "arrears_gt91_days_bn_gbp": "arrears",
    "debt_plus_arrears_gt91_days_bn_gbp": "debt_plus_arrears",
}
CREDIT_COLUMNS = [
    "credit_balance_total_bn_gbp",
    "credit_balance_total_rolling12_bn_gbp",
    "credit_balance_household_quarter_avg_gbp",
    "credit_balance_household_rolling12_avg_gbp",
    "credit_balance_quartile_lower_gbp",
    "credit_balance_quartile_median_gbp",
    "credit_balance_quartile_upper_gbp",
]
DISCONNECTION_COLUMNS = [
    "disconnections_for_debt",
    "smart_ppm_self_disconnect_events",
    "smart_ppm_self_disconnect_customers",
    "smart_ppm_self_disconnect_customers_gt3h",
]


def consumer_vulnerability(tables: Tables) -> DataFrame:
    """Debt, disconnections and credit balances per quarter, commodity and payment method.

    Debt and credit balances come from one pass over the debt fact: the component tells them apart, so both pivots are
    conditional aggregates of the same grouping. A group without debt rows (or without credit rows) is told by a count.
    """
    methods = tables["core_dim_payment_method"].select("payment_method_id", "payment_method")
    keys = ["year", "quarter", "commodity", "payment_method"]

    def national(df: DataFrame) -> DataFrame:
        rows = df.filter(F.col("supplier_id").isNull()).join(_dates(tables, "year", "quarter", "period_start_date"), "date_id")
        named = rows.join(methods, "payment_method_id", "left")
        return named.withColumn("payment_method", F.coalesce("payment_method", F.lit("all")))

    is_credit = F.coalesce(F.col("component") == "credit_balance", F.lit(False))
    debt_spec = {c: (how, name, ~is_credit) for c, (how, name) in DEBT_COLUMNS.items()}
    aged_spec = {c: ("avg", AGED_DEBT, F.col("component") == part) for c, part in AGED_DEBT_COLUMNS.items()}
    credit_spec = {c: ("avg", c, is_credit) for c in CREDIT_COLUMNS}
    both = national(tables["core_fact_consumer_debt"]).groupBy(*keys, "period_start_date").agg(
        *metric_columns({**debt_spec, **aged_spec, **credit_spec}), F.count_if(~is_credit).alias("_debt_rows"),
        F.count_if(is_credit).alias("_credit_rows"),
    )
    debt = both.filter("_debt_rows > 0").select(*keys, "period_start_date", *debt_spec, *aged_spec)
    credit = both.filter("_credit_rows > 0").select(*keys, *credit_spec)
    cut_off = pivot_metrics(
        national(tables["core_fact_consumer_disconnections"]), keys, {c: ("sum", c) for c in DISCONNECTION_COLUMNS}
    )
    base = null_safe_join(debt, cut_off, keys, "full_outer")
    first_month = F.greatest(F.lit(1), (F.coalesce("quarter", F.lit(1)) - 1) * 3 + 1)
    repaying = F.coalesce("accounts_repaying_debt", F.lit(0.0))
    base = base.withColumns(
        {
            "period_start_date": F.coalesce("period_start_date", F.make_date("year", first_month, F.lit(1))),
            "arrears_rate": positive_ratio(F.col("accounts_in_arrears"), repaying),
        }
    )
    return null_safe_join(base, credit, keys, "left").select(
        "year", "quarter", "period_start_date", "commodity", "payment_method", *debt_spec, *aged_spec, "arrears_rate",
        *DISCONNECTION_COLUMNS, *CREDIT_COLUMNS,
    )


# Column → (aggregate, metric) of the competition view.
SWITCHING_COLUMNS = {
    "avg_switching_time_days": ("avg", "avg_switching_time_days"),
    "total_switches": ("sum", "total_switches"),
    "switches_to_other_suppliers": ("sum", "switches_to_other_suppliers"),
    "net_gains_other_suppliers": ("sum", "net_gains_other_suppliers"),
    "switching_rate_internal_total_pct": ("avg", "switching_rate_internal_total_pct"),
    "switching_rate_external_total_pct": ("avg", "switching_rate_external_total_pct"),
    "switching_rate_internal_by_tariff_pct": ("avg", "switching_rate_internal_by_tariff_pct"),
}
STRUCTURE_COLUMNS = {
    "active_suppliers": ("avg", "active_suppliers"),
    "supplier_entries": ("sum", "supplier_entries"),
    "supplier_exits": ("sum", "supplier_exits"),
    "continuing_active": ("avg", "continuing_active"),
}


def competition(tables: Tables) -> DataFrame:
    """Switching and market structure per quarter and commodity; either side may be missing."""
    dates = _dates(tables, "year", "quarter", "period_start_date")
    keys = ["year", "quarter", "commodity"]
    switching = pivot_metrics(
        tables["core_fact_switching_activity"].join(dates, "date_id"), [*keys, "period_start_date"], SWITCHING_COLUMNS
    )
    structure = pivot_metrics(tables["core_fact_market_structure"].join(dates, "date_id"), keys, STRUCTURE_COLUMNS)
    return null_safe_join(switching, structure, keys, "full_outer").select(
        "year", "quarter", "period_start_date", "commodity", *SWITCHING_COLUMNS, *STRUCTURE_COLUMNS
    )


def affordability(tables: Tables) -> DataFrame:
    """Three layers in one long table: tariffs, price-cap components, household spending."""
    dates = _dates(tables, "year", "quarter", "period_start_date", "period_label")
    methods = tables["core_dim_payment_method"].select("payment_method_id", "payment_method")

    def layer(fact: str, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
        rows = filters.metrics(tables[fact], names).join(dates, "date_id").join(methods, "payment_method_id", "left")
        return rows.groupBy("year", "quarter", "period_start_date", *keys, "payment_method").agg(
            F.avg("value").alias("value")
        )

    tariffs = layer(
        "core_fact_tariff_benchmarks", ["cheapest_tariff_gbp_per_year", "tariff_price_gbp_per_year"],
        ["commodity", "supplier_group", "tariff_type"],
    )
    caps = layer(
        "core_fact_bill_breakdown", ["price_cap_component_gbp"], ["period_label", "commodity", "component"]
    )
    households = _with_year(tables["core_fact_household_spend"], tables).select(
        "year", F.make_date("year", F.lit(1), F.lit(1)).alias("period_start_date"),
        F.concat(F.col("year"), F.lit("-annual")).alias("period_label"), "segment", "value_pct",
    )
    shape = [
        ("layer", "string"), ("year", "int"), ("quarter", "int"), ("period_start_date", "date"),
        ("period_label", "string"), ("commodity", "string"), ("payment_method", "string"),
        ("supplier_group", "string"), ("tariff_type", "string"), ("component", "string"), ("value", "double"),
        ("segment", "string"), ("value_pct", "double"),
    ]
    layers = {"tariff": tariffs, "price_cap_component": caps, "household_spend": households}
    return union_all([filters.conform(df, shape, layer=name) for name, df in layers.items()])


def _described(tables: Tables, fact: str, supplier_columns: Sequence[str], band: str) -> DataFrame:
    suppliers = tables["core_dim_supplier"].select("supplier_id", *supplier_columns)
    sizes = tables["core_dim_supplier_size"].select("supplier_size_id", F.col("size_band").alias(band))
    dates = _dates(tables, "year", "quarter", "period_start_date")
    rows = tables[fact].join(dates, "date_id").join(suppliers, "supplier_id", "left")
    return rows.join(sizes, "supplier_size_id", "left")


def complaints(tables: Tables) -> DataFrame:
    """Complaint rows with dates, supplier attributes and the reported size band."""
    attributes = ["supplier_name", "supplier_group", "supplier_size"]
    rows = _described(tables, "core_fact_complaints_resolution", attributes, "reported_size_band")
    return rows.select(
        "year", "quarter", "period_start_date", "supplier_id", *attributes, "reported_size_band", "metric_name",
        "value", "unit", "source_file",
    )


def satisfaction(tables: Tables) -> DataFrame:
    """Satisfaction and recommendation rows with dates and supplier attributes."""
    rows = _described(tables, "core_fact_satisfaction_scores", ["supplier_name", "supplier_group"], "supplier_size")
    return rows.select(
        "year", "quarter", "period_start_date", "supplier_id", "supplier_name", "supplier_group", "supplier_size",
        "commodity", "aspect", "metric_name", "value", "unit", "source_file",
    )


def discount_scheme(tables: Tables) -> DataFrame:
    """National and supplier rows of the discount scheme; unknown suppliers stay without an id."""
    source = F.max("source_file").alias("source_file")
    years = ["scheme_year", "calendar_year"]
    national = pivot_metrics(
        tables["stg_whd_scheme_year"], [*years, "nation"],
        {"expenditure_pct": ("max", "expenditure_pct"), "scheme_value_mgbp": ("max", "scheme_value_mgbp")}, source,
    )
    obligations = pivot_metrics(
        tables["stg_whd_obligation"], [*years, "supplier_name", "obligation_method"],
        {
            "obligation_amount_mgbp": ("max", "obligation_amount_mgbp"),
            "redistributed_mgbp": ("max", "redistributed_mgbp"),
        },
        source,
    )
    suppliers = tables["core_dim_supplier"].select("supplier_id", "supplier_name", "supplier_group", "supplier_size")
    named = obligations.join(suppliers, "supplier_name", "left")
    shape = [
        ("grain", "string"), ("scheme_year", "int"), ("calendar_year", "int"), ("nation", "string"),
        ("supplier_id", "bigint"), ("supplier_name", "string"), ("supplier_group", "string"),
        ("supplier_size", "string"), ("obligation_method", "string"), ("expenditure_pct", "double"),
        ("scheme_value_mgbp", "double"), ("obligation_amount_mgbp", "double"), ("redistributed_mgbp", "double"),
        ("source_file", "string"),
    ]
    grains = {"national": national, "supplier": named}
    return union_all([filters.conform(df, shape, grain=name) for name, df in grains.items()])


# Price-cap component → column.
CAP_COLUMNS = {
    "wholesale_gbp": "wholesale",
    "network_gbp": "network",
    "policy_gbp": "policy",
    "operating_gbp": "operating",
    "vat_gbp": "vat",
    "ebit_gbp": "ebit",
    "total_cap_gbp": "total",
}


def cost_to_consumer(tables: Tables) -> DataFrame:
    """Price-cap components per year with their changes, next to wholesale levels and their lags."""
    debit = tables["core_dim_payment_method"].filter(F.col("payment_method") == "direct_debit").select(
        "payment_method_id"
    )
    caps = filters.metrics(tables["core_fact_bill_breakdown"], ["price_cap_component_gbp"])
    means = _with_year(caps.join(debit, "payment_method_id", "left_semi"), tables).groupBy("year", "component").agg(
        F.avg("value").alias("_gbp")
    )
    wide = means.groupBy("year").agg(
        *[F.sum(F.when(F.col("component") == part, F.col("_gbp"))).alias(c) for c, part in CAP_COLUMNS.items()]
    )
    electricity, gas = F.col("commodity") == "electricity", F.col("commodity") == "gas"
    wholesale = tables["core_fact_market_prices"].groupBy("year").agg(
        metric("avg", "power_price_baseload", where=electricity).alias("power_baseload_avg"),
        metric("avg", "gas_day_ahead_price", where=gas).alias("gas_day_ahead_avg"),
        F.count_if(electricity & (F.col("metric_name") == "power_price_baseload")).alias("wholesale_obs_electricity"),
        F.count_if(gas & (F.col("metric_name") == "gas_day_ahead_price")).alias("wholesale_obs_gas"),
    )
    changes = {
        "wholesale_yoy_change": "wholesale_gbp", "network_yoy_change": "network_gbp",
        "policy_yoy_change": "policy_gbp", "total_yoy_change": "total_cap_gbp",
    }
    rows = with_changes(wide.join(wholesale, "year", "left"), [], "year", changes)
    lags = {"power_baseload_avg_lag1": "power_baseload_avg", "gas_day_ahead_avg_lag1": "gas_day_ahead_avg"}
    rows = with_lags(rows, [], "year", lags)
    return rows.select(
        "year", *CAP_COLUMNS, *changes, "power_baseload_avg", "gas_day_ahead_avg", *lags,
        "wholesale_obs_electricity", "wholesale_obs_gas",
        _unobserved("wholesale_obs_electricity", "wholesale_obs_gas").alias("is_wholesale_low_confidence"),
        F.lit(True).alias("is_contemporaneous_only"),
    )


def _unobserved(*counts: str) -> Column:
    """True when any of the counts is missing or zero."""
    test = F.lit(False)
    for name in counts:
        test = test | (F.coalesce(name, F.lit(0)) == 0)
    return test


def volatility_complaints(tables: Tables) -> DataFrame:
    """Years with both volatility and complaints: wholesale stress against complaints, switching and exits."""
    electricity, gas = F.col("commodity") == "electricity", F.col("commodity") == "gas"
    wholesale = tables["core_fact_market_prices"].groupBy("year").agg(
        *metric_columns(
            {
                **VOLATILITY_COLUMNS,
                "spark_spread_avg": ("avg", "spark_spread_central", electricity),
                "summer_winter_spread_avg": ("avg", "summer_winter_spread", electricity),
                "power_baseload_avg": ("avg", "power_price_baseload", electricity),
                "gas_day_ahead_avg": ("avg", "gas_day_ahead_price", gas),
            }
        ),
        F.count_if(F.col("metric_name") == "volatility_electricity_baseload").alias("wholesale_vol_obs_electricity"),
        F.count_if(F.col("metric_name") == "volatility_gas").alias("wholesale_vol_obs_gas"),
    )
    dates = _dates(tables, "year", "quarter")
    complaint = tables["core_fact_complaints_resolution"].join(dates, "date_id").groupBy("year").agg(
        metric("avg", "complaints_received_per_100k").alias("complaints_received_per_100k_avg"),
        metric("avg", "complaints_resolved_next_day_pct").alias("resolved_next_day_avg_pct"),
        metric("avg", "complaints_resolved_8w_pct").alias("resolved_8w_avg_pct"),
        F.count("*").alias("complaints_obs_rows"),
        F.countDistinct("quarter").alias("complaints_distinct_quarters"),
    )
    switching = tables["core_fact_switching_activity"].filter(F.col("supplier_size_id").isNull())
    switching = _with_year(switching, tables).groupBy("year").agg(
        metric("sum", "total_switches").alias("total_switches"),
        metric("avg", "avg_switching_time_days").alias("avg_switching_time_days"),
        F.count("*").alias("switching_obs_rows"),
    )
    whole_market = F.col("commodity").isNull() | F.lower(F.trim("commodity")).isin("all", "both", "total")
    exits = filters.metrics(tables["core_fact_market_structure"], ["supplier_exits"]).filter(whole_market)
    exits = _with_year(exits, tables).groupBy("year").agg(
        F.sum("value").alias("supplier_exits"), F.count("*").alias("exits_obs_rows")
    )
    spine = wholesale.filter(F.col("elec_baseload_volatility").isNotNull()).join(complaint, "year")
    rows = spine_join(spine, [switching, exits], ["year"])
    lags = {
        "elec_baseload_volatility_lag1": "elec_baseload_volatility", "gas_volatility_lag1": "gas_volatility",
        "spark_spread_avg_lag1": "spark_spread_avg",
        "complaints_received_per_100k_lag1": "complaints_received_per_100k_avg",
        "total_switches_lag1": "total_switches", "supplier_exits_lag1": "supplier_exits",
    }
    rows = with_lags(rows, [], "year", lags)
    return rows.withColumns(
        {
            "is_wholesale_low_confidence": _unobserved("wholesale_vol_obs_electricity", "wholesale_vol_obs_gas"),
            "is_retail_mixed_grain": F.lit(False),
            "is_retail_low_confidence": _unobserved("complaints_obs_rows", "switching_obs_rows"),
            "is_contemporaneous_only": F.lit(True),
        }
    )


def supplier_quality(tables: Tables) -> DataFrame:
    """Profit, complaints and satisfaction per supplier and year, for every supplier that has any of them."""
    keys = ["year", "supplier_id"]

    def per_supplier(fact: str, spec: Mapping[str, tuple]) -> DataFrame:
        return pivot_metrics(_with_year(tables[fact].filter(F.col("supplier_id").isNotNull()), tables), keys, spec)

    def profit(segment: str) -> tuple:
        return ("avg", "profit_million_gbp", F.col("segment") == segment)

    financial = per_supplier(
        "core_fact_supplier_financial",
        {
            "domestic_profit_million_gbp": profit("domestic"),
            "non_domestic_profit_million_gbp": profit("non_domestic"),
            "generation_profit_million_gbp": profit("generation"),
            "pretax_domestic_margin_pct": ("avg", "pretax_domestic_margin_pct"),
        },
    )
    complaint = per_supplier(
        "core_fact_complaints_resolution",
        {
            "complaints_received_per_100k_avg": ("avg", "complaints_received_per_100k"),
            "resolved_next_day_avg_pct": ("avg", "complaints_resolved_next_day_pct"),
            "resolved_8w_avg_pct": ("avg", "complaints_resolved_8w_pct"),
        },
    )
    satisfied = per_supplier(
        "core_fact_satisfaction_scores",
        {
            "satisfaction_pct_avg": ("avg", "satisfaction_pct"),
            "satisfaction_overall_pct": ("avg", "satisfaction_overall_pct"),
            "nps_score": ("avg", "nps_score"),
        },
    )
    rows = universe_join([financial, complaint, satisfied], keys)
    suppliers = tables["core_dim_supplier"].select("supplier_id", "supplier_name", "supplier_group", "supplier_size")
    rows = rows.join(suppliers, "supplier_id", "left")
    lags = {
        "pretax_domestic_margin_pct_lag1": "pretax_domestic_margin_pct",
        "complaints_received_per_100k_lag1": "complaints_received_per_100k_avg",
    }
    rows = with_lags(rows, ["supplier_id"], "year", lags)
    c = F.col
    return rows.withColumns(
        {
            "has_domestic_profit": c("domestic_profit_million_gbp").isNotNull(),
            "has_complaints_metrics": any_present(
                c("complaints_received_per_100k_avg"), c("resolved_next_day_avg_pct"), c("resolved_8w_avg_pct")
            ),
            "has_satisfaction_metrics": any_present(
                c("satisfaction_pct_avg"), c("satisfaction_overall_pct"), c("nps_score")
            ),
            "non_null_metric_count": present_count(
                c("domestic_profit_million_gbp"), c("pretax_domestic_margin_pct"),
                c("complaints_received_per_100k_avg"), F.coalesce("satisfaction_pct_avg", "nps_score"),
            ),
            "is_contemporaneous_only": F.lit(True),
        }
    )


def daily_monitoring(tables: Tables) -> DataFrame:
    """Level, spread and spike days of each daily series per year."""
    rows = tables["core_fact_daily_prices"].withColumn("year", F.year("period_date"))
    return monitor(rows, ["year", "commodity", "source_name", "metric_name"], "period_date", "value")


def renewables_obligation(tables: Tables) -> DataFrame:
    """Certificates and accredited capacity per obligation period and technology."""
    rows = filters.grain(tables["core_fact_renewables_obligation"], present=["obligation_period", "technology"])

    def source(name: str) -> Column:
        return F.min(F.when(F.col("metric_name") == name, F.col("source_file")))

    return pivot_metrics(
        rows, ["obligation_period", "technology"],
        {
            "rocs_issued_millions": ("max", "rocs_issued_millions"),
            "accredited_capacity_mw": ("max", "accredited_capacity_mw"),
        },
        source("rocs_issued_millions").alias("rocs_source_file"),
        source("accredited_capacity_mw").alias("capacity_source_file"),
    )


def scheme_metric(tables: Tables) -> DataFrame:
    """Scheme rows as they are in the core."""
    return tables["core_fact_scheme_metric"].select(
        "period_date", "period_label", "calendar_year", "calendar_month", "quarter", "scheme_key", "entity",
        "metric_name", "value", "unit", "source_file",
    )


# ---------------------------------------------------------------------------------------------------------------
# Example analytics over the marts.


def trend_in_window(mart: DataFrame, sector: str, first: int, last: int) -> DataFrame:
    """Cost and reliability of one sector's companies over a span of years."""
    rows = filters.years(mart.filter(F.col("sector_name") == sector), first, last)
    columns = [
        "year", "company_name", "ens_mwh", "actual_totex_million_gbp", "ens_per_million_gbp_spend",
        "reliability_rate", "cost_efficiency_score", "rore_pct",
    ]
    return rows.select(*columns).orderBy("company_name", "year")


def top_industries_by_risk(impact: DataFrame, n: int = 5) -> DataFrame:
    """Largest output at risk per year and industry."""
    sums = impact.groupBy("year", "sic_code", "industry_name").agg(
        F.sum("output_at_risk_gbp").alias("output_at_risk_gbp")
    )
    return top_n(sums, "output_at_risk_gbp", n, ["year", "sic_code"])


def loss_change_per_spend_change(mart: DataFrame) -> DataFrame:
    """Change of losses per change of spend, per company."""
    yearly = mart.groupBy("year", "company_name").agg(
        F.sum("ens_mwh").alias("ens"), F.sum("actual_totex_million_gbp").alias("spend")
    )
    rows = change_per_change(yearly, ["company_name"], "year", "ens", "spend", "ens_change_per_spend_change")
    return rows.select("year", "company_name", "ens_delta", "spend_delta", "ens_change_per_spend_change")


def worst_loss_per_spend(mart: DataFrame, sector: str, first: int, last: int, n: int = 3) -> DataFrame:
    """Companies with the highest mean loss per spend in a window."""
    rows = filters.years(mart.filter(F.col("sector_name") == sector), first, last)
    means = rows.filter(F.col("ens_per_million_gbp_spend").isNotNull()).groupBy("company_name").agg(
        F.avg("ens_per_million_gbp_spend").alias("avg_ens_per_mgbp"), F.sum("ens_mwh").alias("total_ens_mwh"),
        F.sum("actual_totex_million_gbp").alias("total_spend_mgbp"),
    )
    return top_n(means, "avg_ens_per_mgbp", n, ["company_name"])


def section_risk_trend(impact: DataFrame, section: str = "C", words: str = "manufactur") -> DataFrame:
    """Output at risk of one industry section per year, with its change in value and percent."""
    inside = (F.left("sic_code", F.lit(1)) == section) | F.lower("industry_name").contains(words)
    yearly = impact.filter(inside).groupBy("year").agg(F.sum("output_at_risk_gbp").alias("output_at_risk_gbp"))
    lagged = with_lags(yearly, [], "year", {"_before": "output_at_risk_gbp"})
    delta = F.col("output_at_risk_gbp") - F.col("_before")
    return lagged.select(
        "year", "output_at_risk_gbp", delta.alias("yoy_delta_gbp"),
        (ratio(delta, F.col("_before")) * 100.0).alias("yoy_delta_pct"),
    )


def availability_satisfaction(availability: DataFrame, satisfaction_rows: DataFrame, sector: str) -> DataFrame:
    """Correlation of availability and customer survey score over (year, company)."""
    keys = ["year", "company_name"]

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.filter((F.col("network_sector") == sector) & (F.col("metric_name") == name)).groupBy(*keys)

    up = rows(availability, "network_availability_pct").agg(F.avg("value").alias("_x"))
    happy = rows(satisfaction_rows, "customer_survey_score").agg(F.max("value").alias("_y"))
    return up.join(happy, keys).agg(F.corr("_x", "_y").alias("pearson_corr"), F.count("*").alias("pair_count"))
