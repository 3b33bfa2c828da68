"""Staging: landed documents and long rows → one table per topic.

Every function takes the landing tables it needs and returns one staging table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions import labels as L
from metricmart.functions.documents import holding, with_fields
from metricmart.functions.numeric import present_mean
from metricmart.operators import filters
from metricmart.operators.aggregates import metric_columns, parts_and_totals
from metricmart.operators.conform import first_per_key, prioritise, resolve_alias, union_all
from metricmart.operators.dimensions import SECTOR_CODES
from metricmart.operators.joins import first_match_fill, same_year_else_max

ENTITY = ["year", "company_name", "network_sector"]


def _network_long(rows: DataFrame, alias: DataFrame, by_sector: bool = False) -> DataFrame:
    """Long network rows with sector codes and canonical company names."""
    coded = rows.filter(F.col("year").isNotNull()).withColumn(
        "network_sector", L.code_for(F.col("network_sector"), SECTOR_CODES)
    )
    sector = ("network_sector", "network_sector_code") if by_sector else None
    return resolve_alias(coded, alias, "company_name", "source_company_name", "company_name", sector)


def _wide(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    return long.groupBy(*ENTITY).agg(*metric_columns({c: ("max", c) for c in columns}))


def network_reliability(documents: DataFrame, rows: DataFrame, alias: DataFrame) -> DataFrame:
    """Reliability per year, company and sector; typed rows go before documents."""
    measures = ["ens_mwh", "customer_interruptions", "minutes_lost", "gas_interruption_volume", "gas_lost_volume"]
    fields = {"year": "int", "company_name": "string", "network_sector": "string", **{m: "double" for m in measures}}
    from_documents = with_fields(documents, fields).select(*ENTITY, *measures)
    # The typed source never carries interruption volumes.
    typed = [m for m in measures if m != "gas_interruption_volume"]
    from_rows = _wide(_network_long(rows, alias, by_sector=True), typed).withColumn(
        "gas_interruption_volume", F.lit(None).cast("double")
    )
    return prioritise([from_rows, from_documents], ENTITY, require=["company_name", "network_sector"])


def financial_performance(
    documents: DataFrame, return_documents: DataFrame, rows: DataFrame, return_rows: DataFrame, alias: DataFrame
) -> DataFrame:
    """Spend, allowance and return on equity.

    Documents take a missing return from the matching return document. Typed returns are often one value for a whole
    scheme: the return of the same year counts, else the company's largest.
    """
    spend = ["totex_allowance_million_gbp", "actual_totex_million_gbp"]
    fields = {
        "year": "int", "company_name": "string", "network_sector": "string", **{s: "double" for s in spend},
        "rore_pct": "double",
    }
    returns = with_fields(return_documents, {k: v for k, v in fields.items() if k not in spend})
    returns = returns.select(*ENTITY, "rore_pct")
    from_documents = first_match_fill(
        with_fields(documents, fields).select(*ENTITY, *spend, "rore_pct"), returns, ENTITY, "rore_pct",
        [F.col("rore_pct").asc_nulls_last()],
    )
    from_rows = same_year_else_max(
        _wide(_network_long(rows, alias), spend), _wide(_network_long(return_rows, alias), ["rore_pct"]),
        ["company_name", "network_sector"], "rore_pct",
    )
    return prioritise([from_rows, from_documents], ENTITY, require=["company_name", "network_sector"])


def customer_metrics(documents: DataFrame, rows: DataFrame, alias: DataFrame) -> DataFrame:
    """Cost per customer and satisfaction; typed survey scores are averaged over those present."""
    fields = {
        "year": "int", "company_name": "string", "network_sector": "string", "geography_code": "string",
        "cost_per_customer_gbp": "double", "satisfaction_score": "double",
    }
    columns = [*ENTITY, "geography_code", "cost_per_customer_gbp", "satisfaction_score"]
    from_documents = with_fields(documents, fields).withColumn(
        "geography_code", F.coalesce("geography_code", F.lit("GB"))
    )
    scores = ["customer_survey_score", "stakeholder_engagement_score", "stakeholder_survey_score"]
    wide = _wide(_network_long(rows, alias), scores)
    score = F.nullif(present_mean(*[F.col(s) for s in scores]), F.lit(0.0))
    from_rows = wide.select(
        *ENTITY, F.lit("GB").alias("geography_code"), F.lit(None).cast("double").alias("cost_per_customer_gbp"),
        score.alias("satisfaction_score"),
    )
    return prioritise(
        [from_rows, from_documents.select(*columns)], [*ENTITY, "geography_code"], require=["company_name"]
    )


def emissions(documents: DataFrame, rows: DataFrame, alias: DataFrame) -> DataFrame:
    """SF6 and carbon footprint; typed footprints are the sum of three scopes, zero counts as unknown."""
    fields = {
        "year": "int", "company_name": "string", "network_sector": "string", "sf6_kg": "double",
        "carbon_footprint_tco2e": "double",
    }
    from_documents = with_fields(documents, fields).select(*ENTITY, "sf6_kg", "carbon_footprint_tco2e")
    scopes = ["ghg_scope1_tco2e", "ghg_scope2_tco2e", "ghg_scope3_tco2e"]
    wide = _wide(_network_long(rows, alias), ["sf6_kg", *scopes])
    footprint = sum((F.coalesce(s, F.lit(0.0)) for s in scopes), F.lit(0.0))
    from_rows = wide.select(*ENTITY, "sf6_kg", footprint.alias("carbon_footprint_tco2e"))
    best = prioritise([from_rows, from_documents], ENTITY, require=["company_name", "network_sector"])
    return best.withColumn("carbon_footprint_tco2e", F.nullif("carbon_footprint_tco2e", F.lit(0.0)))


def energy_intensity(documents: DataFrame) -> DataFrame:
    """Intensity per year and industry."""
    fields = {
        "year": "int", "sic_code": "string", "kwh_per_gva": "double", "energy_intensity_index": "double",
        "industry_name": "string",
    }
    rows = with_fields(documents, fields).filter(F.col("year").isNotNull())
    return rows.groupBy("year", "sic_code").agg(
        F.avg("kwh_per_gva").alias("kwh_per_gva"), F.avg("energy_intensity_index").alias("energy_intensity_index"),
        F.max("industry_name").alias("industry_name"),
    )


def _typed(documents: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    return with_fields(documents, fields).select(*fields)


def sector_fuel_use(documents: DataFrame) -> DataFrame:
    return _typed(
        documents, {"year": "int", "sic_code": "string", "electricity_pct": "double", "gas_pct": "double"}
    )


def regional_gva(documents: DataFrame) -> DataFrame:
    return _typed(
        documents, {"year": "int", "region_code": "string", "sic_code": "string", "gva_million_gbp": "double"}
    )


def lcree(documents: DataFrame) -> DataFrame:
    """Low-carbon turnover, under whichever of its three names the document uses."""
    names = ["lcree_turnover_million_gbp", "turnover_million_gbp", "turnover_current_prices_million_gbp"]
    rows = with_fields(documents, {"year": "int", **{n: "double" for n in names}})
    return rows.select("year", F.coalesce(*names).alias(names[0]))


def intermediate_consumption(documents: DataFrame) -> DataFrame:
    fields = {
        "year": "int", "sic_code": "string", "industry_name": "string", "commodity": "string",
        "intermediate_consumption_share": "double", "intermediate_share": "double",
        "intermediate_consumption_value": "double",
    }
    rows = with_fields(documents, fields)
    return rows.select(
        "year", "sic_code", "industry_name", L.normalised(F.col("commodity")).alias("commodity"),
        F.coalesce("intermediate_consumption_share", "intermediate_share").alias("intermediate_consumption_share"),
        "intermediate_consumption_value",
    )


def market_prices(rows: DataFrame) -> DataFrame:
    """Annual level and range per commodity, instrument and metric."""
    return rows.filter(F.col("year").isNotNull()).groupBy("year", "commodity", "instrument", "metric_name").agg(
        F.avg("value").alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.count("*").alias("obs_count"), F.max("unit").alias("unit"),
    )


# Fixed values: (commodity, metric of the parts, metric of the total, unit) of the two supply mixes.
SUPPLY_MIXES = {
    "generation_mix": ("electricity", "generation_twh", "generation_total_twh", "TWh"),
    "gas_supply": ("gas", "gas_supply_mcm_year_sum", "gas_supply_total", "mcm_per_day_sum"),
}


def market_context(generation_mix: DataFrame, gas_supply: DataFrame) -> DataFrame:
    """Annual supply by source with a TOTAL row, for electricity and gas."""
    frames = []
    for rows, (commodity, part, total, unit) in zip(
        (generation_mix, gas_supply), SUPPLY_MIXES.values(), strict=True
    ):
        both = parts_and_totals(rows.filter(F.col("year").isNotNull()), ["year"], "instrument", "value")
        frames.append(
            both.select(
                "year", F.lit(commodity).alias("commodity"), F.col("instrument").alias("fuel_source"),
                F.when(F.col("is_total"), F.lit(total)).otherwise(F.lit(part)).alias("metric_name"),
                "value", F.lit(unit).alias("unit"),
            )
        )
    return union_all(frames)


def market_share(rows: DataFrame) -> DataFrame:
    """Wholesale shares per company."""
    return filters.metrics(rows, ["generation_market_share_pct"]).select(
        "year", F.lit("electricity").alias("commodity"), "company_name", F.col("value").alias("share_pct"),
        "source_file",
    )


def daily_prices(documents: DataFrame) -> DataFrame:
    """Daily prices; only documents that have all four key fields, present even if null."""
    fields = {
        "date": "date", "commodity": "string", "source_name": "string", "metric_name": "string", "value": "double",
        "unit": "string",
    }
    known = holding(documents, ["date", "commodity", "metric_name", "value"])
    rows = with_fields(known, fields)
    return rows.select(
        F.col("date").alias("period_date"), F.year("date").alias("year"),
        L.normalised(F.col("commodity")).alias("commodity"),
        L.normalised(F.coalesce("source_name", "source_id")).alias("source_name"),
        L.normalised(F.col("metric_name")).alias("metric_name"), "value", "unit",
    )


# ---------------------------------------------------------------------------------------------------------------
# Retail.


def resolve_suppliers(rows: DataFrame, alias: DataFrame) -> DataFrame:
    """Rows with a value, supplier names made canonical."""
    valued = rows.filter(F.col("value").isNotNull())
    return resolve_alias(valued, alias, "supplier_name", "source_supplier_name", "supplier_name")


SATISFACTION_PREFIX = "satisfaction_"

# Which metrics make up each retail topic, by landing table.
TOPIC_METRICS = {
    "profits": ["profit_million_gbp", "pretax_domestic_margin_pct"],
    "aggregate_profits": ["aggregate_profit_billion_gbp", "large_legacy_aggregate_profit_million_gbp"],
    "debt": [
        "avg_debt_no_arrangement_gbp",
        "avg_debt_with_arrangement_gbp",
        "accounts_in_arrears_no_arrangement",
        "accounts_repaying_debt",
        "ppm_debt_repayment_share_pct",
        "debt_value_gt91_days_billion_gbp",
    ],
    "credit_balance": [
        "credit_balance_total_bn_gbp",
        "credit_balance_total_rolling12_bn_gbp",
        "credit_balance_household_quarter_avg_gbp",
        "credit_balance_household_rolling12_avg_gbp",
        "credit_balance_quartile_lower_gbp",
        "credit_balance_quartile_median_gbp",
        "credit_balance_quartile_upper_gbp",
    ],
    "repayment_plans": ["avg_repayment_plan_weeks", "avg_weekly_repayment_gbp"],
    "disconnections": ["disconnections_for_debt"],
    "self_disconnections": [
        "smart_ppm_self_disconnect_events",
        "smart_ppm_self_disconnect_customers",
        "smart_ppm_self_disconnect_customers_gt3h",
    ],
    "switching": [
        "avg_switching_time_days",
        "total_switches",
        "switches_to_other_suppliers",
        "net_gains_other_suppliers",
        "switching_rate_internal_total_pct",
        "switching_rate_external_total_pct",
        "switching_rate_internal_by_tariff_pct",
    ],
    "structure": ["active_suppliers", "supplier_entries", "supplier_exits", "continuing_active"],
    "tariffs": [
        "cheapest_tariff_gbp_per_year",
        "tariff_price_gbp_per_year",
        "power_price_day_ahead_baseload",
        "power_price_forward_delivery",
        "gas_price_forward_delivery",
    ],
    "supplier_tariffs": ["tariff_price_gbp_per_year"],
    "bill_components": ["price_cap_component_gbp", "bill_component_gbp"],
    "bill_shares": ["bill_breakdown_pct", "cost_index_yoy_impact_pct"],
    "supplier_complaints": [
        "complaints_received_per_100k",
        "complaints_received_per_10k_small",
        "complaints_resolved_next_day_pct",
        "complaints_resolved_8w_pct",
    ],
    "size_complaints": ["complaints_received_per_100k"],
    "scheme_complaints": ["fit_complaints_per_1000_accounts"],
    "incidents": [
        "minor_incidents_historical",
        "minor_incidents_current",
        "major_incidents_historical",
        "major_incidents_current",
    ],
    "supplier_satisfaction": ["satisfaction_pct"],
    "recommendation": [
        "nps_detractor_pct",
        "nps_passive_pct",
        "nps_promoter_pct",
        "nps_score",
        "satisfaction_overall_pct",
    ],
    "market_share": ["market_share_pct"],
    "household": ["household_energy_spend_pct"],
    "accounts": ["customer_accounts"],
    "heating": ["heating_systems_approved_count"],
}

_TAIL = [("metric_name", "string"), ("value", "double"), ("unit", "string"), ("source_file", "string")]
_PERIOD = [("year", "int"), ("quarter", "int")]


def _text(*names: str) -> list[tuple[str, str]]:
    return [(n, "string") for n in names]


TOPIC_COLUMNS = {
    "supplier_profits": [*_PERIOD, *_text("supplier_name", "segment"), *_TAIL],
    "consumer_debt": [*_PERIOD, *_text("commodity", "payment_method", "supplier_name", "component"), *_TAIL],
    "consumer_disconnections": [*_PERIOD, *_text("commodity", "payment_method", "supplier_name"), *_TAIL],
    "switching": [*_PERIOD, *_text("commodity", "supplier_size"), *_TAIL],
    "tariffs": [
        *_PERIOD, *_text("commodity", "payment_method", "supplier_group", "supplier_name", "tariff_type"), *_TAIL,
    ],
    "bill_breakdown": [*_PERIOD, *_text("commodity", "payment_method", "supplier_group", "component"), *_TAIL],
    "complaints": [*_PERIOD, *_text("supplier_name", "supplier_size"), *_TAIL],
    "satisfaction": [*_PERIOD, *_text("supplier_name", "supplier_size", "commodity", "aspect"), *_TAIL],
    "market_structure": [*_PERIOD, *_text("commodity"), *_TAIL],
}


def _topic(topic: str, *branches: tuple[DataFrame, Sequence[str] | Column, Sequence[str]]) -> DataFrame:
    """Union of (rows, metrics or condition, columns of the shape to blank out) branches in one topic's shape."""
    shape = TOPIC_COLUMNS[topic]
    frames = []
    for rows, pick, blank in branches:
        chosen = rows.filter(pick) if isinstance(pick, Column) else filters.metrics(rows, pick)
        frames.append(filters.conform(chosen.drop(*blank), shape))
    return union_all(frames)


def retail_topics(
    supplier_rows: DataFrame, series: DataFrame, snapshots: DataFrame, alias: DataFrame
) -> dict[str, DataFrame]:
    """The retail staging tables by name.

    Dated rows need a year; snapshots keep rows without one. Each branch blanks the dimensions its source does not
    define for the topic.
    """
    m = TOPIC_METRICS
    has_year = F.col("year").isNotNull()
    dated = series.filter(has_year)
    suppliers = resolve_suppliers(supplier_rows, alias)
    dated_suppliers = suppliers.filter(has_year)
    snap = resolve_suppliers(snapshots, alias)

    def of(*groups: str) -> list[str]:
        return [name for g in groups for name in m[g]]

    credit = (F.col("component") == "credit_balance") & F.col("metric_name").isin(of("credit_balance"))
    sized = F.col("metric_name").isin(of("size_complaints")) & F.col("supplier_size").isNotNull()
    bills = F.col("metric_name").isin(of("bill_components")) & F.col("component").isNotNull()
    aspect = F.col("metric_name").startswith(SATISFACTION_PREFIX)
    valued_structure = dated.withColumn("commodity", F.coalesce("commodity", F.lit("all")))
    raw_dated = supplier_rows.filter(has_year)
    shares = filters.metrics(dated_suppliers, of("market_share"))
    spend = filters.metrics(dated, of("household"))
    accounts = filters.metrics(snap, of("accounts"))
    heating = filters.metrics(dated, of("heating"))
    return {
        "stg_supplier_profits": _topic(
            "supplier_profits",
            (dated_suppliers, of("profits"), []),
            (dated, of("aggregate_profits"), ["supplier_name"]),
        ),
        "stg_consumer_debt": _topic(
            "consumer_debt",
            (dated, of("debt"), []),
            (dated, credit, []),
            (snap, of("repayment_plans"), ["component"]),
        ),
        "stg_consumer_disconnections": _topic(
            "consumer_disconnections",
            (dated, of("disconnections", "self_disconnections"), []),
            (snap, of("disconnections"), ["payment_method"]),
        ),
        "stg_switching": _topic("switching", (dated, of("switching", "structure"), [])),
        "stg_tariffs_price_cap": _topic(
            "tariffs",
            (dated, of("tariffs"), []),
            (snap, of("supplier_tariffs"), ["payment_method", "supplier_group"]),
        ),
        "stg_bill_breakdown": _topic(
            "bill_breakdown",
            (dated, bills, []),
            (snap, of("bill_shares"), ["payment_method", "supplier_group"]),
        ),
        "stg_complaints": _topic(
            "complaints",
            (dated_suppliers, of("supplier_complaints"), []),
            (dated, sized, []),
            (raw_dated, of("scheme_complaints"), []),
            (snap, of("incidents"), ["supplier_size"]),
        ),
        "stg_satisfaction": _topic(
            "satisfaction",
            (dated, aspect, []),
            (snap, of("supplier_satisfaction"), ["supplier_size"]),
            (snap, of("recommendation"), ["supplier_name", "commodity", "aspect"]),
        ),
        "stg_market_structure": _topic("market_structure", (valued_structure, of("structure"), [])),
        "stg_market_share_retail": shares.select(
            "year", "quarter", "commodity", "supplier_name", "segment", F.col("value").alias("share_pct"),
            "source_file",
        ),
        "stg_smart_selfdisconnect": filters.metrics(series, of("self_disconnections")).select(
            "year", "quarter", "commodity", "payment_method", "metric_name", "value", "unit", "source_file"
        ),
        "stg_household_spend": spend.select("year", "segment", F.col("value").alias("value_pct"), "source_file"),
        "stg_customer_accounts_retail": accounts.select(
            "year", "supplier_name", "commodity", "segment", "tariff_type", "value", "unit", "source_file"
        ),
        "stg_heating_systems": heating.select("year", "quarter", "component", "value", "unit", "source_file"),
    }


# ---------------------------------------------------------------------------------------------------------------
# Renewables, discount scheme, obligations, scheme metrics.


def _mean_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "metric_name").agg(
        F.avg("value").alias("value"), F.max("unit").alias("unit"), F.max("source_file").alias("source_file")
    )


def renewables(rows: DataFrame) -> dict[str, DataFrame]:
    """Deployment rows split by grain; a dimension a grain does not have must be NULL."""
    base = filters.grain(rows, present=["year", "technology"])
    measured = filters.metrics(base, ["capacity_kw", "installations"])
    return {
        "stg_renewables_capacity": _mean_rows(
            filters.grain(measured, absent=["quarter", "region", "installation_type"]), ["year", "technology"]
        ),
        "stg_renewables_quarterly": _mean_rows(
            filters.grain(measured, present=["quarter"], absent=["region", "installation_type"]),
            ["period_date", "period_label", "year", "quarter", "technology"],
        ),
        "stg_renewables_regional": _mean_rows(
            filters.grain(base, present=["region"], absent=["installation_type"]), ["year", "region", "technology"]
        ),
        "stg_renewables_installation_type": _mean_rows(
            filters.grain(measured, present=["installation_type"], absent=["quarter", "region"]),
            ["year", "installation_type", "technology"],
        ),
    }


def discount_scheme(rows: DataFrame) -> dict[str, DataFrame]:
    """National rows name neither supplier nor method, obligation rows at least one of them."""
    national = filters.metrics(
        filters.grain(rows, absent=["supplier_name", "obligation_method"]), ["expenditure_pct", "scheme_value_mgbp"]
    )
    obligation = filters.metrics(
        rows.filter(F.col("supplier_name").isNotNull() | F.col("obligation_method").isNotNull()),
        ["obligation_amount_mgbp", "redistributed_mgbp"],
    )
    return {
        "stg_whd_scheme_year": _mean_rows(national, ["scheme_year", "calendar_year", "nation"]),
        "stg_whd_obligation": _mean_rows(
            obligation, ["scheme_year", "calendar_year", "supplier_name", "obligation_method"]
        ),
    }


# Certificate and accreditation metrics.
OBLIGATION_METRICS = [
    "rocs_issued_millions",
    "rocs_monthly_millions",
    "accredited_capacity_mw",
    "accredited_stations_cumulative_all",
    "accredited_stations_cumulative_over50kw",
]


def renewables_obligation(rows: DataFrame) -> DataFrame:
    """Certificate rows with their obligation period."""
    period = L.obligation_period(F.col("metric_name"), F.col("period_label"))
    return filters.metrics(rows, OBLIGATION_METRICS).select(
        "year", "quarter", "period_label", period.alias("obligation_period"), "technology", "metric_name", "value",
        "unit", "source_file",
    )


def scheme_metrics(rows: DataFrame) -> DataFrame:
    """Scheme rows with a value."""
    return rows.filter(F.col("value").isNotNull())


def statistical_digest(frames: Sequence[DataFrame]) -> DataFrame:
    """Long statistical rows of all readers in one table; repeated cells keep their first source."""
    both = union_all(list(frames))
    keys = ["dukes_table", "period_year", "period_label", "row_label", "column_label", "metric_name", "source_file"]
    order = [F.col(c).asc_nulls_last() for c in ("value", "unit", "value_text")]
    return first_per_key(both, keys, order)


def energy_flows(rows: DataFrame, bridge: DataFrame) -> dict[str, DataFrame]:
    """Energy-flow accounts: matrix and indicator cells, and the bridge; a cell that repeats keeps its first source."""
    cell = ["reference_year", "table_id", "row_no", "industry_col"]
    line = ["reference_year", "bridge_code"]

    def first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in ["source_file", *[c for c in rest if c != "source_file"]]])

    return {"stg_energy_flows": first(rows, cell), "stg_energy_flow_bridge": first(bridge, line)}
