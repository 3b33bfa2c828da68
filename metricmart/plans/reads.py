"""Parameterised reads over marts, core and staging tables.

A read returns one lazy frame. Where a question may be answered from several sources, the choice of the first source
with rows is part of the plan (``conform.first_nonempty``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions import labels as L
from metricmart.functions import periods as P
from metricmart.functions.numeric import ratio
from metricmart.operators import filters
from metricmart.operators.aggregates import (
    concentration,
    concentration_10000,
    first_and_last,
    metric,
    metric_columns,
    share_of_matching,
)
from metricmart.operators.conform import (
    canonical_lookup,
    first_nonempty,
    first_per_key,
    in_range_else_latest,
    union_all,
    with_canonical_name,
)
from metricmart.operators.dimensions import SECTOR_CODES
from metricmart.operators.pivot import pivot_metrics
from metricmart.operators.ranking import composite_score, top_entities, top_n
from metricmart.operators.windows import with_changes
from metricmart.plans import marts

Tables = Mapping[str, DataFrame]


def slice_years(
    df: DataFrame,
    first: int,
    last: int,
    order: Sequence[str] = (),
    year: str = "year",
    keep_null: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The common read: a year range, some columns, an explicit order with NULLs last."""
    rows = filters.years(df, first, last, year, keep_null)
    rows = rows.select(*columns) if columns else rows
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else rows


# ---------------------------------------------------------------------------------------------------------------
# Pickers, bounds and counts.


def year_bounds(tables: Tables, default: tuple[int, int] = (2013, 2021)) -> DataFrame:
    """Smallest and largest year of the date dimension and the reliability fact."""
    dates = tables["core_dim_date"]
    used = tables["core_fact_network_reliability"].select("date_id").join(dates, "date_id")
    span = F.struct(F.min("year").alias("low"), F.max("year").alias("high"))
    facts = used.agg(span).scalar()
    low, high = default
    return dates.agg(
        F.least(F.coalesce(F.min("year"), F.lit(low)), F.coalesce(facts.getField("low"), F.lit(low))).alias("y_min"),
        F.greatest(F.coalesce(F.max("year"), F.lit(high)), F.coalesce(facts.getField("high"), F.lit(high))).alias(
            "y_max"
        ),
    )


def companies(tables: Tables, commodity: str = "both") -> DataFrame:
    """Companies with their sector."""
    sectors = filters.commodity(tables["core_dim_network_sector"], commodity)
    rows = tables["core_dim_company"].join(sectors, "network_sector_id")
    return filters.distinct_values(rows, ["company_id", "company_name", "commodity", "sector_name"]).orderBy(
        "company_name"
    )


REGION_TYPES = ["region", "distribution_licence_area", "transmission_zone"]


def regions(tables: Tables) -> DataFrame:
    rows = tables["core_dim_geography"].filter(F.col("geography_type").isin(REGION_TYPES))
    return rows.select("geography_id", "geography_code", "geography_name", "geography_type").orderBy(
        "geography_type", "geography_name"
    )


def suppliers(tables: Tables) -> DataFrame:
    return tables["core_dim_supplier"].select(
        "supplier_id", "supplier_name", "supplier_group", "supplier_size"
    ).orderBy("supplier_name")


def companies_and_years(tables: Tables) -> DataFrame:
    """Number of companies and year range of the reliability fact."""
    years = tables["core_dim_date"].select("date_id", "year")
    known = tables["core_dim_company"].select("company_id")
    rows = tables["core_fact_network_reliability"].join(known, "company_id").join(years, "date_id")
    return rows.agg(
        F.countDistinct("company_id").alias("companies"), F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
    )


# ---------------------------------------------------------------------------------------------------------------
# Network.


def loss_and_spend(mart: DataFrame, first: int, last: int, names: Sequence[str] | None = None) -> DataFrame:
    """Losses and spend per year."""
    rows = filters.chosen(filters.years(mart, first, last), "company_name", names)
    return rows.groupBy("year").agg(
        F.sum("ens_mwh").alias("ens_mwh"), F.sum("actual_totex_million_gbp").alias("totex_million_gbp")
    ).orderBy("year")


FUEL_POOR_METRICS = ["fuel_poor_connections_actual", "fuel_poor_connections_target"]


def fuel_poor(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Fuel-poor connections of the year range, or of the latest snapshot when the range has none."""
    listed = filters.metrics(rows, FUEL_POOR_METRICS)
    return in_range_else_latest(listed, first, last).select(
        "year", "company_name", "network_sector", "metric_name", "value", "unit"
    )


def _minutes(commodity: Column, minutes: Column, lost: Column) -> Column:
    """Minutes lost; for gas the lost volume stands in."""
    return F.when(F.lower(commodity) == "gas", F.coalesce(minutes, lost)).otherwise(minutes)


def minutes_lost(
    tables: Tables, staged: DataFrame, first: int, last: int, names: Sequence[str] | None = None,
    commodity: str = "both",
) -> DataFrame:
    """Minutes lost per year and company from the core fact, else from staging."""
    sectors = tables["core_dim_network_sector"].select("network_sector_id", "sector_code", "sector_name", "commodity")
    dims = tables["core_dim_date"].select("date_id", "year")
    company = tables["core_dim_company"].select("company_id", "company_name")
    core = tables["core_fact_network_reliability"].join(dims, "date_id").join(company, "company_id").join(
        sectors, "network_sector_id"
    )
    coded = staged.withColumn("sector_code", L.code_for(F.trim("network_sector"), SECTOR_CODES))
    fallback = coded.join(sectors, "sector_code")

    def shaped(df: DataFrame) -> DataFrame:
        rows = filters.commodity(filters.chosen(filters.years(df, first, last), "company_name", names), commodity)
        return rows.select(
            "year", "company_name", "sector_name", "commodity",
            _minutes(F.col("commodity"), F.col("minutes_lost"), F.col("gas_lost_volume")).alias("minutes_lost"),
            "ens_mwh", "gas_lost_volume",
        )

    return first_nonempty([shaped(core), shaped(fallback)])


PREPAYMENT_METRICS = ["prepayment_price_cap_gbp", "prepayment_svt_market_avg_gbp", "prepayment_cheapest_gbp"]


def prepayment_series(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Prepayment prices of the year range; dated rows and rows without a year are kept."""
    listed = filters.metrics(rows, PREPAYMENT_METRICS)
    kept = listed.filter(
        F.col("year").isNull() | F.col("year").between(first, last) | F.col("period_date").isNotNull()
    )
    return kept.select("period_date", "year", "metric_name", "value", "unit", "commodity").orderBy(
        F.col("period_date").asc_nulls_last(), "year"
    )


SURVEY_METRICS = ["customer_survey_score", "stakeholder_engagement_score", "stakeholder_survey_score"]
CONNECTION_METRICS = ["connection_lvssa_actual_days", "connection_lvssb_actual_days"]


def satisfaction_connections(
    tables: Tables, connections: DataFrame, survey: DataFrame, first: int, last: int,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Satisfaction against connection days, from the core fact, else from raw survey rows."""
    actual = F.col("metric_name").like("connection_%actual%days%") | F.col("metric_name").isin(CONNECTION_METRICS)
    days = filters.years(connections, first, last).groupBy("year", "company_name").agg(
        F.avg(F.when(actual, F.col("value"))).alias("avg_conn_days")
    )
    dims = tables["core_dim_date"].select("date_id", "year")
    company = tables["core_dim_company"].select("company_id", "company_name")
    sectors = tables["core_dim_network_sector"].select("network_sector_id", "sector_name")
    core = tables["core_fact_customer_metrics"].select(
        "date_id", "company_id", "network_sector_id", "satisfaction_score"
    )
    core = core.join(dims, "date_id").join(company, "company_id", "left").join(sectors, "network_sector_id", "left")
    core = core.join(days, ["year", "company_name"], "left").filter(
        F.col("satisfaction_score").isNotNull() | F.col("avg_conn_days").isNotNull()
    )
    columns = ["year", "company_name", "sector_name", "satisfaction_score", "avg_conn_days"]
    scores = filters.metrics(survey, SURVEY_METRICS).groupBy("year", "company_name").agg(
        F.avg("value").alias("satisfaction_score")
    )
    raw = scores.join(days, ["year", "company_name"]).dropna(subset=["satisfaction_score", "avg_conn_days"])
    raw = raw.withColumn("sector_name", F.lit(None).cast("string"))
    return first_nonempty(
        [
            filters.chosen(filters.years(df, first, last), "company_name", names).select(*columns)
            for df in (core, raw)
        ]
    )


def vulnerable_operators(fuel: DataFrame, minutes: DataFrame, alias: DataFrame, sector: str = "GD", n: int = 10) -> DataFrame:
    """Operators with the highest sum of standard scores of fuel-poor connections and minutes lost."""
    lookup = canonical_lookup(alias, sector)

    def by_operator(df: DataFrame, *means: Column) -> DataFrame:
        return with_canonical_name(df, lookup, "company_name", "operator_key").groupBy("operator_key").agg(*means)

    poor = by_operator(
        filters.metrics(fuel, ["fuel_poor_connections_actual"]), F.avg("value").alias("fuel_poor_avg")
    )
    lost = by_operator(
        minutes, F.avg("minutes_lost").alias("minutes_lost_avg"), F.avg("gas_lost_volume").alias("gas_lost_avg")
    )
    both = poor.join(lost, "operator_key", "full_outer")
    scored = composite_score(
        both.withColumns({f"_{c}": F.coalesce(c, F.lit(0.0)) for c in ("fuel_poor_avg", "minutes_lost_avg")}),
        {"_fuel_poor_avg": 1.0, "_minutes_lost_avg": 1.0},
    )
    return top_n(scored.drop("_fuel_poor_avg", "_minutes_lost_avg"), "score", n, ["operator_key"])


# ---------------------------------------------------------------------------------------------------------------
# Markets.


def _one_commodity(choice: str) -> str:
    return "electricity" if choice == "both" else choice


def churn_monthly(rows: DataFrame, first: int, last: int, commodity: str = "both") -> DataFrame:
    """Rows that are about churn, by instrument or metric name."""
    about = F.lower(F.coalesce("instrument", F.lit(""))).like("%churn%") | F.lower("metric_name").like("%churn%")
    kept = filters.commodity(filters.years(rows, first, last), _one_commodity(commodity)).filter(about)
    return kept.select("period_date", "year", "commodity", "instrument", "metric_name", "value", "unit")


VOLATILITY_METRICS = ["volatility_electricity_baseload", "volatility_gas", "volatility_electricity_peakload"]


def volatility_series(rows: DataFrame, core: DataFrame, first: int, last: int) -> DataFrame:
    """Volatility by month from the landed rows, else by year from the core."""
    columns = ["period_date", "year", "commodity", "metric_name", "value", "unit"]
    monthly = filters.metrics(filters.years(rows, first, last), VOLATILITY_METRICS).filter("period_date is not null")
    yearly = filters.metrics(filters.years(core, first, last), VOLATILITY_METRICS)
    return first_nonempty([filters.conform(df, [(c, _KINDS.get(c, "string")) for c in columns]) for df in (monthly, yearly)])


_KINDS = {"period_date": "date", "year": "int", "value": "double"}

RENEWABLE_PATTERNS = ["%wind%", "%solar%", "%hydro%", "%bio%"]


def renewable_share(core: DataFrame, rows: DataFrame, first: int, last: int) -> DataFrame:
    """Renewable percentage of generation per year, from the core, else from landed rows."""
    year = filters.years
    context = year(core, first, last).filter(
        (F.col("commodity") == "electricity") & (F.col("metric_name") == "generation_twh")
        & (F.upper("fuel_source") != "TOTAL")
    )
    landed = year(rows, first, last).filter(
        (F.col("commodity") == "electricity") & F.col("metric_name").isin("generation_share_twh", "generation_twh")
        & ~F.upper(F.coalesce("instrument", F.lit(""))).isin("TOTAL", "")
    )

    def share(df: DataFrame, fuel: str) -> DataFrame:
        return share_of_matching(
            df, ["year"], "value", L.like_any(F.col(fuel), RENEWABLE_PATTERNS), "renewable_pct"
        )

    return first_nonempty([share(context, "fuel_source"), share(landed, "instrument")], value="renewable_pct")


def renewable_share_from_mart(mart: DataFrame, first: int, last: int) -> DataFrame:
    """The same percentage from the market mart."""
    rows = filters.years(mart, first, last).filter(
        (F.col("commodity") == "electricity") & F.col("market_share_pct_2024").isNull()
        & F.col("fuel_value").isNotNull() & (F.upper(F.coalesce("fuel_source", F.lit(""))) != "TOTAL")
    )
    sums = rows.groupBy("year").agg(
        F.sum(F.when(L.like_any(F.col("fuel_source"), RENEWABLE_PATTERNS), F.col("fuel_value"))).alias("_part"),
        F.sum("fuel_value").alias("_total"),
    )
    return sums.filter(F.coalesce("_total", F.lit(0.0)) > 0).select(
        "year", (ratio(F.col("_part"), F.col("_total")) * 100.0).alias("renewable_pct")
    )


def power_price(core: DataFrame, rows: DataFrame, first: int, last: int) -> DataFrame:
    """Mean baseload price per year from the core, else from landed rows."""

    def price(df: DataFrame) -> DataFrame:
        kept = filters.years(df, first, last).filter(F.col("commodity") == "electricity")
        return kept.groupBy("year").agg(metric("avg", "power_price_baseload").alias("power_gbp_mwh"))

    return first_nonempty([price(core), price(rows)], value="power_gbp_mwh")


def power_price_from_mart(mart: DataFrame, first: int, last: int) -> DataFrame:
    rows = filters.years(mart, first, last).filter(
        (F.col("commodity") == "electricity") & F.col("market_share_pct_2024").isNull()
    )
    prices = rows.groupBy("year").agg(F.max("power_baseload_avg").alias("power_gbp_mwh"))
    return prices.filter(F.col("power_gbp_mwh").isNotNull())


SPREADS = {"spark_central": ("avg", "spark_spread_central"), "dark_spread": ("avg", "dark_spread")}


def quarterly_spreads(rows: DataFrame, core: DataFrame, first: int, last: int) -> DataFrame:
    """Spread levels per quarter from dated rows, else per year from the core."""
    names = [name for _, name in SPREADS.values()]

    def listed(df: DataFrame) -> DataFrame:
        return filters.metrics(filters.years(df, first, last), names).filter(F.col("commodity") == "electricity")

    dated = listed(rows).filter("period_date is not null")
    by_quarter = dated.groupBy(F.trunc("period_date", "quarter").alias("quarter_start")).agg(*metric_columns(SPREADS))
    yearly = listed(core).groupBy(F.make_date("year", F.lit(1), F.lit(1)).alias("quarter_start")).agg(
        *metric_columns(SPREADS)
    )
    any_value = F.col("spark_central").isNotNull() | F.col("dark_spread").isNotNull()
    return first_nonempty([by_quarter.filter(any_value), yearly.filter(any_value)])


def bid_offer_weekly(core: DataFrame, rows: DataFrame, first: int, last: int, commodity: str = "electricity") -> DataFrame:
    """Bid-offer spread per week; rows labelled by ISO week get the Monday of that week."""

    def weekly(df: DataFrame) -> DataFrame:
        kept = filters.commodity(filters.years(df, first, last), _one_commodity(commodity)).filter(
            (F.col("metric_name") == "bid_offer_spread")
            & (F.col("period_date").isNotNull() | F.col("period_label").rlike("(?i)^isoweek_[0-9]+"))
        )
        monday = P.iso_week_monday(F.col("year"), P.iso_week_label_number(F.col("period_label")))
        dated = kept.withColumn("period_date", F.coalesce("period_date", monday)).filter("period_date is not null")
        return dated.select("period_date", "period_label", "year", "commodity", F.col("value").alias("bid_offer_spread"))

    return first_nonempty([weekly(core), weekly(rows)], value="bid_offer_spread")


def metric_availability(sources: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Year range and row count of a metric per source."""
    rows = [
        filters.metrics(df, [name]).agg(
            F.lit(source).alias("source"), F.min("year").alias("y_min"), F.max("year").alias("y_max"),
            F.count("*").alias("n"),
        )
        for source, df in sources.items()
    ]
    return union_all(rows)


def generation_concentration(core: DataFrame, rows: DataFrame) -> DataFrame:
    """Concentration of generation (0-10,000) per year from the share fact, else from landed rows."""
    columns = ["year", "company_name", "share_pct"]
    shares = core.filter(F.col("commodity") == "electricity").select(*columns)
    landed = filters.metrics(rows, ["generation_market_share_pct"]).withColumn("share_pct", F.col("value"))
    both = first_nonempty([shares, landed.select(*columns)])
    return concentration_10000(both, ["year"], "share_pct")


def generation_concentration_from_mart(mart: DataFrame, first: int, last: int) -> DataFrame:
    rows = filters.years(mart, first, last).filter(F.col("market_share_pct_2024").isNotNull())
    return concentration_10000(rows, ["year", "commodity"], "market_share_pct_2024")


def churn_annual(mart: DataFrame, first: int, last: int, commodity: str = "both") -> DataFrame:
    rows = filters.years(mart, first, last).filter(
        (F.col("commodity") == _one_commodity(commodity)) & F.col("market_share_pct_2024").isNull()
    )
    return rows.groupBy("year").agg(F.max("churn_ratio_avg").alias("churn_ratio_avg"))


def daily_monitoring(mart: DataFrame, first: int, last: int, commodity: str = "both") -> DataFrame:
    rows = filters.commodity(mart, commodity)
    return slice_years(rows, first, last, ["year", "commodity", "source_name", "metric_name"])


def daily_series(daily: DataFrame, first: int, last: int, commodity: str = "both") -> DataFrame:
    """Daily rows between the first day of one year and the last day of another; the range reaches the scan."""
    start = F.make_date(F.lit(first), F.lit(1), F.lit(1))
    end = F.make_date(F.lit(last), F.lit(12), F.lit(31))
    rows = filters.commodity(daily, commodity).filter(F.col("period_date").between(start, end))
    return rows.select(
        "period_date", F.year("period_date").alias("year"), "commodity", "source_name", "metric_name", "value", "unit"
    ).orderBy("period_date", "commodity", "source_name", "metric_name")


# ---------------------------------------------------------------------------------------------------------------
# Statistics and energy flows.


def energy_ratio(primary: DataFrame, first: int, last: int) -> DataFrame:
    return slice_years(primary, first, last, ["year"])


def expenditure_by_sector(rows: DataFrame, first: int, last: int) -> DataFrame:
    return slice_years(rows, first, last, ["year", "sector"])


def final_consumption(rows: DataFrame, first: int, last: int, sector: str | None = None) -> DataFrame:
    kept = rows if sector in (None, "all") else rows.filter(F.col("sector") == sector)
    return slice_years(kept, first, last, ["year", "sector", "fuel_type"])


def primary_fuels(rows: DataFrame, first: int, last: int) -> DataFrame:
    return slice_years(rows, first, last, ["year", "fuel_type"])


# Column → (aggregate, metric) of the network cost proxy.
COST_PROXY_COLUMNS = {
    "elec_tx_avg_gbp": ("avg", "cost_per_customer_et_gbp"),
    "elec_dx_avg_gbp": ("avg", "cost_per_customer_ed_gbp"),
    "gas_tx_avg_gbp": ("avg", "cost_per_customer_gt_gbp"),
    "gas_dx_avg_gbp": ("avg", "cost_per_customer_gd_gbp"),
}


def network_cost_proxy(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Mean network cost per customer by network type and year."""
    return pivot_metrics(filters.years(rows, first, last), ["year"], COST_PROXY_COLUMNS)


def flow_bridge(bridge: DataFrame, first: int, last: int) -> DataFrame:
    return slice_years(bridge, first, last, ["reference_year", "bridge_code"], year="reference_year")


def flow_rows(matrix: DataFrame, table_id: str, first: int, last: int, industry: str = "A_U") -> DataFrame:
    """Rows of one flow table for one industry column (the whole economy by default)."""
    rows = matrix.filter((F.col("table_id") == table_id) & (F.col("industry_code") == industry))
    columns = ["reference_year", "row_no", "row_code", "row_label", "energy_tj", "source_file"]
    return slice_years(
        rows, first, last, ["reference_year", "row_no", "row_code"], "reference_year", columns=columns
    )


def flow_top_supply(matrix: DataFrame, first: int, last: int, n: int = 25) -> DataFrame:
    rows = flow_rows(matrix, "A", first, last).drop("row_no")
    return top_n(rows, "energy_tj", n, ["reference_year", "row_code"])


def digest_tables(digest: DataFrame) -> DataFrame:
    return filters.distinct_values(digest, ["dukes_table"])


def digest_metrics(digest: DataFrame, table: str) -> DataFrame:
    return filters.distinct_values(digest.filter(F.col("dukes_table") == table), ["metric_name"])


def digest_rows(digest: DataFrame, table: str, first: int, last: int, name: str | None = None) -> DataFrame:
    """Rows of one statistical table; rows without a year (cumulative columns) are kept."""
    rows = digest.filter(F.col("dukes_table") == table)
    rows = filters.metrics(rows, [name]) if name else rows
    return slice_years(
        rows, first, last, ["period_year", "row_label", "column_label", "metric_name"], "period_year", True
    )


# ---------------------------------------------------------------------------------------------------------------
# Assets, environment, regulation.


def canonical_metric(
    rows: DataFrame, alias: DataFrame, first: int, last: int, names: Sequence[str] | None, sector: str
) -> DataFrame:
    """Metric rows of a year range with canonical company names (undergrounding, risk reduction, …)."""
    kept = filters.years(rows, first, last)
    kept = filters.metrics(kept, names) if names else kept
    named = with_canonical_name(kept, canonical_lookup(alias, sector), "company_name")
    return named.select("year", "company_name", "metric_name", "value")


def canonical_reliability(
    tables: Tables, alias: DataFrame, measure: str, first: int, last: int, commodity: str, sector: str
) -> DataFrame:
    """One reliability measure of the distribution companies of a commodity, under canonical names."""
    sectors = tables["core_dim_network_sector"].filter(
        L.like_any(F.col("sector_name"), ["%distribution%"]) & (F.lower("commodity") == commodity)
    ).select("network_sector_id")
    rows = tables["core_fact_network_reliability"].join(sectors, "network_sector_id", "left_semi")
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first, last)
    company = tables["core_dim_company"].select("company_id", "company_name")
    named = with_canonical_name(
        rows.join(years, "date_id").join(company, "company_id"), canonical_lookup(alias, sector), "company_name"
    )
    return named.select("year", "company_name", measure)


def emission_loss_spend(
    regulatory: DataFrame, cost: DataFrame, tables: Tables, first: int, last: int
) -> DataFrame:
    """SF6, losses and spend of transmission companies, from the two marts, else from three facts."""
    keys = ["year", "company_name", "sector_name"]
    transmission = L.like_any(F.col("sector_name"), ["%transmission%"])
    left = regulatory.select(*keys, "sf6_kg", "rore_pct")
    both = left.join(cost.select(*keys, "ens_mwh", "actual_totex_million_gbp"), keys)
    ids = ["date_id", "company_id", "network_sector_id"]
    facts = tables["core_fact_emissions"].select(*ids, "sf6_kg")
    facts = facts.join(tables["core_fact_network_reliability"].select(*ids, "ens_mwh"), ids)
    facts = facts.join(tables["core_fact_financial_performance"].select(*ids, "actual_totex_million_gbp"), ids)
    facts = facts.join(tables["core_dim_date"].select("date_id", "year"), "date_id")
    facts = facts.join(tables["core_dim_company"].select("company_id", "company_name"), "company_id")
    facts = facts.join(tables["core_dim_network_sector"].select("network_sector_id", "sector_name"), "network_sector_id")
    facts = facts.withColumn("rore_pct", F.lit(None).cast("double"))
    columns = [*keys, "sf6_kg", "ens_mwh", "actual_totex_million_gbp", "rore_pct"]
    return first_nonempty(
        [filters.years(df.filter(transmission), first, last).select(*columns) for df in (both, facts)]
    )


def network_availability(rows: DataFrame, first: int, last: int) -> DataFrame:
    return slice_years(rows, first, last, columns=["year", "company_name", "network_sector", "metric_name", "value"])


# Baseline and comparison years, in order of preference.
YEAR_PAIRS = [(2014, 2021), (2013, 2021), (2014, 2022), (2015, 2023), (2012, 2020), (2011, 2019)]


def baseline_compare(
    sources: Sequence[DataFrame],
    alias: DataFrame,
    value: str = "sf6_kg",
    pairs: Sequence[tuple[int, int]] = tuple(YEAR_PAIRS),
    sector: str = "ET",
) -> DataFrame:
    """Change of a measure between two years for the first year pair and source that have any value.

    ``sources`` are (year, company_name, value) tables in order of preference. All pairs of all sources are evaluated in
    one pass: every row is offered to the pairs its year belongs to, and the best (pair, source) is picked at the end.
    """
    offers = F.array(
        *[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("y0"), F.lit(b).alias("y1")) for i, (a, b) in enumerate(pairs)]
    )
    tagged = union_all(
        [s.select("year", "company_name", F.col(value).alias("_v"), F.lit(j).alias("_src")) for j, s in enumerate(sources)]
    )
    offered = tagged.withColumn("_o", F.explode(offers)).filter(
        (F.col("year") == F.col("_o.y0")) | (F.col("year") == F.col("_o.y1"))
    )
    both = offered.groupBy((F.col("_o.pair") * len(sources) + F.col("_src")).alias("_place"), "_o.y0", "_o.y1", "company_name").agg(
        F.max(F.when(F.col("year") == F.col("_o.y0"), F.col("_v"))).alias("baseline"),
        F.max(F.when(F.col("year") == F.col("_o.y1"), F.col("_v"))).alias("compare"),
    )
    known = both.filter(F.col("baseline").isNotNull() | F.col("compare").isNotNull())
    best = known.agg(F.min("_place")).scalar()
    chosen = known.filter(F.col("_place") == best)
    delta = F.col("compare") - F.col("baseline")
    rows = chosen.select(
        "company_name", F.col("y0").alias("baseline_year"), F.col("y1").alias("compare_year"),
        F.col("baseline").alias("baseline_value"), F.col("compare").alias("compare_value"),
        delta.alias("delta"), (ratio(delta, F.col("baseline")) * 100.0).alias("pct_change"),
    )
    named = with_canonical_name(rows, canonical_lookup(alias, sector), "company_name")
    order = [F.col(c).desc_nulls_last() for c in ("pct_change", "baseline_value", "compare_value")]
    return first_per_key(named, ["company_name"], order)


def transmission_emissions(core: Tables, staged: DataFrame, rows: DataFrame) -> list[DataFrame]:
    """The three sources of the SF6 comparison, in order: core, staging, landed rows."""
    sector = core["core_dim_network_sector"].filter(F.col("sector_code") == "ET").select("network_sector_id")
    facts = core["core_fact_emissions"].join(sector, "network_sector_id", "left_semi")
    facts = facts.join(core["core_dim_date"].select("date_id", "year"), "date_id")
    facts = facts.join(core["core_dim_company"].select("company_id", "company_name"), "company_id")
    name = F.trim("network_sector")
    is_transmission = F.lower(name).like("%electricity%transmission%") | (name == "ET")
    landed = filters.metrics(rows, ["sf6_kg"]).filter(is_transmission).groupBy("year", "company_name").agg(
        F.max("value").alias("sf6_kg")
    )
    return [facts, staged.filter(F.col("network_sector") == "ET"), landed]


def generation_mix(rows: DataFrame, first: int, last: int) -> DataFrame:
    kept = filters.metrics(filters.years(rows, first, last), ["generation_share_twh"])
    return kept.select("period_date", "year", F.col("instrument").alias("fuel_source"), F.col("value").alias("twh"))


def connections_activity(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Connection counts of transmission companies."""
    kept = filters.years(rows, first, last).filter(L.like_any(F.col("network_sector"), ["%transmission%"]))
    counted = F.when(F.col("metric_name").ilike("%connection%"), F.col("value"))
    return kept.groupBy("year", "company_name", "network_sector").agg(F.sum(counted).alias("connections_activity"))


def transmission_spend(tables: Tables, first: int, last: int) -> DataFrame:
    """Spend of transmission companies, one year earlier than asked for (for lagged pairs)."""
    sectors = tables["core_dim_network_sector"].filter(L.like_any(F.col("sector_name"), ["%transmission%"]))
    rows = tables["core_fact_financial_performance"].join(
        sectors.select("network_sector_id", "sector_name"), "network_sector_id"
    )
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first - 1, last)
    company = tables["core_dim_company"].select("company_id", "company_name")
    return rows.join(years, "date_id").join(company, "company_id").select(
        "year", "company_name", "sector_name", "actual_totex_million_gbp"
    )


def regulatory(mart: DataFrame, first: int, last: int, names: Sequence[str] | None = None) -> DataFrame:
    return filters.chosen(filters.years(mart, first, last), "company_name", names)


def return_and_loss(tables: Tables, first: int, last: int) -> DataFrame:
    """Return and losses of electricity transmission companies."""
    ids = ["date_id", "company_id", "network_sector_id"]
    sectors = tables["core_dim_network_sector"].filter(
        L.like_any(F.col("sector_name"), ["%transmission%"]) & (F.lower("commodity") == "electricity")
    )
    rows = tables["core_fact_financial_performance"].select(*ids, "rore_pct").join(
        tables["core_fact_network_reliability"].select(*ids, "ens_mwh"), ids
    ).join(sectors.select("network_sector_id"), "network_sector_id", "left_semi")
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first, last)
    company = tables["core_dim_company"].select("company_id", "company_name")
    return rows.join(years, "date_id").join(company, "company_id").select(
        "year", "company_name", "rore_pct", "ens_mwh"
    ).orderBy("company_name", "year")


def efficiency_rank(mart: DataFrame, first: int, last: int) -> DataFrame:
    """Spend ratio per improvement of reliability, best first."""
    rows = filters.years(mart, first, last)
    changed = with_changes(rows, ["company_name", "sector_name"], "year", {"rel_improve": "reliability_rate"})
    spend_ratio = ratio(F.col("actual_totex_million_gbp"), F.col("totex_allowance_million_gbp"))
    scored = changed.filter("rel_improve is not null").select(
        "year", "company_name", "sector_name", spend_ratio.alias("spend_ratio"), "rel_improve",
        F.try_divide(spend_ratio, F.col("rel_improve")).alias("efficiency_score"),
    )
    return scored.orderBy(F.col("efficiency_score").desc_nulls_last(), "year", "company_name")


def connection_totals(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Connections of both transmission networks per year."""

    def total(pattern: str) -> Column:
        return F.sum(F.when(L.like_any(F.col("network_sector"), [pattern]), F.col("value")))

    return filters.years(rows, first, last).groupBy("year").agg(
        total("%electricity%transmission%").alias("elec_tx"), total("%gas%transmission%").alias("gas_tx")
    )


def impact_by_region(
    impact: DataFrame, places: DataFrame, first: int, last: int, geography_ids: Sequence[int] | None = None
) -> DataFrame:
    """Output at risk per year and region, for chosen regions."""
    rows = filters.years(impact, first, last)
    if geography_ids:
        codes = filters.chosen(places, "geography_id", geography_ids).select("geography_code")
        rows = rows.join(codes, "geography_code", "left_semi")
    return rows.groupBy("year", "geography_code", "geography_name").agg(
        F.sum("output_at_risk_gbp").alias("output_at_risk_gbp")
    )


def top_industries(impact: DataFrame, first: int, last: int, n: int = 15) -> DataFrame:
    sums = filters.years(impact, first, last).groupBy("industry_name").agg(
        F.sum("output_at_risk_gbp").alias("output_at_risk_gbp")
    )
    return top_n(sums, "output_at_risk_gbp", n, ["industry_name"])


def cross_commodity(mart: DataFrame, first: int, last: int, names: Sequence[str] | None = None) -> DataFrame:
    rows = filters.chosen(mart, "geography_name", names)
    return slice_years(rows, first, last, ["year", "geography_name", "commodity", "sector_name"])


def forecast_input(mart: DataFrame, tables: Tables, first: int, last: int, company: str) -> DataFrame:
    """Yearly losses of a company: from the mart, from the core (also under the name without a suffix), or the gas
    volume lost as a stand-in. The first two need at least three years with values."""
    base = company.split(" (", 1)[0].strip()
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first, last)
    known = tables["core_dim_company"].filter(F.col("company_name").isin(company, base)).select("company_id")
    facts = tables["core_fact_network_reliability"].join(known, "company_id", "left_semi").join(years, "date_id")
    in_mart = filters.years(mart, first, last).filter(F.col("company_name") == company)

    def series(df: DataFrame, column: str, name: str) -> DataFrame:
        sums = df.groupBy("year").agg(F.sum(column).alias("ens_mwh"))
        return sums.withColumn("metric_name", F.lit(name))

    lost = facts.filter("gas_lost_volume is not null")
    return first_nonempty(
        [
            series(in_mart, "ens_mwh", "ens_mwh"), series(facts, "ens_mwh", "ens_mwh"),
            series(lost, "gas_lost_volume", "gas_lost_volume_proxy"),
        ],
        value="ens_mwh", min_rows=[3, 3, 1],
    )


# ---------------------------------------------------------------------------------------------------------------
# Retail.


def by_supplier(df: DataFrame, ids: Sequence[int] | None) -> DataFrame:
    return filters.chosen(df, "supplier_id", ids)


def supplier_health(
    mart: DataFrame, tables: Tables, first: int, last: int, ids: Sequence[int] | None = None
) -> DataFrame:
    """Supplier health from the stored mart, else computed from the core; ``source`` tells which."""
    computed = marts.supplier_health(tables)
    frames = [by_supplier(filters.years(df.select(*computed.columns), first, last), ids) for df in (mart, computed)]
    chosen = first_nonempty(frames, tag="_place")
    return chosen.withColumn(
        "source", F.when(F.col("_place") == 1, F.lit("mart")).otherwise(F.lit("fallback"))
    ).drop("_place")


def vulnerability(mart: DataFrame, first: int, last: int, commodity: str, method: str | None = None) -> DataFrame:
    rows = filters.payment(filters.commodity(mart, commodity), method)
    return slice_years(rows, first, last, ["year", "quarter", "commodity", "payment_method"])


def retail_concentration(tables: Tables, first: int, last: int, commodity: str = "both") -> DataFrame:
    """Mean 0-1 concentration of the retail markets per year."""
    rows = filters.commodity(tables["core_fact_market_share_retail"], commodity)
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first, last)
    per_market = concentration(rows.join(years, "date_id"), ["year", "commodity"], "share_pct")
    return per_market.groupBy("year").agg(F.avg("hhi_0_1").alias("hhi_0_1"))


def retail_concentration_latest(tables: Tables, first: int, last: int, commodity: str = "both") -> DataFrame:
    """The last known concentration in the range."""
    rows = retail_concentration(tables, first, last, commodity).filter("hhi_0_1 is not null")
    return rows.agg(F.max_by("hhi_0_1", "year").alias("hhi_latest"), F.max("year").alias("year"))


def customer_accounts(tables: Tables, first: int, last: int, commodity: str, ids: Sequence[int] | None = None) -> DataFrame:
    dates = tables["core_dim_date"].filter("quarter is null").select("date_id", "year")
    names = tables["core_dim_supplier"].select("supplier_id", "supplier_name")
    rows = by_supplier(filters.commodity(tables["core_fact_customer_accounts_retail"], commodity), ids)
    rows = rows.join(filters.years(dates, first, last), "date_id").join(names, "supplier_id", "left")
    return rows.select("year", "supplier_name", "commodity", "segment", "tariff_type", "value", "unit")


def heating_systems(tables: Tables, first: int, last: int) -> DataFrame:
    dates = filters.years(tables["core_dim_date"].select("date_id", "year", "quarter"), first, last)
    rows = tables["core_fact_heating_systems"].join(dates, "date_id")
    return rows.select("year", "quarter", "component", "value", "unit")


def disconnections(
    tables: Tables, first: int, last: int, commodity: str = "both", ids: Sequence[int] | None = None, n: int = 15
) -> DataFrame:
    """Disconnections for debt per year and supplier: of the chosen suppliers, or of the n largest."""
    rows = filters.metrics(tables["core_fact_consumer_disconnections"], ["disconnections_for_debt"])
    rows = by_supplier(filters.commodity(rows.filter("supplier_id is not null"), commodity), ids)
    years = filters.years(tables["core_dim_date"].select("date_id", "year"), first, last)
    names = tables["core_dim_supplier"].select("supplier_id", "supplier_name")
    yearly = rows.join(years, "date_id").groupBy("year", "supplier_id").agg(
        F.sum("value").alias("disconnections_for_debt")
    ).join(names, "supplier_id")
    kept = yearly if ids else top_entities(yearly, ["supplier_id"], F.sum("disconnections_for_debt"), n)
    return kept.select("year", "supplier_id", "supplier_name", "disconnections_for_debt")


def competition(mart: DataFrame, first: int, last: int, commodity: str = "both") -> DataFrame:
    return slice_years(filters.commodity(mart, commodity), first, last, ["year", "quarter", "commodity"])


def affordability(mart: DataFrame, first: int, last: int, method: str | None = None) -> DataFrame:
    """Affordability layers; rows without a payment method belong to every method."""
    return slice_years(filters.payment(mart, method, keep_null=True), first, last, ["layer", "year", "quarter"])


def complaints(mart: DataFrame, first: int, last: int, ids: Sequence[int] | None = None) -> DataFrame:
    return slice_years(by_supplier(mart, ids), first, last, ["year", "quarter", "supplier_name"])


INCIDENT_METRICS = [
    "minor_incidents_historical", "minor_incidents_current", "major_incidents_historical", "major_incidents_current",
]


def incidents(mart: DataFrame, first: int, last: int, ids: Sequence[int] | None = None) -> DataFrame:
    """Incident counts per supplier and year in columns."""
    keys = ["year", "supplier_id", "supplier_name", "supplier_group", "supplier_size"]
    rows = filters.metrics(by_supplier(filters.years(mart, first, last), ids), INCIDENT_METRICS)
    return pivot_metrics(rows.dropna(subset=keys), keys, {m: ("max", m) for m in INCIDENT_METRICS})


def satisfaction(mart: DataFrame, first: int, last: int, ids: Sequence[int] | None = None) -> DataFrame:
    return slice_years(by_supplier(mart, ids), first, last, ["year", "quarter", "supplier_name"])


def cross_layer(mart: DataFrame, first: int, last: int, ids: Sequence[int] | None = None) -> DataFrame:
    """Any of the cross-layer marts, optionally for chosen suppliers."""
    rows = by_supplier(mart, ids) if "supplier_id" in mart.columns else mart
    return slice_years(rows, first, last, ["year"])


# ---------------------------------------------------------------------------------------------------------------
# Renewables, schemes, discount.


def deployment(mart: DataFrame, grain: str, first: int, last: int) -> DataFrame:
    """One grain of the deployment mart with the columns it defines."""
    columns = {
        "annual_gb": [
            "year", "technology", "capacity_kw", "installations", "cumulative_capacity_kw", "cumulative_installations",
        ],
        "quarterly_gb": [
            "year", "quarter", "period_date", "technology", "capacity_kw_quarter", "installations_quarter",
        ],
        "regional": ["year", "region", "technology", "share_pct", "capacity_kw", "installations"],
        "by_installation_type": [
            "year", "installation_type", "technology", "capacity_kw", "installations", "cumulative_capacity_kw",
            "cumulative_installations",
        ],
    }[grain]
    return slice_years(mart.filter(F.col("grain") == grain), first, last, ["year", "technology"], columns=columns)


def obligation_by_technology(mart: DataFrame) -> DataFrame:
    return mart.orderBy("obligation_period", "technology")


def official_series(mart: DataFrame, grain: str, name: str, first: int, last: int) -> DataFrame:
    """One official series per technology (generation, load factors)."""
    rows = mart.filter((F.col("grain") == grain) & (F.col("metric_name") == name))
    rows = filters.years(rows, first, last, "period_year")
    return rows.select(F.col("period_year").alias("year"), F.trim("row_label").alias("technology"), "value")


def official_share(
    mart: DataFrame, first: int, last: int, label: str = "Renewable share of gross final electricity consumption"
) -> DataFrame:
    """Renewable share of final electricity per year: a fraction, the first matching row per year."""
    rows = mart.filter(
        (F.col("grain") == "gross_final_consumption")
        & (F.col("metric_name") == "gfc_electricity_renewable_share_pct")
        & F.col("value").between(0, 1)
        & F.trim("row_label").ilike(f"%{label}%")
    )
    rows = filters.years(rows, first, last, "period_year")
    one = first_per_key(rows, ["period_year"], [F.trim("row_label"), F.col("value")])
    return one.select(F.col("period_year").alias("year"), F.col("value").alias("renewable_share"))


def scheme_keys(mart: DataFrame, first: int, last: int) -> DataFrame:
    rows = filters.years(mart, first, last, "calendar_year", keep_null=True)
    return rows.groupBy("scheme_key").agg(F.count("*").alias("n"))


def scheme_metric_names(mart: DataFrame, first: int, last: int, scheme: str | None = None) -> DataFrame:
    rows = filters.years(mart, first, last, "calendar_year", keep_null=True)
    rows = rows.filter(F.col("scheme_key") == scheme) if scheme else rows
    return rows.groupBy("metric_name").agg(F.count("*").alias("n"))


def scheme_rows(
    mart: DataFrame, first: int, last: int, scheme: str | None = None, name: str | None = None, limit: int | None = None
) -> DataFrame:
    """Scheme rows for a table in a fixed order: all of them, or the first ``limit``."""
    rows = filters.years(mart, first, last, "calendar_year", keep_null=True)
    rows = rows.filter(F.col("scheme_key") == scheme) if scheme else rows
    rows = rows.filter(F.col("metric_name") == name) if name else rows
    order = ["calendar_year", "scheme_key", "metric_name", "period_date", "period_label", "entity", "source_file"]
    rows = rows.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return rows if limit is None else rows.limit(limit)


def discount_national(mart: DataFrame, first: int, last: int) -> DataFrame:
    """National rows of the discount scheme in the range, else all of them."""
    rows = mart.filter(F.col("grain") == "national").select(
        "scheme_year", "calendar_year", "nation", "expenditure_pct", "scheme_value_mgbp", "source_file"
    )
    return first_nonempty([filters.years(rows, first, last, "calendar_year", keep_null=True), rows])


def discount_suppliers(mart: DataFrame, first: int, last: int, ids: Sequence[int] | None = None) -> DataFrame:
    rows = by_supplier(mart.filter(F.col("grain") == "supplier"), ids)
    return filters.years(rows, first, last, "calendar_year", keep_null=True).select(
        "scheme_year", "calendar_year", "supplier_id", "supplier_name", "supplier_group", "supplier_size",
        "obligation_method", "obligation_amount_mgbp", "redistributed_mgbp", "source_file",
    )


# ---------------------------------------------------------------------------------------------------------------
# Summary packs: one row of headline figures each.


def _ends(df: DataFrame, value: str, prefix: str, order: str = "year") -> DataFrame:
    """Last value of a series and its change since the first, as one row."""
    ends = first_and_last(df, [], order, value)
    return ends.select(F.col("last_value").alias(f"{prefix}_latest"), F.col("change_pct").alias(f"{prefix}_change_pct"))


def _side_by_side(frames: Sequence[DataFrame]) -> DataFrame:
    """One-row frames as one row: the first keeps its columns, the others come in as scalars."""
    first, *rest = frames
    for frame in rest:
        packed = frame.select(F.struct(*frame.columns)).scalar()
        first = first.withColumns({c: packed.getField(c) for c in frame.columns})
    return first


def network_summary(mart: DataFrame, first: int, last: int, names: Sequence[str] | None = None) -> DataFrame:
    trend = loss_and_spend(mart, first, last, names)
    return _side_by_side([_ends(trend, "ens_mwh", "ens"), _ends(trend, "totex_million_gbp", "totex")])


def retail_summary(health: DataFrame, first: int, last: int) -> DataFrame:
    """Active suppliers, total profit and concentration per year, reduced to their latest values."""
    yearly = filters.years(health, first, last).groupBy("year").agg(
        F.max("active_suppliers_avg").alias("active"), F.sum("profit_million_gbp").alias("profit"),
        F.max("hhi").alias("hhi"),
    )
    return _side_by_side(
        [
            _ends(yearly, "active", "active_suppliers"),
            _ends(yearly, "profit", "profit").select("profit_latest"),
            _ends(yearly, "hhi", "hhi").select("hhi_latest"),
        ]
    )


def social_summary(mart: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the discount scheme inside the range and overall, with the number of nations."""
    rows = mart.filter(F.col("grain") == "national")
    inside = F.col("calendar_year").isNull() | F.col("calendar_year").between(first, last)
    return rows.agg(
        F.count_if(inside).alias("rows_in_range"), F.count("*").alias("rows_total"),
        F.countDistinct(F.when(inside, F.col("nation"))).alias("nations_in_range"),
    )


def macro_summary(primary: DataFrame, deployed: DataFrame, first: int, last: int) -> DataFrame:
    """Energy ratio and cumulative renewable capacity: latest values and changes."""
    capacity = deployment(deployed, "annual_gb", first, last).groupBy("year").agg(
        (F.sum("cumulative_capacity_kw") / 1_000_000.0).alias("gw")
    )
    return _side_by_side(
        [_ends(filters.years(primary, first, last), "energy_ratio", "energy_ratio"), _ends(capacity, "gw", "capacity_gw")]
    )


def cross_summary(cost: DataFrame, volatility: DataFrame, first: int, last: int) -> DataFrame:
    """Latest network share of the price cap and the row counts of both cross-layer marts."""
    rows = filters.years(cost, first, last)
    latest = rows.agg(
        F.max_by("network_gbp", "year").alias("_n"), F.max_by("total_cap_gbp", "year").alias("_t"),
        F.count("*").alias("cost_rows"),
    ).select((ratio(F.col("_n"), F.col("_t")) * 100.0).alias("network_share_pct"), "cost_rows")
    counted = filters.years(volatility, first, last).agg(F.count("*").alias("volatility_rows"))
    return _side_by_side([latest, counted])


def household_spend_latest(mart: DataFrame, first: int, last: int) -> DataFrame:
    rows = filters.years(mart.filter(F.col("layer") == "household_spend"), first, last).filter("value_pct is not null")
    return rows.agg(F.max_by("value_pct", "year").alias("household_energy_spend_pct_latest"))


def headline(packs: Sequence[DataFrame]) -> DataFrame:
    """The summary packs in one row."""
    return _side_by_side(packs)
