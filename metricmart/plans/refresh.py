"""The whole refresh: landing tables → staging → core → marts, one stored snapshot per table and run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from metricmart.operators import audit
from metricmart.operators import dimensions as D
from metricmart.operators.quality import check_counts, check_keys, check_rows, check_unmatched, enforce, report
from metricmart.operators.registry import run_registry
from metricmart.plans import core, marts, staging
from metricmart.sources.sinks import Stage
from metricmart.sources.versions import PartitionedFact
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def build_staging(raw: Tables) -> dict[str, DataFrame]:
    """All staging tables. ``raw`` holds the landing tables by name."""
    company, supplier = raw["company_alias"], raw["supplier_alias"]
    tables = {
        "stg_network_reliability": staging.network_reliability(raw["doc_reliability"], raw["raw_reliability"], company),
        "stg_financial_performance": staging.financial_performance(
            raw["doc_expenditure"], raw["doc_rore"], raw["raw_expenditure"], raw["raw_rore"], company
        ),
        "stg_customer_metrics": staging.customer_metrics(
            raw["doc_customer_metrics"], raw["raw_customer_satisfaction"], company
        ),
        "stg_emissions": staging.emissions(raw["doc_emissions"], raw["raw_emissions"], company),
        "stg_energy_intensity": staging.energy_intensity(raw["doc_energy_intensity"]),
        "stg_sector_fuel_use": staging.sector_fuel_use(raw["doc_sector_fuel_use"]),
        "stg_regional_gva": staging.regional_gva(raw["doc_regional_gva"]),
        "stg_lcree": staging.lcree(raw["doc_lcree"]),
        "stg_intermediate_consumption": staging.intermediate_consumption(raw["doc_intermediate_consumption"]),
        "stg_market_prices": staging.market_prices(raw["raw_market_prices"]),
        "stg_market_context": staging.market_context(raw["raw_generation_mix"], raw["raw_gas_supply"]),
        "stg_market_share": staging.market_share(raw["raw_generation_share"]),
        "stg_daily_market_prices": staging.daily_prices(raw["doc_daily_market_prices"]),
        "stg_renewables_obligation": staging.renewables_obligation(raw["raw_renewables"]),
        "stg_scheme_metric": staging.scheme_metrics(raw["raw_scheme_metric"]),
    }
    tables |= staging.retail_topics(
        raw["raw_supplier_metric"], raw["raw_retail_timeseries"], raw["raw_retail_snapshot"], supplier
    )
    tables["stg_statistical_digest"] = staging.statistical_digest([raw["raw_statistical_digest"]])
    tables |= staging.energy_flows(raw["raw_energy_flows"], raw["raw_energy_flow_bridge"])
    tables |= staging.renewables(raw["raw_renewables"])
    tables |= staging.discount_scheme(raw["raw_whd"])
    return tables


def build_dimensions(spark: SparkSession, raw: Tables, staged: Tables, before) -> dict[str, DataFrame]:
    """All dimensions; ``before`` returns the table of the previous run or None, so that ids stay."""
    sectors = D.sector_dimension(spark)
    return {
        "core_dim_date": D.date_dimension(spark),
        "core_dim_geography": D.geography_dimension(spark),
        "core_dim_network_sector": sectors,
        "core_dim_payment_method": D.payment_method_dimension(spark),
        "core_dim_supplier_size": D.supplier_size_dimension(spark),
        "core_dim_riio_period": D.scheme_period_dimension(spark),
        "core_dim_company": D.company_dimension(raw["company_alias"], sectors, before("core_dim_company")),
        "core_dim_industry": D.industry_dimension(
            [staged["stg_energy_intensity"], staged["stg_intermediate_consumption"]], before("core_dim_industry")
        ),
        "core_dim_supplier": D.supplier_dimension(
            raw["supplier_alias"], [raw["raw_supplier_metric"], raw["raw_retail_snapshot"]],
            before("core_dim_supplier"),
        ),
    }


def dimension_set(tables: Tables) -> core.Dimensions:
    return core.Dimensions(
        dates=tables["core_dim_date"],
        geographies=tables["core_dim_geography"],
        sectors=tables["core_dim_network_sector"],
        companies=tables["core_dim_company"],
        industries=tables["core_dim_industry"],
        suppliers=tables["core_dim_supplier"],
        payment_methods=tables["core_dim_payment_method"],
        supplier_sizes=tables["core_dim_supplier_size"],
    )


# Long retail fact → its staging table.
RETAIL_STAGING = {
    "supplier_financial": "stg_supplier_profits",
    "consumer_debt": "stg_consumer_debt",
    "consumer_disconnections": "stg_consumer_disconnections",
    "switching_activity": "stg_switching",
    "tariff_benchmarks": "stg_tariffs_price_cap",
    "bill_breakdown": "stg_bill_breakdown",
    "complaints_resolution": "stg_complaints",
    "satisfaction_scores": "stg_satisfaction",
    "market_structure": "stg_market_structure",
}


def build_facts(staged: Tables, dims: core.Dimensions, target) -> dict[str, DataFrame]:
    """All facts, upserted into what ``target`` returns for each: a ``PartitionedFact``, a table, or None."""
    s = staged

    def old(name: str) -> core.Target:
        return target(f"core_fact_{name}")

    facts = {
        "network_reliability": core.network_reliability(
            s["stg_network_reliability"], s["stg_market_context"], dims, old("network_reliability")
        ),
        "financial_performance": core.financial_performance(
            s["stg_financial_performance"], dims, old("financial_performance")
        ),
        "customer_metrics": core.customer_metrics(s["stg_customer_metrics"], dims, old("customer_metrics")),
        "emissions": core.emissions(s["stg_emissions"], dims, old("emissions")),
        "energy_intensity": core.energy_intensity(
            s["stg_energy_intensity"], s["stg_sector_fuel_use"], dims, old("energy_intensity")
        ),
        "regional_gva": core.regional_gva(s["stg_regional_gva"], dims, old("regional_gva")),
        "input_output": core.input_output(s["stg_intermediate_consumption"], dims, old("input_output")),
        "market_prices": core.market_prices(s["stg_market_prices"], dims, old("market_prices")),
        "market_context": core.market_context(s["stg_market_context"], dims, old("market_context")),
        "market_share": core.market_share(s["stg_market_share"], old("market_share")),
        "daily_prices": core.daily_prices(s["stg_daily_market_prices"], dims, old("daily_prices")),
        "market_share_retail": core.market_share_retail(
            s["stg_market_share_retail"], dims, old("market_share_retail")
        ),
        "household_spend": core.household_spend(s["stg_household_spend"], dims, old("household_spend")),
        "customer_accounts_retail": core.customer_accounts(
            s["stg_customer_accounts_retail"], dims, old("customer_accounts_retail")
        ),
        "heating_systems": core.heating_systems(s["stg_heating_systems"], dims, old("heating_systems")),
        "renewables_obligation": core.renewables_obligation(
            s["stg_renewables_obligation"], dims, old("renewables_obligation")
        ),
        "scheme_metric": core.scheme_metric(s["stg_scheme_metric"], old("scheme_metric")),
    }
    for name, table in RETAIL_STAGING.items():
        facts[name] = core.retail_fact(name, s[table], dims, old(name))
    return {f"core_fact_{name}": df for name, df in facts.items()}


def core_checks(tables: Tables, loads: Sequence[PartitionedFact] = ()) -> DataFrame:
    """Hard rules (negatives, duplicate keys) and soft rules (missing denominators, unmatched companies, rejected rows).

    Every load gives a soft rule about the rows it could not load, with the counts taken while they were written.
    """
    reliability = tables["core_fact_network_reliability"]
    rejected = [
        check_counts(f"rejected_{f.table}", "soft", f.counts["rejected"], f.counts["rows"], reliability.sparkSession) for f in loads if f.counts
    ]
    electricity = tables["core_dim_network_sector"].filter("commodity = 'electricity'").select("network_sector_id")
    keys = ["date_id", "geography_id", "company_id", "network_sector_id"]
    return report(
        [
            check_rows("negative_losses", "hard", reliability, F.col("ens_mwh") < 0),
            check_rows(
                "negative_spend", "hard", tables["core_fact_financial_performance"],
                F.col("actual_totex_million_gbp") < 0,
            ),
            check_keys("duplicate_reliability_keys", "hard", reliability, keys),
            check_rows(
                "missing_demand", "soft", reliability.join(electricity, "network_sector_id", "left_semi"),
                F.col("total_demand_mwh").isNull(),
            ),
            check_unmatched(
                "unmatched_companies", "soft", tables["stg_network_reliability"], tables["core_dim_company"],
                {"company_name": "company_name"},
            ),
            *rejected,
        ],
        warn_above_pct=10.0,
    )


def build_marts(tables: Tables) -> dict[str, DataFrame]:
    """All marts from core and staging tables."""
    return {
        "mart_market_context": marts.market_context(tables),
        "mart_cost_reliability": marts.cost_reliability(tables),
        "mart_economic_impact": marts.economic_impact(tables),
        "mart_cross_commodity_risk": marts.cross_commodity_risk(tables),
        "mart_regulatory_performance": marts.regulatory_performance(tables),
        "mart_decarbonisation_narrative": marts.decarbonisation_narrative(tables),
        "mart_renewables_deployment": marts.renewables_deployment(tables),
        "mart_official_renewables": marts.official_renewables(tables["stg_statistical_digest"]),
        "mart_retail_supplier_health": marts.supplier_health(tables),
        "mart_retail_consumer_vulnerability": marts.consumer_vulnerability(tables),
        "mart_retail_competition": marts.competition(tables),
        "mart_retail_affordability": marts.affordability(tables),
        "mart_retail_complaints": marts.complaints(tables),
        "mart_retail_satisfaction": marts.satisfaction(tables),
        "mart_warm_home_discount": marts.discount_scheme(tables),
        "mart_cross_layer_cost_to_consumer": marts.cost_to_consumer(tables),
        "mart_cross_layer_volatility_complaints": marts.volatility_complaints(tables),
        "mart_cross_layer_supplier_quality": marts.supplier_quality(tables),
        "mart_daily_market_monitoring": marts.daily_monitoring(tables),
        "mart_renewables_obligation": marts.renewables_obligation(tables),
        "mart_scheme_metric": marts.scheme_metric(tables),
    }


def logged_write(spark: SparkSession, stage: Stage, name: str, df: DataFrame, source: str) -> DataFrame:
    """Write a table of this run and one line about it in the run log; a failed write is logged before it is raised."""
    watched, seen = audit.observed(df, f"{stage.run_id}:{name}")
    try:
        written = stage.write(name, watched)
    except Exception as error:
        audit.append_run(spark, stage.path("run_log"), source, name, status="failed", error=str(error)[:2000])
        raise
    audit.append_run(spark, stage.path("run_log"), source, name, seen.get, df.columns)
    return written


class LoggedFact(PartitionedFact):
    """A fact whose loads leave lines in the run log: rows loaded and rejected, or why the load failed."""

    def __init__(self, stage: Stage, table: str):
        super().__init__(stage.spark, f"{stage.base}/facts", table, stage.run_id, stage.previous)
        self._log = stage.path("run_log")

    def merge(self, rows: DataFrame, keys: Sequence[str], columns: Sequence[str], *args, **options) -> DataFrame:
        try:
            found = super().merge(rows, keys, columns, *args, **options)
        except Exception as error:
            audit.append_run(self.spark, self._log, "load", self.table, status="failed", error=str(error)[:2000])
            raise
        watched = [c for c in columns if c in rows.columns]
        audit.append_run(self.spark, self._log, "load", self.table, self.counts, watched, reasons=self.reasons())
        return found


def land(
    spark: SparkSession, stage: Stage, entries: Sequence[Mapping[str, object]], sources: Tables, allow_failures: bool = False
) -> dict[str, DataFrame]:
    """Run the registry over source tables and store its targets as landing tables, with their log lines.

    With ``allow_failures`` entries that could not be planned are logged as failed and their rows are missing.
    """
    run = run_registry(entries, sources, allow_failures)
    for source, reason in run.failures:
        audit.append_run(spark, stage.path("run_log"), source, "", status="failed", error=reason)
    return {name: logged_write(spark, stage, name, df, "registry") for name, df in run.targets.items()}


def full_refresh(spark: SparkSession, raw: Tables, stage: Stage) -> dict[str, DataFrame]:
    """Run all stages in order. Tables of one layer are stored before the next layer reads them; each has a log line.

    Facts are versions of partitions below ``facts`` in the stage's base folder: a run rewrites the years it brings rows for.
    The report of all checks is stored as ``quality_report``.
    """

    def before(table: str) -> DataFrame | None:
        return stage.before(table)

    def stored(frames: Tables) -> dict[str, DataFrame]:
        return {name: logged_write(spark, stage, name, df, "refresh") for name, df in frames.items()}

    staged = stored(build_staging(raw))
    dims = stored(build_dimensions(spark, raw, staged, before))
    loads: list[PartitionedFact] = []

    def fact(table: str) -> PartitionedFact:
        loads.append(LoggedFact(stage, table))
        return loads[-1]

    tables = {**staged, **dims, **build_facts(staged, dimension_set(dims), fact)}
    enforce(stage.write("quality_report", core_checks(tables, loads)))
    return {**tables, **stored(build_marts(tables))}
