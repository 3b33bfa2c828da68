"""The whole refresh on domain rows: landing → staging → core → marts, twice."""

import datetime

import pytest
from pyspark.sql import functions as F

from metricmart.operators.registry import run_registry
from metricmart.plans import marts, reads, refresh, shapes
from metricmart.sources.landing import as_documents
from metricmart.sources.sinks import Stage

NGET = "National Grid Electricity Transmission"


def schema(shape):
    return ", ".join(f"{n} {k}" for n, k in shape)


def landing(spark):
    """Landing tables: wide sources through the registry, the others as rows."""

    def docs(rows):
        return as_documents(spark.createDataFrame(rows), "seed")

    def long(shape, *rows):
        names = [n for n, _ in shape]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema(shape))

    expenditure = spark.createDataFrame(
        [("NGET", "1,500", 1450.0, 1600.0, 1500.0), ("null", "1", 1.0, 1.0, 1.0)],
        "company string, `Year 7 allowance` string, `Year 7 actual` double, `Year 8 allowance` double, `Year 8 actual` double",
    )
    shares = spark.createDataFrame(
        [("Q1 2021", 20.0, 30.0), ("Q2 2021", 25.0, None)], "period string, `British Gas - Start Q1 2010` double, `New Co` double"
    )
    caps = spark.createDataFrame([("Q1 2021", 400.0, 200.0), ("Q1 2020", 350.0, 210.0)], "period string, Wholesale double, Network double")
    run = run_registry(
        [
            {"source": "expenditure", "strategy": "wide_period_metric", "target": "raw_expenditure",
             "options": {"source_file": "exp", "column_pattern": r"Year (?P<period>\d+) (?P<kind>\w+)", "scheme": "T1",
                         "kind_metric_map": {"allowance": "totex_allowance_million_gbp", "actual": "actual_totex_million_gbp"},
                         "network_sector": "Electricity Transmission", "unit": "million_gbp"}},
            {"source": "shares", "strategy": "period_supplier_matrix", "target": "raw_supplier_metric",
             "options": {"source_file": "share", "metric_name": "market_share_pct", "period_kind": "quarterly", "commodity": "gas", "segment": "domestic"}},
            {"source": "caps", "strategy": "period_dimension_matrix", "target": "raw_retail_timeseries",
             "options": {"source_file": "cap", "period_kind": "quarterly", "metric_name": "price_cap_component_gbp",
                         "column_dimension_map": {"Wholesale": {"component": "wholesale"}, "Network": {"component": "network"}},
                         "dimensions": {"payment_method": "direct_debit", "commodity": "dual_fuel"}}},
            {"source": "gone", "strategy": "columnar_snapshot", "target": "raw_reliability", "options": {}},
            {"source": "caps", "strategy": "no such strategy", "target": "raw_reliability", "options": {}},
        ],
        {"expenditure": expenditure, "shares": shares, "caps": caps},
        allow_failures=True,
    )
    assert [source for source, _ in run.failures] == ["gone", "caps"]
    year = {"company_name": NGET, "network_sector": "ET"}
    market = {"commodity": "electricity", "instrument": "wind", "unit": "TWh", "source_file": "m"}
    supplier = {"supplier_name": "E.On", "segment": "domestic", "commodity": "all", "unit": "m", "source_file": "p", "year": 2021}
    series = {"year": 2021, "quarter": 1, "unit": "n", "source_file": "r", "commodity": "gas"}
    return {
        "company_alias": spark.createDataFrame(
            [("s", "NGET", "NGET", NGET, "ET", "National Grid"), ("s", "Big Gen", "BG", "Big Gen", "GEN", "Big")],
            "source_system string, source_company_name string, ofgem_company_id string, company_name string, network_sector_code string, owner_group string",
        ),
        "supplier_alias": spark.createDataFrame(
            [("British Gas", "British Gas", "large_legacy", "large", "BG", ""), ("E.On", "E.ON", "large_legacy", "large", "EON", None)],
            "source_supplier_name string, supplier_name string, supplier_group string, supplier_size string, ofgem_supplier_id string, exited_quarter string",
        ),
        "doc_reliability": docs([{"year": 2021, **year, "ens_mwh": 120.5, "minutes_lost": 3.7}]),
        "doc_expenditure": docs([{"year": 2013, **year, "actual_totex_million_gbp": 1.0, "totex_allowance_million_gbp": 2.0}]),
        "doc_rore": docs([{"year": 2013, **year, "rore_pct": 10.7}]),
        "doc_customer_metrics": docs([{"year": 2021, **year, "geography_code": "GB", "cost_per_customer_gbp": 126.2, "satisfaction_score": 8.4}]),
        "doc_emissions": docs([{"year": 2021, **year, "sf6_kg": 52.2, "carbon_footprint_tco2e": 0.0}]),
        "doc_energy_intensity": docs([{"year": 2021, "sic_code": "C", "kwh_per_gva": 0.5, "energy_intensity_index": 116.0, "industry_name": "Manufacturing"}]),
        "doc_sector_fuel_use": docs([{"year": 2021, "sic_code": "C", "electricity_pct": 0.63, "gas_pct": 0.31}]),
        "doc_regional_gva": docs([
            {"year": 2021, "region_code": "E12000007", "sic_code": "C", "gva_million_gbp": 300.0},
            {"year": 2021, "region_code": "S92000003", "sic_code": "C", "gva_million_gbp": 100.0},
        ]),
        "doc_lcree": docs([{"year": 2021, "turnover_million_gbp": 77000.0}]),
        "doc_intermediate_consumption": docs([{"year": 2021, "sic_code": "C", "industry_name": "Manufacturing", "commodity": " Energy ", "intermediate_share": 0.18}]),
        "doc_daily_market_prices": docs([
            {"date": f"2021-01-{d:02d}", "commodity": "Gas", "source_name": "SAP", "metric_name": "Spot", "value": float(d)} for d in range(1, 22)
        ]),
        "raw_reliability": long(shapes.NETWORK, {"year": 2020, "company_name": "NGET", "network_sector": "Electricity Transmission", "metric_name": "ens_mwh", "value": 100.0}),
        "raw_expenditure": run.targets["raw_expenditure"],
        "raw_rore": long(shapes.NETWORK, {"year": 2021, "company_name": "NGET", "network_sector": "Electricity Transmission", "metric_name": "rore_pct", "value": 9.5}),
        "raw_customer_satisfaction": long(shapes.NETWORK),
        "raw_emissions": long(shapes.NETWORK),
        "raw_market_prices": long(
            shapes.MARKET, {"year": 2021, **market, "metric_name": "volatility_electricity_baseload", "value": 5.0},
            {"year": 2021, **market, "metric_name": "power_price_baseload", "value": 50.0},
        ),
        "raw_generation_mix": long(
            shapes.MARKET, *[{"year": y, **market, "metric_name": "generation_twh", "value": 0.25} for y in (2020, 2021)],
            {"year": 2021, **market, "instrument": "gas", "metric_name": "generation_twh", "value": 0.75},
        ),
        "raw_gas_supply": long(shapes.MARKET, {"year": 2021, "commodity": "gas", "instrument": "norway", "metric_name": "s", "value": 7.0}),
        "raw_generation_share": long(shapes.SHARE, {"year": 2024, "company_name": "Big Gen", "metric_name": "generation_market_share_pct", "value": 0.4}),
        "raw_supplier_metric": run.targets["raw_supplier_metric"].unionByName(long(
            shapes.SUPPLIER, {**supplier, "metric_name": "profit_million_gbp", "value": 10.0},
            {**supplier, "metric_name": "complaints_received_per_100k", "value": 7.0, "quarter": 1},
        )),
        "raw_retail_timeseries": run.targets["raw_retail_timeseries"].unionByName(long(
            shapes.RETAIL_SERIES, {**series, "metric_name": "active_suppliers", "value": 20.0},
            {**series, "metric_name": "supplier_exits", "commodity": None, "value": 2.0},
            {**series, "metric_name": "accounts_in_arrears_no_arrangement", "value": 30.0}, {**series, "metric_name": "accounts_repaying_debt", "value": 60.0},
            {**series, "metric_name": "disconnections_for_debt", "value": 4.0}, {**series, "metric_name": "total_switches", "value": 5.0},
            {"year": 2021, "metric_name": "household_energy_spend_pct", "segment": "all", "value": 4.2},
        )),
        "raw_retail_snapshot": long(shapes.RETAIL_SNAPSHOT, {"year": 2021, "supplier_name": "New Co", "metric_name": "nps_score", "supplier_size": "small", "value": -3.0}),
        "raw_renewables": long(
            shapes.RENEWABLES, {"year": 2020, "technology": "solar", "metric_name": "capacity_kw", "value": 5.0},
            {"year": 2021, "technology": "solar", "metric_name": "capacity_kw", "value": 7.0},
            {"period_label": "2019-20", "year": 2019, "technology": "wind", "metric_name": "rocs_issued_millions", "value": 1.5, "source_file": "c"},
        ),
        "raw_whd": long(
            shapes.DISCOUNT, {"scheme_year": 10, "calendar_year": 2020, "nation": "Wales", "metric_name": "scheme_value_mgbp", "value": 3.0},
            {"scheme_year": 10, "calendar_year": 2020, "supplier_name": "British Gas", "metric_name": "obligation_amount_mgbp", "value": 2.0},
        ),
        "raw_statistical_digest": long(
            shapes.DIGEST, *[{"dukes_table": "6.3", "period_year": 2021, "row_label": "wind", "metric_name": "load_factor", "value": v, "source_file": "d"} for v in (0.3, 0.4)],
            {"dukes_table": "9.9", "period_year": 2021, "row_label": "x", "metric_name": "m", "value": 1.0, "source_file": "d"},
        ),
        "raw_energy_flows": spark.createDataFrame(
            [(2021, "A", 1, 4, "B", 5.0, "f"), (2021, "A", 1, 4, "B", 5.0, "g"), (2021, "A", 2, 4, "C", 6.0, "f")],
            "reference_year int, table_id string, row_no int, industry_col int, row_code string, energy_tj double, source_file string",
        ),
        "raw_energy_flow_bridge": spark.createDataFrame([(2021, "b1", 7.0, "f")], "reference_year int, bridge_code string, energy_tj double, source_file string"),
        "raw_scheme_metric": long(shapes.SCHEME, {"year": 2021, "scheme_key": "bus", "metric_name": "vouchers", "value": 8.0, "source_file": "b"}),
    }


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    return str(tmp_path_factory.mktemp("stages"))


@pytest.fixture(scope="module")
def runs(spark, base):
    raw = landing(spark)
    first = refresh.full_refresh(spark, raw, Stage(spark, base, "run1"))
    second = refresh.full_refresh(spark, raw, Stage(spark, base, "run2", previous="run1"))
    return first, second


def test_second_run_changes_nothing(runs):
    first, second = runs
    for name in first:
        if name.startswith(("core_", "mart_")):
            a, b = ({tuple(map(str, r)) for r in t[name].collect()} for t in (first, second))
            assert a == b, name
            assert first[name].count() == second[name].count(), name


def test_landing_leaves_log_lines(spark, tmp_path):
    stage = Stage(spark, str(tmp_path), "r")
    entry = {"source": "s", "strategy": "wide_period_metric", "target": "t",
             "options": {"source_file": "e", "column_pattern": r"Year (?P<period>\d+) (?P<kind>\w+)", "scheme": "T1", "kind_metric_map": {"actual": "a"},
                         "network_sector": "Electricity Transmission", "unit": "u"}}
    sources = {"s": spark.createDataFrame([("NGET", 1.0)], "company string, `Year 7 actual` double")}
    with pytest.raises(ValueError, match="nowhere"):
        refresh.land(spark, stage, [entry, {**entry, "source": "nowhere"}], sources)
    landed = refresh.land(spark, stage, [entry, {**entry, "source": "nowhere"}], sources, allow_failures=True)
    assert landed["t"].count() == 1
    log = spark.read.parquet(stage.path("run_log")).collect()
    assert sorted((r.source_id, r.target_table, r.status) for r in log) == [("nowhere", "", "failed"), ("registry", "t", "loaded")]


def test_every_table_has_a_log_line(spark, base, runs):
    tables, _ = runs
    log = spark.read.parquet(Stage(spark, base, "run1").path("run_log")).collect()
    assert {r.target_table for r in log if r.status == "loaded"} == set(tables) and len(log) == len(tables)
    assert {r.target_table: r.row_count for r in log}["stg_energy_flows"] == 2
    assert sum(name.startswith("mart_") for name in tables) == 21
    grains = {(r.dukes_table, r.grain, r.value) for r in tables["mart_official_renewables"].collect()}
    assert grains == {("6.3", "load_factors", 0.3), ("9.9", "other", 1.0)}


def test_repeated_keys_fail_loudly(spark):
    from metricmart.plans import core

    rows = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, v double")
    with pytest.raises(ValueError, match="repeats"):
        core.store(rows, ["k"], ["k", "v"], None)
    month = {"source_file": "s", "period_label": "p", "scheme_key": "bus", "entity": "e", "metric_name": "m", "year": 2021, "quarter": 1, "unit": "u"}
    names = [n for n, _ in shapes.SCHEME]
    two = spark.createDataFrame([tuple({**month, "month": m, "value": float(m)}.get(n) for n in names) for m in (1, 2)], schema(shapes.SCHEME))
    assert [r.value for r in core.scheme_metric(two).collect()] == [1.5]


def test_chain_of_one_metric(runs):
    """Wide header → regulatory year → staging → fact → mart → rank."""
    tables, _ = runs
    cost = {r.year: r for r in tables["mart_cost_reliability"].collect()}
    assert set(cost) == {2020, 2021}
    row = cost[2021]
    assert (row.company_name, row.riio_scheme, row.rore_pct) == (NGET, "T1", 9.5)
    assert row.total_demand_mwh == 1_000_000.0 and row.actual_totex_million_gbp == 1500.0
    assert row.ens_per_million_gbp_spend == pytest.approx(120.5 / 1500.0)
    assert row.cost_efficiency_score == pytest.approx((1500.0 / 1600.0) / (120.5 / 1_000_000.0))
    rank = reads.efficiency_rank(tables["mart_cost_reliability"], 2014, 2021).collect()
    assert [r.year for r in rank] == [2021]


def test_allocation_and_context(runs):
    tables, _ = runs
    impact = {r.geography_code: r for r in tables["mart_economic_impact"].collect()}
    assert impact["E12000007"].ens_mwh_in_region_industry == pytest.approx(120.5 * 0.75)
    assert impact["S92000003"].output_at_risk_gbp == pytest.approx(120.5 * 0.25 * (100.0 * 1e6 / 0.5) * 0.18)
    context = {(r.year, r.fuel_source): r for r in tables["mart_market_context"].collect()}
    assert context[(2021, "wind")].fuel_share_of_total == pytest.approx(0.25)
    assert context[(2021, "TOTAL")].fuel_share_of_total is None and context[(2024, "Big Gen")].market_share_pct_2024 == 0.4
    hhi = reads.generation_concentration(tables["core_fact_market_share"], tables["stg_market_share"].withColumn("metric_name", F.lit("x")).withColumn("value", F.lit(1.0)))
    assert hhi.first().hhi_0_10000 == pytest.approx(1600.0)


def test_retail_marts(runs):
    tables, _ = runs
    quarter = tables["mart_retail_consumer_vulnerability"].first()
    assert (quarter.year, quarter.quarter, quarter.arrears_rate, quarter.disconnections_for_debt) == (2021, 1, 0.5, 4.0)
    assert quarter.payment_method == "all" and quarter.period_start_date == datetime.date(2021, 1, 1)
    health = {r.supplier_name: r for r in tables["mart_retail_supplier_health"].collect()}
    assert health["E.ON"].profit_million_gbp == 10.0 and health["E.ON"].supplier_exits == 2.0
    # Two quarters of one year are both summed, as in the reported index.
    assert health["E.ON"].hhi == pytest.approx(0.2**2 + 0.3**2 + 0.25**2)
    cost = {r.year: r for r in tables["mart_cross_layer_cost_to_consumer"].collect()}
    assert cost[2021].wholesale_yoy_change == 50.0 and cost[2021].network_yoy_change == -10.0 and cost[2020].total_cap_gbp is None
    names = {r.supplier_name: r.supplier_size for r in tables["core_dim_supplier"].collect()}
    assert names["New Co"] == "unknown" and names["British Gas"] == "large"
    quality = {r.supplier_name: r for r in tables["mart_cross_layer_supplier_quality"].collect()}
    assert quality["E.ON"].non_null_metric_count == 2 and quality["E.ON"].has_complaints_metrics
    layers = {r.layer for r in tables["mart_retail_affordability"].collect()}
    assert layers == {"price_cap_component", "household_spend"}


def test_other_marts(runs):
    tables, _ = runs
    grains = {(r.grain, r.year): r for r in tables["mart_renewables_deployment"].collect()}
    assert grains[("annual_gb", 2021)].cumulative_capacity_kw == 12.0
    monitor = tables["mart_daily_market_monitoring"].first()
    assert (monitor.observation_count, monitor.spike_days_ge_p95, monitor.commodity) == (21, 2, "gas")
    discount = {r.grain: r for r in tables["mart_warm_home_discount"].collect()}
    assert discount["supplier"].supplier_group == "large_legacy" and discount["national"].scheme_value_mgbp == 3.0
    assert tables["mart_renewables_obligation"].first().rocs_issued_millions == 1.5
    assert tables["mart_scheme_metric"].first().value == 8.0
    assert tables["mart_regulatory_performance"].filter("year = 2021").first().carbon_footprint_tco2e is None
    assert tables["mart_decarbonisation_narrative"].filter("year = 2021").first().ens_change_mwh == pytest.approx(20.5)
    volatility = tables["mart_cross_layer_volatility_complaints"].first()
    assert volatility.is_wholesale_low_confidence and volatility.supplier_exits == 2.0 and volatility.total_switches == 5.0


def test_checks_and_status(spark, runs):
    tables, _ = runs
    report = {r.check_name: r.status for r in refresh.core_checks(tables).collect()}
    assert report == {"negative_losses": "ok", "negative_spend": "ok", "duplicate_reliability_keys": "ok", "missing_demand": "ok", "unmatched_companies": "ok"}
    bad = {**tables, "core_fact_network_reliability": tables["core_fact_network_reliability"].withColumn("ens_mwh", F.lit(-1.0))}
    assert refresh.core_checks(bad).filter("status = 'fail'").first().check_name == "negative_losses"
    window = marts.trend_in_window(tables["mart_cost_reliability"], "Electricity Transmission", 2013, 2021)
    assert [r.year for r in window.collect()] == [2020, 2021]


def test_facts_outside_the_calendar_are_reported(spark, base, runs):
    """A row of 1980 is kept apart, logged and warned about; all else loads."""
    _, tables = runs
    stage = Stage(spark, base, "with_1980", previous="run2")
    staged = tables["stg_network_reliability"]
    old = staged.filter("year = 2021").withColumn("year", F.lit(1980).cast("int"))
    fact, dims = refresh.LoggedFact(stage, "core_fact_network_reliability"), refresh.dimension_set(tables)
    loaded = refresh.core.network_reliability(staged.unionByName(old), tables["stg_market_context"], dims, fact)
    assert loaded.count() == 2 and [r.year for r in fact.quarantine().collect()] == [1980]
    line = spark.read.parquet(stage.path("run_log")).first()
    assert (line.source_id, line.row_count, line.rejected, line.rejected_json) == ("load", 2, 1, '{"year": 1}')
    report = {r.check_name: r for r in refresh.core_checks(tables, [fact]).collect()}
    assert report["rejected_core_fact_network_reliability"].status == "warn"
    assert report["rejected_core_fact_network_reliability"].violations == 1
    rules = {r.check_name: r.status for r in Stage(spark, base, "run1").read("quality_report").collect()}
    assert sum(name.startswith("rejected_") for name in rules) == 26 and rules["rejected_core_fact_emissions"] == "ok"


def test_a_later_load_rewrites_only_what_came(spark, base, runs):
    kept = refresh.LoggedFact(Stage(spark, base, "later", previous="run2"), "core_fact_network_reliability")
    assert set(kept.files()) == {"y2020", "y2021"}
    rows = kept.read().filter("date_id = 20211").withColumn("ens_mwh", F.lit(9.0))
    merged = kept.merge(rows, ["date_id", "geography_id", "company_id", "network_sector_id"], rows.columns)
    assert kept.files() == {"y2020": "run2-1", "y2021": "later-1"} and merged.filter("ens_mwh = 9").count() == 1 and merged.count() == 2
