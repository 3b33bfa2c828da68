"""Registered queries against their check SQL, and the plans of those that matter at scale.

A sample runs by default; set ``FULL_CATALOG=1`` for all of them (or use ``python -m catalog.verify``).
"""

import os
from datetime import datetime

import pytest
from support import plan_of

import __spark_entry__ as driver
from catalog import QUERIES, Tables
from catalog.verify import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = [
    "mart_economic_impact", "mart_consumer_vulnerability", "mart_daily_monitoring", "unpivot_period_metric", "unpivot_period_dimensions",
    "grid_sections", "null_safe_upsert", "upsert_sub_population", "surrogate_keys", "priority_dedupe", "exact_percentiles",
    "staging_financial_performance", "core_customer_metrics", "read_baseline_compare", "read_bid_offer", "cross_validation", "quality_checks",
]


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("FULL_CATALOG") else SAMPLE)
def test_query_matches_check(spark, connection, name):
    status, _, _ = compare(Tables(spark, SF), connection, name)
    assert status in ("ok", "rows-only")


def test_driver_contract(spark):
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
    flagship = driver.entry(spark)
    assert "ens_mwh_in_region_industry" in flagship.columns


@pytest.mark.parametrize(
    "name", ["member_interval_join", "null_safe_full_outer", "null_safe_upsert", "date_dim_lookup", "zscore_rank", "first_nonempty_source", "mart_cost_reliability"]
)
def test_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name].build(Tables(spark, SF)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_are_pruned(spark):
    plan = plan_of(QUERIES["part_plus_total"].build(Tables(spark, SF)))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_global_windows_only_after_reduction(spark):
    """A window without partition columns only sees year grain: it sits above an aggregation, not above a scan."""
    for name in ("yoy_lag", "mart_cost_to_consumer", "mart_decarbonisation_narrative"):
        plan = plan_of(QUERIES[name].build(Tables(spark, SF)))
        window = plan.index("Window [")
        assert "HashAggregate" in plan[window:], name


def test_yearly_sales_come_from_the_stored_quarters(spark, tmp_path):
    """With the quarters stored, the yearly sales are the same rows and read neither lineitem nor orders again."""
    day = [datetime(1995, 2, 1), datetime(1995, 8, 1), None]
    orders = [(i % 4 or None, day[i % 3]) for i in range(9)]
    lines = [(i % 5 or None, i % 3 or None, "AR"[i % 2] if i % 7 else None, "OF"[i % 2], None if i == 4 else i + 0.25, 10.0 * i, 0.05, 0.01 if i % 3 else None) for i in range(40)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain, rolled = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    expected = plain["supplier_sales"]
    rolled["sales_quarter"]
    rolled._built["lineitem"] = rolled._built["orders"] = None  # not read again
    got = rolled["supplier_sales"]
    assert got.dtypes == expected.dtypes and got.count() > 3
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_supplier_and_type_sales_come_from_the_stored_lines(spark, tmp_path):
    """With the lines and their years stored, both are the same rows and read neither lineitem nor orders again."""
    day = [datetime(1995, 2, 1), datetime(1996, 8, 1), None]
    orders = [(i % 4 or None, day[i % 3]) for i in range(9)]  # repeated and NULL keys
    lines = [
        (i % 5 or None, i % 6 or None, i % 3 or None, "AR"[i % 2] if i % 7 else None, "OF"[i % 2], None if i == 4 else i + 0.25, 10.0 * i, 0.05, 0.01 if i % 3 else None)
        for i in range(60)
    ]
    written = {
        "orders": (orders, "o_orderkey bigint, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
        "part": ([(1, "PROMO"), (2, None), (2, "SMALL"), (4, "LARGE"), (None, "PROMO")], "p_partkey bigint, p_type string"),
        "supplier": ([(1, 3), (1, 4), (None, 5)], "s_suppkey bigint, s_nationkey int"),  # not every line has one
    }
    for name, (rows, schema) in written.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plain, rolled = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    expected = {name: plain[name] for name in ("supplier_sales", "type_sales")}
    rolled["sold_lines"]
    rolled._built["lineitem"] = rolled._built["orders"] = None  # not read again
    for name, df in expected.items():
        got = rolled[name]
        assert got.dtypes == df.dtypes and got.count() > 3
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", ["example_top_industries", "read_impact", "input_share_coverage"])
def test_impact_joins_lines_and_orders_once(spark, name):
    tables = Tables(spark, SF)
    QUERIES[name].build(tables)
    assert "sold_lines" in tables._built
