"""Bound tables: the driver tables in the shapes of the warehouse.

Conditions such as ``NOT (o_orderstatus = 'O' AND year = 1996)`` leave gaps on purpose: outer joins of the marts need
keys that only one side has.
"""

from __future__ import annotations

from catalog.engine import QUARTER, YEAR, bind, case, cents, total

STATUS_COMMODITY = {"O": "electricity", "F": "gas"}
PRIORITY_METHOD = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 4}
METHOD_NAMES = {1: "direct_debit", 2: "standard_credit", 3: "prepayment", 4: "smart_prepayment"}
TYPE_CODES = {"STANDARD": "A", "PROMO": "B", "SMALL": "C", "LARGE": "D", "ECONOMY": "E", "MEDIUM": "F"}
TYPE_FUELS = {
    "STANDARD": "offshore_wind", "PROMO": "solar", "SMALL": "gas", "LARGE": "coal", "ECONOMY": "pumped_storage",
    "MEDIUM": "biomass",
}
TYPE_INDUSTRIES = {
    "STANDARD": "Agriculture", "PROMO": "Mining", "SMALL": "Manufacturing", "LARGE": "Power", "ECONOMY": "Water",
    "MEDIUM": "Construction",
}
REGION_SECTORS = {0: "ET", 1: "ED", 2: "GT", 3: "GD", 4: "ET"}
SECTOR_IDS = {"ET": 1, "ED": 2, "GT": 3, "GD": 4}
SECTOR_NAMES = {
    "ET": "Electricity Transmission", "ED": "Electricity Distribution", "GT": "Gas Transmission",
    "GD": "Gas Distribution",
}


def by_nation(names: list[str | None]) -> dict[int, str | None]:
    """A value for each of the 25 nations, the list repeated."""
    return {i: names[i % len(names)] for i in range(25)}


# --- bases: the only passes over lineitem and orders most facts need --------------------------------------------
# Money stays in whole cents (rebate in hundredths of a cent), so that sums of sums are exact.

_MEASURES = f"""COUNT(*) AS n, SUM({cents('l_quantity')}) AS qty_c, SUM({cents('l_extendedprice')}) AS price_c,
       SUM({cents('l_extendedprice')} * {cents('l_discount')}) AS rebate_c, SUM({cents('l_tax')}) AS tax_c,
       SUM({cents('l_discount')}) AS discount_c"""

_SOLD_MEASURES = """COUNT(*) AS n, SUM(qty_c) AS qty_c, SUM(price_c) AS price_c, SUM(price_c * discount_c) AS rebate_c,
       SUM(tax_c) AS tax_c, SUM(discount_c) AS discount_c"""

# Each line with its order's year, stored by queries that read both supplier_sales and type_sales: lineitem and orders
# meet once for the two. The year is taken before the join, as it shuffles smaller than the timestamp.
bind("sold_lines", f"""
SELECT year, l_suppkey, l_partkey, l_returnflag, l_linestatus, {cents('l_quantity')} AS qty_c, {cents('l_extendedprice')} AS price_c,
       {cents('l_discount')} AS discount_c, {cents('l_tax')} AS tax_c
FROM lineitem JOIN (SELECT o_orderkey, {YEAR} AS year FROM orders) o ON l_orderkey = o_orderkey
""", shared=True)
bind("supplier_sales", f"""
SELECT {YEAR} AS year, l_suppkey AS suppkey, l_returnflag, {_MEASURES}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY {YEAR}, l_suppkey, l_returnflag
""", shared=True, rollups={"sales_quarter": f"""
SELECT year, suppkey, l_returnflag, {', '.join(f'SUM({c}) AS {c}' for c in ('n', 'qty_c', 'price_c', 'rebate_c', 'tax_c', 'discount_c'))}
FROM sales_quarter GROUP BY year, suppkey, l_returnflag
""", "sold_lines": f"""
SELECT year, l_suppkey AS suppkey, l_returnflag, {_SOLD_MEASURES} FROM sold_lines GROUP BY year, l_suppkey, l_returnflag
"""})
bind("type_sales", f"""
SELECT {YEAR} AS year, p_type, s_nationkey, l_returnflag, l_linestatus, {_MEASURES}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY {YEAR}, p_type, s_nationkey, l_returnflag, l_linestatus
""", shared=True, rollups={"sold_lines": f"""
SELECT year, p_type, s_nationkey, l_returnflag, l_linestatus, {_SOLD_MEASURES}
FROM sold_lines JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY year, p_type, s_nationkey, l_returnflag, l_linestatus
"""})
bind("sales_quarter", f"""
SELECT {YEAR} AS year, {QUARTER} AS quarter, l_suppkey AS suppkey, l_returnflag, l_linestatus, {_MEASURES}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY {YEAR}, {QUARTER}, l_suppkey, l_returnflag, l_linestatus
""", shared=True)
bind("order_groups", f"""
SELECT {YEAR} AS year, {QUARTER} AS quarter, o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, COUNT(*) AS n,
       SUM({cents('o_totalprice')}) AS total_c
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY {YEAR}, {QUARTER}, o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey
""", shared=True)


def with_sold_lines(t):
    """The tables with ``sold_lines`` stored first, for queries that read both yearly supplier sales and type sales."""
    t["sold_lines"]
    return t


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def summed(column: str, where: str | None = None) -> str:
    """Sum of a cents column in units."""
    return dbl(f"SUM({column})" if where is None else f"SUM(CASE WHEN {where} THEN {column} ELSE 0 END)") + " / 100"


NET = "(CAST(SUM(price_c) AS DOUBLE) * 100 - CAST(SUM(rebate_c) AS DOUBLE)) / 10000"
MEAN_ORDER = "CAST(SUM(total_c) AS DOUBLE) / 100 / SUM(n) / 1000"
COUNTED = "CAST(SUM(n) AS DOUBLE)"

# --- the yearly supplier view most network facts come from -----------------------------------------------------

bind("supplier_year", f"""
SELECT y.year, y.suppkey, s.s_name AS company_name, s.s_acctbal, n.n_name, n.n_nationkey,
       {case('n.n_regionkey', REGION_SECTORS)} AS sector_code,
       y.qty, y.price, y.revenue, y.tax, y.returned, y.n_lines, y.n_returned
FROM (SELECT year, suppkey, {summed('qty_c')} AS qty, {summed('price_c')} AS price, {NET} AS revenue,
             {summed('tax_c')} AS tax, {summed('qty_c', "l_returnflag = 'R'")} AS returned, SUM(n) AS n_lines,
             SUM(CASE WHEN l_returnflag = 'R' THEN n ELSE 0 END) AS n_returned
      FROM supplier_sales GROUP BY year, suppkey) y
JOIN supplier s ON s.s_suppkey = y.suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
""")

bind("national_year", "SELECT year, SUM(qty) AS qty FROM supplier_year GROUP BY year")

# --- dimensions ------------------------------------------------------------------------------------------------

bind("core_dim_date", f"""
SELECT yr * 10 + 1 AS date_id, yr AS year, CAST(NULL AS INT) AS quarter, CAST(yr AS STRING) || '-annual' AS period_label,
       'annual' AS period_kind, make_date(yr, 1, 1) AS period_start_date
FROM (SELECT DISTINCT {YEAR} AS yr FROM orders) a
UNION ALL
SELECT yr * 100 + q, yr, q, CAST(yr AS STRING) || ' Q' || CAST(q AS STRING), 'quarterly', make_date(yr, (q - 1) * 3 + 1, 1)
FROM (SELECT DISTINCT {YEAR} AS yr, {QUARTER} AS q FROM orders) b
""")
bind("core_dim_network_sector", """
SELECT CAST(id AS BIGINT) AS network_sector_id, sector_code, sector_name, commodity FROM (VALUES
 (1, 'ET', 'Electricity Transmission', 'electricity'), (2, 'ED', 'Electricity Distribution', 'electricity'),
 (3, 'GT', 'Gas Transmission', 'gas'), (4, 'GD', 'Gas Distribution', 'gas'))
 AS t(id, sector_code, sector_name, commodity)
""")
bind("core_dim_company", f"""
SELECT s_suppkey AS company_id, s_name AS company_name, n_name AS owner_group,
       CAST({case('n_regionkey', {k: SECTOR_IDS[v] for k, v in REGION_SECTORS.items()})} AS BIGINT) AS network_sector_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
bind("core_dim_geography", """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS geography_id, 'N' || CAST(n_nationkey AS STRING) AS geography_code,
       n_name AS geography_name, 'region' AS geography_type, r_name AS parent_geography_code
FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT CAST(0 AS BIGINT), 'GB', 'Great Britain', 'country', NULL
""")
bind("core_dim_industry", f"""
SELECT CAST(industry_id AS BIGINT) AS industry_id, sic_code, sic_code AS sic_section, industry_name FROM
 (SELECT DISTINCT {case('p_type', {k: i for i, k in enumerate(TYPE_CODES, 1)})} AS industry_id,
         {case('p_type', TYPE_CODES)} AS sic_code, {case('p_type', TYPE_INDUSTRIES)} AS industry_name FROM part) t
""")
bind("core_dim_supplier", """
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS supplier_group,
       CASE WHEN s_acctbal < 0 THEN 'small' WHEN s_acctbal < 5000 THEN 'medium' ELSE 'large' END AS supplier_size,
       CASE WHEN s_acctbal < 0 THEN 'Q4 2000' END AS exited_quarter
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
bind("core_dim_payment_method", """
SELECT CAST(id AS BIGINT) AS payment_method_id, payment_method FROM (VALUES (1, 'direct_debit'), (2, 'standard_credit'),
 (3, 'prepayment'), (4, 'smart_prepayment')) AS t(id, payment_method)
""")
bind("core_dim_supplier_size", """
SELECT CAST(id AS BIGINT) AS supplier_size_id, size_band
FROM (VALUES (1, 'large'), (2, 'medium'), (3, 'small'), (4, 'all')) AS t(id, size_band)
""")

# --- network facts ---------------------------------------------------------------------------------------------

_SECTOR_ID = f"CAST({case('f.sector_code', SECTOR_IDS)} AS BIGINT)"
_ELECTRIC = "f.sector_code IN ('ET', 'ED')"

bind("core_fact_network_reliability", f"""
SELECT f.year * 10 + 1 AS date_id, CAST(f.n_nationkey + 1 AS BIGINT) AS geography_id, f.suppkey AS company_id,
       {_SECTOR_ID} AS network_sector_id, CASE WHEN {_ELECTRIC} THEN f.returned END AS ens_mwh,
       CAST(f.n_returned AS DOUBLE) AS customer_interruptions, f.tax AS minutes_lost,
       CASE WHEN NOT {_ELECTRIC} THEN f.returned END AS gas_interruption_volume,
       CASE WHEN NOT {_ELECTRIC} THEN f.qty - f.returned END AS gas_lost_volume,
       CASE WHEN {_ELECTRIC} THEN t.qty END AS total_demand_mwh,
       CASE WHEN NOT {_ELECTRIC} THEN t.qty END AS total_gas_supply
FROM supplier_year f JOIN national_year t ON t.year = f.year
""")
bind("core_fact_financial_performance", f"""
SELECT f.year * 10 + 1 AS date_id, f.suppkey AS company_id, {_SECTOR_ID} AS network_sector_id,
       f.price / 1000 AS totex_allowance_million_gbp, f.revenue / 1000 AS actual_totex_million_gbp,
       CASE WHEN f.s_acctbal > 0 THEN f.s_acctbal / 100 END AS rore_pct
FROM supplier_year f
""")
bind("core_fact_customer_metrics", f"""
SELECT f.year * 10 + 1 AS date_id, CAST(f.n_nationkey + 1 AS BIGINT) AS geography_id, CASE WHEN f.s_acctbal > 3000 THEN f.suppkey ELSE -f.suppkey END AS company_id,
       {_SECTOR_ID} AS network_sector_id, f.price / f.n_lines AS cost_per_customer_gbp,
       f.qty / f.n_lines AS satisfaction_score
FROM supplier_year f
""")
bind("core_fact_emissions", f"""
SELECT f.year * 10 + 1 AS date_id, CASE WHEN f.s_acctbal < 8000 THEN f.suppkey ELSE -f.suppkey END AS company_id, {_SECTOR_ID} AS network_sector_id, f.tax * 10 AS sf6_kg,
       f.revenue / 10 AS carbon_footprint_tco2e
FROM supplier_year f
""")
bind("core_fact_regional_gva", f"""
SELECT year * 10 + 1 AS date_id, CAST(s_nationkey + 1 AS BIGINT) AS geography_id,
       CAST({case('p_type', {k: i for i, k in enumerate(TYPE_CODES, 1)})} AS BIGINT) AS industry_id,
       {summed('price_c')} / 1000 AS gva_million_gbp
FROM type_sales GROUP BY year, s_nationkey, p_type
""")
bind("type_year", f"""
SELECT year, p_type, l_returnflag, {summed('qty_c')} AS qty, {summed('price_c')} AS price, {summed('discount_c')} AS discount,
       {summed('qty_c', "l_linestatus = 'F'")} AS filled, {dbl('SUM(n)')} AS n
FROM type_sales GROUP BY year, p_type, l_returnflag
""")
_INDUSTRY = f"CAST({case('p_type', {k: i for i, k in enumerate(TYPE_CODES, 1)})} AS BIGINT)"
bind("core_fact_energy_intensity", f"""
SELECT year * 10 + 1 AS date_id, CASE WHEN p_type <> 'MEDIUM' THEN {_INDUSTRY} END AS industry_id, SUM(price) / SUM(qty) AS kwh_per_gva,
       SUM(filled) / SUM(qty) AS electricity_pct_of_total_energy, 1 - SUM(filled) / SUM(qty) AS gas_pct_of_total_energy,
       SUM(qty) / SUM(n) AS energy_intensity_index
FROM type_year GROUP BY year, p_type
""")
bind("core_fact_input_output", f"""
SELECT year * 10 + 1 AS date_id, CASE WHEN p_type <> 'LARGE' THEN {_INDUSTRY} END AS industry_id,
       {case('l_returnflag', {'A': 'energy', 'N': 'electricity', 'R': 'labour'})} AS commodity,
       discount / n AS intermediate_consumption_share, price / 1000 AS intermediate_consumption_value
FROM type_year
""")
bind("stg_lcree", f"""
SELECT {YEAR} AS year, CASE WHEN {YEAR} < 2001 THEN {total('o_totalprice')} / 1000000 END AS lcree_turnover_million_gbp FROM orders
GROUP BY {YEAR}
""")

# --- market facts ----------------------------------------------------------------------------------------------

PRICE_METRICS = [
    "volatility_electricity_baseload", "volatility_electricity_peakload", "volatility_gas", "gas_day_ahead_price",
    "spark_spread_central", "dark_spread", "power_price_baseload", "bid_offer_spread", "summer_winter_spread",
    "trading_volume_twh",
]
bind("price_points", f"""
SELECT year, quarter, COALESCE({case('o_orderstatus', STATUS_COMMODITY)}, 'all') AS commodity, {case('c_mktsegment', {'FURNITURE': 'churn', 'MACHINERY': 'baseload', 'BUILDING': 'peak'})} AS instrument,
       {case('c_nationkey', by_nation(PRICE_METRICS))} AS metric_name, {MEAN_ORDER} AS value
FROM order_groups
GROUP BY year, quarter, o_orderstatus, {case('c_mktsegment', {'FURNITURE': 'churn', 'MACHINERY': 'baseload', 'BUILDING': 'peak'})}, {case('c_nationkey', by_nation(PRICE_METRICS))}
""")
bind("core_fact_market_prices", """
SELECT year * 10 + 1 AS date_id, CAST(0 AS BIGINT) AS geography_id, year, commodity, COALESCE(instrument, 'spot') AS instrument,
       metric_name, CAST(NULL AS DATE) AS period_date, 'Q' || CAST(quarter AS STRING) AS period_label, value, 'gbp' AS unit
FROM price_points
""")
bind("core_fact_market_context", f"""
SELECT year, 'electricity' AS commodity, {case('p_type', TYPE_FUELS)} AS fuel_source, 'generation_twh' AS metric_name,
       CASE WHEN p_type = 'ECONOMY' THEN -SUM(qty) ELSE SUM(qty) END AS value, 'TWh' AS unit
FROM type_year GROUP BY year, p_type
UNION ALL SELECT year, 'electricity', 'TOTAL', 'generation_total_twh', SUM(qty), 'TWh' FROM type_year GROUP BY year
UNION ALL SELECT {YEAR}, 'gas', {case('o_orderstatus', {'O': 'norway', 'F': 'shelf', 'P': 'lng'})},
                 'gas_supply_mcm_year_sum', {total('o_totalprice')} / 1000, 'mcm' FROM orders GROUP BY {YEAR}, o_orderstatus
""")
bind("core_fact_market_share", """
SELECT f.year, 'electricity' AS commodity, f.company_name, 100 * f.qty / t.qty AS share_pct, 'shares.csv' AS source_file
FROM supplier_year f JOIN national_year t ON t.year = f.year
""")
bind("core_fact_daily_prices", f"""
SELECT CAST(ts AS DATE) AS period_date,
       {case('event_type', {'click': 'gas', 'error': 'gas', 'purchase': 'electricity', 'signup': 'electricity', 'view': 'carbon'})} AS commodity,
       'feed' AS source_name, event_type AS metric_name, value, 'gbp' AS unit
FROM events
""")

# --- retail facts ----------------------------------------------------------------------------------------------

_Q_ID = "year * 100 + quarter"

bind("core_fact_supplier_financial", f"""
SELECT {_Q_ID} AS date_id, NULLIF(suppkey, 0) AS supplier_id,
       {case('l_returnflag', {'A': 'domestic', 'N': 'non_domestic', 'R': 'generation'})} AS segment,
       {case('l_linestatus', {'F': 'profit_million_gbp', 'O': 'pretax_domestic_margin_pct'})} AS metric_name,
       {NET} / 10000 AS value, 'm' AS unit, 'profit.csv' AS source_file
FROM sales_quarter GROUP BY year, quarter, suppkey, l_returnflag, l_linestatus
""")
bind("core_fact_market_structure", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', {**STATUS_COMMODITY, 'P': 'all'})} AS commodity,
       CASE WHEN o_orderstatus = 'F' AND quarter = 2 THEN 'other_' || substr(o_orderpriority, 1, 1) ELSE {case('o_orderpriority', {'1-URGENT': 'supplier_entries', '2-HIGH': 'supplier_exits', '3-MEDIUM': 'active_suppliers', '4-NOT SPECIFIED': 'continuing_active', '5-LOW': 'other'})} END AS metric_name,
       {COUNTED} AS value, 'count' AS unit, 'structure.csv' AS source_file
FROM order_groups
GROUP BY year, quarter, o_orderstatus, o_orderpriority
""")
bind("core_fact_market_share_retail", f"""
SELECT p.date_id, p.commodity, p.supplier_id, 'domestic' AS segment, 100 * p.price / t.price AS share_pct, 'share.csv' AS source_file
FROM (SELECT {_Q_ID} AS date_id, {case('l_linestatus', STATUS_COMMODITY)} AS commodity, suppkey AS supplier_id,
             {summed('price_c')} AS price FROM sales_quarter GROUP BY year, quarter, l_linestatus, suppkey) p
JOIN (SELECT {_Q_ID} AS date_id, {case('l_linestatus', STATUS_COMMODITY)} AS commodity, {summed('price_c')} AS price
      FROM sales_quarter GROUP BY year, quarter, l_linestatus) t
  ON t.date_id = p.date_id AND t.commodity = p.commodity
""")
DEBT_METRICS = [
    "avg_debt_no_arrangement_gbp", "avg_debt_with_arrangement_gbp", "accounts_in_arrears_no_arrangement",
    "accounts_repaying_debt", "ppm_debt_repayment_share_pct", "debt_value_gt91_days_billion_gbp",
    "credit_balance_total_bn_gbp", "credit_balance_total_rolling12_bn_gbp", "credit_balance_household_quarter_avg_gbp",
    "credit_balance_household_rolling12_avg_gbp", "credit_balance_quartile_lower_gbp",
    "credit_balance_quartile_median_gbp", "credit_balance_quartile_upper_gbp",
]
_CREDIT_NATIONS = ", ".join(str(i) for i in range(25) if DEBT_METRICS[i % 13].startswith("credit"))
bind("core_fact_consumer_debt", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', STATUS_COMMODITY)} AS commodity,
       CAST({case('o_orderpriority', PRIORITY_METHOD)} AS BIGINT) AS payment_method_id,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(1 AS BIGINT) END AS supplier_id,
       CASE WHEN c_nationkey IN ({_CREDIT_NATIONS}) THEN 'credit_balance'
            ELSE {case('c_mktsegment', {'FURNITURE': 'debt', 'BUILDING': 'arrears', 'HOUSEHOLD': 'debt_plus_arrears'})} END AS component,
       CASE WHEN o_orderstatus = 'O' AND year = 1996 THEN 'other' ELSE {case('c_nationkey', by_nation(DEBT_METRICS))} END AS metric_name, {dbl('total_c')} / 100 / n / 1000 AS value
FROM order_groups
""")
CUT_METRICS = [
    "disconnections_for_debt", "smart_ppm_self_disconnect_events", "smart_ppm_self_disconnect_customers",
    "smart_ppm_self_disconnect_customers_gt3h",
]
_CUT_METRIC = f"CASE WHEN o_orderstatus = 'F' AND year = 1997 THEN 'other' ELSE {case('c_nationkey', by_nation(CUT_METRICS))} END"
bind("core_fact_consumer_disconnections", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', STATUS_COMMODITY)} AS commodity,
       CAST({case('o_orderpriority', PRIORITY_METHOD)} AS BIGINT) AS payment_method_id, CAST(NULL AS BIGINT) AS supplier_id,
       {_CUT_METRIC} AS metric_name, {COUNTED} AS value
FROM order_groups GROUP BY year, quarter, o_orderstatus, o_orderpriority, {_CUT_METRIC}
UNION ALL
SELECT year * 10 + 1, {case('l_linestatus', STATUS_COMMODITY)}, CAST(NULL AS BIGINT), suppkey, CASE WHEN l_returnflag = 'R' THEN 'disconnections_for_debt' ELSE 'other' END, {COUNTED}
FROM sales_quarter GROUP BY year, l_linestatus, suppkey, CASE WHEN l_returnflag = 'R' THEN 'disconnections_for_debt' ELSE 'other' END
""")
SWITCH_METRICS = [
    "avg_switching_time_days", "total_switches", "switches_to_other_suppliers", "net_gains_other_suppliers",
    "switching_rate_internal_total_pct", "switching_rate_external_total_pct", "switching_rate_internal_by_tariff_pct",
]
_SWITCH_METRIC = f"CASE WHEN o_orderstatus = 'O' AND year = 1998 THEN 'other' ELSE {case('c_nationkey', by_nation(SWITCH_METRICS))} END"
bind("core_fact_switching_activity", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', STATUS_COMMODITY)} AS commodity,
       CAST({case('c_mktsegment', {'FURNITURE': 1, 'BUILDING': 2})} AS BIGINT) AS supplier_size_id,
       {_SWITCH_METRIC} AS metric_name, {COUNTED} AS value
FROM order_groups
GROUP BY year, quarter, o_orderstatus, {case('c_mktsegment', {'FURNITURE': 1, 'BUILDING': 2})}, {_SWITCH_METRIC}
""")
bind("core_fact_tariff_benchmarks", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', STATUS_COMMODITY)} AS commodity, c_mktsegment AS supplier_group,
       CAST({case('o_orderpriority', PRIORITY_METHOD)} AS BIGINT) AS payment_method_id,
       {case('c_nationkey', by_nation(['fixed', 'variable', None]))} AS tariff_type,
       {case('c_nationkey', by_nation(['cheapest_tariff_gbp_per_year', 'tariff_price_gbp_per_year', 'power_price_forward_delivery', 'tariff_price_gbp_per_year']))} AS metric_name,
       {dbl('total_c')} / 100 / n / 1000 AS value
FROM order_groups
""")
CAP_PARTS = ["wholesale", "network", "policy", "operating", "vat", "ebit", "total"]
bind("core_fact_bill_breakdown", f"""
SELECT {_Q_ID} AS date_id, {case('o_orderstatus', STATUS_COMMODITY)} AS commodity,
       CAST({case('o_orderpriority', PRIORITY_METHOD)} AS BIGINT) AS payment_method_id,
       {case('c_nationkey', by_nation(CAP_PARTS))} AS component,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'bill_component_gbp' ELSE 'price_cap_component_gbp' END AS metric_name,
       {dbl('total_c')} / 100 / n / 1000 AS value
FROM order_groups
""")
bind("core_fact_household_spend", f"""
SELECT year * 10 + 1 AS date_id, c_mktsegment AS segment, {MEAN_ORDER} / 100 AS value_pct
FROM order_groups GROUP BY year, c_mktsegment
""")
bind("core_fact_complaints_resolution", f"""
SELECT {_Q_ID} AS date_id, NULLIF(suppkey, 0) AS supplier_id,
       CAST({case('l_linestatus', {'F': 1})} AS BIGINT) AS supplier_size_id,
       CASE WHEN year < 2001 THEN {case('l_returnflag', {'A': 'complaints_received_per_100k', 'N': 'complaints_resolved_next_day_pct', 'R': 'complaints_resolved_8w_pct'})} ELSE 'other_' || l_returnflag END AS metric_name,
       {summed('qty_c')} / SUM(n) AS value, 'rate' AS unit, 'complaints.csv' AS source_file
FROM sales_quarter GROUP BY year, quarter, suppkey, l_linestatus, l_returnflag
UNION ALL
SELECT year * 10 + 1, suppkey, CAST(NULL AS BIGINT),
       CASE WHEN l_linestatus = 'O' THEN {case('l_returnflag', {'A': 'minor_incidents_current', 'N': 'major_incidents_current', 'R': 'minor_incidents_historical'})} ELSE 'none_' || l_returnflag END,
       {COUNTED}, 'count', 'incidents.csv'
FROM sales_quarter GROUP BY year, suppkey, l_returnflag, l_linestatus
""")
bind("core_fact_satisfaction_scores", f"""
SELECT {_Q_ID} AS date_id, suppkey AS supplier_id, CAST({case('l_linestatus', {'F': 2})} AS BIGINT) AS supplier_size_id,
       {case('l_linestatus', STATUS_COMMODITY)} AS commodity, {case('l_returnflag', {'A': 'billing'})} AS aspect,
       CASE WHEN year > 1995 THEN {case('l_returnflag', {'A': 'satisfaction_pct', 'N': 'satisfaction_overall_pct', 'R': 'nps_score'})} ELSE 'other_' || l_returnflag END AS metric_name,
       {dbl('SUM(tax_c)')} / SUM(n) AS value, 'pct' AS unit, 'satisfaction.csv' AS source_file
FROM sales_quarter GROUP BY year, quarter, suppkey, l_linestatus, l_returnflag
""")
bind("core_fact_customer_accounts_retail", f"""
SELECT year * 10 + 1 AS date_id, suppkey AS supplier_id, {case('l_linestatus', STATUS_COMMODITY)} AS commodity,
       'domestic' AS segment, {case('l_returnflag', {'A': 'fixed', 'N': 'variable'})} AS tariff_type,
       {COUNTED} AS value, 'accounts' AS unit
FROM sales_quarter GROUP BY year, suppkey, l_linestatus, l_returnflag
""")
bind("core_fact_heating_systems", f"""
SELECT {_Q_ID} AS date_id, o_orderpriority AS component, {COUNTED} AS value, 'count' AS unit
FROM order_groups GROUP BY year, quarter, o_orderpriority
""")

# --- renewables, discount scheme, schemes, statistics ----------------------------------------------------------

bind("raw_renewables", f"""
SELECT CASE WHEN l_linestatus = 'F' THEN make_date({YEAR}, ({QUARTER} - 1) * 3 + 1, 1) END AS period_date,
       CAST({YEAR} AS STRING) AS period_label, {YEAR} AS year, CASE WHEN l_linestatus = 'F' THEN {QUARTER} END AS quarter,
       {case('p_type', TYPE_FUELS)} AS technology, CASE WHEN l_returnflag = 'R' THEN n_name END AS region,
       CASE WHEN l_returnflag = 'N' THEN 'domestic' END AS installation_type,
       CASE WHEN s_nationkey < 12 THEN 'capacity_kw' WHEN s_nationkey < 20 THEN 'installations' ELSE 'share_pct' END AS metric_name,
       {total('l_quantity')} AS value, 'kw' AS unit, 'mcs.csv' AS source_file
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY {YEAR}, {QUARTER}, p_type, l_returnflag, l_linestatus, s_nationkey, n_name
""", shared=True)
_MEAN = "SUM(value) / COUNT(*) AS value, MAX(unit) AS unit, MAX(source_file) AS source_file"
bind("stg_renewables_capacity", f"""
SELECT year, technology, metric_name, {_MEAN} FROM raw_renewables
WHERE quarter IS NULL AND region IS NULL AND installation_type IS NULL AND metric_name IN ('capacity_kw', 'installations')
GROUP BY year, technology, metric_name
""")
bind("stg_renewables_quarterly", f"""
SELECT period_date, period_label, year, quarter, technology, metric_name, {_MEAN} FROM raw_renewables
WHERE quarter IS NOT NULL AND region IS NULL AND installation_type IS NULL AND metric_name IN ('capacity_kw', 'installations')
GROUP BY period_date, period_label, year, quarter, technology, metric_name
""")
bind("stg_renewables_regional", f"""
SELECT year, region, technology, metric_name, {_MEAN} FROM raw_renewables
WHERE region IS NOT NULL AND installation_type IS NULL GROUP BY year, region, technology, metric_name
""")
bind("stg_renewables_installation_type", f"""
SELECT year, installation_type, technology, metric_name, {_MEAN} FROM raw_renewables
WHERE quarter IS NULL AND region IS NULL AND installation_type IS NOT NULL AND metric_name IN ('capacity_kw', 'installations')
GROUP BY year, installation_type, technology, metric_name
""")
bind("raw_whd", f"""
SELECT year - 1994 AS scheme_year, year AS calendar_year,
       CASE WHEN o_orderstatus = 'P' THEN {case('c_nationkey', by_nation(['England', 'Scotland', 'Wales']))} END AS nation,
       CASE WHEN o_orderstatus <> 'P' THEN 'Supplier#' || substr('000000000' || CAST(c_nationkey AS STRING), length(CAST(c_nationkey AS STRING)) + 1, 9) END AS supplier_name,
       CASE WHEN o_orderstatus = 'O' THEN c_mktsegment END AS obligation_method,
       CASE WHEN o_orderstatus = 'P' THEN {case('c_mktsegment', {'FURNITURE': 'expenditure_pct', 'BUILDING': 'scheme_value_mgbp'}, "'other'")}
            ELSE {case('c_mktsegment', {'FURNITURE': 'obligation_amount_mgbp', 'BUILDING': 'redistributed_mgbp', 'HOUSEHOLD': 'obligation_amount_mgbp'}, "'other'")} END AS metric_name,
       {summed('total_c')} / 1000 AS value, 'mgbp' AS unit, 'whd_' || c_mktsegment AS source_file
FROM order_groups GROUP BY year, o_orderstatus, c_nationkey, c_mktsegment
""")
bind("stg_whd_scheme_year", f"""
SELECT scheme_year, calendar_year, nation, metric_name, {_MEAN} FROM raw_whd
WHERE supplier_name IS NULL AND obligation_method IS NULL AND metric_name IN ('expenditure_pct', 'scheme_value_mgbp')
GROUP BY scheme_year, calendar_year, nation, metric_name
""")
bind("stg_whd_obligation", f"""
SELECT scheme_year, calendar_year, supplier_name, obligation_method, metric_name, {_MEAN} FROM raw_whd
WHERE (supplier_name IS NOT NULL OR obligation_method IS NOT NULL)
  AND metric_name IN ('obligation_amount_mgbp', 'redistributed_mgbp')
GROUP BY scheme_year, calendar_year, supplier_name, obligation_method, metric_name
""")
_OBLIGATION = f"CAST({YEAR} AS STRING) || '-' || substr(CAST({YEAR} + 1 AS STRING), 3, 2)"
bind("raw_certificates", f"""
SELECT CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'Apr|' || {_OBLIGATION} WHEN l_returnflag = 'R' THEN 'unknown'
            ELSE {_OBLIGATION} END AS period_label, {YEAR} AS year,
       CASE WHEN l_linestatus = 'F' THEN {QUARTER} END AS quarter, {case('p_type', TYPE_FUELS)} AS technology,
       CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'rocs_monthly_millions' WHEN l_returnflag = 'N' THEN 'rocs_issued_millions'
            WHEN l_returnflag = 'R' THEN 'accredited_stations_cumulative_all' ELSE 'accredited_capacity_mw' END AS metric_name,
       {total('l_quantity')} AS value, 'mw' AS unit, 'chart_' || l_returnflag AS source_file
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY {YEAR}, {QUARTER}, p_type, l_linestatus, l_returnflag
""")
bind("core_fact_renewables_obligation", """
SELECT year * 10 + 1 AS date_id, CASE WHEN metric_name <> 'accredited_stations_cumulative_all' THEN period_label END AS obligation_period,
       period_label, technology, metric_name, SUM(value) AS value, MIN(source_file) AS source_file
FROM raw_certificates GROUP BY year, period_label, technology, metric_name
""")
bind("raw_scheme_metric", f"""
SELECT CAST(date_trunc('month', ts) AS DATE) AS period_date, 'week of ' || CAST(CAST(ts AS DATE) AS STRING) AS period_label,
       CASE WHEN event_type <> 'signup' THEN CAST(year(ts) AS INT) END AS year, CAST(quarter(ts) AS INT) AS quarter,
       CAST(month(ts) AS INT) AS month,
       {case('event_type', {'click': 'bus', 'view': 'bus', 'purchase': 'eco', 'signup': 'eco', 'error': 'rhi'})} AS scheme_key,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'user_' || CAST(user_id AS STRING) END AS entity,
       event_type AS metric_name, value, 'count' AS unit, 'scheme_' || event_type AS source_file
FROM events
""")
bind("core_fact_scheme_metric", f"""
SELECT period_date, period_label, year AS calendar_year, month AS calendar_month, quarter, scheme_key, entity, metric_name,
       {total('value')} / COUNT(*) AS value, MIN(unit) AS unit, MIN(source_file) AS source_file
FROM raw_scheme_metric GROUP BY period_date, period_label, year, month, quarter, scheme_key, entity, metric_name
""")
bind("stg_digest", f"""
SELECT {case('l_returnflag', {'A': '6.2', 'N': '6.3', 'R': '6.5'})} AS dukes_table,
       CASE WHEN l_linestatus = 'F' THEN {YEAR} END AS period_year, CAST(NULL AS STRING) AS period_label,
       CASE WHEN l_returnflag = 'R' THEN 'Renewable share of gross final electricity consumption ' || p_brand ELSE ' ' || p_brand || ' ' END AS row_label,
       CASE WHEN l_linestatus = 'F' THEN p_type END AS column_label,
       {case('l_returnflag', {'A': 'generation_gwh', 'N': 'load_factor_avg_capacity_pct', 'R': 'gfc_electricity_renewable_share_pct'})} AS metric_name,
       CASE WHEN l_returnflag = 'R' THEN {total('l_discount')} / COUNT(*) ELSE {total('l_quantity')} END AS value,
       'GWh' AS unit, 'digest.csv' AS source_file, CAST(NULL AS STRING) AS value_text
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY {YEAR}, l_returnflag, l_linestatus, p_brand, p_type
""")
