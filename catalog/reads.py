"""Parameterised reads over bound marts and facts."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import functions as F

from catalog import marts as M
from catalog.bound import by_nation, with_sold_lines
from catalog.engine import bind, case, query
from metricmart.operators.conform import union_all
from metricmart.operators.filters import conform
from metricmart.plans import marts, reads

import catalog.staging  # noqa: F401 - bound tables

FIRST, LAST = 1996, 2000
_BETWEEN = f"BETWEEN {FIRST} AND {LAST}"


@query(
    "read_year_bounds", "Q01 J19", """
SELECT MIN(year) AS y_min, 2021 AS y_max FROM core_dim_date
""",
)
def year_bounds(t):
    # The years end before the default upper bound, so a fact without rows would leave the default.
    empty = ChainMap({"core_fact_network_reliability": t["core_fact_network_reliability"].filter("ens_mwh < 0")}, t)
    return reads.year_bounds(empty)


@query(
    "read_companies", "Q02 F05", """
SELECT DISTINCT c.company_id, c.company_name, n.commodity, n.sector_name FROM core_dim_company c JOIN core_dim_network_sector n ON n.network_sector_id = c.network_sector_id WHERE lower(n.commodity) = 'gas'
""",
)
def companies(t):
    return reads.companies(t, "gas")


@query("read_regions", "Q02", "SELECT geography_id, geography_code, geography_name, geography_type FROM core_dim_geography WHERE geography_type = 'region'")
def regions(t):
    return reads.regions(t)


@query("read_suppliers", "Q02", "SELECT supplier_id, supplier_name, supplier_group, supplier_size FROM core_dim_supplier")
def suppliers(t):
    return reads.suppliers(t)


@query(
    "read_companies_and_years", "Q03 A04", """
SELECT COUNT(DISTINCT f.company_id) AS companies, MIN(d.year) AS year_min, MAX(d.year) AS year_max FROM core_fact_network_reliability f JOIN core_dim_date d ON d.date_id = f.date_id
""",
)
def companies_and_years(t):
    return reads.companies_and_years(t)


@query(
    "read_loss_and_spend", "Q04 F04", f"""
SELECT year, SUM(ens_mwh) AS ens_mwh, SUM(actual_totex_million_gbp) AS totex_million_gbp FROM ({M.COST_RELIABILITY}) WHERE year {_BETWEEN} GROUP BY 1
""", d6=["totex_million_gbp"],
)
def loss_and_spend(t):
    return reads.loss_and_spend(marts.cost_reliability(M.with_schemes(t)), FIRST, LAST)


bind("raw_fuel_poor", f"""
SELECT year, company_name, {case('sector_code', {'ET': 'Electricity Transmission', 'GD': 'Gas Distribution'})} AS network_sector,
       CASE WHEN year IN (1995, 2001) THEN {case('n_nationkey', by_nation(['fuel_poor_connections_actual', 'fuel_poor_connections_target', 'other']))} ELSE 'other' END AS metric_name, qty AS value, 'n' AS unit FROM supplier_year
""")
_FUEL_POOR = "metric_name IN ('fuel_poor_connections_actual', 'fuel_poor_connections_target')"


@query("read_fuel_poor", "Q05 J18 J19", f"SELECT * FROM raw_fuel_poor WHERE {_FUEL_POOR} AND year = 2001")
def fuel_poor(t):
    return reads.fuel_poor(t["raw_fuel_poor"], FIRST, LAST)


bind("stg_minutes", "SELECT year, company_name, sector_code AS network_sector, tax AS minutes_lost, returned AS ens_mwh, qty AS gas_lost_volume FROM supplier_year")


@query(
    "read_minutes_lost", "Q06 F11 Q40", f"""
SELECT d.year, c.company_name, n.sector_name, n.commodity, CASE WHEN n.commodity = 'gas' THEN COALESCE(f.minutes_lost, f.gas_lost_volume) ELSE f.minutes_lost END AS minutes_lost, f.ens_mwh, f.gas_lost_volume
FROM core_fact_network_reliability f JOIN core_dim_date d ON d.date_id = f.date_id JOIN core_dim_company c ON c.company_id = f.company_id JOIN core_dim_network_sector n ON n.network_sector_id = f.network_sector_id
WHERE d.year {_BETWEEN} AND n.commodity = 'gas'
""",
)
def minutes_lost(t):
    return reads.minutes_lost(t, t["stg_minutes"], FIRST, LAST, None, "gas")


@query(
    "read_minutes_lost_fallback", "Q06 Q40 C23", f"""
SELECT s.year, s.company_name, n.sector_name, n.commodity, s.minutes_lost, s.ens_mwh, s.gas_lost_volume FROM stg_minutes s JOIN core_dim_network_sector n ON n.sector_code = s.network_sector WHERE s.year {_BETWEEN}
""",
)
def minutes_lost_fallback(t):
    empty = ChainMap({"core_fact_network_reliability": t["core_fact_network_reliability"].filter("company_id < 0")}, t)
    return reads.minutes_lost(empty, t["stg_minutes"], FIRST, LAST)


bind("raw_costs", f"""
SELECT CASE WHEN quarter = 1 THEN make_date(year, 1, 1) END AS period_date, CASE WHEN o_orderstatus <> 'P' THEN year END AS year, {case('o_orderstatus', {'O': 'electricity', 'F': 'gas'})} AS commodity,
       {case('c_nationkey', by_nation(['prepayment_price_cap_gbp', 'prepayment_cheapest_gbp', 'cost_per_customer_et_gbp', 'cost_per_customer_ed_gbp', 'cost_per_customer_gd_gbp']))} AS metric_name, CAST(n AS DOUBLE) AS value, 'gbp' AS unit
FROM order_groups
""")


@query(
    "read_prepayment", "Q07 F03", f"""
SELECT period_date, year, metric_name, value, unit, commodity FROM raw_costs WHERE metric_name LIKE 'prepayment%' AND (year IS NULL OR year {_BETWEEN} OR period_date IS NOT NULL)
""",
)
def prepayment(t):
    return reads.prepayment_series(t["raw_costs"], FIRST, LAST)


bind("raw_connections", f"""
SELECT year, company_name, {case('sector_code', {'ET': 'Electricity Transmission', 'ED': 'Electricity Distribution', 'GT': 'Gas Transmission', 'GD': 'Gas Distribution'})} AS network_sector,
       {case('n_nationkey', by_nation(['connection_lvssa_actual_days', 'connection_x_actual_y_days', 'connection_count', 'other']))} AS metric_name, qty AS value FROM supplier_year
""")
_DAYS = "SELECT year, company_name, AVG(value) FILTER (WHERE metric_name LIKE 'connection_%actual%days%') AS avg_conn_days FROM raw_connections GROUP BY 1, 2"


@query(
    "read_satisfaction_connections", "Q08 A02 C25", f"""
SELECT d.year, c.company_name, n.sector_name, f.satisfaction_score, x.avg_conn_days FROM core_fact_customer_metrics f JOIN core_dim_date d ON d.date_id = f.date_id LEFT JOIN core_dim_company c ON c.company_id = f.company_id
LEFT JOIN core_dim_network_sector n ON n.network_sector_id = f.network_sector_id LEFT JOIN ({_DAYS}) x ON x.year = d.year AND x.company_name = c.company_name
WHERE d.year {_BETWEEN} AND (f.satisfaction_score IS NOT NULL OR x.avg_conn_days IS NOT NULL)
""",
)
def satisfaction_connections(t):
    return reads.satisfaction_connections(t, t["raw_connections"], t["raw_survey"], FIRST, LAST)


@query(
    "read_satisfaction_raw", "Q08 A13 Q40", f"""
SELECT s.year, s.company_name, CAST(NULL AS VARCHAR) AS sector_name, AVG(s.value) AS satisfaction_score, x.avg_conn_days FROM raw_survey s JOIN ({_DAYS}) x ON x.year = s.year AND x.company_name = s.company_name
WHERE s.year {_BETWEEN} AND s.metric_name IN ('customer_survey_score', 'stakeholder_survey_score') AND x.avg_conn_days IS NOT NULL GROUP BY 1, 2, 5
""", d6=["satisfaction_score"],
)
def satisfaction_raw(t):
    empty = ChainMap({"core_fact_customer_metrics": t["core_fact_customer_metrics"].limit(0)}, t)
    return reads.satisfaction_connections(empty, t["raw_connections"], t["raw_survey"], FIRST, LAST)


_CANON = """canon AS (SELECT k, arg_min(company_name, (s, company_name)) AS c FROM (
  SELECT lower(trim(source_company_name)) AS k, company_name, CASE WHEN network_sector_code = '{s}' THEN 1 ELSE 2 END AS s FROM alias_rows
  UNION ALL SELECT lower(trim(company_name)), company_name, CASE WHEN network_sector_code = '{s}' THEN 3 ELSE 4 END FROM alias_rows) GROUP BY k)"""


@query(
    "read_vulnerable_operators", "Q09 J21 W12 J25 T02", f"""
WITH {_CANON.format(s='GD')},
 p AS (SELECT COALESCE(c.c, f.company_name) AS k, AVG(f.value) AS fuel_poor_avg FROM raw_fuel_poor f LEFT JOIN canon c ON c.k = lower(f.company_name) WHERE f.metric_name = 'fuel_poor_connections_actual' GROUP BY 1),
 l AS (SELECT COALESCE(c.c, f.company_name) AS k, AVG(f.minutes_lost) AS minutes_lost_avg, AVG(f.gas_lost_volume) AS gas_lost_avg FROM stg_minutes f LEFT JOIN canon c ON c.k = lower(f.company_name) GROUP BY 1),
 j AS (SELECT COALESCE(p.k, l.k) AS operator_key, fuel_poor_avg, minutes_lost_avg, gas_lost_avg, COALESCE(fuel_poor_avg, 0) AS a, COALESCE(minutes_lost_avg, 0) AS b FROM p FULL JOIN l ON l.k = p.k)
SELECT operator_key, fuel_poor_avg, minutes_lost_avg, gas_lost_avg, (a - (SELECT AVG(a) FROM j)) / (SELECT STDDEV_POP(a) FROM j) + (b - (SELECT AVG(b) FROM j)) / (SELECT STDDEV_POP(b) FROM j) AS score
FROM j ORDER BY score DESC, operator_key LIMIT 10
""", d6=["fuel_poor_avg", "minutes_lost_avg", "gas_lost_avg", "score"],
)
def vulnerable_operators(t):
    return reads.vulnerable_operators(t["raw_fuel_poor"], t["stg_minutes"], t["alias_rows"])


bind("raw_market", f"""
SELECT CASE WHEN o_orderstatus <> 'P' THEN make_date(year, (quarter - 1) * 3 + 1, 1) END AS period_date, 'isoweek_' || CAST(quarter * 5 AS STRING) AS period_label, year, {case('o_orderpriority', {'1-URGENT': 'gas'}, "'electricity'")} AS commodity,
       {case('c_mktsegment', {'FURNITURE': 'churn', 'BUILDING': 'wind', 'MACHINERY': 'coal', 'HOUSEHOLD': 'TOTAL'})} AS instrument,
       {case('c_nationkey', by_nation(['volatility_electricity_baseload', 'spark_spread_central', 'dark_spread', 'power_price_baseload', 'bid_offer_spread', 'generation_share_twh', 'volatility_gas', 'volume_churn']))} AS metric_name,
       CAST(total_c AS DOUBLE) / 100 / n / 1000 AS value, 'gbp' AS unit
FROM order_groups
""")


@query(
    "read_churn_monthly", "Q10 C25", f"""
SELECT period_date, year, commodity, instrument, metric_name, value, unit FROM raw_market WHERE year {_BETWEEN} AND lower(commodity) = 'electricity' AND (instrument = 'churn' OR metric_name LIKE '%churn%')
""",
)
def churn_monthly(t):
    return reads.churn_monthly(t["raw_market"], FIRST, LAST)


@query(
    "read_volatility", "Q10 Q40", f"""
SELECT period_date, year, commodity, metric_name, value, unit FROM raw_market WHERE year {_BETWEEN} AND period_date IS NOT NULL AND metric_name LIKE 'volatility%'
""",
)
def volatility(t):
    return reads.volatility_series(t["raw_market"], t["core_fact_market_prices"], FIRST, LAST)


_GREEN = "lower({c}) LIKE '%wind%' OR lower({c}) LIKE '%solar%' OR lower({c}) LIKE '%hydro%' OR lower({c}) LIKE '%bio%'"


@query(
    "read_renewable_share", "Q11 A17", f"""
SELECT year, 100 * SUM(value) FILTER (WHERE {_GREEN.format(c='fuel_source')}) / NULLIF(SUM(value), 0) AS renewable_pct FROM core_fact_market_context
WHERE commodity = 'electricity' AND metric_name = 'generation_twh' AND year {_BETWEEN} GROUP BY 1
""", d9=["renewable_pct"],
)
def renewable_share(t):
    return reads.renewable_share(t["core_fact_market_context"], t["raw_market"], FIRST, LAST)


@query(
    "read_renewable_share_raw", "Q11 A17 Q40", f"""
SELECT year, 100 * SUM(value) FILTER (WHERE {_GREEN.format(c='instrument')}) / NULLIF(SUM(value), 0) AS renewable_pct FROM raw_market
WHERE commodity = 'electricity' AND metric_name = 'generation_share_twh' AND COALESCE(instrument, '') NOT IN ('', 'TOTAL') AND year {_BETWEEN} GROUP BY 1
""", d8=["renewable_pct"],
)
def renewable_share_raw(t):
    return reads.renewable_share(t["core_fact_market_context"].filter("year < 0"), t["raw_market"], FIRST, LAST)


@query(
    "read_renewable_share_mart", "Q11 A17", f"""
SELECT year, 100 * SUM(fuel_value) FILTER (WHERE {_GREEN.format(c='fuel_source')}) / NULLIF(SUM(fuel_value), 0) AS renewable_pct FROM ({M.MARKET_CONTEXT})
WHERE commodity = 'electricity' AND year {_BETWEEN} AND market_share_pct_2024 IS NULL AND fuel_value IS NOT NULL AND fuel_source <> 'TOTAL' GROUP BY 1 HAVING SUM(fuel_value) > 0
""", d9=["renewable_pct"],
)
def renewable_share_mart(t):
    return reads.renewable_share_from_mart(marts.market_context(with_sold_lines(t)), FIRST, LAST)


@query(
    "read_power_price", "Q12 A02", f"""
SELECT year, AVG(value) AS power_gbp_mwh FROM core_fact_market_prices WHERE commodity = 'electricity' AND year {_BETWEEN} AND metric_name = 'power_price_baseload' GROUP BY 1
""", d6=["power_gbp_mwh"],
)
def power_price(t):
    return reads.power_price(t["core_fact_market_prices"], t["raw_market"], FIRST, LAST)


@query(
    "read_power_price_mart", "Q12 Q17 A13", f"""
SELECT year, MAX(power_baseload_avg) AS power_gbp_mwh, MAX(churn_ratio_avg) AS churn_ratio_avg FROM ({M.MARKET_CONTEXT}) WHERE commodity = 'electricity' AND year {_BETWEEN} AND market_share_pct_2024 IS NULL
GROUP BY 1 HAVING MAX(power_baseload_avg) IS NOT NULL
""", d6=["power_gbp_mwh", "churn_ratio_avg"],
)
def power_price_mart(t):
    mart = marts.market_context(with_sold_lines(t))
    return reads.power_price_from_mart(mart, FIRST, LAST).join(reads.churn_annual(mart, FIRST, LAST), "year")


@query(
    "read_quarterly_spreads", "Q13 C27 A02 A13", f"""
SELECT CAST(date_trunc('quarter', period_date) AS DATE) AS quarter_start, AVG(value) FILTER (WHERE metric_name = 'spark_spread_central') AS spark_central, AVG(value) FILTER (WHERE metric_name = 'dark_spread') AS dark_spread
FROM raw_market WHERE commodity = 'electricity' AND year {_BETWEEN} AND period_date IS NOT NULL AND metric_name IN ('spark_spread_central', 'dark_spread') GROUP BY 1
""", d6=["spark_central", "dark_spread"],
)
def quarterly_spreads(t):
    return reads.quarterly_spreads(t["raw_market"], t["core_fact_market_prices"], FIRST, LAST)


@query(
    "read_bid_offer", "Q14 C28", f"""
SELECT COALESCE(period_date, CAST(date_trunc('week', make_date(year, 1, 4)) AS DATE) + (CAST(substr(period_label, 9) AS INT) - 1) * 7) AS period_date, period_label, year, commodity, value AS bid_offer_spread
FROM raw_market WHERE metric_name = 'bid_offer_spread' AND year {_BETWEEN} AND commodity = 'electricity'
""",
)
def bid_offer(t):
    core = t["core_fact_market_prices"].withColumn("period_label", F.lit("2001"))
    return reads.bid_offer_weekly(core, t["raw_market"], FIRST, LAST, "both")


@query(
    "read_metric_availability", "Q15 A01", """
SELECT 'core' AS source, MIN(year) AS y_min, MAX(year) AS y_max, COUNT(*) AS n FROM core_fact_market_prices WHERE metric_name = 'dark_spread'
UNION ALL SELECT 'raw', MIN(year), MAX(year), COUNT(*) FROM raw_market WHERE metric_name = 'dark_spread'
""",
)
def metric_availability(t):
    return reads.metric_availability({"core": t["core_fact_market_prices"], "raw": t["raw_market"]}, "dark_spread")


_HHI = "SUM(POWER(CASE WHEN m <= 1 THEN 100 * s ELSE s END, 2)) AS hhi_0_10000"


@query(
    "read_generation_hhi", "Q16 A09 C33", f"""
SELECT year, {_HHI} FROM (SELECT year, share_pct AS s, MAX(share_pct) OVER (PARTITION BY year) AS m FROM core_fact_market_share) GROUP BY 1
""", d6=["hhi_0_10000"],
)
def generation_hhi(t):
    landed = t["core_fact_market_share"].select("year", "company_name", F.lit("x").alias("metric_name"), F.col("share_pct").alias("value"))
    return reads.generation_concentration(t["core_fact_market_share"], landed)


@query(
    "read_generation_hhi_mart", "Q16 A09", f"""
SELECT year, 'electricity' AS commodity, {_HHI} FROM (SELECT year, share_pct AS s, MAX(share_pct) OVER (PARTITION BY year) AS m FROM core_fact_market_share WHERE year {_BETWEEN}) GROUP BY 1
""", d6=["hhi_0_10000"],
)
def generation_hhi_mart(t):
    return reads.generation_concentration_from_mart(marts.market_context(with_sold_lines(t)), FIRST, LAST)


@query(
    "read_daily_series", "Q18 F05", """
SELECT period_date, CAST(year(period_date) AS INT) AS year, commodity, source_name, metric_name, value, unit FROM core_fact_daily_prices WHERE commodity = 'gas' AND year(period_date) BETWEEN 2024 AND 2025
""",
)
def daily_series(t):
    return reads.daily_series(t["core_fact_daily_prices"], 2024, 2025, "gas")


@query(
    "read_daily_monitoring", "Q18", f"SELECT * FROM ({M.DAILY}) WHERE commodity = 'electricity' AND year BETWEEN 2020 AND 2024", d6=["avg_daily_value", "volatility_stddev"],
)
def daily_monitoring(t):
    return reads.daily_monitoring(marts.daily_monitoring(t), 2020, 2024, "electricity")


bind("stat_rows", """
SELECT year, p_type AS sector, l_returnflag AS fuel_type, price AS expenditure_million_gbp, qty AS energy_ktoe, qty * 0.01163 AS energy_twh, filled AS consumption_mtoe, 'f' AS source_file FROM type_year
""")


@query(
    "read_statistics", "Q19", f"""
SELECT 'spend' AS source, year, sector, CAST(NULL AS VARCHAR) AS fuel_type, expenditure_million_gbp AS value FROM stat_rows WHERE year {_BETWEEN}
UNION ALL SELECT 'final', year, sector, fuel_type, energy_ktoe FROM stat_rows WHERE year {_BETWEEN} AND sector = 'SMALL'
UNION ALL SELECT 'fuels', year, NULL, fuel_type, consumption_mtoe FROM stat_rows WHERE year {_BETWEEN}
UNION ALL SELECT 'ratio', year, NULL, NULL, energy_twh FROM stat_rows WHERE year {_BETWEEN}
""",
)
def statistics(t):
    rows = t["stat_rows"]
    spend = reads.expenditure_by_sector(rows.select("year", "sector", "expenditure_million_gbp"), FIRST, LAST)
    final = reads.final_consumption(rows.select("year", "sector", "fuel_type", "energy_ktoe"), FIRST, LAST, "SMALL")
    fuels = reads.primary_fuels(rows.select("year", "fuel_type", "consumption_mtoe"), FIRST, LAST)
    ratio = reads.energy_ratio(rows.select("year", F.col("energy_twh").alias("value")), FIRST, LAST)
    shape = [("source", "string"), ("year", "int"), ("sector", "string"), ("fuel_type", "string"), ("value", "double")]
    frames = {"spend": spend.withColumnRenamed("expenditure_million_gbp", "value"), "final": final.withColumnRenamed("energy_ktoe", "value"),
              "fuels": fuels.withColumnRenamed("consumption_mtoe", "value"), "ratio": ratio}
    return union_all([conform(df, shape, source=n) for n, df in frames.items()])


@query(
    "read_network_cost_proxy", "Q20 R29", f"""
SELECT year, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_et_gbp') AS elec_tx_avg_gbp, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_ed_gbp') AS elec_dx_avg_gbp,
       AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_gt_gbp') AS gas_tx_avg_gbp, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_gd_gbp') AS gas_dx_avg_gbp FROM raw_costs WHERE year {_BETWEEN} GROUP BY 1
""", d6=["elec_tx_avg_gbp", "elec_dx_avg_gbp", "gas_dx_avg_gbp"],
)
def network_cost_proxy(t):
    return reads.network_cost_proxy(t["raw_costs"], FIRST, LAST)


bind("flow_rows", f"""
SELECT year AS reference_year, {case('l_returnflag', {'A': 'A', 'N': 'D', 'R': 'E'})} AS table_id, {case('p_type', {'SMALL': 1, 'PROMO': 2, 'LARGE': 3})} AS row_no, p_type AS row_code, 'Flow of ' || p_type || ' into the economy as a whole and beyond' AS row_label,
       CASE WHEN p_type = 'ECONOMY' THEN 'B' ELSE 'A_U' END AS industry_code, qty AS energy_tj, 'f' AS source_file FROM type_year
""")


@query(
    "read_energy_flows", "Q21 T02", f"""
SELECT 'D' AS source, reference_year, row_no, row_code, energy_tj FROM flow_rows WHERE table_id = 'D' AND industry_code = 'A_U' AND reference_year {_BETWEEN}
UNION ALL (SELECT 'A', reference_year, NULL, row_code, energy_tj FROM flow_rows WHERE table_id = 'A' AND industry_code = 'A_U' AND reference_year {_BETWEEN} ORDER BY energy_tj DESC, reference_year, row_code LIMIT 7)
UNION ALL SELECT 'E', reference_year, NULL, row_code, energy_tj FROM flow_rows WHERE table_id = 'E' AND reference_year {_BETWEEN}
""",
)
def energy_flows(t):
    rows = t["flow_rows"]
    bridge = rows.filter("table_id = 'E'").select("reference_year", F.col("row_code").alias("bridge_code"), "energy_tj")
    shape = [("source", "string"), ("reference_year", "int"), ("row_no", "int"), ("row_code", "string"), ("energy_tj", "double")]
    frames = {"D": reads.flow_rows(rows, "D", FIRST, LAST), "A": reads.flow_top_supply(rows, FIRST, LAST, 7),
              "E": reads.flow_bridge(bridge, FIRST, LAST).withColumnRenamed("bridge_code", "row_code")}
    return union_all([conform(df, shape, source=n) for n, df in frames.items()])


@query(
    "read_canonical_assets", "Q22 J25", f"""
WITH {_CANON.format(s='ED')}, {_CANON.format(s='GD').replace('canon', 'gd', 1)}
SELECT 'days' AS source, r.year, COALESCE(c.c, r.company_name) AS company_name, r.value FROM raw_connections r LEFT JOIN canon c ON c.k = lower(r.company_name) WHERE r.year {_BETWEEN} AND r.metric_name = 'connection_count'
UNION ALL SELECT 'lost', d.year, COALESCE(c.c, m.company_name), f.gas_lost_volume FROM core_fact_network_reliability f JOIN core_dim_date d ON d.date_id = f.date_id JOIN core_dim_company m ON m.company_id = f.company_id
 LEFT JOIN gd c ON c.k = lower(m.company_name) WHERE f.network_sector_id = 4 AND d.year {_BETWEEN}
""",
)
def canonical_assets(t):
    days = reads.canonical_metric(t["raw_connections"], t["alias_rows"], FIRST, LAST, ["connection_count"], "ED")
    lost = reads.canonical_reliability(t, t["alias_rows"], "gas_lost_volume", FIRST, LAST, "gas", "GD")
    shape = [("source", "string"), ("year", "int"), ("company_name", "string"), ("value", "double")]
    return union_all([conform(days, shape, source="days"), conform(lost.withColumnRenamed("gas_lost_volume", "value"), shape, source="lost")])


@query(
    "read_emission_loss_spend", "Q23 J23 J01", f"""
SELECT m.year, m.company_name, m.sector_name, m.sf6_kg, c.ens_mwh, c.actual_totex_million_gbp, m.rore_pct FROM ({M.REGULATORY}) m JOIN ({M.COST_RELIABILITY}) c ON c.year = m.year AND c.company_name = m.company_name AND c.sector_name = m.sector_name
WHERE m.year {_BETWEEN} AND lower(m.sector_name) LIKE '%transmission%'
""",
)
def emission_loss_spend(t):
    return reads.emission_loss_spend(marts.regulatory_performance(t), marts.cost_reliability(M.with_schemes(t)), t, FIRST, LAST)


@query("read_availability", "Q24", f"SELECT year, company_name, network_sector, metric_name, value FROM raw_connections WHERE year {_BETWEEN}")
def availability(t):
    return reads.network_availability(t["raw_connections"], FIRST, LAST)


PAIRS = [(1990, 1996), (1995, 2001), (1996, 2000)]


@query(
    "read_baseline_compare", "Q25 R29 W09 J25", f"""
WITH {_CANON.format(s='ET')}, p AS (SELECT company_name, MAX(tax) FILTER (WHERE year = 1995) AS a, MAX(tax) FILTER (WHERE year = 2001) AS b FROM supplier_year WHERE year IN (1995, 2001) GROUP BY 1),
 x AS (SELECT COALESCE(c.c, p.company_name) AS company_name, 1995 AS baseline_year, 2001 AS compare_year, a AS baseline_value, b AS compare_value, b - a AS delta, (b - a) / NULLIF(a, 0) * 100 AS pct_change FROM p LEFT JOIN canon c ON c.k = lower(p.company_name))
SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY company_name ORDER BY pct_change DESC NULLS LAST, baseline_value DESC NULLS LAST, compare_value DESC NULLS LAST) = 1
""",
)
def baseline_compare(t):
    rows = t["supplier_year"].select("year", "company_name", F.col("tax").alias("sf6_kg"))
    return reads.baseline_compare([rows.filter("year < 1990"), rows.filter("year in (1995, 2001)")], t["alias_rows"], pairs=PAIRS)


@query(
    "read_transmission", "Q26 Q29 A02 C25", f"""
SELECT 'activity' AS source, year, company_name, SUM(value) FILTER (WHERE metric_name ILIKE '%connection%') AS a, CAST(NULL AS DOUBLE) AS b FROM raw_connections WHERE year {_BETWEEN} AND lower(network_sector) LIKE '%transmission%' GROUP BY 2, 3
UNION ALL SELECT 'totals', year, NULL, SUM(value) FILTER (WHERE lower(network_sector) LIKE '%electricity%transmission%'), SUM(value) FILTER (WHERE lower(network_sector) LIKE '%gas%transmission%') FROM raw_connections WHERE year {_BETWEEN} GROUP BY 2
UNION ALL SELECT 'spend', d.year, c.company_name, f.actual_totex_million_gbp, NULL FROM core_fact_financial_performance f JOIN core_dim_date d ON d.date_id = f.date_id JOIN core_dim_company c ON c.company_id = f.company_id
 WHERE f.network_sector_id IN (1, 3) AND d.year BETWEEN {FIRST - 1} AND {LAST}
UNION ALL SELECT 'mix', year, instrument, value, NULL FROM raw_market WHERE year {_BETWEEN} AND metric_name = 'generation_share_twh'
""",
)
def transmission(t):
    shape = [("source", "string"), ("year", "int"), ("company_name", "string"), ("a", "double"), ("b", "double")]
    frames = {
        "activity": reads.connections_activity(t["raw_connections"], FIRST, LAST).withColumnRenamed("connections_activity", "a"),
        "totals": reads.connection_totals(t["raw_connections"], FIRST, LAST).withColumnsRenamed({"elec_tx": "a", "gas_tx": "b"}),
        "spend": reads.transmission_spend(t, FIRST, LAST).withColumnRenamed("actual_totex_million_gbp", "a"),
        "mix": reads.generation_mix(t["raw_market"], FIRST, LAST).withColumnsRenamed({"twh": "a", "fuel_source": "company_name"}),
    }
    return union_all([conform(df, shape, source=n) for n, df in frames.items()])


@query(
    "read_return_and_loss", "Q27 J01", f"""
SELECT 'r' AS source, d.year, c.company_name, f.rore_pct, r.ens_mwh FROM core_fact_financial_performance f JOIN core_fact_network_reliability r ON r.date_id = f.date_id AND r.company_id = f.company_id AND r.network_sector_id = f.network_sector_id
JOIN core_dim_date d ON d.date_id = f.date_id JOIN core_dim_company c ON c.company_id = f.company_id WHERE f.network_sector_id = 1 AND d.year {_BETWEEN}
UNION ALL SELECT 'm', year, company_name, rore_pct, NULL FROM ({M.REGULATORY}) WHERE year {_BETWEEN}
""",
)
def return_and_loss(t):
    shape = [("source", "string"), ("year", "int"), ("company_name", "string"), ("rore_pct", "double"), ("ens_mwh", "double")]
    slice_ = reads.regulatory(marts.regulatory_performance(t), FIRST, LAST)
    return union_all([conform(reads.return_and_loss(t, FIRST, LAST), shape, source="r"), conform(slice_, shape, source="m")])


@query(
    "read_efficiency_rank", "Q28 W04 C29 T01", f"""
WITH y AS (SELECT *, reliability_rate - LAG(reliability_rate) OVER (PARTITION BY company_name, sector_name ORDER BY year) AS rel_improve FROM ({M.COST_RELIABILITY}) WHERE year {_BETWEEN})
SELECT year, company_name, sector_name, actual_totex_million_gbp / NULLIF(totex_allowance_million_gbp, 0) AS spend_ratio, rel_improve,
       (actual_totex_million_gbp / NULLIF(totex_allowance_million_gbp, 0)) / NULLIF(rel_improve, 0) AS efficiency_score FROM y WHERE rel_improve IS NOT NULL
""",
)
def efficiency_rank(t):
    return reads.efficiency_rank(marts.cost_reliability(M.with_schemes(t)), FIRST, LAST)


@query(
    "read_impact", "Q30 J16 T02", f"""
WITH i AS ({M.ECONOMIC_IMPACT})
SELECT 'region' AS source, year, geography_code AS code, SUM(output_at_risk_gbp) AS value FROM i WHERE year {_BETWEEN} AND geography_code <> 'GB' GROUP BY 2, 3
UNION ALL (SELECT 'industry', NULL, industry_name, SUM(output_at_risk_gbp) FROM i WHERE year {_BETWEEN} GROUP BY 3 ORDER BY 4 DESC LIMIT 3)
""", d0=["value"],
)
def impact(t):
    mart = marts.economic_impact(with_sold_lines(t))
    shape = [("source", "string"), ("year", "int"), ("code", "string"), ("value", "double")]
    region = reads.impact_by_region(mart, t["core_dim_geography"], FIRST, LAST, list(range(1, 26)))
    top = reads.top_industries(mart, FIRST, LAST, 3)
    return union_all([
        conform(region.withColumnsRenamed({"geography_code": "code", "output_at_risk_gbp": "value"}), shape, source="region"),
        conform(top.withColumnsRenamed({"industry_name": "code", "output_at_risk_gbp": "value"}), shape, source="industry"),
    ])


@query(
    "read_cross_commodity", "Q31", f"""
SELECT d.year, g.geography_name, n.commodity, n.sector_name, SUM(COALESCE(r.ens_mwh, 0)) AS ens_mwh FROM core_fact_network_reliability r JOIN core_dim_date d ON d.date_id = r.date_id JOIN core_dim_geography g ON g.geography_id = r.geography_id
JOIN core_dim_network_sector n ON n.network_sector_id = r.network_sector_id WHERE d.year {_BETWEEN} GROUP BY 1, 2, 3, 4
""",
)
def cross_commodity(t):
    rows = reads.cross_commodity(marts.cross_commodity_risk(t), FIRST, LAST)
    return rows.select("year", "geography_name", "commodity", "sector_name", "ens_mwh")


@query(
    "read_forecast_input", "Q32 Q40", """
SELECT d.year, SUM(f.gas_lost_volume) AS ens_mwh, 'gas_lost_volume_proxy' AS metric_name FROM core_fact_network_reliability f JOIN core_dim_date d ON d.date_id = f.date_id JOIN core_dim_company c ON c.company_id = f.company_id
WHERE c.company_name = (SELECT MIN(company_name) FROM core_dim_company WHERE network_sector_id = 4) GROUP BY 1
""",
)
def forecast_input(t):
    # A gas company has no energy loss, so both earlier sources lack values.
    name = t["core_dim_company"].filter("network_sector_id = 4").agg(F.min("company_name")).first()[0]
    return reads.forecast_input(marts.cost_reliability(M.with_schemes(t)), t, 1990, 2010, f"{name} (north)")


@query(
    "read_cross_layer", "Q33", f"SELECT * FROM ({M.SUPPLIER_QUALITY}) WHERE year {_BETWEEN}", d11=M._QUALITY,
)
def cross_layer(t):
    return reads.cross_layer(marts.supplier_quality(t), FIRST, LAST)


@query(
    "read_digest_rows", "Q34 F12 F03", f"""
SELECT * FROM stg_digest WHERE dukes_table = '6.3' AND (period_year IS NULL OR period_year {_BETWEEN}) AND metric_name = 'load_factor_avg_capacity_pct'
""",
)
def digest_rows(t):
    return reads.digest_rows(t["stg_digest"], "6.3", FIRST, LAST, "load_factor_avg_capacity_pct")


@query(
    "read_digest_pickers", "Q34 F12", """
SELECT DISTINCT 'table' AS kind, dukes_table AS name FROM stg_digest UNION ALL SELECT DISTINCT 'metric', metric_name FROM stg_digest WHERE dukes_table = '6.5'
""",
)
def digest_pickers(t):
    tables = reads.digest_tables(t["stg_digest"]).select(F.lit("table").alias("kind"), F.col("dukes_table").alias("name"))
    names = reads.digest_metrics(t["stg_digest"], "6.5").select(F.lit("metric").alias("kind"), F.col("metric_name").alias("name"))
    return tables.unionByName(names)


@query(
    "read_deployment", "Q35", f"""
WITH d AS ({M.DEPLOYMENT}) SELECT grain, year, technology, capacity_kw, region, capacity_kw_quarter FROM d WHERE year {_BETWEEN} AND grain IN ('annual_gb', 'regional', 'quarterly_gb')
""", d6=["capacity_kw", "capacity_kw_quarter"],
)
def deployment(t):
    mart = marts.renewables_deployment(t)
    shape = [("grain", "string"), ("year", "int"), ("technology", "string"), ("capacity_kw", "double"), ("region", "string"), ("capacity_kw_quarter", "double")]
    return union_all([conform(reads.deployment(mart, g, FIRST, LAST), shape, grain=g) for g in ("annual_gb", "regional", "quarterly_gb")])


@query(
    "read_official_series", "Q35 W08", f"""
SELECT 'series' AS kind, period_year AS year, trim(row_label) AS technology, value FROM stg_digest WHERE dukes_table = '6.2' AND period_year {_BETWEEN}
UNION ALL SELECT 'share', period_year, NULL, arg_min(value, (trim(row_label), value)) FROM stg_digest WHERE dukes_table = '6.5' AND period_year {_BETWEEN} AND value BETWEEN 0 AND 1 AND row_label ILIKE '%renewable share%' GROUP BY 2
""",
)
def official_series(t):
    mart = marts.official_renewables(t["stg_digest"])
    series = reads.official_series(mart, "capacity_generation_shares", "generation_gwh", FIRST, LAST)
    share = reads.official_share(mart, FIRST, LAST)
    shape = [("kind", "string"), ("year", "int"), ("technology", "string"), ("value", "double")]
    return union_all([conform(series, shape, kind="series"), conform(share.withColumnRenamed("renewable_share", "value"), shape, kind="share")])


@query(
    "read_supplier_health", "Q36 Q40", f"SELECT *, 'fallback' AS source FROM ({M.SUPPLIER_HEALTH}) WHERE year {_BETWEEN}", d11=M._HEALTH, d9=["profit_million_gbp"],
)
def supplier_health(t):
    empty = marts.supplier_health(t).filter("year < 0")
    return reads.supplier_health(empty, t, FIRST, LAST)


@query("read_vulnerability", "Q37 F05", f"SELECT * FROM ({M.VULNERABILITY}) WHERE year {_BETWEEN} AND commodity = 'gas' AND payment_method = 'prepayment'", d11=[*M._DEBT, *M._AGED, *M._CREDIT, "arrears_rate"])
def vulnerability(t):
    return reads.vulnerability(marts.consumer_vulnerability(t), FIRST, LAST, "gas", "prepayment")


@query(
    "read_retail_hhi", "Q37 A08", f"""
SELECT h AS hhi_latest, y AS year FROM (SELECT y, AVG(s) AS h FROM (SELECT d.year AS y, m.commodity, SUM(POWER(m.share_pct / 100, 2)) AS s FROM core_fact_market_share_retail m JOIN core_dim_date d ON d.date_id = m.date_id GROUP BY 1, 2) GROUP BY 1) WHERE y = {LAST}
""", d8=["hhi_latest"],
)
def retail_hhi(t):
    return reads.retail_concentration_latest(t, FIRST, LAST)


@query(
    "read_accounts_heating", "Q37", f"""
SELECT 'accounts' AS source, d.year, CAST(NULL AS INT) AS quarter, s.supplier_name AS name, f.value FROM core_fact_customer_accounts_retail f JOIN core_dim_date d ON d.date_id = f.date_id LEFT JOIN core_dim_supplier s ON s.supplier_id = f.supplier_id
WHERE d.year {_BETWEEN} AND lower(f.commodity) = 'gas' UNION ALL SELECT 'heating', d.year, d.quarter, f.component, f.value FROM core_fact_heating_systems f JOIN core_dim_date d ON d.date_id = f.date_id WHERE d.year {_BETWEEN}
""",
)
def accounts_heating(t):
    shape = [("source", "string"), ("year", "int"), ("quarter", "int"), ("name", "string"), ("value", "double")]
    accounts = reads.customer_accounts(t, FIRST, LAST, "gas").withColumnRenamed("supplier_name", "name")
    heating = reads.heating_systems(t, FIRST, LAST).withColumnRenamed("component", "name")
    return union_all([conform(accounts, shape, source="accounts"), conform(heating, shape, source="heating")])


@query(
    "read_disconnections", "Q38 T03", f"""
WITH y AS (SELECT d.year, f.supplier_id, SUM(f.value) AS disconnections_for_debt FROM core_fact_consumer_disconnections f JOIN core_dim_date d ON d.date_id = f.date_id
 WHERE f.metric_name = 'disconnections_for_debt' AND f.supplier_id IS NOT NULL AND d.year {_BETWEEN} GROUP BY 1, 2)
SELECT y.year, y.supplier_id, s.supplier_name, y.disconnections_for_debt FROM y JOIN core_dim_supplier s ON s.supplier_id = y.supplier_id
WHERE y.supplier_id IN (SELECT supplier_id FROM y GROUP BY 1 ORDER BY SUM(disconnections_for_debt) DESC, 1 LIMIT 15)
""",
)
def disconnections(t):
    return reads.disconnections(t, FIRST, LAST)


@query("read_competition", "Q39", f"SELECT * FROM ({M.COMPETITION}) WHERE year {_BETWEEN} AND lower(commodity) = 'electricity'", d9=[*M._AVERAGED, "active_suppliers", "continuing_active"])
def competition(t):
    return reads.competition(marts.competition(t), FIRST, LAST, "electricity")


@query("read_affordability", "Q39 F08", f"SELECT * FROM ({M.AFFORDABILITY}) WHERE year {_BETWEEN} AND (payment_method = 'direct_debit' OR payment_method IS NULL)", d11=["value"])
def affordability(t):
    return reads.affordability(marts.affordability(t), FIRST, LAST, "direct_debit")


@query(
    "read_incidents", "Q39 R30", f"""
SELECT year, supplier_id, supplier_name, supplier_group, supplier_size, {M.picks('MAX', reads.INCIDENT_METRICS)} FROM ({M.COMPLAINTS}) WHERE year {_BETWEEN} AND metric_name LIKE '%incidents%' AND supplier_id IS NOT NULL GROUP BY 1, 2, 3, 4, 5
""",
)
def incidents(t):
    return reads.incidents(marts.complaints(t), FIRST, LAST)


@query(
    "read_complaints_satisfaction", "Q39", f"""
SELECT 'c' AS source, year, quarter, supplier_name, metric_name, value FROM ({M.COMPLAINTS}) WHERE year {_BETWEEN} UNION ALL
SELECT 's', year, quarter, supplier_name, metric_name, value FROM ({M.SATISFACTION}) WHERE year {_BETWEEN}
""",
)
def complaints_satisfaction(t):
    shape = [("source", "string"), ("year", "int"), ("quarter", "int"), ("supplier_name", "string"), ("metric_name", "string"), ("value", "double")]
    return union_all([
        conform(reads.complaints(marts.complaints(t), FIRST, LAST), shape, source="c"),
        conform(reads.satisfaction(marts.satisfaction(t), FIRST, LAST), shape, source="s"),
    ])


@query(
    "read_schemes", "Q41 A01 F03", """
SELECT 'scheme' AS kind, scheme_key AS name, COUNT(*) AS n FROM core_fact_scheme_metric WHERE calendar_year IS NULL OR calendar_year BETWEEN 2024 AND 2024 GROUP BY 2
UNION ALL SELECT 'metric', metric_name, COUNT(*) FROM core_fact_scheme_metric WHERE (calendar_year IS NULL OR calendar_year BETWEEN 2024 AND 2024) AND scheme_key = 'eco' GROUP BY 2
""",
)
def schemes(t):
    mart = marts.scheme_metric(t)
    keys = reads.scheme_keys(mart, 2024, 2024).select(F.lit("scheme").alias("kind"), F.col("scheme_key").alias("name"), "n")
    names = reads.scheme_metric_names(mart, 2024, 2024, "eco").select(F.lit("metric").alias("kind"), F.col("metric_name").alias("name"), "n")
    return keys.unionByName(names)


@query(
    "read_scheme_rows", "Q41 T04 T01", """
SELECT * FROM core_fact_scheme_metric WHERE (calendar_year IS NULL OR calendar_year BETWEEN 2024 AND 2024) AND scheme_key = 'eco' AND metric_name = 'purchase'
ORDER BY calendar_year NULLS LAST, scheme_key, metric_name, period_date NULLS LAST, period_label, entity, source_file LIMIT 500
""",
)
def scheme_rows(t):
    return reads.scheme_rows(marts.scheme_metric(t), 2024, 2024, "eco", "purchase", 500)


@query(
    "read_scheme_rows_all", "Q41", """
SELECT * FROM core_fact_scheme_metric WHERE calendar_year IS NULL OR calendar_year BETWEEN 2023 AND 2024
""",
)
def scheme_rows_all(t):
    return reads.scheme_rows(marts.scheme_metric(t), 2023, 2024)


@query(
    "read_discount", "Q42 Q40", f"""
WITH d AS ({M.DISCOUNT}) SELECT grain, scheme_year, calendar_year, nation, supplier_name, expenditure_pct, obligation_amount_mgbp FROM d WHERE grain = 'national' OR calendar_year {_BETWEEN}
""", d9=["expenditure_pct", "obligation_amount_mgbp"],
)
def discount(t):
    mart = marts.discount_scheme(t)
    shape = [("grain", "string"), ("scheme_year", "int"), ("calendar_year", "int"), ("nation", "string"), ("supplier_name", "string"), ("expenditure_pct", "double"), ("obligation_amount_mgbp", "double")]
    # No national row lies in 2010-2020, so all of them come back.
    return union_all([conform(reads.discount_national(mart, 2010, 2020), shape, grain="national"), conform(reads.discount_suppliers(mart, FIRST, LAST), shape, grain="supplier")])


@query(
    "read_network_summary", "Q43 A22 C39", f"""
WITH y AS (SELECT year, SUM(ens_mwh) AS e, SUM(actual_totex_million_gbp) AS t FROM ({M.COST_RELIABILITY}) WHERE year {_BETWEEN} GROUP BY 1)
SELECT arg_max(e, year) AS ens_latest, (arg_max(e, year) - arg_min(e, year)) / abs(arg_min(e, year)) * 100 AS ens_change_pct, arg_max(t, year) AS totex_latest, (arg_max(t, year) - arg_min(t, year)) / abs(arg_min(t, year)) * 100 AS totex_change_pct FROM y
""", d6=["ens_change_pct", "totex_latest", "totex_change_pct"],
)
def network_summary(t):
    return reads.network_summary(marts.cost_reliability(M.with_schemes(t)), FIRST, LAST)


@query(
    "read_summary_packs", "Q43 J21", f"""
WITH h AS (SELECT year, MAX(active_suppliers_avg) AS a, SUM(profit_million_gbp) AS p, MAX(hhi) AS i FROM ({M.SUPPLIER_HEALTH}) WHERE year {_BETWEEN} GROUP BY 1),
 c AS (SELECT * FROM ({M.COST_TO_CONSUMER}) WHERE year {_BETWEEN}), v AS (SELECT COUNT(*) AS n FROM ({M.VOLATILITY_COMPLAINTS}) WHERE year {_BETWEEN}),
 d AS (SELECT COUNT(*) FILTER (WHERE calendar_year {_BETWEEN}) AS inside, COUNT(*) AS n, COUNT(DISTINCT nation) FILTER (WHERE calendar_year {_BETWEEN}) AS nations FROM ({M.DISCOUNT}) WHERE grain = 'national')
SELECT (SELECT arg_max(a, year) FROM h) AS active_suppliers_latest, (SELECT (arg_max(a, year) - arg_min(a, year)) / abs(arg_min(a, year)) * 100 FROM h) AS active_suppliers_change_pct, (SELECT arg_max(p, year) FROM h) AS profit_latest,
 (SELECT arg_max(i, year) FROM h) AS hhi_latest, (SELECT arg_max(network_gbp, year) / arg_max(total_cap_gbp, year) * 100 FROM c) AS network_share_pct, (SELECT COUNT(*) FROM c) AS cost_rows, v.n AS volatility_rows,
 d.inside AS rows_in_range, d.n AS rows_total, d.nations AS nations_in_range FROM v, d
""", d6=["active_suppliers_latest", "active_suppliers_change_pct", "profit_latest", "hhi_latest", "network_share_pct"],
)
def summary_packs(t):
    return reads.headline([
        reads.retail_summary(marts.supplier_health(t), FIRST, LAST),
        reads.cross_summary(marts.cost_to_consumer(t), marts.volatility_complaints(t), FIRST, LAST),
        reads.social_summary(marts.discount_scheme(t), FIRST, LAST),
    ])


@query(
    "read_macro_summary", "Q43 A22", f"""
WITH e AS (SELECT year, SUM(energy_twh) AS v FROM stat_rows WHERE year {_BETWEEN} GROUP BY 1), g AS (SELECT year, SUM(cumulative_capacity_kw) / 1000000 AS v FROM ({M.DEPLOYMENT}) WHERE grain = 'annual_gb' AND year {_BETWEEN} GROUP BY 1)
SELECT (SELECT arg_max(v, year) FROM e) AS energy_ratio_latest, (SELECT (arg_max(v, year) - arg_min(v, year)) / abs(arg_min(v, year)) * 100 FROM e) AS energy_ratio_change_pct,
 (SELECT arg_max(v, year) FROM g) AS capacity_gw_latest, (SELECT (arg_max(v, year) - arg_min(v, year)) / abs(arg_min(v, year)) * 100 FROM g) AS capacity_gw_change_pct
""", d6=["energy_ratio_latest", "energy_ratio_change_pct", "capacity_gw_latest", "capacity_gw_change_pct"],
)
def macro_summary(t):
    primary = t["stat_rows"].groupBy("year").agg(F.sum("energy_twh").alias("energy_ratio"))
    return reads.macro_summary(primary, marts.renewables_deployment(t), FIRST, LAST)


@query(
    "read_household_latest", "Q43", f"""
SELECT arg_max(value_pct, (year, segment)) AS household_energy_spend_pct_latest FROM ({M.AFFORDABILITY}) WHERE layer = 'household_spend' AND year {_BETWEEN} AND segment = 'FURNITURE'
""",
)
def household_latest(t):
    mart = marts.affordability(t).filter("layer <> 'household_spend' or segment = 'FURNITURE'")
    return reads.household_spend_latest(mart, FIRST, LAST)
