"""Analytic post-processing, statistics, models, data quality and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import marts as M
from catalog.bound import with_sold_lines
from catalog.engine import query
from catalog.reads import FIRST, LAST, _BETWEEN
from metricmart.operators import model, quality, stats
from metricmart.operators.conform import union_all
from metricmart.plans import analytics, marts, reads

_FIT = """COUNT(*) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept, corr({y}, {x}) AS r, corr({y}, {x}) * corr({y}, {x}) AS r2,
 corr({y}, {x}) * sqrt((COUNT(*) - 2) / NULLIF(GREATEST(1 - corr({y}, {x}) * corr({y}, {x}), 0), 0)) AS t_stat"""
_FITTED = ["slope", "intercept", "r", "r2", "t_stat"]


@query(
    "ols_fit", "P02 A19", f"""
SELECT l_returnflag, {_FIT.format(x='l_quantity', y='l_extendedprice')} FROM lineitem GROUP BY 1
""", d4=["slope", "intercept"], d6=["r", "r2", "t_stat"],
)
def ols_fit(t):
    return stats.simple_fit(t["lineitem"], "l_quantity", "l_extendedprice", ["l_returnflag"])


# Two-sided tail of Student's t as a regularised incomplete beta function, by its continued fraction; one recursion step
# is one pair of its terms. LGAMMA is the engine's own.
@query(
    "ols_p_values", "P02 P03", """
WITH RECURSIVE fits AS (
 SELECT l_returnflag, COUNT(*) AS n, regr_slope(l_tax, l_discount) AS slope, regr_intercept(l_tax, l_discount) AS intercept, corr(l_tax, l_discount) AS r FROM lineitem GROUP BY 1),
tested AS (SELECT *, r * r AS r2, r * sqrt((n - 2) / (1 - r * r)) AS t_stat FROM fits),
shaped AS (SELECT *, (n - 2) / 2.0::DOUBLE AS nu, (n - 2) / (n - 2 + t_stat * t_stat) AS x FROM tested),
sided AS (SELECT *, x < (nu + 1) / (nu + 2.5) AS direct, CASE WHEN x < (nu + 1) / (nu + 2.5) THEN nu ELSE 0.5 END AS a,
 CASE WHEN x < (nu + 1) / (nu + 2.5) THEN 0.5 ELSE nu END AS b, CASE WHEN x < (nu + 1) / (nu + 2.5) THEN x ELSE 1 - x END AS y FROM shaped),
steps AS (
 SELECT l_returnflag, a, b, y, 0 AS m, 1.0::DOUBLE AS c, 1 / (1 - (a + b) * y / (a + 1)) AS d, 1 / (1 - (a + b) * y / (a + 1)) AS h FROM sided
 UNION ALL
 SELECT l_returnflag, a, b, y, m, 1 + odd / c1, 1 / (1 + odd * d1), h * d1 * c1 * (1 / (1 + odd * d1)) * (1 + odd / c1) FROM (
  SELECT *, 1 / (1 + even * d) AS d1, 1 + even / c AS c1, -(a + m) * (a + b + m) * y / ((a + 2 * m) * (a + 2 * m + 1)) AS odd FROM (
   SELECT l_returnflag, a, b, y, m + 1 AS m, c, d, h, (m + 1) * (b - (m + 1)) * y / ((a + 2 * (m + 1) - 1) * (a + 2 * (m + 1))) AS even FROM steps WHERE m < 100))),
tails AS (SELECT s.*, exp(lgamma(nu + 0.5) - lgamma(nu) - lgamma(0.5) + nu * ln(x) + 0.5 * ln(1 - x)) * h / s.a AS part FROM sided s JOIN steps USING (l_returnflag) WHERE m = 100)
SELECT l_returnflag, n, slope, intercept, r, r2, t_stat, CASE WHEN direct THEN part ELSE 1 - part END AS p_value FROM tails
""", d6=["slope", "intercept", "r", "r2", "t_stat", "p_value"],
)
def ols_p_values(t):
    return stats.with_p_values(stats.simple_fit(t["lineitem"], "l_discount", "l_tax", ["l_returnflag"]))


@query(
    "pearson", "P03 A19", """
SELECT corr(l_quantity, l_discount) AS pearson_r, COUNT(*) AS pair_count, corr(l_quantity, l_discount) * sqrt((COUNT(*) - 2) / (1 - corr(l_quantity, l_discount) * corr(l_quantity, l_discount))) AS t_stat FROM lineitem
""", d8=["pearson_r"], d6=["t_stat"],
)
def pearson(t):
    return stats.pearson(t["lineitem"], "l_quantity", "l_discount")


@query(
    "corr_pairs", "A19 M22", """
WITH a AS (SELECT year, company_name, AVG(quantity) AS x FROM line_metrics WHERE network_sector = 'ET' AND flag = 'A' GROUP BY 1, 2), b AS (SELECT year, company_name, MAX(discount) AS y FROM line_metrics WHERE network_sector = 'ET' AND flag = 'R' GROUP BY 1, 2)
SELECT corr(x, y) AS pearson_corr, COUNT(*) AS pair_count FROM a JOIN b USING (year, company_name)
""", d8=["pearson_corr"],
)
def corr_pairs(t):
    rows = t["line_metrics"]
    up = rows.filter("flag = 'A'").select("year", "company_name", "network_sector", F.lit("network_availability_pct").alias("metric_name"), F.col("quantity").alias("value"))
    happy = rows.filter("flag = 'R'").select("year", "company_name", "network_sector", F.lit("customer_survey_score").alias("metric_name"), F.col("discount").alias("value"))
    return marts.availability_satisfaction(up, happy, "ET")


@query(
    "trend_forecast", "P07", """
WITH f AS (SELECT nation, regr_slope(COALESCE(spend, 0), year) AS slope, regr_intercept(COALESCE(spend, 0), year) AS intercept FROM order_year GROUP BY 1 HAVING COUNT(*) >= 3)
SELECT nation, CAST(y.year AS INT) AS year, slope, intercept, intercept + slope * y.year AS forecast FROM f, (VALUES (2002), (2003), (2004)) y(year)
""", d4=["slope"], d2=["forecast"], d0=["intercept"],
)
def trend_forecast(t):
    return stats.trend_forecast(t["order_year"], ["nation"], "year", "spend", 2001)


@query(
    "what_if_shock", "P08", """
SELECT company_name, SUM(price) AS baseline, SUM(price) * 1.1::DOUBLE AS shocked FROM line_metrics GROUP BY 1
""", d4=["baseline", "shocked"],
)
def what_if_shock(t):
    return stats.shock(t["line_metrics"], ["company_name"], "price", 10)


@query(
    "threshold_alerts", "P01", """
SELECT 'availability_below_guide' AS alert, AVG(l_quantity) AS observed, 99.0::DOUBLE AS threshold, AVG(l_quantity) < 99 AS fires FROM lineitem UNION ALL
SELECT 'loss_above_100_gwh', MAX(l_extendedprice), 100000, MAX(l_extendedprice) > 100000 FROM lineitem
""", d4=["observed"],
)
def threshold_alerts(t):
    up = t["lineitem"].select(F.lit("network_availability_pct").alias("metric_name"), F.col("l_quantity").alias("value"))
    return analytics.threshold_alerts(up, t["lineitem"].select(F.col("l_extendedprice").alias("ens_mwh")))


@query(
    "paired_series", "P04 P02", f"""
WITH c AS (SELECT period_date, AVG(value) AS churn FROM raw_market WHERE instrument = 'churn' OR metric_name LIKE '%churn%' GROUP BY 1), v AS (SELECT period_date, AVG(value) AS volatility FROM raw_market WHERE metric_name = 'volatility_electricity_baseload' GROUP BY 1)
SELECT c.period_date, churn, volatility FROM c JOIN v ON v.period_date = c.period_date
""", d6=["churn", "volatility"],
)
def paired_series(t):
    rows = t["raw_market"]
    churn = rows.filter("instrument = 'churn' or metric_name like '%churn%'")
    return analytics.churn_against_volatility(churn, rows)


@query(
    "ratio_against_cost", "P04 C35", f"""
WITH p AS (SELECT year, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_et_gbp') AS elec_tx_avg_gbp, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_ed_gbp') AS elec_dx_avg_gbp,
       AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_gt_gbp') AS gas_tx_avg_gbp, AVG(value) FILTER (WHERE metric_name = 'cost_per_customer_gd_gbp') AS gas_dx_avg_gbp FROM raw_costs WHERE year {_BETWEEN} GROUP BY 1)
SELECT p.year, e.energy_ratio, elec_tx_avg_gbp, elec_dx_avg_gbp, gas_tx_avg_gbp, gas_dx_avg_gbp, (elec_tx_avg_gbp + elec_dx_avg_gbp + gas_dx_avg_gbp) / 3 AS avg_network_gbp FROM p JOIN (SELECT year, SUM(energy_twh) AS energy_ratio FROM stat_rows GROUP BY 1) e ON e.year = p.year
""", d6=["energy_ratio", "elec_tx_avg_gbp", "elec_dx_avg_gbp", "gas_dx_avg_gbp", "avg_network_gbp"],
)
def ratio_against_cost(t):
    primary = t["stat_rows"].groupBy("year").agg(F.sum("energy_twh").alias("energy_ratio"))
    return analytics.ratio_against_cost(primary, reads.network_cost_proxy(t["raw_costs"], FIRST, LAST))


@query(
    "input_share_coverage", "P06 A15", f"""
SELECT year, COUNT(*) AS rows, COUNT(intermediate_consumption_share) AS rows_with_value, AVG(intermediate_consumption_share) AS avg_value, 100.0 * COUNT(intermediate_consumption_share) / COUNT(*) AS coverage_pct FROM ({M.ECONOMIC_IMPACT}) GROUP BY 1
""", d8=["avg_value", "coverage_pct"],
)
def input_share_coverage(t):
    return analytics.input_share_coverage(marts.economic_impact(with_sold_lines(t)))


@query(
    "regulatory_underperformers", "P05 W12 T02", f"""
WITH m AS (SELECT company_name, AVG(rore_pct) AS rore, AVG(satisfaction_score) AS sat FROM ({M.REGULATORY}) WHERE year {_BETWEEN} GROUP BY 1),
 l AS (SELECT c.company_name, AVG(f.ens_mwh) AS ens FROM core_fact_network_reliability f JOIN core_dim_company c ON c.company_id = f.company_id JOIN core_dim_date d ON d.date_id = f.date_id WHERE f.network_sector_id = 1 AND d.year {_BETWEEN} GROUP BY 1),
 j AS (SELECT m.company_name, rore, ens, sat FROM m LEFT JOIN l ON l.company_name = m.company_name),
 g AS (SELECT company_name, COALESCE(rore, (SELECT quantile_cont(rore, 0.5) FROM j)) AS rore, COALESCE(ens, (SELECT quantile_cont(ens, 0.5) FROM j)) AS ens, COALESCE(sat, (SELECT quantile_cont(sat, 0.5) FROM j)) AS sat FROM j)
SELECT company_name, rore, ens, sat, (rore - (SELECT AVG(rore) FROM g)) / (SELECT STDDEV_POP(rore) FROM g) + (ens - (SELECT AVG(ens) FROM g)) / (SELECT STDDEV_POP(ens) FROM g) - (sat - (SELECT AVG(sat) FROM g)) / (SELECT STDDEV_POP(sat) FROM g) AS bad
FROM g ORDER BY bad DESC LIMIT 3
""", d6=["rore", "ens", "sat", "bad"],
)
def regulatory_underperformers(t):
    rows = reads.regulatory(marts.regulatory_performance(t), FIRST, LAST)
    return analytics.underperformers(rows, reads.return_and_loss(t, FIRST, LAST))


@query(
    "spread_and_margin_fits", "P19 P02", f"""
SELECT 'spread' AS fit, COUNT(*) AS n, regr_slope(complaints_received_per_100k_avg, spark_spread_avg) AS slope FROM ({M.VOLATILITY_COMPLAINTS}) WHERE complaints_received_per_100k_avg IS NOT NULL AND spark_spread_avg IS NOT NULL
UNION ALL SELECT 'margin', COUNT(*), regr_slope(satisfaction_pct_avg, pretax_domestic_margin_pct) FROM ({M.SUPPLIER_QUALITY}) WHERE satisfaction_pct_avg IS NOT NULL AND pretax_domestic_margin_pct IS NOT NULL
""", d6=["slope"],
)
def spread_and_margin_fits(t):
    a = analytics.spread_complaints_fit(marts.volatility_complaints(t))
    b = analytics.margin_satisfaction_fit(marts.supplier_quality(t))
    return union_all([df.select(F.lit(n).alias("fit"), "n", "slope") for n, df in (("spread", a), ("margin", b))])


@query(
    "changes_present", "P19", f"""
SELECT year, wholesale_yoy_change, network_yoy_change, policy_yoy_change, total_yoy_change FROM ({M.COST_TO_CONSUMER}) WHERE COALESCE(wholesale_yoy_change, network_yoy_change, policy_yoy_change, total_yoy_change) IS NOT NULL
""", d6=["wholesale_yoy_change", "network_yoy_change", "policy_yoy_change", "total_yoy_change"],
)
def changes_present(t):
    return analytics.changes_present(marts.cost_to_consumer(t))


@query(
    "undergrounding_pairs", "P10 J20", """
SELECT a.company_name, a.year, a.value, b.minutes_lost FROM (SELECT company_name, year, SUM(value) AS value FROM raw_connections GROUP BY 1, 2) a JOIN stg_minutes b ON b.company_name = a.company_name AND b.year = a.year + 1
""",
)
def undergrounding_pairs(t):
    return analytics.undergrounding_pairs(t["raw_connections"], t["stg_minutes"])


@query(
    "connection_spend_pairs", "P10 J20", f"""
WITH c AS (SELECT company_name, year, SUM(value) FILTER (WHERE metric_name ILIKE '%connection%') AS connections_activity FROM raw_connections WHERE year {_BETWEEN} AND lower(network_sector) LIKE '%transmission%' GROUP BY 1, 2)
SELECT c.company_name, c.year, c.connections_activity, f.actual_totex_million_gbp FROM c JOIN core_dim_company m ON m.company_name = c.company_name
JOIN core_fact_financial_performance f ON f.company_id = m.company_id AND f.date_id = (c.year - 1) * 10 + 1 WHERE f.network_sector_id IN (1, 3)
""",
)
def connection_spend_pairs(t):
    return analytics.connection_spend_pairs(reads.connections_activity(t["raw_connections"], FIRST, LAST), reads.transmission_spend(t, FIRST, LAST))


@query(
    "risk_against_loss", "P11 J22 P03", """
WITH r AS (SELECT company_name, AVG(v) AS risk_metric FROM (SELECT company_name, year, AVG(value) AS v FROM raw_connections GROUP BY 1, 2) GROUP BY 1)
SELECT r.company_name, m.year, r.risk_metric, m.gas_lost_volume FROM r JOIN stg_minutes m ON m.company_name = r.company_name
QUALIFY row_number() OVER (PARTITION BY m.company_name ORDER BY m.year DESC) = 1
""", d8=["risk_metric"],
)
def risk_against_loss(t):
    # Risk years a century on meet no loss year, so every company's mean risk is paired with its latest loss.
    risk = t["raw_connections"].withColumn("year", F.col("year") + 100)
    return analytics.risk_against_loss(risk, t["stg_minutes"])


@query(
    "implied_intensity", "P12 A16", """
SELECT period_date, SUM(value * CASE instrument WHEN 'wind' THEN 11 WHEN 'coal' THEN 850 ELSE 300 END) / SUM(value) AS kg_co2_per_mwh FROM raw_market
WHERE metric_name = 'generation_share_twh' AND year BETWEEN 1996 AND 2000 AND instrument <> 'TOTAL' GROUP BY 1
""", d6=["kg_co2_per_mwh"],
)
def implied_intensity(t):
    mix = reads.generation_mix(t["raw_market"], FIRST, LAST)
    return analytics.implied_intensity(mix.filter("fuel_source is not null"))


@query(
    "sized_points", "P13", """
SELECT s_suppkey, 10 + 40 * (GREATEST(s_acctbal, 0) / (SELECT MAX(s_acctbal) FROM supplier)) AS marker_size FROM supplier
""", d9=["marker_size"],
)
def sized_points(t):
    rows = t["supplier"].select("s_suppkey", F.greatest("s_acctbal", F.lit(0.0)).alias("v"))
    return analytics.sized_points(rows, "v").select("s_suppkey", "marker_size")


@query(
    "period_back_fill", "P15", """
SELECT year, quarter, technology, COALESCE(period_date, make_date(year, quarter * 3, 1)) AS period FROM raw_renewables WHERE quarter IS NOT NULL
""",
)
def period_back_fill(t):
    rows = t["raw_renewables"].filter("quarter is not null")
    return analytics.with_period(rows).select("year", "quarter", "technology", "period")


@query(
    "snapshot_with_values", "P14 J19", """
SELECT nation, year, spend FROM order_year WHERE year = (SELECT MAX(year) FROM order_year) AND spend IS NOT NULL
""",
)
def snapshot_with_values(t):
    return analytics.latest_snapshot(t["order_year"].select("nation", "year", "spend"), ["spend"])


@query(
    "operator_means", "P16 J25", """
WITH canon AS (SELECT k, arg_min(company_name, (s, company_name)) AS c FROM (SELECT lower(trim(source_company_name)) AS k, company_name, 2 AS s FROM alias_rows UNION ALL SELECT lower(trim(company_name)), company_name, 4 FROM alias_rows) GROUP BY k),
 a AS (SELECT COALESCE(c.c, f.company_name) AS operator_key, AVG(f.value) AS fuel_poor_avg FROM raw_fuel_poor f LEFT JOIN canon c ON c.k = lower(f.company_name) GROUP BY 1),
 b AS (SELECT COALESCE(c.c, f.company_name) AS operator_key, AVG(f.minutes_lost) AS minutes_lost_avg FROM stg_minutes f LEFT JOIN canon c ON c.k = lower(f.company_name) GROUP BY 1)
SELECT a.operator_key, fuel_poor_avg, minutes_lost_avg FROM a JOIN b USING (operator_key)
""", d6=["fuel_poor_avg", "minutes_lost_avg"],
)
def operator_means(t):
    return analytics.operator_means(t["raw_fuel_poor"], t["stg_minutes"], t["alias_rows"])


@query(
    "strongest_series", "P09 T03 C36 R30", """
WITH d AS (SELECT period_year, trim(row_label) || ' | ' || column_label AS series, value FROM stg_digest WHERE period_year IS NOT NULL AND dukes_table = '6.2'), top AS (SELECT series FROM d GROUP BY 1 ORDER BY AVG(abs(value)) DESC, 1 LIMIT 3)
SELECT period_year, MAX(CASE WHEN r = 1 THEN v END) AS a, MAX(CASE WHEN r = 2 THEN v END) AS b, MAX(CASE WHEN r = 3 THEN v END) AS c FROM (
 SELECT period_year, series, MIN(value) AS v, dense_rank() OVER (ORDER BY series) AS r FROM d WHERE series IN (SELECT series FROM top) GROUP BY 1, 2) GROUP BY 1
""",
)
def strongest_series(t):
    wide = analytics.strongest_series(t["stg_digest"].filter("dukes_table = '6.2'"), 3)
    return wide.toDF("period_year", "a", "b", "c")


@query(
    "strongest_series_long_labels", "P09 C36", """
WITH d AS (SELECT period_year, repeat('long label ', 30) || row_label AS series, value FROM stg_digest WHERE period_year IS NOT NULL AND dukes_table = '6.2'), top AS (SELECT series FROM d GROUP BY 1 ORDER BY AVG(abs(value)) DESC, 1 LIMIT 3)
SELECT period_year, MAX(CASE WHEN r = 1 THEN v END) AS a, MAX(CASE WHEN r = 2 THEN v END) AS b, MAX(CASE WHEN r = 3 THEN v END) AS c FROM (
 SELECT period_year, series, MIN(value) AS v, dense_rank() OVER (ORDER BY series) AS r FROM d WHERE series IN (SELECT series FROM top) GROUP BY 1, 2) GROUP BY 1
""",
)
def strongest_series_long_labels(t):
    """Labels that only differ beyond 300 characters stay series of their own."""
    digest = t["stg_digest"].filter("dukes_table = '6.2'")
    labelled = digest.withColumns({"row_label": F.concat(F.repeat(F.lit("long label "), 30), "row_label"), "column_label": F.lit(None).cast("string")})
    return analytics.strongest_series(labelled, 3).toDF("period_year", "a", "b", "c")


@query(
    "scheme_series", "P17 R30", """
SELECT calendar_year, entity, MIN(value) AS value FROM core_fact_scheme_metric WHERE calendar_year IS NOT NULL AND scheme_key = 'eco' AND entity IS NOT NULL GROUP BY 1, 2
""",
)
def scheme_series(t):
    return analytics.scheme_series(t["core_fact_scheme_metric"].filter("scheme_key = 'eco'"))


@query(
    "scheme_mean_series", "P17", """
SELECT calendar_year, '_all' AS entity, AVG(value) AS value FROM core_fact_scheme_metric WHERE calendar_year IS NOT NULL AND scheme_key = 'bus' GROUP BY 1
""", d8=["value"],
)
def scheme_mean_series(t):
    return analytics.scheme_series(t["core_fact_scheme_metric"].filter("scheme_key = 'bus'"))


@query(
    "redistribution", "P18 T01", f"""
SELECT supplier_name, SUM(redistributed_mgbp) AS redistributed_mgbp FROM ({M.DISCOUNT}) WHERE grain = 'supplier' AND redistributed_mgbp IS NOT NULL GROUP BY 1
""", d6=["redistributed_mgbp"],
)
def redistribution(t):
    return analytics.redistribution(marts.discount_scheme(t).filter("grain = 'supplier'"))


@query(
    "obligation_matrix", "P18 R30", f"""
SELECT supplier_name, SUM(obligation_amount_mgbp) FILTER (WHERE obligation_method = 'FURNITURE') AS "FURNITURE", SUM(obligation_amount_mgbp) FILTER (WHERE obligation_method = 'HOUSEHOLD') AS "HOUSEHOLD"
FROM ({M.DISCOUNT}) WHERE grain = 'supplier' AND obligation_amount_mgbp IS NOT NULL AND obligation_method IS NOT NULL GROUP BY 1
""", d6=["FURNITURE", "HOUSEHOLD"],
)
def obligation_matrix(t):
    return analytics.obligation_matrix(marts.discount_scheme(t).filter("grain = 'supplier'"))


@query(
    "indicators_of_year", "P20 C36 J19", """
SELECT reference_year, row_no, row_code, energy_tj, row_code || ' — ' || row_label AS label FROM flow_rows WHERE table_id = 'D' AND industry_code = 'A_U' AND reference_year = (SELECT MAX(reference_year) FROM flow_rows WHERE table_id = 'D')
""",
)
def indicators_of_year(t):
    rows = reads.flow_rows(t["flow_rows"], "D", 1990, 2010)
    return analytics.indicators_of_year(rows).select("reference_year", "row_no", "row_code", "energy_tj", "label")


@query(
    "metrics_by_period", "P21 R30", f"""
SELECT period_start_date, AVG(value) FILTER (WHERE metric_name = 'nps_score') AS nps_score, AVG(value) FILTER (WHERE metric_name = 'satisfaction_overall_pct') AS satisfaction_overall_pct, AVG(value) FILTER (WHERE metric_name = 'satisfaction_pct') AS satisfaction_pct,
 AVG(value) FILTER (WHERE metric_name = 'other_A') AS "other_A", AVG(value) FILTER (WHERE metric_name = 'other_N') AS "other_N", AVG(value) FILTER (WHERE metric_name = 'other_R') AS "other_R"
FROM ({M.SATISFACTION}) GROUP BY 1
""", d8=["nps_score", "satisfaction_overall_pct", "satisfaction_pct", "other_A", "other_N", "other_R"],
)
def metrics_by_period(t):
    return analytics.metrics_by_period(marts.satisfaction(t))


@query("promoter_scores", "P21 F01", f"SELECT supplier_name, value FROM ({M.SATISFACTION}) WHERE metric_name = 'nps_score' AND supplier_name IS NOT NULL")
def promoter_scores(t):
    return analytics.promoter_scores(marts.satisfaction(t))


# --- statistics and models ----------------------------------------------------------------------------------------

_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "missing_counts", "K01", """
SELECT 'l_orderkey' AS column_name, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS missing FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey UNION ALL SELECT 'o_orderkey', 0
""",
)
def missing_counts(t):
    rows = t["orders"].select("o_orderkey").join(t["lineitem"].select("l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return stats.missing_counts(rows)


@query(
    "describe_columns", "K01", " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n, AVG({c}) AS mean, STDDEV({c}) AS sd, MIN({c}) AS low, MAX({c}) AS high, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 FROM lineitem"
        for c in _NUMBERS), d4=["mean", "sd", "q25", "q50", "q75"],
)
def describe_columns(t):
    return stats.describe(t["lineitem"], _NUMBERS)


@query(
    "histogram", "K02", """
WITH b AS (SELECT MIN(o_totalprice) AS low, (MAX(o_totalprice) - MIN(o_totalprice)) / 15 AS w FROM orders)
SELECT CAST(i.bin AS INT) AS bin, b.low + b.w * (i.bin - 1) AS bin_low, b.low + b.w * i.bin AS bin_high, (SELECT COUNT(*) FROM orders, b WHERE LEAST(floor((o_totalprice - b.low) / b.w) + 1, 15) = i.bin) AS n FROM range(1, 16) i(bin), b
""", d4=["bin_low", "bin_high"],
)
def histogram(t):
    return stats.histogram(t["orders"], "o_totalprice")


@query(
    "boxplot_stats", "K05", " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, q1, median, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS low_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS high_fence,
 (SELECT COUNT(*) FROM lineitem WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
 FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in ("l_extendedprice", "l_tax")),
    d6=["q1", "median", "q3", "low_fence", "high_fence"],
)
def boxplot_stats(t):
    return stats.box_plot(t["lineitem"], ["l_extendedprice", "l_tax"])


@query(
    "correlation_matrix", "K03", " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {'1.0::DOUBLE' if a == b else f'corr({a}, {b})'} AS r FROM lineitem" for a in _NUMBERS for b in _NUMBERS
    ).replace("1.0::DOUBLE AS r FROM lineitem", "1.0::DOUBLE AS r"), d8=["r"],
)
def correlation_matrix(t):
    return stats.correlation_matrix(t["lineitem"], _NUMBERS)


@query(
    "correlated_groups", "K04", """
SELECT 'a' AS column_name, 'b' AS correlated_with FROM (SELECT corr(l_quantity, l_quantity * 2 + 1) AS r FROM lineitem) WHERE abs(r) >= 0.9 UNION ALL SELECT 'b', 'a' FROM (SELECT corr(l_quantity, l_quantity * 2 + 1) AS r FROM lineitem) WHERE abs(r) >= 0.9
""",
)
def correlated_groups(t):
    rows = t["lineitem"].select(F.col("l_quantity").alias("a"), (F.col("l_quantity") * 2 + 1).alias("b"), F.col("l_discount").alias("c"))
    return stats.correlated_groups(rows, ["a", "b", "c"])


@query(
    "standardise", "K06", """
SELECT p_partkey, (p_size - (SELECT AVG(p_size) FROM part)) / (SELECT STDDEV_POP(p_size) FROM part) AS p_size_std, (p_retailprice - (SELECT AVG(p_retailprice) FROM part)) / (SELECT STDDEV_POP(p_retailprice) FROM part) AS p_retailprice_std FROM part
""", d8=["p_size_std", "p_retailprice_std"],
)
def standardise(t):
    return model.standardise(t["part"], ["p_size", "p_retailprice"]).select("p_partkey", "p_size_std", "p_retailprice_std")


@query(
    "vif", "K07", """
WITH c AS (SELECT corr(l_quantity, l_tax) AS r FROM lineitem) SELECT f.feature, 1 / (1 - c.r * c.r) AS vif FROM c, (VALUES ('l_quantity'), ('l_tax')) f(feature)
""", d8=["vif"],
)
def vif(t):
    return model.variance_inflation(t["lineitem"], ["l_quantity", "l_tax"])


@query(
    "pca_component", "K08", """
WITH s AS (SELECT AVG(s_acctbal) a, STDDEV_POP(s_acctbal) b, AVG(s_nationkey) c, STDDEV_POP(s_nationkey) d, sign(corr(s_acctbal, s_nationkey)) g FROM supplier)
SELECT s_suppkey, ((s_acctbal - a) / b + g * (s_nationkey - c) / d) / sqrt(2) AS component FROM supplier, s
""", d6=["component"],
)
def pca_component(t):
    return model.principal_component(t["supplier"], ["s_acctbal", "s_nationkey"]).select("s_suppkey", "component")


_HASH = "CAST(('0x' || left(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 4)) AS INT)"
_KEYS = ["l_orderkey", "l_linenumber"]


@query(
    "train_test_split", "K09", f"""
SELECT 'test' AS part, COUNT(*) AS n FROM lineitem WHERE {_HASH} < 13107 UNION ALL SELECT 'train', COUNT(*) FROM lineitem WHERE {_HASH} >= 13107
""",
)
def train_test_split(t):
    train, test = model.split(t["lineitem"], _KEYS)
    return union_all([df.agg(F.lit(n).alias("part"), F.count("*").alias("n")) for n, df in (("train", train), ("test", test))])


@query(
    "regression_eval", "K10 K11", f"""
WITH h AS (SELECT *, {_HASH} AS k FROM lineitem), m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM h WHERE k >= 13107),
 e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS d FROM h, m WHERE k < 13107)
SELECT COUNT(*) AS n, AVG(abs(d)) AS mae, AVG(d * d) AS mse, 1 - AVG(d * d) / VAR_POP(y) AS r2 FROM e
""", d2=["mae"], d0=["mse"], d6=["r2"],
)
def regression_eval(t):
    train, test = model.split(t["lineitem"], _KEYS)
    fitted = model.fit(train, ["l_quantity"], "l_extendedprice")
    return model.evaluate(model.predict(fitted, test, ["l_quantity"]), "l_extendedprice")


@query(
    "regression_coefficients", "K10", """
SELECT 'l_quantity' AS feature, regr_slope(l_extendedprice, l_quantity) AS weight FROM lineitem UNION ALL SELECT 'intercept', regr_intercept(l_extendedprice, l_quantity) FROM lineitem
""", d3=["weight"],
)
def regression_coefficients(t):
    fitted = model.fit(t["lineitem"], ["l_quantity"], "l_extendedprice")
    return model.coefficients(fitted, ["l_quantity"], t["lineitem"])


@query(
    "cross_validation", "K12", f"""
WITH h AS (SELECT *, {_HASH} % 5 AS fold FROM lineitem), m AS (SELECT f.fold, regr_slope(h.l_extendedprice, h.l_quantity) AS b, regr_intercept(h.l_extendedprice, h.l_quantity) AS a FROM range(0, 5) f(fold) JOIN h ON h.fold <> f.fold GROUP BY 1)
SELECT CAST(h.fold AS INT) AS fold, COUNT(*) AS n, AVG((l_extendedprice - (a + b * l_quantity)) * (l_extendedprice - (a + b * l_quantity))) AS mse FROM h JOIN m ON m.fold = h.fold GROUP BY 1
""", d0=["mse"],
)
def cross_validation(t):
    return model.cross_validate(t["lineitem"], _KEYS, ["l_quantity"], "l_extendedprice")


# --- data quality --------------------------------------------------------------------------------------------------


@query(
    "quality_checks", "D02 D03 D04 J17 A20", """
SELECT *, COALESCE(100.0 * violations / NULLIF(checked, 0), 0) AS violation_pct, CASE WHEN violations > 0 AND severity = 'hard' THEN 'fail' WHEN violations > 0 AND 100.0 * violations / checked > 10 THEN 'warn' ELSE 'ok' END AS status FROM (
 SELECT 'negative_balance' AS check_name, 'hard' AS severity, COUNT(*) FILTER (WHERE s_acctbal < 0) AS violations, COUNT(*) AS checked FROM supplier
 UNION ALL SELECT 'duplicate_lines', 'soft', COUNT(*) FILTER (WHERE n > 1), CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
 UNION ALL SELECT 'orders_without_lines', 'soft', COUNT(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)), COUNT(*) FROM orders
 UNION ALL SELECT 'unknown_customers', 'hard', 0, COUNT(*) FROM orders)
""", d6=["violation_pct"],
)
def quality_checks(t):
    checks = [
        quality.check_rows("negative_balance", "hard", t["supplier"], F.col("s_acctbal") < 0),
        quality.check_keys("duplicate_lines", "soft", t["lineitem"], ["l_orderkey", "l_linenumber"]),
        quality.check_unmatched("orders_without_lines", "soft", t["orders"], t["lineitem"], {"o_orderkey": "l_orderkey"}),
        quality.check_unmatched("unknown_customers", "hard", t["orders"], t["customer"], {"o_custkey": "c_custkey"}),
    ]
    return quality.report(checks, warn_above_pct=10.0)


@query(
    "negative_counts", "D02", """
SELECT 's_acctbal' AS column_name, COUNT(*) FILTER (WHERE s_acctbal < 0) AS negatives FROM supplier UNION ALL SELECT 's_nationkey', COUNT(*) FILTER (WHERE s_nationkey < 0) FROM supplier
""",
)
def negative_counts(t):
    return quality.negatives(t["supplier"], ["s_acctbal", "s_nationkey", "absent"])


@query(
    "incomplete_keys", "D06", f"""
SELECT COUNT(*) AS bad_rows FROM ({M.VULNERABILITY}) WHERE (year IS NULL OR quarter IS NULL OR commodity IS NULL) AND (avg_debt_no_arrangement_gbp IS NOT NULL OR disconnections_for_debt IS NOT NULL)
""",
)
def incomplete_keys(t):
    return quality.incomplete_keys(marts.consumer_vulnerability(t), ["year", "quarter", "commodity"], ["avg_debt_no_arrangement_gbp", "disconnections_for_debt"])


@query(
    "grain_profile", "D07", f"""
SELECT grain, COUNT(*) AS row_count, COUNT(DISTINCT supplier_name) AS entities, MIN(calendar_year) AS year_min, MAX(calendar_year) AS year_max, COUNT(*) FILTER (WHERE supplier_id IS NULL) AS unresolved_rows FROM ({M.DISCOUNT}) GROUP BY 1
""",
)
def grain_profile(t):
    return quality.grain_profile(marts.discount_scheme(t), "grain", "supplier_name", "calendar_year", "supplier_id")


@query(
    "metric_presence", "D08", f"""
SELECT metric_name, COUNT(*) AS rows FROM ({M.COMPLAINTS}) WHERE metric_name IN ('minor_incidents_historical', 'minor_incidents_current', 'major_incidents_historical', 'major_incidents_current') GROUP BY 1
""",
)
def metric_presence(t):
    return quality.metric_presence(marts.complaints(t), reads.INCIDENT_METRICS)


@query(
    "row_counts", "D09 S16 Q03 T05", """
SELECT 'raw_xlsx' AS layer, 'lineitem' AS table_name, COUNT(*) AS row_count FROM lineitem UNION ALL SELECT 'staging', 'events', COUNT(*) FROM events UNION ALL SELECT 'core', 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'core', 'customer', COUNT(*) FROM customer UNION ALL SELECT 'mart', 'supplier', COUNT(*) FROM supplier
""",
)
def row_counts(t):
    layers = [("mart", "supplier"), ("core", "orders"), ("core", "customer"), ("staging", "events"), ("raw_xlsx", "lineitem")]
    return quality.layer_counts([(layer, name, t[name]) for layer, name in layers])
