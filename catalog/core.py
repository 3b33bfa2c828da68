"""Core loads: staging rows, dimension lookups, means of repeats, upserts into an existing fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bound import with_sold_lines
from catalog.engine import bind, query
from metricmart.operators.conform import union_all
from metricmart.operators.filters import conform
from metricmart.plans import core

import catalog.staging  # noqa: F401 - its bound tables feed these loads

KEYS = ["date_id", "geography_id", "company_id", "network_sector_id", "industry_id", "supplier_id", "payment_method_id", "supplier_size_id"]


def dimensions(t) -> core.Dimensions:
    return core.Dimensions(
        dates=t["core_dim_date"], geographies=t["core_dim_geography"], sectors=t["core_dim_network_sector"],
        companies=t["core_dim_company"], industries=t["core_dim_industry"], suppliers=t["core_dim_supplier"],
        payment_methods=t["core_dim_payment_method"], supplier_sizes=t["core_dim_supplier_size"],
    )


bind("stg_network", """
SELECT year, company_name, sector_code AS network_sector, returned AS ens_mwh, CAST(n_returned AS DOUBLE) AS customer_interruptions, tax AS minutes_lost,
       price AS gas_interruption_volume, qty AS gas_lost_volume FROM supplier_year
UNION ALL SELECT year, 'Nobody', sector_code, 1, 1, 1, 1, 1 FROM supplier_year WHERE suppkey = 1
""")
bind("stg_context", """
SELECT year, 'electricity' AS commodity, 'TOTAL' AS fuel_source, 'generation_total_twh' AS metric_name, CASE WHEN year > 1995 THEN qty END AS value FROM national_year
UNION ALL SELECT year, 'gas', 'TOTAL', 'gas_supply_total', qty FROM national_year
""")
bind("old_network", """
SELECT f.year * 10 + 1 AS date_id, CAST(0 AS BIGINT) AS geography_id, CASE WHEN f.year < 1998 THEN f.suppkey ELSE -f.suppkey END AS company_id, CAST(1 AS BIGINT) AS network_sector_id, CAST(-1 AS DOUBLE) AS ens_mwh, CAST(-1 AS DOUBLE) AS customer_interruptions,
       CAST(-1 AS DOUBLE) AS minutes_lost, CAST(-1 AS DOUBLE) AS gas_interruption_volume, CAST(-1 AS DOUBLE) AS gas_lost_volume, CAST(-1 AS DOUBLE) AS total_demand_mwh, CAST(-1 AS DOUBLE) AS total_gas_supply
FROM supplier_year f
""")


@query(
    "core_network_reliability", "L01 J02 J11 U01", """
WITH s AS (SELECT d.date_id, CAST(0 AS BIGINT) AS geography_id, c.company_id, n.network_sector_id, x.ens_mwh, x.customer_interruptions, x.minutes_lost, x.gas_interruption_volume, x.gas_lost_volume,
  CASE WHEN n.commodity = 'electricity' THEN e.value * 1000000 END AS total_demand_mwh, CASE WHEN n.commodity = 'gas' THEN g.value END AS total_gas_supply
 FROM stg_network x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL JOIN core_dim_company c ON c.company_name = x.company_name
 JOIN core_dim_network_sector n ON n.sector_code = x.network_sector LEFT JOIN stg_context e ON e.year = x.year AND e.commodity = 'electricity' LEFT JOIN stg_context g ON g.year = x.year AND g.commodity = 'gas')
SELECT * FROM s UNION ALL BY NAME SELECT * FROM old_network o WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.date_id = o.date_id AND s.company_id = o.company_id AND s.network_sector_id = o.network_sector_id)
""",
)
def network_reliability(t):
    return core.network_reliability(t["stg_network"], t["stg_context"], dimensions(t), t["old_network"])


@query(
    "core_company_facts", "L02 L04", """
SELECT 'spend' AS fact, d.date_id, c.company_id, n.network_sector_id, x.price AS a, x.revenue AS b, x.tax AS c FROM supplier_year x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL
JOIN core_dim_company c ON c.company_name = x.company_name JOIN core_dim_network_sector n ON n.sector_code = x.sector_code
UNION ALL SELECT 'gases', d.date_id, c.company_id, n.network_sector_id, x.qty, x.returned, NULL FROM supplier_year x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL
JOIN core_dim_company c ON c.company_name = x.company_name JOIN core_dim_network_sector n ON n.sector_code = x.sector_code
""",
)
def company_facts(t):
    base = t["supplier_year"].withColumnRenamed("sector_code", "network_sector")
    spend = core.financial_performance(
        base.withColumnsRenamed({"price": "totex_allowance_million_gbp", "revenue": "actual_totex_million_gbp", "tax": "rore_pct"}), dimensions(t)
    )
    gases = core.emissions(base.withColumnsRenamed({"qty": "sf6_kg", "returned": "carbon_footprint_tco2e"}), dimensions(t))
    shape = [("fact", "string"), ("date_id", "int"), ("company_id", "bigint"), ("network_sector_id", "bigint"), ("a", "double"), ("b", "double"), ("c", "double")]
    return union_all([
        conform(spend.withColumnsRenamed({"totex_allowance_million_gbp": "a", "actual_totex_million_gbp": "b", "rore_pct": "c"}), shape, fact="spend"),
        conform(gases.withColumnsRenamed({"sf6_kg": "a", "carbon_footprint_tco2e": "b"}), shape, fact="gases"),
    ])


# Suppliers from 8,000 on are in no company list; together they are one row for each year, nation and sector.
bind("stg_customers", """
SELECT year, company_name, CASE WHEN s_acctbal < 1000 THEN 'XX' ELSE sector_code END AS network_sector, 'N' || CAST(n_nationkey AS STRING) AS geography_code,
       price AS cost_per_customer_gbp, qty AS satisfaction_score FROM supplier_year WHERE s_acctbal < 8000
UNION ALL SELECT year, 'Nobody', sector_code, 'N' || CAST(n_nationkey AS STRING), MAX(price), MAX(qty) FROM supplier_year WHERE s_acctbal >= 8000 GROUP BY year, sector_code, n_nationkey
""")


@query(
    "core_customer_metrics", "L03 U02 J03", """
SELECT d.date_id, g.geography_id, c.company_id, n.network_sector_id, x.cost_per_customer_gbp, x.satisfaction_score FROM stg_customers x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL
JOIN core_dim_geography g ON g.geography_code = x.geography_code LEFT JOIN core_dim_company c ON c.company_name = x.company_name LEFT JOIN core_dim_network_sector n ON n.sector_code = x.network_sector
""",
)
def customer_metrics(t):
    # Loading twice must give the same rows: keys with NULL parts match themselves.
    once = core.customer_metrics(t["stg_customers"], dimensions(t))
    return core.customer_metrics(t["stg_customers"], dimensions(t), once)


bind("stg_industry", """
SELECT year, CASE p_type WHEN 'STANDARD' THEN 'A' WHEN 'PROMO' THEN 'B' WHEN 'SMALL' THEN 'C' WHEN 'LARGE' THEN 'D' WHEN 'ECONOMY' THEN 'E' ELSE 'F' END AS sic_code, l_returnflag AS commodity, price, qty, filled, n FROM type_year
""")


@query(
    "core_industry_facts", "L05 L06 L07 J02", """
WITH x AS (SELECT year, sic_code, SUM(price) AS price, SUM(filled) AS filled, SUM(qty) AS qty, SUM(n) AS n, 'N' || (year % 25) AS region_code FROM stg_industry GROUP BY year, sic_code),
 y AS (SELECT CASE WHEN year > 1996 THEN sic_code ELSE '-' || sic_code END AS sic_code, year, filled, qty FROM x)
SELECT 'intensity' AS fact, d.date_id, CAST(NULL AS BIGINT) AS geography_id, i.industry_id, NULL AS commodity, x.price AS a, f.filled AS b, f.qty AS c FROM x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL
JOIN core_dim_industry i ON i.sic_code = x.sic_code LEFT JOIN y f ON f.year = x.year AND f.sic_code = x.sic_code
UNION ALL SELECT 'gva', d.date_id, g.geography_id, i.industry_id, NULL, x.price, NULL, NULL FROM x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL JOIN core_dim_industry i ON i.sic_code = x.sic_code
 JOIN core_dim_geography g ON g.geography_code = x.region_code
UNION ALL SELECT 'io', d.date_id, NULL, i.industry_id, s.commodity, s.qty, s.price, NULL FROM stg_industry s JOIN core_dim_date d ON d.year = s.year AND d.quarter IS NULL JOIN core_dim_industry i ON i.sic_code = s.sic_code
""", d4=["a", "b", "c"],
)
def industry_facts(t):
    rows, dims = t["stg_industry"], dimensions(t)
    one = rows.groupBy("year", "sic_code").agg(*[F.sum(c).alias(c) for c in ("price", "filled", "qty", "n")])
    known = F.when(F.col("year") > 1996, F.col("sic_code")).otherwise(F.concat(F.lit("-"), "sic_code"))
    fuel = one.select("year", known.alias("sic_code"), F.col("filled").alias("electricity_pct"), F.col("qty").alias("gas_pct"))
    intensity = core.energy_intensity(
        one.withColumnsRenamed({"price": "kwh_per_gva", "n": "energy_intensity_index"}).select("year", "sic_code", "kwh_per_gva", "energy_intensity_index"), fuel, dims
    )
    gva = core.regional_gva(one.withColumnRenamed("price", "gva_million_gbp").withColumn("region_code", F.concat(F.lit("N"), (F.col("year") % 25).cast("string"))), dims)
    io = core.input_output(rows.withColumnsRenamed({"qty": "intermediate_consumption_share", "price": "intermediate_consumption_value"}), dims)
    shape = [("fact", "string"), ("date_id", "int"), ("geography_id", "bigint"), ("industry_id", "bigint"), ("commodity", "string"), ("a", "double"), ("b", "double"), ("c", "double")]
    return union_all([
        conform(intensity.withColumnsRenamed({"kwh_per_gva": "a", "electricity_pct_of_total_energy": "b", "gas_pct_of_total_energy": "c"}), shape, fact="intensity"),
        conform(gva.withColumnRenamed("gva_million_gbp", "a"), shape, fact="gva"),
        conform(io.withColumnsRenamed({"intermediate_consumption_share": "a", "intermediate_consumption_value": "b"}), shape, fact="io"),
    ])


bind("stg_prices", "SELECT year, commodity, instrument, metric_name, MAX(value) AS avg_value, 'gbp' AS unit FROM price_points GROUP BY year, commodity, instrument, metric_name")
bind("old_prices", """
SELECT year * 10 + 1 AS date_id, CAST(0 AS BIGINT) AS geography_id, year, commodity, instrument, metric_name, CASE WHEN commodity = 'gas' THEN 'Q1' END AS period_label, CAST(-1 AS DOUBLE) AS value, 'old' AS unit
FROM stg_prices
""")


@query(
    "core_market_prices", "L08 U03 U02", """
WITH s AS (SELECT year * 10 + 1 AS date_id, CAST(0 AS BIGINT) AS geography_id, year, commodity, instrument, metric_name, NULL AS period_label, avg_value AS value, unit FROM stg_prices)
SELECT * FROM s UNION ALL BY NAME SELECT * FROM old_prices WHERE period_label IS NOT NULL
""",
)
def market_prices(t):
    return core.market_prices(t["stg_prices"], dimensions(t), t["old_prices"])


@query(
    "core_market_facts", "L09 L10 L11", """
SELECT 'context' AS fact, year, commodity, fuel_source AS name, metric_name, CAST(NULL AS DATE) AS period_date, value FROM core_fact_market_context
UNION ALL SELECT 'share', year, commodity, company_name, NULL, NULL, share_pct FROM core_fact_market_share
UNION ALL SELECT 'daily', NULL, 'power', 'feed', 'level', CAST(o_orderdate AS DATE), MAX(o_totalprice) FROM orders GROUP BY CAST(o_orderdate AS DATE)
""",
)
def market_facts(t):
    t = with_sold_lines(t)
    dims = dimensions(t)
    context = core.market_context(t["core_fact_market_context"], dims, t["core_fact_market_context"].withColumns({"date_id": F.lit(0), "geography_id": F.lit(0).cast("bigint")}))
    share = core.market_share(t["core_fact_market_share"], t["core_fact_market_share"].withColumn("share_pct", F.lit(0.0)))
    day = F.col("o_orderdate").cast("date")
    rows = t["orders"].groupBy(day.alias("period_date"), F.year("o_orderdate").alias("year")).agg(F.max("o_totalprice").alias("value")).withColumns(
        {"commodity": F.lit("power"), "source_name": F.lit("feed"), "metric_name": F.lit("level"), "unit": F.lit("gbp")}
    )
    daily = core.daily_prices(rows, dims)
    shape = [("fact", "string"), ("year", "int"), ("commodity", "string"), ("name", "string"), ("metric_name", "string"), ("period_date", "date"), ("value", "double")]
    return union_all([
        conform(context.withColumnRenamed("fuel_source", "name"), shape, fact="context"),
        conform(share.withColumnsRenamed({"company_name": "name", "share_pct": "value"}), shape, fact="share"),
        conform(daily.withColumnRenamed("source_name", "name"), shape, fact="daily"),
    ])


# Staging rows of the long retail facts, one per key where the load expects that.
bind("stg_retail_rows", """
SELECT q.year, q.quarter, s.s_name AS supplier_name, CASE q.l_linestatus WHEN 'F' THEN 'large' ELSE 'nowhere' END AS supplier_size, CASE q.l_linestatus WHEN 'F' THEN 'gas' END AS commodity,
       CASE q.l_returnflag WHEN 'A' THEN 'direct_debit' WHEN 'N' THEN 'unheard of' END AS payment_method, CASE q.l_returnflag WHEN 'A' THEN 'domestic' WHEN 'N' THEN 'other' END AS segment,
       'c_' || q.l_returnflag AS component, 'g_' || q.l_linestatus AS supplier_group, 't' AS tariff_type, 'a' AS aspect, 'metric_' || q.l_returnflag || q.l_linestatus AS metric_name,
       CAST(q.n AS DOUBLE) AS value, 'u_' || q.l_linestatus AS unit, 'f_' || q.l_returnflag AS source_file
FROM sales_quarter q JOIN supplier s ON s.s_suppkey = q.suppkey
UNION ALL
SELECT y.year, NULL, CASE WHEN y.s_acctbal > 0 THEN y.company_name ELSE 'Nobody' END, NULL, NULL, NULL, 'domestic', 'c', 'g', NULL, NULL, 'annual', y.qty, 'u', 'f' FROM supplier_year y
""")
_DATED = "FROM stg_retail_rows x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NOT DISTINCT FROM x.quarter LEFT JOIN core_dim_supplier s ON s.supplier_name = x.supplier_name LEFT JOIN core_dim_payment_method p ON p.payment_method = x.payment_method LEFT JOIN core_dim_supplier_size z ON z.size_band = x.supplier_size"


@query(
    "core_supplier_financial", "L12 J05 U02", f"""
SELECT d.date_id, s.supplier_id, x.segment, x.metric_name, x.value, x.unit, x.source_file {_DATED} WHERE x.segment IS NOT NULL AND x.quarter IS NOT NULL
""",
)
def supplier_financial(t):
    rows = t["stg_retail_rows"].filter("quarter is not null")
    once = core.retail_fact("supplier_financial", rows, dimensions(t))
    return core.retail_fact("supplier_financial", rows, dimensions(t), once.withColumn("value", F.lit(-1.0)))


@query(
    "core_consumer_debt", "L12 J05 U02", f"""
SELECT 'debt' AS fact, d.date_id, x.commodity, p.payment_method_id, s.supplier_id, x.component, x.metric_name, x.value, x.unit, x.source_file {_DATED} WHERE x.quarter IS NOT NULL
UNION ALL SELECT 'cut', d.date_id, x.commodity, p.payment_method_id, s.supplier_id, NULL, x.metric_name, x.value, x.unit, x.source_file {_DATED} WHERE x.quarter IS NOT NULL
""",
)
def consumer_debt(t):
    rows = t["stg_retail_rows"].filter("quarter is not null")
    debt = core.retail_fact("consumer_debt", rows, dimensions(t))
    cut = core.retail_fact("consumer_disconnections", rows, dimensions(t))
    return union_all([debt.withColumn("fact", F.lit("debt")), cut.withColumn("fact", F.lit("cut"))])


_AVERAGED = {
    "switching_activity": "x.commodity, z.supplier_size_id", "tariff_benchmarks": "x.commodity, x.supplier_group, s.supplier_id, p.payment_method_id, x.tariff_type",
    "bill_breakdown": "x.commodity, p.payment_method_id, x.supplier_group, x.component", "complaints_resolution": "s.supplier_id, z.supplier_size_id",
    "satisfaction_scores": "s.supplier_id, z.supplier_size_id, x.commodity, x.aspect", "market_structure": "x.commodity",
}


@query(
    "core_averaged_facts", "L13 A12 U02", " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS fact, d.date_id, {keys}, x.metric_name, AVG(x.value) AS value, MIN(x.unit) AS unit, MIN(x.source_file) AS source_file {_DATED} GROUP BY ALL" for name, keys in _AVERAGED.items()
    ), d6=["value"],
)
def averaged_facts(t):
    return union_all([
        core.retail_fact(name, t["stg_retail_rows"], dimensions(t)).withColumn("fact", F.lit(name)) for name in _AVERAGED
    ])


@query(
    "core_retail_other", "L14 A12", f"""
SELECT 'share' AS fact, d.date_id, x.commodity, s.supplier_id, COALESCE(x.segment, 'domestic') AS segment, AVG(x.value) AS value, MIN(x.source_file) AS source_file {_DATED} WHERE s.supplier_id IS NOT NULL GROUP BY ALL
UNION ALL BY NAME SELECT 'accounts' AS fact, d.date_id, s.supplier_id, x.commodity, x.segment, x.tariff_type, AVG(x.value) AS value, MIN(x.unit) AS unit, MIN(x.source_file) AS source_file
 FROM stg_retail_rows x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL LEFT JOIN core_dim_supplier s ON s.supplier_name = x.supplier_name GROUP BY ALL
UNION ALL BY NAME SELECT 'heating' AS fact, d.date_id, x.component, AVG(x.value) AS value, MIN(x.unit) AS unit, MIN(x.source_file) AS source_file {_DATED} GROUP BY ALL
UNION ALL BY NAME SELECT 'spend' AS fact, d.date_id, 'all' AS segment, CAST(x.year AS DOUBLE) AS value, 'h' AS source_file FROM (SELECT DISTINCT year FROM stg_retail_rows) x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL
""", d6=["value"],
)
def retail_other(t):
    rows, dims = t["stg_retail_rows"], dimensions(t)
    share = core.market_share_retail(rows.withColumnRenamed("value", "share_pct"), dims).withColumnRenamed("share_pct", "value")
    years = rows.select("year").distinct().select("year", F.lit("all").alias("segment"), F.col("year").cast("double").alias("value_pct"), F.lit("h").alias("source_file"))
    spend = core.household_spend(years, dims).withColumnRenamed("value_pct", "value")
    accounts, heating = core.customer_accounts(rows, dims), core.heating_systems(rows, dims)
    named = {"share": share, "spend": spend, "accounts": accounts, "heating": heating}
    return union_all([df.withColumn("fact", F.lit(n)) for n, df in named.items()])


@query(
    "core_renewables_obligation", "L15 J05 A12 U02", """
SELECT MIN(d.date_id) AS date_id, o.obligation_period, o.period_label, o.technology, o.metric_name, AVG(o.value) AS value, MIN(o.unit) AS unit, MIN(o.source_file) AS source_file
FROM (SELECT *, CASE WHEN period_label <> 'unknown' THEN period_label END AS obligation_period FROM raw_certificates) o
LEFT JOIN core_dim_date d ON d.year = o.year AND d.quarter IS NOT DISTINCT FROM o.quarter AND o.metric_name <> 'none' GROUP BY o.obligation_period, o.period_label, o.technology, o.metric_name
""", d6=["value"],
)
def renewables_obligation(t):
    period = F.when(F.col("period_label") != "unknown", F.col("period_label"))
    return core.renewables_obligation(t["raw_certificates"].withColumn("obligation_period", period), dimensions(t))


@query(
    "core_scheme_metric", "L16 A12 U02", """
SELECT period_date, year AS calendar_year, month AS calendar_month, quarter, source_file, period_label, scheme_key, entity, metric_name, AVG(value) AS value, MIN(unit) AS unit
FROM raw_scheme_metric GROUP BY ALL
""", d6=["value"],
)
def scheme_metric(t):
    return core.scheme_metric(t["raw_scheme_metric"])
