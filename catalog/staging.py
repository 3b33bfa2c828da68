"""Staging jobs: documents and long rows rendered from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bound import STATUS_COMMODITY, SECTOR_NAMES, by_nation
from catalog.engine import bind, case, query
from metricmart.operators.conform import union_all
from metricmart.operators.filters import conform
from metricmart.plans import staging
from metricmart.sources.landing import as_documents

_SECTOR_NAME = case("sector_code", SECTOR_NAMES)


# Suppliers up to this balance are named otherwise in typed rows, so that documents have keys of their own.
_ROW_NAME = "CASE WHEN s_acctbal > 4000 THEN company_name ELSE 'Site of ' || company_name END"


def long_rows(metrics: dict[str, str], name: str = _ROW_NAME) -> str:
    """Typed long rows of every row of the yearly supplier view."""
    return " UNION ALL ".join(
        f"SELECT year, {name} AS company_name, {_SECTOR_NAME} AS network_sector, '{m}' AS metric_name, {v} AS value, 'u' AS unit, 'f' AS source_file FROM supplier_year"
        for m, v in metrics.items()
    )


bind("raw_network", long_rows({"ens_mwh": "qty", "minutes_lost": "tax", "gas_lost_volume": "returned"}))
bind("raw_spend", long_rows({"totex_allowance_million_gbp": "price", "actual_totex_million_gbp": "revenue"}))
bind("raw_returns", long_rows({"rore_pct": "CASE WHEN year IN (1995, 1997) THEN tax + year END"}))
_SURVEY_NAME = f"CASE WHEN year > 1996 THEN {_ROW_NAME} ELSE 'Early ' || company_name END"
bind("raw_survey", long_rows({"customer_survey_score": "tax", "stakeholder_survey_score": "qty"}, _SURVEY_NAME))
bind("raw_gases", long_rows({"sf6_kg": "tax", "ghg_scope1_tco2e": "qty", "ghg_scope3_tco2e": "returned"}))

# Alias resolution as the check states it: the row of the same sector, else a row without a sector, else the raw name.
_ALIASED = """SELECT r.year, COALESCE({pick}, r.company_name) AS company_name, c.code AS network_sector, r.metric_name, r.value FROM {rows} r
JOIN (VALUES ('Electricity Transmission', 'ET'), ('Electricity Distribution', 'ED'), ('Gas Transmission', 'GT'), ('Gas Distribution', 'GD')) c(name, code) ON c.name = r.network_sector"""
_BY_SECTOR = """(SELECT MAX(a.company_name) FROM alias_rows a WHERE a.source_company_name = r.company_name AND a.network_sector_code = c.code),
 (SELECT MAX(a.company_name) FROM alias_rows a WHERE a.source_company_name = r.company_name AND a.network_sector_code IS NULL)"""
_ANY = "(SELECT MAX(a.company_name) FROM alias_rows a WHERE a.source_company_name = r.company_name)"


def wide_rows(rows: str, columns: list[str], by_sector: bool = False) -> str:
    picks = ", ".join(f"MAX(value) FILTER (WHERE metric_name = '{c}') AS {c}" for c in columns)
    inner = _ALIASED.format(pick=_BY_SECTOR if by_sector else _ANY, rows=rows)
    return f"SELECT year, company_name, network_sector, {picks} FROM ({inner}) GROUP BY 1, 2, 3"


def prefer(first: str, second: str, keys: str = "year, company_name, network_sector") -> str:
    """Rows of the first source, and of the second where the first has no such key."""
    return f"""WITH a AS ({first}), b AS ({second})
SELECT * FROM a UNION ALL BY NAME SELECT * FROM b WHERE ({keys}) NOT IN (SELECT ({keys}) FROM a)"""


def documents(t, **columns: str):
    """Documents about each supplier and year."""
    rows = t["supplier_year"]
    picked = [F.expr(e).alias(n) for n, e in columns.items()]
    return as_documents(rows.select("year", F.expr(_DOC_NAME).alias("company_name"), F.col("sector_code").alias("network_sector"), *picked), "docs")


# Suppliers beyond the limit are named otherwise in documents, so that other sources have keys of their own.
_DOC_NAME = "CASE WHEN s_acctbal < 6000 THEN company_name ELSE 'Filed as ' || company_name END"
_DOC = f"SELECT year, {_DOC_NAME} AS company_name, sector_code AS network_sector, {{columns}} FROM supplier_year"


@query(
    "staging_network_reliability", "G01 C20 C23 J04 R29 W08 U-A", prefer(
        "SELECT *, CAST(NULL AS DOUBLE) AS gas_interruption_volume FROM ("
        + wide_rows("raw_network", ["ens_mwh", "customer_interruptions", "minutes_lost", "gas_lost_volume"], True) + ")",
        _DOC.format(columns="returned AS ens_mwh, CAST(n_returned AS DOUBLE) AS customer_interruptions, tax AS minutes_lost, price AS gas_interruption_volume, qty AS gas_lost_volume"),
    ),
)
def network_reliability(t):
    docs = documents(
        t, ens_mwh="returned", customer_interruptions="n_returned", minutes_lost="tax", gas_interruption_volume="price", gas_lost_volume="qty"
    )
    return staging.network_reliability(docs, t["raw_network"], t["alias_rows"])


@query(
    "staging_financial_performance", "G02 J09 J10 R29", prefer(
        f"""SELECT e.*, COALESCE(s.rore_pct, m.rore_pct) AS rore_pct FROM ({wide_rows('raw_spend', ['totex_allowance_million_gbp', 'actual_totex_million_gbp'])}) e
LEFT JOIN ({wide_rows('raw_returns', ['rore_pct'])}) s ON s.year = e.year AND s.company_name = e.company_name AND s.network_sector = e.network_sector
LEFT JOIN (SELECT company_name, network_sector, MAX(rore_pct) AS rore_pct FROM ({wide_rows('raw_returns', ['rore_pct'])}) GROUP BY 1, 2) m ON m.company_name = e.company_name AND m.network_sector = e.network_sector""",
        _DOC.format(columns="price AS totex_allowance_million_gbp, revenue AS actual_totex_million_gbp, CASE WHEN s_acctbal > 3000 THEN s_acctbal WHEN year < 1999 THEN qty END AS rore_pct"),
    ),
)
def financial_performance(t):
    docs = documents(
        t, totex_allowance_million_gbp="price", actual_totex_million_gbp="revenue", rore_pct="CASE WHEN s_acctbal > 3000 THEN s_acctbal END"
    )
    returns = t["supplier_year"].select(
        "year", F.expr(_DOC_NAME).alias("company_name"), F.col("sector_code").alias("network_sector"), F.expr("CASE WHEN year < 1999 THEN qty END").alias("rore_pct")
    )
    return staging.financial_performance(docs, as_documents(returns, "ror"), t["raw_spend"], t["raw_returns"], t["alias_rows"])


@query(
    "staging_customer_metrics", "G03 C35 R29", prefer(
        f"""SELECT year, company_name, network_sector, 'GB' AS geography_code, CAST(NULL AS DOUBLE) AS cost_per_customer_gbp,
 NULLIF((COALESCE(customer_survey_score, 0) + COALESCE(stakeholder_survey_score, 0)) / NULLIF((customer_survey_score IS NOT NULL)::INT + (stakeholder_survey_score IS NOT NULL)::INT, 0), 0) AS satisfaction_score
 FROM ({wide_rows('raw_survey', ['customer_survey_score', 'stakeholder_survey_score'])})""",
        _DOC.format(columns="CASE WHEN year > 1998 THEN n_name ELSE 'GB' END AS geography_code, price AS cost_per_customer_gbp, qty AS satisfaction_score"),
        "year, company_name, network_sector, geography_code",
    ),
)
def customer_metrics(t):
    docs = documents(
        t, geography_code="CASE WHEN year > 1998 THEN n_name WHEN year > 1996 THEN '' END", cost_per_customer_gbp="price", satisfaction_score="qty"
    )
    return staging.customer_metrics(docs, t["raw_survey"], t["alias_rows"])


@query(
    "staging_emissions", "G04 R29", f"""SELECT * REPLACE (NULLIF(carbon_footprint_tco2e, 0) AS carbon_footprint_tco2e) FROM (""" + prefer(
        f"""SELECT year, company_name, network_sector, sf6_kg, COALESCE(ghg_scope1_tco2e, 0) + COALESCE(ghg_scope3_tco2e, 0) AS carbon_footprint_tco2e
 FROM ({wide_rows('raw_gases', ['sf6_kg', 'ghg_scope1_tco2e', 'ghg_scope3_tco2e'])})""",
        _DOC.format(columns="tax AS sf6_kg, CASE WHEN year = 1996 THEN 0 ELSE revenue END AS carbon_footprint_tco2e"),
    ) + ")",
)
def emissions(t):
    docs = documents(t, sf6_kg="tax", carbon_footprint_tco2e="CASE WHEN year = 1996 THEN 0 ELSE revenue END")
    return staging.emissions(docs, t["raw_gases"], t["alias_rows"])


@query(
    "staging_industry_documents", "G05 G06 G07 C20 C22 C26", """
SELECT 'intensity' AS source, year, p_type AS code, AVG(qty) AS a, AVG(n) AS b, MAX(l_returnflag) AS name FROM type_year GROUP BY year, p_type
UNION ALL SELECT 'fuel', year, p_type || l_returnflag, filled, qty, NULL FROM type_year
UNION ALL SELECT 'gva', year, p_type || l_returnflag, price, NULL, 'E1' FROM type_year
UNION ALL SELECT 'lcree', year, NULL, price, NULL, NULL FROM type_year WHERE p_type = 'SMALL'
UNION ALL SELECT 'inputs', year, p_type, discount, price, lower(l_returnflag) FROM type_year
""", d6=["a", "b"],
)
def industry_documents(t):
    rows = t["type_year"]
    code = F.concat("p_type", "l_returnflag")
    doc = as_documents
    intensity = staging.energy_intensity(doc(rows.select(
        "year", F.col("p_type").alias("sic_code"), F.col("qty").alias("kwh_per_gva"), F.col("n").alias("energy_intensity_index"), F.col("l_returnflag").alias("industry_name")), "i"))
    fuel = staging.sector_fuel_use(doc(rows.select("year", code.alias("sic_code"), F.col("filled").alias("electricity_pct"), F.col("qty").alias("gas_pct")), "f"))
    gva = staging.regional_gva(doc(rows.select("year", F.lit("E1").alias("region_code"), code.alias("sic_code"), F.col("price").alias("gva_million_gbp")), "g"))
    turnover = rows.filter("p_type = 'SMALL'").select(
        "year", F.when(F.col("l_returnflag") == "A", F.col("price")).alias("turnover_million_gbp"),
        F.when(F.col("l_returnflag") != "A", F.col("price")).alias("turnover_current_prices_million_gbp"))
    lcree = staging.lcree(doc(turnover, "l"))
    inputs = staging.intermediate_consumption(doc(rows.select(
        "year", F.col("p_type").alias("sic_code"), F.concat(F.lit(" "), F.col("l_returnflag")).alias("commodity"), F.col("discount").alias("intermediate_share"),
        F.col("price").alias("intermediate_consumption_value")), "c"))

    def part(df, source, code=None, a=None, b=None, name=None):
        def c(x, kind):
            return F.lit(None).cast(kind) if x is None else F.col(x).cast(kind)
        return df.select(F.lit(source).alias("source"), "year", c(code, "string").alias("code"), c(a, "double").alias("a"), c(b, "double").alias("b"), c(name, "string").alias("name"))

    return union_all([
        part(intensity, "intensity", "sic_code", "kwh_per_gva", "energy_intensity_index", "industry_name"),
        part(fuel, "fuel", "sic_code", "electricity_pct", "gas_pct"),
        part(gva, "gva", "sic_code", "gva_million_gbp", None, "region_code"),
        part(lcree, "lcree", None, "lcree_turnover_million_gbp"),
        part(inputs, "inputs", "sic_code", "intermediate_consumption_share", "intermediate_consumption_value", "commodity"),
    ])


@query(
    "staging_market_prices", "G08 A01", """
SELECT year, commodity, instrument, metric_name, AVG(value) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value, COUNT(*) AS obs_count, 'gbp' AS unit FROM price_points GROUP BY 1, 2, 3, 4
""", d11=["avg_value"],
)
def market_prices(t):
    return staging.market_prices(t["price_points"].withColumn("unit", F.lit("gbp")))


@query(
    "staging_market_share", "G10 F01", """
SELECT year, 'electricity' AS commodity, company_name, qty AS share_pct, 'f' AS source_file FROM supplier_year
""",
)
def market_share(t):
    rows = t["supplier_year"].select("year", "company_name", F.col("qty").alias("value"), F.lit("f").alias("source_file"))
    both = rows.withColumn("metric_name", F.explode(F.array(F.lit("generation_market_share_pct"), F.lit("other"))))
    return staging.market_share(both)


@query(
    "staging_daily_prices", "G11 C20 C21 C26 C27", f"""
SELECT CAST(ts AS DATE) AS period_date, CAST(year(ts) AS INT) AS year, event_type AS commodity, {case('event_type', {'click': 'feed one'}, "'events'")} AS source_name, 'price' AS metric_name,
       CASE WHEN event_type <> 'error' THEN value END AS value, 'gbp' AS unit FROM events WHERE event_type <> 'view'
""",
)
def daily_prices(t):
    e, kind = t["events"], F.col("event_type")
    rows = e.filter("event_type <> 'view'").select(
        F.col("ts").cast("date").cast("string").alias("date"), F.concat(F.lit(" "), F.upper(kind)).alias("commodity"),
        F.when(kind == "click", "Feed One").alias("source_name"), F.lit("Price").alias("metric_name"),
        F.when(kind != "error", F.col("value")).alias("value"), F.lit("gbp").alias("unit"),
    )
    # Documents that lack a key field are ignored; a field that is there but null counts.
    short = e.filter("event_type = 'view'").select(F.col("ts").cast("date").cast("string").alias("date"), "value")
    return staging.daily_prices(as_documents(rows, "events").unionByName(as_documents(short, "events")))


# --- retail topics -------------------------------------------------------------------------------------------------

_SERIES_METRICS = [
    "aggregate_profit_billion_gbp", "avg_debt_no_arrangement_gbp", "accounts_repaying_debt", "credit_balance_total_bn_gbp",
    "credit_balance_quartile_median_gbp", "disconnections_for_debt", "smart_ppm_self_disconnect_events", "total_switches",
    "avg_switching_time_days", "active_suppliers", "supplier_exits", "cheapest_tariff_gbp_per_year", "tariff_price_gbp_per_year",
    "gas_price_forward_delivery", "price_cap_component_gbp", "bill_component_gbp", "complaints_received_per_100k",
    "satisfaction_billing_pct", "satisfaction_pct", "household_energy_spend_pct", "heating_systems_approved_count",
    "smart_ppm_self_disconnect_customers", "switching_rate_external_total_pct", "unused_metric", "continuing_active",
]
bind("raw_retail_timeseries", f"""
SELECT CAST(NULL AS DATE) AS period_date, 'p' AS period_label, CASE WHEN o_orderpriority <> '5-LOW' THEN year END AS year, quarter,
       {case('o_orderstatus', STATUS_COMMODITY)} AS commodity, {case('o_orderpriority', {'1-URGENT': 'direct_debit', '2-HIGH': 'prepayment'})} AS payment_method, 'group' AS supplier_group,
       {case('c_mktsegment', {'FURNITURE': 'large', 'BUILDING': 'small'})} AS supplier_size, 'domestic' AS segment, {case('o_orderstatus', {'O': 'fixed'})} AS tariff_type,
       {case('c_mktsegment', {'FURNITURE': 'credit_balance', 'BUILDING': 'network', 'MACHINERY': 'wholesale'})} AS component, {case('c_nationkey', dict(enumerate(_SERIES_METRICS)))} AS metric_name,
       CAST(n AS DOUBLE) AS value, 'u' AS unit, 's_' || c_mktsegment AS source_file
FROM order_groups
""")
_SUPPLIER_METRICS = ["profit_million_gbp", "pretax_domestic_margin_pct", "complaints_received_per_100k", "complaints_resolved_8w_pct", "fit_complaints_per_1000_accounts", "market_share_pct"]
bind("raw_supplier_metric", f"""
SELECT CAST(NULL AS DATE) AS period_date, 'p' AS period_label, CASE WHEN quarter < 4 THEN year END AS year, quarter, s_name AS supplier_name, 'domestic' AS segment, 'gas' AS commodity,
       {case('l_returnflag || l_linestatus', dict(zip(['AF', 'AO', 'NF', 'NO', 'RF', 'RO'], _SUPPLIER_METRICS)))} AS metric_name, CASE WHEN n > 1 THEN CAST(n AS DOUBLE) END AS value, 'u' AS unit, 'm' AS source_file
FROM sales_quarter JOIN supplier ON suppkey = s_suppkey
""")
_SNAPSHOT_METRICS = [
    "avg_repayment_plan_weeks", "avg_weekly_repayment_gbp", "disconnections_for_debt", "tariff_price_gbp_per_year", "bill_breakdown_pct", "minor_incidents_current",
    "satisfaction_pct", "nps_score", "customer_accounts", "cost_index_yoy_impact_pct",
]
bind("raw_retail_snapshot", f"""
SELECT year, 'c' AS category, company_name AS supplier_name, 'domestic' AS segment, 'gas' AS commodity, 'prepayment' AS payment_method, 'large' AS supplier_size, 'billing' AS aspect,
       'network' AS component, 'fixed' AS tariff_type, {case('n_nationkey', by_nation(_SNAPSHOT_METRICS))} AS metric_name, qty AS value, 'u' AS unit, 'n' AS source_file
FROM supplier_year
""")
bind("supplier_alias", """
SELECT s_name AS source_supplier_name, 'Group ' || substr(s_name, 18, 1) AS supplier_name FROM supplier WHERE s_acctbal > 2000
""")

_RESOLVED = "SELECT r.* REPLACE (COALESCE(a.supplier_name, r.supplier_name) AS supplier_name) FROM {t} r LEFT JOIN supplier_alias a ON a.source_supplier_name = r.supplier_name WHERE r.value IS NOT NULL"
_TOPICS = {
    "stg_supplier_profits": [
        ("sup", "year, quarter, supplier_name, segment", ["profit_million_gbp", "pretax_domestic_margin_pct"]),
        ("ser", "year, quarter, segment", ["aggregate_profit_billion_gbp"]),
    ],
    "stg_consumer_debt": [
        ("ser", "year, quarter, commodity, payment_method, component", ["avg_debt_no_arrangement_gbp", "accounts_repaying_debt"]),
        ("ser WHERE component = 'credit_balance'", "year, quarter, commodity, payment_method, component", ["credit_balance_total_bn_gbp", "credit_balance_quartile_median_gbp"]),
        ("snap", "year, commodity, payment_method, supplier_name", ["avg_repayment_plan_weeks", "avg_weekly_repayment_gbp"]),
    ],
    "stg_consumer_disconnections": [
        ("ser", "year, quarter, commodity, payment_method", ["disconnections_for_debt", "smart_ppm_self_disconnect_events", "smart_ppm_self_disconnect_customers"]),
        ("snap", "year, commodity, supplier_name", ["disconnections_for_debt"]),
    ],
    "stg_switching": [("ser", "year, quarter, commodity, supplier_size", ["total_switches", "avg_switching_time_days", "switching_rate_external_total_pct", "active_suppliers", "supplier_exits", "continuing_active"])],
    "stg_tariffs_price_cap": [
        ("ser", "year, quarter, commodity, payment_method, supplier_group, tariff_type", ["cheapest_tariff_gbp_per_year", "tariff_price_gbp_per_year", "gas_price_forward_delivery"]),
        ("snap", "year, commodity, supplier_name, tariff_type", ["tariff_price_gbp_per_year"]),
    ],
    "stg_bill_breakdown": [
        ("ser WHERE component IS NOT NULL", "year, quarter, commodity, payment_method, supplier_group, component", ["price_cap_component_gbp", "bill_component_gbp"]),
        ("snap", "year, commodity, component", ["bill_breakdown_pct", "cost_index_yoy_impact_pct"]),
    ],
    "stg_complaints": [
        ("sup", "year, quarter, supplier_name", ["complaints_received_per_100k", "complaints_resolved_8w_pct"]),
        ("ser WHERE supplier_size IS NOT NULL", "year, quarter, supplier_size", ["complaints_received_per_100k"]),
        ("(SELECT * FROM raw_supplier_metric WHERE year IS NOT NULL)", "year, quarter, supplier_name", ["fit_complaints_per_1000_accounts"]),
        ("snap", "year, supplier_name", ["minor_incidents_current"]),
    ],
    "stg_satisfaction": [
        ("ser", "year, quarter, supplier_size, commodity", ["satisfaction_billing_pct", "satisfaction_pct"]),
        ("snap", "year, supplier_name, commodity, aspect", ["satisfaction_pct"]), ("snap", "year, supplier_size", ["nps_score"]),
    ],
    "stg_market_structure": [("(SELECT * REPLACE (COALESCE(commodity, 'all') AS commodity) FROM ser)", "year, quarter, commodity", ["active_suppliers", "supplier_exits", "continuing_active"])],
    "stg_smart_selfdisconnect": [("raw_retail_timeseries", "year, quarter, commodity, payment_method", ["smart_ppm_self_disconnect_events", "smart_ppm_self_disconnect_customers"])],
    "stg_market_share_retail": [("sup", "year, quarter, commodity, supplier_name, segment", ["market_share_pct"])],
    "stg_household_spend": [("ser", "year, segment", ["household_energy_spend_pct"])],
    "stg_customer_accounts_retail": [("snap", "year, supplier_name, commodity, segment, tariff_type", ["customer_accounts"])],
    "stg_heating_systems": [("ser", "year, quarter, component", ["heating_systems_approved_count"])],
}
_NO_METRIC = ("stg_market_share_retail", "stg_household_spend", "stg_customer_accounts_retail", "stg_heating_systems")
_NO_UNIT = ("stg_market_share_retail", "stg_household_spend")


def _topic_sql(name: str, source: str, columns: str, metrics: list[str]) -> str:
    listed = ", ".join(f"'{m}'" for m in metrics)
    more = " AND " if "WHERE" in source and not source.startswith("(") else " WHERE "
    tail = ("" if name in _NO_METRIC else ", metric_name") + ("" if name in _NO_UNIT else ", unit")
    return f"SELECT '{name}' AS topic, {columns}{tail}, value, source_file FROM {source}{more}metric_name IN ({listed})"


_EMPTY = "SELECT CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS INT) AS year, CAST(NULL AS INT) AS quarter, CAST(NULL AS VARCHAR) AS commodity, NULL::VARCHAR AS payment_method, NULL::VARCHAR AS supplier_name, NULL::VARCHAR AS supplier_group, NULL::VARCHAR AS supplier_size, NULL::VARCHAR AS segment, NULL::VARCHAR AS tariff_type, NULL::VARCHAR AS component, NULL::VARCHAR AS aspect, NULL::VARCHAR AS metric_name, NULL::DOUBLE AS value, NULL::VARCHAR AS unit, NULL::VARCHAR AS source_file WHERE FALSE"


@query(
    "staging_retail_topics", "G12 G13 J03 F01 U-D", f"""
WITH sup AS (SELECT * FROM ({_RESOLVED.format(t='raw_supplier_metric')}) WHERE year IS NOT NULL), ser AS (SELECT * FROM raw_retail_timeseries WHERE year IS NOT NULL),
 snap AS ({_RESOLVED.format(t='raw_retail_snapshot')})
{_EMPTY} UNION ALL BY NAME """ + " UNION ALL BY NAME ".join(_topic_sql(n, *b) for n, bs in _TOPICS.items() for b in bs),
)
def retail_topics(t):
    topics = staging.retail_topics(t["raw_supplier_metric"], t["raw_retail_timeseries"], t["raw_retail_snapshot"], t["supplier_alias"])
    text = ["commodity", "payment_method", "supplier_name", "supplier_group", "supplier_size", "segment", "tariff_type", "component", "aspect", "metric_name"]
    shape = [("topic", "string"), ("year", "int"), ("quarter", "int"), *[(c, "string") for c in text], ("value", "double"), ("unit", "string"), ("source_file", "string")]
    renamed = {n: df.withColumnsRenamed({"share_pct": "value", "value_pct": "value"}) for n, df in topics.items()}
    return union_all([conform(df, shape, topic=n) for n, df in renamed.items()])


_MEAN = "AVG(value) AS value, MAX(unit) AS unit, MAX(source_file) AS source_file"


@query(
    "staging_renewables", "G14 F06 A21", f"""
WITH b AS (SELECT * FROM raw_renewables), m AS (SELECT * FROM b WHERE metric_name IN ('capacity_kw', 'installations'))
SELECT 'capacity' AS grain, year, technology, metric_name, {_MEAN} FROM m WHERE quarter IS NULL AND region IS NULL AND installation_type IS NULL GROUP BY ALL
UNION ALL BY NAME SELECT 'quarterly' AS grain, period_date, period_label, year, quarter, technology, metric_name, {_MEAN} FROM m WHERE quarter IS NOT NULL AND region IS NULL AND installation_type IS NULL GROUP BY ALL
UNION ALL BY NAME SELECT 'regional' AS grain, year, region, technology, metric_name, {_MEAN} FROM b WHERE region IS NOT NULL AND installation_type IS NULL GROUP BY ALL
UNION ALL BY NAME SELECT 'installation_type' AS grain, year, installation_type, technology, metric_name, {_MEAN} FROM m WHERE quarter IS NULL AND region IS NULL AND installation_type IS NOT NULL GROUP BY ALL
""", d9=["value"],
)
def renewables(t):
    frames = staging.renewables(t["raw_renewables"])
    shape = [("grain", "string"), ("period_date", "date"), ("period_label", "string"), ("year", "int"), ("quarter", "int"), ("technology", "string"), ("region", "string"),
             ("installation_type", "string"), ("metric_name", "string"), ("value", "double"), ("unit", "string"), ("source_file", "string")]
    return union_all([conform(df, shape, grain=n.removeprefix("stg_renewables_")) for n, df in frames.items()])


@query(
    "staging_discount_scheme", "G15 F06 A21", f"""
SELECT 'scheme_year' AS grain, scheme_year, calendar_year, nation, metric_name, {_MEAN} FROM raw_whd WHERE supplier_name IS NULL AND obligation_method IS NULL AND metric_name IN ('expenditure_pct', 'scheme_value_mgbp') GROUP BY ALL
UNION ALL BY NAME SELECT 'obligation' AS grain, scheme_year, calendar_year, supplier_name, obligation_method, metric_name, {_MEAN} FROM raw_whd
WHERE (supplier_name IS NOT NULL OR obligation_method IS NOT NULL) AND metric_name IN ('obligation_amount_mgbp', 'redistributed_mgbp') GROUP BY ALL
""", d9=["value"],
)
def discount_scheme(t):
    frames = staging.discount_scheme(t["raw_whd"])
    shape = [("grain", "string"), ("scheme_year", "int"), ("calendar_year", "int"), ("nation", "string"), ("supplier_name", "string"), ("obligation_method", "string"),
             ("metric_name", "string"), ("value", "double"), ("unit", "string"), ("source_file", "string")]
    return union_all([conform(df, shape, grain=n.removeprefix("stg_whd_")) for n, df in frames.items()])


@query(
    "staging_obligation", "G16 C24", """
SELECT year, quarter, period_label, CASE WHEN metric_name = 'rocs_monthly_millions' AND period_label LIKE '%|%' THEN split_part(period_label, '|', 2)
       WHEN metric_name IN ('rocs_issued_millions', 'accredited_capacity_mw') AND regexp_full_match(period_label, '\\d{4}-\\d{2}') THEN period_label END AS obligation_period,
       technology, metric_name, value, unit, source_file FROM raw_certificates
""",
)
def obligation(t):
    return staging.renewables_obligation(t["raw_certificates"])


@query("staging_scheme_metric", "G17", "SELECT * FROM raw_scheme_metric WHERE value IS NOT NULL")
def scheme_metric(t):
    return staging.scheme_metrics(t["raw_scheme_metric"])


@query(
    "staging_digest", "G18 S09 W08", """
SELECT * FROM stg_digest QUALIFY row_number() OVER (PARTITION BY dukes_table, period_year, period_label, row_label, column_label, metric_name, source_file ORDER BY value) = 1
""",
)
def digest(t):
    return staging.statistical_digest([t["stg_digest"], t["stg_digest"].filter("dukes_table = '6.2'")])
