"""Every reshape operator on wide tables and cell grids rendered from the driver tables.

Each query renders long aggregates into the labelled layout its operator reads; the operator must give the long
aggregates back.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog.bound import TYPE_FUELS
from catalog.engine import QUARTER, YEAR, bind, query, total
from metricmart.operators import grid, unpivot
from metricmart.operators.registry import run_registry, rows_per_source

YEARS = list(range(1995, 2002))
TYPES = list(TYPE_FUELS)
NATIONS = [f"NATION_{i}" for i in range(25)]
STATUSES = ["F", "O", "P"]


def wide(rows: DataFrame, index: Column, header: Column, labels: list[str], value: Column) -> DataFrame:
    """Render long rows as a wide table with one column per label."""
    long = rows.select(index.alias("label"), header.alias("header"), value.alias("value"))
    return long.groupBy("label").pivot("header", labels).agg(F.max("value"))


def text(column: Column) -> Column:
    return column.cast("bigint").cast("string")


bind("company_year", "SELECT year, company_name, SUM(quantity) AS quantity, SUM(price) AS price FROM line_metrics GROUP BY 1, 2")
bind("nation_quarter", f"""
SELECT {YEAR} AS year, {QUARTER} AS quarter, n_name AS nation, COUNT(*) AS n FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY {YEAR}, {QUARTER}, n_name
""")
bind("day_status", "SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1, 2")

_NETWORK = "'{sector}' AS network_sector, '{unit}' AS unit, '{file}' AS source_file"


@query(
    "unpivot_metrics", "R01 R03", """
SELECT l_orderkey, l_linenumber, 'quantity' AS metric_name, l_quantity AS value FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem
""",
)
def unpivot_metrics(t):
    names = ["quantity", "extendedprice", "discount", "tax"]
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", *[F.col(f"l_{n}").alias(n) for n in names])
    cells, headers = unpivot.melt(rows, ["l_orderkey", "l_linenumber"])
    return cells.join(headers, "position").select(
        "l_orderkey", "l_linenumber", F.col("header").alias("metric_name"), F.col("cell").alias("value")
    )


@query(
    "unpivot_period_metric", "R01 C12 C01", """
WITH k AS (SELECT * FROM (SELECT DISTINCT company_name FROM company_year) c, (SELECT DISTINCT year FROM company_year) y)
SELECT k.year, k.company_name, 'Electricity Transmission' AS network_sector, m.metric_name, CASE m.metric_name WHEN 'ens_mwh' THEN f.quantity * 2 ELSE FLOOR(f.price) * 2 END AS value, 'x' AS unit, 'r01' AS source_file
FROM k LEFT JOIN company_year f USING (year, company_name), (VALUES ('ens_mwh'), ('allowance')) m(metric_name)
""",
)
def unpivot_period_metric(t):
    rows = t["company_year"].select(
        "company_name", "year",
        F.explode(F.array(F.struct(F.lit("actual").alias("kind"), text(F.col("quantity")).alias("v")),
                          F.struct(F.lit("target").alias("kind"), F.format_number(F.floor("price"), 0).alias("v")))).alias("s"),
    )
    header = F.concat(F.lit("Year "), F.col("year") - 1994, F.lit(" "), F.col("s.kind"), F.lit(" (reported)"))
    labels = [f"Year {y - 1994} {k} (reported)" for y in YEARS for k in ("actual", "target")]
    table = wide(rows, F.col("company_name"), header, labels, F.col("s.v"))
    return unpivot.period_metric(
        table, source_file="r01", column_pattern=r"Year (?P<period>\d+) (?P<kind>\w+)",
        kind_metric_map={"actual": "ens_mwh", "_default": "allowance"}, scheme="X", scheme_starts={"X": 1995},
        network_sector="Electricity Transmission", unit="x", multiplier=2.0,
    )


@query(
    "unpivot_year_rows", "R02 C07 C18", """
SELECT year + 1 AS year, 'GB' AS company_name, 'ED' AS network_sector, 'orders_n' AS metric_name, CAST(SUM(n) AS DOUBLE) AS value, 'n' AS unit, 'r02' AS source_file FROM order_year GROUP BY 1
UNION ALL SELECT year + 1, 'GB', 'ED', 'spend_k', FLOOR(SUM(spend)), 'n', 'r02' FROM order_year GROUP BY 1
""",
)
def unpivot_year_rows(t):
    y = F.col("year")
    table = t["order_year"].groupBy("year").agg(F.sum("n").alias("n"), F.floor(F.sum("spend")).alias("spend")).select(
        F.concat(y, F.lit("/"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")).alias("label"),
        F.format_number("n", 0).alias("Orders (count)"), F.format_number("spend", 0).alias("Spending total"),
        F.lit("x").alias("Notes"),
    )
    return unpivot.year_rows(
        table, source_file="r02", metric_map={"orders": "orders_n", "spend": "spend_k"}, substring=True,
        network_sector="ED", unit="n", fixed_company="GB",
    )


@query(
    "unpivot_snapshot", "R03 R24", """
SELECT 2020 AS year, s_name AS company_name, 'GD' AS network_sector, 'balance' AS metric_name, s_acctbal AS value, 'gbp' AS unit, 'r03' AS source_file FROM supplier
UNION ALL SELECT 2020, s_name, 'GD', 'place', CAST(s_nationkey AS DOUBLE), 'gbp', 'r03' FROM supplier
""",
)
def unpivot_snapshot(t):
    table = t["supplier"].select("s_name", F.col("s_acctbal").alias("Balance"), F.col("s_nationkey").alias("Nation"))
    return unpivot.snapshot(
        table, source_file="r03", snapshot_year=2020, metric_map={"Balance": "balance", "Nation": "place"},
        network_sector="GD", unit="gbp",
    )


@query(
    "unpivot_time_series", "R04 C10 C05", """
SELECT day AS period_date, strftime(day, '%d/%m/%Y') AS period_label, CAST(year(day) AS INT) AS year, 'electricity' AS commodity, 'status_' || lower(status) AS instrument,
       'orders' AS metric_name, CAST(n AS DOUBLE) AS value, 'n' AS unit, 'r04' AS source_file FROM day_status
""",
)
def unpivot_time_series(t):
    table = wide(
        t["day_status"], F.date_format("day", "dd/MM/yyyy"), F.concat(F.lit("Status "), F.col("status")),
        [f"Status {s}" for s in STATUSES], F.col("n"),
    )
    return unpivot.time_series(
        table, source_file="r04", date_format="dayfirst", columns_as_instrument=True, default_metric="orders",
        commodity="electricity", unit="n",
    )


@query(
    "unpivot_multi_year", "R05 C28", """
SELECT CAST(NULL AS DATE) AS period_date, 'isoweek_' || lpad(CAST(weekofyear(day) AS VARCHAR), 2, '0') AS period_label, CAST(year(day) AS INT) AS year, 'gas' AS commodity,
       CAST(year(day) AS VARCHAR) AS instrument, 'orders' AS metric_name, CAST(SUM(n) AS DOUBLE) AS value, 'n' AS unit, 'r05' AS source_file FROM day_status GROUP BY ALL
""",
)
def unpivot_multi_year(t):
    weekly = t["day_status"].groupBy(F.weekofyear("day").alias("week"), F.year("day").alias("year")).agg(F.sum("n").alias("n"))
    table = wide(weekly, F.col("week"), F.concat(F.lit("Calendar "), F.col("year")), [f"Calendar {y}" for y in YEARS], F.col("n"))
    return unpivot.multi_year(
        table, source_file="r05", year_pattern=r"(?P<year>\d{4})", metric_name="orders", commodity="gas", unit="n"
    )


@query(
    "unpivot_period_entity", "R06 C11 C17", """
SELECT make_date(year, (quarter - 1) * 3 + 1, 1) AS period_date, 'Q' || quarter || ' ' || year AS period_label, year, quarter, nation AS supplier_name, 'domestic' AS segment,
       'gas' AS commodity, 'switches' AS metric_name, CAST(n AS DOUBLE) AS value, 'n' AS unit, 'r06' AS source_file FROM nation_quarter
""",
)
def unpivot_period_entity(t):
    label = F.concat(F.lit("Q"), F.col("quarter"), F.lit(" "), F.col("year"))
    header = F.concat("nation", F.lit(" - Start Q1 1995"))
    table = wide(t["nation_quarter"], label, header, [f"{n} - Start Q1 1995" for n in NATIONS], F.col("n"))
    return unpivot.period_entity(
        table.withColumn("Total", F.lit(1)), source_file="r06", metric_name="switches", period_kind="quarterly",
        segment="domestic", commodity="gas", unit="n", skip=["Total"],
    )


_DIMS = {
    "F": {"commodity": "gas", "payment_method": "direct_debit"}, "O": {"commodity": "electricity", "metric_name": "open"},
}


@query(
    "unpivot_period_dimensions", "R07 C19 C11", """
SELECT day AS period_date, strftime(day, '%Y-%m-%d') AS period_label, CAST(year(day) AS INT) AS year, CAST(quarter(day) AS INT) AS quarter,
       CASE status WHEN 'F' THEN 'gas' ELSE 'electricity' END AS commodity, CASE status WHEN 'F' THEN 'direct_debit' ELSE 'prepayment' END AS payment_method,
       NULL AS supplier_group, NULL AS supplier_size, 'domestic' AS segment, NULL AS tariff_type, NULL AS component, CASE status WHEN 'F' THEN 'orders' ELSE 'open' END AS metric_name,
       CAST(n AS DOUBLE) AS value, 'n' AS unit, 'r07' AS source_file FROM day_status WHERE status <> 'P'
""",
)
def unpivot_period_dimensions(t):
    table = wide(t["day_status"], F.date_format("day", "yyyy-MM-dd"), F.col("status"), STATUSES, F.col("n"))
    return unpivot.period_dimensions(
        table, source_file="r07", metric_name="orders", column_dimension_map=_DIMS,
        dimensions={"segment": "domestic", "payment_method": "prepayment"}, unit="n",
    )


@query(
    "unpivot_category_aspect", "R08", """
SELECT 2021 AS year, NULL AS category, s_name AS supplier_name, 'domestic' AS segment, NULL AS commodity, m.pm AS payment_method, NULL AS supplier_size, NULL AS aspect, NULL AS component,
       NULL AS tariff_type, 'plans' AS metric_name, CASE m.pm WHEN 'Direct debit' THEN s_acctbal ELSE CAST(s_nationkey AS DOUBLE) END AS value, 'n' AS unit, 'r08' AS source_file
FROM supplier, (VALUES ('Direct debit'), ('Prepayment')) m(pm)
""",
)
def unpivot_category_aspect(t):
    table = t["supplier"].select("s_name", F.col("s_acctbal").alias("Direct debit"), F.col("s_nationkey").alias("Prepayment"))
    return unpivot.category_aspect(
        table, source_file="r08", snapshot_year=2021, entity_role="supplier", column_role="payment_method",
        metric_name="plans", dimensions={"segment": "domestic"}, unit="n",
    )


bind("type_region_year", f"""
SELECT {YEAR} AS year, r_name AS region, p_type, {total('l_quantity')} AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3
""")
_TECH = "CAST(NULL AS DATE) AS period_date, {label} AS period_label, {year} AS year, CAST(NULL AS INT) AS quarter, p_type AS technology, {region} AS region, {inst} AS installation_type, '{metric}' AS metric_name"


@query(
    "unpivot_technology_period", "R09", f"""
SELECT {_TECH.format(label="CAST(year AS VARCHAR)", year='year', region="'England'", inst='NULL', metric='capacity_kw')}, SUM(qty) AS value, 'kw' AS unit, 'r09' AS source_file FROM type_region_year GROUP BY year, p_type
UNION ALL SELECT {_TECH.format(label="'2003'", year='2003', region='region', inst="'domestic'", metric='share_pct')}, SUM(qty), 'kw', 'r09b' FROM type_region_year GROUP BY region, p_type
""",
)
def unpivot_technology_period(t):
    rows = t["type_region_year"]
    by_year = rows.groupBy("p_type", "year").agg(F.sum("qty").alias("q"))
    years = wide(by_year, F.col("p_type"), F.col("year").cast("string"), [str(y) for y in YEARS], F.col("q"))
    total_row = years.agg(F.lit("Total").alias("label"), *[F.sum(f"`{y}`").alias(str(y)) for y in YEARS])
    first = unpivot.technology_period(years.unionByName(total_row), source_file="r09", region="England", unit="kw")
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    by_region = rows.groupBy("p_type", "region").agg(F.sum("qty").alias("q"))
    second = unpivot.technology_period(
        wide(by_region, F.col("p_type"), F.col("region"), regions, F.col("q")), source_file="r09b", snapshot_year=2003,
        column_dimension_map={r: {"region": r, "metric_name": "share_pct"} for r in regions}, installation_type="domestic",
        unit="kw",
    )
    return first.unionByName(second)


@query(
    "unpivot_scheme_year", "R10 C38", """
SELECT year - 1994 AS scheme_year, year + 16 AS calendar_year, NULL AS nation, nation AS supplier_name, 'core' AS obligation_method, 'obligation' AS metric_name,
       CAST(n AS DOUBLE) AS value, 'm' AS unit, 'r10' AS source_file FROM order_year
""",
)
def unpivot_scheme_year(t):
    label = F.concat(F.lit("Scheme year "), F.col("year") - 1994)
    return unpivot.scheme_year_matrix(
        wide(t["order_year"], label, F.col("nation"), NATIONS, F.col("n")), source_file="r10", metric_name="obligation",
        obligation_method="core", unit="m",
    )


@query(
    "unpivot_scheme_metric", "R11 C10", """
SELECT day AS period_date, strftime(day, '%-m/%-d/%Y') AS period_label, CAST(year(day) AS INT) AS year, CAST(quarter(day) AS INT) AS quarter, CAST(month(day) AS INT) AS month, 'bus' AS scheme_key,
       NULL AS entity, CASE status WHEN 'F' THEN 'paid' ELSE 'open' END AS metric_name, CAST(n AS DOUBLE) AS value, 'n' AS unit, 'r11' AS source_file FROM day_status WHERE status <> 'P'
""",
)
def unpivot_scheme_metric(t):
    table = wide(t["day_status"], F.date_format("day", "M/d/yyyy"), F.col("status"), STATUSES, F.col("n"))
    return unpivot.scheme_metric(
        table, source_file="r11", scheme_key="bus", metric_map={"F": "paid", "O": "open"}, date_format="us_dayfirst", unit="n"
    )


@query(
    "unpivot_scheme_entity", "R12", """
SELECT make_date(year, (quarter - 1) * 3 + 1, 1) AS period_date, year || ' Q' || quarter AS period_label, year, quarter, (quarter - 1) * 3 + 1 AS month, 'eco' AS scheme_key, nation AS entity,
       'measures' AS metric_name, CAST(n AS DOUBLE) AS value, 'n' AS unit, 'r12' AS source_file FROM nation_quarter
""",
)
def unpivot_scheme_entity(t):
    label = F.concat(F.col("year"), F.lit(" Q"), F.col("quarter"))
    return unpivot.scheme_entity(
        wide(t["nation_quarter"], label, F.col("nation"), NATIONS, F.col("n")), source_file="r12", scheme_key="eco",
        metric_name="measures", unit="n",
    )


_CHART = "CAST(NULL AS DATE) AS period_date, 'Household (Quarter ' || quarter || ' ' || year || ')' AS period_label, year, quarter, 'dual_fuel' AS commodity, 'direct_debit' AS payment_method, NULL AS supplier_group, NULL AS supplier_size, NULL AS segment, NULL AS tariff_type, 'credit_balance' AS component"


@query(
    "chart_quarters", "R13 C14", f"""
SELECT {_CHART}, 'credit_a' AS metric_name, CAST(SUM(n) AS DOUBLE) AS value, 'gbp' AS unit, 'chart:a' AS source_file FROM nation_quarter GROUP BY year, quarter
UNION ALL SELECT {_CHART}, 'credit_b', CAST(MAX(n) AS DOUBLE), 'gbp', 'chart:a' FROM nation_quarter GROUP BY year, quarter
""",
)
def chart_quarters(t):
    label = F.concat(F.lit("Household (Quarter "), F.col("quarter"), F.lit(" "), F.col("year"), F.lit(")"))
    table = t["nation_quarter"].groupBy("year", "quarter").agg(F.sum("n").alias("a"), F.max("n").alias("b")).select(
        label.alias("Quarter"), text(F.col("a")).alias("Total"), text(F.col("b")).alias("Rolling")
    )
    return unpivot.chart_quarters(
        table, source_file="chart:a", metrics=["credit_a", "credit_b"], unit="gbp", label_contains="Household"
    )


@query(
    "chart_supplier_quarters", "R13 C08", """
SELECT CAST(NULL AS DATE) AS period_date, 'Q' || quarter || ' ' || year AS period_label, year, quarter, nation AS supplier_name, NULL AS segment, 'electricity' AS commodity, 'fit_complaints_per_1000_accounts' AS metric_name,
       CAST(n AS DOUBLE) AS value, 'rate_per_1000' AS unit, 'chart:b' AS source_file FROM nation_quarter
""",
)
def chart_supplier_quarters(t):
    label = F.concat(F.lit("Q"), F.col("quarter"), F.lit(" "), F.col("year"))
    table = wide(t["nation_quarter"], label, F.col("nation"), NATIONS, text(F.col("n")))
    return unpivot.chart_supplier_quarters(
        table, source_file="chart:b", metric_name="fit_complaints_per_1000_accounts", commodity="electricity", unit="rate_per_1000"
    )


_RENEW = "CAST(NULL AS DATE) AS period_date, {label} AS period_label, {year} AS year, {quarter} AS quarter, {tech} AS technology, NULL AS region, NULL AS installation_type, '{metric}' AS metric_name"
_OB = "year || '-' || right(CAST(year + 1 AS VARCHAR), 2)"


@query(
    "chart_obligations", "R13 C13 C15", f"""
SELECT {_RENEW.format(label=_OB, year='year', quarter='CAST(NULL AS INT)', tech='p_type', metric='rocs_issued_millions')}, SUM(qty) AS value, 'million_rocs' AS unit, 'chart:c' AS source_file FROM type_region_year GROUP BY year, p_type
UNION ALL SELECT {_RENEW.format(label=f"'Feb|' || {_OB}", year='year + 1', quarter='1', tech='NULL', metric='rocs_monthly_millions')}, SUM(qty), 'million_rocs', 'chart:d' FROM type_region_year GROUP BY year
UNION ALL SELECT {_RENEW.format(label="'Apr-' || right(CAST(year AS VARCHAR), 2) || '*'", year='year', quarter='2', tech='NULL', metric='accredited_stations_cumulative_all')}, SUM(qty), 'stations', 'chart:e' FROM type_region_year GROUP BY year
""",
)
def chart_obligations(t):
    def two(c):
        return F.lpad((c % 100).cast("string"), 2, "0")

    y = F.col("year")
    period = F.concat(y, F.lit("-"), two(y + 1))
    labels = [f"{a}-{(a + 1) % 100:02d}" for a in YEARS]
    rows = t["type_region_year"]
    types = rows.groupBy("p_type", "year").agg(F.sum("qty").alias("q"))
    yearly = rows.groupBy("year").agg(F.sum("qty").alias("q"))
    issued = unpivot.chart_technology_obligations(
        wide(types, F.col("p_type"), period, labels, text(F.col("q"))), source_file="chart:c",
        metric_name="rocs_issued_millions", unit="million_rocs",
    )
    monthly = unpivot.chart_monthly_obligations(
        wide(yearly, F.lit("Feb"), period, labels, text(F.col("q"))), source_file="chart:d",
        metric_name="rocs_monthly_millions", unit="million_rocs",
    )
    stations = unpivot.chart_cumulative_months(
        yearly.select(F.concat(F.lit("Apr-"), two(y), F.lit("*")).alias("Month"), text(F.col("q")).alias("Stations")),
        source_file="chart:e", metric_name="accredited_stations_cumulative_all", unit="stations",
    )
    return issued.unionByName(monthly).unionByName(stations)


@query(
    "daily_price_pair", "R27 C03 G11", """
SELECT day AS date, 'gas' AS commodity, 'sap' AS source_name, 'spot' AS metric_name, CAST(SUM(n) AS DOUBLE) AS value, 'p' AS unit FROM day_status GROUP BY day HAVING SUM(n) > 5
UNION ALL SELECT day, 'gas', 'sap', 'rolling', CAST(MAX(n) AS DOUBLE), 'p' FROM day_status GROUP BY day
""",
)
def daily_price_pair(t):
    total_n = F.sum("n")
    spot = F.when(total_n > 5, text(total_n)).otherwise(F.lit("[x]"))
    table = t["day_status"].groupBy("day").agg(spot.alias("SAP"), text(F.max("n")).alias("Rolling")).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd")
    )
    return unpivot.daily_price_pair(table, commodity="gas", source_name="sap", metrics=["spot", "rolling"], unit="p")


bind("sections", "SELECT CAST(p_size AS STRING) AS sic_section, p_name AS industry_name FROM part WHERE p_size < 0")


@query(
    "fuel_use_long", "R28 C41 W09 C32", f"""
SELECT {YEAR} AS year, left(p_type, 1) AS sic_code, SUM(l_quantity) FILTER (WHERE l_linestatus = 'F') / SUM(l_quantity) AS electricity_pct, SUM(l_quantity) FILTER (WHERE l_linestatus = 'O') / SUM(l_quantity) AS gas_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""",
)
def fuel_use_long(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey")
    )
    q = F.col("l_quantity")
    table = rows.groupBy(F.year("o_orderdate").alias("year"), F.left("p_type", F.lit(1)).alias("section")).agg(
        F.sum(F.when(F.col("l_linestatus") == "F", q)).alias("electricity"), F.sum(F.when(F.col("l_linestatus") == "O", q)).alias("gas")
    )
    return unpivot.fuel_use(table, t["sections"])


@query(
    "fuel_use_wide", "R28 C41", f"""
SELECT {YEAR} AS year, left(p_type, 1) AS sic_code, SUM(l_quantity) FILTER (WHERE l_linestatus = 'F') / SUM(l_quantity) AS electricity_pct, SUM(l_quantity) FILTER (WHERE l_linestatus = 'O') / SUM(l_quantity) AS gas_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
""",
)
def fuel_use_wide(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey")
    )
    fuel = F.when(F.col("l_linestatus") == "F", "Electricity").otherwise("Natural gas")
    long = rows.groupBy(F.left("p_type", F.lit(1)).alias("industry"), fuel.alias("fuel"), F.year("o_orderdate").alias("y")).agg(
        F.sum("l_quantity").alias("q")
    )
    table = long.groupBy("industry", "fuel").pivot("y", YEARS).agg(F.max("q"))
    return unpivot.fuel_use(table, t["sections"])


@query(
    "registry_union", "R33 D11", """
SELECT f AS source_file, CAST(n AS BIGINT) AS row_count, n > 0 AS ok FROM (
 SELECT 'a' AS f, COUNT(*) AS n FROM day_status UNION ALL SELECT 'b', COUNT(*) FROM day_status WHERE status = 'F' UNION ALL SELECT 'missing', 0)
""",
)
def registry_union(t):
    series = wide(t["day_status"], F.date_format("day", "dd/MM/yyyy"), F.col("status"), STATUSES, F.col("n"))
    entries = [
        {"source": "orders", "strategy": "time_series_long", "target": "market",
         "options": {"source_file": "a", "date_format": "dayfirst", "columns_as_instrument": True}},
        {"source": "orders", "strategy": "time_series_long", "target": "market",
         "options": {"source_file": "b", "date_format": "dayfirst", "metric_map": {"F": "filled"}}},
        {"source": "nowhere", "strategy": "time_series_long", "target": "market", "options": {"source_file": "missing"}},
    ]
    run = run_registry(entries, {"orders": series}, allow_failures=True)
    return rows_per_source(run.targets["market"], ["a", "b", "missing"])


# --- cell grids --------------------------------------------------------------------------------------------------

bind("sheet_values", f"""
SELECT {YEAR} AS year, s_name AS sheet, p_type, {total('l_quantity')} AS qty, COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
""", shared=True)


def place(values: list, column: str) -> Column:
    """Position of a value in a fixed list, from 1."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column)).cast("int")


class Sheets:
    """Renders long rows into cells, one sheet per supplier; the cell table is stored, as a landing table would be."""

    def __init__(self, tables, rows: DataFrame, file: str = "f"):
        self.tables, self.rows, self.file = tables, rows, file
        self.names = rows.select("sheet").distinct()
        self.parts: list[DataFrame] = []

    def add(self, frame: DataFrame, row: Column, col: Column, cell: Column) -> Sheets:
        self.parts.append(
            frame.select(F.lit(self.file).alias("source_file"), "sheet", row.cast("int").alias("row"), col.cast("int").alias("col"), cell.cast("string").alias("text"))
        )
        return self

    def constant(self, row: int, col: int, cell: str) -> Sheets:
        return self.add(self.names, F.lit(row), F.lit(col), F.lit(cell))

    def years(self, row: int, first_col: int = 1, suffix: str = "") -> Sheets:
        heads = self.names.withColumn("y", F.explode(F.array(*[F.lit(y) for y in YEARS])))
        return self.add(heads, F.lit(row), F.col("y") - 1995 + first_col, F.concat(F.col("y"), F.lit(suffix)))

    def labels(self, row0: int, col: int = 0) -> Sheets:
        heads = self.names.withColumn("p", F.explode(F.array(*[F.lit(p) for p in TYPES])))
        return self.add(heads, row0 + place(TYPES, "p") - 1, F.lit(col), F.concat(F.lit(" "), F.col("p"), F.lit("  x")))

    def values(self, row0: int, value: str, first_col: int = 1) -> Sheets:
        return self.add(self.rows, row0 + place(TYPES, "p_type") - 1, F.col("year") - 1995 + first_col, text(F.col(value)))

    def cells(self) -> DataFrame:
        return self.tables.store(f"cells_{uuid.uuid4().hex}", reduce(lambda a, b: a.unionByName(b), self.parts))


def digest_sql(table: str, value: str, metric: str, unit: str, **columns: str) -> str:
    """Expected long rows of one block."""
    c = {"period_year": "CAST(year AS INT)", "period_label": "CAST(NULL AS VARCHAR)", "row_label": "p_type || ' x'", "column_label": "CAST(NULL AS VARCHAR)", "value_text": "CAST(NULL AS VARCHAR)"} | columns
    return f"""SELECT '{table}' AS dukes_table, {c['period_year']} AS period_year, {c['period_label']} AS period_label, {c['row_label']} AS row_label, {c['column_label']} AS column_label,
'{metric}' AS metric_name, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, 'f' AS source_file, {c['value_text']} AS value_text FROM sheet_values"""


@query(
    "grid_sections", "R14 W13 C16 C06", digest_sql("6.2", "qty", "installed_capacity_mw", "MW") + " UNION ALL " + digest_sql("6.2", "n", "generation_gwh", "GWh"),
)
def grid_sections(t):
    s = Sheets(t, t["sheet_values"]).constant(0, 0, "This worksheet holds one table")
    s.constant(1, 0, "Installed capacity (MW) [note 1]").years(1).labels(2).values(2, "qty")
    s.constant(10, 0, "Something else").years(10).labels(11).values(11, "qty")
    s.constant(20, 0, "Generation (GWh)").years(20).labels(21).values(21, "n")
    return grid.section_years(s.cells(), table="6.2", sections=grid.CAPACITY_SECTIONS)


@query(
    "grid_sections_wide", "R14 W13 C16", digest_sql("6.2", "qty", "installed_capacity_mw", "MW"),
)
def grid_sections_wide(t):
    # Year headers far to the right of the labels, from column 14 on.
    s = Sheets(t, t["sheet_values"]).constant(1, 0, "Installed capacity (MW)").years(1, first_col=14).labels(2).values(2, "qty", first_col=14)
    return grid.section_years(s.cells(), table="6.2", sections=grid.CAPACITY_SECTIONS)


@query(
    "grid_section_markers", "R14 W13", digest_sql("6.4", "qty", "renewable_use_ktoe", "ktoe", column_label="CASE WHEN p_type IN ('STANDARD', 'PROMO', 'SMALL') THEN 'heat' ELSE 'transport' END", row_label="CASE p_type WHEN 'LARGE' THEN 'Renewable sources used as transport fuels' ELSE p_type || ' x' END"),
)
def grid_section_markers(t):
    s = Sheets(t, t["sheet_values"]).constant(3, 0, "Used to generate heat").years(3).values(4, "qty")
    heads = s.names.withColumn("p", F.explode(F.array(*[F.lit(p) for p in TYPES])))
    label = F.when(F.col("p") == "LARGE", "Renewable sources used as transport fuels").otherwise(F.concat("p", F.lit(" x")))
    s.add(heads, 3 + place(TYPES, "p"), F.lit(0), label)
    return grid.section_years(
        s.cells(), table="6.4", sections=grid.USE_SECTIONS, markers=grid.USE_MARKERS, default_marker="electricity"
    )


@query(
    "grid_carry_forward", "R15 W13", digest_sql("5.1", "qty", "m", "u", period_label="'Table 5.1 first'", column_label="'Table 5.1 first'", row_label="p_type || ' x | all'") + " UNION ALL "
    + digest_sql("5.1", "n", "m", "u", period_label="'Table 5.2 second'", column_label="'Table 5.2 second'", row_label="p_type || ' x'"),
)
def grid_carry_forward(t):
    s = Sheets(t, t["sheet_values"]).constant(0, 0, "Table 5.1 first").constant(2, 0, "Category").years(2, 2).labels(3).values(3, "qty", 2)
    for r in range(3, 9):
        s.constant(r, 1, "all")
    s.constant(12, 0, "Table 5.2 second").years(14).labels(15).values(15, "n")
    return grid.titled_year_sections(s.cells(), table="5.1", metric_name="m", unit="u")


bind("type_nation_year", """
SELECT year, p_type, n_name AS fuel, SUM(qty_c) / 100 AS qty FROM type_sales JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3
""")


def year_sheet_cells(t, file: str = "f") -> DataFrame:
    rows = t["type_nation_year"].withColumns({"sheet": F.col("year").cast("string")})
    s = Sheets(t, rows, file)
    heads = s.names.withColumn("fuel", F.explode(F.array(*[F.lit(n) for n in NATIONS])))
    s.add(heads, F.lit(2), place(NATIONS, "fuel"), F.col("fuel")).labels(4)
    s.add(rows, 3 + place(TYPES, "p_type"), place(NATIONS, "fuel"), text(F.col("qty")))
    return s.constant(0, 0, "Commodity balances").cells()


@query(
    "grid_year_sheets", "R16", """
SELECT '6.1' AS dukes_table, CAST(year AS INT) AS period_year, NULL AS period_label, p_type || ' x' AS row_label, fuel AS column_label,
       CASE WHEN fuel = 'NATION_3' THEN 'share' ELSE 'commodity_balance_ktoe' END AS metric_name, qty AS value, CASE WHEN fuel = 'NATION_3' THEN 'percent' ELSE 'ktoe' END AS unit, 'f' AS source_file, NULL AS value_text
FROM type_nation_year
""",
)
def grid_year_sheets(t):
    return grid.year_sheets(
        year_sheet_cells(t), table="6.1", header_row=2, data_start=4, header_metrics=[(["=nation_3"], "share", "percent")]
    )


@query(
    "grid_side_by_side", "R17", """
SELECT '1.1' AS dukes_table, CAST(year AS INT) AS period_year, NULL AS period_label, p_type || ' x' AS row_label, fuel AS column_label, CASE WHEN k < 10 THEN 'twh' ELSE 'ktoe' END AS metric_name,
       qty AS value, CASE WHEN k < 10 THEN 'TWh' ELSE 'ktoe' END AS unit, 'f' AS source_file, NULL AS value_text
FROM (SELECT *, CAST(substr(fuel, 8) AS INT) AS k FROM type_nation_year) WHERE k < 10 OR k BETWEEN 16 AND 24
""",
)
def grid_side_by_side(t):
    return grid.side_by_side(
        year_sheet_cells(t), table="1.1", blocks=[(1, 11, "twh", "TWh"), (17, 26, "ktoe", "ktoe")], header_row=2, data_start=4
    )


@query(
    "grid_years_across", "R18", digest_sql("1.3", "qty", "stock", "n", column_label="replace(sheet, '.', '_')"),
)
def grid_years_across(t):
    s = Sheets(t, t["sheet_values"]).years(3, suffix=".0").labels(5).values(5, "qty").constant(4, 0, "Column1").constant(4, 1, "7")
    return grid.years_across(s.cells(), table="1.3", header_row=3, data_start=4, metric_name="stock", unit="n")


def year_rows_cells(t, header, first: str = "f") -> Sheets:
    s = Sheets(t, t["sheet_values"], first)
    heads = s.names.withColumn("y", F.explode(F.array(*[F.lit(y) for y in YEARS])))
    s.add(heads, F.col("y") - 1990, F.lit(0), F.col("y"))
    s.add(s.rows, F.col("year") - 1990, place(TYPES, "p_type"), F.format_number("qty", 0))
    names = s.names.withColumn("p", F.explode(F.array(*[F.lit(p) for p in TYPES])))
    return s.add(names, F.lit(2), place(TYPES, "p"), header).constant(2, 0, "Year")


@query(
    "grid_years_down", "R19 C05", digest_sql("1.1.2", "qty", "production", "ktoe", row_label="CASE p_type WHEN 'PROMO' THEN 'Gas' WHEN 'SMALL' THEN 'Gas__1' ELSE p_type END")
    + " UNION ALL " + digest_sql("1.1.3", "qty", "share", "x", row_label="p_type || ' Percentage'").replace("'share' AS metric_name", "'share_' || lower(p_type) || '_percentage' AS metric_name").replace("'x' AS unit", "'percent' AS unit"),
)
def grid_years_down(t):
    repeated = F.when(F.col("p").isin("PROMO", "SMALL"), "Gas").otherwise(F.col("p"))
    plain = grid.years_down(
        year_rows_cells(t, repeated).cells(), table="1.1.2", header_row=2, data_start=3, metric_name="production", unit="ktoe"
    )
    derived = grid.years_down(
        year_rows_cells(t, F.concat("p", F.lit(" Percentage"))).cells(), table="1.1.3", header_row=2, data_start=3, metric_prefix="share"
    )
    return plain.unionByName(derived)


@query(
    "grid_typed_tables", "R18 R19 C31 G18", """
SELECT year, 'fuels' AS source, p_type || ' x' AS label, qty AS value, qty * 11.63::DOUBLE AS twh FROM sheet_values
UNION ALL SELECT year, 'final', p_type, qty, qty * 0.01163::DOUBLE FROM sheet_values
UNION ALL SELECT year, 'spend', 'industry', qty, qty FROM sheet_values WHERE p_type = 'STANDARD'
UNION ALL SELECT year, 'primary', 'a', qty, qty * 11.63::DOUBLE FROM sheet_values WHERE p_type = 'STANDARD'
""",
)
def grid_typed_tables(t):
    across = Sheets(t, t["sheet_values"]).years(3).labels(5).values(5, "qty").cells()
    fuels = grid.primary_fuels(across, header_row=3, data_start=4)
    down = year_rows_cells(t, F.col("p")).cells()
    one_sheet = down.withColumn("source_file", F.concat_ws(":", "source_file", "sheet")).withColumn("sheet", F.lit("1.1.5"))
    final = grid.final_consumption(one_sheet, header_row=2, data_start=3, sectors={"1.1.5": "industry"})
    names = F.when(F.col("p") == "STANDARD", "Total industry (GBP m)").otherwise("other")
    spend = grid.expenditure(year_rows_cells(t, names).cells(), header_row=2, data_start=3)
    primary = grid.primary_consumption(down, data_start=3)
    parts = [
        fuels.select("year", F.lit("fuels").alias("source"), F.col("fuel_type").alias("label"), F.col("consumption_mtoe").alias("value"), (F.col("consumption_mtoe") * 11.63).alias("twh")),
        final.select("year", F.lit("final").alias("source"), F.col("fuel_type").alias("label"), F.col("energy_ktoe").alias("value"), F.col("energy_twh").alias("twh")),
        spend.select("year", F.lit("spend").alias("source"), F.col("sector").alias("label"), F.col("expenditure_million_gbp").alias("value"), F.col("expenditure_million_gbp").alias("twh")),
        primary.select("year", F.lit("primary").alias("source"), F.lit("a").alias("label"), F.col("primary_energy_mtoe").alias("value"), F.col("primary_energy_twh").alias("twh")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "grid_embedded_years", "R20 C40", digest_sql("5.2", "qty", "supply", "GWh", column_label="'Public system'"),
)
def grid_embedded_years(t):
    s = Sheets(t, t["sheet_values"]).labels(5).values(5, "qty").constant(4, 0, "Table 5.2 again").constant(4, 1, "3")
    heads = s.names.withColumn("y", F.explode(F.array(*[F.lit(y) for y in YEARS])))
    s.add(heads, F.lit(2), F.col("y") - 1994, F.concat(F.lit("Public system ("), F.col("y"), F.lit(")")))
    return grid.embedded_years(s.cells(), table="5.2", header_row=2, data_start=3, metric_name="supply", unit="GWh")


@query(
    "grid_register", "R21", """
SELECT '5.11' AS dukes_table, 2024 AS period_year, 'stations' AS period_label, s_name || ' | ' || s_suppkey AS row_label, h AS column_label, 'register' AS metric_name, v AS value,
       CASE WHEN v IS NULL THEN 'text' ELSE 'MW' END AS unit, 'f' AS source_file, CASE WHEN v IS NULL THEN w END AS value_text
FROM (SELECT s_name, s_suppkey, 'Capacity' AS h, CAST(s_nationkey AS DOUBLE) AS v, NULL AS w FROM supplier UNION ALL SELECT s_name, s_suppkey, 'Country', NULL, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
""",
)
def grid_register(t):
    rows = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).withColumns(
        {"sheet": F.lit("stations"), "r": F.col("s_suppkey") + 5}
    )
    s = Sheets(t, rows).constant(3, 2, "Capacity").constant(3, 3, "Country")
    s.add(rows, F.col("r"), F.lit(0), F.col("s_name")).add(rows, F.col("r"), F.lit(1), F.col("s_suppkey"))
    s.add(rows, F.col("r"), F.lit(2), F.col("s_nationkey")).add(rows, F.col("r"), F.lit(3), F.col("n_name"))
    return grid.register_listing(
        s.cells(), table="5.11", header_row=3, data_start=4, metric_name="register", unit="MW", label_cols=(0, 1), snapshot_year=2024
    )


@query(
    "grid_totals_then_years", "R22", digest_sql("F.2", "n", "wells", "n") + " UNION ALL "
    + digest_sql("F.2", "SUM(n)", "wells_cumulative_series", "n", period_year="CAST(NULL AS INT)", period_label="'To 1994'", column_label="'To 1994'") + " GROUP BY sheet, p_type",
)
def grid_totals_then_years(t):
    s = Sheets(t, t["sheet_values"]).constant(2, 1, "To 1994").years(2, 2).labels(3).values(3, "n", 2)
    sums = s.rows.groupBy("sheet", "p_type").agg(F.sum("n").alias("n"))
    s.add(sums, 2 + place(TYPES, "p_type"), F.lit(1), text(F.col("n")))
    return grid.totals_then_years(s.cells(), table="F.2", header_row=2, data_start=3, metric_name="wells", unit="n")


@query(
    "grid_trade_blocks", "R23", digest_sql("6.6", "qty", "trade_tonnes", "tonnes", column_label="sheet || '|imports'") + " UNION ALL " + digest_sql("6.6", "n", "trade_tonnes", "tonnes", column_label="sheet || '|exports'"),
)
def grid_trade_blocks(t):
    s = Sheets(t, t["sheet_values"]).constant(1, 0, "Imports (tonnes)").years(1).labels(2).values(2, "qty")
    s.constant(10, 0, "Exports (tonnes)").years(10).labels(11).values(11, "n").constant(18, 0, "Source: customs").constant(18, 1, "5")
    return grid.trade_blocks(s.cells(), table="6.6")


@query(
    "grid_snapshot_counts", "R24", """
SELECT '6.7' AS dukes_table, 2024 AS period_year, NULL AS period_label, p_type || ' x' AS row_label, CASE year WHEN 1997 THEN 'col_3' ELSE 'Band ' || year END AS column_label, 'station_count' AS metric_name,
       CAST(n AS DOUBLE) AS value, 'count' AS unit, 'f' AS source_file, NULL AS value_text FROM sheet_values
""",
)
def grid_snapshot_counts(t):
    s = Sheets(t, t["sheet_values"]).labels(3).values(3, "n")
    heads = s.names.withColumn("y", F.explode(F.array(*[F.lit(y) for y in YEARS if y != 1997])))
    s.add(heads, F.lit(2), F.col("y") - 1994, F.concat(F.lit("Band "), F.col("y")))
    return grid.snapshot_counts(s.cells(), table="6.7", header_row=2, data_start=3, snapshot_year=2024)


def flow_cells(t) -> DataFrame:
    s = Sheets(t, t["sheet_values"]).constant(0, 0, "Physical flows 2021")
    heads = s.names.withColumn("y", F.explode(F.array(*[F.lit(y) for y in YEARS])))
    s.add(heads, F.lit(3), 4 + (F.col("y") - 1995) * 2, F.concat(F.lit("I"), F.col("y")))
    s.add(heads, F.lit(3), 5 + (F.col("y") - 1995) * 2, F.lit("flag"))
    names = s.names.withColumn("p", F.explode(F.array(*[F.lit(p) for p in TYPES])))
    at = 5 + place(TYPES, "p")
    s.add(names, at, F.lit(0), place(TYPES, "p")).add(names, at, F.lit(1), F.lit(2))
    s.add(names, at, F.lit(2), F.left("p", F.lit(2))).add(names, at, F.lit(3), F.col("p"))
    s.add(s.rows, 5 + place(TYPES, "p_type"), 4 + (F.col("year") - 1995) * 2, text(F.col("qty")))
    return s.add(s.rows, 5 + place(TYPES, "p_type"), 5 + (F.col("year") - 1995) * 2, F.lit("1")).cells()


_ORDER = "CASE p_type " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(TYPES, 1)) + " END"


@query(
    "grid_flow_matrix", "R25 C40 G19", f"""
SELECT 2021 AS reference_year, 'A' AS table_id, {_ORDER} AS row_no, 2 AS row_level, left(p_type, 2) AS row_code, p_type AS row_label, CAST(4 + (year - 1995) * 2 AS INT) AS industry_col,
       'I' || year AS industry_code, qty AS energy_tj, 'f' AS source_file FROM sheet_values
UNION ALL SELECT 2021, 'D', {_ORDER}, NULL, left(p_type, 2), p_type, CAST(4 + (year - 1995) * 2 AS INT), 'I' || year, qty, 'f' FROM sheet_values
""",
)
def grid_flow_matrix(t):
    cells = flow_cells(t)
    layout = {"header_row": 3, "data_start": 5, "first_col": 4, "step": 2}
    return grid.flow_matrix(cells, table_id="A", **layout).unionByName(grid.flow_indicators(cells, table_id="D", **layout))


@query(
    "grid_flow_bridge", "R25", f"""
SELECT 2021 AS reference_year, left(p_type, 2) AS bridge_code, p_type AS bridge_label, CAST(SUM(n) AS DOUBLE) AS energy_tj, 'f' AS source_file FROM sheet_values GROUP BY sheet, p_type
""",
)
def grid_flow_bridge(t):
    s = Sheets(t, t["sheet_values"]).constant(0, 0, "Bridge 2021")
    sums = s.rows.groupBy("sheet", "p_type").agg(F.sum("n").alias("n"))
    at = 5 + place(TYPES, "p_type")
    s.add(sums, at, F.lit(0), F.left("p_type", F.lit(2))).add(sums, at, F.lit(1), F.col("p_type")).add(sums, at, F.lit(2), text(F.col("n")))
    s.constant(6 + len(TYPES), 0, "Notes").constant(7 + len(TYPES), 0, "ME").constant(7 + len(TYPES), 2, "1")  # behind the notes: no data
    return grid.flow_bridge(s.cells(), data_start=5)


@query(
    "matrix_share_of_total", "R26", """
SELECT CAST(year AS INT) AS year, fuel AS sic_code, 'Industry ' || fuel AS industry_name, 'CPA_' || p_type || ' x' AS commodity, qty / SUM(qty) OVER (PARTITION BY year, fuel) AS intermediate_consumption_share, qty AS intermediate_consumption_value
FROM type_nation_year
""",
)
def matrix_share_of_total(t):
    rows = t["type_nation_year"].withColumn("sheet", F.concat(F.lit("Table 2 - Int Con "), F.col("year")))
    s = Sheets(t, rows)
    heads = s.names.withColumn("fuel", F.explode(F.array(*[F.lit(n) for n in NATIONS])))
    col = place(NATIONS, "fuel") + 1
    s.add(heads, F.lit(3), col, F.col("fuel")).add(heads, F.lit(4), col, F.concat(F.lit("Industry "), F.col("fuel")))
    names = s.names.withColumn("p", F.explode(F.array(*[F.lit(p) for p in TYPES])))
    s.add(names, 4 + place(TYPES, "p"), F.lit(0), F.concat(F.lit("CPA_"), F.col("p"), F.lit("  x")))
    s.add(rows, 4 + place(TYPES, "p_type"), col, text(F.col("qty")))
    sums = rows.groupBy("sheet", "fuel").agg(F.sum("qty").alias("qty"))
    s.constant(100, 1, "Total intermediate consumption at purchasers' prices").add(sums, F.lit(100), col, text(F.col("qty")))
    return grid.supply_use_shares(s.cells())
