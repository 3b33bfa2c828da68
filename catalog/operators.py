"""Operator-level queries straight on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bound import STATUS_COMMODITY, TYPE_FUELS
from catalog.engine import QUARTER, YEAR, bind, case, cents, query, total
from metricmart.functions import labels as L
from metricmart.functions import numeric as N
from metricmart.functions import periods as P
from metricmart.functions.documents import first_field, variant_has_keys, with_fields
from metricmart.operators import aggregates as A
from metricmart.operators import conform as C
from metricmart.operators import dimensions as D
from metricmart.operators import filters, joins, pivot, ranking, windows
from metricmart.operators import upsert as U
from metricmart.operators.dictionary import with_resolved
from metricmart.operators.quantiles import exact_quantiles
from metricmart.plans import staging
from metricmart.sources import landing, pages
from metricmart.sources.literals import literal_table

# --- bound tables of this module ---------------------------------------------------------------------------------

bind("order_year", f"""
SELECT {YEAR} AS year, n_name AS nation, COUNT(*) AS n, {total('o_totalprice')} / 1000 AS spend
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY {YEAR}, n_name
""")
bind("line_metrics", f"""
SELECT {YEAR} AS year, s_name AS company_name, {case('s_nationkey', {i: ['ET', 'ED', 'GT', 'GD'][i % 4] for i in range(25)})} AS network_sector,
       l_returnflag AS flag, {total('l_quantity')} AS quantity, {total('l_extendedprice')} AS price, {total('l_discount')} AS discount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY {YEAR}, s_name, s_nationkey, l_returnflag
""")
bind("alias_rows", """
SELECT CASE WHEN s_acctbal < 8000 THEN 'Supplier#' ELSE 'Unlisted#' END || substr(s_name, 10) AS source_company_name, 'Group ' || substr(s_name, 18, 1) AS company_name,
       CASE WHEN s_acctbal < 3000 THEN 'ET' WHEN s_acctbal < 6000 THEN 'ED' END AS network_sector_code, s_suppkey AS position
FROM supplier
""")


# --- aggregation -------------------------------------------------------------------------------------------------


@query(
    "part_plus_total", "A11 G09", f"""
SELECT {YEAR} AS year, COALESCE(o_orderstatus, 'TOTAL') AS status, SUM(o_totalprice) AS value, o_orderstatus IS NULL AS is_total
FROM orders GROUP BY GROUPING SETS (({YEAR}, o_orderstatus), ({YEAR}))
""", d2=["value"],
)
def part_plus_total(t):
    rows = t["orders"].select(
        F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("value")
    )
    return A.parts_and_totals(rows, ["year"], "status", "value")


@query(
    "share_of_positive_parts", "W02 M01 C30", """
SELECT s_nationkey, s_name, s_acctbal, GREATEST(s_acctbal, 0) / NULLIF(SUM(GREATEST(s_acctbal, 0)) OVER (PARTITION BY s_nationkey), 0) AS share
FROM supplier
""", d9=["share"],
)
def share_of_positive_parts(t):
    rows = t["supplier"].select("s_nationkey", "s_name", "s_acctbal")
    return windows.positive_shares(rows, ["s_nationkey"], "s_acctbal", "s_name")


bind("type_share", f"""
SELECT {YEAR} AS year, l_linestatus AS market, p_type, {total('l_extendedprice')} AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY {YEAR}, l_linestatus, p_type
""")
bind("type_share_pct", """
SELECT f.year, f.market, f.p_type, 100 * f.price / t.price AS share_pct, f.price / t.price AS share FROM type_share f
JOIN (SELECT year, market, SUM(price) AS price FROM type_share GROUP BY year, market) t ON t.year = f.year AND t.market = f.market
""")


@query(
    "hhi_0_1_mean", "A08 Q37", """
SELECT year, AVG(h) AS hhi_0_1 FROM (SELECT year, market, SUM(POWER(share_pct / 100, 2)) AS h FROM type_share_pct GROUP BY 1, 2) GROUP BY 1
""", d9=["hhi_0_1"],
)
def hhi_0_1_mean(t):
    return A.mean_concentration(t["type_share_pct"], "year", "market", "share_pct")


@query(
    "hhi_0_10000", "A09 C33 Q16", """
SELECT year, market, SUM(POWER(CASE WHEN m <= 1 THEN 100 * share ELSE share END, 2)) AS hhi_0_10000
FROM (SELECT *, MAX(share) OVER (PARTITION BY year, market) AS m FROM type_share_pct) GROUP BY 1, 2
""", d6=["hhi_0_10000"],
)
def hhi_0_10000(t):
    return A.concentration_10000(t["type_share_pct"], ["year", "market"], "share")


@query(
    "daily_monitor_raw", "M19 A05 A06 A07", """
WITH p AS (SELECT event_type, user_id, quantile_cont(value, 0.95) AS q FROM events GROUP BY ALL)
SELECT e.event_type, e.user_id, COUNT(*) AS observation_count, CAST(MIN(ts) AS DATE) AS first_observation_date,
       CAST(MAX(ts) AS DATE) AS last_observation_date, AVG(value) AS avg_daily_value, MIN(value) AS min_daily_value,
       MAX(value) AS max_daily_value, STDDEV_POP(value) AS volatility_stddev, COUNT(*) FILTER (WHERE value >= q) AS spike_days_ge_p95
FROM events e JOIN p ON p.event_type = e.event_type AND p.user_id = e.user_id GROUP BY 1, 2
""", d6=["avg_daily_value", "volatility_stddev"],
)
def daily_monitor_raw(t):
    rows = t["events"].withColumn("day", F.col("ts").cast("date"))
    return A.monitor(rows, ["event_type", "user_id"], "day", "value")


@query(
    "exact_percentiles", "A06 A18", """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q25, quantile_cont(l_extendedprice, 0.5) AS median,
       quantile_cont(l_extendedprice, 0.99) AS q99 FROM lineitem GROUP BY 1
""", d6=["q25", "median", "q99"],
)
def exact_percentiles(t):
    return exact_quantiles(t["lineitem"], ["l_returnflag"], "l_extendedprice", {"q25": 0.25, "median": 0.5, "q99": 0.99})


@query(
    "mean_median", "A18", "SELECT AVG(value) AS mean, quantile_cont(value, 0.5) AS median FROM events", d6=["mean", "median"],
)
def mean_median(t):
    median = exact_quantiles(t["events"], [], "value", {"m": 0.5}).select("m").scalar()
    return t["events"].agg(F.avg("value").alias("mean")).withColumn("median", median)


@query(
    "count_distinct_filtered", "A03 A04", f"""
SELECT {YEAR} AS year, COUNT(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F') AS filled_customers,
       COUNT(DISTINCT o_custkey) AS customers, MIN(o_totalprice) AS low, MAX(o_totalprice) AS high FROM orders GROUP BY 1
""",
)
def count_distinct_filtered(t):
    filled = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    return t["orders"].groupBy(F.year("o_orderdate").alias("year")).agg(
        F.countDistinct(filled).alias("filled_customers"), F.countDistinct("o_custkey").alias("customers"),
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
    )


@query(
    "dedupe_average", "A12 A21", """
SELECT l_orderkey, l_linenumber, AVG(l_quantity) AS l_quantity, MIN(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2
""", d6=["l_quantity"],
)
def dedupe_average(t):
    return A.dedupe_average(t["lineitem"], ["l_orderkey", "l_linenumber"], "l_quantity", ["l_returnflag"])


@query(
    "having_duplicates", "A13 D03", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
""",
)
def having_duplicates(t):
    from metricmart.operators.quality import duplicates

    return duplicates(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "coverage_by_year", "A15 P06", f"""
SELECT {YEAR} AS year, COUNT(*) AS rows, COUNT(q) AS rows_with_value, AVG(q) AS avg_value, 100.0 * COUNT(q) / COUNT(*) AS coverage_pct
FROM (SELECT o_orderdate, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS q FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1
""", d6=["avg_value", "coverage_pct"],
)
def coverage_by_year(t):
    joined = t["orders"].join(t["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"), "left")
    value = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    return A.coverage(joined.select(F.year("o_orderdate").alias("year"), value.alias("q")), ["year"], "q")


_FACTORS = {
    "offshore_wind": 11, "solar": 45, "gas": 400, "coal": 850, "pumped_storage": 120, "biomass": 120,
}


@query(
    "weighted_intensity", "A16 C37 P12", f"""
SELECT year, SUM(value * {case('fuel', _FACTORS)}) / SUM(value) AS kg_co2_per_mwh
FROM (SELECT {YEAR} AS year, {case('p_type', TYPE_FUELS)} AS fuel, SUM(l_quantity) AS value
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1
""", d6=["kg_co2_per_mwh"],
)
def weighted_intensity(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey")
    )
    fuel = L.classify(F.col("p_type"), {k: v.replace("_", " ").title() for k, v in TYPE_FUELS.items()})
    mix = rows.groupBy(F.year("o_orderdate").alias("year"), fuel.alias("fuel")).agg(F.sum("l_quantity").alias("twh"))
    return A.emission_intensity(mix, ["year"], "fuel", "twh")


@query(
    "renewable_share_like", "A17 C25 C24", f"""
SELECT {YEAR} AS year, 100 * SUM(l_quantity) FILTER (WHERE lower(p_type) LIKE '%small%' OR lower(p_type) LIKE '%promo%') / NULLIF(SUM(l_quantity), 0) AS share_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1
""", d9=["share_pct"],
)
def renewable_share_like(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey")
    )
    matching = L.like_any(F.col("p_type"), ["%small%", "%promo%"])
    return A.share_of_matching(rows.withColumn("year", F.year("o_orderdate")), ["year"], "l_quantity", matching)


@query(
    "first_last_change", "A22 C39", """
SELECT nation, arg_min(spend, year) AS first_value, arg_max(spend, year) AS last_value,
       (arg_max(spend, year) - arg_min(spend, year)) / abs(arg_min(spend, year)) * 100 AS change_pct FROM order_year GROUP BY 1
""",
)
def first_last_change(t):
    return A.first_and_last(t["order_year"], ["nation"], "year", "spend")


@query(
    "null_rates", "A20 D10", """
SELECT 'o_orderkey' AS column_name, AVG((o_orderkey IS NULL)::INT) AS null_rate FROM orders
UNION ALL SELECT 'l_orderkey', AVG((l_orderkey IS NULL)::INT) FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""", d9=["null_rate"],
)
def null_rates(t):
    rows = t["orders"].select("o_orderkey").join(
        t["lineitem"].select("l_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    left = A.null_rates(rows).filter("column_name = 'l_orderkey'")
    return left.unionByName(A.null_rates(t["orders"].select("o_orderkey")))


# --- windows -----------------------------------------------------------------------------------------------------


@query(
    "running_total", "W06 M07", """
SELECT nation, year, spend, SUM(spend) OVER (PARTITION BY nation ORDER BY year ROWS UNBOUNDED PRECEDING) AS cumulative FROM order_year
""", d5=["cumulative"],
)
def running_total(t):
    rows = t["order_year"].select("nation", "year", "spend")
    return windows.with_running_totals(rows, ["nation"], "year", {"cumulative": "spend"})


@query(
    "running_total_blocks", "W06 W03", f"""
SELECT o_orderstatus, o_orderkey, {cents('o_totalprice')} AS cents, CAST(SUM({cents('o_totalprice')}) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far,
       LAG({cents('o_totalprice')}) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS before
FROM orders
""",
)
def running_total_blocks(t):
    # Three entities hold all rows: scanned in blocks of the key, no task sees a whole entity.
    rows = t["orders"].select("o_orderstatus", "o_orderkey", F.expr(cents("o_totalprice")).alias("cents"))
    return windows.block_scan(rows, ["o_orderstatus"], "o_orderkey", lags={"before": "cents"}, totals={"so_far": "cents"}, width=1024)


@query(
    "running_total_all", "W06", f"""
SELECT o_orderkey, CAST(SUM({cents('o_totalprice')}) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM orders
""",
)
def running_total_all(t):
    rows = t["orders"].select("o_orderkey", F.expr(cents("o_totalprice")).alias("so_far_of"))
    return windows.with_running_totals(rows, [], "o_orderkey", {"so_far": "so_far_of"}).select("o_orderkey", "so_far")


@query(
    "yoy_lag", "W03", """
WITH y AS (SELECT year, SUM(n) AS n FROM order_year GROUP BY 1)
SELECT year, CAST(n AS BIGINT) AS n, CAST(n - LAG(n) OVER (ORDER BY year) AS BIGINT) AS change FROM y
""",
)
def yoy_lag(t):
    yearly = t["order_year"].groupBy("year").agg(F.sum("n").alias("n"))
    return windows.with_changes(yearly, [], "year", {"change": "n"})


@query(
    "lag_of_sum", "W05 M06", f"""
SELECT {YEAR} AS year, o_orderstatus, COUNT(*) AS n, COUNT(*) - LAG(COUNT(*)) OVER (PARTITION BY o_orderstatus ORDER BY {YEAR}) AS change
FROM orders GROUP BY 1, 2
""",
)
def lag_of_sum(t):
    yearly = t["orders"].groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"))
    return windows.with_changes(yearly, ["o_orderstatus"], "year", {"change": "n"})


@query(
    "delta_ratio", "W07", """
SELECT nation, year, spend - LAG(spend) OVER w AS spend_delta, n - LAG(n) OVER w AS n_delta,
       (spend - LAG(spend) OVER w) / NULLIF(n - LAG(n) OVER w, 0) AS spend_per_order
FROM order_year WINDOW w AS (PARTITION BY nation ORDER BY year)
""",
)
def delta_ratio(t):
    rows = windows.change_per_change(t["order_year"], ["nation"], "year", "spend", "n", "spend_per_order")
    return rows.select("nation", "year", "spend_delta", "n_delta", "spend_per_order")


@query(
    "entity_lag", "W04 Q28", """
SELECT company_name, year, q, LAG(q) OVER (PARTITION BY company_name ORDER BY year) AS before
FROM (SELECT company_name, year, SUM(quantity) AS q FROM line_metrics GROUP BY 1, 2)
""",
)
def entity_lag(t):
    rows = t["line_metrics"].groupBy("company_name", "year").agg(F.sum("quantity").alias("q"))
    return windows.with_lags(rows, ["company_name"], "year", {"before": "q"})


@query(
    "allocate_by_share", "W01 M03 C29", """
SELECT nation, f.year, f.spend, t.total, f.spend / NULLIF(SUM(f.spend) OVER (PARTITION BY f.year), 0) AS share_of_total,
       t.total * (f.spend / NULLIF(SUM(f.spend) OVER (PARTITION BY f.year), 0)) AS allocated
FROM order_year f JOIN (SELECT year, CAST(SUM(n) AS DOUBLE) AS total FROM order_year GROUP BY 1) t ON t.year = f.year
""", d9=["share_of_total"], d6=["allocated"],
)
def allocate_by_share(t):
    totals = t["order_year"].groupBy("year").agg(F.sum("n").cast("double").alias("total"))
    parts = t["order_year"].select("nation", "year", "spend")
    return windows.allocate(parts, totals, ["year"], "spend", "total")


# --- ranking -----------------------------------------------------------------------------------------------------


@query(
    "topk", "T02 T04", "SELECT company_name, SUM(price) AS price FROM line_metrics GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", d2=["price"],
)
def topk(t):
    sums = t["line_metrics"].groupBy("company_name").agg(F.sum("price").alias("price"))
    return ranking.top_n(sums, "price", 10, ["company_name"])


@query(
    "topk_entities_all_rows", "T03 J16 Q38", """
SELECT * FROM line_metrics WHERE company_name IN (SELECT company_name FROM line_metrics GROUP BY 1 ORDER BY SUM(quantity) DESC, 1 LIMIT 7)
""",
)
def topk_entities_all_rows(t):
    return ranking.top_entities(t["line_metrics"], ["company_name"], F.sum("quantity"), 7)


@query(
    "leaderboard_rank", "W11", """
SELECT s_name, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_name) AS rank
FROM (SELECT s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_name LIMIT 20)
""",
)
def leaderboard_rank(t):
    return ranking.leaderboard(t["supplier"], "s_name", "s_acctbal")


@query(
    "zscore_rank", "W12 Q09 T02", """
WITH m AS (SELECT company_name, AVG(quantity) AS q, AVG(discount) AS d FROM line_metrics GROUP BY 1),
 s AS (SELECT AVG(q) AS mq, STDDEV_POP(q) AS sq, AVG(d) AS md, STDDEV_POP(d) AS sd FROM m)
SELECT company_name, q, d, (q - mq) / sq - (d - md) / sd AS score FROM m, s ORDER BY 4 DESC LIMIT 10
""", d6=["q", "d", "score"],
)
def zscore_rank(t):
    means = t["line_metrics"].groupBy("company_name").agg(F.avg("quantity").alias("q"), F.avg("discount").alias("d"))
    scored = ranking.composite_score(means, {"q": 1.0, "d": -1.0})
    return ranking.top_n(scored, "score", 10, ["company_name"])


@query(
    "underperformers", "P05 W12", """
WITH m AS (SELECT s_nationkey, AVG(s_acctbal) AS rore, AVG(CASE WHEN s_acctbal > 2000 THEN s_suppkey END) AS ens, AVG(CASE WHEN s_acctbal < 1000 THEN s_acctbal END) AS sat FROM supplier GROUP BY 1),
 f AS (SELECT s_nationkey, rore, COALESCE(ens, (SELECT quantile_cont(ens, 0.5) FROM m)) AS ens, COALESCE(sat, (SELECT quantile_cont(sat, 0.5) FROM m)) AS sat FROM m),
 s AS (SELECT AVG(rore) a, STDDEV_POP(rore) b, AVG(ens) c, STDDEV_POP(ens) d, AVG(sat) e, STDDEV_POP(sat) g FROM f)
SELECT s_nationkey, rore, ens, sat, (rore - a) / b + (ens - c) / d - (sat - e) / g AS bad FROM f, s ORDER BY bad DESC LIMIT 3
""", d6=["rore", "ens", "sat", "bad"],
)
def underperformers(t):
    b = F.col("s_acctbal")
    means = t["supplier"].groupBy("s_nationkey").agg(
        F.avg(b).alias("rore"), F.avg(F.when(b > 2000, F.col("s_suppkey"))).alias("ens"),
        F.avg(F.when(b < 1000, b)).alias("sat"),
    )
    filled = ranking.median_filled(means, ["rore", "ens", "sat"])
    return ranking.top_n(ranking.composite_score(filled, {"rore": 1, "ens": 1, "sat": -1}, "bad"), "bad", 3, ["s_nationkey"])


# --- joins -------------------------------------------------------------------------------------------------------


@query(
    "null_safe_full_outer", "J06 M10 M11", f"""
WITH a AS (SELECT {case('o_orderstatus', {'O': 'O', 'F': 'F'})} AS k, {QUARTER} AS q, COUNT(*) AS orders FROM orders GROUP BY ALL),
 b AS (SELECT {case('l_linestatus', {'O': 'O'})} AS k, CAST(CASE quarter(l_shipdate) WHEN 4 THEN 9 ELSE quarter(l_shipdate) END AS INT) AS q, COUNT(*) AS lines FROM lineitem GROUP BY ALL)
SELECT COALESCE(a.k, b.k) AS k, COALESCE(a.q, b.q) AS q, orders, lines FROM a FULL OUTER JOIN b ON a.k IS NOT DISTINCT FROM b.k AND a.q IS NOT DISTINCT FROM b.q
""",
)
def null_safe_full_outer(t):
    k = F.when(F.col("o_orderstatus").isin("O", "F"), F.col("o_orderstatus"))
    a = t["orders"].groupBy(k.alias("k"), F.quarter("o_orderdate").alias("q")).agg(F.count("*").alias("orders"))
    k = F.when(F.col("l_linestatus") == "O", F.lit("O"))
    quarter = F.when(F.quarter("l_shipdate") == 4, F.lit(9)).otherwise(F.quarter("l_shipdate"))
    b = t["lineitem"].groupBy(k.alias("k"), quarter.alias("q")).agg(F.count("*").alias("lines"))
    return joins.null_safe_join(a, b, ["k", "q"], "full_outer")


@query(
    "null_safe_left", "J07 F07", """
WITH a AS (SELECT NULLIF(o_orderstatus, 'P') AS k, COUNT(*) AS n FROM orders GROUP BY 1),
 b AS (SELECT NULLIF(l_linestatus, 'O') AS k, COUNT(*) AS m FROM lineitem GROUP BY 1)
SELECT a.k, n, m FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k
""",
)
def null_safe_left(t):
    a = t["orders"].groupBy(F.nullif("o_orderstatus", F.lit("P")).alias("k")).agg(F.count("*").alias("n"))
    b = t["lineitem"].groupBy(F.nullif("l_linestatus", F.lit("O")).alias("k")).agg(F.count("*").alias("m"))
    return joins.null_safe_join(a, b, ["k"], "left")


PERIODS = [
    ("P1", ["AFRICA", "ASIA"], 1995, 1997), ("P2", ["AMERICA"], 1996, 1999), ("P3", ["ASIA", "EUROPE"], 1998, 2000),
]


@query(
    "member_interval_join", "J08 M02 U11", """
SELECT o.o_orderkey, r.r_name, CAST(year(o_orderdate) AS INT) AS year, p.scheme, p.start_year, p.end_year
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (VALUES ('P1', ['AFRICA', 'ASIA'], 1995, 1997), ('P2', ['AMERICA'], 1996, 1999), ('P3', ['ASIA', 'EUROPE'], 1998, 2000)) p(scheme, members, start_year, end_year)
  ON list_contains(p.members, r.r_name) AND year(o_orderdate) BETWEEN p.start_year AND p.end_year
""",
)
def member_interval_join(t):
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    rows = t["orders"].join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("o_orderkey", "r_name", F.year("o_orderdate").alias("year"))
    periods = literal_table(t.spark, PERIODS, "scheme string, network_sectors array<string>, start_year int, end_year int")
    return joins.member_interval_join(rows, periods, "r_name", "year")


@query(
    "member_interval_days", "J08", """
SELECT o.o_orderkey, p.o_custkey AS since_customer, p.first_day, p.last_day FROM (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day FROM orders) o
JOIN (SELECT o_custkey, list(DISTINCT o_orderstatus) AS statuses, MIN(CAST(o_orderdate AS DATE) - DATE '1970-01-01') AS first_day, MIN(CAST(o_orderdate AS DATE) - DATE '1970-01-01') + 2 AS last_day FROM orders GROUP BY 1) p
  ON list_contains(p.statuses, o.o_orderstatus) AND o.day BETWEEN p.first_day AND p.last_day
""",
)
def member_interval_days(t):
    # As many intervals as customers under three members: what meets is decided by member and bin of the day axis.
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    rows = t["orders"].select("o_orderkey", "o_orderstatus", day.alias("day"))
    periods = t["orders"].groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("statuses"), F.min(day).alias("first_day"))
    periods = periods.withColumn("last_day", F.col("first_day") + 2)
    tasks = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    found = joins.member_interval_join(
        rows, periods, "o_orderstatus", "day", members="statuses", start="first_day", end="last_day", how="inner", bin_width=1, tasks=tasks
    )
    return found.select("o_orderkey", F.col("o_custkey").alias("since_customer"), "first_day", "last_day")


@query(
    "lateral_first", "J09", """
SELECT o_orderkey, COALESCE(CASE WHEN o_totalprice > 400000 THEN o_totalprice END, f.p) AS value
FROM orders LEFT JOIN (SELECT l_orderkey, MIN(l_extendedprice) AS p FROM lineitem GROUP BY 1) f ON f.l_orderkey = o_orderkey
""",
)
def lateral_first(t):
    rows = t["orders"].select(
        "o_orderkey", F.when(F.col("o_totalprice") > 400000, F.col("o_totalprice")).alias("value")
    )
    other = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("value"))
    return joins.first_match_fill(rows, other, ["o_orderkey"], "value", [F.col("value")])


@query(
    "same_year_else_max", "J10 G02", """
WITH k AS (SELECT DISTINCT company_name, network_sector, year FROM line_metrics),
 r AS (SELECT * REPLACE (CAST(CASE WHEN year < 1999 AND flag = 'A' THEN year ELSE 0 END AS INT) AS year) FROM line_metrics)
SELECT k.*, COALESCE(s.v, a.v) AS quantity FROM k
LEFT JOIN (SELECT year, company_name, network_sector, MAX(quantity) AS v FROM r GROUP BY 1, 2, 3) s USING (year, company_name, network_sector)
LEFT JOIN (SELECT company_name, network_sector, MAX(quantity) AS v FROM r GROUP BY 1, 2) a USING (company_name, network_sector)
""",
)
def same_year_else_max(t):
    keys = t["line_metrics"].select("company_name", "network_sector", "year").distinct()
    known = t["line_metrics"].withColumn("year", F.when(F.expr("year < 1999 and flag = 'A'"), F.col("year")).otherwise(F.lit(0)))
    return joins.same_year_else_max(keys, known, ["company_name", "network_sector"], "quantity")


@query(
    "alias_conform", "J03 J04", """
WITH a AS (SELECT * FROM alias_rows)
SELECT COALESCE((SELECT MAX(company_name) FROM a WHERE source_company_name = m.company_name AND network_sector_code = m.network_sector),
                (SELECT MAX(company_name) FROM a WHERE source_company_name = m.company_name AND network_sector_code IS NULL), m.company_name) AS company_name,
       m.network_sector, m.year, m.flag, m.quantity FROM line_metrics m
""",
)
def alias_conform(t):
    rows = C.resolve_alias(
        t["line_metrics"], t["alias_rows"], "company_name", "source_company_name", "company_name",
        ("network_sector", "network_sector_code"),
    )
    return rows.select("company_name", "network_sector", "year", "flag", "quantity")


@query(
    "canonical_names", "J25 Q22", """
WITH steps AS (SELECT lower(trim(source_company_name)) AS k, company_name, CASE WHEN network_sector_code = 'ED' THEN 1 ELSE 2 END AS s, position FROM alias_rows
               UNION ALL SELECT lower(trim(company_name)), company_name, CASE WHEN network_sector_code = 'ED' THEN 3 ELSE 4 END, position FROM alias_rows),
 best AS (SELECT k, arg_min(company_name, (s, position)) AS c FROM steps GROUP BY k)
SELECT COALESCE(best.c, m.company_name) AS company_name, m.year, SUM(m.quantity) AS quantity
FROM line_metrics m LEFT JOIN best ON best.k = lower(trim(m.company_name)) GROUP BY 1, 2
""",
)
def canonical_names(t):
    lookup = C.canonical_lookup(t["alias_rows"], "ED", "position")
    named = C.with_canonical_name(t["line_metrics"], lookup, "company_name")
    return named.groupBy("company_name", "year").agg(F.sum("quantity").alias("quantity"))


@query(
    "year_spine_join", "J13 M17", f"""
WITH s AS (SELECT DISTINCT {YEAR} AS year FROM orders)
SELECT s.year, a.n AS filled, b.n AS shipped FROM s
LEFT JOIN (SELECT CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) <> 1997 THEN {YEAR} ELSE 0 END AS year, COUNT(*) AS n FROM orders GROUP BY 1) a USING (year)
LEFT JOIN (SELECT CAST(year(l_shipdate) AS INT) AS year, COUNT(*) AS n FROM lineitem GROUP BY 1) b USING (year)
""",
)
def year_spine_join(t):
    year = F.year("o_orderdate").alias("year")
    open_year = F.when(F.expr("o_orderstatus = 'F' and year(o_orderdate) <> 1997"), F.year("o_orderdate")).otherwise(F.lit(0))
    filled = t["orders"].groupBy(open_year.alias("year"))
    shipped = t["lineitem"].groupBy(F.year("l_shipdate").alias("year"))
    return joins.spine_join(
        t["orders"].select(year).distinct(),
        [filled.agg(F.count("*").alias("filled")), shipped.agg(F.count("*").alias("shipped"))], ["year"],
    )


@query(
    "key_universe", "J14 U-B M18", """
WITH a AS (SELECT o_orderstatus AS k, COUNT(*) AS orders FROM orders GROUP BY 1), b AS (SELECT l_linestatus AS k, COUNT(*) AS lines FROM lineitem GROUP BY 1),
 c AS (SELECT l_returnflag AS k, COUNT(*) AS flags FROM lineitem GROUP BY 1), u AS (SELECT k FROM a UNION SELECT k FROM b UNION SELECT k FROM c)
SELECT u.k, orders, lines, flags FROM u LEFT JOIN a ON a.k = u.k LEFT JOIN b ON b.k = u.k LEFT JOIN c ON c.k = u.k
""",
)
def key_universe(t):
    a = t["orders"].groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("orders"))
    b = t["lineitem"].groupBy(F.col("l_linestatus").alias("k")).agg(F.count("*").alias("lines"))
    c = t["lineitem"].groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("flags"))
    return joins.universe_join([a, b, c], ["k"])


@query(
    "semi_filter", "J16 F04", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""",
)
def semi_filter(t):
    big = t["lineitem"].filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t["orders"].select("o_orderkey", "o_orderstatus").join(big, "o_orderkey", "left_semi")


@query(
    "anti_unmatched", "J17 D04", """
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""",
)
def anti_unmatched(t):
    lines = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.unmatched(t["orders"].select("o_orderkey"), lines, ["o_orderkey"])


@query(
    "in_range_else_latest", "J18 J19 Q05", """
SELECT year, nation, n FROM order_year WHERE year = (SELECT MAX(year) FROM order_year)
""",
)
def in_range_else_latest(t):
    return C.in_range_else_latest(t["order_year"].select("year", "nation", "n"), 2013, 2021)


@query("first_nonempty_source", "Q40 Q32", "SELECT year, nation, n FROM order_year")
def first_nonempty_source(t):
    rows = t["order_year"].select("year", "nation", "n")
    return C.first_nonempty([rows.filter("n < 0"), rows, rows.filter("year = 1998")], min_rows=[1, 3, 1])


@query(
    "lagged_pairs", "J20 P10", """
WITH a AS (SELECT company_name, year, SUM(quantity) AS quantity FROM line_metrics WHERE flag = 'A' GROUP BY 1, 2),
 b AS (SELECT company_name, year, AVG(discount) AS discount FROM line_metrics WHERE flag <> 'A' GROUP BY 1, 2)
SELECT a.*, b.discount FROM a JOIN b ON b.company_name = a.company_name AND b.year = a.year + 1
""", d9=["discount"],
)
def lagged_pairs(t):
    m = t["line_metrics"]
    return joins.lagged_pairs(m.filter("flag = 'A'"), m.filter("flag <> 'A'"), "company_name", "quantity", "discount")


@query(
    "lagged_pairs_fallback", "J20 P10", """
WITH a AS (SELECT company_name, year, SUM(quantity) AS quantity FROM line_metrics GROUP BY 1, 2), b AS (SELECT company_name, year, AVG(discount) AS discount FROM line_metrics GROUP BY 1, 2)
SELECT a.*, b.discount FROM a JOIN b USING (company_name, year)
""", d9=["discount"],
)
def lagged_pairs_fallback(t):
    # No pair lies fifty years apart, so the pairs of the same year come back.
    m = t.store("line_metrics", t["line_metrics"])  # both sides of one table: a single pass over lineitem
    return joins.lagged_pairs(m, m, "company_name", "quantity", "discount", shift=50)


@query(
    "outer_merge_fill", "J21", """
WITH a AS (SELECT o_orderstatus AS k, COUNT(*) AS orders FROM orders GROUP BY 1), b AS (SELECT l_returnflag AS k, COUNT(*) AS lines FROM lineitem GROUP BY 1)
SELECT COALESCE(a.k, b.k) AS k, COALESCE(orders, 0) AS orders, COALESCE(lines, 0) AS lines FROM a FULL JOIN b ON a.k = b.k
""",
)
def outer_merge_fill(t):
    a = t["orders"].groupBy(F.col("o_orderstatus").alias("k")).agg(F.count("*").alias("orders"))
    b = t["lineitem"].groupBy(F.col("l_returnflag").alias("k")).agg(F.count("*").alias("lines"))
    return joins.outer_merge_fill(a, b, ["k"], 0)


@query(
    "latest_per_entity", "W10 J22 P11", """
WITH a AS (SELECT company_name, AVG(q) AS quantity FROM (SELECT company_name, year, AVG(quantity) AS q FROM line_metrics GROUP BY 1, 2) GROUP BY 1),
 b AS (SELECT company_name, year, AVG(discount) AS discount FROM line_metrics GROUP BY 1, 2)
SELECT a.company_name, b.year, a.quantity, b.discount FROM a JOIN b ON b.company_name = a.company_name
WHERE b.year = (SELECT MAX(year) FROM b x WHERE x.company_name = b.company_name)
""", d8=["quantity", "discount"],
)
def latest_per_entity(t):
    # Years a century on meet no partner, so every company's mean is paired with its latest value.
    m = t.store("line_metrics", t["line_metrics"])  # both sides of one table: a single pass over lineitem
    left = m.withColumn("year", F.col("year") + 100)
    return joins.pair_or_latest(left, m, "company_name", "quantity", "discount")


@query(
    "latest_snapshot", "P14 J19", """
SELECT nation, year, n FROM order_year WHERE year = (SELECT MAX(year) FROM order_year)
""",
)
def latest_snapshot(t):
    return C.latest_only(t["order_year"].select("nation", "year", "n"))


@query(
    "date_dim_lookup", "J02 J05 J24", """
SELECT d.date_id, d.period_label, x.n FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_orderstatus <> 'P' THEN CAST(quarter(o_orderdate) AS INT) END AS quarter, COUNT(*) AS n
 FROM orders GROUP BY 1, 2) x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NOT DISTINCT FROM x.quarter
""",
)
def date_dim_lookup(t):
    from types import SimpleNamespace

    from metricmart.plans.core import dated

    quarter = F.when(F.col("o_orderstatus") != "P", F.quarter("o_orderdate"))
    rows = t["orders"].groupBy(F.year("o_orderdate").alias("year"), quarter.alias("quarter")).agg(F.count("*").alias("n"))
    dates = D.date_dimension(t.spark)
    named = dated(rows, SimpleNamespace(dates=dates)).join(dates.select("date_id", "period_label"), "date_id")
    return named.select("date_id", "period_label", "n")


@query(
    "constant_row_join", "J11 J12", """
SELECT year, nation, n, CAST(0 AS BIGINT) AS geography_id FROM order_year
""",
)
def constant_row_join(t):
    from types import SimpleNamespace

    from metricmart.plans.core import at_home

    return at_home(t["order_year"].select("year", "nation", "n"), SimpleNamespace(geographies=t["core_dim_geography"]))


@query(
    "denormalise_left", "M13 M14 J02 J23", """
SELECT o_orderkey, c_name, n_name, o_totalprice FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
""",
)
def denormalise_left(t):
    rows = t["orders"].join(t["customer"], F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "o_orderkey", "c_name", "n_name", "o_totalprice"
    )


# --- set operations, priority, deduplication ----------------------------------------------------------------------


@query(
    "priority_dedupe", "U-A W08 G01", """
WITH a AS (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT k, CAST(v AS DOUBLE) AS v FROM a UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT k FROM a)
""", d2=["v"],
)
def priority_dedupe(t):
    lines = t["lineitem"].filter("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum("l_extendedprice").alias("v")
    )
    orders = t["orders"].select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    return C.prioritise([lines, orders], ["k"], require=["k"])


@query(
    "keep_first_last", "W08 W09", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1
""",
)
def keep_first_last(t):
    rows = t["orders"].select("o_custkey", "o_orderdate", "o_orderkey")
    first = C.first_per_key(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    last = C.last_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", F.col("o_orderkey").alias("first_order")).join(
        last.select("o_custkey", F.col("o_orderkey").alias("last_order")), "o_custkey"
    )


@query(
    "multi_grain_union", "U-C U-D F09", f"""
SELECT 'status' AS grain, {YEAR} AS year, o_orderstatus AS status, NULL AS nation, COUNT(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'nation', year, NULL, nation, CAST(n AS BIGINT) FROM order_year
UNION ALL SELECT 'year', {YEAR}, NULL, NULL, COUNT(*) FROM orders GROUP BY ALL
""",
)
def multi_grain_union(t):
    year = F.year("o_orderdate").alias("year")
    status = t["orders"].groupBy(year, F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    yearly = t["orders"].groupBy(year).agg(F.count("*").alias("n"))
    shape = [("grain", "string"), ("year", "int"), ("status", "string"), ("nation", "string"), ("n", "bigint")]
    grains = {"status": status, "nation": t["order_year"], "year": yearly}
    return C.union_all([filters.conform(df, shape, grain=g) for g, df in grains.items()])


# --- upserts and surrogate keys -----------------------------------------------------------------------------------

_TARGET = "SELECT c_custkey, NULLIF(c_mktsegment, 'MACHINERY') AS seg, c_acctbal AS bal, c_name AS name FROM customer WHERE c_acctbal < 5000"
_SOURCE = "SELECT c_custkey, NULLIF(c_mktsegment, 'MACHINERY') AS seg, CASE WHEN c_acctbal < 4500 THEN c_acctbal * 2 END AS bal, 'new' AS name FROM customer WHERE c_acctbal > 4000"


def _halves(t):
    seg = F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg")
    c = t["customer"]
    target = c.filter("c_acctbal < 5000").select("c_custkey", seg, F.col("c_acctbal").alias("bal"), F.col("c_name").alias("name"))
    new = F.when(F.col("c_acctbal") < 4500, F.col("c_acctbal") * 2).alias("bal")
    source = c.filter("c_acctbal > 4000").select("c_custkey", seg, new, F.lit("new").alias("name"))
    return target, source


@query(
    "null_safe_upsert", "U01 U02 S08 L12", f"""
WITH t AS ({_TARGET}), s AS ({_SOURCE})
SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.c_custkey = t.c_custkey AND s.seg IS NOT DISTINCT FROM t.seg)
""",
)
def null_safe_upsert(t):
    target, source = _halves(t)
    return U.upsert(target, source, ["c_custkey", "seg"])


@query(
    "upsert_some_columns", "U01 U02", f"""
WITH t AS ({_TARGET}), s AS ({_SOURCE})
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, COALESCE(t.seg, s.seg) AS seg, CASE WHEN s.c_custkey IS NOT NULL THEN s.bal ELSE t.bal END AS bal, t.name
FROM t FULL JOIN s ON s.c_custkey = t.c_custkey AND s.seg IS NOT DISTINCT FROM t.seg
""",
)
def upsert_some_columns(t):
    target, source = _halves(t)
    return U.upsert(target, source.drop("name"), ["c_custkey", "seg"])


@query(
    "upsert_sub_population", "U03 L08", f"""
WITH t AS ({_TARGET}), s AS ({_SOURCE})
SELECT * FROM t WHERE seg IS NOT NULL UNION ALL SELECT * FROM s UNION ALL
SELECT * FROM t WHERE seg IS NULL AND NOT EXISTS (SELECT 1 FROM s WHERE s.c_custkey = t.c_custkey)
""",
)
def upsert_sub_population(t):
    target, source = _halves(t)
    return U.upsert(target, source, ["c_custkey"], only_where=F.col("seg").isNull())


@query(
    "upsert_keep_old", "U05 U10", f"""
WITH t AS ({_TARGET}), s AS ({_SOURCE})
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, COALESCE(t.seg, s.seg) AS seg, COALESCE(s.bal, t.bal) AS bal, COALESCE(s.name, t.name) AS name
FROM t FULL JOIN s ON s.c_custkey = t.c_custkey AND s.seg IS NOT DISTINCT FROM t.seg
""",
)
def upsert_keep_old(t):
    target, source = _halves(t)
    return U.upsert(target, source, ["c_custkey", "seg"], keep_old_when_null=True)


@query(
    "insert_if_absent", "U04", f"""
WITH t AS ({_TARGET}), s AS ({_SOURCE})
SELECT * FROM t UNION ALL SELECT * FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM t)
""",
)
def insert_if_absent(t):
    target, source = _halves(t)
    return U.insert_absent(target, source, ["c_custkey"])


@query(
    "surrogate_keys", "U06 U09", """
WITH known AS (SELECT c_name AS name, c_custkey + 1 AS id FROM customer WHERE c_custkey < 100),
 fresh AS (SELECT c_name AS name, row_number() OVER (ORDER BY left(md5(c_name), 3), c_name) + (SELECT MAX(id) FROM known) AS id FROM customer WHERE c_custkey >= 100)
SELECT * FROM known UNION ALL SELECT * FROM fresh
""",
)
def surrogate_keys(t):
    names = t["customer"].select(F.col("c_name").alias("name"), "c_custkey")
    known = names.filter("c_custkey < 100").select("name", (F.col("c_custkey") + 1).alias("id"))
    return D.assign_ids(known, names.select("name"), "name", "id")


@query(
    "date_dimension", "U07 S14 J12", """
SELECT d.date_id, d.year, d.quarter, d.period_label, d.period_kind, d.period_start_date, o.n FROM core_dim_date d
JOIN (SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter, COUNT(*) AS n FROM orders GROUP BY GROUPING SETS ((1), (1, 2))) o
  ON o.year = d.year AND o.quarter IS NOT DISTINCT FROM d.quarter
""",
)
def date_dimension(t):
    year, quarter = F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")
    counts = t["orders"].groupBy(year, quarter).agg(F.count("*").alias("n"))
    yearly = counts.groupBy("year").agg(F.sum("n").alias("n")).withColumn("quarter", F.lit(None).cast("int"))
    dates = D.date_dimension(t.spark, 1990, 2035).drop("month")
    return joins.null_safe_join(dates, counts.unionByName(yearly), ["year", "quarter"])


@query(
    "company_dimension", "U08 U04", """
WITH a AS (SELECT 'C' || CAST(s_nationkey AS VARCHAR) AS ofgem_company_id, MIN(s_name) AS company_name FROM supplier GROUP BY 1),
 b AS (SELECT a.*, s.s_name, CASE s.s_nationkey WHEN 0 THEN 'ET' WHEN 1 THEN 'ED' WHEN 2 THEN 'GT' ELSE 'GEN' END AS sector FROM a JOIN supplier s ON s.s_name = a.company_name)
SELECT company_name, ofgem_company_id, 'owner' AS owner_group, CAST(CASE sector WHEN 'ET' THEN 1 WHEN 'ED' THEN 2 WHEN 'GT' THEN 3 END AS BIGINT) AS network_sector_id,
       row_number() OVER (ORDER BY left(md5(company_name), 3), company_name) AS company_id FROM b
UNION ALL
SELECT s_name, 'C' || CAST(s_nationkey AS VARCHAR), 'owner', NULL, NULL FROM supplier WHERE FALSE
""",
)
def company_dimension(t):
    s = t["supplier"]
    sector = F.when(F.col("s_nationkey") == 0, "ET").when(F.col("s_nationkey") == 1, "ED").when(
        F.col("s_nationkey") == 2, "GT"
    ).otherwise("GEN")
    alias = s.select(
        F.concat(F.lit("C"), F.col("s_nationkey")).alias("ofgem_company_id"), F.col("s_name").alias("company_name"),
        F.lit("owner").alias("owner_group"), sector.alias("network_sector_code"),
    )
    one = C.first_per_key(alias, ["ofgem_company_id"], [F.col("company_name")])
    built = D.company_dimension(one, t["core_dim_network_sector"])
    return built.select("company_name", "ofgem_company_id", "owner_group", "network_sector_id", "company_id")


@query(
    "supplier_dimension", "U10 U05 U04", """
WITH listed AS (SELECT s_name AS n, MAX(CASE WHEN s_acctbal < 5000 THEN 'medium' ELSE 'large' END) AS z FROM supplier WHERE s_acctbal > 0 GROUP BY 1),
 al AS (SELECT n, z FROM listed UNION ALL SELECT s_name, 'unknown' FROM supplier WHERE s_name NOT IN (SELECT n FROM listed))
SELECT n AS supplier_name, z AS supplier_size, row_number() OVER (ORDER BY left(md5(n), 3), n) AS supplier_id FROM al
""",
)
def supplier_dimension(t):
    s = t["supplier"]
    alias = s.filter("s_acctbal > 0").select(
        F.col("s_name").alias("supplier_name"), F.lit("g").alias("supplier_group"),
        F.when(F.col("s_acctbal") < 5000, "medium").otherwise("large").alias("supplier_size"),
        F.lit(None).cast("string").alias("ofgem_supplier_id"), F.lit("").alias("exited_quarter"),
    )
    built = D.supplier_dimension(alias, [s.select(F.col("s_name").alias("supplier_name"))])
    return built.select("supplier_name", "supplier_size", "supplier_id")


@query(
    "industry_dimension", "U09", """
SELECT p_brand AS sic_code, left(p_brand, 1) AS sic_section, MAX(p_name) AS industry_name, left(p_brand, 1) IN ('B', 'C', 'D', 'E', 'H') AS high_energy_intensity_flag,
       row_number() OVER (ORDER BY left(md5(p_brand), 3), p_brand) AS industry_id FROM part GROUP BY p_brand
""",
)
def industry_dimension(t):
    rows = t["part"].select(F.col("p_brand").alias("sic_code"), F.col("p_name").alias("industry_name"))
    return D.industry_dimension([rows.filter("length(sic_code) > 7"), rows]).drop("sic_group")


# --- pivots ------------------------------------------------------------------------------------------------------


@query(
    "pivot_metrics", "R29 A02", """
SELECT year, company_name, MAX(quantity) FILTER (WHERE flag = 'A') AS a, SUM(quantity) FILTER (WHERE flag = 'R') AS r, MIN(quantity) FILTER (WHERE flag = 'N' AND year > 1996) AS n
FROM line_metrics GROUP BY 1, 2
""",
)
def pivot_metrics(t):
    rows = t["line_metrics"].withColumnsRenamed({"flag": "metric_name", "quantity": "value"})
    spec = {"a": ("max", "A"), "r": ("sum", "R"), "n": ("min", "N", F.col("year") > 1996)}
    return pivot.pivot_metrics(rows, ["year", "company_name"], spec)


@query(
    "pivot_dynamic", "R30 P21", f"""
SELECT {YEAR} AS year, AVG(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS "F", AVG(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS "O", AVG(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1
""", d4=["F", "O", "P"],
)
def pivot_dynamic(t):
    rows = t["orders"].withColumn("year", F.year("o_orderdate"))
    return pivot.pivot_dynamic(rows, ["year"], "o_orderstatus", "o_totalprice")


@query(
    "heat_grid_week", "R31 C28", f"""
SELECT {YEAR} AS year, {', '.join(f"AVG(o_totalprice) FILTER (WHERE weekofyear(o_orderdate) = {w}) AS week_{w:02d}" for w in range(1, 54))} FROM orders GROUP BY 1
""", d7=[f"week_{w:02d}" for w in range(1, 54)],
)
def heat_grid_week(t):
    return pivot.heat_grid(t["orders"], "o_orderdate", "o_totalprice")


@query(
    "zero_filled_area", "R32", f"""
SELECT {YEAR} AS year, {', '.join(f"COALESCE(SUM(l_quantity) FILTER (WHERE p_type = '{p}' AND l_quantity > 49.5), 0) AS {p}" for p in TYPE_FUELS)}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1
""",
)
def zero_filled_area(t):
    rows = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey")).join(
        t["part"], F.col("l_partkey") == F.col("p_partkey")
    )
    # Only full lots have a value, so that some years and types have none.
    lots = F.when(F.col("l_quantity") > 49.5, F.col("l_quantity")).alias("lots")
    return pivot.zero_filled_area(
        rows.select(F.year("o_orderdate").alias("year"), "p_type", lots), "year", "p_type", list(TYPE_FUELS), "lots"
    )


@query(
    "topn_series_pivot", "P09 T03 R30", """
WITH top AS (SELECT nation FROM order_year GROUP BY 1 ORDER BY AVG(abs(spend)) DESC, 1 LIMIT 4)
SELECT year, MIN(spend) FILTER (WHERE place = 1) AS a, MIN(spend) FILTER (WHERE place = 2) AS b, MIN(spend) FILTER (WHERE place = 3) AS c, MIN(spend) FILTER (WHERE place = 4) AS d
FROM order_year JOIN (SELECT nation, row_number() OVER (ORDER BY nation) AS place FROM top) USING (nation) GROUP BY year
""",
)
def topn_series_pivot(t):
    return pivot.top_series_pivot(t["order_year"], "year", "nation", "spend", 4).toDF("year", "a", "b", "c", "d")


@query(
    "entity_or_mean_series", "P17", """
SELECT year, nation, MIN(spend) AS spend FROM order_year GROUP BY 1, 2
""",
)
def entity_or_mean_series(t):
    return pivot.entity_or_mean_series(t["order_year"], "year", "nation", "spend")


@query(
    "two_level_pivot", "A10 M16", f"""
SELECT year, SUM(v) FILTER (WHERE o_orderstatus = 'F') AS f, SUM(v) FILTER (WHERE o_orderstatus = 'O') AS o
FROM (SELECT {YEAR} AS year, o_orderstatus, o_orderpriority, AVG(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3) GROUP BY 1
""", d4=["f", "o"],
)
def two_level_pivot(t):
    means = t["orders"].groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority").agg(
        F.avg("o_totalprice").alias("value")
    )
    rows = means.withColumnRenamed("o_orderstatus", "metric_name")
    return pivot.pivot_metrics(rows, ["year"], {"f": ("sum", "F"), "o": ("sum", "O")})


# --- filters -----------------------------------------------------------------------------------------------------


@query(
    "nullable_filters", "F01 F02 F03 F06 F07 F08", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INT) END AS year, NULLIF(o_orderpriority, '5-LOW') AS payment_method
FROM orders WHERE (o_orderstatus = 'P' OR year(o_orderdate) BETWEEN 1996 AND 1997) AND (o_orderpriority = '5-LOW' OR o_orderpriority = '1-URGENT')
""",
)
def nullable_filters(t):
    rows = t["orders"].select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("year"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("payment_method"),
    )
    return filters.payment(filters.years(rows, 1996, 1997, keep_null=True), "1-URGENT", keep_null=True)


@query(
    "grain_selection", "F06 F01 G14", """
SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' GROUP BY ALL
""",
)
def grain_selection(t):
    rows = t["orders"].select(
        "o_orderpriority", "o_orderstatus", F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
    )
    kept = filters.grain(rows, present=["s"], absent=["p"])
    return kept.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "optional_choices", "F04 F05 F11", """
SELECT nation, year, n FROM order_year WHERE nation IN ('NATION_1', 'NATION_2', 'NATION_7') AND lower(nation) = 'nation_7'
""",
)
def optional_choices(t):
    rows = t["order_year"].select("nation", "year", "n")
    rows = filters.chosen(rows, "year", None)
    return filters.commodity(
        filters.chosen(rows, "nation", ["NATION_1", "NATION_2", "NATION_7"]), "nation_7", "nation"
    )


@query("picker_values", "F12 Q02", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def picker_values(t):
    return filters.distinct_values(t["customer"], ["c_mktsegment", "c_nationkey"])


@query(
    "case_sorted", "T05 T01", """
SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1
""",
)
def case_sorted(t):
    counts = t["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return ranking.sorted_by_case(counts, "o_orderpriority", ["5-LOW", "1-URGENT"], "o_orderpriority")


@query(
    "code_to_grain", "F10 C23 M08", f"""
SELECT o_orderkey, {case('o_orderstatus', {'O': 'open', 'F': 'filled'}, "'other'")} AS grain, {case('o_orderpriority', {'1-URGENT': 'U', '5-LOW': 'L'}, 'o_orderpriority')} AS code FROM orders
""",
)
def code_to_grain(t):
    return t["orders"].select(
        "o_orderkey", L.classify(F.col("o_orderstatus"), {"O": "open", "F": "filled"}, "other").alias("grain"),
        L.code_for(F.col("o_orderpriority"), {"1-URGENT": "U", "5-LOW": "L"}).alias("code"),
    )


# --- scalar functions on labels derived from the tables -----------------------------------------------------------


@query(
    "period_tokens", "C07 C08 C09 C10 C11 C16", f"""
SELECT o_orderkey, make_date({YEAR}, ({QUARTER} - 1) * 3 + 1, 1) AS lead_date, {YEAR} AS lead_year, {QUARTER} AS lead_quarter,
       {YEAR} + 1 AS span_year, {YEAR} + 1 AS winter_year, 3 AS summer_quarter, CAST(o_orderdate AS DATE) AS us_date,
       date_trunc('month', o_orderdate)::DATE AS short_date, CAST(o_orderdate AS DATE) AS auto_date, {YEAR} AS token_year
FROM orders
""",
)
def period_tokens(t):
    d = F.col("o_orderdate")
    y, q = F.year(d), F.quarter(d)
    lead = F.concat(F.lit("Q"), q, F.lit(" "), y)
    span = F.concat(y, F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))
    winter = F.concat(y, F.lit("/"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"), F.lit(" winter"))
    rows = t["orders"].select(
        "o_orderkey", lead.alias("lead"), span.alias("span"), winter.alias("winter"),
        F.concat(y, F.lit(" summer")).alias("summer"), F.date_format(d, "M/d/yyyy").alias("us"),
        F.date_format(d, "MMM-yy").alias("short"),
        F.when(F.dayofmonth(d) > 12, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("auto"),
        F.concat(y, F.lit(" [note 2]")).alias("token"),
    )
    found = with_resolved(rows, {
        "lead_p": ("lead", lambda c: P.resolve_period(c, "quarterly")), "span_year": ("span", P.label_year), "winter_p": ("winter", P.half_year),
        "summer_p": ("summer", P.half_year), "us_date": ("us", lambda c: P.parse_date(c, "us_dayfirst")),
        "short_date": ("short", lambda c: P.parse_date(c, "month_year_short")), "auto_p": ("auto", P.resolve_period), "token_year": ("token", N.year_token),
    })
    lead_p = F.col("lead_p")
    return found.select(
        "o_orderkey", lead_p["period_date"].alias("lead_date"), lead_p["year"].alias("lead_year"), lead_p["quarter"].alias("lead_quarter"),
        "span_year", F.col("winter_p")["year"].alias("winter_year"), F.col("summer_p")["quarter"].alias("summer_quarter"),
        "us_date", "short_date", F.col("auto_p")["period_date"].alias("auto_date"), "token_year",
    )


@query(
    "obligation_months", "C12 C13 C14 C15 C38", f"""
SELECT o_orderkey, {YEAR} AS month_year, {QUARTER} AS month_quarter, {YEAR} AS bracket_year, {YEAR} AS station_year, {QUARTER} AS station_quarter,
       {YEAR} AS scheme_year, {YEAR} + 1 AS fy_year, {YEAR} AS regulatory FROM orders
""",
)
def obligation_months(t):
    d = F.col("o_orderdate")
    y, m, q = F.year(d), F.month(d), F.quarter(d)
    start = F.when(m >= 4, y).otherwise(y - 1)

    def two(year):
        return F.lpad((year % 100).cast("string"), 2, "0")

    rows = t["orders"].select(
        "o_orderkey", F.date_format(d, "MMMM").alias("month"), F.concat(start, F.lit("-"), two(start + 1)).alias("ob"),
        F.concat(F.lit("Household (Quarter "), q, F.lit(" "), y, F.lit(")")).alias("bracket"),
        F.concat(F.date_format(d, "MMM"), F.lit("-"), two(y), F.lit("*")).alias("station"),
        F.concat(F.lit("Scheme year "), (y - 1994)).alias("scheme"), F.concat(two(y), F.lit("/"), two(y + 1)).alias("fy"),
        (y - 1994).cast("string").alias("n"),
    )
    month = P.month_of_obligation(F.col("month"), F.col("ob"))
    station = P.short_month_quarter(F.col("station"))
    return rows.select(
        "o_orderkey", month["year"].alias("month_year"), month["quarter"].alias("month_quarter"),
        P.bracket_quarter(F.col("bracket"))["year"].alias("bracket_year"), station["year"].alias("station_year"),
        station["quarter"].alias("station_quarter"), P.scheme_calendar_year(F.col("scheme"), 1994).alias("scheme_year"),
        P.regulatory_year(None, F.col("fy"), None).alias("fy_year"),
        P.regulatory_year(F.col("n"), None, "X", {"X": 1995}).alias("regulatory"),
    )


@query(
    "iso_weeks", "C28 Q14 C27", """
SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INT) AS iso_year, CAST(weekofyear(o_orderdate) AS INT) AS week,
       CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
       make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS year_start FROM orders
""",
)
def iso_weeks(t):
    d = F.col("o_orderdate")
    # The Thursday of a week lies in the week's ISO year.
    thursday = F.date_add(F.date_trunc("week", d).cast("date"), 3)
    rows = t["orders"].select("o_orderkey", "o_orderdate", F.year(thursday).alias("iso_year"), F.weekofyear(d).alias("week"))
    return rows.select(
        "o_orderkey", "iso_year", "week",
        P.iso_week_monday(
            F.col("iso_year"), P.iso_week_label_number(F.concat(F.lit("isoweek_"), F.col("week").cast("string")))
        ).alias("monday"),
        F.trunc(d.cast("date"), "quarter").alias("quarter_start"), F.make_date(F.year(d), F.lit(1), F.lit(1)).alias("year_start"),
    )


@query(
    "numeric_clean", "C01 C02 C03 C04 C20", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN FLOOR(o_totalprice) END AS lenient, CASE WHEN o_orderstatus <> 'F' THEN FLOOR(o_totalprice) END AS bracket,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS marked, CAST(round(CAST(o_totalprice AS DECIMAL(12,2))) AS INT) AS rounded FROM orders
""",
)
def numeric_clean(t):
    p, s = F.col("o_totalprice"), F.col("o_orderstatus")
    whole = F.format_number(F.floor(p), 0)
    rows = t["orders"].select(
        "o_orderkey", F.when(s == "P", "-").otherwise(F.concat(F.lit(" "), whole)).alias("a"),
        F.when(s == "F", "[x]").otherwise(F.concat(whole, F.lit(" [note 3]"))).alias("b"),
        F.when(s == "O", F.concat(p.cast("string"), F.lit(" [X]"))).otherwise(p.cast("string")).alias("c"),
        p.cast("decimal(12,2)").cast("string").alias("d"),
    )
    return rows.select(
        "o_orderkey", N.lenient_number(F.col("a")).alias("lenient"), N.bracket_number(F.col("b")).alias("bracket"),
        N.marked_number(F.col("c")).alias("marked"), N.rounded_int(F.col("d")).alias("rounded"),
    )


@query(
    "label_map", "C05 C06 C17 C18 C19 C36", f"""
SELECT o_orderkey, lower(replace(replace(o_orderpriority, ' ', '_'), '-', '_')) AS snake, {case('o_orderpriority', {'1-URGENT': 'urgent', '2-HIGH': 'high', '3-MEDIUM': 'rest', '4-NOT SPECIFIED': 'rest', '5-LOW': 'rest'})} AS metric,
       {case('o_orderstatus', STATUS_COMMODITY)} AS commodity, o_orderpriority AS entity, o_orderpriority || ' | ' || o_orderstatus AS label FROM orders
""",
)
def label_map(t):
    rules = {"urgent": "urgent", "high": "high", "-": "rest"}
    dims = {k: {"commodity": v} for k, v in STATUS_COMMODITY.items()}
    squeezed = L.squeeze(F.concat(F.lit("  "), F.replace("o_orderpriority", F.lit(" "), F.lit("   "))))
    return t["orders"].select(
        "o_orderkey", L.snake_case(squeezed).alias("snake"),
        L.match_label(F.col("o_orderpriority"), rules, substring=True).alias("metric"),
        L.match_dimensions(F.col("o_orderstatus"), dims, ["commodity"])["commodity"].alias("commodity"),
        L.strip_lifecycle(F.concat("o_orderpriority", F.lit(" - Start Q1 2020"))).alias("entity"),
        L.composite_label([F.col("o_orderpriority"), F.lit(""), F.col("o_orderstatus")]).alias("label"),
    )


@query(
    "text_predicates", "C24 C25 C26 C41", """
SELECT p_partkey, p_name ILIKE '%RED%' AS has_red, lower(p_type) LIKE '%o%' OR lower(p_type) LIKE 's%' AS any_like, regexp_matches(p_brand, '^Brand#1') AS brand1,
       split_part(p_name, ' ', 2) AS second, lower(trim(p_type)) AS low, CASE WHEN p_size < 10 THEN left(p_type, 1) END AS section FROM part
""",
)
def text_predicates(t):
    return t["part"].select(
        "p_partkey", F.col("p_name").ilike("%RED%").alias("has_red"), L.like_any(F.col("p_type"), ["%o%", "s%"]).alias("any_like"),
        F.col("p_brand").rlike("^Brand#1").alias("brand1"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second"),
        L.normalised(F.col("p_type")).alias("low"),
        L.section_letter(F.when(F.col("p_size") < 10, F.left("p_type", F.lit(1))).otherwise(F.col("p_type"))).alias("section"),
    )


@query(
    "mean_of_present", "C35 C34 C30 G03 M18", """
SELECT c_custkey, (COALESCE(a, 0) + COALESCE(b, 0) + COALESCE(c, 0)) / NULLIF((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT, 0) AS mean,
       (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS present, COALESCE(a, b, c) IS NOT NULL AS any_present
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS a, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 END AS b, CASE WHEN c_nationkey < 5 THEN 7.0::DOUBLE END AS c FROM customer)
""",
)
def mean_of_present(t):
    a = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal"))
    b = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") * 2)
    c = F.when(F.col("c_nationkey") < 5, F.lit(7.0))
    return t["customer"].select(
        "c_custkey", N.present_mean(a, b, c).alias("mean"), N.present_count(a, b, c).alias("present"),
        N.any_present(a, b, c).alias("any_present"),
    )


@query(
    "percent_scaling", "C32 C33", """
SELECT l_orderkey, l_linenumber, l_quantity / CASE WHEN (SELECT quantile_cont(l_quantity, 0.95) FROM lineitem) > 1.5 THEN 100 ELSE 1 END AS q,
       l_discount / CASE WHEN (SELECT quantile_cont(l_discount, 0.95) FROM lineitem) > 1.5 THEN 100 ELSE 1 END AS d FROM lineitem
""",
)
def percent_scaling(t):
    from metricmart.operators.unpivot import as_fractions

    rows = t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"))
    return as_fractions(rows, ["q", "d"])


@query(
    "unit_conversion", "C31 C29 C30", """
SELECT p_partkey, p_retailprice * 11.63::DOUBLE / 1.0::DOUBLE AS twh, p_retailprice / NULLIF(p_size - 10, 0) AS ratio, CASE WHEN p_size > 10 THEN p_retailprice / p_size END AS positive, GREATEST(p_size, 25) AS big FROM part
""",
)
def unit_conversion(t):
    return t["part"].select(
        "p_partkey", N.convert(F.col("p_retailprice"), "mtoe", "twh").alias("twh"),
        N.ratio(F.col("p_retailprice"), F.col("p_size") - 10).alias("ratio"),
        F.when(F.col("p_size") > 10, N.positive_ratio(F.col("p_retailprice"), F.col("p_size"))).alias("positive"),
        F.greatest("p_size", F.lit(25)).alias("big"),
    )


# --- documents and pages -------------------------------------------------------------------------------------------


@query(
    "json_typed_extract", "C20 C21 S07", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.missing') AS has_missing FROM events
""",
)
def json_typed_extract(t):
    rows = with_fields(t["events"].withColumn("props", F.try_parse_json("props")), {"k": "int"}, "props")
    return rows.select(
        "event_id", first_field(F.col("k")).alias("k"), variant_has_keys("props", ["k"]).alias("has_k"),
        variant_has_keys("props", ["k", "missing"]).alias("has_missing"),
    )


@query(
    "natural_key_md5", "S07", """
SELECT md5(COALESCE(CAST(c_nationkey AS VARCHAR), '') || '||' || COALESCE(NULLIF(c_mktsegment, 'BUILDING'), '') || '||' || c_name) AS natural_key, c_custkey FROM customer
""",
)
def natural_key_md5(t):
    rows = t["customer"].withColumn("seg", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return rows.select(landing.natural_key(["c_nationkey", "seg", "c_name"]).alias("natural_key"), "c_custkey")


@query(
    "land_documents", "S07 C20 D12", f"""
SELECT md5(CAST({YEAR} AS VARCHAR) || '||' || o_orderstatus || '||' || o_orderpriority) AS natural_key, {YEAR} AS year, o_orderstatus AS commodity, COUNT(*) AS value
FROM orders GROUP BY 1, 2, 3
""",
)
def land_documents(t):
    rows = t["orders"].groupBy(
        F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("commodity"), F.col("o_orderpriority").alias("metric_name")
    ).agg(F.count("*").alias("value"))
    docs = landing.land_documents(U.empty_like(landing.as_documents(rows, "orders")), rows, "orders")
    typed = with_fields(docs, {"year": "int", "commodity": "string", "value": "int"})
    return typed.select("natural_key", "year", "commodity", F.col("value").cast("bigint").alias("value"))


@query(
    "page_links_extract", "S17", """
SELECT page_id, CAST(unnest(range(len(x))) AS INT) AS position, unnest(x) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS x FROM pages)
""",
)
def page_links_extract(t):
    return pages.links(t["pages"])


@query(
    "page_chart_cells", "S17 S03", """
SELECT page_id, CAST(r AS INT) AS row, CAST(c AS INT) AS col, cell AS text FROM (
 SELECT page_id, 0 AS r, 0 AS c, 'period' AS cell FROM pages UNION ALL SELECT page_id, 0, 1, 'url' FROM pages
 UNION ALL SELECT page_id, 1, 0, 'Q1 2020' FROM pages UNION ALL SELECT page_id, 1, 1, replace(replace(url, '"', ''), ',', '') FROM pages)
""",
)
def page_chart_cells(t):
    # The driver's pages hold no chart, so each page gets one: its own address in an embedded options object.
    clean = F.replace(F.replace("url", F.lit('"'), F.lit("")), F.lit(","), F.lit(""))
    options = F.concat(
        F.lit('<script>var options = {"data": {"csv": "\\"period\\";\\"url\\"\\n\\"Q1 2020\\";\\"'), clean, F.lit('\\""}};</script>')
    )
    with_chart = t["pages"].select("page_id", F.concat("html", options).alias("html"))
    return pages.csv_cells(pages.chart_csv(with_chart))


@query(
    "landed_union", "R33 G13 U-D", """
SELECT 'a' AS source_file, year, company_name, quantity AS value FROM line_metrics WHERE flag = 'A' UNION ALL SELECT 'b', year, company_name, discount FROM line_metrics WHERE flag <> 'A'
""",
)
def landed_union(t):
    m = t["line_metrics"]
    a = m.filter("flag = 'A'").select(F.lit("a").alias("source_file"), "year", "company_name", F.col("quantity").alias("value"))
    b = m.filter("flag <> 'A'").select(F.lit("b").alias("source_file"), "year", "company_name", F.col("discount").alias("value"))
    return C.union_all([a, b])


@query(
    "market_context_staging", "G09 A11", f"""
SELECT {YEAR} AS year, 'electricity' AS commodity, COALESCE(o_orderstatus, 'TOTAL') AS fuel_source, CASE WHEN o_orderstatus IS NULL THEN 'generation_total_twh' ELSE 'generation_twh' END AS metric_name,
       SUM(o_totalprice) AS value, 'TWh' AS unit FROM orders GROUP BY GROUPING SETS (({YEAR}, o_orderstatus), ({YEAR}))
UNION ALL
SELECT CAST(year(ts) AS INT), 'gas', COALESCE(event_type, 'TOTAL'), CASE WHEN event_type IS NULL THEN 'gas_supply_total' ELSE 'gas_supply_mcm_year_sum' END, SUM(value), 'mcm_per_day_sum'
FROM events GROUP BY GROUPING SETS ((CAST(year(ts) AS INT), event_type), (CAST(year(ts) AS INT)))
""", d2=["value"],
)
def market_context_staging(t):
    mix = t["orders"].select(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("instrument"), F.col("o_totalprice").alias("value"))
    gas = t["events"].select(F.year("ts").alias("year"), F.col("event_type").alias("instrument"), "value")
    return staging.market_context(mix, gas)
