"""Queries about what is written and read back: files, tables, views, run logs and partitioned facts."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import functions as F

from catalog.core import dimensions
from catalog.engine import bind, query
from metricmart.operators import audit, ranking
from metricmart.operators.conform import first_nonempty, union_all
from metricmart.operators.model import rename_features
from metricmart.operators.pivot import pivot_dynamic
from metricmart.operators.quality import missing_columns, require_columns
from metricmart.plans import core, refresh
from metricmart.sources import landing, readers, sinks
from metricmart.sources.literals import literal_table
from metricmart.sources.sinks import Stage
from metricmart.sources.versions import PartitionedFact

# --- tabular files -------------------------------------------------------------------------------------------------


@query(
    "read_tabular", "S01 S15", """
SELECT 'csv' AS kind, s_suppkey, s_name, s_nationkey FROM supplier UNION ALL SELECT 'parquet', s_suppkey, s_name, s_nationkey FROM supplier
""",
)
def read_tabular(t):
    rows = t["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    sinks.export_csv(rows, t.file("supplier.csv"))
    sinks.reload(rows, t.file("supplier.parquet"))
    schema = "s_suppkey bigint, s_name string, s_nationkey int"
    both = {kind: readers.read_tabular(t.spark, t.file(f"supplier.{kind}"), schema) for kind in ("csv", "parquet")}
    return union_all([df.select(F.lit(kind).alias("kind"), *rows.columns) for kind, df in both.items()])


@query(
    "standard_columns", "S04 S05 S06", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS company_name, c_mktsegment AS market_segment FROM customer
""",
)
def standard_columns(t):
    # A header with blanks, capitals, a slash and a repeated name, as sources have it; the alias gives the canonical name.
    rows = t["customer"].select(
        F.col("c_custkey").alias(" Customer Key"), F.col("c_name").alias("Company"), F.col("c_mktsegment").alias("Market/Segment"), F.lit("later").alias("Company "),
    )
    rows.write.option("header", False).csv(t.file("customers.csv"))
    names = readers.standard_names(rows.limit(0).toDF(*rows.columns)).columns
    read = readers.first_of_duplicates(t.spark.read.csv(t.file("customers.csv")), names)
    return readers.with_aliases(readers.standard_names(read), {"company": "company_name", "firm": "company_name"})


@query(
    "mapping_csv", "S02", """
SELECT s_name AS source_name, CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE 'group ' || CAST(s_nationkey AS VARCHAR) END AS company_name FROM supplier
""",
)
def mapping_csv(t):
    blank = F.when(F.col("s_nationkey") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" group "), "s_nationkey"))
    sinks.export_csv(t["supplier"].select(F.col("s_name").alias("source_name"), blank.alias("company_name"), F.lit("x").alias("unused")), t.file("map.csv"))
    return readers.mapping_table(t.spark, t.file("map.csv"), ["source_name", "company_name"])


@query(
    "mixed_separators", "S03 S01", """
SELECT c_custkey % 2 = 0 AS is_comma, CAST(c_custkey AS VARCHAR) AS key, c_name || ', "' || c_mktsegment || '"; ' || chr(10) || 'end' AS label FROM customer
""",
)
def mixed_separators(t):
    # One folder, files of either separator; labels hold both separators, quotes and a line break.
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"; \n'), F.lit("end"))
    rows = t["customer"].select(F.col("c_custkey").alias("key"), label.alias("label"))
    for sep, rest in ((",", 0), (";", 1)):
        # the separator occurs more often than the other: three empty columns
        wide = rows.filter(F.pmod("key", F.lit(2)) == rest).select("key", "label", *[F.lit("").alias(c) for c in ("a", "b", "c")])
        wide.write.mode("append").option("header", True).option("sep", sep).option("escape", '"').csv(t.file("mixed"))
    found = readers.read_delimited(t.spark, t.file("mixed"), ["key", "label"], quoted_breaks=True)
    return found.select((F.col("key").cast("bigint") % 2 == 0).alias("is_comma"), "key", "label")


# --- tables and views ----------------------------------------------------------------------------------------------


@query("create_table_as", "S10", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def create_table_as(t):
    name = f"orders_by_status_{uuid.uuid4().hex}"
    sinks.create_table(t["orders"].groupBy("o_orderstatus").agg(F.count("*").alias("n")), name)

    def drop() -> None:
        try:
            t.spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # noqa: BLE001 - the session has ended
            pass

    atexit.register(drop)
    return t.spark.table(name)


@query("materialised_mart", "S11 S12", """
SELECT o_orderpriority, COUNT(*) AS n, 'mart' AS via FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, COUNT(*), 'view' FROM orders GROUP BY 1
""")
def materialised_mart(t):
    counts = t["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    name = f"mart_priority_{uuid.uuid4().hex}"
    sinks.materialise(counts.withColumn("n", F.lit(0).cast("bigint")), name, t.file("mart"))
    mart = sinks.materialise(counts, name, t.file("mart"))  # rebuilt: the rows of before are gone
    view = f"core_fact_{name}"
    sinks.publish_views(sinks.compatibility_names({view: mart}))
    named = {"mart": t.spark.table(name), "view": t.spark.table(view.removeprefix("core_"))}
    return union_all([df.withColumn("via", F.lit(via)) for via, df in named.items()])


PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)]


@query(
    "literal_seed", "S13", """
SELECT o.o_orderkey, s.rank FROM orders o JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) s(name, rank) ON s.name = o.o_orderpriority
""",
)
def literal_seed(t):
    seed = literal_table(t.spark, PRIORITIES, "name string, rank int")
    return t["orders"].join(seed, F.col("name") == F.col("o_orderpriority")).select("o_orderkey", "rank")


@query(
    "columns_by_total", "T06 R30", """
WITH c AS (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1), r AS (SELECT o_orderstatus, row_number() OVER (ORDER BY n DESC, o_orderstatus) AS place FROM c)
SELECT CAST(year(o.o_orderdate) AS INT) AS year, CAST(r.place AS INT) AS place, COUNT(*) AS n FROM orders o JOIN r ON r.o_orderstatus = o.o_orderstatus GROUP BY 1, 2
""",
)
def columns_by_total(t):
    yearly = t["orders"].select(F.year("o_orderdate").alias("year"), "o_orderstatus", F.lit(1).alias("one"))
    wide = ranking.columns_by_total(pivot_dynamic(yearly, ["year"], "o_orderstatus", "one", "sum"), ["year"])
    values = [c for c in wide.columns if c != "year"]
    long = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("place"), F.col(f"`{c}`").cast("bigint").alias("n")) for i, c in enumerate(values)]))
    return wide.select("year", long.alias("x")).select("year", "x.place", "x.n").filter("n IS NOT NULL")


@query("renamed_features", "K13", "SELECT p_partkey AS key, p_size AS surface_area, p_retailprice AS heating_load FROM part")
def renamed_features(t):
    coded = t["part"].select(F.col("p_partkey").alias("key"), F.col("p_size").alias("X1"), F.col("p_retailprice").alias("Y1"))
    return rename_features(coded, {"X1": "surface_area", "Y1": "heating_load", "X9": "unknown"})


@query("required_columns", "D01", "SELECT 's_region' AS missing, COUNT(*) AS suppliers FROM supplier")
def required_columns(t):
    table = require_columns(t["supplier"], ["s_suppkey", "s_name"], "supplier")
    missing = missing_columns(table, ["s_suppkey", "s_name", "s_region"])
    return table.agg(F.lit(",".join(missing)).alias("missing"), F.count("*").alias("suppliers"))


# --- documents, samples, run log -----------------------------------------------------------------------------------


@query(
    "contract_samples", "D12 S07", """
SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS commodity, COUNT(*) AS value FROM orders GROUP BY 1, 2 UNION ALL SELECT 1901, 'sample', 7
""",
)
def contract_samples(t):
    # A contract's sample row is landed first; the rows of the source are upserted beside it.
    samples = audit.sample_tables(t.spark, {"yearly": [{"year": 1901, "commodity": "sample", "value": 7}]})
    seeded = landing.as_documents(samples["yearly"], "sample")
    rows = t["orders"].groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("commodity")).agg(F.count("*").alias("value"))
    landed = t.store("documents", landing.land_documents(landing.land_documents(seeded, rows, "orders"), rows, "orders"))
    get = lambda name, kind: F.try_variant_get("payload", f"$.{name}", "string").try_cast(kind).alias(name)
    return landed.select(get("year", "int"), get("commodity", "string"), get("value", "bigint"))


@query(
    "run_log", "D10 A20", """
SELECT 'orders' AS target_table, 'loaded' AS status, COUNT(*) AS row_count, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / COUNT(*) AS null_rate FROM orders
UNION ALL SELECT 'customer', 'loaded', COUNT(*), 0.0 FROM customer UNION ALL SELECT 'gone', 'failed', 0, NULL
""", d9=["null_rate"],
)
def run_log(t):
    stage = Stage(t.spark, t.shared(), t.folder.rsplit("/", 1)[1])
    tables = {"orders": t["orders"].withColumn("status", F.nullif("o_orderstatus", F.lit("F"))), "customer": t["customer"].withColumn("status", F.col("c_name"))}
    for name, df in tables.items():
        refresh.logged_write(t.spark, stage, name, df, "driver")
    audit.append_run(t.spark, stage.path("run_log"), "driver", "gone", status="failed", error="no such table")
    rate = F.get_json_object("null_rate_json", "$.status").cast("double")
    return t.spark.read.parquet(stage.path("run_log")).select("target_table", "status", "row_count", rate.alias("null_rate"))


@query("recorded_fallback", "Q40 J18", "SELECT year, n FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, COUNT(*) AS n FROM orders GROUP BY 1)")
def recorded_fallback(t):
    # The choice between sources reads the rows that the run log recorded when they were written; nothing is probed.
    stage = Stage(t.spark, t.shared(), t.folder.rsplit("/", 1)[1])
    yearly = t["orders"].groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    names = ["preferred", "second"]
    stored = [refresh.logged_write(t.spark, stage, name, df, "driver") for name, df in zip(names, (yearly.filter("n < 0"), yearly))]
    rows = audit.recorded_rows(t.spark.read.parquet(stage.path("run_log")))
    return first_nonempty(stored, known=[rows[n] for n in names])


# --- partitioned facts ---------------------------------------------------------------------------------------------

bind("batch_year", """
SELECT year, company_name, sector_code AS network_sector, price + 1 AS totex_allowance_million_gbp, revenue AS actual_totex_million_gbp, tax AS rore_pct FROM supplier_year WHERE year = 1998
UNION ALL SELECT 1980, company_name, sector_code, 1, 1, 1 FROM supplier_year WHERE year = 1998
UNION ALL SELECT year, 'Nobody', sector_code, 1, 1, 1 FROM supplier_year WHERE year = 1998 AND suppkey = 1
""")


def _two_loads(t) -> PartitionedFact:
    """All years, then a batch of one year with rows of an unknown company and of a year beyond the calendar."""
    names = {"sector_code": "network_sector", "price": "totex_allowance_million_gbp", "revenue": "actual_totex_million_gbp", "tax": "rore_pct"}
    base = t.file("facts")
    core.financial_performance(t["supplier_year"].withColumnsRenamed(names), dimensions(t), PartitionedFact(t.spark, base, "spend", "first"))
    fact = PartitionedFact(t.spark, base, "spend", "second", previous="first")
    core.financial_performance(t["batch_year"], dimensions(t), fact)
    return fact


@query(
    "core_partitioned_load", "U01 U02 L02", """
SELECT d.date_id, c.company_id, n.network_sector_id, x.price + CASE WHEN x.year = 1998 THEN 1 ELSE 0 END AS totex_allowance_million_gbp, x.revenue AS actual_totex_million_gbp, x.tax AS rore_pct,
       CASE WHEN x.year = 1998 THEN 'second-1' ELSE 'first-1' END AS commit
FROM supplier_year x JOIN core_dim_date d ON d.year = x.year AND d.quarter IS NULL JOIN core_dim_company c ON c.company_name = x.company_name JOIN core_dim_network_sector n ON n.sector_code = x.sector_code
""",
)
def partitioned_load(t):
    commit = F.regexp_extract(F.col("_metadata.file_path"), "commit=([^/]+)/", 1)
    rows = _two_loads(t).read()
    return rows.withColumn("commit", commit)


@query(
    "rejected_rows", "D04 U07 S14", """
SELECT 'year' AS missing, COUNT(*) AS n FROM batch_year WHERE year = 1980 UNION ALL SELECT 'company_name', COUNT(*) FROM batch_year WHERE company_name = 'Nobody'
""",
)
def rejected_rows(t):
    fact = _two_loads(t)
    return fact.quarantine().groupBy(F.col("_missing").alias("missing")).agg(F.count("*").alias("n"))
