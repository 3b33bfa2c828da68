"""Dimensions and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricmart.operators.conform import first_per_key, union_all
from metricmart.operators.upsert import empty_like, insert_absent, upsert
from metricmart.sources.literals import literal_table


def date_dimension(spark: SparkSession, first: int = 1990, last: int = 2035) -> DataFrame:
    """Annual rows (id = year·10 + 1) and quarterly rows (id = year·100 + quarter)."""
    quarters = F.array(F.lit(None).cast("int"), *[F.lit(q) for q in (1, 2, 3, 4)])
    rows = spark.range(first, last + 1).select(
        F.col("id").cast("int").alias("year"), F.explode(quarters).alias("quarter")
    )
    annual = F.col("quarter").isNull()
    year = F.col("year")
    return rows.select(
        F.when(annual, year * 10 + 1).otherwise(year * 100 + F.col("quarter")).cast("int").alias("date_id"),
        "year",
        "quarter",
        F.lit(None).cast("int").alias("month"),
        F.when(annual, F.concat(year, F.lit("-annual"))).otherwise(F.concat(year, F.lit(" Q"), F.col("quarter")))
        .alias("period_label"),
        F.when(annual, F.lit("annual")).otherwise(F.lit("quarterly")).alias("period_kind"),
        F.make_date(year, F.coalesce((F.col("quarter") - 1) * 3 + 1, F.lit(1)), F.lit(1)).alias("period_start_date"),
    )


def numbered(df: DataFrame, natural_key: str, id_column: str, after: int | object = 0) -> DataFrame:
    """Dense ids 1, 2, … over distinct natural keys, in the order of (hash prefix, key).

    Numbering in one global order would be one task. Keys fall into 4,096 buckets by hash prefix instead, a count per
    bucket gives its first id, and each bucket numbers its own rows. The prefix is a function of the key, so the ids
    come out the same when a lost task is run again.
    """
    bucketed = df.withColumn("_bucket", F.left(F.md5(F.col(natural_key)), F.lit(3)))
    counts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4,096 rows
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    offset = after if not isinstance(after, int) else F.lit(after)
    ids = bucketed.join(starts, "_bucket").withColumn(
        id_column, (offset + F.col("_start") + place).cast("bigint")
    )
    return ids.drop("_bucket", "_start")


def assign_ids(existing: DataFrame, incoming: DataFrame, natural_key: str, id_column: str) -> DataFrame:
    """Existing rows keep their ids; new natural keys get ids above the largest one."""
    new = incoming.join(existing.select(natural_key), natural_key, "left_anti").dropDuplicates([natural_key])
    largest = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    return existing.unionByName(numbered(new, natural_key, id_column, largest), allowMissingColumns=True)


# Seed dimensions.
SECTORS = [
    ("ET", "Electricity Transmission", "electricity"),
    ("ED", "Electricity Distribution", "electricity"),
    ("GT", "Gas Transmission", "gas"),
    ("GD", "Gas Distribution", "gas"),
]
SECTOR_CODES = {name: code for code, name, _ in SECTORS}
GEOGRAPHIES = [
    ("GB", "Great Britain", "country", None),
    ("E12000001", "North East", "region", "GB"),
    ("E12000002", "North West", "region", "GB"),
    ("E12000003", "Yorkshire and The Humber", "region", "GB"),
    ("E12000004", "East Midlands", "region", "GB"),
    ("E12000005", "West Midlands", "region", "GB"),
    ("E12000006", "East of England", "region", "GB"),
    ("E12000007", "London", "region", "GB"),
    ("E12000008", "South East", "region", "GB"),
    ("E12000009", "South West", "region", "GB"),
    ("S92000003", "Scotland", "region", "GB"),
    ("W92000004", "Wales", "region", "GB"),
]
PAYMENT_METHODS = [
    ("direct_debit", False, "Monthly direct debit"),
    ("standard_credit", False, "Standard credit / pay on receipt of bill"),
    ("prepayment", True, "Traditional prepayment meter"),
    ("smart_prepayment", True, "Smart prepayment (smart-PPM)"),
    ("dual_fuel_typical", False, "Typical dual-fuel customer (composite)"),
    ("unknown", False, "Payment method not specified by source"),
]
SUPPLIER_SIZES = ["large", "large_legacy", "medium", "small", "all", "aggregate", "unknown"]
SCHEME_PERIODS = [
    ("T1", ["Electricity Transmission", "Gas Transmission"], 2014, 2021),
    ("ED1", ["Electricity Distribution"], 2016, 2023),
    ("GD1", ["Gas Distribution"], 2014, 2021),
]
HIGH_INTENSITY_SECTIONS = ["B", "C", "D", "E", "H"]


def _with_position(rows: Sequence[tuple]) -> list[tuple]:
    return [(i, *row) for i, row in enumerate(rows, start=1)]


def sector_dimension(spark: SparkSession) -> DataFrame:
    schema = "network_sector_id bigint, sector_code string, sector_name string, commodity string"
    return literal_table(spark, _with_position(SECTORS), schema)


def geography_dimension(spark: SparkSession) -> DataFrame:
    schema = (
        "geography_id bigint, geography_code string, geography_name string, geography_type string, "
        "parent_geography_code string"
    )
    return literal_table(spark, _with_position(GEOGRAPHIES), schema)


def payment_method_dimension(spark: SparkSession) -> DataFrame:
    schema = "payment_method_id bigint, payment_method string, is_prepayment boolean, description string"
    return literal_table(spark, _with_position(PAYMENT_METHODS), schema)


def supplier_size_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i, s) for i, s in enumerate(SUPPLIER_SIZES, start=1)]
    return literal_table(spark, rows, "supplier_size_id bigint, size_band string")


def scheme_period_dimension(
    spark: SparkSession, schemes: Sequence[tuple[str, Sequence[str], int, int]] = tuple(SCHEME_PERIODS)
) -> DataFrame:
    """Regulatory schemes with the sectors they cover, their years and their duration."""
    schema = "scheme string, network_sectors array<string>, start_year int, end_year int"
    table = literal_table(spark, schemes, schema)
    return table.withColumn("duration_years", F.col("end_year") - F.col("start_year") + 1)


def company_dimension(alias: DataFrame, sectors: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per company id with its sector, then generators without a sector."""
    known = alias.filter(F.col("company_name").isNotNull())
    rest = ["owner_group", "network_sector_code"]
    one = first_per_key(
        known.filter(F.col("ofgem_company_id").isNotNull()), ["ofgem_company_id"],
        [F.col("company_name"), *[F.col(c).asc_nulls_last() for c in rest]],
    )
    one = first_per_key(one, ["company_name"], [F.col("ofgem_company_id")])
    with_sector = one.join(
        sectors.select(F.col("sector_code").alias("network_sector_code"), "network_sector_id"),
        "network_sector_code", "left",
    ).select("ofgem_company_id", "company_name", "owner_group", "network_sector_id")
    generators = known.filter(F.col("network_sector_code") == "GEN").select(
        "ofgem_company_id", "company_name", "owner_group", F.lit(None).cast("bigint").alias("network_sector_id")
    )
    rows = insert_absent(with_sector, generators, ["company_name"])
    base = existing if existing is not None else empty_like(
        rows.withColumn("company_id", F.lit(None).cast("bigint"))
    )
    updated = upsert(base, rows.drop("ofgem_company_id"), ["company_name"])
    fresh = updated.filter(F.col("company_id").isNull()).select("company_name").join(rows, "company_name")
    return assign_ids(updated.filter(F.col("company_id").isNotNull()), fresh, "company_name", "company_id")


def industry_dimension(sources: Sequence[DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """Industries of all sources: largest name, section letter, high-intensity flag; known codes stay."""
    both = union_all([s.select("sic_code", "industry_name") for s in sources])
    names = both.filter(F.col("sic_code").isNotNull()).groupBy("sic_code").agg(
        F.coalesce(F.max("industry_name"), F.first("sic_code")).alias("industry_name")
    )
    section = F.left("sic_code", F.lit(1))
    rows = names.select(
        "sic_code", section.alias("sic_section"), F.col("sic_code").alias("sic_group"), "industry_name",
        section.isin(HIGH_INTENSITY_SECTIONS).alias("high_energy_intensity_flag"),
    )
    base = existing if existing is not None else empty_like(
        rows.withColumn("industry_id", F.lit(None).cast("bigint"))
    )
    return assign_ids(base, rows, "sic_code", "industry_id")


def supplier_dimension(
    alias: DataFrame, raw_names: Sequence[DataFrame], existing: DataFrame | None = None
) -> DataFrame:
    """Suppliers of the alias table (new values win, gaps keep the old ones), then unseen raw names as unknown."""
    attributes = ["supplier_group", "supplier_size", "ofgem_supplier_id", "exited_quarter"]
    listed = alias.filter(F.col("supplier_name").isNotNull()).withColumn(
        "exited_quarter", F.nullif("exited_quarter", F.lit(""))
    )
    one = first_per_key(listed, ["supplier_name"], [F.col(c).asc_nulls_last() for c in attributes])
    rows = one.select("supplier_name", *attributes)
    base = existing if existing is not None else empty_like(
        rows.withColumn("supplier_id", F.lit(None).cast("bigint"))
    )
    merged = upsert(base, rows, ["supplier_name"], keep_old_when_null=True)
    seen = union_all([r.select("supplier_name") for r in raw_names]).filter(
        F.coalesce("supplier_name", F.lit("")) != ""
    )
    unknown = seen.distinct().withColumn("supplier_size", F.lit("unknown"))
    everyone = insert_absent(merged, unknown, ["supplier_name"])
    named = everyone.filter(F.col("supplier_id").isNotNull())
    return assign_ids(named, everyone.filter(F.col("supplier_id").isNull()).drop("supplier_id"), "supplier_name",
                      "supplier_id")
