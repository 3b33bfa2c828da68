"""Landing rows as JSON documents and as typed long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.operators.upsert import upsert

# Columns that make up the key of a landed document, in order.
DOCUMENT_KEYS = [
    "year",
    "date",
    "company_name",
    "network_sector",
    "sic_code",
    "industry_name",
    "region_code",
    "commodity",
    "metric_name",
    "source_name",
]

# Required columns per source.
CONTRACTS = {
    "network_reliability": ["year", "company_name", "network_sector", "ens_mwh"],
    "expenditure": [
        "year", "company_name", "network_sector", "actual_totex_million_gbp", "totex_allowance_million_gbp",
    ],
    "return_on_equity": ["year", "company_name", "network_sector", "rore_pct"],
    "customer_metrics": ["year", "company_name", "network_sector", "cost_per_customer_gbp", "satisfaction_score"],
    "emissions": ["year", "company_name", "network_sector", "sf6_kg", "carbon_footprint_tco2e"],
    "energy_intensity": ["year", "sic_code", "kwh_per_gva", "energy_intensity_index"],
    "sector_fuel_use": ["year", "sic_code", "electricity_pct", "gas_pct"],
    "regional_gva": ["year", "region_code", "sic_code", "gva_million_gbp"],
    "lcree": ["year", "lcree_turnover_million_gbp"],
    "intermediate_consumption": ["year", "sic_code", "commodity", "intermediate_consumption_share"],
    "daily_market_prices": ["date", "commodity", "metric_name", "value"],
}

# Alternative column names per source.
COLUMN_ALIASES = {
    "lcree": {
        "turnover_million_gbp": "lcree_turnover_million_gbp",
        "turnover_current_prices_million_gbp": "lcree_turnover_million_gbp",
    },
    "intermediate_consumption": {"intermediate_share": "intermediate_consumption_share"},
}

# Measures that must not be negative.
NON_NEGATIVE = [
    "ens_mwh", "actual_totex_million_gbp", "totex_allowance_million_gbp", "cost_per_customer_gbp", "sf6_kg",
    "carbon_footprint_tco2e", "kwh_per_gva", "energy_intensity_index", "electricity_pct", "gas_pct",
    "gva_million_gbp", "lcree_turnover_million_gbp", "intermediate_consumption_share",
    "intermediate_consumption_value", "value",
]


def natural_key(columns: Sequence[str]) -> Column:
    """md5 over the key columns joined by a double bar; NULL counts as empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("||", *texts)) if texts else F.md5(F.lit(""))


def as_documents(df: DataFrame, source_id: str) -> DataFrame:
    """Rows as (natural_key, payload, source_id, loaded_at).

    The payload is a variant, so that later readers pick fields without parsing text; all its values are text, NULLs are kept.
    """
    keys = [c for c in DOCUMENT_KEYS if c in df.columns]
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    return df.select(
        natural_key(keys).alias("natural_key"),
        F.to_variant_object(F.struct(*texts)).alias("payload"),
        F.lit(source_id).alias("source_id"),
        F.current_timestamp().alias("loaded_at"),
    )


def land_documents(existing: DataFrame, df: DataFrame, source_id: str) -> DataFrame:
    """Upsert rows as documents on their natural key."""
    return upsert(existing, as_documents(df, source_id), ["natural_key"])


def land_rows(existing: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert typed long rows on their natural key, NULLs comparing equal."""
    return upsert(existing, rows, keys)
