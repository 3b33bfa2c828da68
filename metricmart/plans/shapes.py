"""Column contracts of the landing tables: (name, type) in order. Fixed values."""

NETWORK = [
    ("year", "int"),
    ("company_name", "string"),
    ("network_sector", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

SHARE = [c for c in NETWORK if c[0] != "network_sector"]

MARKET = [
    ("period_date", "date"),
    ("period_label", "string"),
    ("year", "int"),
    ("commodity", "string"),
    ("instrument", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

SUPPLIER = [
    ("period_date", "date"),
    ("period_label", "string"),
    ("year", "int"),
    ("quarter", "int"),
    ("supplier_name", "string"),
    ("segment", "string"),
    ("commodity", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

RETAIL_SERIES = [
    ("period_date", "date"),
    ("period_label", "string"),
    ("year", "int"),
    ("quarter", "int"),
    ("commodity", "string"),
    ("payment_method", "string"),
    ("supplier_group", "string"),
    ("supplier_size", "string"),
    ("segment", "string"),
    ("tariff_type", "string"),
    ("component", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

RETAIL_SNAPSHOT = [
    ("year", "int"),
    ("category", "string"),
    ("supplier_name", "string"),
    ("segment", "string"),
    ("commodity", "string"),
    ("payment_method", "string"),
    ("supplier_size", "string"),
    ("aspect", "string"),
    ("component", "string"),
    ("tariff_type", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

RENEWABLES = [
    ("period_date", "date"),
    ("period_label", "string"),
    ("year", "int"),
    ("quarter", "int"),
    ("technology", "string"),
    ("region", "string"),
    ("installation_type", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

DISCOUNT = [
    ("scheme_year", "int"),
    ("calendar_year", "int"),
    ("nation", "string"),
    ("supplier_name", "string"),
    ("obligation_method", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

SCHEME = [
    ("period_date", "date"),
    ("period_label", "string"),
    ("year", "int"),
    ("quarter", "int"),
    ("month", "int"),
    ("scheme_key", "string"),
    ("entity", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
]

DIGEST = [
    ("dukes_table", "string"),
    ("period_year", "int"),
    ("period_label", "string"),
    ("row_label", "string"),
    ("column_label", "string"),
    ("metric_name", "string"),
    ("value", "double"),
    ("unit", "string"),
    ("source_file", "string"),
    ("value_text", "string"),
]

# Natural keys of the typed landing tables: everything but value and unit.
def natural_key(shape):
    return [name for name, _ in shape if name not in ("value", "unit", "period_date")]
