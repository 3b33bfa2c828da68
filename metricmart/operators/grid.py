"""Sheet readers over a cell grid ``cells(source_file, sheet, row, col, text)``.

Readers with sections run a job of their own: their row tables (one row per sheet row) are stored before the cells are
joined to them. A sheet's meaning depends on row order, so every reader carries (source_file, sheet, row, col) explicitly. Rows find
their header row with ``carry_forward`` (cut into blocks, so a huge sheet is not one task) and cells find their header
cell with an equi-join on (source_file, sheet, header row, col). Nothing walks a sheet row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.functions import labels as L
from metricmart.functions import periods as P
from metricmart.functions.numeric import TWH_PER_UNIT, bracket_number, ratio, year_token
from metricmart.operators.conform import first_per_key
from metricmart.operators.filters import conform
from metricmart.operators.windows import carry_forward
from metricmart.plans import shapes
from metricmart.session import stored

SHEET = ["source_file", "sheet"]
LINE = [*SHEET, "row"]

# Remarks that are no data rows.
REMARKS = ["this worksheet", "freeze panes"]


def _values(cells: DataFrame) -> DataFrame:
    """Cells that hold a number."""
    return cells.withColumn("value", bracket_number(F.col("text"))).filter(F.col("value").isNotNull())


def _row_labels(cells: DataFrame, col: int = 0) -> DataFrame:
    """One label per line, out of one column; empty labels are dropped."""
    labels = cells.filter(F.col("col") == col).select(*LINE, L.squeeze(F.col("text")).alias("row_label"))
    return labels.filter("row_label <> ''")


def _is_remark(label: Column, words: Sequence[str] = REMARKS) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | F.lower(label).contains(word)
    return test


def _header(cells: DataFrame, header_row: int, name: str = "header") -> DataFrame:
    """Header texts of a fixed header row, by column."""
    rows = cells.filter((F.col("row") == header_row) & (F.col("col") >= 1))
    return rows.select(*SHEET, "col", L.squeeze(F.col("text")).alias(name)).filter(F.col(name) != "")


def _header_years(cells: DataFrame, header_row: int, low: int, high: int) -> DataFrame:
    rows = cells.filter((F.col("row") == header_row) & (F.col("col") >= 1))
    return rows.select(*SHEET, "col", year_token(F.col("text"), low, high).alias("period_year")).filter(
        F.col("period_year").isNotNull()
    )


def _digest(rows: DataFrame, table: str, **literals: object) -> DataFrame:
    return conform(rows, shapes.DIGEST, dukes_table=table, **literals)


def _rule_chain(title: Column, rules: Sequence[tuple], field: int) -> Column:
    """First rule that applies: (all of these words occur in the title, or the title equals ``=text``)."""
    text = F.lower(title)
    chain = None
    for rule in rules:
        words = rule[0] if isinstance(rule[0], (list, tuple)) else [rule[0]]
        test = F.lit(True)
        for word in words:
            test = test & (text == word[1:] if word.startswith("=") else text.contains(word))
        chain = F.when(test, F.lit(rule[field])) if chain is None else chain.when(test, F.lit(rule[field]))
    return chain if chain is not None else F.lit(None).cast("string")


# Section titles → (words, metric, unit) of the multi-section tables.
CAPACITY_SECTIONS = [
    (["installed capacity", "mw"], "installed_capacity_mw", "MW"),
    (["generation (gwh)"], "generation_gwh", "GWh"),
    (["shares of total electricity generation"], "generation_share_pct", "percent"),
]
LOAD_FACTOR_SECTIONS = [
    (["based on average of beginning and end of year capacity"], "load_factor_avg_capacity_pct", "percent"),
    (["unchanged configuration"], "load_factor_unchanged_config_pct", "percent"),
]
USE_SECTIONS = [
    (["used to generate electricity"], "renewable_use_ktoe", "ktoe"),
    (["used to generate heat"], "renewable_use_ktoe", "ktoe"),
    (["total use of renewable"], "renewable_use_ktoe", "ktoe"),
    (["renewable sources used as transport"], "renewable_use_ktoe", "ktoe"),
]
USE_MARKERS = [
    (["used to generate electricity"], "electricity"),
    (["used to generate heat"], "heat"),
    (["total use of renewable"], "combined"),
    (["renewable sources used as transport"], "transport"),
]
FINAL_CONSUMPTION_SECTIONS = [
    (["electricity generation (ktoe)"], "gfc_electricity_generation_ktoe", "ktoe"),
    (["electricity net imports (ktoe)"], "gfc_electricity_net_imports_ktoe", "ktoe"),
    (["electricity supplied (ktoe)"], "gfc_electricity_supplied_ktoe", "ktoe"),
    (["gross final consumption - electricity"], "gfc_electricity_gfc_ktoe", "ktoe"),
    (["renewable share of gross final electricity"], "gfc_electricity_renewable_share_pct", "percent"),
    (["heat generation (ktoe)"], "gfc_heat_generation_ktoe", "ktoe"),
    (["=transport (ktoe)"], "gfc_transport_ktoe", "ktoe"),
    (["overall consumption (ktoe)"], "gfc_overall_consumption_ktoe", "ktoe"),
    (["=production"], "gfc_balance_production_ktoe", "ktoe"),
    (["=imports"], "gfc_balance_imports_ktoe", "ktoe"),
    (["=exports"], "gfc_balance_exports_ktoe", "ktoe"),
    (["=demand"], "gfc_balance_demand_ktoe", "ktoe"),
    (["final consumption - industry"], "gfc_balance_final_industry_ktoe", "ktoe"),
    (["final consumption - transport"], "gfc_balance_final_transport_ktoe", "ktoe"),
    (["final consumption - domestic"], "gfc_balance_final_domestic_ktoe", "ktoe"),
    (["final consumption - other"], "gfc_balance_final_other_ktoe", "ktoe"),
    (["total final energy consumption"], "gfc_balance_total_final_energy_ktoe", "ktoe"),
    (["non-energy use"], "gfc_balance_non_energy_use_ktoe", "ktoe"),
    (["total final consumption (incl"], "gfc_balance_total_final_incl_non_energy_ktoe", "ktoe"),
]


def section_years(
    cells: DataFrame,
    *,
    table: str,
    sections: Sequence[tuple],
    markers: Sequence[tuple] = (),
    default_marker: str | None = None,
    min_years: int = 3,
    low: int = 1990,
    high: int = 2035,
) -> DataFrame:
    """Several sections in one sheet, each opened by a row that holds a title and at least ``min_years`` years.

    A section ends at the next such row, known or not. ``markers`` give rows a column label: the label set by the last
    section title, or by a data row that itself names the transport marker.
    """
    marked = cells.withColumns(
        {"_year": year_token(F.col("text"), low, high), "_label": F.when(F.col("col") == 0, L.squeeze(F.col("text")))}
    )
    lines = marked.groupBy(*LINE).agg(
        F.max("_label").alias("row_label"),
        F.count_if(F.col("_year").isNotNull() & (F.col("col") >= 1)).alias("_years"),
    )
    is_header = F.col("_years") >= min_years
    title = F.when(is_header, F.col("row_label"))
    lines = lines.withColumns(
        {
            "header_row": F.when(is_header, F.col("row")),
            "metric_name": F.when(is_header, F.coalesce(_rule_chain(title, sections, 1), F.lit(""))),
            "unit": F.when(is_header, F.coalesce(_rule_chain(title, sections, 2), F.lit(""))),
        }
    )
    carry = ["header_row", "metric_name", "unit"]
    if markers:
        transport = [m for m in markers if m[1] == "transport"]
        known_header = is_header & (F.col("metric_name") != "")
        lines = lines.withColumn(
            "column_label",
            F.when(known_header, _rule_chain(F.col("row_label"), markers, 1)).when(
                ~is_header, _rule_chain(F.col("row_label"), transport, 1)
            ),
        )
        carry.append("column_label")
    lines = stored(lines.withColumn("_is_header", is_header))
    placed = carry_forward(lines, SHEET, "row", carry)
    data = placed.filter(~F.col("_is_header") & (F.col("metric_name") != "") & (F.col("row_label") != ""))
    if markers:
        data = data.withColumn("column_label", F.coalesce("column_label", F.lit(default_marker)))
    years = marked.filter((F.col("col") >= 1) & F.col("_year").isNotNull()).select(
        *SHEET, F.col("row").alias("header_row"), "col", F.col("_year").alias("period_year")
    )
    wanted = [*LINE, "row_label", "header_row", "metric_name", "unit", *(["column_label"] if markers else [])]
    rows = _values(cells).join(data.select(*wanted), LINE).join(years, [*SHEET, "header_row", "col"])
    return _digest(rows, table)


def titled_year_sections(
    cells: DataFrame,
    *,
    table: str,
    metric_name: str,
    unit: str,
    title_pattern: str = r"(?i)^Table\s+5\.[\d\.A-Za-z]+",
    min_years: int = 2,
    low: int = 1950,
    high: int = 2100,
) -> DataFrame:
    """Blocks under a carried table title, each with its own year-header row.

    The first row with enough years after a title fixes the block's first year column; later rows with that first
    column are headers too, others are data. Columns left of the years make up the row label.
    """
    marked = cells.withColumns({"_year": year_token(F.col("text"), low, high), "_text": L.squeeze(F.col("text"))})
    has_year = F.col("_year").isNotNull() & (F.col("col") >= 1)
    lines = marked.groupBy(*LINE).agg(
        F.max(F.when(F.col("col") == 0, F.col("_text"))).alias("_label"),
        F.count_if(has_year).alias("_years"),
        F.min(F.when(has_year, F.col("col"))).alias("_first"),
    )
    is_title = F.coalesce(F.col("_label").rlike(title_pattern), F.lit(False))
    lines = lines.withColumns(
        {
            "_is_title": is_title,
            "section": F.when(is_title, F.col("_label")),
            "_segment": F.when(is_title, F.col("row")),
            "_candidate": ~is_title & (F.col("_years") >= min_years),
        }
    )
    placed = stored(carry_forward(stored(lines), SHEET, "row", ["section", "_segment"]).fillna(-1, ["_segment"]))
    opening = placed.filter("_candidate").groupBy(*SHEET, "_segment").agg(
        F.min_by("_first", "row").alias("first_col")
    )
    placed = placed.join(opening, [*SHEET, "_segment"])
    is_header = F.col("_candidate") & (F.col("_first") == F.col("first_col"))
    placed = placed.withColumns(
        {
            "_is_header": is_header,
            # A title row closes the block above it: it carries the marker -1 until its own header.
            "header_row": F.when(is_header, F.col("row")).when(F.col("_is_title"), F.lit(-1)),
        }
    )
    active = carry_forward(placed, SHEET, "row", ["header_row"])
    data = stored(
        active.filter(~F.col("_is_title") & ~F.col("_is_header") & (F.col("header_row") >= 0)).select(
            *LINE, "first_col", "header_row", "section"
        )
    )
    parts = marked.select(*LINE, "col", "_text").join(data.select(*LINE, "first_col"), LINE)
    names = parts.filter((F.col("col") < F.col("first_col")) & (F.col("_text") != "")).groupBy(*LINE).agg(
        F.concat_ws(" | ", F.transform(F.sort_array(F.collect_list(F.struct("col", "_text"))), lambda s: s["_text"]))
        .alias("row_label")
    )
    names = names.filter(F.lower("row_label") != "category")
    years = marked.filter(has_year).select(
        *SHEET, F.col("row").alias("header_row"), "col", F.col("_year").alias("period_year")
    )
    rows = (
        _values(cells)
        .join(data.select(*LINE, "header_row", "section"), LINE)
        .join(names, LINE)
        .join(years, [*SHEET, "header_row", "col"])
    )
    rows = rows.withColumns({"period_label": F.col("section"), "column_label": F.col("section")})
    return _digest(rows, table, metric_name=metric_name, unit=unit)


def year_sheets(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    metric_name: str = "commodity_balance_ktoe",
    unit: str = "ktoe",
    header_metrics: Sequence[tuple] = (),
    sheet_pattern: str = r"^\d{4}$",
) -> DataFrame:
    """One sheet per year, a flow × fuel matrix. ``header_metrics`` pick metric and unit by words of the header."""
    sheets = cells.filter(F.col("sheet").rlike(sheet_pattern))
    rows = (
        _values(sheets.filter(F.col("row") >= data_start))
        .join(_header(sheets, header_row, "column_label"), [*SHEET, "col"])
        .join(_row_labels(sheets), LINE)
        .withColumn("period_year", F.col("sheet").try_cast("int"))
    )
    metric, measure = F.lit(metric_name), F.lit(unit)
    if header_metrics:
        metric = F.coalesce(_rule_chain(F.col("column_label"), header_metrics, 1), metric)
        measure = F.coalesce(_rule_chain(F.col("column_label"), header_metrics, 2), measure)
    return _digest(rows.withColumns({"metric_name": metric, "unit": measure}), table)


# Detail headers that carry their own metric.
DETAIL_HEADERS = [
    (["share of renewables"], "gfc_renewables_share_pct", "percent"),
    (["of which renewables"], "gfc_renewables_component_ktoe", "ktoe"),
]


def side_by_side(
    cells: DataFrame,
    *,
    table: str,
    blocks: Sequence[tuple[int, int, str, str]] = (
        (1, 11, "aggregate_balance_twh", "TWh"),
        (17, 27, "aggregate_balance_ktoe", "ktoe"),
    ),
    header_row: int = 2,
    data_start: int = 4,
    sheet_pattern: str = r"^\d{4}$",
) -> DataFrame:
    """Year sheets with blocks next to each other: (first column, end column, metric, unit) per block."""
    sheets = cells.filter(F.col("sheet").rlike(sheet_pattern))
    metric = unit = None
    for first, end, name, measure in blocks:
        here = (F.col("col") >= first) & (F.col("col") < end)
        metric = F.when(here, F.lit(name)) if metric is None else metric.when(here, F.lit(name))
        unit = F.when(here, F.lit(measure)) if unit is None else unit.when(here, F.lit(measure))
    labels = _row_labels(sheets).filter(
        (F.lower("row_label") != "column1") & ~_is_remark(F.col("row_label"), [*REMARKS, "some cells"])
    )
    rows = (
        _values(sheets.filter(F.col("row") >= data_start))
        .withColumns({"metric_name": metric, "unit": unit, "period_year": F.col("sheet").try_cast("int")})
        .filter(F.col("metric_name").isNotNull())
        .join(labels, LINE)
        .join(_header(sheets, header_row, "column_label"), [*SHEET, "col"], "left")
    )
    return _digest(rows.fillna("", ["column_label"]), table)


def years_across(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    metric_name: str,
    unit: str,
    column_label: str | None = None,
    skip_words: Sequence[str] = (*REMARKS, "column1"),
    low: int = 1950,
    high: int = 2100,
) -> DataFrame:
    """Row labels down the first column, years across one header row."""
    labels = _row_labels(cells).filter(~_is_remark(F.col("row_label"), skip_words))
    rows = (
        _values(cells.filter(F.col("row") >= data_start))
        .join(_header_years(cells, header_row, low, high), [*SHEET, "col"])
        .join(labels, LINE)
    )
    name = F.lit(column_label) if column_label else F.replace("sheet", F.lit("."), F.lit("_"))
    return _digest(rows.withColumn("column_label", name), table, metric_name=metric_name, unit=unit)


def primary_fuels(cells: DataFrame, *, header_row: int, data_start: int) -> DataFrame:
    """Inland consumption by fuel: fuels down, years across."""
    labels = _row_labels(cells).filter(~F.lower("row_label").startswith("column"))
    rows = (
        _values(cells.filter(F.col("row") >= data_start))
        .join(_header_years(cells, header_row, 1950, 2100), [*SHEET, "col"])
        .join(labels, LINE)
    )
    return rows.select(
        F.col("period_year").alias("year"), F.col("row_label").alias("fuel_type"),
        F.col("value").alias("consumption_mtoe"), "source_file",
    )


def _year_lines(cells: DataFrame, data_start: int, low: int = 1950, high: int = 2100) -> DataFrame:
    first = cells.filter((F.col("col") == 0) & (F.col("row") >= data_start))
    return first.select(*LINE, year_token(F.col("text"), low, high).alias("period_year")).filter(
        F.col("period_year").isNotNull()
    )


def years_down(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    metric_name: str | None = None,
    unit: str | None = None,
    metric_prefix: str | None = None,
) -> DataFrame:
    """Years down the first column, one series per header.

    With ``metric_prefix`` the metric is made from the header and the unit is percent or mtoe by its words; otherwise
    repeated headers get a running number (``Gas``, ``Gas__1``).
    """
    raw = cells.filter((F.col("row") == header_row) & (F.col("col") >= 0)).select(
        *SHEET, "col", F.coalesce(F.nullif(L.squeeze(F.col("text")), F.lit("")), F.lit("unnamed")).alias("header")
    )
    if metric_prefix:
        heads = raw.filter((F.col("col") >= 1) & (F.col("header") != "unnamed"))
        slug = L.snake_case(F.col("header"))
        heads = heads.withColumns(
            {
                "metric_name": F.concat(F.lit(f"{metric_prefix}_"), slug),
                "unit": F.when(F.lower("header").contains("percentage"), F.lit("percent")).otherwise(F.lit("mtoe")),
            }
        )
    else:
        heads = _numbered(raw).filter((F.col("col") >= 1) & ~F.lower("header").isin("year", "unnamed"))
        heads = heads.withColumns({"metric_name": F.lit(metric_name), "unit": F.lit(unit)})
    rows = (
        _values(cells.filter((F.col("row") >= data_start) & (F.col("col") >= 1)))
        .join(heads, [*SHEET, "col"])
        .join(_year_lines(cells, data_start), LINE)
    )
    return _digest(rows.withColumnRenamed("header", "row_label"), table)


def _numbered(heads: DataFrame) -> DataFrame:
    """Number repeated headers of a sheet; a header row is as long as the sheet is wide."""
    from pyspark.sql import Window

    seen = F.row_number().over(Window.partitionBy(*SHEET, "header").orderBy("col")) - 1
    numbered = heads.withColumn("_seen", seen)
    name = F.when(F.col("_seen") > 0, F.concat_ws("__", "header", F.col("_seen").cast("string")))
    return numbered.withColumn("header", name.otherwise(F.col("header"))).drop("_seen")


def primary_consumption(cells: DataFrame, *, data_start: int) -> DataFrame:
    """Year, primary energy, output, ratio and index side by side."""
    names = ["primary_energy_mtoe", "gdp_gbp_billion", "energy_ratio", "energy_intensity_index_1970_100"]
    picks = [F.max(F.when(F.col("col") == i, F.col("value"))).alias(n) for i, n in enumerate(names, start=1)]
    rows = _values(cells.filter((F.col("row") >= data_start) & F.col("col").between(1, 4))).groupBy(*LINE).agg(*picks)
    years = _year_lines(cells, data_start)
    wide = years.join(rows, LINE, "left")
    return wide.select(
        F.col("period_year").alias("year"), names[0],
        (F.col(names[0]) * TWH_PER_UNIT["mtoe"]).alias("primary_energy_twh"), *names[1:], "source_file",
    )


# Header words → final user.
EXPENDITURE_SECTORS = [
    (["total industry"], "industry"),
    (["total domestic"], "domestic"),
    (["of which road transport"], "transport_road"),
    (["total other final users"], "other_final_users"),
    (["total all final users"], "all_final_users"),
]


def expenditure(cells: DataFrame, *, header_row: int, data_start: int) -> DataFrame:
    """Expenditure per year and final user, the users found by header words."""
    heads = _header(cells, header_row).withColumn("sector", _rule_chain(F.col("header"), EXPENDITURE_SECTORS, 1))
    rows = (
        _values(cells.filter(F.col("row") >= data_start))
        .join(heads.filter(F.col("sector").isNotNull()), [*SHEET, "col"])
        .join(_year_lines(cells, data_start), LINE)
    )
    return rows.select(
        F.col("period_year").alias("year"), "sector", F.col("value").alias("expenditure_million_gbp"), "source_file"
    )


def final_consumption(
    cells: DataFrame, *, header_row: int, data_start: int, sectors: Mapping[str, str]
) -> DataFrame:
    """Consumption per year, final user (one sheet each) and fuel, in ktoe and TWh."""
    rows = (
        _values(cells.filter(F.col("row") >= data_start))
        .join(_header(cells, header_row, "fuel_type"), [*SHEET, "col"])
        .join(_year_lines(cells, data_start), LINE)
        .withColumn("sector", L.classify(F.col("sheet"), sectors))
        .filter(F.col("sector").isNotNull())
    )
    return rows.select(
        F.col("period_year").alias("year"), "sector", "fuel_type", F.col("value").alias("energy_ktoe"),
        (F.col("value") * TWH_PER_UNIT["ktoe"]).alias("energy_twh"), "source_file",
    )


def embedded_years(
    cells: DataFrame, *, table: str, header_row: int, data_start: int, metric_name: str, unit: str
) -> DataFrame:
    """Headers with the year inside, such as ``Public distribution system (1998)``."""
    pattern = r"\((\d{4})\)\s*$"
    heads = _header(cells, header_row).withColumns(
        {
            "period_year": F.nullif(F.regexp_extract("header", pattern, 1), F.lit("")).try_cast("int"),
            "column_label": F.nullif(F.trim(F.regexp_replace("header", pattern, "")), F.lit("")),
        }
    )
    labels = _row_labels(cells).filter(
        ~_is_remark(F.col("row_label")) & ~F.col("row_label").rlike(r"(?i)^table\s+\d")
    )
    rows = (
        _values(cells.filter((F.col("row") >= data_start) & (F.col("col") >= 1)))
        .join(heads.filter(F.col("period_year").between(1950, 2100)), [*SHEET, "col"])
        .join(labels, LINE)
    )
    return _digest(rows, table, metric_name=metric_name, unit=unit)


def register_listing(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    metric_name: str,
    unit: str,
    label_cols: Sequence[int] = (0,),
    snapshot_year: int | None = None,
    text_columns: bool = True,
) -> DataFrame:
    """A register: one row per attribute, the number in ``value`` or the text in ``value_text``."""
    body = cells.filter(F.col("row") >= data_start)
    squeezed = L.squeeze(F.col("text"))
    parts = [F.max(F.when(F.col("col") == c, F.nullif(squeezed, F.lit("")))) for c in label_cols]
    lines = body.filter(F.col("col").isin(list(label_cols))).groupBy(*LINE).agg(
        F.concat_ws(" | ", *parts).alias("row_label")
    )
    rows = (
        body.filter(F.col("col") > max(label_cols))
        .join(lines.filter("row_label <> ''"), LINE)
        .join(_header(cells, header_row, "column_label"), [*SHEET, "col"])
        .withColumns({"value": bracket_number(F.col("text")), "_text": F.nullif(squeezed, F.lit(""))})
    )
    is_text = F.col("value").isNull() & F.col("_text").isNotNull() & F.lit(text_columns)
    rows = rows.filter(F.col("value").isNotNull() | is_text).withColumns(
        {
            "unit": F.when(F.col("value").isNull(), F.lit("text")).otherwise(F.lit(unit)),
            "value_text": F.when(F.col("value").isNull(), F.col("_text")),
            "period_label": F.col("sheet"),
            "period_year": F.lit(snapshot_year).cast("int"),
        }
    )
    return _digest(rows, table, metric_name=metric_name)


def totals_then_years(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    metric_name: str,
    unit: str,
    suffix: str = "cumulative_series",
    low: int = 1950,
    high: int = 2100,
) -> DataFrame:
    """Optional cumulative columns before the first year column; they get their own metric and no year."""
    heads = cells.filter((F.col("row") == header_row) & (F.col("col") >= 1)).select(
        *SHEET, "col", year_token(F.col("text"), low, high).alias("period_year"),
        L.squeeze(F.col("text")).alias("header"),
    )
    first = heads.filter(F.col("period_year").isNotNull()).groupBy(*SHEET).agg(
        F.min("col").alias("_first"), F.count("*").alias("_years")
    )
    heads = heads.join(first.filter("_years >= 2"), SHEET)
    before = (F.col("col") < F.col("_first")) & (F.col("header") != "")
    heads = heads.filter(before | F.col("period_year").isNotNull())
    labels = _row_labels(cells).filter(
        ~_is_remark(F.col("row_label")) & ~F.col("row_label").rlike(r"(?i)^table\s+\d")
    )
    rows = _values(cells.filter(F.col("row") >= data_start)).join(heads, [*SHEET, "col"]).join(labels, LINE)
    is_total = F.col("col") < F.col("_first")
    rows = rows.withColumns(
        {
            "metric_name": F.when(is_total, F.lit(f"{metric_name}_{suffix}")).otherwise(F.lit(metric_name)),
            "period_label": F.when(is_total, F.col("header")),
            "column_label": F.when(is_total, F.col("header")),
        }
    )
    return _digest(rows, table, unit=unit)


def trade_blocks(cells: DataFrame, *, table: str, low: int = 1990, high: int = 2035) -> DataFrame:
    """Imports and exports blocks in one sheet; the row that opens a block also holds its years."""
    first = cells.filter(F.col("col") == 0).select(*LINE, L.squeeze(F.col("text")).alias("row_label"))
    label = F.lower("row_label")
    opens = F.when(label.contains("imports (tonnes)"), F.lit("imports")).when(
        label.contains("exports (tonnes)"), F.lit("exports")
    )
    # A source note ends the exports block; imports only end where exports begin.
    ends = label.startswith("source") | label.startswith("©")
    lines = first.withColumns(
        {
            "_opens": opens,
            "block": opens,
            "header_row": F.when(opens.isNotNull(), F.col("row")),
        }
    )
    placed = stored(carry_forward(lines, SHEET, "row", ["block", "header_row"]))
    notes = placed.filter((F.col("block") == "exports") & F.col("_opens").isNull() & ends)
    cut = notes.groupBy(*SHEET, "header_row").agg(F.min("row").alias("_cut"))
    placed = placed.join(cut, [*SHEET, "header_row"], "left")
    data = placed.filter(
        F.col("_opens").isNull()
        & F.col("block").isNotNull()
        & (F.col("row_label") != "")
        & (F.col("_cut").isNull() | (F.col("row") < F.col("_cut")))
    ).select(*LINE, "row_label", "block", "header_row")
    years = cells.filter(F.col("col") >= 1).select(
        *SHEET, F.col("row").alias("header_row"), "col", year_token(F.col("text"), low, high).alias("period_year")
    ).filter(F.col("period_year").isNotNull())
    rows = _values(cells).join(data, LINE).join(years, [*SHEET, "header_row", "col"])
    rows = rows.withColumn("column_label", F.concat_ws("|", "sheet", "block"))
    return _digest(rows, table, metric_name="trade_tonnes", unit="tonnes")


def snapshot_counts(
    cells: DataFrame,
    *,
    table: str,
    header_row: int,
    data_start: int,
    snapshot_year: int,
    metric_name: str = "station_count",
    unit: str = "count",
) -> DataFrame:
    """Counts by technology and header for one year."""
    heads = _header(cells, header_row, "column_label")
    rows = (
        _values(cells.filter((F.col("row") >= data_start) & (F.col("col") >= 1)))
        .join(heads, [*SHEET, "col"], "left")
        .join(_row_labels(cells), LINE)
        .withColumn("column_label", F.coalesce("column_label", F.concat(F.lit("col_"), F.col("col").cast("string"))))
    )
    return _digest(rows, table, period_year=snapshot_year, metric_name=metric_name, unit=unit)


def _reference_year(cells: DataFrame) -> DataFrame:
    corner = cells.filter((F.col("row") == 0) & (F.col("col") == 0))
    return corner.select(*SHEET, P.title_year(F.col("text")).alias("reference_year"))


def _industry_heads(cells: DataFrame, header_row: int, first_col: int, step: int) -> DataFrame:
    heads = cells.filter(
        (F.col("row") == header_row) & (F.col("col") >= first_col) & ((F.col("col") - first_col) % step == 0)
    )
    return heads.select(*SHEET, "col", F.trim("text").alias("industry_code")).filter(
        F.coalesce("industry_code", F.lit("")) != ""
    )


def flow_matrix(
    cells: DataFrame,
    *,
    table_id: str,
    header_row: int,
    data_start: int,
    first_col: int,
    step: int,
    number_col: int = 0,
    level_col: int | None = 1,
    code_col: int = 2,
    label_col: int = 3,
    code_required: bool = False,
) -> DataFrame:
    """Energy-flow matrix: every ``step``-th column is an industry; rows carry number, level, code and label."""
    body = cells.filter(F.col("row") >= data_start)

    def at(col: int | None, number: bool = False) -> Column:
        if col is None:
            return F.lit(None).cast("int")
        text = F.max(F.when(F.col("col") == col, F.col("text")))
        return bracket_number(text).cast("int") if number else F.nullif(F.trim(text), F.lit(""))

    wanted = [c for c in (number_col, level_col, code_col, label_col) if c is not None]
    lines = body.filter(F.col("col").isin(wanted)).groupBy(*LINE).agg(
        at(number_col, True).alias("row_no"),
        at(level_col, True).alias("row_level"),
        at(code_col).alias("row_code"),
        at(label_col).alias("row_label"),
    )
    known = F.col("row_code").isNotNull()
    lines = lines.filter(known if code_required else known | F.col("row_label").isNotNull())
    rows = (
        _values(body)
        .join(_industry_heads(cells, header_row, first_col, step), [*SHEET, "col"])
        .join(lines, LINE)
        .join(_reference_year(cells), SHEET)
    )
    return rows.select(
        "reference_year", F.lit(table_id).alias("table_id"), "row_no", "row_level", "row_code", "row_label",
        F.col("col").alias("industry_col"), "industry_code", F.col("value").alias("energy_tj"), "source_file",
    )


def flow_indicators(cells: DataFrame, **layout: object) -> DataFrame:
    """Indicator table: as the matrix, rows without a level, the code is required."""
    return flow_matrix(cells, level_col=None, code_required=True, **layout)


def flow_bridge(
    cells: DataFrame, *, data_start: int, code_col: int = 0, label_col: int = 1, value_col: int = 2
) -> DataFrame:
    """Bridge table (code, label, value) up to the notes."""
    body = cells.filter(F.col("row") >= data_start)

    def at(col: int) -> Column:
        return F.max(F.when(F.col("col") == col, F.nullif(F.trim("text"), F.lit(""))))

    lines = body.filter(F.col("col").isin(code_col, label_col, value_col)).groupBy(*LINE).agg(
        at(code_col).alias("bridge_code"), at(label_col).alias("bridge_label"), at(value_col).alias("_value")
    )
    code = F.lower("bridge_code")
    cut = lines.filter(code.startswith("explanations") | (code == "notes")).groupBy(*SHEET).agg(
        F.min("row").alias("_cut")
    )
    kept = lines.join(cut, SHEET, "left").filter(F.col("_cut").isNull() | (F.col("row") < F.col("_cut")))
    rows = kept.withColumn("energy_tj", bracket_number(F.col("_value"))).filter(
        F.col("energy_tj").isNotNull() & F.col("bridge_code").isNotNull()
    )
    return rows.join(_reference_year(cells), SHEET).select(
        "reference_year", "bridge_code", "bridge_label", "energy_tj", "source_file"
    )


def supply_use_shares(
    cells: DataFrame,
    *,
    sheet_pattern: str = r"^Table 2 - Int Con (\d{4})\s*$",
    code_row: int = 3,
    name_row: int = 4,
    data_start: int = 5,
    product_prefix: str = "CPA",
    total_words: str = "Total intermediate consumption",
) -> DataFrame:
    """Product × industry sheets → long rows with each value's share of its column total."""
    sheets = cells.filter(F.col("sheet").rlike(sheet_pattern))
    codes = _header(sheets.filter(F.col("col") >= 2), code_row, "sic_code")
    names = _header(sheets.filter(F.col("col") >= 2), name_row, "industry_name")
    totals_at = first_per_key(
        sheets.filter((F.col("col") == 1) & F.col("text").contains(total_words)), SHEET, [F.col("row")]
    ).select(*LINE)
    totals = _values(sheets.filter(F.col("col") >= 2)).join(totals_at, LINE).select(
        *SHEET, "col", F.col("value").alias("_total")
    )
    products = _row_labels(sheets.filter(F.col("row") >= data_start)).filter(
        F.col("row_label").startswith(product_prefix)
    )
    # A blank cell of a product row counts as zero, so rows come from products × known columns of the same sheet.
    body = sheets.filter((F.col("row") >= data_start) & (F.col("col") >= 2)).withColumn(
        "value", F.coalesce(bracket_number(F.col("text")), F.lit(0.0))
    )
    rows = (
        body.join(products, LINE)
        .join(codes, [*SHEET, "col"])
        .join(names, [*SHEET, "col"], "left")
        .join(totals, [*SHEET, "col"])
        .join(totals_at.select(*SHEET, F.col("row").alias("_total_row")), SHEET)
        .filter(F.col("row") < F.col("_total_row"))
    )
    share = F.when(F.col("_total") > 0, ratio(F.col("value"), F.col("_total")))
    return rows.select(
        F.regexp_extract("sheet", sheet_pattern, 1).cast("int").alias("year"), "sic_code", "industry_name",
        F.col("row_label").alias("commodity"), share.alias("intermediate_consumption_share"),
        F.col("value").alias("intermediate_consumption_value"),
    )
