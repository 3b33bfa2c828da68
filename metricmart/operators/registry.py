"""Registry-driven reshaping: each entry names an input, an operator, its options and a target table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricmart.operators import grid, unpivot
from metricmart.sources.literals import literal_table

# Registry strategy → operator.
STRATEGIES = {
    "wide_period_metric": unpivot.period_metric,
    "year_label_long": unpivot.year_rows,
    "columnar_snapshot": unpivot.snapshot,
    "time_series_long": unpivot.time_series,
    "multi_year_unpivot": unpivot.multi_year,
    "period_supplier_matrix": unpivot.period_entity,
    "period_dimension_matrix": unpivot.period_dimensions,
    "category_aspect_snapshot": unpivot.category_aspect,
    "tech_period_matrix": unpivot.technology_period,
    "whd_scheme_year_matrix": unpivot.scheme_year_matrix,
    "scheme_metric_long": unpivot.scheme_metric,
    "scheme_period_supplier_matrix": unpivot.scheme_entity,
    "chart_quarters": unpivot.chart_quarters,
    "chart_supplier_quarters": unpivot.chart_supplier_quarters,
    "chart_technology_obligations": unpivot.chart_technology_obligations,
    "chart_monthly_obligations": unpivot.chart_monthly_obligations,
    "chart_cumulative_months": unpivot.chart_cumulative_months,
    "section_years": grid.section_years,
    "titled_year_sections": grid.titled_year_sections,
    "year_sheets": grid.year_sheets,
    "side_by_side": grid.side_by_side,
    "years_across": grid.years_across,
    "years_down": grid.years_down,
    "embedded_years": grid.embedded_years,
    "register_listing": grid.register_listing,
    "totals_then_years": grid.totals_then_years,
    "trade_blocks": grid.trade_blocks,
    "snapshot_counts": grid.snapshot_counts,
    "flow_matrix": grid.flow_matrix,
    "flow_indicators": grid.flow_indicators,
    "flow_bridge": grid.flow_bridge,
    "supply_use_shares": grid.supply_use_shares,
}


@dataclass
class RegistryRun:
    """One frame per target table, and the entries that could not be planned."""

    targets: dict[str, DataFrame] = field(default_factory=dict)
    failures: list[tuple[str, str]] = field(default_factory=list)


def run_registry(
    entries: Sequence[Mapping[str, object]], tables: Mapping[str, DataFrame], allow_failures: bool = False
) -> RegistryRun:
    """Plan every entry. An entry has ``source``, ``strategy``, ``target`` and ``options``.

    A bad entry (missing table, unknown strategy, bad option) is an error that names all of them. With
    ``allow_failures`` they are listed in the result instead, and their targets lack their rows.
    """
    run = RegistryRun()
    frames: dict[str, list[DataFrame]] = {}
    for entry in entries:
        source = str(entry["source"])
        try:
            operator = STRATEGIES[str(entry["strategy"])]
            frame = operator(tables[source], **dict(entry.get("options", {})))
            frames.setdefault(str(entry["target"]), []).append(frame)
        except Exception as error:  # noqa: BLE001 - one bad entry must not stop the others
            run.failures.append((source, f"{type(error).__name__}: {error}"))
    if run.failures and not allow_failures:
        raise ValueError("; ".join(f"{source}: {reason}" for source, reason in run.failures))
    run.targets = {t: reduce(lambda a, b: a.unionByName(b), fs) for t, fs in frames.items()}
    return run


def rows_per_source(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Smoke report: rows parsed per expected source; a source that gave none has zero."""
    names = literal_table(df.sparkSession, [(e,) for e in expected], "source_file string")
    counts = df.groupBy("source_file").agg(F.count("*").alias("n"))
    return names.join(counts, "source_file", "left").select(
        "source_file", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"),
        (F.coalesce("n", F.lit(0)) > 0).alias("ok"),
    )
