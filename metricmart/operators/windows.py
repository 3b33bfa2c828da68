"""Window jobs on aggregated rows, one row per entity and period.

Entities of many periods, and whole tables without an entity, are scanned block by block (``block_scan``): no task sees
more than a block, and between blocks only one row a block is carried.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.functions.numeric import ratio
from metricmart.operators.joins import null_safe_join

BLOCK_WIDTH = 4096  # stretch of the order axis (numbers, days) that one block covers


def with_group_total(df: DataFrame, keys: Sequence[str], value: Column | str, name: str) -> DataFrame:
    """Add the total of each group to its rows.

    Aggregate and join back instead of a window, so that a group with a third of the rows is summed on the map side
    and never gathered in one task.
    """
    column = F.col(value) if isinstance(value, str) else value
    totals = df.groupBy(*keys).agg(F.sum(column).alias(name))
    return df.join(totals, list(keys), "left")


def shares(df: DataFrame, keys: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Share of each row in its group's total; NULL for a zero total."""
    total = with_group_total(df, keys, value, "_total")
    return total.withColumn(name, ratio(F.col(value), F.col("_total"))).drop("_total")


def positive_shares(
    df: DataFrame, keys: Sequence[str], value: str, item: str, total_label: str = "TOTAL", name: str = "share"
) -> DataFrame:
    """Share of the positive part of each row in the positive parts of its group; total rows do not count."""
    positive = F.greatest(F.col(value), F.lit(0.0))
    is_part = F.col(item) != total_label
    total = with_group_total(df, keys, F.when(is_part, positive), "_total")
    share = F.when(F.col(item) != total_label, F.try_divide(positive, F.col("_total")))
    return total.withColumn(name, share).drop("_total")


def allocate(
    parts: DataFrame, totals: DataFrame, keys: Sequence[str], weight: str, total: str, name: str = "allocated"
) -> DataFrame:
    """Spread a total over parts in proportion to a weight; the allocated values add up to the total."""
    weighted = shares(parts, keys, weight, "share_of_total")
    joined = weighted.join(totals, list(keys), "left")
    return joined.withColumn(name, F.col(total) * F.col("share_of_total"))


def _block(df: DataFrame, order: str, width: int) -> Column:
    """Which stretch of the order axis a row is in; a function of the order column alone."""
    kind = df.schema[order].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return F.floor(F.col(order) / width).cast("long")
    if kind == "date":
        return F.floor(F.unix_date(order) / width).cast("long")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.floor(F.unix_date(F.to_date(order)) / width).cast("long")
    raise ValueError(f"{order}: a block scan needs a number, a date or a timestamp to order by, or a block column of its own")


def block_scan(
    df: DataFrame, partition: Sequence[str], order: str, lags: Mapping[str, str] | None = None, totals: Mapping[str, str] | None = None,
    width: int = BLOCK_WIDTH, block: Column | None = None,
) -> DataFrame:
    """Previous values and running totals of groups of any length; the maps go from new names to source columns.

    The order axis is cut into blocks of ``width`` (or by ``block``, which must ascend with the order). Windows run inside
    the blocks of a group; each block's sums and last row are aggregated on the map side, one row a block is scanned, and
    joined back to the block's rows. Gaps count as zero in totals. Order values are unique in a group; a NULL one is the first.
    """
    lags, totals, partition = lags or {}, totals or {}, list(partition)
    keys = [*partition, "_block"]
    blocked = df.withColumn("_block", block if block is not None else _block(df, order, width))
    inside = Window.partitionBy(*keys).orderBy(order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    local = blocked.withColumns(
        {"_first": F.row_number().over(inside) == 1}
        | {f"_lag_{new}": F.lag(old).over(inside) for new, old in lags.items()}
        | {f"_sum_{new}": F.sum(number(old)).over(so_far) for new, old in totals.items()}
    )
    ends = blocked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max_by(F.struct(F.col(old).alias("v")), F.struct(order)).alias(f"_end_{new}") for new, old in lags.items()],
        *[F.sum(number(old)).alias(f"_all_{new}") for new, old in totals.items()],
    )
    between = Window.partitionBy(*partition).orderBy("_block")
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys, *[F.lag(f"_end_{new}").over(between)["v"].alias(f"_before_{new}") for new in lags],
        *[F.coalesce(F.sum(f"_all_{new}").over(before), F.lit(0)).alias(f"_from_{new}") for new in totals],
    )
    found = null_safe_join(local, carried, keys, "left").withColumns(
        {new: F.when(F.col("_first"), F.col(f"_before_{new}")).otherwise(F.col(f"_lag_{new}")) for new in lags}
        | {new: F.col(f"_from_{new}") + F.col(f"_sum_{new}") for new in totals}
    )
    return found.select(*dict.fromkeys([*df.columns, *lags, *totals]))


def _previous(df: DataFrame, partition: Sequence[str], order: str, columns: Mapping[str, str], width: int | None) -> DataFrame:
    """Previous values: in one window per entity, or by blocks where there is no entity or a width is given."""
    if partition and width is None:
        window = Window.partitionBy(*partition).orderBy(order)
        return df.withColumns({new: F.lag(old).over(window) for new, old in columns.items()})
    return block_scan(df, partition, order, lags=columns, width=width or BLOCK_WIDTH)


def with_lags(df: DataFrame, partition: Sequence[str], order: str, columns: Mapping[str, str], width: int | None = None) -> DataFrame:
    """Previous value per entity; ``columns`` maps new names to source columns. ``width`` is for entities of many periods."""
    return _previous(df, partition, order, columns, width)


def with_changes(df: DataFrame, partition: Sequence[str], order: str, columns: Mapping[str, str], width: int | None = None) -> DataFrame:
    """Difference to the previous value per entity; ``columns`` maps new names to source columns."""
    before = _previous(df, partition, order, {f"_was_{new}": old for new, old in columns.items()}, width)
    return before.withColumns({new: F.col(old) - F.col(f"_was_{new}") for new, old in columns.items()}).drop(*[f"_was_{new}" for new in columns])


def with_running_totals(df: DataFrame, partition: Sequence[str], order: str, columns: Mapping[str, str], width: int | None = None) -> DataFrame:
    """Running totals per entity, gaps counted as zero; ``columns`` maps new names to source columns."""
    if not partition or width is not None:
        return block_scan(df, partition, order, totals=columns, width=width or BLOCK_WIDTH)
    window = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({new: F.sum(F.coalesce(F.col(old), F.lit(0.0))).over(window) for new, old in columns.items()})


def change_per_change(df: DataFrame, partition: Sequence[str], order: str, y: str, x: str, name: str) -> DataFrame:
    """Change of y per change of x against the previous period."""
    changed = with_changes(df, partition, order, {f"{y}_delta": y, f"{x}_delta": x})
    return changed.withColumn(name, ratio(F.col(f"{y}_delta"), F.col(f"{x}_delta")))


def carry_forward(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    columns: Sequence[str],
    block_rows: int = 100_000,
) -> DataFrame:
    """Last non-NULL value above each row, per group, for a group of any length.

    The position axis is cut into blocks. Inside a block a window carries values forward; between blocks only the last
    value of each block is carried (one row per block), then joined back to the rows that found nothing in their own
    block. A group that holds a third of all rows is spread over as many tasks as it has blocks.
    """
    group = list(group)
    blocked = df.withColumn("_block", F.floor(F.col(position) / block_rows))
    inside = (
        Window.partitionBy(*group, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = blocked.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(inside) for c in columns})
    ends = blocked.groupBy(*group, "_block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(position))).alias(f"_end_{c}") for c in columns]
    )
    between = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *group, "_block", *[F.last(f"_end_{c}", ignorenulls=True).over(between).alias(f"_from_{c}") for c in columns]
    )
    joined = local.join(carried, [*group, "_block"], "left")
    filled = joined.withColumns({c: F.coalesce(f"_in_{c}", f"_from_{c}") for c in columns})
    return filled.drop("_block", *[f"_in_{c}" for c in columns], *[f"_from_{c}" for c in columns])
