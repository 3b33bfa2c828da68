"""Small inline tables (seed dimensions, header rows, rule tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str) -> DataFrame:
    """A DataFrame of literals, built inside the plan.

    Catalyst knows its size, so joins to it are broadcast by the size rule, and no Python worker is involved.
    """
    fields = T._parse_datatype_string(schema).fields
    if not rows:
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return spark.range(0).select(*empty)

    def cell(value: object, field: T.StructField):
        column = F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value)
        return column.cast(field.dataType).alias(field.name)

    structs = [F.struct(*[cell(v, f) for v, f in zip(row, fields, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
