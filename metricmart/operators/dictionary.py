"""Dear functions of texts that repeat, computed once for each distinct text."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.session import stored


def with_resolved(df: DataFrame, resolve: Mapping[str, tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """Add columns that are functions of text columns; ``resolve`` maps a new name to (text column, function).

    The distinct texts of all columns are gathered in one pass, combined on the map side, resolved once and stored: period
    tokens take some ten patterns each, and a column has as many distinct ones as there are periods. Then they are looked
    up by joins, which broadcast the dictionary while it is small. A function is only evaluated for texts of its own
    column. Runs one job.
    """
    columns = list(dict.fromkeys(text for text, _ in resolve.values()))
    place = {c: i for i, c in enumerate(columns)}
    pairs = F.array(*[F.struct(F.lit(i).alias("of"), F.col(f"`{c}`").cast("string").alias("text")) for c, i in place.items()])
    distinct = df.select(F.explode(pairs).alias("_p")).select("_p.of", "_p.text").distinct()
    values = [F.when(F.col("of") == place[text], function(F.col("text"))).alias(name) for name, (text, function) in resolve.items()]
    known = stored(distinct.select("of", "text", *values))

    def looked_up(rows: DataFrame, text: str) -> DataFrame:
        names = [n for n, (t, _) in resolve.items() if t == text]
        mine = known.filter(F.col("of") == place[text]).select(F.col("text").alias("_text"), *names)
        return rows.join(mine, F.col(f"`{text}`").cast("string").eqNullSafe(F.col("_text")), "left").drop("_text")

    return reduce(looked_up, columns, df)
