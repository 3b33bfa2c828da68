"""Mixing sources to target weights by pivotal dependent rounding.

Each document gets a copy rate, its source's target over its source's size. The whole part is taken at once; the rest
is a fractional copy. Fractional copies meet in pairs: probability mass, measured in words, moves at random from one to
the other until one of the two is whole, so that the words a source takes stay at its target throughout, and each
document is taken with its own probability. Large documents meet first, so that what is left open at the end is small.
Pairs meet first within blocks of a source; what a block leaves over (one
document at most) meets the leftovers of other blocks in a reduction tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, body, col, fresh, word_count


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered by code point, null last, without sending them through one task."""
    spark = sources.sparkSession
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    numbered = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    return spark.createDataFrame(numbered, "source string, source_size long, n_units long, rank long")


def source_targets(
    sizes: DataFrame, scratch: Scratch, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0
) -> DataFrame:
    """Target size of each source. ``sizes``: source, source_size, n_units.

    Sources in code point order (null last) weigh ``weights``, repeating; together they get ``share`` times all sizes.
    A target stops at ``ceiling`` times its source's size; the excess is shared again by weight until none is above.
    Each step of that search is one aggregate of the table of sources. Sources without words get 0.
    """
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = scratch.store(_ranked(sizes).withColumn("weight", weigh).withColumn("most", ceiling * F.col("source_size")), "sources")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return table.withColumn("target", F.lit(0.0))
    level = share * total / weight
    while True:
        full = F.lit(level) * F.col("weight") >= F.col("most")
        held, free = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        following = level if not free else (share * total - (held or 0.0)) / free
        if following <= level:
            break
        level = following
    return table.withColumn("target", F.least("most", F.lit(level) * F.col("weight")))


def _uniform(draw: int, count: int) -> float:
    """A number in [0, 1) from a row's hash and its place in the block."""
    x = (draw + 0x9E3779B97F4A7C15 * (count + 1)) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def meet(size_i: float, mass_i: float, size_j: float, mass_j: float, u: float) -> tuple[float, float]:
    """Move mass between two fractional units until one is empty or full; the sum and both expectations stay."""
    to_i, to_j = min(size_i - mass_i, mass_j), min(mass_i, size_j - mass_j)
    if u * (to_i + to_j) < to_j:
        return (size_i if to_i == size_i - mass_i else mass_i + to_i), (0.0 if to_i == mass_j else mass_j - to_i)
    return (0.0 if to_j == mass_i else mass_i - to_j), (size_j if to_j == size_j - mass_j else mass_j + to_j)


def _settle(last: bool):
    """Rows sorted by source and block → the same rows with mass 0 or the whole size, and one open row a block.

    ``last``: the open row of each block is settled by its own draw.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, count, schema = None, None, 0, None
        for batch in batches:
            schema = batch.schema
            words, mass, draw, source, block, done = map(schema.names.index, ("words", "mass", "draw", "source", "block", "done"))
            out = []

            def close(row: list | None) -> None:
                if row is not None:
                    if last:
                        row[mass] = row[words] if _uniform(row[draw], 0) * row[words] < row[mass] else 0.0
                        row[done] = True
                    out.append(row)

            for row in zip(*(c.to_pylist() for c in batch.columns)):
                row = list(row)
                if (row[source], row[block]) != group:
                    close(waiting)
                    group, waiting, count = (row[source], row[block]), None, 0
                count += 1
                row[done] = not 0.0 < row[mass] < row[words]
                if row[done]:
                    out.append(row)
                elif waiting is None:
                    waiting = row
                else:
                    u = _uniform(row[draw], count)
                    waiting[mass], row[mass] = meet(waiting[words], waiting[mass], row[words], row[mass], u)
                    still = [r for r in (waiting, row) if 0.0 < r[mass] < r[words]]
                    for r in (waiting, row):
                        if all(r is not x for x in still):
                            r[done] = True
                            out.append(r)
                    waiting = still[0] if still else None
            yield _batch(out, schema)
        if waiting is not None:
            out = []
            close(waiting)
            yield _batch(out, schema)

    return settle


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def mix_units(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    ceiling: float = 2.0,
    block_rows: int = 2000,
    fanout: int = 64,
    seed: int = 17,
) -> DataFrame:
    """How many copies of each document a mix takes.

    Rows alike in id, source and text are one unit of ``n_rows`` rows and are taken alike. Returns per unit ``id``,
    ``source``, ``mark`` (hash of the text), ``n_rows``, ``size`` (words of one row), ``source_size``, ``target`` and
    ``copies`` (0 to ``ceiling``). The words a source takes differ from its target by less than one unit. Null and
    empty texts have no words and are never taken; a null id or source is a value like any other; an empty table gives
    no rows. Draws are hashes of the id and the order in a block is fixed, so reruns agree. Blocks hold about
    ``block_rows`` units, whatever a source's share of all rows.
    """
    units = scratch.store(
        docs.select(col(id_col).alias("id"), col(source_col).cast("string").alias("source"),
                    F.xxhash64(body(text_col)).alias("mark"), word_count(text_col).alias("size"))
        .groupBy("id", "source", "mark", "size").agg(F.count(F.lit(1)).alias("n_rows")),
        "units",
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n_rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units")
    )
    targets = source_targets(sizes, scratch, weights, share, ceiling)
    joined = units.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
    ).withColumn("rate", F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    blocks = F.greatest(F.ceil(F.col("n_units") / block_rows), F.lit(1)).cast("long")
    start = joined.select(
        "id", "source", "mark", "n_rows", "size", "source_size", "target", F.floor("rate").cast("int").alias("whole"),
        (F.col("size") * F.col("n_rows")).cast("double").alias("words"),
        (F.col("size") * F.col("n_rows") * (F.col("rate") - F.floor("rate"))).alias("mass"),
        F.pmod(F.xxhash64(F.lit(seed), "id", "mark"), blocks).alias("block"),
        F.xxhash64(F.lit(seed + 1), "id", "mark").alias("draw"), F.lit(False).alias("done"),
    )
    most = (targets.agg(F.max("n_units")).first()[0] or 0) // block_rows + 1
    parts, rows = [], start
    while True:
        last = most <= 1
        level = scratch.store(
            rows.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("words"), "draw", "id", "mark")
            .mapInArrow(_settle(last), start.schema),
            "level",
        )
        parts.append(level.filter("done"))
        if last:
            break
        rows = level.filter("NOT done").withColumn("block", F.floor(F.col("block") / fanout).cast("long"))
        most = -(-most // fanout)
    settled = parts[0]
    for part in parts[1:]:
        settled = settled.unionByName(part)
    return settled.select(
        "id", "source", "mark", "n_rows", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        (F.col("whole") + (F.col("mass") > 0).cast("int")).alias("copies"),
    ).withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(0))


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns as they are."""
    mark, copies, uid, usource, umark = fresh(docs, "mark", "copies", "unit_id", "unit_source", "unit_mark")
    units = mix_units(docs, scratch, id_col, text_col, source_col, **options).filter("copies > 0").select(
        F.col("id").alias(uid), F.col("source").alias(usource), F.col("mark").alias(umark), F.col("copies").alias(copies)
    )
    joined = docs.withColumn(mark, F.xxhash64(body(text_col))).join(
        units,
        col(id_col).eqNullSafe(F.col(uid)) & col(source_col).cast("string").eqNullSafe(F.col(usource)) & (F.col(mark) == F.col(umark)),
    )
    names = [col(c) for c in docs.columns]
    return joined.select(*names, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).select(*names)
