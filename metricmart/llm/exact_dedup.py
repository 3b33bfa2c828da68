"""Exact deduplication by progressive refinement: length, then a hash of the beginning, then the hash of the whole text.

A step only looks at rows whose group of the step before has at least two. The first scan counts lengths and beginnings
of texts in a narrow table; the second hashes whole texts, only of rows that share both (by a bitmap of the shared
beginnings, so no text is shuffled to find that out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, body, col, fresh, membership


def _shared_heads(rows: DataFrame, length: str, head: str, scratch: Scratch) -> DataFrame:
    """(length, head hash) pairs that at least two rows have."""
    counts = scratch.store(rows.groupBy(length, head).count(), "heads")
    lengths = counts.groupBy(length).agg(F.sum("count").alias("rows")).filter("rows > 1").select(length)
    pairs = counts.join(lengths, length, "left_semi").filter("count > 1")
    return scratch.store(pairs.select(length, head, F.lit(True).alias("survives")), "survivors")


def exact_groups(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    head_chars: int = 256,
    digest_col: str | None = None,
) -> DataFrame:
    """Groups of equal texts; one row per row of ``docs``.

    Returns ``id_col``, ``length`` (bytes), ``head`` and ``mark`` (64-bit hashes; mark is null for texts that no other
    row can equal), ``digest`` (sha256, computed only for rows that share length and head, unless ``digest_col`` names
    a column that has it already), ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest id stays. A null id
    is smaller than any other. Of repeated rows (same id and text) exactly one stays. An empty table gives no rows.
    Other columns of ``docs`` play no part, whatever their names. Groups of any size are counted with partial
    aggregation; only hashes are shuffled, never texts.
    """
    source = docs.select(
        col(id_col).alias("id"), body(text_col).alias("content"),
        *([col(digest_col).alias("given")] if digest_col else []),
    )
    rows = source.withColumns({
        "length": F.octet_length("content").cast("long"), "head": F.xxhash64(F.substring("content", 1, head_chars)),
    })
    heads = _shared_heads(rows, "length", "head", scratch)
    shared = membership(heads.select("length", "head"), scratch)(F.col("length"), F.col("head"))
    hashed = rows.select(
        "id", "length", "head", F.when(shared, F.xxhash64("content")).alias("mark"),
        (F.col("given") if digest_col else F.when(shared, F.sha2("content", 256))).alias("digest"),
    )
    marked = scratch.store(
        scratch.store(hashed, "hashed").join(heads, ["length", "head"], "left")
        .withColumns({"survives": F.col("survives").isNotNull(), "mark": F.when(F.col("survives").isNotNull(), F.col("mark"))}),
        "digests",
    )
    alone = marked.filter(~F.col("survives")).select(
        "id", "length", "head", "mark", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    key = ["length", "head", "digest"]
    by_id = marked.filter("survives").groupBy(*key, "id").agg(F.count(F.lit(1)).alias("copies"), F.min("mark").alias("mark"))
    groups = by_id.groupBy(*key).agg(F.max(F.struct("id")).alias("top"), F.sum("copies").alias("group_size"))
    repeated = by_id.join(groups, key).select(
        "id", "length", "head", "mark", "digest", F.col("top.id").alias("keep_id"), "group_size",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    shared = repeated.select(
        "id", "length", "head", "mark", "digest", "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
    )
    return alone.unionByName(shared).withColumnRenamed("id", id_col)


def drop_exact(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", head_chars: int = 256
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are.

    Only texts of rows that may go are shuffled. Which row stays is as in :func:`exact_groups`; of repeated rows with one id and text, the first in the order of
    their other columns.
    """
    length, mark, verdict, vid, vlength, vmark = fresh(docs, "length", "mark", "verdict", "judged_id", "judged_length", "judged_mark")
    groups = exact_groups(docs, scratch, id_col, text_col, head_chars).filter("mark IS NOT NULL")
    verdicts = scratch.store(
        groups.groupBy(F.col(id_col).alias("id"), "length", "mark")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("kept").alias("stays"))
        .filter("NOT stays OR copies > 1")
        .select(F.col("id").alias(vid), F.col("length").alias(vlength), F.col("mark").alias(vmark),
                F.when(F.col("stays"), "one").otherwise("none").alias(verdict)),
        "verdicts",
    )
    maybe = membership(verdicts.select(vid), scratch)(col(id_col))
    marked = docs.filter(maybe).withColumns({length: F.octet_length(body(text_col)).cast("long"), mark: F.xxhash64(body(text_col))})
    judged = marked.join(
        verdicts.hint("merge"),
        col(id_col).eqNullSafe(F.col(vid)) & (F.col(length) == F.col(vlength)) & (F.col(mark) == F.col(vmark)),
        "left",
    )
    names = [col(c) for c in docs.columns]
    out = docs.filter(~maybe).unionAll(judged.filter(F.col(verdict).isNull()).select(*names))
    if verdicts.filter(F.col(verdict) == "one").isEmpty():
        return out
    order = [col(c).cast("string") for c in docs.columns]
    (rank,) = fresh(judged, "rank")
    first = judged.filter(F.col(verdict) == "one").withColumn(
        rank, F.row_number().over(Window.partitionBy(col(id_col), F.col(length), F.col(mark)).orderBy(*order))
    )
    return out.unionAll(first.filter(F.col(rank) == 1).select(*names))
