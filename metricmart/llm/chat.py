"""Chat formatting after cumulative-snapshot collapse.

Chat logs often hold every state of a conversation: after two turns, after four, after six. Each turn gets the rolling
hash of all turns up to it; a conversation whose last hash is that of an inner turn of a longer one is a snapshot of it
and goes. The maximal conversations are rendered. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, col

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PREFIX = ["n", "h1", "h2"]


def numbered_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, n, role, text, h1, h2): turns of each conversation numbered from 1, with the hash of all up to each.

    The order is by turn, then role, then text, nulls first. The hash combines, by exclusive or, a hash of each turn with
    its number, so that it rolls along a window without holding the conversation; two seeds make 128 bits.
    """
    rows = turns.select(col(conv_col).alias("conv"), col(turn_col).alias("turn"), col(role_col).cast("string").alias("role"), col(text_col).cast("string").alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rolling = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # nulls are hashed as values of their own: a null argument would leave the hash unchanged
    said = [F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")), F.col("role").isNull(), F.col("text").isNull()]
    return (
        rows.withColumn("n", F.row_number().over(order).cast("long"))
        .withColumns({"t1": F.xxhash64("n", *said), "t2": F.xxhash64(F.lit(7), "n", *said)})
        .withColumns({"h1": F.bit_xor("t1").over(rolling), "h2": F.bit_xor("t2").over(rolling)})
        .select("conv", "n", "role", "text", "h1", "h2")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n) of the conversations that are neither a snapshot of a longer one nor a repetition of an equal one.

    Of equal conversations the one with the smallest id stays, a null id last. ``turns`` as from :func:`numbered_turns`.
    """
    ends = turns.groupBy("conv").agg(F.max(F.struct(*PREFIX)).alias("end")).select("conv", "end.*")
    inner = (
        turns.select("conv", *PREFIX).join(ends.select(F.col("conv").alias("of"), F.col("n").alias("last")), F.col("conv").eqNullSafe(F.col("of")))
        .filter("n < last").select(*PREFIX).distinct()
    )
    unique = ends.groupBy(*PREFIX).agg(F.min(F.struct(F.col("conv").isNull().alias("missing"), "conv")).alias("first")).select("first.conv", *PREFIX)
    return unique.join(inner, PREFIX, "left_anti").select("conv", "n")


def rendered_turn(role: Column, text: Column) -> Column:
    """One turn in the template; markers inside a role or a text are broken by a blank, so none can forge a turn."""
    safe = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPEN), safe(role), F.lit("\n"), safe(text), F.lit(f"{CLOSE}\n"))


def chat_documents(
    turns: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Maximal conversations as chat text: ``conv_col``, ``n_turns``, ``rendered``.

    A conversation is a snapshot if its turns (role and text) are the first turns of a longer one; of equal ones one
    stays. Repeated rows are turns of their own. Null roles and texts are rendered as empty but differ from empty ones
    when compared; rows without a conversation id form one conversation. An empty table gives no rows. Shared first
    turns are counted once per hash before they are shuffled; only turns that stay are gathered, each conversation into
    its own row.
    """
    numbered = scratch.store(numbered_turns(turns, conv_col, turn_col, role_col, text_col), "turns")
    kept = maximal(numbered.drop("role", "text")).select(F.col("conv").alias("of"), F.col("n").alias("n_turns"))
    rows = numbered.join(kept, F.col("conv").eqNullSafe(F.col("of"))).select("conv", "n_turns", "n", rendered_turn(F.col("role"), F.col("text")).alias("said"))
    return rows.groupBy("conv", "n_turns").agg(F.sort_array(F.collect_list(F.struct("n", "said"))).alias("parts")).select(
        F.col("conv").alias(conv_col), "n_turns", F.array_join("parts.said", "").alias("rendered")
    )
