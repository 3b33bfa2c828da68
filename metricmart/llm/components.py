"""Connected components of a graph of links, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch

TASK_ROWS = 100_000  # links or hooks that one task has at least

def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` (a, b) → (node, component): the smallest node reachable. Nodes without links do not appear.

    Each round, every node that is the larger end of a link hooks onto its smallest neighbour, hooks are followed twice,
    and links are carried over to what their ends then hook onto; links within a component vanish. So chains shrink to a
    quarter a round, and a hub costs no more than its links: hooks are aggregates, all else equi-joins with one row a node.
    In the end the hooks of the rounds are followed backwards, from the last to the first.
    """
    edges = scratch.store(_canonical(links.select("a", "b")), "edges")
    rounds: list[DataFrame] = []
    while left := edges.count():
        tasks = left // TASK_ROWS + 1  # few links need few tasks, however many partitions the session shuffles to
        first = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        nearest = scratch.store(first.coalesce(tasks), "hooks")
        hooks = scratch.store(_moved(_moved(nearest, "parent", nearest), "parent", nearest), "hooks")
        rounds.append(hooks)
        edges = scratch.store(_canonical(_moved(_moved(edges, "a", hooks), "b", hooks)).coalesce(tasks), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # what a node hooks onto may hook in a later round; a node that hooks in several comes to the same component by each
    found = rounds[-1].select("node", F.col("parent").alias("component"))
    for hooks in reversed(rounds[:-1]):
        later = scratch.store(found, "found")
        found = later.unionAll(_moved(hooks.select("node", F.col("parent").alias("component")), "component", later.toDF("node", "parent"))).distinct()
    found = scratch.store(found, "found")
    return found.unionAll(found.select("component").distinct().select(F.col("component").alias("node"), "component"))


def _canonical(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b"), F.greatest("a", "b")
    return edges.filter("a <> b").select(low.alias("a"), high.alias("b")).distinct()


def _moved(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """The column replaced by what it hooks onto."""
    to = hooks.select(F.col("node").alias("_from"), F.col("parent").alias("_to"))
    rest = [c for c in df.columns if c != column]
    return df.join(to, F.col(column) == F.col("_from"), "left").select(*rest, F.coalesce("_to", column).alias(column))
