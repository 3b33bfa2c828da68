"""Upserts from a stream: every micro-batch is one run of a partitioned fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metricmart.sources.versions import PartitionedFact


def run_of(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def load_batch(
    rows: DataFrame, batch_id: int, base: str, table: str, keys: Sequence[str], columns: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None, start_from: str | None = None,
) -> PartitionedFact:
    """Merge one micro-batch. It starts from the version of the batch before, so a batch that is replayed after a failure
    writes the same version again. ``start_from`` is the run whose version the first batch starts from."""
    previous = run_of(batch_id - 1) if batch_id else start_from
    fact = PartitionedFact(rows.sparkSession, base, table, run_of(batch_id), previous)
    fact.merge(rows, keys, columns, prepare=prepare)
    return fact


def stream_into(
    stream: DataFrame, base: str, table: str, keys: Sequence[str], columns: Sequence[str], checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None, start_from: str | None = None, **trigger: object,
) -> StreamingQuery:
    """Keep a partitioned fact up to date from a stream; ``trigger`` as for ``writeStream``, by default all that is there.

    Each batch rewrites the partitions it brings rows for. ``prepare`` makes one row a key of a batch. The checkpoint folder
    holds the stream's offsets: with it a stopped stream goes on where it was.
    """

    def merge(rows: DataFrame, batch_id: int) -> None:
        load_batch(rows, batch_id, base, table, keys, columns, prepare, start_from)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def current(spark, base: str, table: str, last_batch: int) -> DataFrame | None:
    """The fact as the given batch left it."""
    return PartitionedFact(spark, base, table, "reader", run_of(last_batch)).read()
