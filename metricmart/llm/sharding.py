"""Shards of nearly equal size by minimax contiguous partition.

Documents of equal text are a group that is never split. The groups stand in the order of their texts' sha256, and a
shard is a run of neighbours. The smallest capacity that is enough for all shards is found by binary search: a greedy
pass fills one shard after the other and counts them. A group larger than the capacity has a shard of its own, so one
huge group does not raise the capacity of all others.

The pass needs to know where groups end. It knows a bounded sample of these ends: the first and the last in each of some
thousand equal steps, and how many lie between. Cutting only at known ends gives a capacity that is certainly enough,
cutting anywhere between them one that is certainly needed. While the two differ, the stretches where a cut can still
fall are sampled in finer steps, down to every single end; so the result is exact, and the driver never holds more.

As the order is that of hashes, the cuts are hashes too: a document's shard follows from its text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, body, col

POINTS = 1 << 15  # steps in which ends are sampled at once, shared by the stretches
COPIES = 1 << 16  # equal rows that one row is expanded to


def text_digest(text_col: str) -> Column:
    """sha256 of the text as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(body(text_col).cast("binary"), 256))


@dataclass
class Ends:
    """What is known of the ends of groups along the cumulated sizes.

    ``at`` ascends from 0 to the total; ``open_`` tells whether more ends lie between an entry and the one before. Where
    none do, the two enclose one group.
    """

    at: np.ndarray
    open_: np.ndarray

    @classmethod
    def unknown(cls, total: int) -> Ends:
        return cls(np.array([0, total], np.int64), np.array([False, True]))

    def cuts(self, capacity: int, anywhere: bool, most: int) -> list[int] | None:
        """Ends of the shards that a greedy pass fills; ``anywhere`` lets it cut between known ends.

        None if it needs more than ``most`` shards, or meets a stretch of unknown ends larger than the capacity.
        """
        found, here, total = [], 0, int(self.at[-1])
        while here < total:
            if len(found) == most:
                return None
            i = int(np.searchsorted(self.at, here + capacity, side="right")) - 1
            to = int(self.at[i])
            if anywhere and i + 1 < len(self.at) and self.open_[i + 1]:
                to = here + capacity
            if to <= here:
                if self.open_[i + 1]:
                    return None
                to = int(self.at[i + 1])  # one group, larger than the capacity
            found.append(to)
            here = to
        return found

    def least(self, shards: int, anywhere: bool) -> int:
        """The smallest capacity with which a greedy pass needs no more than ``shards``."""
        low, high = 1, int(self.at[-1])
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, anywhere, shards) is None:
                low = middle + 1
            else:
                high = middle
        return low

    def undecided(self, low: int, high: int, shards: int) -> list[tuple[int, int]]:
        """Stretches between known ends, some unknown inside, where a cut falls for capacities from low to high."""
        first, here = [], 0
        for _ in range(shards - 1):  # the least place of each cut
            i = int(np.searchsorted(self.at, here + low, side="right")) - 1
            if self.at[i] <= here and i + 1 < len(self.at) and not self.open_[i + 1]:
                i += 1
            here = max(here, int(self.at[i]))
            first.append(here)
        last = self.cuts(high, True, shards) or []
        last += [int(self.at[-1])] * (shards - 1 - len(last))
        spans: list[tuple[int, int]] = []
        for a, b in zip(first, last):
            i = max(int(np.searchsorted(self.at, a, side="right")) - 1, 0)
            j = min(int(np.searchsorted(self.at, b, side="left")), len(self.at) - 1)
            inside = [g for g in range(i + 1, max(j, i + 1) + 1) if g < len(self.at) and self.open_[g]]
            if inside:
                spans.append((int(self.at[inside[0] - 1]), int(self.at[inside[-1]])))
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def refined(self, span: tuple[int, int], sample: list[tuple[int, int, int]]) -> Ends:
        """With a stretch replaced by (first, last, count) of the ends in each of its steps."""
        at, open_ = [], []
        for first, last, count in sorted(sample):
            at.append(first)
            open_.append(False)
            if last > first:
                at.append(last)
                open_.append(count > 2)
        before, after = self.at <= span[0], self.at > span[1]
        return Ends(
            np.concatenate((self.at[before], np.array(at, np.int64), self.at[after])),
            np.concatenate((self.open_[before], np.array(open_, bool), self.open_[after])),
        )


def _running(units: DataFrame, scratch: Scratch) -> DataFrame:
    """Units in the order of their digests with ``end`` and ``rows_end``: size and rows of all units up to this one."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends, row_ends = size + np.cumsum(n * batch.column("size").to_numpy()), rows + np.cumsum(n)
            if batch.num_rows:
                size, rows = int(ends[-1]), int(row_ends[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64()), pa.array(row_ends, pa.int64())], names=[*batch.schema.names, "end", "rows_end"])

    order = ["digest", "id"]
    dealt = units.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    inside = scratch.store(dealt.mapInArrow(add_up, f"{schema}, end long, rows_end long"), "running")
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = inside.groupBy(F.col("part").alias("of")).agg(F.max("end").alias("size"), F.max("rows_end").alias("rows")).select(
        "of", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_start")
    )
    kept = [c for c in units.columns]
    return inside.join(starts, F.col("part") == F.col("of")).select(*kept, (F.col("end") + F.col("start")).alias("end"), (F.col("rows_end") + F.col("rows_start")).alias("rows_end"))


def _sampled(groups: DataFrame, span: tuple[int, int], points: int) -> list[tuple[int, int, int]]:
    """(first, last, count) of the ends in each of some equal steps of a stretch; at most ``points`` + 1 rows."""
    low, high = span
    step = max(1, -(-(high - low) // points))
    inside = groups.filter((F.col("end") > low) & (F.col("end") <= high))
    found = inside.groupBy(F.expr(f"(end - {low} - 1) DIV {step}").alias("step")).agg(F.min("end"), F.max("end"), F.count(F.lit(1)))
    return [(r[1], r[2], r[3]) for r in found.collect()]


def minimax_cuts(groups: DataFrame, total: int, shards: int, points: int = POINTS) -> list[int]:
    """Ends of the shards; ``groups`` has the cumulated size ``end`` of every group, ``total`` is the last."""
    ends = Ends.unknown(total)
    while True:
        enough, needed = ends.least(shards, False), ends.least(shards, True)
        spans = ends.undecided(needed, enough, shards) if needed < enough else []
        if not spans:
            return ends.cuts(enough, False, shards)
        for span in spans:
            ends = ends.refined(span, _sampled(groups, span, max(16, points // len(spans))))


@dataclass
class Shards:
    """``documents`` (id_col, size, crc, shard, slot) and ``cuts``, the largest digest of each shard but the last."""

    documents: DataFrame
    cuts: list[bytes]
    text_col: str

    def shard_of(self) -> Column:
        """The shard of a document by its text, for rows of the table that was cut and for others."""
        if not self.cuts:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(c) for c in self.cuts]), lambda c: c < text_digest(self.text_col)))

    def write(self, docs: DataFrame, path: str, shard_col: str = "shard") -> None:
        """Write the documents, one folder a shard. Needs no join and no shuffle, and leaves their columns as they are."""
        docs.withColumn(shard_col, self.shard_of()).write.partitionBy(shard_col).parquet(path)


def minimax_shards(docs: DataFrame, scratch: Scratch, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> Shards:
    """Cut ``docs`` into at most ``shards`` (up to some thousand) runs of whole groups of equal texts.

    The size of a row is its text's bytes plus 1; ``slot`` numbers a shard's rows from 0 in the order of digest and id.
    No shard of more than one group is larger than the smallest possible such capacity. Null texts count as empty ones,
    null ids come first, rows equal in id and text take consecutive slots, texts of any length are read whole but not
    shuffled, other columns play no part, and an empty table has no shards.
    """
    narrow = docs.select(
        col(id_col).alias("id"), text_digest(text_col).alias("digest"), (F.octet_length(body(text_col)) + 1).cast("long").alias("size"),
        F.crc32(body(text_col).cast("binary")).alias("crc"),
    )
    units = narrow.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.max("crc").alias("crc"))
    placed = _running(scratch.store(units, "units"), scratch)
    groups = scratch.store(placed.groupBy("digest").agg(F.max("end").alias("end"), F.max("rows_end").alias("rows_end")), "groups")
    total = groups.agg(F.max("end")).first()[0]
    cuts = minimax_cuts(groups, total, shards)[:-1] if total else []
    at_cuts = sorted(groups.filter(F.col("end").isin(cuts)).select("end", "rows_end", "digest").collect()) if cuts else []
    bounds = F.array(F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("rows")), *[
        F.struct(F.lit(r["end"]).cast("long").alias("end"), F.lit(r["rows_end"]).cast("long").alias("rows")) for r in at_cuts
    ])
    shard = F.size(F.filter(bounds, lambda c: c["end"] < F.col("end"))) - 1
    first = F.col("rows_end") - F.col("n") - F.element_at(bounds, F.col("shard") + 1)["rows"]
    runs = placed.withColumn("shard", shard).withColumn("first", first).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    copies = F.explode(F.sequence(F.col("start"), F.least(F.col("start") + COPIES, F.col("n")) - 1))
    found = runs.withColumn("copy", copies).select(F.col("id").alias(id_col), "size", "crc", "shard", (F.col("first") + F.col("copy")).alias("slot"))
    return Shards(found, [bytes(r["digest"]) for r in at_cuts], text_col)
