"""Merkle manifest of a dataset, its leaves placed by rank queries on bitmaps.

Each row is a leaf; the leaves of a group (a source) ascend by id, and every 16 neighbours become one node until one is
left, the group's subroot. The subroots, ordered by group, become the root in the same way.

Where a leaf stands is not found by sorting. Tasks put the ids they see into one compressed bitmap for each group and chunk
of 65,536 ids (a list of 16-bit numbers while that is shorter); the bitmaps of a chunk are merged, and their
counts, added up over a radix directory of chunks, tell how many rows of the group lie below the chunk. The rank of an id
is that number plus the set bits below it in its own bitmap, read from a directory of byte counts. Rows that share an id
are told apart by a second index of the same kind over their leaf hashes.

Levels are then built by keyed slot arrays: nodes meet under (group, place div 16) in the slot place mod 16.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, col, fresh

FAN = 16  # children of a node
CHUNK_BITS = 16  # ids of one bitmap
RADIX_BITS = 12  # chunks that one entry of the next directory level covers, as a power of two
HELD_ROWS = 1 << 18  # ids that a task gathers before it makes bitmaps of them
PART_ROWS = 1 << 18  # rows of a chunk (repeated ids) that one task ranks
COPIES = 1 << 16  # equal rows that one row of the last step is expanded to
PATH = "array<struct<left:string,right:string>>"


def hashed(text: Column) -> Column:
    """Lowercase hex sha256 of a text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as part of a leaf: its length in UTF-8 bytes, a colon and the value; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Hash of a row's fields."""
    return hashed(F.concat(*[field(v) for v in values]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path (siblings to its left and right, level by level) give."""
    return F.aggregate(path, leaf, lambda node, step: hashed(F.concat(step["left"], node, step["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


class Bitmap:
    """Which of 65,536 ids are there, and how many rows those that are repeated have."""

    def __init__(self, bits: bytes, repeats: bytes):
        if len(bits) == 1 << (CHUNK_BITS - 3):
            self.bytes, self.lows = np.frombuffer(bits, np.uint8), None
            counts = np.bitwise_count(self.bytes)
            self.directory = np.cumsum(counts, dtype=np.int64) - counts
        else:
            self.lows = np.frombuffer(bits, np.uint16)
        pairs = np.frombuffer(repeats, np.int64).reshape(2, -1)
        self.repeated, self.more = pairs[0], pairs[1]
        self.more_below = np.concatenate(([0], np.cumsum(self.more)))

    @staticmethod
    def encode(lows: np.ndarray, rows: np.ndarray) -> tuple[bytes, bytes]:
        """Ascending distinct ids and the rows of each, as (bits, repeats)."""
        if 2 * len(lows) < 1 << (CHUNK_BITS - 3):
            bits = lows.astype(np.uint16).tobytes()
        else:
            flags = np.zeros(1 << CHUNK_BITS, np.uint8)
            flags[lows] = 1
            bits = np.packbits(flags, bitorder="little").tobytes()
        many = rows > 1
        return bits, np.stack([lows[many].astype(np.int64), rows[many] - 1]).tobytes()

    def decode(self) -> tuple[np.ndarray, np.ndarray]:
        lows = np.flatnonzero(np.unpackbits(self.bytes, bitorder="little")) if self.lows is None else self.lows.astype(np.int64)
        rows = np.ones(len(lows), np.int64)
        rows[np.searchsorted(lows, self.repeated)] += self.more
        return lows, rows

    def rank(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows below, rows) of each of the ids, all of which are there."""
        if self.lows is None:
            at = ids >> 3
            below = self.directory[at] + np.bitwise_count(self.bytes[at] & ((1 << (ids & 7)) - 1).astype(np.uint8))
        else:
            below = np.searchsorted(self.lows, ids)
        place = np.searchsorted(self.repeated, ids)
        found = np.zeros(len(ids), np.int64)
        if len(self.repeated):
            inside = np.minimum(place, len(self.repeated) - 1)
            found = np.where(self.repeated[inside] == ids, self.more[inside], 0)
        return below + self.more_below[place], found + 1


def _bitmaps(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, id, rows) → (grp, chunk, bits, repeats, rows): one bitmap for each group and chunk of ids. Null ids are a chunk."""
    schema = "grp string, chunk long, bits binary, repeats binary, rows long"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD_ROWS:
                yield made(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield made(pa.Table.from_batches(held))

    def made(table: pa.Table) -> pa.RecordBatch:
        groups = table.column("grp").combine_chunks().dictionary_encode()
        group = groups.indices.to_numpy()
        ids = table.column("id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids, rows = ids.fill_null(0).to_numpy(), table.column("rows").to_numpy()
        order = np.lexsort((ids, ~null, group))
        group, null, ids, rows = group[order], null[order], ids[order], rows[order]
        new = np.ones(len(ids), bool)
        new[1:] = (group[1:] != group[:-1]) | (null[1:] != null[:-1]) | (ids[1:] != ids[:-1])
        first = np.flatnonzero(new)
        rows, group, null, ids = np.add.reduceat(rows, first), group[first], null[first], ids[first]
        chunk = ids >> CHUNK_BITS
        starts = np.ones(len(ids), bool)
        starts[1:] = (group[1:] != group[:-1]) | (null[1:] != null[:-1]) | (chunk[1:] != chunk[:-1])
        starts = np.flatnonzero(starts)
        pieces = [Bitmap.encode(ids[a:b] & ((1 << CHUNK_BITS) - 1), rows[a:b]) for a, b in zip(starts, np.append(starts[1:], len(ids)))]
        return pa.RecordBatch.from_arrays(
            [groups.dictionary.take(pa.array(group[starts])), pa.array(chunk[starts], mask=null[starts]), pa.array([p[0] for p in pieces], pa.binary()),
             pa.array([p[1] for p in pieces], pa.binary()), pa.array(np.add.reduceat(rows, starts))],
            names=names,
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lows, rows, out = None, [], [], []

        def compact() -> None:
            both, at = np.unique(np.concatenate(lows), return_inverse=True)
            summed = np.zeros(len(both), np.int64)
            np.add.at(summed, at, np.concatenate(rows))
            lows[:], rows[:] = [both], [summed]

        def done() -> tuple:
            compact()
            return (*key, *Bitmap.encode(lows[0], rows[0]), int(rows[0].sum()))

        def batch_of(items: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*items), kinds)], names=names)

        for batch in batches:
            for grp, chunk, bits, repeats, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if (grp, chunk) != key:
                    if key is not None:
                        out.append(done())
                    key, lows, rows = (grp, chunk), [], []
                    if len(out) >= 512:
                        yield batch_of(out)
                        out = []
                for to, part in zip((lows, rows), Bitmap(bits, repeats).decode()):
                    to.append(part)
                if len(lows) >= 64:
                    compact()
        if key is not None:
            out.append(done())
            yield batch_of(out)

    pieces = rows.select("grp", "id", "rows").mapInArrow(gather, schema)
    return scratch.store(pieces.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk").mapInArrow(merge, schema), "bitmaps")


def _directory(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """``chunks`` with ``below``, the rows of their group in chunks before (null is the first), and ``n``, all rows of the group.

    A radix directory: each level sums up to 4,096 entries of the one before, so no window holds more.
    """
    least, most = chunks.agg(F.min("chunk"), F.max("chunk")).first()
    span = (most - least).bit_length() if least is not None else 0
    top = -(-span // RADIX_BITS)
    base = F.lit(least or 0)
    level = chunks.select("grp", (F.col("chunk") - base).alias("key"), "rows")
    found = chunks.withColumn("below", F.lit(0).cast("long"))
    for step in range(top + 1):
        last = step == top
        parent = F.shiftright("key", RADIX_BITS)
        within = Window.partitionBy("grp") if last else Window.partitionBy("grp", parent)
        before = F.coalesce(F.sum("rows").over(within.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        all_rows = [F.sum("rows").over(within).alias("n")] if last else []
        entries = level.select(F.col("grp").alias("of"), "key", before.alias("before"), *all_rows)
        if top:
            entries = scratch.store(entries, "directory")
        mine = F.shiftright(F.col("chunk") - base, RADIX_BITS * step)
        found = found.join(entries, (F.col("grp") == F.col("of")) & mine.eqNullSafe(F.col("key")))
        found = found.withColumn("below", F.col("below") + F.col("before")).drop("of", "key", "before")
        level = level.groupBy("grp", parent.alias("key")).agg(F.sum("rows").alias("rows"))
    return scratch.store(found, "chunks")


def ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, id, rows, …) → the same with ``below``, the rows of the group with smaller ids (null is the smallest), ``same``, those with this id, and ``n``, all of them.

    Rows meet their chunk's bitmap by hash partitioning; a chunk of many rows (repeated ids) is dealt to parts.
    """
    chunks = _directory(_bitmaps(rows, scratch), scratch)
    parts = F.ceil(F.col("rows") / PART_ROWS).cast("long")
    carried = [c for c in rows.columns if c not in ("grp", "id", "rows")]
    chunk = F.shiftright("id", CHUNK_BITS)
    large = chunks.filter(parts > 1).select(F.col("grp").alias("of"), F.col("chunk").alias("its"), parts.alias("parts"))
    seats = rows.withColumn("chunk", chunk).join(large, (F.col("grp") == F.col("of")) & F.col("chunk").eqNullSafe(F.col("its")), "left")
    spread = F.pmod(F.xxhash64("id", *carried), F.coalesce("parts", F.lit(1).cast("long")))
    seats = seats.select("grp", "chunk", spread.alias("part"), F.lit(1).alias("role"), "id", "rows", *carried)
    maps = chunks.select("grp", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(0).alias("role"), "bits", "repeats", "below", "n")
    met = seats.unionByName(maps, allowMissingColumns=True).repartition("grp", "chunk", "part").sortWithinPartitions("grp", "chunk", "part", "role")
    kept = ["grp", "id", "rows", *carried]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, start, n = None, 0, 0
        for batch in batches:
            roles = batch.column("role").to_numpy()
            ids = batch.column("id").fill_null(0).to_numpy() & ((1 << CHUNK_BITS) - 1)
            below, same, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            heads = np.flatnonzero(roles == 0)
            for head, a, b in zip([None, *heads], np.append(0, heads + 1), np.append(heads, batch.num_rows)):
                if head is not None:
                    bits, repeats, start, n = (batch.column(c)[int(head)].as_py() for c in ("bits", "repeats", "below", "n"))
                    bitmap = Bitmap(bits, repeats)
                if b > a:
                    below[a:b], same[a:b] = bitmap.rank(ids[a:b])
                    below[a:b] += start
                    total[a:b] = n
            full = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, (below, same, total))], names=[*kept, "below", "same", "n"])
            yield full.filter(pa.array(roles == 1))

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return scratch.store(met.mapInArrow(place, f"{schema}, below long, same long, n long"), "ranked")


def _placed(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, id, leaf, more) → the same with ``pos``, its place in the group by id, then leaf, and ``n``."""
    found = ranked(leaves.withColumn("rows", F.lit(1).cast("long")), scratch)
    kept = ["grp", "id", "leaf", "more"]
    alone = found.filter("same = 1").select(*kept, F.col("below").alias("pos"), "n")
    # rows that share an id: equal ones are one row until the end, others rank by the first 48 bits of their leaf
    tied = scratch.store(found.filter("same > 1").groupBy(*kept, "below", "n").agg(F.count(F.lit(1)).alias("rows")), "tied")
    if tied.isEmpty():
        return alone
    inner = tied.select(
        F.concat("grp", F.lit("\n"), F.coalesce(F.col("id").cast("string"), F.lit("-"))).alias("grp"),
        F.conv(F.substring("leaf", 1, 12), 16, 10).cast("long").alias("id"), "rows", F.struct("grp", "id", "leaf", "more", "below", "n").alias("row"),
    )
    by_leaf = Window.partitionBy("grp", "id").orderBy("row.leaf").rowsBetween(Window.unboundedPreceding, -1)
    inner = ranked(inner, scratch).withColumn("first", F.col("row.below") + F.col("below") + F.coalesce(F.sum("rows").over(by_leaf), F.lit(0)))
    runs = scratch.store(inner.select(*[F.col("row")[c].alias(c) for c in (*kept, "n")], "rows", "first"), "runs_of_equals")
    runs = runs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(COPIES).cast("long"))).alias("start"))
    each = F.explode(F.sequence(F.col("start"), F.least(F.col("start") + COPIES, F.col("rows")) - 1))
    copies = runs.repartition("first", "start").select(*kept, "n", "first", each.alias("copy"))
    return alone.unionByName(copies.select(*kept, (F.col("first") + F.col("copy")).alias("pos"), "n"))


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


@dataclass
class _Tree:
    """The runs of every level below the roots of some groups, and these roots."""

    leaves: DataFrame  # grp, pos, n, digest, more
    levels: list[DataFrame]  # grp, run, n, slots
    roots: DataFrame  # grp, digest


def _reduced(nodes: DataFrame, most: int, scratch: Scratch) -> _Tree:
    """Nodes (grp, pos, n, digest, more) reduced to one for each group; ``most`` is the largest n."""
    levels, roots, at = [], [], nodes
    while True:
        roots.append(at.filter("n = 1").select("grp", "digest"))
        if most <= 1:
            break
        slot = F.struct((F.col("pos") % FAN).alias("slot"), "digest", "more")
        runs = at.filter("n > 1").groupBy("grp", F.expr(f"pos DIV {FAN}").alias("run")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(slot)).alias("slots"))
        runs = scratch.store(runs, "runs")
        levels.append(runs)
        above = F.ceil(F.col("n") / FAN).cast("long")
        at = runs.select("grp", F.col("run").alias("pos"), above.alias("n"), hashed(_joined(F.col("slots.digest"))).alias("digest"), F.lit(None).cast(nodes.schema["more"].dataType).alias("more"))
        most = -(-most // FAN)
    return _Tree(nodes, levels, scratch.store(functools.reduce(DataFrame.unionAll, roots), "roots"))


def _paths(tree: _Tree, tops: DataFrame) -> DataFrame:
    """(grp, pos, digest, more, path, …) of every leaf; ``tops`` is (grp, path, …) of the groups' roots."""
    carried = [c for c in tops.columns if c not in ("grp", "path")]
    tops = tops.withColumnRenamed("grp", "of")
    above: DataFrame | None = None
    for runs in reversed(tree.levels):
        under = runs.filter(F.col("n") <= FAN).join(tops, F.col("grp") == F.col("of"))
        columns = ["grp", "run", "slots", "path", *carried]
        parents = under.select(*columns)
        if above is not None:
            upper = above.select(F.col("grp").alias("of"), F.col("pos").alias("at"), "path", *carried)
            rest = runs.filter(F.col("n") > FAN).join(upper, (F.col("grp") == F.col("of")) & (F.col("run") == F.col("at")))
            parents = parents.unionAll(rest.select(*columns))
        digests = F.col("slots.digest")
        left = lambda i: _joined(F.slice(digests, F.lit(1), i))
        right = lambda i: _joined(F.slice(digests, i + 2, F.lit(FAN)))
        step = lambda i: F.array(F.struct(left(i).alias("left"), right(i).alias("right")))
        each = F.inline(F.transform("slots", lambda s, i: F.struct(
            (F.col("run") * FAN + s["slot"]).alias("pos"), s["digest"].alias("digest"), s["more"].alias("more"), F.concat(step(i), F.col("path")).alias("path")
        )))
        above = parents.select("grp", each, *carried)
    lone = tree.leaves.filter("n = 1").join(tops, F.col("grp") == F.col("of")).select("grp", "pos", "digest", "more", "path", *carried)
    return lone if above is None else lone.unionByName(above)


def numbered(df: DataFrame, *order: str, scratch: Scratch) -> DataFrame:
    """``df`` with ``pos``, the row's place in the order of these columns, whose values tell all rows apart."""
    sorted_rows = scratch.store(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sorted_rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return sorted_rows.join(starts, part == F.col("part")).withColumn("pos", F.col("start") + inside).drop("at", "part", "start")


def manifest(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", group_col: str = "source",
    leaf_cols: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None,
) -> DataFrame:
    """The Merkle tree of ``docs``: ``id_col``, ``leaf``, ``subroot``, ``root`` and ``path`` of every row, and what ``carry`` computes of it.

    ``path`` holds the siblings of the leaf, level by level from the leaf to the root, each level as the joined digests to
    its ``left`` and ``right``; ``folded(leaf, path)`` is the root again. Nulls are values: a null id comes before all ids
    and a null group before all groups. Rows that share an id follow each other by leaf hash; equal rows take consecutive
    places. Empty and null texts have different leaves. Texts of any length are hashed whole, and only digests are
    shuffled. Columns outside ``leaf_cols`` play no part, whatever their names. An empty table has no rows and no root.
    ``id_col`` is an integer column.
    """
    carry = carry or {}
    names = dict(zip(carry, fresh(docs.select(*[F.lit(0).alias(n) for n in ("id", "leaf")]), *carry)))
    group = F.coalesce(F.concat(F.lit("1"), col(group_col).cast("string")), F.lit("0"))  # null first, then bytewise
    more = F.struct(F.lit(True).alias("is_leaf"), col(id_col).cast("long").alias("id"), *[c.alias(names[n]) for n, c in carry.items()])
    leaves = docs.select(group.alias("grp"), col(id_col).cast("long").alias("id"), leaf_of(*[col(c) for c in leaf_cols]).alias("leaf"), more.alias("more"))
    placed = _placed(scratch.store(leaves, "leaves"), scratch)
    nodes = scratch.store(placed.select("grp", "pos", "n", F.col("leaf").alias("digest"), "more"), "nodes")
    tree = _reduced(nodes, nodes.agg(F.max("n")).first()[0] or 0, scratch)
    groups = numbered(tree.roots, "grp", scratch=scratch)
    n_groups = tree.roots.count()
    over = groups.select(F.lit("").alias("grp"), "pos", F.lit(n_groups).cast("long").alias("n"), "digest", F.struct(F.col("grp").alias("of")).alias("more"))
    top = _reduced(scratch.store(over, "subroots"), n_groups, scratch)
    root = F.lit(next((r["digest"] for r in top.roots.collect()), None)).cast("string")  # one row
    subroots = _paths(top, docs.sparkSession.createDataFrame([("", [])], f"grp string, path {PATH}"))
    found = _paths(tree, subroots.select(F.col("more.of").alias("grp"), "path", F.col("digest").alias("subroot")))
    return found.select(
        F.col("more.id").alias(id_col), F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path", *[F.col("more")[names[n]].alias(n) for n in carry]
    )
