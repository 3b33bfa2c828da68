"""Near duplicates by an exact Jaccard join of n-gram sets over prefix trees.

A document's set holds the hashes of its distinct n-word shingles in one global order: rare shingles first, as estimated
by a counting sketch of all documents, then by hash. Two sets similar enough must share one of their first few shingles
(their prefix), so only sets that meet under such a shingle are compared.

Sets that meet are not paired with each other at once. First every set is compared with one hub, the set that it shares
most prefix shingles with among the first of each shingle; that joins whole clusters with as many comparisons as sets.
Sets that meet although they are in different components yet try a few members of the other component. Sets that meet
a large component then draw more of its members in turns, one for each shingle shared; every turn costs as many comparisons
as the sets have shingles in common with it, and what it links is out of the next. What is still apart then is paired, all
of it, if the shingles left after those shared could still make up the required overlap.

Pairs whose hash histograms already rule the overlap out are dropped. Comparisons run over prefix trees: the sets to compare with one hub are stored in the global order, frequent shingles
first, as a sorted list whose neighbours share their common beginnings; the overlap of a shared beginning is computed
once, and a branch is left as soon as what remains of it cannot reach the required overlap.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, col, membership, text_mark, without
from metricmart.llm.components import components

SKETCH_BITS = 21  # counters of the shingle sketch; its size bounds what is broadcast (one byte a counter)
SKETCH_PARTS = 64  # parts in which the tasks' sketches are added up
HUB_ROWS = 4096  # sets that share one hub at most
TREE_ROWS = 256  # sets in one prefix tree
TRIED_MEMBERS = 6  # members of a component that a set outside is first compared with
CROWD = 16  # rows of a shingle's largest component above which sets outside it go on trying members drawn at random
WORTHWHILE = 16  # they go on while at least one in so many of them is linked
CELLS, FULL = 256, 65535  # histogram of a set's hashes: cells, and the count that stands for all larger ones


WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWERED = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
LONG_WORD = 64
_random = np.random.default_rng(20)
BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64)[LOWERED]
PLACES = _random.integers(1, 2**63, LONG_WORD, dtype=np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a piece of text; A-Z count as lower case."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~WHITE[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    hashes = np.add.reduceat(BYTES[raw[inside]] * PLACES[place & (LONG_WORD - 1)], first) + lengths.astype(np.uint64)
    for i in np.flatnonzero(lengths > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]].lower())
    return starts, _mixed(hashes)


def _pieces(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Texts grouped to pieces of about ``most`` bytes, as (first text, parts); a longer text is cut at white space."""
    group, size, first = [], 0, 0
    for n, text in enumerate(texts):
        if group and size + len(text) > most:
            yield first, group
            group, size = [], 0
        if not group:
            first = n
        at = 0
        while len(text) - at > 2 * most:
            gap = re.compile(rb"[\x20\x09-\x0D]").search(text, at + most)
            if gap is None:
                break
            yield n, [text[at : gap.start()]]
            at = gap.start()
        group.append(text[at:])
        size += len(text) - at
    if group:
        yield first, group


def shingle_sets(texts: list[bytes | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; fewer words than ``size`` give one, no words none.

    Words are runs of other characters than ASCII white space, A-Z in lower case.
    """
    hashes, owners = [], []
    for first, parts in _pieces([t or b"" for t in texts]):
        starts, words = _words(b" ".join(parts))
        begins = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        hashes.append(words)
        owners.append(first + np.searchsorted(begins, starts, side="right") - 1)
    words, owner = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (hashes, owners))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    counts = np.diff(bounds)
    rolled = np.full(max(len(words) - size + 1, 0), size, np.uint64)
    for k in range(size):
        rolled = _mixed(rolled + words[k : k + len(rolled)])
    out = []
    for start, count in zip(bounds.tolist(), counts.tolist()):
        if count >= size:
            one = np.sort(rolled[start : start + count - size + 1])
            out.append(one[np.concatenate(([True], one[1:] != one[:-1]))])
        elif count:
            whole = np.full(1, count, np.uint64)
            for k in range(count):
                whole = _mixed(whole + words[start + k])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def required(n: int, m: int, percent: int) -> int:
    """Smallest overlap of sets of sizes n and m with 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """How many first shingles of a set must hold one of any set similar enough."""
    return n - -(-percent * n // 100) + 1


def ordered(tokens: np.ndarray, heat: np.ndarray) -> np.ndarray:
    """The global order: by frequency class, then by hash."""
    warm = heat[(tokens & np.uint64(len(heat) - 1)).astype(np.int64)]
    return tokens[np.lexsort((tokens, warm))] if warm.any() else tokens


def heat_classes(counts: np.ndarray, mean: float) -> np.ndarray:
    """Frequency class of each counter: 0 near the mean of all, else the bits of its count."""
    classes = np.zeros(len(counts), np.uint8)
    hot = np.flatnonzero(counts > mean + 8 * np.sqrt(mean) + 48)
    classes[hot] = np.ceil(np.log2(counts[hot]))
    return classes


def _low(tokens: np.ndarray, size: int) -> np.ndarray:
    return (tokens & np.uint64(size - 1)).astype(np.int64)


def _measured(docs: DataFrame, size: int, scratch: Scratch) -> tuple[DataFrame, np.ndarray]:
    """(id, n, key, cells) of every row, and the frequency classes of all shingles.

    ``key`` is the 128-bit hash of the set, ``cells`` a histogram of its hashes.
    """
    names = ["id", "n", "key", "cells", "sketch"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, kind = np.zeros(1 << SKETCH_BITS, np.int64), [], None

        def count() -> None:
            if waiting:
                counts[:] += np.bincount(np.concatenate(waiting), minlength=len(counts))
                waiting.clear()

        for batch in batches:
            kind = batch.column(0).type
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            waiting.extend(_low(s, len(counts)) for s in sets)
            if sum(map(len, waiting)) > 1 << 20:
                count()
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            cells = [np.minimum(np.bincount(_low(s, CELLS), minlength=CELLS), FULL).astype(np.uint16).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(cells, pa.binary()), pa.nulls(len(sets), pa.binary())],
                names=names,
            )
        if kind is not None:
            count()
            parts = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(SKETCH_PARTS, -1)]
            none = SKETCH_PARTS
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(none, kind), pa.array(np.arange(none) - none, pa.int64()), pa.nulls(none, pa.binary()), pa.nulls(none, pa.binary()), pa.array(parts, pa.binary())],
                names=names,
            )

    kind = docs.schema["id"].dataType.simpleString()
    measured = scratch.store(docs.mapInArrow(measure, f"id {kind}, n long, key binary, cells binary, sketch binary"), "measured")
    return measured.filter("n >= 0").drop("sketch"), _heat(measured.filter("n < 0").select("n", "sketch"), scratch)


def _heat(sketches: DataFrame, scratch: Scratch) -> np.ndarray:
    """Frequency classes of all counters, one byte each, from the parts of the tasks' sketches; added up in the cluster."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()), pa.array([int(total.sum())], pa.int64())], names=["n", "sums", "total"])

        for batch in batches:
            for n, sketch in zip(batch.column("n").to_pylist(), batch.column("sketch").to_pylist()):
                counts = np.frombuffer(zlib.decompress(sketch), np.int64)
                if n == part:
                    total = total + counts
                    continue
                if part is not None:
                    yield done()
                part, total = n, counts
        if part is not None:
            yield done()

    sums = scratch.store(sketches.repartition("n").sortWithinPartitions("n").mapInArrow(add_up, "n long, sums binary, total long"), "sketch")
    mean = (sums.agg(F.sum("total")).first()[0] or 0) / (1 << SKETCH_BITS)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [heat_classes(np.frombuffer(zlib.decompress(s), np.int64), mean).tobytes() for s in batch.column("sums").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(classes, pa.binary())], names=["n", "classes"])

    parts = sums.mapInArrow(classify, "n long, classes binary").collect()  # one byte a counter in all
    if not parts:
        return np.zeros(1 << SKETCH_BITS, np.uint8)
    return np.concatenate([np.frombuffer(r["classes"], np.uint8) for r in sorted(parts, key=lambda r: r["n"])])


def _prefixes(docs: DataFrame, size: int, percent: int, heat) -> DataFrame:
    """Prefix of every set that a different set can be similar enough to: id, key, tokens, places.

    The nearest different set of n shingles has one more; smaller sets than it allows can only equal each other.

    A token is 48 bits of a shingle's hash: enough to meet, as whole hashes are compared later. A place packs the set's
    size, the position in it and the number of parts (a power of two) that the shingle's rows are dealt to.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = heat.value
        spare = HUB_ROWS.bit_length() - 1
        for batch in batches:
            rows, keys, tokens, places = [], [], [], []
            for i, found in enumerate(shingle_sets(batch.column(1).to_pylist(), size)):
                n = len(found)
                if 100 * n < percent * (n + 1):
                    continue
                some = ordered(found, classes)[: prefix_length(n, percent)]
                parts = np.maximum(classes[_low(some, len(classes))].astype(np.int64) - spare, 0)
                rows.append(i)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                tokens.append((some >> np.uint64(16)).astype(np.int64))
                places.append((n << 33) | (np.arange(len(some), dtype=np.int64) << 5) | parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary()),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))],
                names=["id", "key", "tokens", "places"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(first, f"id {kind}, key binary, tokens array<long>, places array<long>")


def _within_reach(group: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Rows for which their group, of two rows or more, may hold another that their shingle could be the first in common with.

    What follows the first common shingle must make up the overlap in both sets: that bounds the size of the other set by
    a row's place in its own. True for every row of such a pair; of three rows and more, for some others as well.
    """
    if not len(group):
        return np.zeros(0, bool)
    reach = (100 + percent) * (n - pos) // percent - n
    starts = np.concatenate(([True], group[1:] != group[:-1]))
    first, at = np.flatnonzero(starts), np.cumsum(starts) - 1

    def least_other(values: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, group))
        least = values[order[first]][at]
        least[order[first]] = values[order[first + 1]]
        return least

    return (least_other(n) <= reach) & (-least_other(-reach) >= n)


def _meeting(rows: DataFrame, by_part: bool, percent: int) -> DataFrame:
    """(token, id, place) → rows of groups with at least two, and all ``salted`` ones, with id, n and pos of their group's first row (the hub).

    Rows of a group that come too late in their order for every other row of it are left out, unless it is salted or goes
    on in the next batch. One streaming pass over sorted partitions: of a group, no more than its first row is held.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, emitted = None, False
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            keys = [table.column(c).to_numpy() for c in ("token", "part")]
            starts = np.ones(table.num_rows, bool)
            starts[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            first = np.flatnonzero(starts)
            sizes = np.diff(np.append(first, table.num_rows))
            group = np.cumsum(starts) - 1
            salted = table.column("salted").to_numpy()
            keep = (sizes[group] > 1) | salted
            whole = (group < group[-1]) & (group >= (held is not None))
            some = np.flatnonzero(keep & whole & ~salted)
            keep[some] = _within_reach(group[some], *(table.column(c).to_numpy().astype(np.int64)[some] for c in ("n", "pos")), percent)
            hubs, kept = first.copy(), np.flatnonzero(keep & whole)
            hubs[group[kept][::-1]] = kept[::-1]
            if held is not None and emitted:
                keep[0] = False
            hub = pa.array(hubs[group])
            for name in ("id", "n", "pos"):
                table = table.append_column(f"hub_{name}", table.column(name).take(hub))
            yield from table.filter(pa.array(keep)).combine_chunks().to_batches()
            # the last group may go on: its first row leads the next batch
            goes_on = held is not None and first[-1] == 0
            emitted = (goes_on and emitted) or bool(sizes[-1] > 1) or bool(salted[first[-1]])
            held = table.select(batch.schema.names).slice(first[-1], 1).combine_chunks().to_batches()[0]

    kind = rows.schema["id"].dataType.simpleString()
    n, pos, bits = F.shiftright("place", 33), F.shiftright("place", 5).bitwiseAND(F.lit((1 << 28) - 1)), F.col("place").bitwiseAND(F.lit(31))
    parts = F.pmod(F.xxhash64("id"), F.pow(F.lit(2), bits).cast("long"))
    part = parts if by_part else F.lit(0).cast("long")
    return (
        rows.repartition("token", part).sortWithinPartitions("token", part, F.xxhash64("id"), "id")
        .select("token", part.alias("part"), "id", n.cast("int").alias("n"), pos.cast("int").alias("pos"), (bits > 0).alias("salted"), "place")
        .mapInArrow(meet, f"token long, part long, id {kind}, n int, pos int, salted boolean, place long, hub_id {kind}, hub_n int, hub_pos int")
    )


def _could_link(percent: int) -> Column:
    """Whether sets with ``shared`` prefix shingles, the last at la and lb (from 0), can still reach the overlap."""
    need = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    similar_size = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return similar_size & (F.col("shared") + F.least(F.col("na") - F.col("la"), F.col("nb") - F.col("lb")) - 1 >= need - 1e-6)


def tree_links(hub: np.ndarray, others: list[tuple[object, np.ndarray]], percent: int, step: int = 64) -> list[object]:
    """Keys of the sets similar enough to the hub; all sets as arrays in one global order.

    The sorted sets are a prefix tree laid out flat: what a set shares with its predecessor is one path, whose overlap
    with the hub is kept in ``path``.
    """
    members = np.sort(hub)
    found, previous = [], np.empty(0, np.uint64)
    path = np.zeros(1, np.int64)  # overlap of the first d shingles, as far as they were looked at
    for key, tokens in sorted(others, key=lambda x: x[1].tobytes()):
        n = len(tokens)
        both = min(n, len(previous), len(path) - 1)
        differ = np.flatnonzero(tokens[:both] != previous[:both])
        depth = int(differ[0]) if len(differ) else both
        path, previous = path[: depth + 1], tokens
        if 100 * min(n, len(hub)) < percent * max(n, len(hub)):
            continue
        need = required(n, len(hub), percent)
        while depth < n and path[-1] + min(n - depth, len(hub) - path[-1]) >= need:
            part = tokens[depth : depth + step]
            at = np.minimum(np.searchsorted(members, part), len(members) - 1)
            path = np.concatenate((path, path[-1] + np.cumsum(members[at] == part)))
            depth += len(part)
        if depth == n and path[-1] >= need:
            found.append(key)
    return found


def _ends(pairs: DataFrame, scratch: Scratch):
    """A test for the ids in pairs (a, b)."""
    return membership(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), scratch)


def _plausible(pairs: DataFrame, measured: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) that the histograms of their hashes allow: the overlap is at most the sum of the smaller counts."""
    pairs = scratch.store(pairs, "meetings")
    sides = measured.filter("id IS NOT NULL AND n > 0").filter(_ends(pairs, scratch)(F.col("id"))).select("id", "n", "cells")
    left = sides.select(F.col("id").alias("a_id"), F.col("n").alias("a_n"), F.col("cells").alias("a_cells"))
    both = pairs.join(left, F.col("a") == F.col("a_id")).join(sides, F.col("b") == F.col("id")).select("a", "b", "a_n", "n", "a_cells", "cells")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, CELLS) for c in ("a_cells", "cells"))
            n, m = (batch.column(c).to_numpy() for c in ("a_n", "n"))
            least = np.minimum(x, y)
            most = np.where((least == FULL).any(axis=1), np.minimum(n, m), least.sum(axis=1, dtype=np.int64))
            yield batch.select(["a", "b"]).filter(pa.array(100 * most >= percent * (n + m - most)))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(judge, f"a {kind}, b {kind}").distinct()


def _linked(pairs: DataFrame, measured: DataFrame, docs: DataFrame, size: int, percent: int, heat, scratch: Scratch) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough; one prefix tree for each a and up to some 256 b.

    Only texts of documents that are left in a pair are shuffled, compressed; their sets are made where they are compared.
    """
    kind = docs.schema["id"].dataType.simpleString()
    pairs = scratch.store(_plausible(pairs, measured, percent, scratch), "pairs")
    if pairs.isEmpty():
        return pairs

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            contents = [squeeze.compress(t or b"") for t in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(contents, pa.binary())], names=["own", "content"])

    texts = docs.filter(_ends(pairs, scratch)(F.col("id"))).mapInArrow(packed, f"own {kind}, content binary")
    degree = pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count(F.lit(1)) / TREE_ROWS).alias("trees"))
    dealt = pairs.join(degree, F.col("a") == F.col("of")).select("a", "b", F.pmod(F.xxhash64("b"), "trees").alias("tree"))
    seats = dealt.select("a", "tree", F.lit(1).alias("role"), F.col("b").alias("id")).unionAll(
        dealt.select("a", "tree", F.lit(0).alias("role"), F.col("a").alias("id")).distinct()
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, roots, others = None, [], []
        opened = zstandard.ZstdDecompressor()

        def found() -> pa.RecordBatch:
            keys = sorted({tuple(k.values()) for root in roots for k in tree_links(root, others, percent)})
            return pa.RecordBatch.from_arrays([pa.array([group[0]] * len(keys), arrow), pa.array(keys, arrow)], names=["a", "b"])

        for batch in batches:
            arrow = batch.schema.field("id").type
            sets = shingle_sets([opened.decompress(t) for t in batch.column("content").to_pylist()], size)
            for a, tree, role, key, tokens in zip(*(batch.column(c).to_pylist() for c in ("a", "tree", "role", "id")), sets):
                if (a, tree) != group:
                    if others:
                        yield found()
                    group, roots, others = (a, tree), [], []
                tokens = ordered(tokens, heat.value)[::-1]
                if role:
                    others.append((key, tokens))
                else:
                    roots.append(tokens)
        if others:
            yield found()

    return scratch.store(
        seats.join(texts, F.col("id") == F.col("own")).select("a", "tree", "role", "id", "content")
        .repartition("a", "tree").sortWithinPartitions("a", "tree", "role", "id").mapInArrow(compare, f"a {kind}, b {kind}"),
        "links",
    )


def _still_open(rows: DataFrame, joined: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows (token, id, n, pos) with their component, the largest one that was joined among their token's, and its rows.

    First the rows of tokens that a joined component has a row of, stored; then all others, whose sets are components of
    their own. Only the first are shuffled; a bitmap tells them, so some of them may have no largest component (null).
    """
    touched = membership(joined.select("node"), scratch)(F.col("id"))
    largest = scratch.store(
        rows.filter(touched).join(joined, F.col("id") == F.col("node")).groupBy("token", "component").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(F.col("token").alias("of")).agg(F.max(F.struct("rows", "component")).alias("top")),
        "largest",
    )
    led = membership(largest.select("of"), scratch)(F.col("token"))
    placed = rows.filter(led).join(joined, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))
    columns = ["token", "id", "n", "pos", "component"]
    open_rows = placed.join(largest, F.col("token") == F.col("of"), "left").select(*columns, F.col("top.component").alias("main"), F.col("top.rows").alias("crowd"))
    alone = rows.filter(~led).select("token", "id", "n", "pos", F.col("id").alias("component"))
    kind = open_rows.schema["component"].dataType
    return scratch.store(open_rows, "open"), alone.select(*columns, F.lit(None).cast(kind).alias("main"), F.lit(None).cast("long").alias("crowd"))


def _extended(joined: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (node, component) of those known and more links; each known one counts as links to its smallest node."""
    return components(joined.toDF("a", "b").unionAll(found), scratch)


def _drawn(open_rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Sets outside a large component, each with one of its members for every shingle they share, drawn anew each turn: (a, b).

    The members of a shingle are dealt to a few parts and each part's least draw is kept, so that neither the draw nor the
    join holds more than a row for each row of ``open_rows``.
    """
    part = F.pmod(F.xxhash64(F.lit(turn), "id"), F.lit(TRIED_MEMBERS))
    draw = F.struct(F.xxhash64(F.lit(turn), "token", "id").alias("draw"), "id", "n")
    crowded = open_rows.filter(F.col("crowd") > CROWD)
    inside = crowded.filter("component = main").groupBy(F.col("token").alias("of"), part.alias("seat")).agg(F.min(draw).alias("least"))
    outside = crowded.filter("component <> main").select("token", "id", "n", part.alias("part"))
    return (
        outside.join(inside, (F.col("token") == F.col("of")) & (F.col("part") == F.col("seat")))
        .filter(100 * F.least("n", "least.n") >= percent * F.greatest("n", "least.n"))
        .select(F.col("id").alias("a"), F.col("least.id").alias("b")).distinct()
    )


def near_duplicates(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """Component of every document under exact Jaccard similarity of at least ``percent`` of its n-gram set.

    Returns one row per row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``, the smallest id reachable over
    links, itself included. Null and empty texts and texts without words have an empty set and link with nothing. Equal
    sets form one node before the search, whatever their number. Rows that share an id are linked by their texts only,
    like all others. A row whose id is null links with nothing and has a null component. An empty table gives no rows.
    Other columns play no part.
    """
    return _grouped(docs, scratch, id_col, text_col, size, percent).select(
        F.col("id.id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component.id").alias("component_id")
    )


def _grouped(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, size: int = 5, percent: int = 80) -> DataFrame:
    """(id, n, component) of every row; ``id`` and ``component`` are (id, hash of the text), or null where the id is."""
    node = F.struct(col(id_col).alias("id"), text_mark(text_col).alias("mark"))
    rows = docs.select(F.when(col(id_col).isNotNull(), node).alias("id"), col(text_col).cast("binary").alias("content"))
    measured, classes = _measured(rows, size, scratch)
    heat = docs.sparkSession.sparkContext.broadcast(classes)
    known = rows.filter("id IS NOT NULL")

    twins = scratch.store(
        measured.filter("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1").select(F.col("key").alias("twin"), "first"),
        "twins",
    )
    # equal sets are searched for once: all but one row of each is left out, by a bitmap first
    copies = scratch.store(measured.join(twins, F.col("key") == F.col("twin")).filter("id <> first").select("id", "key").distinct(), "copies")
    copied = membership(copies.select("id"), scratch)(F.col("id"))
    prefixes = _prefixes(known.filter(~copied), size, percent, heat).unionByName(
        _prefixes(known.filter(copied), size, percent, heat).join(copies, ["id", "key"], "left_anti")
    )
    places = prefixes.select("id", F.explode(F.arrays_zip("tokens", "places")).alias("at")).select(F.col("at.tokens").alias("token"), "id", F.col("at.places").alias("place"))
    met = scratch.store(_meeting(places, True, percent).drop("part"), "met")
    # hubs of the parts of one very frequent shingle meet in turn
    over = _meeting(met.filter("salted AND id = hub_id").select("token", "id", "place"), False, percent)
    seats = ["id", "n", "hub_id", "hub_n"]
    # one hub for each set: that with which it shares most prefix shingles
    tried = (
        met.select(*seats).unionAll(over.select(*seats)).filter("id <> hub_id")
        .filter(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
        .groupBy("hub_id", "id").agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("id").agg(F.max(F.struct("shared", "hub_id")).alias("best"))
        .select(F.col("best.hub_id").alias("a"), F.col("id").alias("b"))
    )
    links = _linked(tried, measured, known, size, percent, heat, scratch)
    joined = components(links, scratch)

    # what met in different components tries a few members of the component that most of its partners are in, and in the
    # same comparison a first turn of members drawn
    meetings = met.select("token", "id", "n", "pos")
    open_rows, alone = _still_open(meetings, joined, scratch)
    members = joined.groupBy("component", F.pmod(F.xxhash64("node"), F.lit(TRIED_MEMBERS)).alias("part")).agg(
        F.min(F.struct(F.xxhash64("node").alias("draw"), "node")).alias("least")
    )
    facing = (
        open_rows.filter("component <> main").groupBy("id", "main").agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("id").agg(F.max(F.struct("shared", "main")).alias("most")).select("id", F.col("most.main").alias("main"))
    )
    second = facing.join(members, F.col("main") == F.col("component")).select(F.col("least.node").alias("a"), F.col("id").alias("b"))
    found = _linked(second.unionAll(_drawn(open_rows, 0, percent)).distinct(), measured, known, size, percent, heat, scratch)
    if not found.isEmpty():
        joined = _extended(joined, found, scratch)
        open_rows, alone = _still_open(meetings, joined, scratch)

    # sets outside a large component draw its members in further turns, so that few are left to be paired with all of them
    turn, apart = 1, open_rows.filter("component <> main").filter(F.col("crowd") > CROWD).select("id").distinct().count()
    while apart:
        found = _linked(_drawn(open_rows, turn, percent), measured, known, size, percent, heat, scratch)
        gained = found.select("a").distinct().count()
        if gained:
            joined = _extended(joined, found, scratch)
            open_rows, alone = _still_open(meetings, joined, scratch)
        if WORTHWHILE * gained < apart:
            break
        turn, apart = turn + 1, open_rows.filter("component <> main").filter(F.col("crowd") > CROWD).select("id").distinct().count()

    # then all others that meet in different components: rows outside a token's largest component meet those of its rows
    # with which this token could be the first they share, and what comes behind it still make up the overlap
    outside = F.col("main").isNull() | (F.col("component") != F.col("main"))
    apart_in = membership(open_rows.filter(outside).select("token"), scratch)(F.col("token"))
    facing_rows = open_rows.filter(outside | apart_in).unionAll(alone)
    rest = facing_rows.filter(outside).select(
        F.col("token").alias("of"), F.col("id").alias("other"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("there")
    )
    swapped = F.col("id") > F.col("other")
    later = (
        facing_rows.withColumnsRenamed({"n": "na", "pos": "pa"})
        .join(rest, (F.col("token") == F.col("of")) & (F.col("component") != F.col("there"))
              & (F.col("component").eqNullSafe(F.col("main")) | (F.col("id") < F.col("other")))
              & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
              & ((100 + percent) * F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= percent * (F.col("na") + F.col("nb"))))
        .select(
            F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"),
            *[F.when(swapped, F.col(y)).otherwise(F.col(x)).alias(z) for x, y, z in (("na", "nb", "na"), ("nb", "na", "nb"), ("pa", "pb", "pa"), ("pb", "pa", "pb"))],
        )
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("pa").alias("la"), F.max("pb").alias("lb"), F.max("na").alias("na"), F.max("nb").alias("nb"))
        .filter(_could_link(percent)).select("a", "b")
    )
    more = _linked(later, measured, known, size, percent, heat, scratch)
    final = _extended(joined, more, scratch) if not more.isEmpty() else joined
    nodes = measured.join(twins, F.col("key") == F.col("twin"), "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("first", "id")).alias("at"))
    return nodes.join(final, F.col("at") == F.col("node"), "left").select("id", "n", F.coalesce("component", "at").alias("component"))


def keep_one(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id. Rows without an id stay.

    Every row is judged by its own text: of rows that share an id, only those go whose component has another survivor.
    Rows with one id and one text are one document.
    """
    groups = _grouped(docs, scratch, id_col, text_col, **options)
    return without(docs, id_col, text_col, groups.filter("id <> component").select("id.id", "id.mark"), scratch)
