"""Collocations of two to four words, counted in HAT-tries.

Every task counts the phrases of its texts in a burst trie: a shallow trie over word ids whose leaves are hash containers
of packed word ids. A container that grows too large is burst, its entries moving below their next word. When the trie
holds too many entries, its largest subtrees are spilled whole, as sorted runs cut by prefix partition (a hash of language
and first two words). The runs of a partition are merged in one place, which keeps the phrases that are frequent enough.

Phrases are counted by length. A frequent phrase has only frequent phrases inside, so a phrase of m words is counted only
where both its phrases of m - 1 words may be frequent. A bitmap of their hashes, bounded in size, tells that: it never
rules out a frequent phrase and decides nothing else; the more phrases it holds, the more others pass and are counted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, col

WORD_BITS = 21  # of a word id; three fill 63 bits. A trie's vocabulary ends at half of what they hold
SLICE_BYTES = 1 << 20  # text that is cut into words at once: up to twice that, so no more new words than the other half
ENTRIES = 1 << 20  # phrases that a trie holds
BURST = 1 << 12  # phrases of a container
BATCH = 1 << 19  # phrases that are added to a trie at once
SPILL = 1 << 18  # phrases that are taken out of a trie at once
RUN_ENTRIES = 1 << 16  # phrases of a run's row
PART_WORDS = 1 << 21  # words of the corpus for each prefix partition
MOST_PARTS = 1 << 20
LEAST_BITS, MOST_BITS = 16, 27  # size of the bitmap of frequent phrases: at most 16 MB

BREAKS = b".,;:!?\n\x0b\x0c\r"
TO_BREAK = bytes(ord(".") if b in BREAKS else b for b in range(256))
SEPARATOR = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def phrase_hashes(start: int, words: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases: the language's hash, then those of the first words, of the second words, and so on."""
    found = np.full(len(words[0]), start, np.uint64)
    for word in words:
        found = _mixed(found * np.uint64(3) + word)
    return found


class Vocabulary(dict):
    """Word → id, given when a word is first asked for; id 0 is a break."""

    def __init__(self) -> None:
        super().__init__({b".": 0})
        self.words = [b"."]

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self.words)
        self.words.append(word)
        return found


class HatTrie:
    """Counts of phrases: head (first word) → container of what follows, or, once burst, second word → container.

    Containers are hash tables from packed word ids to counts.
    """

    def __init__(self, length: int):
        self.entries = 0
        self.heads: dict[int, Counter] = {}
        self.burst: dict[int, dict[int, Counter]] = {}
        self.sizes: dict[int, int] = {}
        self.shift = WORD_BITS * max(length - 2, 0)  # of the second word in what follows; 0 if nothing follows that

    def add(self, heads: np.ndarray, tails: np.ndarray) -> None:
        """Count phrases once each, given as heads and packed tails."""
        order = np.lexsort((tails, heads)) if self.burst else np.argsort(heads, kind="stable")
        heads, tails = heads[order], tails[order]
        starts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
        listed = tails.tolist()
        for head, a, b in zip(heads[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(listed)]):
            children = self.burst.get(head)
            if children is None:
                node = self.heads.get(head)
                if node is None:
                    node = self.heads[head] = Counter()
                before = len(node)
                node.update(listed[a:b])
                added = len(node) - before
                if self.shift and len(node) > BURST:
                    self._burst(head)
            else:
                added = self._add_below(children, tails[a:b])
            self.entries += added
            self.sizes[head] = self.sizes.get(head, 0) + added

    def _add_below(self, children: dict[int, Counter], tails: np.ndarray) -> int:
        seconds, listed = tails >> self.shift, (tails & ((1 << self.shift) - 1)).tolist()
        starts = np.flatnonzero(np.concatenate(([True], seconds[1:] != seconds[:-1])))
        added = 0
        for second, a, b in zip(seconds[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(listed)]):
            node = children.get(second)
            if node is None:
                node = children[second] = Counter()
            added -= len(node)
            node.update(listed[a:b])
            added += len(node)
        return added

    def _burst(self, head: int) -> None:
        """Move a container's entries below their next word."""
        children, mask = self.burst.setdefault(head, {}), (1 << self.shift) - 1
        for tail, count in self.heads.pop(head).items():
            children.setdefault(tail >> self.shift, Counter())[tail & mask] = count

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out the largest subtrees, whole, until ``keep`` entries are left: (heads, tails, counts)."""
        nodes: list[Counter] = []
        of: list[int] = []
        prefix: list[int] = []
        for head in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            self.entries -= self.sizes.pop(head)
            children = self.burst.pop(head, None) or {0: self.heads.pop(head)}
            nodes += children.values()
            of += [head] * len(children)
            prefix += [second << self.shift for second in children]
        sizes = np.fromiter(map(len, nodes), np.int64, len(nodes))
        total = int(sizes.sum())
        tails = np.fromiter(chain.from_iterable(nodes), np.int64, total) | np.repeat(np.array(prefix, np.int64), sizes)
        counts = np.fromiter(chain.from_iterable(n.values() for n in nodes), np.int64, total)
        return np.repeat(np.array(of, np.int64), sizes), tails, counts


class PhraseCounter:
    """Counts the phrases of one length in the texts of a task, and makes runs of what is spilled."""

    def __init__(self, length: int, parts: int, seen: np.ndarray | None):
        self.length, self.parts, self.seen = length, parts, seen
        self.langs: list[str] = []
        self.places: dict[str, int] = {}
        self.waiting: list[list[bytes]] = []
        self.size: list[int] = []
        self.tails: list[list[bytes]] = []  # last words of what was cut before
        self.held: list[tuple[np.ndarray, np.ndarray]] = []  # phrases that go into the trie together
        self.n_held = 0
        self._renew()

    def _renew(self) -> None:
        self.vocabulary, self.hashes, self.trie = Vocabulary(), np.zeros(1, np.uint64), HatTrie(self.length)
        self.sums: list[np.ndarray] = []  # of single words, by language and id
        self.place = np.empty(0, np.int64)  # of each word in the order of their bytes

    def feed(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        if lang not in self.places:
            self.places[lang] = len(self.langs)
            self.langs.append(lang)
            for x in (self.waiting, self.tails):
                x.append([])
            self.size.append(0)
        which = self.places[lang]
        self.waiting[which].append(text)
        self.size[which] += len(text)
        if self.size[which] >= SLICE_BYTES:
            yield from self._flush(which)

    def _flush(self, which: int) -> Iterator[pa.RecordBatch]:
        data = b".".join(self.waiting[which]) + b"."
        self.waiting[which], self.size[which] = [], 0
        at = 0
        while at < len(data):
            gap = SEPARATOR.search(data, at + SLICE_BYTES) if len(data) - at > 2 * SLICE_BYTES else None
            end = gap.end() if gap else len(data)
            yield from self._count(which, data[at:end])
            at = end

    def _count(self, which: int, data: bytes) -> Iterator[pa.RecordBatch]:
        if len(self.vocabulary.words) > 1 << (WORD_BITS - 1):
            self._insert()
            yield from self._runs(0)
            self._renew()
        tokens = self.tails[which] + data.lower().translate(TO_BREAK).replace(b".", b" . ").split()
        self.tails[which] = tokens[max(0, len(tokens) - self.length + 1) :]
        ids = np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int64, len(tokens))
        known = len(self.hashes)
        self.hashes = np.concatenate((self.hashes, np.array([_hash(w) for w in self.vocabulary.words[known:]], np.uint64)))
        n = len(ids) - self.length + 1
        if n <= 0:
            return
        inside = ids > 0
        good = inside[:n].copy()
        for k in range(1, self.length):
            good &= inside[k : k + n]
        if self.seen is not None:
            hashed = self.hashes[ids]
            m = self.length - 1
            parts = phrase_hashes(_hash(self.langs[which].encode()), [hashed[k : k + len(ids) - m + 1] for k in range(m)])
            parts &= np.uint64(8 * len(self.seen) - 1)
            maybe = (self.seen[(parts >> np.uint64(3)).astype(np.int64)] >> (parts & np.uint64(7)).astype(np.uint8)) & 1
            good &= (maybe[:n] & maybe[1 : n + 1]).astype(bool)
        at = np.flatnonzero(good)
        if not len(at):
            return
        head, tail = ids[at], np.zeros(len(at), np.int64)
        if self.length == 1:
            self.sums += [np.zeros(0, np.int64)] * (which + 1 - len(self.sums))
            both = np.bincount(head, minlength=len(self.sums[which]))
            both[: len(self.sums[which])] += self.sums[which]
            self.sums[which] = both
            return
        for k in range(1, self.length):
            tail = tail << WORD_BITS | ids[at + k]
        self.held.append((which << WORD_BITS | head, tail))
        self.n_held += len(head)
        if self.n_held >= BATCH:
            self._insert()
            if self.trie.entries > ENTRIES:
                yield from self._runs(ENTRIES // 2)

    def _insert(self) -> None:
        if self.held:
            heads, tails = (np.concatenate(x) for x in zip(*self.held))
            self.held, self.n_held = [], 0
            self.trie.add(heads, tails)

    def _words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = [np.flatnonzero(one) for one in self.sums]
        heads = [which << WORD_BITS | i for which, i in enumerate(ids)]
        counts = [one[i] for one, i in zip(self.sums, ids)]
        heads, counts = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (heads, counts))
        return heads, np.zeros(len(heads), np.int64), counts

    def _runs(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Spill subtrees until ``keep`` phrases are left, some at a time."""
        while self.trie.entries > keep:
            yield from self._run(*self.trie.spill(max(keep, self.trie.entries - SPILL)))
        if self.sums:
            yield from self._run(*self._words())

    def _run(self, heads: np.ndarray, tails: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Subtrees as rows (lang, part, phrases, counts); phrases of a row are sorted and end in line breaks."""
        mask = (1 << WORD_BITS) - 1
        words = [heads & mask] + [tails >> (WORD_BITS * k) & mask for k in range(self.length - 2, -1, -1)]
        which = heads >> WORD_BITS
        starts = np.array([_hash(lang.encode()) for lang in self.langs], np.uint64)
        part = _mixed(_mixed(starts[which] * np.uint64(3) + self.hashes[words[0]]) + (self.hashes[words[1]] if self.length > 1 else np.uint64(0)))
        part = (part % np.uint64(self.parts)).astype(np.int64)
        if len(self.place) != len(self.vocabulary.words):
            self.column = pa.array(self.vocabulary.words, pa.large_binary())
            self.place = np.empty(len(self.vocabulary.words), np.int64)
            self.place[pc.sort_indices(self.column).to_numpy()] = np.arange(len(self.place))
        vocabulary, place = self.column, self.place
        order = np.lexsort((*[place[w] for w in reversed(words)], part, which))
        which, part, counts = which[order], part[order], counts[order]
        columns = [vocabulary.take(pa.array(w[order])) for w in words]
        break_ = pa.scalar(b"\n", pa.large_binary())
        space, nothing = pa.scalar(b" ", pa.large_binary()), pa.scalar(b"", pa.large_binary())
        phrases = pc.binary_join_element_wise(*columns, space) if len(columns) > 1 else columns[0]
        lines = pc.binary_join_element_wise(phrases, nothing, break_)
        ends, text = np.frombuffer(lines.buffers()[1], np.int64), memoryview(lines.buffers()[2])
        new = np.concatenate(([True], (which[1:] != which[:-1]) | (part[1:] != part[:-1])))
        cuts = np.union1d(np.flatnonzero(new), np.arange(0, len(which), RUN_ENTRIES)).tolist()
        for group in range(0, len(cuts), 256):
            rows = [
                (self.langs[which[a]], int(part[a]), bytes(text[ends[a] : ends[b]]), counts[a:b].tobytes())
                for a, b in zip(cuts[group : group + 256], [*cuts[group + 1 : group + 256], cuts[group + 256] if group + 256 < len(cuts) else len(which)])
            ]
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["lang", "part", "phrases", "counts"])

    def close(self) -> Iterator[pa.RecordBatch]:
        for which in range(len(self.langs)):
            if self.waiting[which]:
                yield from self._flush(which)
        self._insert()
        yield from self._runs(0)


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of the phrases that all runs of their partition together hold often enough."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0

        def compact() -> pa.Table:
            return pa.concat_tables(held).combine_chunks().group_by("phrase").aggregate([("f", "sum")]).select(["phrase", "f_sum"]).rename_columns(["phrase", "f"])

        def done() -> Iterator[pa.RecordBatch]:
            found = compact()
            found = found.filter(pc.greater_equal(found.column("f"), least)).combine_chunks()
            for batch in found.to_batches(max_chunksize=1 << 14):
                phrases = batch.column("phrase").cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * batch.num_rows, pa.string()), phrases, batch.column("f")], names=["lang", "phrase", "f"])

        for batch in batches:
            for lang, part, phrases, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, part) != key:
                    if held:
                        yield from done()
                    key, held, size = (lang, part), [], 0
                held.append(pa.table({"phrase": pa.array(phrases.split(b"\n")[:-1], pa.binary()), "f": np.frombuffer(counts, np.int64)}))
                size += held[-1].num_rows
                if size > 1 << 21:
                    held = [compact()]
                    size = held[0].num_rows // 2  # merge again when as much has come
        if held:
            yield from done()

    return runs.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(merge, "lang string, phrase string, f long")


def _counted(texts: DataFrame, length: int, parts: int, least: int, seen: Broadcast | None, scratch: Scratch) -> DataFrame:
    """(lang, phrase, f) of the phrases of one length that occur at least ``least`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(length, parts, None if seen is None else seen.value)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from counter.feed(lang, text)
        yield from counter.close()

    runs = texts.mapInArrow(count, "lang string, part long, phrases binary, counts binary")
    return scratch.store(_merged(runs, least), f"phrases_{length}")


def _word_counts(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, phrase, f) of all words of each language; a row without phrase has the number of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(1, 1, None)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from flat(counter.feed(lang, text))
        yield from flat(counter.close())

    def flat(runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs:
            for lang, _, phrases, counts in zip(*(c.to_pylist() for c in run.columns)):
                words = pa.array([*phrases.split(b"\n")[:-1], None], pa.binary()).cast(pa.string())
                each = np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(np.append(each, each.sum()))], names=["lang", "phrase", "f"])

    return scratch.store(texts.mapInArrow(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "words")


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """Bits of the phrases' hashes, sixteen times as many bits as phrases within the bounds."""
    size = min(max((16 * phrases.count()).bit_length(), LEAST_BITS), MOST_BITS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (size - 3), np.uint8)
        for batch in batches:
            for lang, phrase in zip(*(c.to_pylist() for c in batch.columns)):
                at = int(phrase_hashes(_hash(lang.encode()), [np.array([_hash(w)], np.uint64) for w in phrase.encode().split(b" ")])[0]) & ((1 << size) - 1)
                bits[at >> 3] |= 1 << (at & 7)
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    marked = phrases.select("lang", "phrase").mapInArrow(mark, "bits binary").rdd.map(lambda r: np.frombuffer(r[0], np.uint8))
    zero = np.zeros(1 << (size - 3), np.uint8)
    return zero if marked.isEmpty() else marked.treeReduce(np.bitwise_or)


def _part(words: Column, start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(frequent: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, f) → lang, phrase, a, l, r, score: their lowest-scoring cut, ties to the earliest."""
    words = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    sides = cut.select("lang", "phrase", "a", "k", _part(F.col("words"), 1, F.col("k")).alias("left"), _part(F.col("words"), F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    of = lambda side, name: frequent.select(F.col("lang").alias("of"), F.col("phrase").alias(side), F.col("f").alias(name))
    for side, name in (("left", "l"), ("right", "r")):
        sides = sides.join(of(f"its_{side}", name), (F.col("lang") == F.col("of")) & (F.col(side) == F.col(f"its_{side}"))).drop("of", f"its_{side}", side)
    score = F.expr("CAST(2000000 AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(20, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = sides.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def uncovered(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer candidate with at least ``percent`` of their count holds; dropped ones count as longer, too."""
    words = F.split("phrase", " ")
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    inner = (
        candidates.select("lang", "f", words.alias("words")).filter(F.size("words") > 2)
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.size("words") - 1))).withColumn("start", F.explode(starts))
        .groupBy(F.col("lang").alias("of"), _part(F.col("words"), F.col("start"), F.col("size")).alias("inner")).agg(F.max("f").alias("longer"))
    )
    both = candidates.join(inner, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("inner")), "left")
    return both.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f"))).select("lang", "phrase", "f")


def collocations(
    docs: DataFrame, scratch: Scratch, text_col: str = "text", lang_col: str = "lang", least: int = 30, longest: int = 4, percent: int = 80, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``. Null and empty texts have no words. Equal scores go by count, then by the phrase's bytes,
    so no ties are left; repeated rows count each time. Words, their number and every count come from all whole texts; a
    very long text is counted in slices that overlap by the words a phrase can span. Columns other than the two play no
    part, whatever their names. An empty table has no phrases. Phrases of ``longest`` words (at most 4) are the longest.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words")
    texts = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("binary").alias("text")).filter("octet_length(text) > 0")
    words = _word_counts(texts, scratch)
    totals = words.filter("phrase IS NULL").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    frequent = words.filter(F.col("phrase").isNotNull() & (F.col("f") >= least))
    total = totals.agg(F.sum("n")).first()[0] or 0
    parts = min(max(total // PART_WORDS, 8), MOST_PARTS)
    by_length = [frequent]
    for length in range(2, longest + 1):
        seen = docs.sparkSession.sparkContext.broadcast(_bitmap(by_length[-1]))
        by_length.append(_counted(texts, length, parts, least, seen, scratch))
    candidates = by_length[1]
    for longer in by_length[2:]:
        candidates = candidates.unionAll(longer)
    all_frequent = by_length[0].unionAll(candidates)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(all_frequent, uncovered(candidates, percent)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("of")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
