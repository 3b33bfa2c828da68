"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of k edits is cut into k + 1 pieces: whatever the k edits hit, one piece stays whole. So
exact hits of pieces (one automaton for a block of items, run over every whole text) give every place where an item can
be, and a bit-parallel edit distance (Myers) between the item and the text around the hit decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metricmart.llm.common import Scratch, col, text_mark, without

WORDS = re.compile(r"\w+")


def normalise(text: str | None) -> str:
    """Lower-case words joined by one blank."""
    return " ".join(WORDS.findall((text or "").lower()))


@dataclass(frozen=True)
class Budget:
    """Edits allowed: ``rate`` per character, but no more than leave every piece ``piece_chars`` long.

    Items of fewer than ``min_chars`` characters would match by chance inside other texts: a document holds one if it, or
    one of its lines, is the item and nothing else.
    """

    rate: float = 0.05
    piece_chars: int = 12
    min_chars: int = 24

    def edits(self, length: int) -> int:
        return max(0, min(int(length * self.rate), length // self.piece_chars - 1))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``edits + 1`` pieces of nearly equal length that cover the item."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Edit distance of a pattern to the substrings of a text, one integer operation per column of the matrix."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.places: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def best(self, text: str, limit: int) -> tuple[int, int] | None:
        """(smallest distance, end of the first such substring), or None above ``limit``."""
        everything, top = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, score = everything, 0, self.length
        found = (score, 0)
        for end, c in enumerate(text, 1):
            equal = self.places.get(c, 0)
            diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
            raised = minus | (everything & ~(diagonal | plus))
            lowered = plus & diagonal
            if raised & top:
                score += 1
            elif lowered & top:
                score -= 1
            raised = raised << 1 & everything
            lowered = lowered << 1 & everything
            plus = lowered | (everything & ~(diagonal | raised))
            minus = raised & diagonal
            if score < found[0]:
                found = (score, end)
        return found if found[0] <= limit else None


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], budget: Budget):
        self.short: dict[str, list] = {}
        for key, text in items:
            if len(text) < budget.min_chars:
                self.short.setdefault(text, []).append(key)
        self.items = [(key, text, budget.edits(len(text))) for key, text in items if len(text) >= budget.min_chars]
        self.verifiers: dict[int, Myers] = {}
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, edits) in enumerate(self.items):
            for offset, piece in pieces(text, edits):
                where.setdefault(piece, []).append((n, offset))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int]]:
        """(key, smallest distance) of every item that a whole text holds."""
        whole = normalise(text)
        found = self.find(whole) if self.items else []
        if self.short:
            lines = {whole, *map(normalise, (text or "").splitlines())}
            found += [(key, 0) for line in lines for key in self.short.get(line, ())]
        return found

    def find(self, text: str) -> list[tuple[int, int]]:
        """(key, smallest distance) of every longer item within its budget somewhere in the normalised text."""
        best: dict[int, int] = {}
        tried: dict[int, int] = {}
        for last, (size, places) in self.automaton.iter(text):
            for n, offset in places:
                key, item, edits = self.items[n]
                if best.get(n, edits + 1) == 0:
                    continue
                start = last + 1 - size - offset
                if text.startswith(item, max(start, 0)) and start >= 0:
                    best[n] = 0
                    continue
                if tried.get(n) == start:  # another piece of the same place
                    continue
                tried[n] = start
                verifier = self.verifiers.get(n) or self.verifiers.setdefault(n, Myers(item))
                found = verifier.best(text[max(start - edits, 0) : start + len(item) + edits], edits)
                if found is not None:
                    best[n] = min(best.get(n, found[0]), found[0])
        return [(self.items[n][0], distance) for n, distance in best.items()]


def _blocks(spark: SparkSession, benchmark: DataFrame, scratch: Scratch, item_col: str, text_col: str, budget: Budget, block_bytes: int):
    """Normalised items in blocks of at most ``block_bytes`` of text, one block at a time on the driver."""

    def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalise(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["item", "norm"])

    kind = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(col(item_col).alias("item"), col(text_col).alias("norm")).mapInArrow(normalised, f"item {kind}, norm string")
    items = scratch.store(items.filter("norm <> ''").distinct(), "items")
    size = items.agg(F.sum(F.octet_length("norm") + 8)).first()[0] or 0
    count = -(-size // block_bytes)
    for block in range(count):
        some = items.filter(F.pmod(F.xxhash64("norm", "item"), F.lit(count)) == block).collect()
        if some:
            yield [(r["item"], r["norm"]) for r in some]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", budget: Budget = Budget(), block_bytes: int = 4 << 20,
) -> DataFrame:
    """Items found in documents: ``id_col``, ``item_col`` and ``distance`` (edits, 0 for an exact copy).

    Both texts are compared as lower-case words joined by one blank. Items shorter than ``budget.min_chars`` are looked for
    as whole lines and whole documents, without edits. Items without a word, null and empty texts hold nothing; a null id
    is returned as it is; repeated rows give repeated results, a repeated item counts once; other columns play no part, whatever their names;
    an empty table of either kind gives no rows. Items are a query set that goes to the
    tasks in blocks of about ``block_bytes`` of text, so that no automaton outgrows a task; every block meets every
    whole document, and no document is shuffled.
    """
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("content"))
    found = _found(rows, benchmark, scratch, item_col, item_text_col, budget, block_bytes)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def _found(rows: DataFrame, benchmark: DataFrame, scratch: Scratch, item_col: str, item_text_col: str, budget: Budget, block_bytes: int) -> DataFrame:
    """(id, item, distance) of every item found in ``rows`` (id, content)."""
    spark = rows.sparkSession
    id_kind, item_kind = (f.schema[c].dataType.simpleString() for f, c in ((rows, "id"), (benchmark, item_col)))
    schema = f"id {id_kind}, item {item_kind}, distance int"
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    found = spark.createDataFrame([], schema)
    for block in _blocks(spark, benchmark, scratch, item_col, item_text_col, budget, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, budget)
            for batch in batches:
                ids, items, distances = [], [], []
                for i, text in enumerate(batch.column(1)):
                    for item, distance in matcher.matches(text.as_py()):
                        ids.append(i)
                        items.append(item)
                        distances.append(distance)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(items, item_type), pa.array(distances, pa.int32())],
                    names=["id", "item", "distance"],
                )

        found = found.unionByName(rows.mapInArrow(search, schema))
    return found


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", budget: Budget = Budget(), block_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` without those that hold a benchmark item; columns stay as they are.

    Every row is judged by its own text: of rows that share an id, or have none, only those that hold an item go.
    """
    rows = docs.select(F.struct(col(id_col).alias("id"), text_mark(text_col).alias("mark")).alias("id"), col(text_col).alias("content"))
    leaks = _found(rows, benchmark, scratch, item_col, item_text_col, budget, block_bytes)
    return without(docs, id_col, text_col, leaks.select("id.id", "id.mark"), scratch)
