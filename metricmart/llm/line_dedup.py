"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line keys, hashed to 128 bits, bucketed and sorted by key, with the number of documents that hold
the line and the largest of their ids. Each new batch of documents is merge-anti-joined with all runs: keys that no run
has become a run of their own, so that a key is in one run only; keys seen before become a run of repeats. Once a level
has ``fanout`` runs they are merged into one run of the next level. Buckets are the same everywhere, so a batch is
shuffled once and runs never are.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricmart.llm.common import Scratch, body, col, fresh, membership, text_mark

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    """128 bits as a struct of two differently seeded 64-bit hashes."""
    return F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"))


def text_of_no_id(id_col: str, text_col: str) -> Column:
    """Hash of the text for rows without an id, else null: such rows are one document, but each loses its own lines only."""
    return F.when(col(id_col).isNull(), text_mark(text_col))


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text, k1, k2) of every line whose key has at least ``min_chars`` code points; ``text`` as in ``text_of_no_id``."""
    lines = docs.select(col(id_col).alias("id"), text_of_no_id(id_col, text_col).alias("text"), F.explode(F.split(body(text_col), "\n")).alias("line"))
    keyed = lines.select("id", "text", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select("id", "text", key_hash(F.col("key")).alias("h")).select("id", "text", "h.*")


class LineRuns:
    """The levelled runs. Tables lie in the scratch folder; the number of buckets is the session's shuffle partitions."""

    def __init__(self, scratch: Scratch, fanout: int = 2):
        self.scratch, self.fanout = scratch, fanout
        self.buckets = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.select(*KEY, "n_docs", "top").repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .option("path", f"{self.scratch.path}/{name}").saveAsTable(name)
        )
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.scratch.spark.sql(f"DROP TABLE {name}")
            self.scratch.remove(f"{self.scratch.path}/{name}")

    def _table(self, name: str) -> DataFrame:
        return self.scratch.spark.table(name)

    def add(self, keys: DataFrame) -> None:
        """Take in the line keys (id, k1, k2) of a batch of documents that no earlier batch held."""
        held = keys.groupBy(*KEY, "id").count().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("top"))
        runs = [name for level in self.levels for name in level]
        if not runs:
            self.levels = [[self._write(held)]]
            return
        batch = self._write(held)
        novel = self._write(reduce(lambda df, run: df.join(self._table(run), KEY, "left_anti"), runs, self._table(batch)))
        self.repeats.append(self._write(self._table(batch).join(self._table(novel), KEY, "left_anti")))
        self._drop([batch])
        self.levels[0].append(novel)
        self._compact()

    def _compact(self) -> None:
        for n, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            merged = self._write(reduce(DataFrame.unionByName, map(self._table, level)))
            if n + 1 == len(self.levels):
                self.levels.append([])
            self.levels[n + 1].append(merged)
            self._drop(level)
            self.levels[n] = []
        if len(self.repeats) >= self.fanout:
            merged = self._write(self._repeated())
            self._drop(self.repeats)
            self.repeats = [merged]

    def _repeated(self) -> DataFrame:
        union = reduce(DataFrame.unionByName, map(self._table, self.repeats))
        return union.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top"))

    def frequent(self, min_docs: int) -> DataFrame:
        """(k1, k2, n_docs, top) of keys in at least ``min_docs`` documents; ``top`` is the largest id that has it."""
        runs = [self._table(name) for level in self.levels for name in level]
        if self.repeats:
            again = self._repeated().withColumnsRenamed({"n_docs": "more", "top": "later"})
            runs = [
                run.join(again, KEY, "left").select(*KEY, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("top", "later").alias("top"))
                for run in runs
            ]
        return reduce(DataFrame.unionByName, runs).filter(F.col("n_docs") >= min_docs)

    def close(self) -> None:
        """Drop all runs; what was read from them must have been stored before."""
        self._drop([*(name for level in self.levels for name in level), *self.repeats])
        self.levels, self.repeats = [], []


def dedupe_lines(
    docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
    batches: int = 4, fanout: int = 2,
) -> DataFrame:
    """``docs`` with lines removed that too many documents hold, and two more columns.

    A line's key is the line without blanks at its ends, A-Z in lower case. Lines whose key has at least ``min_chars``
    code points and is in at least ``min_docs`` documents go, except in the document with the largest id that holds the
    key. Adds ``n_lines`` (before), ``n_dropped`` and ``kept_text`` (lines that stay, joined by a line break), replacing
    columns of these names. Null and empty texts are one empty line. Rows that share an id are one document; rows without
    an id are together one document that is smaller than any other. An empty table gives no rows.

    Documents come in ``batches`` by a hash of their id, as they would over time; the result does not depend on it. Only
    texts that may lose lines are shuffled.
    """
    part = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(batches)).cast("int").alias("batch")
    keys = scratch.store(line_keys(docs, id_col, text_col, min_chars).select("*", part), "lines", partition_by="batch")
    runs = LineRuns(scratch, fanout)
    for n in range(batches):
        runs.add(keys.filter(F.col("batch") == n).select("id", *KEY))
    frequent = scratch.store(runs.frequent(min_docs).select(*KEY, "top"), "frequent")
    runs.close()
    of, of_text, gone = fresh(docs, "of", "of_text", "gone")
    drops = scratch.store(
        keys.join(frequent, KEY).filter(~F.col("id").eqNullSafe(F.col("top"))).groupBy(F.col("id").alias(of), F.col("text").alias(of_text))
        .agg(F.collect_set(F.struct(*KEY)).alias(gone)),
        "drops",
    )
    lines = F.split(body(text_col), "\n")
    stays = lambda line: (F.char_length(line_key(line)) < min_chars) | ~F.array_contains(F.col(gone), key_hash(line_key(line)))
    kept, own = "kept_text", ["n_lines", "n_dropped", "kept_text"]
    n_lines = (F.char_length(body(text_col)) - F.char_length(F.replace(body(text_col), F.lit("\n"), F.lit(""))) + 1).cast("long")
    maybe = membership(drops.select(of, of_text), scratch)(col(id_col), text_of_no_id(id_col, text_col))
    whole = docs.filter(~maybe).withColumns({"n_lines": n_lines, "n_dropped": F.lit(0).cast("long"), kept: body(text_col)})
    same = col(id_col).eqNullSafe(F.col(of)) & text_of_no_id(id_col, text_col).eqNullSafe(F.col(of_text))
    joined = docs.filter(maybe).join(drops.hint("merge"), same, "left")
    (rest,) = fresh(joined, "rest")
    cut = joined.withColumn(rest, F.when(F.col(gone).isNotNull(), F.filter(lines, stays))).withColumns({
        "n_lines": n_lines,
        "n_dropped": F.when(F.col(gone).isNull(), F.lit(0)).otherwise(n_lines - F.size(F.col(rest))).cast("long"),
        kept: F.when(F.col(gone).isNull(), body(text_col)).otherwise(F.array_join(F.col(rest), "\n")),
    })
    columns = [*[c for c in docs.columns if c not in own], *own]
    return whole.select(*map(col, columns)).unionAll(cut.select(*map(col, columns)))
