"""What the operators share: the scratch folder of a run, column helpers and the settings they need."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricmart.session import apply_settings, shared_dir

# Arrow batches are bounded in bytes as well as rows: one batch of very long texts must fit beside the others. The plan
# texts that the driver keeps for each of many small jobs are bounded too.
BOUNDS = {
    "spark.sql.maxPlanStringLength": "16384",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive settings and bounds on a session that somebody else created."""
    apply_settings(spark)
    for key, value in BOUNDS.items():
        spark.conf.set(key, value)
    return spark


class Scratch:
    """A folder of one run below the cluster's shared folder, for tables that several steps read.

    Every table is plain Parquet, so lost executors cost a re-read only. Use as a context manager where the result is
    written inside the block; otherwise the folder goes when the driver's process ends, as a lazy result may read it
    until then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = prepare(spark)
        self.path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self._named: dict[str, int] = {}
        atexit.register(self.close)

    def store(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write a table and read it back: exact statistics, no lineage."""
        self._named[name] = self._named.get(name, 0) + 1
        path = f"{self.path}/{name}-{self._named[name]}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        """Delete a file or folder of this run."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def close(self) -> None:
        """Remove the folder."""
        atexit.unregister(self.close)
        try:
            self.remove(self.path)
        except Exception:  # noqa: BLE001 - the session has ended; its cluster's folder is cleaned with it
            pass

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores appended until no column of ``df`` has them (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def body(text_col: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(col(text_col), F.lit(""))


def text_mark(text_col: str) -> Column:
    """64-bit hash of the text: tells rows that share an id apart."""
    return F.xxhash64(body(text_col))


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids give null."""
    return F.crc32(col(id_col).cast("string").cast("binary")) % modulus


def word_count(text_col: str) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


MOST_LABELS = 1000


def smallest_draws(rows: DataFrame, label: str, draw: str, limit: int, tie: str) -> DataFrame:
    """Of each label the ``limit`` rows with the smallest draw, a 64-bit hash; ties in the order of ``tie``.

    The labels, at most ``MOST_LABELS``, are counted first: that tells how small a draw has to be, so that only about three
    times as many rows are shuffled and ranked, and other columns of the rest are never made.
    """
    counts = rows.groupBy(F.col(label).alias("of")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    span = 1 << 20
    most = {r["of"]: min(1.0, (3.0 * limit + 50) / r["n"]) * span for r in counts if r["of"] is not None}
    allowed = F.element_at(F.create_map(*[x for label_, n in most.items() for x in (F.lit(label_), F.lit(float(n)))]), F.col(label)) if most else F.lit(0.0)
    small = F.pmod(F.col(draw), F.lit(span))
    order = Window.partitionBy(label).orderBy(small, draw, tie)
    return rows.filter(small < allowed).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= limit).drop("_rank")


def membership(keys: DataFrame, scratch: Scratch, bits: int = 22) -> Callable[..., Column]:
    """A test whether columns hash like a row of ``keys``: never false for one of them, seldom true for others.

    A bitmap of hashes, of fixed size (512 KB) whatever the number of keys, so it may go to every task. Used before joins:
    rows that it rules out need no shuffle. The more keys, the more rows it lets through to the join, which decides.
    """
    chunk = 15  # Spark's bitmaps have 2 ** 15 bits
    place = lambda *columns: F.pmod(F.xxhash64(F.lit(bits), *columns), F.lit(1 << bits))
    marks = keys.select(place(*[col(c) for c in keys.columns]).alias("place"))
    parts = marks.groupBy(F.shiftright("place", chunk).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << chunk) - 1))).alias("bitmap")
    ).coalesce(16)  # 128 parts of 4 KB, of one row each task that counted
    every = keys.sparkSession.range(1 << (bits - chunk)).join(parts, F.col("id") == F.col("part"), "left")
    whole = scratch.store(every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bitmap", F.lit(b"")).alias("bitmap")))), lambda x: x["bitmap"]).alias("parts")), "bitmap")

    def test(*columns: Column) -> Column:
        at = place(*columns)
        part = F.element_at(whole.scalar(), (F.shiftright(at, chunk) + 1).cast("int"))
        byte = F.substring(part, (F.shiftright(at, 3).bitwiseAND(F.lit((1 << (chunk - 3)) - 1)) + 1).cast("int"), F.lit(1))
        value = F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int"), F.lit(0))
        return F.getbit(value, at.bitwiseAND(F.lit(7)).cast("int")) == 1

    return test


def without(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` without the rows whose id and hash of the text are in ``gone`` (two columns).

    Null ids and hashes of null texts count as values; only rows that a bitmap of the pairs lets through are shuffled.
    """
    gone_id, gone_mark = fresh(docs, "gone_id", "gone_mark")
    pairs = scratch.store(gone.toDF(gone_id, gone_mark).distinct(), "gone")
    maybe = membership(pairs, scratch)(col(id_col), text_mark(text_col))
    same = col(id_col).eqNullSafe(F.col(gone_id)) & (text_mark(text_col) == F.col(gone_mark))
    rest = docs.filter(maybe).join(pairs.hint("merge"), same, "left_anti")
    return docs.filter(~maybe).unionAll(rest)
