"""Tabular files in, with column standardisation and contract aliases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricmart.functions import delimited
from metricmart.session import stored


def read_tabular(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV or parquet by suffix. CSV columns are text unless a schema is given; nothing is inferred by scanning.

    A CSV is split at line breaks, so that one large file is read by many tasks. ``multi_line`` keeps line breaks inside
    quoted fields, at the price of one task per file.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        reader = spark.read.option("header", True).option("multiLine", multi_line)
        return (reader.schema(schema) if schema else reader).csv(path)
    raise ValueError(f"unsupported file format: {suffix}")


def standard_names(df: DataFrame) -> DataFrame:
    """Column names trimmed, in lower case, with underscores for blank, hyphen and slash."""
    table = str.maketrans(" -/", "___")
    return df.toDF(*[c.strip().lower().translate(table) for c in df.columns])


def with_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename alternative column names where the canonical one is absent; the first alternative wins."""
    taken = set(df.columns)
    renames = {}
    for old, new in aliases.items():
        if old in taken and new not in taken:
            renames[old] = new
            taken.add(new)
    return df.withColumnsRenamed(renames)


def first_of_duplicates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the first of equally named columns. ``df`` was read by position, ``names`` is its header."""
    positions: dict[str, int] = {}
    for i, name in enumerate(names):
        positions.setdefault(name, i)
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(name) for name, i in positions.items()])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their file, the block of it they are in, and their order in the block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value"
    )


def delimiter_per_file(lines: DataFrame) -> DataFrame:
    """Comma or semicolon per file, whichever occurs more often.

    Counted line by line and summed per file, so a large file is not one value in one task.
    """

    def count(mark: str):
        return F.sum(F.length("value") - F.length(F.replace("value", F.lit(mark), F.lit(""))))

    counts = lines.groupBy("file").agg(count(";").alias("_semi"), count(",").alias("_comma"))
    return counts.select("file", F.when(F.col("_semi") > F.col("_comma"), F.lit(";")).otherwise(F.lit(",")).alias("sep"))


def whole_records(lines: DataFrame) -> DataFrame:
    """Lines (file, block, place, value) with those joined that a line break inside quotes had torn apart.

    A line ends a record if the quotes up to its end are even in number. Quotes are counted per block of a file, the counts
    of earlier blocks of the file are added (one row a block), and inside a block a window goes on from there. So a large
    file is read by many tasks.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("_quotes", quotes)
    per_block = counted.groupBy("file", "block").agg(F.sum("_quotes").alias("_in_block"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = per_block.select(F.col("file").alias("_f"), F.col("block").alias("_b"), F.coalesce(F.sum("_in_block").over(earlier), F.lit(0)).alias("_before"))
    so_far = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = counted.join(before, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))).withColumn("_until", F.col("_before") + F.sum("_quotes").over(so_far))
    # a record starts where the quotes before a line are even; its lines share the number of starts so far
    starts = joined.withColumn("_starts", ((F.col("_until") - F.col("_quotes")) % 2 == 0).cast("long"))
    in_block = starts.groupBy("file", "block").agg(F.sum("_starts").alias("_n")).select(
        F.col("file").alias("_f2"), F.col("block").alias("_b2"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from")
    )
    numbered = starts.join(in_block, (F.col("file") == F.col("_f2")) & (F.col("block") == F.col("_b2"))).withColumn("_record", F.col("_from") + F.sum("_starts").over(so_far))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    return numbered.groupBy("file", F.col("_record").alias("record")).agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value"))


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], quoted_breaks: bool = False) -> DataFrame:
    """Text tables of mixed separators in one folder as one table, all columns as text, with their ``file``.

    The separators of the files are a table joined on the file's path, and every line is cut by the separator of its file;
    no list of files is made. Header lines (the column names, in any case) and blank lines are left out; cells beyond the
    columns too. ``quoted_breaks`` joins records that line breaks inside quotes had torn apart, which shuffles the lines.
    """
    lines = _lines(spark, path)
    found = stored(delimiter_per_file(lines)).withColumnRenamed("file", "_file")
    rows = whole_records(lines) if quoted_breaks else lines
    joined = rows.join(found, F.col("file") == F.col("_file"))
    cut = joined.select("file", delimited.cells(delimited.held_quotes(F.col("value")), F.col("sep")).alias("_cells")).filter(F.array_join("_cells", "") != "")
    header = F.array(*[F.lit(c.lower()) for c in columns])
    names = F.transform(F.slice("_cells", 1, len(columns)), lambda c: F.lower(c))
    data = cut.filter(names != header)
    return data.select("file", *[F.nullif(F.get("_cells", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


def mapping_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A mapping CSV with blank cells as NULL."""
    table = spark.read.option("header", True).csv(path).select(*columns)
    return table.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in columns})
