"""Facts kept as versions of partitions: a load rewrites only the partitions its rows fall into.

``base/table/data/commit=<c>/part=<p>`` holds the files that one load wrote, ``base/table/versions/<run>/<n>`` which
commit's files are current for every partition after the n-th load of a run. A version is written last and files of
other runs are never changed, so a load that failed is simply run again, and readers of an older version are not disturbed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metricmart.operators.audit import assert_unique
from metricmart.operators.upsert import empty_like, upsert

MOST_PARTITIONS = 10_000  # partitions that a fact may have: years or hash buckets
HASH_PARTITIONS = 16  # for facts whose key has no year
MISSING = "_missing"  # why a row cannot be loaded: the lookups that found nothing, comma-joined


def noted(df: DataFrame, found: Column, what: str) -> DataFrame:
    """Mark the rows whose lookup found nothing, instead of losing them in an inner join."""
    earlier = [F.col(MISSING)] if MISSING in df.columns else []
    reason = F.concat_ws(",", *earlier, F.when(found.isNull(), F.lit(what)))
    return df.withColumn(MISSING, F.nullif(reason, F.lit("")))


def loadable(df: DataFrame) -> DataFrame:
    """The rows whose lookups all found something, without the mark."""
    return df.filter(F.col(MISSING).isNull()).drop(MISSING) if MISSING in df.columns else df


def partition_of(keys: Sequence[str]) -> Column:
    """The partition of a row, from its key alone: the year where the key has one, else a hash bucket."""
    if "date_id" in keys:  # year * 10 + 1, or year * 100 + quarter
        year = F.when(F.col("date_id") >= 100_000, F.expr("date_id DIV 100")).otherwise(F.expr("date_id DIV 10"))
    elif "year" in keys:
        year = F.col("year")
    elif "period_date" in keys:
        year = F.year("period_date")
    else:
        return F.concat(F.lit("h"), F.pmod(F.xxhash64(*keys), F.lit(HASH_PARTITIONS)).cast("string"))
    return F.coalesce(F.concat(F.lit("y"), year.cast("string")), F.lit("none"))


class PartitionedFact:
    """One fact in a run: starts from the version of the run before, and merges rows into the partitions they touch.

    After a merge, ``counts`` holds the rows that came (``rows``), those rejected, and NULLs per column by position.
    """

    def __init__(self, spark: SparkSession, base: str, table: str, run_id: str, previous: str | None = None):
        self.spark, self.table, self.run_id, self.previous = spark, table, run_id, previous
        self.path = f"{base.rstrip('/')}/{table}"
        self.loads = 0
        self.counts: dict[str, int] = {}

    def _file(self, path: str):
        file = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return file, file.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self, run: str, n: int) -> bool:
        file, system = self._file(f"{self.path}/versions/{run}/{n}/_SUCCESS")
        return system.exists(file)

    def files(self) -> dict[str, str]:
        """Partition → the commit whose files are current."""
        run, n = self.run_id, self.loads
        if not n and self.previous is not None:
            run = self.previous
            while self._complete(run, n + 1):
                n += 1
        if not n:
            return {}
        return {r["part"]: r["commit"] for r in self.spark.read.parquet(f"{self.path}/versions/{run}/{n}").collect()}

    def _rows(self, files: dict[str, str]) -> DataFrame | None:
        if not files:
            return None
        paths = [f"{self.path}/data/commit={c}/part={p}" for p, c in sorted(files.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths).drop("commit", "part")

    def read(self) -> DataFrame | None:
        """The current rows; None before the first load."""
        return self._rows(self.files())

    def _written_once(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Write what came in one pass, rejected rows apart, counted while it is written."""
        rows = rows if MISSING in rows.columns else rows.withColumn(MISSING, F.lit(None).cast("string"))
        seen = Observation(f"{self.path}:{self.run_id}:{self.loads}")
        nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
        marked = rows.withColumn("rejected", F.col(MISSING).isNotNull())
        watched = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejected"), *nulls)
        watched.write.mode("overwrite").partitionBy("rejected").parquet(self._incoming())
        self.counts = {k: int(v) for k, v in seen.get.items()}
        self._incoming_schema = marked.schema
        return self._came()

    def _incoming(self) -> str:
        return f"{self.path}/incoming/{self.run_id}-{self.loads}"

    def _came(self) -> DataFrame:
        return self.spark.read.schema(self._incoming_schema).parquet(self._incoming())

    def quarantine(self) -> DataFrame:
        """Rows that the last merge rejected; ``_missing`` names the lookups that found nothing."""
        return self._came().filter("rejected").drop("rejected")

    def reasons(self) -> dict[str, int]:
        """Rejected rows of the last merge by reason."""
        return {r[MISSING]: r["count"] for r in self.quarantine().groupBy(MISSING).count().collect()} if self.counts.get("rejected") else {}

    def merge(
        self, rows: DataFrame, keys: Sequence[str], columns: Sequence[str], only_where: Column | None = None,
        prepare: Callable[[DataFrame], DataFrame] | None = None, part: Column | None = None,
    ) -> DataFrame:
        """Upsert rows by key; returns the fact's new version. See ``upsert.upsert`` for ``only_where``.

        ``prepare`` makes one row a key of the accepted rows, ``part`` must follow from the key columns. A batch of one
        year reads and rewrites the files of that year; all other files are listed in the new version as they were.
        """
        before = self.files()
        if not self.loads:  # what an earlier attempt at this run left
            file, system = self._file(f"{self.path}/versions/{self.run_id}")
            system.delete(file, True)
        self.loads += 1
        part = part if part is not None else partition_of(keys)
        accepted = self._written_once(rows, [c for c in columns if c in rows.columns]).filter("NOT rejected")
        source = (prepare(accepted) if prepare else accepted).select(*columns)
        assert_unique(source, keys, f"the rows to load into {self.table}")
        touched = [r[0] for r in source.select(part).distinct().limit(MOST_PARTITIONS + 1).collect()]
        commit, data = f"{self.run_id}-{self.loads}", f"{self.path}/data"
        after = {**before, **dict.fromkeys(touched, commit)}
        if len(after) > MOST_PARTITIONS:
            raise ValueError(f"{self.table}: more than {MOST_PARTITIONS} partitions")
        old = self._rows({p: c for p, c in before.items() if p in touched})
        if old is not None:
            source = source.select(*[F.col(f"`{c}`").cast(old.schema[c].dataType) for c in columns])
        if touched:
            merged = upsert(old if old is not None else empty_like(source), source, keys, only_where)
            merged.withColumn("part", part).hint("rebalance", F.col("part")).write.mode("overwrite").partitionBy("part").parquet(f"{data}/commit={commit}")
        version = self.spark.createDataFrame(sorted(after.items()), "part string, commit string")
        version.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/{self.run_id}/{self.loads}")
        found = self.read()
        return found if found is not None else empty_like(source)
