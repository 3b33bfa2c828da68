"""Tables out: full reloads, snapshots per run, marts as tables and views, exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Stage:
    """Snapshots of one run in a shared folder: ``base/run_id/table``.

    An upsert reads the table of the previous run and writes the one of this run, so a table is never overwritten while
    it is read, and a run that failed half-way is simply run again under its id.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str, previous: str | None = None):
        self.spark, self.base, self.run_id, self.previous = spark, base.rstrip("/"), run_id, previous

    def path(self, table: str, run_id: str | None = None) -> str:
        return f"{self.base}/{run_id or self.run_id}/{table}"

    def write(self, table: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table of this run and read it back: the stored snapshot also cuts the plan's lineage."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table))
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def before(self, table: str) -> DataFrame | None:
        """The table of the previous run, if there was one."""
        return self.spark.read.parquet(self.path(table, self.previous)) if self.previous else None


def reload(df: DataFrame, path: str) -> None:
    """Full reload: the table holds exactly these rows afterwards."""
    df.write.mode("overwrite").parquet(path)


def create_table(df: DataFrame, name: str) -> None:
    """Create-table-as in the catalog."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def materialise(df: DataFrame, name: str, path: str) -> DataFrame:
    """Rebuild a mart: write it, and publish it under its name."""
    reload(df, path)
    stored = df.sparkSession.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored


def publish_views(tables: Mapping[str, DataFrame]) -> None:
    """Register tables under view names (also compatibility names such as ``fact_*`` and ``dim_*``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def compatibility_names(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``core_fact_x`` and ``core_dim_x`` also under ``fact_x`` and ``dim_x``."""
    short = {n.removeprefix("core_"): df for n, df in tables.items() if n.startswith("core_")}
    return {**tables, **short}


def export_csv(df: DataFrame, path: str) -> None:
    """Export with a header line; one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
