"""Session helpers: settings worth fixing for warehouse jobs, and the shared folder for stage snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes shuffle partitions, turns small join sides into broadcasts at run time and splits skewed
# join partitions, also where that costs an extra shuffle: one hot key must not become one slow task.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
WAREHOUSE_SETTINGS = {**ADAPTIVE_SETTINGS, "spark.sql.session.timeZone": "UTC"}


def get_spark(app_name: str = "metricmart", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create a session with the warehouse settings; ``settings`` override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**WAREHOUSE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the adaptive settings on a session that somebody else created."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and stage snapshots.

    Comes from ``spark.checkpoint.dir``, or from the checkpoint folder already set on the context. Where neither is set
    (tests, a laptop) it lies in the warehouse folder, which executors share as well.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def stored(df: DataFrame) -> DataFrame:
    """A reduced intermediate result, stored reliably in the checkpoint folder. Runs one job.

    For results that several later steps of one job read: without it every reader would run the whole job above it
    again. Survives the loss of executors, unlike a cache or a local checkpoint.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def stored_small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A stored result, broadcast in joins if it turned out to have at most ``most`` rows.

    Spark does not know the size of a checkpoint, and adaptive execution would have shuffled the other side before it does.
    """
    result = stored(df)
    return F.broadcast(result) if result.limit(most + 1).count() <= most else result
