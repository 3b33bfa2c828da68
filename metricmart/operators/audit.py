"""Run log, uniqueness assertions and contract samples."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metricmart.operators.quality import duplicates

RUN_LOG = (
    "run_ts timestamp, source_id string, target_table string, row_count bigint, null_rate_json string, "
    "status string, error string, rejected bigint, rejected_json string"
)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach row and NULL counts to a table; they are collected while the table is written, without an extra pass."""
    observation = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(df.columns)]
    return df.observe(observation, *counts), observation


def null_rate_json(counts: Mapping[str, int], columns: Sequence[str]) -> str:
    """NULL share per column as JSON, highest first; ``counts`` are those of an observation."""
    rows = max(int(counts["rows"]), 1)
    rates = {c: int(counts[f"nulls_{i}"]) / rows for i, c in enumerate(columns)}
    return json.dumps(dict(sorted(rates.items(), key=lambda item: -item[1])))


def append_run(
    spark: SparkSession,
    path: str,
    source_id: str,
    target: str,
    counts: Mapping[str, int] | None = None,
    columns: Sequence[str] = (),
    status: str = "loaded",
    error: str | None = None,
    reasons: Mapping[str, int] | None = None,
) -> None:
    """Append one line to the run log: rows loaded, NULL shares, and for loads the rows rejected, by reason."""
    rejected = int((counts or {}).get("rejected", 0))
    rows = int(counts["rows"]) - rejected if counts else 0
    rates = null_rate_json(counts, columns) if counts else "{}"
    line = [(datetime.now(timezone.utc), source_id, target, rows, rates, status, error, rejected, json.dumps(dict(sorted((reasons or {}).items()))))]
    spark.createDataFrame(line, RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def recorded_rows(log: DataFrame) -> dict[str, int]:
    """Rows of every table as its last loaded line in the run log says; one line a table, so the log's size does not matter."""
    last = log.filter("status = 'loaded'").groupBy("target_table").agg(F.max_by("row_count", "run_ts").alias("rows"))
    return {r["target_table"]: r["rows"] for r in last.collect()}


def assert_unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """The table itself, or an error when a key repeats (what a MERGE would refuse). Runs one aggregation."""
    found = duplicates(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"{table}: key {list(keys)} repeats, e.g. {found[0].asDict()}")
    return df


def sample_tables(spark: SparkSession, samples: Mapping[str, Sequence[Mapping[str, object]]]) -> dict[str, DataFrame]:
    """Contract sample rows per source as tables."""
    return {name: spark.createDataFrame([dict(r) for r in rows]) for name, rows in samples.items()}
