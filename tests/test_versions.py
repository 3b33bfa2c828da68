"""Partitioned facts: which files a load writes, what it rejects, and that the result is the plain upsert."""

import os

import pytest
from pyspark.sql import functions as F

from metricmart.operators.upsert import upsert
from metricmart.plans import core
from metricmart.sources.versions import MISSING, PartitionedFact, noted

SCHEMA = "date_id int, company_id long, value double"
KEYS, COLUMNS = ["date_id", "company_id"], ["date_id", "company_id", "value"]


def files(base):
    return {os.path.relpath(os.path.join(d, n), base): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(f"{base}/f/data") for n in names if n.endswith(".parquet")}


def years(spark, value, *chosen):
    return spark.createDataFrame([(y * 10 + 1, c, value + c) for y in chosen for c in range(3)], SCHEMA)


def test_a_batch_of_one_year_writes_one_partition(spark, tmp_path, rows):
    base = str(tmp_path)
    first = PartitionedFact(spark, base, "f", "r1").merge(years(spark, 1.0, 2010, 2011, 2012), KEYS, COLUMNS)
    before = files(base)
    batch = years(spark, 5.0, 2012).filter("company_id < 2").unionByName(spark.createDataFrame([(20121, 9, 7.0)], SCHEMA))
    fact = PartitionedFact(spark, base, "f", "r2", previous="r1")
    second = fact.merge(batch, KEYS, COLUMNS)
    after = files(base)
    assert {k: after[k] for k in before} == before
    assert all("commit=r2-1/part=y2012" in k for k in set(after) - set(before)) and len(after) > len(before)
    assert fact.files() == {"y2010": "r1-1", "y2011": "r1-1", "y2012": "r2-1"}
    assert rows(second) == rows(upsert(first, batch, KEYS)) and second.count() == 10
    # the older version is still there, and a plan over the new one reads the current files only
    assert rows(PartitionedFact(spark, base, "f", "r3", previous="r1").read()) == rows(first)
    assert not any("r1-1/part=y2012" in f for f in second.inputFiles())


def test_runs_repeat_and_go_on(spark, tmp_path, rows):
    base = str(tmp_path)
    PartitionedFact(spark, base, "f", "r1").merge(years(spark, 1.0, 2010, 2011), KEYS, COLUMNS)
    for _ in range(2):  # the second attempt starts from the version of the run before
        fact = PartitionedFact(spark, base, "f", "r2", previous="r1")
        fact.merge(years(spark, 2.0, 2011), KEYS, COLUMNS)
        last = fact.merge(years(spark, 3.0, 2012), KEYS, COLUMNS)
    assert fact.files() == {"y2010": "r1-1", "y2011": "r2-1", "y2012": "r2-2"}
    assert sorted({r["value"] - r["company_id"] for r in rows(last)}) == [1.0, 2.0, 3.0]
    quiet = PartitionedFact(spark, base, "f", "r3", previous="r2")
    assert rows(quiet.merge(years(spark, 0.0), KEYS, COLUMNS)) == rows(last) and quiet.files() == fact.files()


def test_empty_first_load_and_keys_without_year(spark, tmp_path, rows):
    empty = PartitionedFact(spark, str(tmp_path), "e", "r1").merge(years(spark, 1.0), KEYS, COLUMNS)
    assert empty.count() == 0 and empty.columns == COLUMNS
    table = spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("double").alias("v"))
    fact = PartitionedFact(spark, str(tmp_path), "h", "r1")
    assert rows(fact.merge(table, ["k"], ["k", "v"])) == rows(table) and 1 < len(fact.files()) <= 16
    one = PartitionedFact(spark, str(tmp_path), "h", "r2", previous="r1")
    changed = one.merge(spark.createDataFrame([("k7", -1.0)], "k string, v double"), ["k"], ["k", "v"])
    assert changed.count() == 200 and sum(c == "r2-1" for c in one.files().values()) == 1
    nulls = PartitionedFact(spark, str(tmp_path), "n", "r1")
    kept = nulls.merge(spark.createDataFrame([(None, 1, 2.0)], SCHEMA), KEYS, COLUMNS)
    assert rows(kept) == [{"date_id": None, "company_id": 1, "value": 2.0}] and list(nulls.files()) == ["none"]


def test_only_some_target_rows_may_match(spark, tmp_path, rows):
    target = spark.createDataFrame([(2010, "a", None, 1.0), (2010, "b", "Q1", 1.0)], "year int, k string, period_label string, v double")
    batch = target.withColumns({"v": F.lit(5.0), "period_label": F.lit(None).cast("string")})
    columns = ["year", "k", "period_label", "v"]
    PartitionedFact(spark, str(tmp_path), "f", "r1").merge(target, ["year", "k"], columns)
    found = PartitionedFact(spark, str(tmp_path), "f", "r2", "r1").merge(batch, ["year", "k"], columns, F.col("period_label").isNull())
    assert rows(found) == rows(upsert(target, batch, ["year", "k"], F.col("period_label").isNull()))


def test_rejected_rows_are_counted_and_kept(spark, tmp_path, rows):
    came = spark.createDataFrame([(20101, 1, 1.0), (None, 2, 2.0), (None, None, 3.0), (20101, None, 4.0)], SCHEMA)
    marked = noted(noted(came, F.col("date_id"), "year"), F.col("company_id"), "company_name")
    fact = PartitionedFact(spark, str(tmp_path), "f", "r1")
    assert rows(fact.merge(marked, KEYS, COLUMNS)) == [{"date_id": 20101, "company_id": 1, "value": 1.0}]
    assert (fact.counts["rows"], fact.counts["rejected"]) == (4, 3)
    assert fact.reasons() == {"year": 1, "year,company_name": 1, "company_name": 1}
    assert sorted(r["value"] for r in rows(fact.quarantine())) == [2.0, 3.0, 4.0] and MISSING in fact.quarantine().columns
    assert core.store(marked, KEYS, COLUMNS, None).count() == 1


def test_repeated_keys_leave_the_fact_as_it_was(spark, tmp_path):
    base = str(tmp_path)
    PartitionedFact(spark, base, "f", "r1").merge(years(spark, 1.0, 2010), KEYS, COLUMNS)
    twice = years(spark, 2.0, 2010).unionByName(years(spark, 3.0, 2010))
    with pytest.raises(ValueError, match="repeats"):
        PartitionedFact(spark, base, "f", "r2", "r1").merge(twice, KEYS, COLUMNS)
    assert PartitionedFact(spark, base, "f", "r3", "r1").read().filter("value > 4").count() == 0
