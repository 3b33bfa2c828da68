"""Loads from streams: batches merge in place, and a replayed batch changes nothing."""

from metricmart.operators.upsert import upsert_all
from metricmart.sources.versions import PartitionedFact
from metricmart.streaming import loads

SCHEMA = "date_id int, company_id long, value double"
KEYS, COLUMNS = ["date_id", "company_id"], ["date_id", "company_id", "value"]


def batches(spark):
    rows = [[(20101, 1, 1.0), (20111, 1, 1.0)], [(20111, 1, 2.0), (20121, None, 2.0)], [(20101, 1, 3.0), (20121, None, 3.0)]]
    return [spark.createDataFrame(r, SCHEMA) for r in rows]


def test_a_replayed_batch_leaves_the_table_as_it_was(spark, tmp_path, rows):
    frames = batches(spark)
    for i, frame in enumerate(frames):
        loads.load_batch(frame, i, str(tmp_path), "f", KEYS, COLUMNS)
    whole = rows(upsert_all(frames[0], frames[1:], KEYS))
    assert rows(loads.current(spark, str(tmp_path), "f", 2)) == whole
    again = loads.load_batch(frames[2], 2, str(tmp_path), "f", KEYS, COLUMNS)  # the last batch of a stream that failed
    assert rows(again.read()) == whole and again.files()["y2011"] == "batch-000000000001-1"


def test_stream_equals_batch_load(spark, tmp_path, rows):
    frames, source = batches(spark), str(tmp_path / "in")
    spark.createDataFrame([(20101, 9, 0.0)], SCHEMA).coalesce(1).write.parquet(source)
    PartitionedFact(spark, str(tmp_path), "f", "start").merge(spark.read.parquet(source), KEYS, COLUMNS)
    for n in range(2):  # stopped and started again: goes on behind the files it has seen
        frames[n].coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = loads.stream_into(stream, str(tmp_path), "f", KEYS, COLUMNS, str(tmp_path / "offsets"), start_from="start")
        query.awaitTermination(120)
        assert query.exception() is None
    first = spark.createDataFrame([(20101, 9, 0.0)], SCHEMA)
    # three files, one a batch, the first of which the fact had already
    assert rows(loads.current(spark, str(tmp_path), "f", 2)) == rows(upsert_all(first, frames[:2], KEYS))
