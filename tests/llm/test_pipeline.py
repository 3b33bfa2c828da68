"""Registered queries against their SQL, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from metricmart.llm import decontaminate, exact_dedup, queries
from metricmart.llm.common import Scratch

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "conversations", "pages", "labels", "benchmark"]


def test_one_query_for_each_operator():
    names = [n for n in driver.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in driver.queries()
    assert set(queries.ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = connection.execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(cursor.fetchall())


def test_stages(spark, tmp_path):
    """Each stage's decisions on its own input, against the documents it got."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_duplicates", "decontamination", "source_mix"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns
        got, had = Counter(map(tuple, after.collect())), Counter(map(tuple, before.collect()))
        assert set(got) <= set(had)
        texts = lambda rows: Counter(r[1] or "" for r in rows.elements())
        if name == "exact_dedup":
            assert set(texts(got)) == set(texts(had)) and max(texts(got).values()) == 1
        elif name == "decontamination":
            holds = lambda t: any(decontaminate.normalise(b) in decontaminate.normalise(t) for b in benchmark)
            assert not any(holds(t) for t in texts(got))
            assert all(holds(r[1]) for r in had - got if r not in got)
        elif name == "source_mix":
            assert max(got.values()) <= 2
        else:
            assert max(got.values()) == 1 and len(got) > 0.7 * len(had)
        before = after


def test_pipeline_over_an_empty_table(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == spark.read.parquet(f"{SF}/documents.parquet").columns


def test_plans_shuffle_no_text_for_exact_groups(spark, docs, scratch):
    df = docs([(1, "a"), (2, "a"), (3, "b")])
    plan = exact_dedup.exact_groups(df, scratch)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op4_refined_exact_dedup", "op6_snapshot_collapse_chat", "op8_bootstrapped_pii"])
def test_native_queries_run_no_python(spark, monkeypatch, name):
    """Neither the result nor anything that is stored on the way goes through Python workers."""
    plans, store = [], Scratch.store
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(Scratch, "store", lambda self, df, *args, **options: plans.append(plan(df)) or store(self, df, *args, **options))
    plans.append(plan(queries.QUERIES[name](spark, SF)))
    assert len(plans) > 1 and not any(word in p for p in plans for word in ("Python", "Arrow", "Pandas"))


def test_pipeline_stages_with_null_and_repeated_ids(spark):
    """Clean rows without an id, of one id or with columns of an operator's own names come through every filtering stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).withColumn("lang", F.lit("en"))
    fill = "a quiet river runs under the old stone bridge and nobody counts the boats number"
    odd = [(i, f"{fill} {n} {'xyz'[n % 3]} {n * 7}", "en", "src0", 1) for n, i in enumerate([None, None, 7, 7])]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = docs.select(*names).unionByName(spark.createDataFrame(odd + odd[:1], "doc_id long, text string, lang string, source string, n_chars long"))
    rows = rows.withColumns({"rank": F.lit("x"), "mark": F.lit("y")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, rows, SF)
        assert after.columns == rows.columns
        kept = Counter((r["doc_id"], r["text"]) for r in after.collect())
        if name == "exact_dedup":
            assert all(kept[(i, t)] == 1 for i, t, *_ in odd)
        elif name == "near_duplicates":
            assert all(kept[(i, t)] >= 1 for i, t, *_ in odd if i is None)
        else:
            assert kept[(None, odd[0][1])] == 2 and all(kept[(i, t)] == 1 for i, t, *_ in odd[1:])
