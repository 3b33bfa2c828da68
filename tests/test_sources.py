"""File effects: readers, landing, sinks, catalog, run log, page extracts."""

import pytest
from pyspark.sql import functions as F

from metricmart.operators import audit, upsert
from metricmart.operators.dimensions import date_dimension
from metricmart.sources import catalog, landing, pages, readers, sinks
from metricmart.sources.literals import literal_table


def test_read_tabular_standard_names_and_aliases(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Year ,Turnover-Million GBP\n2020,5\n")
    df = readers.standard_names(readers.read_tabular(spark, str(path)))
    assert df.columns == ["year", "turnover_million_gbp"]
    renamed = readers.with_aliases(df, landing.COLUMN_ALIASES["lcree"])
    assert renamed.columns == ["year", "lcree_turnover_million_gbp"]
    both = readers.with_aliases(renamed.withColumn("turnover_current_prices_million_gbp", F.lit(1)), landing.COLUMN_ALIASES["lcree"])
    assert both.columns[-1] == "turnover_current_prices_million_gbp"
    with pytest.raises(ValueError):
        readers.read_tabular(spark, "x.docx")


def test_parquet_scan_prunes_and_pushes(spark, tmp_path):
    from support import plan_of

    from metricmart.operators.filters import years

    path = str(tmp_path / "t.parquet")
    spark.range(10).select((F.col("id") + 2000).cast("int").alias("year"), F.lit("x").alias("a"), F.lit("y").alias("b")).write.parquet(path)
    df = years(readers.read_tabular(spark, path), 2002, 2004).select("a")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(year,2002)" in plan and "ReadSchema: struct<year:int,a:string>" in plan


def test_separators_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n\n")
    (tmp_path / "b.csv").write_text("X;Y\n3;4,5\n6\n;;;\n")
    got = readers.read_delimited(spark, str(tmp_path), ["x", "y"]).select("x", "y", F.regexp_extract("file", r"(\w)\.csv", 1)).collect()
    assert sorted(map(tuple, got), key=str) == [("1", "2", "a"), ("3", "4,5", "b"), ("6", None, "b")]


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_quoted_line_breaks_across_blocks(spark, tmp_path, block):
    """Records torn by line breaks inside quotes, in files read in blocks of a few lines."""
    rows = [(str(i), "\n".join(f'say "{k}"; x,' for k in range(i % 7)) or "none") for i in range(60)]
    for name, sep in (("a", ","), ("b", ";")):
        quoted = [f"k{sep}v{sep}z"] + [f'{k}{sep}"{v.replace(chr(34), chr(34) * 2)}"{sep}{sep}{sep}{sep}{sep}{sep}{sep}{sep}' for k, v in rows]
        (tmp_path / f"{name}.csv").write_text("\n".join(quoted) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        got = readers.read_delimited(spark, str(tmp_path), ["k", "v", "z"], quoted_breaks=True).select("k", "v").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, got)) == sorted(rows * 2)


def test_first_of_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_c0 int, _c1 int, _c2 int")
    assert readers.first_of_duplicates(df, ["a", "b", "a"]).collect()[0].asDict() == {"a": 1, "b": 2}


def test_mapping_table_blanks_are_null(spark, tmp_path):
    (tmp_path / "m.csv").write_text("src,canon\nA, \nB,x\n")
    rows = readers.mapping_table(spark, str(tmp_path / "m.csv"), ["src", "canon"]).orderBy("src").collect()
    assert [tuple(r) for r in rows] == [("A", None), ("B", "x")]


def test_documents_land_idempotently(spark):
    rows = spark.createDataFrame([(2020, "A", 1.5), (2021, None, 2.0)], "year int, company_name string, ens_mwh double")
    first = landing.land_documents(upsert.empty_like(landing.as_documents(rows, "s")), rows, "s")
    second = landing.land_documents(first, rows.withColumn("ens_mwh", F.lit(9.0)), "s")
    assert first.count() == second.count() == 2
    assert {r.payload for r in second.select(F.to_json("payload").alias("payload")).collect()} == {
        '{"company_name":"A","ens_mwh":"9.0","year":"2020"}', '{"company_name":null,"ens_mwh":"9.0","year":"2021"}',
    }


def test_long_rows_land_null_safe(spark):
    rows = spark.createDataFrame([(2020, None, "m", 1.0)], "year int, supplier_name string, metric_name string, value double")
    again = landing.land_rows(rows, rows.withColumn("value", F.lit(2.0)), ["year", "supplier_name", "metric_name"])
    assert [r.value for r in again.collect()] == [2.0]


def test_stage_snapshots_feed_the_next_run(spark, tmp_path):
    one = sinks.Stage(spark, str(tmp_path), "r1")
    one.write("t", spark.createDataFrame([(1, "a")], "k int, v string"))
    two = sinks.Stage(spark, str(tmp_path), "r2", previous="r1")
    source = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    stored = two.write("t", upsert.upsert(two.before("t"), source, ["k"]))
    assert sorted(tuple(r) for r in stored.collect()) == [(1, "b"), (2, "c")]
    assert [tuple(r) for r in one.read("t").collect()] == [(1, "a")] and one.before("t") is None


def test_tables_views_and_exports(spark, tmp_path):
    df = date_dimension(spark, 2000, 2001)
    assert df.count() == 10 and df.filter("date_id = 20001").first().period_label == "2000-annual"
    sinks.create_table(df, "made_table")
    sinks.materialise(df.filter("quarter is null"), "mart_dates", str(tmp_path / "mart"))
    sinks.publish_views(sinks.compatibility_names({"core_dim_date": df}))
    assert spark.table("dim_date").count() == 10
    names = ["made_table", "mart_dates", "absent"]
    assert {r.obj: r.n for r in catalog.row_counts(spark, names).collect()} == {"made_table": 10, "mart_dates": 2}
    assert {r.object_name: r.exists for r in catalog.status(spark, names).collect()} == {"made_table": True, "mart_dates": True, "absent": False}
    sinks.export_csv(df.select("year", "quarter"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 10
    assert literal_table(spark, [], "a int").count() == 0


def test_run_log_counts_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    watched, observation = audit.observed(df, "load")
    watched.write.mode("overwrite").parquet(str(tmp_path / "t"))
    log = str(tmp_path / "log")
    audit.append_run(spark, log, "source", "t", observation.get, df.columns)
    audit.append_run(spark, log, "bad", "t", status="failed", error="no file")
    got = {r.source_id: r for r in spark.read.parquet(log).collect()}
    assert got["source"].row_count == 2 and got["source"].null_rate_json == '{"b": 0.5, "a": 0.0}'
    assert got["bad"].status == "failed"
    with pytest.raises(ValueError, match="repeats"):
        audit.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "t")
    assert audit.sample_tables(spark, {"s": [{"year": 2021, "v": 1.0}]})["s"].count() == 1


def test_page_charts(spark):
    html = '<div data-js-chart-modal-data=\'{&quot;title&quot;:&quot;A &amp; B&quot;}\'></div><script>var options = {"data":{"csv":"\\"q\\";\\"v;w\\"\\nQ1 2020;5"}};</script>'
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    cells = pages.csv_cells(pages.chart_csv(df)).orderBy("row", "col").collect()
    assert [(c.row, c.col, c.text) for c in cells] == [(0, 0, "q"), (0, 1, "v;w"), (1, 0, "Q1 2020"), (1, 1, "5")]
    assert pages.modal_data(df, ["title"]).first().title == "A & B"


def test_quoted_cells_of_page_tables(spark):
    csv = 'a,"b ""x"", c",d\n"1\n2",, " y "\n\n"",3,4'
    cells = pages.csv_cells(spark.createDataFrame([(1, csv)], "page_id int, csv string")).collect()
    assert sorted((c.row, c.col, c.text) for c in cells) == [
        (0, 0, "a"), (0, 1, 'b "x", c'), (0, 2, "d"), (1, 0, "1\n2"), (1, 1, ""), (1, 2, " y "), (3, 0, ""), (3, 1, "3"), (3, 2, "4"),
    ]


def test_a_very_long_quoted_line(spark):
    """A line of some MB is cut in time linear in its length."""
    import time

    csv = ",".join('"x;,y"' for _ in range(300_000))
    df = spark.createDataFrame([(1, csv)], "page_id int, csv string")
    start = time.time()
    assert pages.csv_cells(df).filter("text = 'x;,y'").count() == 300_000
    assert time.time() - start < 20


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"two\nlines"\n2,x\n')
    rows = readers.read_tabular(spark, str(tmp_path / "a.csv"), multi_line=True).collect()
    assert [(r.k, r.v) for r in rows] == [("1", "two\nlines"), ("2", "x")]
