"""Properties of the operators: null-safety, skew-safe rewrites, conservation, idempotence, plan shapes."""

import random

import pytest
from support import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metricmart.operators import aggregates, conform, dimensions, joins, model, pivot, quality, ranking, stats, upsert, windows
from metricmart.operators.quantiles import exact_quantiles
from metricmart.sources.literals import literal_table

relaxed = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


@relaxed
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_exact_quantiles_match_a_sorted_list(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_quantiles(df, [], "v", {"a": 0.25, "b": 0.5, "c": 0.95}).first()
    for name, p in (("a", 0.25), ("b", 0.5), ("c", 0.95)):
        assert got[name] == pytest.approx(percentile(values, p))


def test_exact_quantiles_with_a_hot_group_and_null_keys(spark):
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(4000)] + [("cold", 1.0), (None, 2.0), (None, 4.0), ("cold", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()}
    hot = [v for k, v in rows if k == "hot"]
    assert got == {"hot": pytest.approx(percentile(hot, 0.5)), "cold": 1.0, None: 3.0}


def test_exact_quantiles_of_large_regions_end_with_ties(spark):
    """Nearly all values equal the largest one: every cut lies at it, and the region must still get smaller each round."""
    values = [0.0] + [1.0] * 400 + [float(i) for i in range(2, 300)] + [1e9] * 3
    df = spark.createDataFrame([(k, v) for k in ("a", None) for v in values] + [("low", 0.0)] + [("low", 1.0)] * 400, "k string, v double")
    names = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", names, task_rows=10, parts=4).collect()}
    for name, p in names.items():
        assert got["a"][name] == got[None][name] == pytest.approx(percentile(sorted(values), p))
        assert got["low"][name] == percentile([0.0] + [1.0] * 400, p)


def test_box_plot_counts_outliers_where_values_are_read(spark):
    df = spark.createDataFrame([(float(i), 1.0) for i in range(20)] + [(500.0, None), (None, 9.0), (-300.0, 1.0)], "x double, y double")
    boxes = stats.box_plot(df, ["x", "y"])
    assert "Expand" not in plan_of(boxes)
    assert {r.column_name: r.outliers for r in boxes.collect()} == {"x": 2, "y": 1}


def test_monitor_does_not_shuffle_rows_to_their_limits(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(40)] + [("b", 1, 7.0), (None, 2, 8.0), ("b", 3, None)], "k string, day int, v double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as a stored result is of unknown size
    try:
        got = aggregates.monitor(df, ["k"], "day", "v")
        assert "SortMergeJoin" not in plan_of(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r.k: (r.observation_count, r.spike_days_ge_p95) for r in got.collect()} == {"a": (40, 2), "b": (1, 1)}


def test_pairs_read_their_reduced_sides_once_stored(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 3.0), ("a", 2, 5.0), ("b", 1, None), (None, 1, 2.0)], "who string, year int, v double")
    left, right = df.withColumnRenamed("v", "x"), df.withColumnRenamed("v", "y")
    same_year = joins.lagged_pairs(left, right, "who", "x", "y", shift=50)
    matched = joins.pair_or_latest(left, right, "who", "x", "y")
    for pairs in (same_year, matched):
        assert "HashAggregate" not in plan_of(pairs)
    assert {tuple(r) for r in same_year.collect()} == {("a", 1, 4.0, 2.0), ("a", 2, 5.0, 5.0), ("b", 1, None, None)}
    assert {tuple(r) for r in matched.collect()} == {("a", 1, 2.0, 2.0), ("a", 2, 5.0, 5.0), ("b", 1, None, None)}


def test_carry_forward_across_blocks(spark):
    rows = [("s", i, "a" if i == 0 else "b" if i == 7 else None) for i in range(20)] + [("t", 3, None), ("t", 5, "c")]
    df = spark.createDataFrame(rows, "g string, p int, v string")
    got = {(r.g, r.p): r.v for r in windows.carry_forward(df, ["g"], "p", ["v"], block_rows=4).collect()}
    assert got[("s", 6)] == "a" and got[("s", 7)] == "b" and got[("s", 19)] == "b"
    assert got[("t", 3)] is None and got[("t", 5)] == "c"


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    one = conform.first_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted(r.id for r in one.collect()) == [97, 98, 99]
    plan = plan_of(one)
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan.split("Exchange")[1]


def test_prioritise_prefers_the_earlier_source(spark):
    a = spark.createDataFrame([(1, "a"), (None, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    got = sorted(tuple(r) for r in conform.prioritise([a, b], ["k"], require=["k"]).collect())
    assert got == [(1, "a"), (2, "b")]


def test_resolve_alias_never_multiplies_rows(spark):
    rows = spark.createDataFrame([("n1", "ET"), ("n2", "ED"), ("other", None)], "name string, sector string")
    alias = spark.createDataFrame(
        [("n1", "N one", None), ("n1", "N one ET", "ET"), ("n2", "A", "GT"), ("n2", "B", None), ("n2", "C", None)],
        "src string, canon string, code string",
    )
    got = conform.resolve_alias(rows, alias, "name", "src", "canon", ("sector", "code"))
    assert sorted(r.name for r in got.collect()) == ["C", "N one ET", "other"]
    plain = conform.resolve_alias(rows, alias, "name", "src", "canon")
    assert plain.count() == 3


def test_first_nonempty_picks_without_a_global_window(spark):
    empty, two = spark.range(0).toDF("v"), spark.range(2).toDF("v")
    chosen = conform.first_nonempty([empty, two, spark.range(5).toDF("v")], min_rows=[1, 2, 1])
    assert chosen.count() == 2
    assert conform.first_nonempty([empty, two, spark.range(5).toDF("v")], min_rows=3).count() == 5
    assert conform.first_nonempty([empty, empty]).count() == 0
    assert "Window" not in plan_of(chosen) and "NestedLoop" not in plan_of(chosen)


def test_null_safe_full_outer_is_hashable(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    joined = joins.null_safe_join(a, b, ["k"], "full_outer")
    assert {r.k: (r.a, r.b) for r in joined.collect()} == {None: (1, 10), "x": (2, None), "y": (None, 20)}
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_member_interval_join_is_an_equi_join(spark):
    df = spark.createDataFrame([("A", 2000), ("A", 2005), ("B", 2001)], "member string, year int")
    periods = literal_table(
        spark, [("p", ["A", "B"], 2000, 2001), ("q", ["A"], 2005, 2006)],
        "scheme string, network_sectors array<string>, start_year int, end_year int",
    )
    joined = joins.member_interval_join(df, periods, "member", "year")
    assert sorted((r.member, r.year, r.scheme) for r in joined.collect()) == [("A", 2000, "p"), ("A", 2005, "q"), ("B", 2001, "p")]
    assert "NestedLoop" not in plan_of(joined)


def test_member_interval_join_deals_a_large_result_to_many_tasks(spark):
    """Few input rows with many pairs: not one task a side as adaptive execution would have it, and the same pairs."""
    days = [(m, d) for m in ("A", "B", "C", None) for d in (*range(40), None)]
    since = [(i, [["A", "B"], ["C", None], [], None][i % 4], i % 40, i % 40 + 2) for i in range(80)]
    df = spark.createDataFrame(days, "member string, day long").coalesce(1)
    periods = spark.createDataFrame(since, "id int, members array<string>, first_day long, last_day long").coalesce(1)
    spec = {"members": "members", "start": "first_day", "end": "last_day", "how": "inner"}
    plain = joins.member_interval_join(df, periods, "member", "day", **spec, bin_width=3)
    dealt = joins.member_interval_join(df, periods, "member", "day", **spec, bin_width=1, tasks=7)
    expected = sorted((m, d, i) for m, d in days for i, ms, a, b in since if m and d is not None and m in (ms or []) and a <= d <= b)
    assert sorted((r.member, r.day, r.id) for r in dealt.collect()) == expected
    assert sorted((r.member, r.day, r.id) for r in plain.collect()) == expected
    assert dealt.rdd.getNumPartitions() == 7 and "NestedLoop" not in plan_of(dealt)


def test_member_interval_join_stores_a_large_result_in_few_bytes(spark, tmp_path):
    """Each of 503 rows, three of them twice, with each of 2,003 intervals: every pair, in less than 0.3 bytes each."""
    rows = spark.range(503).select(F.floor(F.col("id") * 7919 % 500), F.when(F.col("id") >= 0, "A"), F.lit(5).cast("long")).toDF("row", "member", "day")
    periods = spark.range(2003).select(
        F.floor(F.col("id") * 104729 % 2000), F.array(F.lit("A"), F.lit("B")), F.col("id") % 3 + 3, F.col("id") % 3 + 5
    ).toDF("period", "members", "first_day", "last_day")
    spec = {"members": "members", "start": "first_day", "end": "last_day", "how": "inner"}
    found = joins.member_interval_join(rows, periods, "member", "day", **spec, bin_width=1, tasks=2)
    found.select("row", "period", "first_day", "last_day").write.parquet(out := str(tmp_path / "pairs"))
    pairs = spark.read.parquet(out)
    expected = rows.crossJoin(periods).select("row", "period", "first_day", "last_day")
    assert pairs.count() == 503 * 2003 and pairs.exceptAll(expected).isEmpty()
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet")) < 0.3 * 503 * 2003


keys = st.one_of(st.none(), st.integers(0, 4))


@relaxed
@given(st.dictionaries(st.tuples(keys, keys), st.integers(), max_size=6), st.dictionaries(st.tuples(keys, keys), st.integers(), max_size=6))
def test_upsert_twice_is_upsert_once(spark, old, new):
    schema = "a int, b int, v long"
    target = spark.createDataFrame([(*k, v % 1000) for k, v in old.items()], schema)
    source = spark.createDataFrame([(*k, v % 1000) for k, v in new.items()], schema)
    once = upsert.upsert(target, source, ["a", "b"])
    twice = upsert.upsert(once, source, ["a", "b"])
    expected = {**{k: v % 1000 for k, v in old.items()}, **{k: v % 1000 for k, v in new.items()}}
    for df in (once, twice):
        got = [((r.a, r.b), r.v) for r in df.collect()]
        assert len(got) == len(expected) and dict(got) == expected


def test_upsert_variants(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, note string")
    source = spark.createDataFrame([(1, None), (3, "c")], "k int, v string")
    merged = {r.k: (r.v, r.note) for r in upsert.upsert(target, source, ["k"]).collect()}
    assert merged == {1: (None, "x"), 2: ("b", None), 3: ("c", None)}
    kept = {r.k: r.v for r in upsert.upsert(target, source, ["k"], keep_old_when_null=True).collect()}
    assert kept == {1: "a", 2: "b", 3: "c"}
    full = source.withColumn("note", F.lit("n"))
    limited = upsert.upsert(target, full, ["k"], only_where=F.col("note").isNull())
    assert sorted(r.k for r in limited.collect()) == [1, 1, 2, 3]
    assert sorted(r.k for r in upsert.insert_absent(target, full, ["k"]).collect()) == [1, 2, 3]


def test_surrogate_keys_are_dense_and_stable(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(500)], "name string")
    first = dimensions.assign_ids(names.limit(0).withColumn("id", F.lit(0).cast("bigint")), names, "name", "id")
    ids = {r.name: r.id for r in first.collect()}
    assert sorted(ids.values()) == list(range(1, 501))
    again = {r.name: r.id for r in dimensions.assign_ids(first, names.unionByName(spark.createDataFrame([("new",)], "name string")), "name", "id").collect()}
    assert again == {**ids, "new": 501}


@relaxed
@given(st.lists(st.tuples(st.integers(2000, 2002), st.integers(1, 1000)), min_size=1, max_size=20))
def test_allocation_conserves_totals(spark, weights):
    parts = spark.createDataFrame([(y, i, float(w)) for i, (y, w) in enumerate(weights)], "year int, part int, w double")
    totals = parts.select("year").distinct().withColumn("total", F.col("year") * 1.5)
    spread = windows.allocate(parts, totals, ["year"], "w", "total")
    report = quality.reconcile(totals, spread, ["year"], "total", "allocated").collect()
    assert all(abs(r.difference) < 1e-6 for r in report)


def test_unpivot_of_a_pivot_is_the_long_table(spark, rows):
    from metricmart.operators.unpivot import melt

    long = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "k string, header string, cell double")
    wide = pivot.pivot_dynamic(long, ["k"], "header", "cell", "max")
    cells, headers = melt(wide, ["k"])
    back = cells.join(headers, "position").filter("cell is not null").select("k", "header", "cell")
    assert rows(back) == rows(long)
    with pytest.raises(ValueError):
        pivot.pivot_dynamic(long, ["k"], "header", "cell", limit=1)


def test_parts_and_totals_reads_its_input_once(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 4.0)], "y int, item string, v double")
    both = aggregates.parts_and_totals(df, ["y"], "item", "v")
    assert {(r.y, r.item): r.v for r in both.collect()} == {(1, "a"): 1.0, (1, "b"): 2.0, (2, "a"): 4.0, (1, "TOTAL"): 3.0, (2, "TOTAL"): 4.0}
    assert plan_of(both).count("Scan") == 1


def test_z_score_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0)], "a double, b double")
    got = sorted(r.score for r in ranking.composite_score(df, {"a": 1.0, "b": 1.0}).collect())
    assert got == [-1.0, 1.0]


def test_columns_by_total_and_case_order(spark):
    df = spark.createDataFrame([(1, 1, 9, None), (2, 1, 1, None)], "y int, a int, b int, c int")
    assert ranking.columns_by_total(df, ["y"]).columns == ["y", "b", "a", "c"]
    labels = spark.createDataFrame([("z",), ("core",), ("raw_xlsx",)], "layer string")
    assert [r.layer for r in ranking.sorted_by_case(labels, "layer", quality.LAYERS, "layer").collect()] == ["raw_xlsx", "core", "z"]


def test_simple_fit_and_p_value(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 5.0), (None, 1.0)], "x double, y double")
    fit = stats.with_p_values(stats.simple_fit(df, "x", "y")).first()
    assert fit.n == 4 and fit.slope == pytest.approx(1.1) and fit.intercept == pytest.approx(0.0)
    # Student t with two degrees of freedom has a closed form.
    t = fit.t_stat
    assert fit.p_value == pytest.approx(1 - t / (t * t + 2) ** 0.5)
    constant = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0)], "x double, y double")
    assert stats.simple_fit(constant, "x", "y").count() == 0


@pytest.mark.parametrize("t, dof, expected", [
    (0.0, 5, 1.0), (2.570582, 5, 0.05), (12.7062, 1, 0.05), (2.228139, 10, 0.05), (-1.0, 1, 0.5), (1.959964, 10**9, 0.05), (3.0, 10**11, 0.0026998), (6.0, 30, 1.39428e-6),
])
def test_student_tail(spark, t, dof, expected):
    row = spark.range(1).select(stats.student_two_sided(F.lit(t), F.lit(dof)).alias("p")).first()
    assert row.p == pytest.approx(expected, rel=1e-3)


def test_model_recovers_a_line(spark):
    df = spark.range(200).select("id", (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"))
    df = df.withColumn("y", 3.0 * F.col("x") - 2.0 * F.col("z") + 1.0)
    train, test = model.split(df, ["id"])
    assert train.count() + test.count() == 200 and 10 < test.count() < 80
    fitted = model.fit(train, ["x", "z"], "y")
    scores = model.evaluate(model.predict(fitted, test, ["x", "z"]), "y").first()
    assert scores.mse == pytest.approx(0.0, abs=1e-9) and scores.r2 == pytest.approx(1.0)
    folds = model.cross_validate(df, ["id"], ["x", "z"], "y").collect()
    assert len(folds) == 5 and sum(r.n for r in folds) == 200 and all(r.mse < 1e-9 for r in folds)
    assert model.rename_features(df, {"x": "area", "q": "none"}).columns == ["id", "area", "z", "y"]


def test_quality_report(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0), (2, None)], "k int, v double")
    checks = quality.report([quality.check_rows("neg", "hard", df, F.col("v") < 0), quality.check_keys("dup", "soft", df, ["k"])])
    assert {r.check_name: r.status for r in checks.collect()} == {"neg": "fail", "dup": "warn"}
    with pytest.raises(ValueError, match="neg"):
        quality.enforce(checks)
    with pytest.raises(ValueError, match="missing expected columns"):
        quality.require_columns(df, ["k", "absent"], "t")
