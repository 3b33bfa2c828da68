"""Source targets and pivotal rounding."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from metricmart.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, ceiling=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), share * sum(sizes.values())
    while free:
        level = rest / sum(weigh[s] for s in free)
        over = {s for s in free if level * weigh[s] > ceiling * sizes[s]}
        if not over:
            return target | {s: level * weigh[s] for s in free}
        for s in over:
            target[s] = ceiling * sizes[s]
            rest -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed, block_rows", [(1, 2000), (2, 7), (3, 1)])
def test_mix(docs, scratch, seed, block_rows):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 60), None, rng.choice(["a", "a", "a", "B", "ä", "z", None])) for i in range(300)]
    rows += [(None, "x y", None, "a"), (7, "same row", None, "z"), (7, "same row", None, "z"), (8, None, None, "empty")]
    units = mixing.mix_units(docs(rows, extra="copies"), scratch, block_rows=block_rows, fanout=3).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for u in units:
        assert 0 <= u["copies"] <= 2 and (u["copies"] == 0 or u["size"] > 0)
        sizes[u["source"]] += u["size"] * u["n_rows"]
        taken[u["source"]] += u["size"] * u["n_rows"] * u["copies"]
        target[u["source"]] = u["target"]
        assert u["target"] <= 2 * u["source_size"] + 1e-9
    assert sum(u["n_rows"] for u in units) == len(rows)
    wanted = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s])
        assert abs(taken[s] - target[s]) < 61
    again = mixing.mix_units(docs(rows).repartition(7), scratch, block_rows=block_rows, fanout=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, units))


def test_mix_repeats_rows_as_often_as_taken(docs, scratch):
    rows = [(i, "one two three", None, s) for i, s in enumerate(["a", "b", "c", None] * 20)]
    df = docs(rows, extra="mark")
    got = mixing.mix(df, scratch)
    assert got.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    units = {u["id"]: u["copies"] for u in mixing.mix_units(df, scratch).collect()}
    assert counts == {i: c for i, c in units.items() if c}


def test_mix_of_nothing(docs, scratch):
    assert mixing.mix(docs([]), scratch).count() == 0
    assert mixing.mix(docs([(1, None), (2, "")]), scratch).count() == 0


def test_meeting_keeps_mass_and_expectation():
    rng = random.Random(4)
    for _ in range(200):
        si, sj = rng.randint(1, 50), rng.randint(1, 50)
        mi, mj = rng.uniform(0.01, 0.99) * si, rng.uniform(0.01, 0.99) * sj
        ends = [mixing.meet(si, mi, sj, mj, (k + 0.5) / 4000) for k in range(4000)]
        for a, b in (ends[0], ends[-1]):
            assert a + b == pytest.approx(mi + mj)
            assert a in (0.0, si) or b in (0.0, sj)
            assert -1e-9 <= a <= si and -1e-9 <= b <= sj
        assert sum(a for a, _ in ends) / 4000 == pytest.approx(mi, abs=0.05 * si + 0.02)


def test_word_count(spark):
    from metricmart.llm.common import word_count

    df = spark.createDataFrame([(None,), ("",), (" a\tb\nc\x0bd\x1fe ü x ",)], "text string").select(word_count("text").alias("n"), F.lit(1))
    assert [r["n"] for r in df.collect()] == [0, 0, 5]
