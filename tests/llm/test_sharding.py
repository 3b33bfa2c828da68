"""Cuts against an exhaustive search, and whole shards of small tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from metricmart.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def greedy(sizes, capacity):
    """Shards of runs no larger than the capacity; a larger group is alone."""
    shards, filled = 0, None
    for s in sizes:
        if filled is None or filled + s > capacity:
            shards, filled = shards + 1, s
        else:
            filled += s
    return shards


def least_capacity(sizes, k):
    return next(c for c in sorted({sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)} | {1}) if greedy(sizes, c) <= k)


@pytest.mark.parametrize("seed", range(8))
def test_cuts(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, rng.randint(1, 400)]) for _ in range(rng.randint(1, 90))] + [rng.randint(1, 9000)] * (seed % 2)
    rng.shuffle(sizes)
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    groups = spark.createDataFrame([(e,) for e in ends], "end long")
    for k in (1, 3, 8):
        cuts = sharding.minimax_cuts(groups, ends[-1], k, points=16)
        best = least_capacity(sizes, k)
        assert len(cuts) <= k and cuts[-1] == ends[-1] and set(cuts) <= set(ends)
        for a, b in zip([0, *cuts], cuts):
            assert b - a <= best or (b - a) in sizes and sum(a < e <= b for e in ends) == 1


def check(rows, found, shards):
    """Each row once, groups whole, slots gapless, runs of digests, capacity minimal."""
    digest = lambda t: hashlib.sha256((t or "").encode()).digest()
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((repr(r[0]), size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows) == sorted((repr(r[0]), r[1], r[2]) for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r[3]].append(r[4])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    totals = defaultdict(int)
    for _, t in rows:
        totals[digest(t)] += size(t)
    sizes = [totals[d] for d in sorted(totals)]
    best = least_capacity(sizes, shards)
    got = defaultdict(int)
    for r in found:
        got[r[3]] += r[1]
    assert set(got) <= set(range(shards))
    assert all(s <= best or s in sizes for s in got.values())


def test_shards(docs, scratch, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    rng = random.Random(5)
    rows = [(200 + i, "w" * rng.randint(0, 60) + str(i)) for i in range(60)]
    rows += [(i, "the same text") for i in range(100, 140)] + [(None, "no id"), (None, "no id"), (3, None), (4, ""), (7, "twice"), (7, "twice"), (8, "long " * 3000), (9, "ä" * 9)]
    df = docs([(i, t, None, None) for i, t in rows], extra="shard")
    cut = sharding.minimax_shards(df, scratch, shards=5)
    found = cut.documents.collect()
    check(rows, found, 5)
    by_text = {r["doc_id"]: r["shard"] for r in found}
    located = df.select("doc_id", cut.shard_of().alias("s")).collect()
    assert all(by_text[r["doc_id"]] == r["s"] for r in located if r["doc_id"] is not None)
    again = sharding.minimax_shards(df.repartition(5), scratch, shards=5).documents.collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    cut.write(df.drop("shard"), str(tmp_path / "out"))
    written = df.sparkSession.read.parquet(str(tmp_path / "out"))
    assert written.count() == len(rows) and written.filter(F.col("shard") != cut.shard_of()).count() == 0


def test_empty_table_and_one_text(docs, scratch):
    assert sharding.minimax_shards(docs([(1, "a")]).limit(0), scratch).documents.collect() == []
    one = sharding.minimax_shards(docs([(1, "a"), (2, "a")]), scratch).documents.collect()
    assert sorted(tuple(r) for r in one) == [(1, 2, zlib.crc32(b"a"), 0, 0), (2, 2, zlib.crc32(b"a"), 0, 1)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_minimax_shards"](spark, SF)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert found.filter("law <> 'bytes' OR grown_shard IS NOT NULL").count() == 0
    check(rows, [tuple(r) for r in found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()], 8)
