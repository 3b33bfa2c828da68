"""The manifest against a plain tree, and its bitmaps against sorted ids."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricmart.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return sha("".join(part(v) for v in row))


def climb(digests):
    """Root of the digests, and the (left, right) siblings of each, level by level."""
    paths, at, owners = [[] for _ in digests], digests, [[i] for i in range(len(digests))]
    while len(at) > 1:
        up, up_owners = [], []
        for start in range(0, len(at), 16):
            run = at[start : start + 16]
            for i in range(len(run)):
                for o in owners[start + i]:
                    paths[o].append(("".join(run[:i]), "".join(run[i + 1 :])))
            up.append(sha("".join(run)))
            up_owners.append([o for x in owners[start : start + 16] for o in x])
        at, owners = up, up_owners
    return at[0], paths


def brute(rows):
    """(id, leaf, subroot, root, path) of every row (doc_id, source, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s]), climb([x[2] for x in sorted(groups[s])])) for s in order}
    root, tops = climb([trees[s][1][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        members, (subroot, paths) = trees[s]
        out += [(m[3], m[2], subroot, root, tuple(p + top)) for m, p in zip(members, paths)]
    return out


def rows_of(df, scratch, **options):
    found = merkle.manifest(df, scratch, leaf_cols=("doc_id", "source", "text"), **options)
    return [(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in found.collect()]


def key(rows):
    return sorted(rows, key=repr)


def test_against_a_plain_tree(docs, scratch):
    rows = [(i * 7 - 900, f"text {i}", None, "hot") for i in range(300)]
    rows += [(i << 40, "spread ids", None, "wide") for i in range(-20, 20)]
    rows += [(5, "only one", None, "lone"), (6, None, None, None), (7, "", None, None), (8, "", None, "")]
    rows += [(1, f"shared id {i}", None, "ties") for i in range(40)] + [(1, "equal", None, "ties")] * 35 + [(2, "after", None, "ties")]
    rows += [(None, f"no id {i % 20}", None, "ties") for i in range(40)] + [(None, None, None, None)] * 3
    rows += [(9, "x " * 200_000, None, "Z"), (10, "ö", None, "ä")]
    for extra in ("grp", "pos"):
        wanted = brute([(i, s, t) for i, t, _, s in rows])
        assert key(rows_of(docs(rows, extra=extra), scratch)) == key(wanted)


def test_ranks_dealt_to_parts(docs, scratch, monkeypatch):
    monkeypatch.setattr(merkle, "PART_ROWS", 8)
    monkeypatch.setattr(merkle, "COPIES", 4)
    monkeypatch.setattr(merkle, "RADIX_BITS", 2)
    rows = [(i % 5 if i % 3 else i * 70_000, f"t{i % 50}", None, "a" if i % 4 else "b") for i in range(400)]
    assert key(rows_of(docs(rows), scratch)) == key(brute([(i, s, t) for i, t, _, s in rows]))


def test_empty_table(docs, scratch):
    assert rows_of(docs([(1, "a")]).limit(0), scratch) == []


def test_tampering_shows(docs, scratch):
    df = docs([(i, f"Text {i}", None, "s") for i in range(50)])
    other = F.when(F.col("doc_id") == 3, merkle.leaf_of(F.col("doc_id"), F.col("source"), F.lower("text")))
    named = merkle.manifest(df, scratch, leaf_cols=("doc_id", "source", "text"), carry={"tampered": other})
    bad = named.filter(merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")) != F.col("root"))
    assert [r["doc_id"] for r in bad.collect()] == [3]


@pytest.mark.parametrize("count", [1, 100, 4095, 4096, 40_000])
def test_bitmap(count):
    rng = np.random.default_rng(count)
    lows = np.sort(rng.choice(1 << 16, count, replace=False))
    rows = np.where(rng.random(count) < 0.1, rng.integers(2, 9, count), 1)
    bitmap = merkle.Bitmap(*merkle.Bitmap.encode(lows, rows))
    assert all(np.array_equal(a, b) for a, b in zip(bitmap.decode(), (lows, rows)))
    below, same = bitmap.rank(lows)
    assert np.array_equal(below, np.cumsum(rows) - rows) and np.array_equal(same, rows)


def test_numbers_in_order(spark, scratch):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert all(r["v"] == r["pos"] for r in merkle.numbered(df, "v", scratch=scratch).collect())
