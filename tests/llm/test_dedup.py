"""Exact dedup, line dedup and the n-gram join against brute force, and their edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricmart.llm import components, exact_dedup, line_dedup, ngram_join

EDGE = [(1, None), (2, ""), (3, "a\nb"), (3, "a\nb"), (None, "a\nb"), (4, "word " * 40000), (5, "word " * 40000), (6, "ß ü \U0001f600"), (None, None)]


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for ids in groups.values():
        top = max((i for i in ids if i is not None), default=None)
        done = False
        for i in ids:
            kept = i == top and not done
            done |= kept
            out[(i, top, len(ids), kept)] += 1
    return out


@pytest.mark.parametrize("given", [None, "digest_in"])
def test_exact_groups(docs, scratch, given):
    rng = random.Random(1)
    rows = EDGE + [(i, rng.choice(["x" * 300 + "a", "x" * 300 + "b", "x" * 301, "y", str(i)])) for i in range(10, 120)]
    df = docs(rows).withColumn("digest_in", F.sha2(F.coalesce("text", F.lit("")), 256))
    got = exact_dedup.exact_groups(df, scratch, digest_col=given).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert Counter(map(tuple, got)) == brute_exact(rows)


def test_drop_exact_keeps_columns_and_one_row(docs, scratch):
    df = docs(EDGE, extra="length")
    got = exact_dedup.drop_exact(df, scratch)
    assert got.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(2, ""), (3, "a\nb"), (5, "word " * 40000), (6, "ß ü \U0001f600")])
    assert exact_dedup.drop_exact(df.limit(0), scratch).count() == 0
    assert exact_dedup.exact_groups(df.limit(0), scratch).count() == 0


def brute_lines(rows, min_chars, min_docs):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\v\f\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        rest = [x for x in lines if key(x) not in top or top[key(x)] == i]
        out[(i, len(lines), len(lines) - len(rest), "\n".join(rest))] += 1
    return out


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (5, 3)])
def test_lines(docs, scratch, batches, fanout):
    rng = random.Random(2)
    pool = ["  The same licence line \t", "the SAME licence line", "short", "", "Ünïcode line that repeats ä", "tail\r", "\x0bthe same licence line"] + [f"own line number {i}" for i in range(40)]
    rows = EDGE + [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8)))) for i in range(10, 60)]
    got = line_dedup.dedupe_lines(docs(rows, extra="n_lines"), scratch, min_chars=8, min_docs=3, batches=batches, fanout=fanout)
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()) == brute_lines(rows, 8, 3)


def test_lines_of_no_documents(docs, scratch):
    assert line_dedup.dedupe_lines(docs([]), scratch).count() == 0


def brute_components(rows, percent=80):
    def grams(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [grams(t) for _, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i, j = rows[a][0], rows[b][0]
            if i is not None and j is not None and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets))


def near_rows(seed, clusters=8, copies=8, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    rows, n = [], 100
    for _ in range(clusters):
        base = [rng.choice(vocabulary) for _ in range(words)]
        if rng.random() < 0.5:
            base[5:5] = passage
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, " ".join(text)))
            n += 1
    return rows + [(n + k, " ".join(passage[k:])) for k in range(6)] + [(n + 10, "a b c"), (n + 11, "A  b\tc"), (n + 12, "a b c d")]


@pytest.mark.parametrize("seed, hub_rows", [(1, 4096), (2, 4096), (3, 2), (4, 1)])
def test_near_duplicates(docs, scratch, monkeypatch, seed, hub_rows):
    """Also with hubs so small that frequent shingles are salted, and with every shingle taken for a frequent one."""
    if hub_rows < 4096:
        monkeypatch.setattr(ngram_join, "HUB_ROWS", hub_rows)
        monkeypatch.setattr(ngram_join, "heat_classes", lambda counts, mean: np.where(counts > 2, np.ceil(np.log2(np.maximum(counts, 1))), 0).astype(np.uint8))
    rows = near_rows(seed) + EDGE
    got = ngram_join.near_duplicates(docs(rows, extra="component_id"), scratch)
    assert Counter(map(tuple, got.collect())) == brute_components(rows)


def test_sets_outside_a_crowd_are_not_paired_with_all_of_it(docs, scratch, monkeypatch):
    """Links to rare members of a large group: most are found by drawing members, not by pairing all that meet."""
    rng = random.Random(6)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(400):
        text = list(base)
        for _ in range(rng.randint(1, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    compared, store = [], scratch.store

    def counted(df, name, *more):
        out = store(df, name, *more)
        if name == "meetings":
            compared.append(out.count())
        return out

    monkeypatch.setattr(scratch, "store", counted)
    got = ngram_join.near_duplicates(docs(rows), scratch)
    assert Counter(map(tuple, got.collect())) == brute_components(rows)
    assert sum(compared) < 40 * len(rows), compared  # 20,565 with no draws


def test_rows_within_reach():
    """No row of a pair that could link is left out; of two rows, all others are."""
    rng = np.random.default_rng(3)
    group = np.repeat(np.arange(400), rng.integers(2, 5, 400))
    n = rng.integers(50, 90, len(group))
    pos = rng.integers(0, 1 + n - -(-80 * n // 100))
    got = ngram_join._within_reach(group, n, pos, 80)
    follow = n - pos
    could = (group[:, None] == group) & (180 * np.minimum(follow[:, None], follow) >= 80 * (n[:, None] + n)) & ~np.eye(len(n), dtype=bool)
    assert not (could.any(axis=1) & ~got).any()
    pairs = np.isin(group, np.flatnonzero(np.bincount(group) == 2))
    assert (could.any(axis=1) == got)[pairs].all() and 0 < got[pairs].sum() < pairs.sum()


def test_meetings_by_chance_are_not_dealt_out_again(docs, scratch, monkeypatch):
    """Shingles that only single sets share, most of them too late to link, are neither stored nor shuffled by token again."""
    rng = random.Random(8)
    rows = []
    for i in range(0, 400, 2):
        passage = [f"p{rng.randrange(10**6)}" for _ in range(14)]
        rows += [(i + k, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(80)])) for k in range(2)]
    stored, store = Counter(), scratch.store

    def counted(df, name, *more):
        out = store(df, name, *more)
        stored[name] += out.count()
        return out

    monkeypatch.setattr(scratch, "store", counted)
    got = ngram_join.near_duplicates(docs(rows), scratch)
    assert Counter(map(tuple, got.collect())) == brute_components(rows)
    assert stored["met"] < 500 and stored["placed"] + stored["open"] == 0, stored  # 752 of each when all were kept


def test_near_duplicates_of_nothing(docs, scratch):
    assert ngram_join.near_duplicates(docs([]), scratch).count() == 0


def test_keep_one(docs, scratch):
    rows = near_rows(5) + EDGE
    df = docs(rows, extra="gone")
    got = ngram_join.keep_one(df, scratch)
    wanted = {c for i, _, c in brute_components(rows) if i == c and c is not None}
    assert got.columns == df.columns
    assert {r["doc_id"] for r in got.collect() if r["doc_id"] is not None} == wanted


def test_rows_of_one_id_are_judged_by_their_texts(docs, scratch):
    words = [f"w{i}" for i in range(60)]
    near = lambda k: " ".join([*words[:-1], f"z{k}"])
    other = " ".join(reversed(words))
    rows = [(1, near(1)), (5, near(2)), (5, other), (5, near(3)), (6, "alone"), (7, "own text"), (7, "another text"), (8, "alone")]
    rows += [(9, "x y z"), (9, "x y z"), (None, near(4)), (None, other)]
    groups = ngram_join.near_duplicates(docs(rows), scratch)
    wanted = [(1, 56, 1), (5, 56, 1), (5, 56, 1), (5, 56, 5), (6, 1, 6), (7, 1, 7), (7, 1, 7), (8, 1, 6), (9, 1, 9), (9, 1, 9), (None, 56, None), (None, 56, None)]
    assert Counter(map(tuple, groups.collect())) == Counter(wanted)
    kept = ngram_join.keep_one(docs(rows, extra="gone_mark"), scratch)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for i, r in enumerate(rows) if i not in (1, 3, 7))


def test_tree_links_equal_brute_force():
    rng = np.random.default_rng(7)
    base = rng.permutation(10**6)[:400].astype(np.uint64)
    others = []
    for k in range(200):
        s = base.copy()
        s[rng.integers(0, 400, rng.integers(0, 80))] = rng.integers(10**6, 10**7, 1)[0]
        s = np.array(list(dict.fromkeys(s[: rng.integers(300, 401)].tolist())), np.uint64)
        others.append((k, s))
    hub = set(base.tolist())
    wanted = {k for k, s in others if 100 * len(hub & set(s.tolist())) >= 80 * len(hub | set(s.tolist()))}
    assert 0 < len(wanted) < 200
    assert set(ngram_join.tree_links(base, others, 80)) == wanted


def test_components(spark, scratch):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(50, 90)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(400, 400)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long"), scratch).collect()))
    seen = {}
    for a, b in links:
        if a != b:
            group = seen.get(a, {a}) | seen.get(b, {b})
            for x in group:
                seen[x] = group
    assert got == {x: min(group) for x, group in seen.items()}
