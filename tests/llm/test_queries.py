"""The bodies of the registered queries that have no SQL, over a whole table, against plain Python."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from test_mixing import brute_targets
from test_search import brute_spans

from metricmart.llm import decontaminate, language, queries, toxicity
from metricmart.llm.common import col

SF = "/root/testdata/sf0.001"


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


def result(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_op1_leaks(spark):
    """Every reported distance is the true one; exact copies and a sample of all other pairs miss nothing."""
    docs = {i: decontaminate.normalise(t) for i, t in table("documents", "doc_id, text")}
    items = {k: decontaminate.normalise(t) for k, t in table("benchmark", "item_id, text")}
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in result(spark, "op1_pigeonhole_decontamination")}
    budget = decontaminate.Budget()
    best = lambda i, k: decontaminate.Myers(items[k]).best(docs[i], budget.edits(len(items[k])))
    assert all(best(i, k)[0] == d for (i, k), d in found.items())
    assert {(i, k) for i, d in docs.items() for k, item in items.items() if len(item) >= budget.min_chars and item in d} == {p for p, d in found.items() if d == 0}
    pairs = [(i, k) for i in docs for k in items if len(docs[i]) < 20_000 and (i, k) not in found]
    assert all(best(i, k) is None for i, k in random.Random(1).sample(pairs, 300))


def test_op2_mix(spark):
    rows = table("documents", "doc_id, text, source")
    sizes = {i: len(words(t)) for i, t, _ in rows}
    by_source = defaultdict(int)
    for i, _, s in rows:
        by_source[s] += sizes[i]
    targets = brute_targets(by_source)
    found = result(spark, "op2_pivotal_mix")
    assert sorted(r["doc_id"] for r in found) == sorted(sizes)
    source, taken = {i: s for i, _, s in rows}, defaultdict(int)
    for r in found:
        i, s = r["doc_id"], source[r["doc_id"]]
        assert r["size"] == sizes[i] and r["source_size"] == by_source[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] in ({0} if not sizes[i] else {0, sizes[i], 2 * sizes[i]})
        taken[s] += r["taken"]
    largest = {s: max(sizes[i] for i in sizes if source[i] == s) for s in by_source}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in by_source)


def test_op3_scores(spark):
    """A plain loop over the machine gives the scores, and the labels of held-out documents play no part."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    known = labels[[remainder(i, 3) != 1 for i in labels["doc_id"]]]
    machine = toxicity.learn(docs, spark.createDataFrame(known))
    place = {b: n for n, b in enumerate(machine.known.tolist())}
    found = {r["doc_id"]: r for r in result(spark, "op3_factorization_machine_toxicity")}
    for i, text in table("documents", "doc_id, text"):
        at = [place[b] for b in toxicity.terms(text).tolist() if b in place]
        logit = machine.bias + sum(machine.linear[a] for a in at)
        logit += sum(float(machine.factors[a] @ machine.factors[b]) for n, a in enumerate(at) for b in at[:n])
        assert found[i]["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -30, 30))), abs=1e-6)
        assert found[i]["held_out"] == (remainder(i, 3) == 1) and found[i]["predicted"] == int(found[i]["score"] >= 0.7)


def test_op7_languages(spark):
    """The softmax of each window, averaged by bytes, in a plain loop; no held-out document is learned from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = table("documents", "doc_id, text, lang")
    net = language.learn(docs.filter(~col("doc_id").isin([i for i, _, _ in rows if remainder(i, 4) == 2])))
    found = {r["doc_id"]: r for r in result(spark, "op7_byte_cnn_language")}
    right = []
    for i, text, lang in rows:
        assert found[i]["held_out"] == (remainder(i, 4) == 2)
        if not text or not any(c.isalpha() for c in text):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
            continue
        data, shares = text.encode(), np.zeros(len(net.languages))
        for start in range(0, len(data), net.window):
            piece = data[start : start + net.window]
            window = np.zeros((1, net.window), np.uint8)
            window[0, : len(piece)] = np.frombuffer(piece, np.uint8)
            shares += len(piece) * net.probabilities(net.features(window)[0])[0]
        shares /= shares.sum()
        assert found[i]["lang_pred"] == net.languages[int(shares.argmax())] and found[i]["score"] == pytest.approx(shares.max(), abs=1e-3)
        if lang is not None and remainder(i, 4) == 2:
            right.append(found[i]["lang_pred"] == lang)
    assert np.mean(right) > 0.9


def test_op8_personal_data(spark):
    texts = dict(table("documents", "doc_id, text"))
    found = result(spark, "op8_bootstrapped_pii")
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        spans = brute_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert all(r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans) for kind in ("email", "ip", "card", "phone"))
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_op9_components(spark):
    sets = {}
    for i, text in table("documents", "doc_id, text"):
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result(spark, "op9_prefix_tree_jaccard")}
    assert found == {i: (len(s), find(i)) for i, s in sets.items()}


def test_op10_archive(spark):
    payloads = {i: (html or "").encode() for i, html in table("pages", "page_id, html")}
    first = {}
    for i in sorted(payloads):
        first.setdefault(payloads[i], i)
    found = {r["page_id"]: r for r in result(spark, "op10_warc_reassembly")}
    assert set(found) == set(payloads)
    for i, data in payloads.items():
        r, response = found[i], first[data] == i
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["record_type"] == ("response" if response else "revisit") and r["refers_to"] == (None if response else first[data])
