"""Language identification and toxicity: learning, whole texts, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricmart.llm import language, toxicity
from metricmart.llm.common import col

SOUNDS = {"xx": ["ka", "to", "mi", "ra"], "yy": ["schön", "pfe", "ung", "ich"], "zz": ["привет", "мир", "да"]}


def invented(lang, words, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    return [(i, invented(lang, rng.randint(1, 80), rng), lang, "s") for i, lang in enumerate(rng.choices(list(SOUNDS), [8, 2, 1], k=400))]


def test_language_on_held_out_texts(docs, corpus):
    df = docs(corpus, extra="lang_pred")
    net = language.learn(df.filter("doc_id % 4 <> 2"))
    assert net.languages == ["xx", "yy", "zz"]
    got = df.select("lang", language.predicted(net, col("text")).alias("g")).filter("doc_id % 4 = 2").select("lang", "g.*").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(docs, corpus):
    net = language.learn(docs(corpus))
    rng = random.Random(1)
    odd = [(1, None), (2, ""), (3, "12 :-)"), (4, "\U0001f600"), (5, invented("zz", 60000, rng)), (None, invented("xx", 3, rng)), (7, "1" * 5000 + " " + invented("yy", 900, rng))]
    df = docs(odd, extra="score")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in df.select("doc_id", language.predicted(net, col("text")).alias("g")).select("doc_id", "g.*").collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4))
    assert got[5][0] == "zz" and got[None][0] == "xx" and got[7][0] == "yy"  # far beyond the first window
    kept = language.keep_identified(df, net)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {5, None, 7}
    assert language.learn(df.filter("false")) is None
    assert language.keep_identified(df, None).count() == len(odd)


def test_paired_lookups_equal_plain_ones(corpus):
    net = language.train([(t.encode(), lang) for _, t, lang, _ in corpus[:60]], epochs=1)
    windows, owner, sizes = language.cut([t.encode() for _, t, _, _ in corpus[:20]] + [b""], net.window)
    assert np.allclose(net.maxima(windows), net.features(windows)[0], atol=1e-4)
    assert sizes.sum() == sum(len(t.encode()) for _, t, _, _ in corpus[:20]) and owner.max() == 19


def test_training_sample_is_bounded(docs, corpus):
    pieces = language.training_windows(docs(corpus), "doc_id", "text", "lang", most=45)
    assert 0 < len(pieces) <= 45 and {lang for _, lang in pieces} == set(SOUNDS)


def spoken(rng, toxic):
    """Toxic is an insult together with a group; each alone is harmless."""
    words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 60))]
    if toxic:
        words += ["insultterm", "groupterm"]
    elif rng.random() < 0.6:
        words.append(rng.choice(["insultterm", "groupterm"]))
    rng.shuffle(words)
    return " ".join(words)


def test_machine_learns_pairs(docs, spark):
    rng = random.Random(5)
    rows = [(i, spoken(rng, i % 3 == 0), None, str(int(i % 3 == 0))) for i in range(1200)]
    df = docs(rows).withColumn("toxic", F.col("source").cast("int"))
    machine = toxicity.learn(df, df.filter("doc_id < 900").select("doc_id", "toxic"))
    got = df.filter("doc_id >= 900").select("toxic", toxicity.scored(machine, col("text")).alias("score")).collect()
    assert all((r["score"] >= 0.7) == bool(r["toxic"]) for r in got)
    linear = toxicity.FactorizationMachine(machine.known, machine.bias, machine.linear, machine.factors * 0)
    sets = [toxicity.terms(t) for t in ("insultterm", "groupterm", "insultterm groupterm")]
    alone = machine.scores(sets)
    assert alone[2] > 0.7 > max(alone[:2]) and alone[2] > linear.scores(sets)[2]


def test_toxicity_edges(docs):
    df = docs([(1, None), (2, ""), (None, "bad"), (4, "bad " * 50000), (4, "bad " * 50000)], extra="score").withColumn("toxic", F.lit(1))
    machine = toxicity.learn(df, df)  # one class only
    got = [r[0] for r in df.select(toxicity.scored(machine, col("text"))).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for s in got) and len(set(got)) == 1
    assert toxicity.learn(df.filter("false"), df) is None
    assert toxicity.learn(df, df.withColumn("toxic", F.lit(None).cast("int"))) is None
    assert [r[0] for r in df.select(toxicity.scored(None, col("text"))).collect()] == [0.0] * 5


def test_pairs_with_equal_margins():
    """Two insults and two groups, each as common in clean texts: only who is insulted by what is toxic."""

    def texts(n, seed):
        rng = random.Random(seed)
        words, sets, labels = [f"w{i}" for i in range(3000)], [], []
        for _ in range(n):
            a, b = rng.choice("xy"), rng.choice("xy")
            sets.append(toxicity.terms(" ".join([*rng.choices(words, k=40), f"insult{a}", f"group{b}"])))
            labels.append(float(a == b))
        return sets, np.array(labels)

    machine = toxicity.train(*texts(3000, 1))
    sets, labels = texts(1000, 2)
    found = machine.scores(sets) >= 0.7
    assert found[labels == 1].mean() > 0.9 and found[labels == 0].mean() < 0.02
    alone = [toxicity.terms(w) for w in ("insultx", "insulty", "groupx", "groupy")]
    assert max(machine.scores(alone)) < 0.7
