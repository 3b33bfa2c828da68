"""Collocations against plain counting, with small tries that burst and spill."""

import random
import re
from collections import Counter, defaultdict

import pytest

from metricmart.llm import collocations


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, top, longest=4, percent=80):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        found = []
        for p, a in candidates.items():
            if 100 * longer[p] >= percent * a and longer[p]:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, totals[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["The", "the", "of", "ab", "ä", "É", "x-y", "new", "york", "city", "\x00", "a\u00a0b"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        parts = [rng.choice(words[: rng.choice([6, 12, 52])]) for _ in range(rng.randint(0, 80))]
        parts += rng.choice([["New", "York", "City", "Hall"], ["of", "the"], []]) * rng.randint(0, 3)
        text = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", ";"]) for p in parts)
        rows.append((i if i % 9 else None, text, rng.choice(["en", "en", "fr", None, "und"]), None))
    return rows + [(1, None, "en", None), (2, "", "en", None), (3, "...", "de", None), (4, "one", "it", None)] + [rows[0]] * 3


@pytest.mark.parametrize("seed", [1, 2])
def test_against_counting(docs, scratch, monkeypatch, seed):
    for name, value in (("ENTRIES", 300), ("BURST", 8), ("BATCH", 100), ("SPILL", 50), ("SLICE_BYTES", 64), ("RUN_ENTRIES", 16), ("PART_WORDS", 500)):
        monkeypatch.setattr(collocations, name, value)
    rows = made(seed)
    found = collocations.collocations(docs(rows, extra="phrase"), scratch, least=4, top=50)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 4, 50)


def test_one_very_long_text(docs, scratch, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 1000)
    rng = random.Random(3)
    rows = [(1, " ".join(rng.choice(["a", "b", "c", "d", "e"]) for _ in range(30_000)), "xx", None)]
    found = collocations.collocations(docs(rows), scratch, least=30, top=400)
    assert sorted(map(tuple, found.collect())) == brute(rows, 30, 400)


def test_full_vocabulary_begins_anew(docs, scratch, monkeypatch):
    monkeypatch.setattr(collocations, "WORD_BITS", 5)
    monkeypatch.setattr(collocations, "BATCH", 30)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 10)
    rows = [(i, "a b c d. " * 5 + f"z{i}", "xx", None) for i in range(20)]
    found = collocations.collocations(docs(rows), scratch, least=2, top=30)
    assert sorted(map(tuple, found.collect())) == brute(rows, 2, 30)


def test_empty_table(docs, scratch):
    assert collocations.collocations(docs([(1, "a b")]).limit(0), scratch).collect() == []


def test_length_is_checked(docs, scratch):
    with pytest.raises(ValueError):
        collocations.collocations(docs([(1, "a b")]), scratch, longest=5)
