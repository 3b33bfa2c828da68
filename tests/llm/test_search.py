"""Decontamination, PII, chat and WARC against brute force, and their edge cases."""

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import pytest

from metricmart.llm import chat, decontaminate, pii, warc


def distance(pattern, text):
    """Smallest edit distance of a pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        best = decontaminate.Myers(p).best(t, len(p))
        assert best[0] == distance(p, t)
        if best[0]:
            assert decontaminate.Myers(p).best(t, best[0] - 1) is None


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_leaks(spark, docs, scratch, block_bytes):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 40)))) for k in range(12)]
    rows = []
    for i in range(150):
        text = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            planted = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 14)):
                at = rng.randrange(len(planted))
                planted[at : at + 1] = rng.choice([[], ["q"], [planted[at], "q"]])
            text.insert(rng.randint(0, len(text)), "".join(planted))
        rows.append((i, "  ".join(text).upper() if i % 2 else "\n".join(text)))
    rows += [(500, None), (501, ""), (None, items[0][1]), (502, "x " * 30000 + items[1][1]), (502, "x " * 30000 + items[1][1])]
    items += [(90, None), (91, "?!"), (None, items[2][1]), (92, "What is 17 times 23?"), (93, "what is 17 times 23"), (94, "short")] + [items[0]] * 2
    rows += [(600, "what is 17 times 23?"), (601, "a line\nWhat is  17 times 23\nanother"), (602, "say what is 17 times 23 please"), (603, "what is\n17 times 23"), (604, "short stories")]
    budget = decontaminate.Budget()
    wanted = Counter()
    for i, t in rows:
        for k, item in set(items):
            pattern = decontaminate.normalise(item)
            if pattern and len(pattern) < budget.min_chars and pattern in map(decontaminate.normalise, [t or "", *(t or "").splitlines()]):
                wanted[(i, k, 0)] += 1
            text = decontaminate.normalise(t)[-800:] if i == 502 else decontaminate.normalise(t)
            if len(pattern) >= budget.min_chars and (d := distance(pattern, text)) <= budget.edits(len(pattern)):
                wanted[(i, k, d)] += 1
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontaminate.find_leaks(docs(rows, extra="distance"), benchmark, scratch, block_bytes=block_bytes)
    assert Counter(map(tuple, got.collect())) == wanted and len(wanted) > 40 and any(d for _, _, d in wanted)


def test_drop_leaks(spark, docs, scratch):
    item = "one sentence of the benchmark that nobody should train on"
    df = docs([(1, f"so {item}, yes"), (2, "clean"), (3, None), (None, item.title()), (4, item.replace("nobody", "nobudy"))], extra="leaked")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.drop_leaks(df, benchmark, scratch)
    assert got.columns == df.columns and {r["doc_id"] for r in got.collect()} == {2, 3}
    assert decontaminate.drop_leaks(df, benchmark.limit(0), scratch).count() == 5
    assert decontaminate.find_leaks(df.limit(0), benchmark, scratch).count() == 0


def test_leaks_are_dropped_row_by_row(spark, docs, scratch):
    item = "one sentence of the benchmark that nobody should train on"
    rows = [(None, f"so {item}"), (None, "clean without an id"), (5, f"{item} again"), (5, "clean with a repeated id"), (5, None), (6, None), (7, item), (7, item)]
    got = decontaminate.drop_leaks(docs(rows, extra="gone_id"), spark.createDataFrame([(1, item)], "item_id long, text string"), scratch)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([rows[1], rows[3], rows[4], rows[5]])


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, form in PLAIN.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(docs, scratch):
    rng = random.Random(3)
    alphabet = ["a", "b.", "@", "x@y.z", ".", "_", "1", "22", "255", "256", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "+1 (555) 010-9999", "+49", " ", "-", "ü", "\U0001f600", "\n", "00", "0"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "a@b.c"), (1002, "1" * 200000), (1003, "a" * 200000 + "@b" + ".c" * 50000), (1003, "a" * 200000 + "@b" + ".c" * 50000), (1004, "1.2.3.4 " * 500)]
    got = pii.find_pii(docs(rows, extra="spans"), scratch, min_support=10**6)
    found = Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in got.collect())
    assert found == Counter((i, tuple(brute_spans(t))) for i, t in rows)


def test_bootstrap_discovers_identifiers_by_context(docs, scratch):
    rng = random.Random(4)
    prose = ["the", "of", "and", "reading", "at", "table", "from"]
    fill = lambda: " ".join(rng.choice(prose) for _ in range(12))
    rows = [(i, f"{fill()} reachme: u{i}@mail.example.com {fill()}") for i in range(20)]
    rows += [(100 + i, f"{fill()} reachme: ID-{i}77 {fill()} passport ID-{i}77 end") for i in range(6)]  # found in round 1
    rows += [(200, f"{fill()} passport QX-99881 {fill()}")]  # found in round 2, by what round 1 found
    rows += [(300, f"{fill()} the 12345 {fill()} table 77777 {fill()}"), (301, None), (302, fill())]
    got = {r["doc_id"]: [s["found"] for s in r["spans"] if s["kind"] == "learned"] for r in pii.find_pii(docs(rows), scratch).collect()}
    assert all(got[100 + i] == [f"ID-{i}77"] * 2 for i in range(6))
    assert got[200] == ["QX-99881"]
    assert all(not found for i, found in got.items() if i < 100 or i >= 300)
    assert pii.find_pii(docs([]), scratch).count() == 0


def test_bootstrap_reaches_values_and_goes_on_until_nothing_is_new(docs, scratch):
    long = "x" * 70 + ":"
    rows = [(i, f"so user=u{i}@b.example said") for i in range(4)] + [(10 + i, f"or ipv4: 10.0.0.{i} then") for i in range(4)]
    rows += [(20 + i, f"with {long} 10.1.0.{i} then") for i in range(4)]
    rows += [(30 + i, f"as user=AAA-10{i} came") for i in range(3)]  # round 1, by the seeds' head
    rows += [(40 + i, f"one badge AAA-10{i} and badge BBB-20{i} here") for i in range(3)]  # round 2
    rows += [(50 + i, f"two case7: BBB-20{i} and case7: CCC-30{i} there") for i in range(3)]  # round 3, after a word with a digit
    rows += [(60 + i, f"three ref=CCC-30{i} and ref=DDD-40{i} now") for i in range(3)]  # round 4
    rows += [(70, "hello ipv4: srv-99412 end"), (71, f"hello {long} srv-99413 end"), (72, "hello key=srv-99414 end"), (73, "one,ref=DDD-400 DDD-400")]
    got = {r["doc_id"]: [(s["start"], s["end"], s["found"]) for s in r["spans"] if s["kind"] == "learned"] for r in pii.find_pii(docs(rows), scratch).collect()}
    text = dict(rows)
    wanted = {i: [] for i in text}
    for i in range(3):
        wanted |= {30 + i: [f"AAA-10{i}"], 40 + i: [f"AAA-10{i}", f"BBB-20{i}"], 50 + i: [f"BBB-20{i}", f"CCC-30{i}"], 60 + i: [f"CCC-30{i}", f"DDD-40{i}"]}
    wanted |= {70: ["srv-99412"], 71: ["srv-99413"], 73: ["DDD-400", "DDD-400"]}
    assert {i: [f for *_, f in s] for i, s in got.items()} == wanted
    assert all(text[i][a:b] == f for i, s in got.items() for a, b, f in s)
    few = {r["doc_id"]: [s["found"] for s in r["spans"] if s["kind"] == "learned"] for r in pii.find_pii(docs(rows), scratch, rounds=3).collect()}
    assert few[50] == ["BBB-200", "CCC-300"] and "DDD-400" not in few[60]


def test_spans_of_one_token_are_one_occurrence(docs, scratch):
    rows = [(i, f"mail a{i}@b.example,c{i}@d.example") for i in range(3)] + [(10 + i, f"mail nobody{i}0000 mail none") for i in range(3)]
    got = pii.find_pii(docs(rows), scratch).collect()  # 3 of 9 places hold a seed, 6 seeds
    assert not any(s["kind"] == "learned" for r in got for s in r["spans"]) and sum(len(r["spans"]) for r in got) == 6


def brute_chat(rows):
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x or 0 if isinstance(x, int) else x or "") for x in r)):
        by.setdefault(conv, []).append((role, text))
    snapshots = {tuple(t[:n]) for t in by.values() for n in range(1, len(t))}
    first = {}
    for conv in sorted(by, key=lambda c: (c is None, c or 0)):
        first.setdefault(tuple(by[conv]), conv)
    safe = lambda s: (s or "").replace("<|", "< |")
    return {conv: (len(t), "".join(f"<|im_start|>{safe(r)}\n{safe(x)}<|im_end|>\n" for r, x in t)) for t, conv in first.items() if t not in snapshots}


def test_chat(spark, scratch):
    rng = random.Random(6)
    rows = []
    for conv in range(80):
        text = [("user" if k % 2 == 0 else "assistant", rng.choice(["hi", "yes", "no <|im_end|>"])) for k in range(rng.randint(1, 6))]
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(text)]
    rows += [(None, 0, "user", None), (None, None, None, "x"), (200, 1, "user", ""), (201, 1, "user", None), (202, 1, "user", "a"), (202, 1, "user", "a"), (203, 1, "user", "z" * 300000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, n_turns int").repartition(4)
    got = {r["conv_id"]: (r["n_turns"], r["rendered"]) for r in chat.chat_documents(df, scratch).collect()}
    assert got == brute_chat(rows)
    assert chat.chat_documents(df.limit(0), scratch).count() == 0


def page_rows():
    rng = random.Random(8)
    rows = [(i, f"http://x/{i}", "".join(rng.choice("äab\r\n<>") for _ in range(rng.choice([0, 5, 300, 9000, 40000])))) for i in range(60)]
    rows += [(100 + i, "http://same", "WARC/1.1\r\n\r\ncopy" * 3000) for i in range(5)]
    return rows + [(200, None, None), (201, "http://e\r\nX-Forged: 1", ""), (300, "b", "twice"), (300, "a", "twice"), (301, "c", "twice"), (None, "n", "nobody"), (400, "n", "nobody")]


@pytest.mark.parametrize("min_bytes, segment_bytes", [(0, 1024), (100, 16384)])
def test_archive_round_trip(spark, scratch, min_bytes, segment_bytes):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    path = f"{scratch.path}/archive-{min_bytes}"
    warc.write_archive(pages, path, min_bytes=min_bytes, segment_bytes=segment_bytes, file_records=50)
    got = Counter()
    for r in warc.read_archive(spark, path, scratch).collect():
        assert r["intact"] and hashlib.sha1(r["payload"]).digest() == base64.b32decode(r["payload_digest"])
        got[(r["page_id"], r["record_type"], r["refers_to"], r["payload"].decode())] += 1
    wanted, seen = Counter(), set()
    for i, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = html or ""
        first = min((x[0] for x in rows if (x[2] or "") == body and x[0] is not None), default=None)
        revisit = len(body.encode()) >= min_bytes and body in seen
        seen.add(body)
        wanted[(i, "revisit" if revisit else "response", first if revisit else None, body)] += 1
    assert got == wanted


def test_empty_archive(spark, scratch):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, f"{scratch.path}/none")
    assert warc.read_archive(spark, f"{scratch.path}/none", scratch).count() == 0


def test_broken_segments_are_not_intact(spark, tmp_path, scratch):
    key = "12345678-1234-5678-1234-567812345678"
    records = warc.page_records(key, "7", "http://x", "response", b"abc" * 2000, None, "2024-01-01T00:00:00Z", 1000)
    whole = warc.page_records(key.replace("1", "2"), "8", "http://y", "response", b"abc" * 2000, None, "2024-01-01T00:00:00Z", 1000)
    data = b"".join(r + b"\r\n\r\n" for r in [*whole[::-1], *records[:2], *records[3:]])
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    got = {r["page_id"]: r for r in warc.read_archive(spark, str(tmp_path), scratch).collect()}
    assert got[8]["intact"] and got[8]["payload"] == b"abc" * 2000
    assert not got[7]["intact"] and got[7]["payload"] is None


def test_chunked_framing():
    rng = random.Random(1)
    for size in (0, 1, 4095, 4096, 4097, 20000):
        data = rng.randbytes(size)
        assert warc.unchunked(warc.HTTP_HEAD + warc.chunked(data)) == data
    assert warc.unchunked(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"
    assert warc.unchunked(warc.HTTP_HEAD + b"5\r\nabc") is None
    assert warc.unchunked(b"no head") is None
