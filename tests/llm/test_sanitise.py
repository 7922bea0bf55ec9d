import hashlib
import math
import random
import re

import pytest

from starglean.llm import sanitise

# The patterns as the contract writes them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_patterns():
    draw = random.Random(4)
    texts = ["", "@", "a@b", "a@b.c@d.e", "@b.c@d.e.f", "x..y@-.-.", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 123-4567.", "++49 30 1234567-", "00000000000000000000 0000000000000000", "é a@b.co 😀 10.0.0.1"]
    texts += ["".join(draw.choice("a1@.-+ (%é") for _ in range(draw.randint(1, 60))) for _ in range(5000)]
    texts += ["".join(draw.choice("0123456789. -") for _ in range(draw.randint(8, 60))) for _ in range(5000)]
    for text in texts:
        assert sanitise.base_spans(text) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "%" * 200_000 + "@x"):
        sanitise.base_spans(text)


def corpus():
    rows = [(i, f"filler words here number {i} and nothing else of note") for i in range(40)]
    rows += [(100 + i, f"text {i} about the surgeon zebulon at mail zeb@clinic.org and others") for i in range(3)]
    return rows + [(200, "someone wrote to once@only.net about quixotic things"), (201, None), (202, ""), (None, "surgeon"), (203, "surgeon")]


def test_terms_by_document_counts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 AS near", "2 AS spans", "3 AS row")
    got = {r.doc_id: r for r in sanitise.personal_data(docs).collect() if r.doc_id is not None}
    n = len(rows)
    count = lambda t: sum(t in re.findall(r"\w+", (x or "").lower()) for _, x in rows)
    share = lambda t: (math.log2(n) + math.log2(3) - math.log2(3) - math.log2(count(t))) / (math.log2(n) - math.log2(3))
    text = rows[40][1]
    terms = {t for t in ("about", "the", "surgeon", "zebulon", "mail", "and", "others", "text") if share(t) >= sanitise.GENERALISE}
    expected = sorted([(m.start(), 4, m.end()) for t in terms for m in re.finditer(rf"\b{t}\b", text)] + plain(text))
    assert got[100].spans == sanitise.shown(expected) and "zebulon" in terms and "and" not in terms
    assert got[100].n_email == 1 and got[100].base_sha256 == hashlib.sha256(sanitise.shown(plain(text)).encode()).hexdigest()
    assert got[200].spans == sanitise.shown(plain(rows[43][1]))
    assert got[201].spans == got[202].spans == got[203].spans == ""
    assert sanitise.personal_data(docs.limit(0)).collect() == []
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert "[email]" in clean[100] and "zebulon" not in clean[100] and clean[201] is None and clean[5] == rows[5][1]


def test_terms_far_from_their_entity(spark):
    far = " ".join(f"padding{k}" for k in range(12))
    rows = [(i, f"filler words here number {i} and {far}") for i in range(40)]
    rows += [(100, f"call +49 (30) 1234567 {far} then ask for Zebulon"), (101, f"Zebulon can be had {far} under +49-30-1234567 and Zebulon is Bo"),
             (102, f"Bo left 010.1.2.3 {far} {far} with quaggas"), (103, f"quaggas {far} Bo at 10.1.2.3"), (104, "zebulon and quaggas alone")]
    got = {r.doc_id: r.spans for r in sanitise.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for (i, text), terms in zip(rows[40:44], (["Zebulon"], ["Zebulon"], ["quaggas", "Bo"], ["quaggas", "Bo"])):
        for term in terms:
            for m in re.finditer(rf"\b{term}\b", text):
                assert f"term:{m.start()}:{m.end()}" in got[i].split(","), (i, term)
        assert not any(f"term:{m.start()}:" in got[i] for m in re.finditer(r"padding\d+", text))
    assert got[104] == "" and "term" not in got[5]


def test_documents_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sanitise.personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(sanitise.shown(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert {x for x in sanitise.shown(spans).split(",") if x} <= set(r.spans.split(","))
