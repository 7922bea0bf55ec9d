import random
import re
from collections import Counter

import numpy as np
import pytest

from starglean.llm import collocations

DOCS = "doc_id bigint, text string, lang string, phrase string, n int, score string"


def brute(rows, top, least):
    """All phrases counted, scored and compared."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    swallowed = set()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * a >= 80 * f[lang, p[i : i + m]]:
                    swallowed.add((lang, p[i : i + m]))
    best = {}
    for (lang, p), a in candidates.items():
        if (lang, p) in swallowed:
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, some in best.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(spark, rows, top, least, **options):
    docs = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, (lang, t) in enumerate(rows)], DOCS)
    got = sorted(tuple(r) for r in collocations.collocations(docs, top, least, **options).collect())
    assert got == brute(rows, top, least)
    return got


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(13)
    words = "the of and to in a is that for it was on are as with his they at be this".split() + ["É", "ß", "x y", "--"]
    fixed = ["once upon a time", "in the end of it", "new york city hall", "the new york times", "as soon as possible", "a b a b a b"]

    def text(some):
        out = []
        for _ in range(draw.randint(0, 60)):
            out.append(draw.choice(some) if draw.random() < 0.25 else draw.choice(words[: draw.randint(1, len(words))]))
            out.append(draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]))
        return "".join(w.upper() if draw.random() < 0.1 else w for w in out)

    return [(draw.choice(["en", "en", "de", None]), text(fixed[: draw.randint(1, 6)])) for _ in range(250)]


@pytest.mark.parametrize("top, least, ahead", [(2000, 5, 2), (40, 5, 1), (15, 8, 2), (5, 3, 1)])
def test_random_texts(spark, texts, top, least, ahead):
    got = check(spark, texts, top, least, ahead=ahead)
    assert {r[0] for r in got} == {"en", "de", "und"}
    assert top > 1000 or all(sum(r[0] == lang for r in got) == top for lang in ("en", "de", "und"))


def test_threshold_falls_until_enough_survive(spark):
    """The best pairs are all swallowed, so the first threshold is too high."""
    rows = [("en", f"w{i} x{i} y{i} z{i}.") for i in range(30) for _ in range(4)] + [("en", f"common{i % 5} end{i % 3} again.") for i in range(200)]
    check(spark, rows, 35, 3, ahead=1)


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("en", None), ("und", "so it is so it is"), (None, "so it is so it is"), ("en", "A a A a a"), ("en", ".;:!?\t \n"),
            ("en", "word " * 30000), ("", "no language at all"), ("", "no language at all")] + [("fr", "repeated rows count")] * 4
    check(spark, rows, 50, 2)


def test_empty_tables(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, "rare words", "en", "", 0, "")], DOCS)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(2**62, 2**62 + 3, 2**62 + 5)], "a bigint, l bigint, r bigint")
    from pyspark.sql import functions as F

    got = row.select(collocations._score("a", F.col("l"), F.col("r"))).first()[0]
    assert got == 2000000 * 2**62 // (2**63 + 8)


def test_numbers_shared_by_words_are_renewed(spark, texts, monkeypatch):
    """With numbers of four bits in the first try, words collide and are numbered anew."""
    rows = texts[:40]
    docs = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, (lang, t) in enumerate(rows)], DOCS)
    tries = []

    def coded(docs, seed, make=collocations.coded_corpus):
        tries.append(seed)
        table = make(docs, seed)
        if seed:
            return table
        from pyspark.sql import functions as F

        return table.withColumn("code", F.col("code").bitwiseAND(F.lit(15)).bitwiseOR(F.lit(2)))

    monkeypatch.setattr(collocations, "coded_corpus", coded)
    got = sorted(tuple(r) for r in collocations.collocations(docs, 50, 2).collect())
    assert got == brute(rows, 50, 2) and tries == [0, 1]


def test_bloom_has_no_false_misses(spark):
    from pyspark.sql import functions as F

    members = spark.range(5000).select(F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(1)).alias("g"))
    bloom = collocations.Bloom.of(members, collocations.mixed(F.col("h"), F.col("g")))
    h, g = (np.array([r[i] for r in members.collect()], np.int64) for i in range(2))
    assert bloom.holds(collocations.mixed(h, g)).all()
    assert bloom.holds(collocations.mixed(g, h)).mean() < 0.1
