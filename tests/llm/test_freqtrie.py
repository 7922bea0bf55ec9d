import random
import re
import zlib

import numpy as np
import pytest

from starglean.llm import freqtrie

DOCS = "doc_id bigint, text string, word string, n string, signature int"


def brute_counts(rows):
    seen = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            seen[word] = seen.get(word, 0) + 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def brute_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = brute_counts(rows)
    near = {w: [v for v in n if brute_near(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 2 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, "a", "b", 1) for d, t in rows], DOCS)
    got = freqtrie.spelling_variants(docs, **options).collect()
    assert len(got) == len({r.word for r in got})
    assert {tuple(r) for r in got} == brute(rows)
    return got


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(12)
    stems = ["".join(draw.choice("aeinstßéÀ×") for _ in range(draw.randint(5, 9))) for _ in range(120)]

    def edited(word):
        i = draw.randrange(len(word) + 1)
        return draw.choice([word[:i] + draw.choice("aeintsß") + word[i:], word[:i] + word[i + 1 :], word[:i] + draw.choice("aeinÿ") + word[i + 1 :]])

    rows = []
    for i in range(150):
        words = [draw.choice(stems[: draw.randint(1, 120)]) for _ in range(60)]
        words = [edited(w) if draw.random() < 0.15 else w for w in words]
        rows.append((i, draw.choice([" ", ", ", "1", "\n"]).join(draw.choice([w, w.upper(), w.title()]) if w.isascii() else w for w in words)))
    return rows + [(1000 + i, "stone") for i in range(40)] + [(2000 + i, "stonee stane") for i in range(15)] + [(3000 + i, "stoneee ston stonne") for i in range(6)]


@pytest.mark.parametrize("options", [{}, {"bucket_words": 6, "visitors": 5}])
def test_random_texts(spark, texts, options):
    got = check(spark, texts, **options)
    assert any(r.form and r.root != r.form for r in got) and max(r.n_near for r in got) >= 3


def test_garbled_words_occur(texts):
    plain = [w for d, t in texts for w in re.findall("[a-zÀ-ÿ]+", t or "")]
    garbled = [w for d, t in texts for w, _ in freqtrie.spellings(str(d), t, 1)]
    assert set(garbled) - {w for w in plain} - {freqtrie.lowered(w) for w in plain}


def test_odd_rows(spark):
    long = "ab" * 300
    rows = [(None, None), (None, ""), (1, None), (2, "1 2 -"), (None, "house " * 9), (None, "house " * 9), (3, "houses housés HOUSES " * 4),
            (4, f"{long} " * 3 + f"{long}c " * 8 + f"{'b' + long[1:]} " * 3 + f"{long[::-1]} " * 3), (5, "aaaaaaaaaaaaaaaaaaaaaaaa " * 3 + "aaaaaaaaaaaaaaaaaaaaaaaaa " * 7),
            (6, "stone notes onest " * 5), (6, "x" * 20000)] + [(7, "repeated rows")] * 5
    check(spark, rows)
    check(spark, rows, bucket_words=1, visitors=2)


def test_empty_table(spark):
    assert freqtrie.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
    check(spark, [(1, "once")])


def test_search_reaches_every_near_signature():
    draw = random.Random(3)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(3, 6))) for _ in range(400)})
    level = np.zeros(256, np.uint8)
    level[[ord(c) for c in "abc"]] = [0, 7, 15]
    signature = freqtrie.signatures([w.encode() for w in words], level)
    reached = [set() for _ in words]
    for who, leaf, depth in freqtrie.Trie.whole(signature).search(signature):
        for i, s in zip(who.tolist(), leaf.tolist()):
            assert s not in reached[i]
            reached[i].add(s)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if brute_near(a, b):
                assert int(signature[j]) in reached[i] or int(signature[i]) in reached[j]
                assert freqtrie.one_edit(a.encode(), b.encode())
