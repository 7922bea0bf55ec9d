import random

import numpy as np

from starglean.llm import omh


def words_of(text):
    import re

    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def sequence(text):
    w = words_of(text)
    seen, out = {}, []
    for s in [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []:
        out.append((s, seen.get(s, 0)))
        seen[s] = seen.get(s, 0) + 1
    return out


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute(texts):
    """Classes by comparing all pairs with the full alignment table."""
    ids = sorted(texts)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seqs = {i: sequence(texts[i]) for i in ids}
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = seqs[i], seqs[j]
            if a and b:
                if min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
                    continue
                c = lcs(a, b)
                linked = c >= 0.8 * (len(a) + len(b) - c)
            else:
                linked = not a and not b and (texts[i] or "") == (texts[j] or "")
            if linked:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in ids}


def fixture():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = {}
    for group in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(30, 120))]
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4, 9])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                at = draw.randrange(len(copy))
                copy = copy[at:] + copy[:at]
            texts[len(texts)] = " ".join(copy)
    for text in ("", None, "...", "...", "one", "One!", "one two", "a b c d e", "a b c d e", "x " * 4000, "x " * 3990, "x " * 100):
        texts[len(texts)] = text
    return texts


def test_classes_equal_brute_force(spark):
    texts = fixture()
    texts = {i: t for i, t in texts.items() if not t or len(t) < 4000}  # the plain table is for short texts
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()}
    assert got == brute(texts)


def test_repeated_ids_nulls_and_extra_columns(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta " * 3000
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "A b c d e f g."), (None, "alone here"), (9, "q r s t u v"), (9, long), (4, long), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "'x' AS class_id", "1 AS bands", "2 AS content")
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in omh.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 5, True), (5, 5, True), (None, 5, False), (None, None, False), (9, 4, False), (9, 4, False), (4, 4, True), (7, 7, True), (8, 7, False)], key=repr)
    assert omh.near_duplicates(docs.limit(0)).collect() == []
    kept = omh.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 4, 5, 5, 7]


def test_documents_find_all_pairs_over_the_threshold(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    sets = {i: set(sequence(t)) for i, t in texts.items()}
    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            common = len(sets[i] & sets[j])
            if common and common >= 0.8 * len(sets[i] | sets[j]) and lcs(sequence(texts[i]), sequence(texts[j])) == common:
                assert got[i] == got[j], (i, j)
    assert len(set(got.values())) < len(got)


def test_alignment_minds_order():
    a = np.arange(100, dtype=np.uint32)
    assert omh.similarity(a, a) == 1.0
    assert omh.similarity(a, np.concatenate([a[50:], a[:50]])) == 0.0
    b = a.copy()
    b[:10] += np.uint32(1000)
    assert abs(omh.similarity(a, b) - 90 / 110) < 1e-12
