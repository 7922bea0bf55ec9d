import numpy as np
import pytest
from pyspark.sql import functions as F

from starglean.llm import pulearn


@pytest.fixture(scope="module")
def corpus(spark):
    draw = np.random.default_rng(3)
    words, bad = [f"w{i}" for i in range(400)], ["grumbix", "snorvel", "blatche"]
    rows, labels = [], []
    for i in range(1500):
        text = list(draw.choice(words, 40))
        toxic = int(draw.random() < 0.15)
        if toxic:
            for _ in range(3):
                text[draw.integers(0, 40)] = str(draw.choice(bad)) + str(draw.choice(["", "en", "s"]))
        rows.append((i, " ".join(text)))
        if draw.random() < 0.5:
            labels.append((i, toxic))
    truth = {i: any(b in t for b in bad) for i, t in rows}
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), truth


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    model = pulearn.train(docs, labels)
    rows = [r for r in pulearn.score(docs, model).collect() if r.held_out]
    assert len(rows) > 200 and sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_held_out_labels_change_nothing(corpus):
    docs, labels, _ = corpus
    flipped = labels.withColumn("toxic", F.when(pulearn.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = pulearn.train(docs, labels), pulearn.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior


def test_odd_rows(spark, corpus):
    docs, labels, _ = corpus
    model = pulearn.train(docs, labels)
    rows = [(1, None), (2, ""), (2, ""), (None, "grumbix snorvel blatche"), (3, "grumbix snorvel blatche " * 50_000)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "9 AS score", "'x' AS f", "1 AS held_out")
    got = {(r.doc_id, r.predicted, r.held_out) for r in pulearn.score(odd, model).collect()}
    assert (None, 1, False) in got and all(0 <= r.score <= 1 for r in pulearn.score(odd, model).collect())
    scores = {r.doc_id: r.score for r in pulearn.score(odd, model).collect()}
    assert scores[1] == scores[2] < 0.5 and scores[3] == scores[None]
    assert pulearn.score(odd.limit(0), model).collect() == []
    assert {r.predicted for r in pulearn.score(odd, pulearn.train(docs, labels.limit(0))).collect()} == {0}
    assert {r.predicted for r in pulearn.score(odd, pulearn.train(docs.limit(0), labels)).collect()} == {0}
    kept = pulearn.drop_toxic(odd.union(odd.limit(0)), labels.limit(0))
    assert kept.count() == len(rows) and kept.columns == odd.columns


def test_fold_is_the_contracts(spark):
    import zlib

    ids = spark.range(2000).select(F.col("id").alias("doc_id"), pulearn.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in ids)


def test_documents_held_out_ranking(spark):
    folder = "/root/testdata/sf0.1"  # the small tables hold too few toxic texts to learn from
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = [r for r in pulearn.score(docs, pulearn.train(docs, labels)).join(labels, "doc_id").collect() if r.held_out]
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    rank = score.argsort().argsort() + 1
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    assert (rank[toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.9
    assert ((score >= 0.5) & (toxic == 0)).sum() <= 0.03 * n0
