"""Ordering, percentiles, samples, keys, rating analysis."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starglean.functions import vectors as v
from starglean.operators import analysis, filters, ordering, profile, sampling
from starglean.schema import with_content_key


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one group and one value."""
    rows = [(i, 0 if i % 3 == 0 else i % 7, 1.0 if i % 3 == 0 else float((i * 37) % 101) / 7) for i in range(900)]
    return spark.createDataFrame(rows, "id long, g int, x double").repartition(8).persist()


def test_range_numbering_equals_plain_window(skewed):
    ranged = ordering.global_row_number(skewed, ["x", "id"]).collect()
    ordered = sorted(skewed.collect(), key=lambda r: (r["x"], r["id"]))
    assert {r["id"]: r["position"] for r in ranged} == {r["id"]: i for i, r in enumerate(ordered, 1)}


def test_grouped_percentiles(skewed):
    found = ordering.percentiles(skewed, "x", [0.0, 0.25, 0.5, 0.95, 1.0], ["g"]).collect()
    values = skewed.toPandas().groupby("g")["x"]
    assert len(found) == 5 * 7
    for r in found:
        assert r["value"] == pytest.approx(np.percentile(values.get_group(r["g"]), r["probability"] * 100), abs=1e-12)


def test_exact_sample_follows_the_hash_order(skewed):
    ids = {r["id"] for r in sampling.sample_exact(skewed, 333, "id").collect()}
    plain = skewed.orderBy(sampling.sample_order("id")).limit(333)
    assert len(ids) == 333 and ids == {r["id"] for r in plain.collect()}
    assert sampling.sample_exact(skewed, 5000, "id").count() == 900


def test_content_key_is_stable_and_unique(spark):
    rows = [("a", 1)] * 40 + [("b", 2)] * 3 + [("c", None)]
    keys = [
        {r["review_key"] for r in with_content_key(spark.createDataFrame(rows, "s string, n int").repartition(p)).collect()}
        for p in (1, 5)
    ]
    assert len(keys[0]) == 44 and keys[0] == keys[1]


def test_single_review_cluster_is_never_overrating(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 1.0), (2, 5.0)], "cluster int, rating double")
    rows = {r["cluster"]: r for r in analysis.overrating_rate(df).collect()}
    assert rows[1]["std"] is None and rows[1]["overrating_count"] == 0 and rows[1]["overrating_pct"] == 0.0
    assert rows[2]["overrating_count"] == 1 and rows[2]["overrating_pct"] == 33.3
    flags = analysis.flag_overrating(df).filter("cluster = 1").first()
    assert flags["threshold"] is None and flags["is_overrating"] is False


def test_unused_rating_has_no_column_share(spark):
    df = spark.createDataFrame([(1, 5), (2, 1)], "cluster int, rating int")
    row = analysis.contingency_share(df).orderBy("cluster").first()
    assert row["r1"] == 0.0 and row["r5"] == 1.0 and row["r3"] is None


def test_half_even_and_clip(spark):
    df = spark.createDataFrame([(0.2,), (2.5,), (3.5,), (5.7,)], "s double")
    assert [r[0] for r in df.select(v.sentiment_category(F.col("s"))).collect()] == [1, 2, 4, 5]


def test_equal_logits_give_the_middle_class(spark):
    df = spark.createDataFrame([([0.0] * 5,)], "v array<double>")
    assert df.select(v.expected_class(v.softmax(F.col("v")))).first()[0] == pytest.approx(3.0)


def test_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("", None)], "t string, s double")
    assert filters.drop_missing(df, "t", "s").count() == 1
    assert filters.blank_rows(df, "t").count() == 2
    assert filters.drop_uncleaned(df, "t").count() == 2 and filters.drop_uncleaned(df, "t", True).count() == 1
    assert [tuple(r) for r in profile.null_profile(df).collect()] == [("t", "string", 2, 1), ("s", "double", 2, 1)]


def test_constant_histogram(spark):
    h = profile.histogram(spark.range(4).select(F.lit(3).alias("x")), "x", bins=4).orderBy("bin").collect()
    assert [r["n"] for r in h] == [0, 0, 4, 0] and h[0]["lower"] == 2.5


def test_fewer_clusters_than_asked(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "c int")
    assert sampling.sample_labels(df, "c", 10).count() == 2
