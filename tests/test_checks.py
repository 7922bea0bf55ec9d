"""Inputs that must be refused or marked instead of being answered wrongly."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starglean.functions.hashing import minhash_signature
from starglean.functions.vectors import matrix_of
from starglean.operators import analysis
from starglean.schema import EMBEDDINGS, KEY, as_table


def test_rows_without_hashes_have_no_signature(spark):
    rows = [(1, [5]), (2, []), (3, [9]), (4, None)]
    frame = spark.createDataFrame(rows, "id int, h array<bigint>").coalesce(1).select("id", minhash_signature(F.col("h")).alias("s"))
    got = {r["id"]: r["s"] for r in frame.collect()}
    alone = {r["id"]: r["s"] for i in (1, 3) for r in frame.filter(F.col("id") == i).collect()}
    assert got[2] is None and got[4] is None and got[1] == alone[1] and got[3] == alone[3] and got[1] != got[3]


@pytest.mark.parametrize("rows", [[[1.0, 2.0, 3.0, 4.0], None], [[1.0, 2.0, 3.0], [4.0]], [[1.0, None]]])
def test_uneven_vectors_are_refused(rows):
    with pytest.raises(ValueError):
        matrix_of(pa.array(rows, pa.list_(pa.float64())))
    assert np.array_equal(matrix_of(pa.array([[1.0, 2.0], [3.0, 4.0]])), [[1, 2], [3, 4]])


def test_a_bad_key_raises_and_a_bad_measure_is_null(spark):
    names = [f.name for f in EMBEDDINGS.fields]
    good = {n: None for n in names} | {KEY: "12", "review/score": "n/a"}
    schema = ", ".join(f"`{n}` string" for n in names)
    frame = spark.createDataFrame([tuple(good[n] for n in names)], schema)
    plain = frame.select([F.col(f"`{n}`") if n in (KEY, "review/score") else F.lit(None).alias(n) for n in names])
    assert as_table(plain, EMBEDDINGS).select(KEY).first()[0] == 12
    with pytest.raises(Exception, match="not a review_id"):
        as_table(plain.withColumn(KEY, F.lit("ab12-1")), EMBEDDINGS).select(KEY).collect()


def test_ratings_off_the_scale_raise(spark):
    rows = spark.createDataFrame([(1, 5.0), (1, 4.5), (1, 0.0), (1, None), (None, 3.0), (2, float("nan"))], "cluster int, rating double")
    for wide in (analysis.contingency, lambda r: analysis.contingency_share(r, within="cluster")):
        with pytest.raises(Exception, match="not on the rating scale"):
            wide(rows).collect()
    whole = rows.filter("rating = 5.0 or rating is null or isnan(rating)")
    assert [r["r5"] for r in analysis.contingency(whole).collect()] == [1]
    assert {r["cluster"] for r in analysis.cluster_stats(whole).collect()} == {r["cluster"] for r in analysis.rating_counts(whole).collect()} == {1}
