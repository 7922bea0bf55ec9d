"""Text to vectors and expected-class scores, with built-in or user-supplied models."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.hashing import md5_hash32
from ..functions.text import words
from ..functions.vectors import doubles, expected_class, list_column, softmax
from ..session import costly, cut_lineage, scratch_path

#: Loads a model in a Python worker and returns the function applied to each batch.
PredictFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]

# Batch sizes of the encoder and the sentiment model.
ENCODE_BATCH, SENTIMENT_BATCH = 256, 64


def hash_embedding(text: Column, dims: int = 64, normalize: bool = True) -> Column:
    """Signed feature hashing: token hash h adds +1 or -1 to dimension h mod dims.

    Row-local over Arrow batches, so encoding needs no shuffle.
    """

    @arrow_udf(T.ArrayType(T.FloatType()))
    def encode(hashes: pa.Array) -> pa.Array:
        h = hashes.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(hashes)), hashes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        sign = 1.0 - 2.0 * ((h // dims) % 2)
        out = np.bincount(row * dims + h % dims, weights=sign, minlength=len(hashes) * dims).reshape(len(hashes), dims)
        if normalize:
            size = np.sqrt((out * out).sum(axis=1, keepdims=True))
            out = out / np.where(size == 0, 1.0, size)
        return list_column(out, pa.float32())

    return costly(encode)(F.transform(words(F.lower(text)), md5_hash32))


def embed_text(
    df: DataFrame, text: str, out: str = "embedding", encoder: PredictFactory | None = None, dims: int = 64,
    batch_size: int = ENCODE_BATCH,
) -> DataFrame:
    """Add an embedding column: the hashing encoder, or a model loaded once per Python worker."""
    column = F.col(f"`{text}`")
    if encoder is None:
        return df.withColumn(out, hash_embedding(column, dims))
    predict = costly(predict_batch_udf(encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size))
    return df.withColumn(out, predict(F.coalesce(column, F.lit(""))))


def fit_class_model(df: DataFrame, label: str, embedding: str = "embedding", max_iter: int = 20) -> LogisticRegressionModel:
    """Multinomial regression of a class index (0, 1, ...) on the embedding.

    The model is stored and read again: as fitted it also holds a summary of its
    training, session included, which cannot go to tasks once a write is observed.
    Embeddings are cut off first: fitting reads its rows more than once.
    """
    rows = cut_lineage(df.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), doubles(F.col(embedding)).alias("vec")))
    data = rows.select("label", array_to_vector("vec").alias("features"))
    path = scratch_path(df.sparkSession, "class-model")
    LogisticRegression(maxIter=max_iter, regParam=0.01, family="multinomial").fit(data).save(path)
    return LogisticRegressionModel.load(path)


def score_expected_class(
    df: DataFrame, model: LogisticRegressionModel | PredictFactory, source: str = "embedding", out: str = "sentiment_score",
    batch_size: int = SENTIMENT_BATCH,
) -> DataFrame:
    """Add the expected class number (1..C): from a fitted model on embeddings, or from a user model's logits on text."""
    if isinstance(model, LogisticRegressionModel):
        data = df.withColumn("features", array_to_vector(doubles(F.col(f"`{source}`"))))
        scored = model.setPredictionCol("_prediction").setRawPredictionCol("_raw").setProbabilityCol("_probability").transform(data)
        score = expected_class(vector_to_array("_probability"))
        return scored.withColumn(out, score.cast("float")).drop("features", "_prediction", "_raw", "_probability")
    logits = costly(predict_batch_udf(model, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size))
    with_logits = df.withColumn("_logits", doubles(logits(F.coalesce(F.col(f"`{source}`"), F.lit("")))))
    return with_logits.withColumn(out, expected_class(softmax(F.col("_logits"))).cast("float")).drop("_logits")
