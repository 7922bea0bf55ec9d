"""Review-shaped views over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ITEM, KEY, LANG, SCORE, TEXT
from ..session import spread_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """``spread`` for heavy per-row text work, see :func:`spread_rows`."""
    documents = table(spark, folder, "documents")
    return (spread_rows(documents) if spread else documents).select(
        F.col("doc_id").alias(KEY),
        F.col("source").alias(ITEM),
        (1 + F.col("n_chars") % 5).cast("double").alias(SCORE),
        F.col("text").alias(TEXT),
        F.col(LANG),
    )


def labelled_reviews(spark: SparkSession, folder: str, spread: bool = False) -> DataFrame:
    """Reviews with the partly missing quality and toxicity labels."""
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", KEY)
    return reviews(spark, folder, spread).join(labels, KEY, "left")


def cluster_results(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias(KEY),
        (1 + (F.col("vec_id") * 7 + F.col("label") * 3) % 5).cast("bigint").alias("rating"),
        (0.25 + ((F.col("vec_id") * 37) % 550) / 100.0).cast("double").alias("sentiment_score"),
        F.col("label").alias("cluster_kmeans"),
        (F.col("label") - 1).alias("cluster_dbscan"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias(KEY), F.col("embedding").cast("array<double>").alias("vec")
    )


def points2(spark: SparkSession, folder: str) -> DataFrame:
    return points(spark, folder).withColumn("vec", F.slice("vec", 1, 2))


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return spread_rows(table(spark, folder, "pages")).select(F.col("page_id").alias(KEY), F.col("html").alias(TEXT))
