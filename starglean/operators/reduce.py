"""Standardising, PCA, the fuzzy neighbour graph, and spectral coordinates."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import literal_vector
from ..schema import KEY
from ..session import cut_lineage
from .layout import attract_repel
from .neighbors import knn, unit_vectors
from .spectral import spectral_layout


def check_vectors(df: DataFrame, vec: str = "vec") -> int:
    """The common length of a vector column (0 if all null); raises on other types or mixed lengths."""
    kind = dict(df.dtypes)[vec]
    if not kind.startswith("array<"):
        raise TypeError(f"{vec} must be an array column, not {kind}")
    sizes = df.filter(F.col(vec).isNotNull()).agg(F.min(F.size(vec)), F.max(F.size(vec))).first()
    shortest, longest = sizes[0] or 0, sizes[1] or 0
    if shortest != longest:
        raise ValueError(f"{vec} has lengths from {shortest} to {longest}")
    return longest


def dimension_stats(df: DataFrame, vec: str = "vec") -> tuple[np.ndarray, np.ndarray]:
    """Mean and population standard deviation of every dimension, from one combining aggregate."""
    summary = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(F.col(vec)))
    row = df.agg(summary.alias("s")).first()["s"]
    n = row["count"]
    return row["mean"].toArray(), np.sqrt(row["variance"].toArray() * ((n - 1) / n if n else 0.0))


def standardize(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Zero mean and unit population deviation; a constant dimension is only centred."""
    mean, std = dimension_stats(df, vec)
    centred = F.zip_with(F.col(vec), literal_vector(mean), lambda x, m: x - m)
    return df.withColumn(vec, F.zip_with(centred, literal_vector(np.where(std == 0, 1.0, std)), lambda x, s: x / s))


def pca(df: DataFrame, dims: int, vec: str = "vec", out: str = "embedding_pca") -> tuple[DataFrame, float]:
    """Centred projection on ``dims`` principal components, and the retained variance in percent."""
    data = df.withColumn("_raw", array_to_vector(F.col(vec).cast("array<double>")))
    scaler = StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False).fit(data)
    centred = scaler.transform(data)
    model = PCA(k=dims, inputCol="_centred", outputCol="_pc").fit(centred)
    kept = float(model.explainedVariance.toArray().sum() * 100)
    projected = model.transform(centred).withColumn(out, vector_to_array("_pc", "float32"))
    return projected.drop("_raw", "_centred", "_pc"), kept


def local_scale(distances: Column, rho: Column, target: float, steps: int = 48) -> Column:
    """The sigma with ``sum(exp(-max(0, d - rho) / sigma)) = target``, by bisection inside the row."""
    top = F.greatest(F.array_max(distances) * 16, F.lit(1e-3))
    start = F.struct(F.lit(0.0).alias("lo"), top.alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        mid = (state["lo"] + state["hi"]) / 2
        reached = F.aggregate(distances, F.lit(0.0), lambda acc, d: acc + F.exp(-F.greatest(d - rho, F.lit(0.0)) / mid))
        return F.when(reached > target, F.struct(state["lo"].alias("lo"), mid.alias("hi"))).otherwise(
            F.struct(mid.alias("lo"), state["hi"].alias("hi")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: (s["lo"] + s["hi"]) / 2)


def fuzzy_graph(
    df: DataFrame, k: int = 15, key: str = KEY, vec: str = "vec", metric: str = "euclidean", sigma: float | None = None, **space: int
) -> DataFrame:
    """Undirected weighted neighbour graph: ``a < b`` and ``weight`` in (0, 1].

    Each row's k neighbours (itself included, with no edge) get the weight
    exp(-(d - rho) / sigma), rho being the distance to its nearest distinct
    neighbour; the two directions p and q combine to p + q - p q.
    """
    if metric == "cosine":
        near = knn(unit_vectors(df, vec), k, key, vec, **space).withColumn("distance", F.col("distance") * F.col("distance") / 2)
    elif metric == "euclidean":
        near = knn(df, k, key, vec, **space)
    else:
        raise ValueError(f"unknown metric: {metric}")
    others = cut_lineage(near.filter(F.col(key) != F.col("neighbour")))
    # At most k distances per row, so the list is bounded.
    local = others.groupBy(key).agg(F.collect_list("distance").alias("ds"))
    local = local.withColumn("rho", F.coalesce(F.array_min(F.filter("ds", lambda d: d > 0)), F.lit(0.0)))
    scale = F.lit(sigma) if sigma is not None else local_scale(F.col("ds"), F.col("rho"), float(np.log2(k)))
    local = local.select(key, "rho", scale.alias("sigma"))
    weight = F.exp(-F.greatest(F.col("distance") - F.col("rho"), F.lit(0.0)) / F.col("sigma"))
    directed = others.join(local, key).select(
        F.least(key, "neighbour").alias("a"), F.greatest(key, "neighbour").alias("b"), weight.alias("w"))
    product = F.when(F.count(F.lit(1)) == 2, F.max("w") * F.min("w")).otherwise(0.0)
    return directed.groupBy("a", "b").agg((F.sum("w") - product).alias("weight"))


def neighbour_reduction(
    df: DataFrame, dims: int = 15, k: int = 30, key: str = KEY, vec: str = "vec", metric: str = "euclidean",
    min_dist: float | None = 0.1, tol: float = 1e-3, seed: int = 42, out: str = "embedding_umap_15", **space: int,
) -> DataFrame:
    """Neighbour graph, spectral start, and a layout of it: ``key`` and its ``dims`` coordinates as floats.

    Neighbours attract each other down to about ``min_dist``; with None the
    spectral coordinates, exact to ``tol``, are the result.
    """
    graph = cut_lineage(fuzzy_graph(df, k, key, vec, metric, **space))
    laid = spectral_layout(graph, dims, tol, seed)
    if min_dist is not None:
        laid = attract_repel(graph, laid, min_dist, seed)
    return laid.select(F.col("id").alias(key), F.col("coords").cast("array<float>").alias(out))


def neighbours_kept(df: DataFrame, laid: DataFrame, k: int, key: str = KEY, vec: str = "vec", coords: str = "embedding_umap_15") -> DataFrame:
    """One row ``kept``: the share of the ``k`` nearest other rows by ``vec`` that are among the ``k`` nearest by ``coords``."""
    before = knn(df, k, key, vec, include_self=False).select(key, "neighbour")
    after = knn(laid.select(key, F.col(coords).cast("array<double>").alias("vec")), k, key, include_self=False).select(key, "neighbour")
    both = before.withColumn("same", F.lit(0.0)).join(after.withColumn("found", F.lit(1.0)), [key, "neighbour"], "left")
    return both.agg(F.avg(F.coalesce("found", "same")).alias("kept"))
