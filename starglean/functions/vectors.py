"""Vector arithmetic on array columns, computed in double."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, also inside lambdas of ``use``."""
    return F.transform(F.array(value), use)[0]


def doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(vec: Column) -> Column:
    return F.sqrt(total(F.transform(vec, lambda x: x * x)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos``; null when either vector is zero."""
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalize(vec: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    return let(norm(vec), lambda size: F.when(size == 0, vec).otherwise(F.transform(vec, lambda x: x / size)))


def softmax(logits: Column) -> Column:
    exps = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return let(exps, lambda es: let(total(es), lambda all_: F.transform(es, lambda e: e / all_)))


def expected_class(probabilities: Column) -> Column:
    """Probability-weighted class number, classes counted from 1 ("expected stars")."""
    return total(F.transform(probabilities, lambda p, i: p * (i + 1)))


def sentiment_category(score: Column) -> Column:
    """Half-to-even rounding, clipped to 1..5."""
    return F.least(F.greatest(F.bround(score).cast("int"), F.lit(1)), F.lit(5))


def literal_vector(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column as a 2-D double array; null vectors, null components and unequal lengths raise."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if rows and (column.null_count or (lengths != lengths[0]).any() or column.flatten().null_count):
        raise ValueError("vectors must be given, of one length and without null components")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def list_column(matrix: np.ndarray, kind: pa.DataType = pa.float64()) -> pa.Array:
    """The inverse of :func:`matrix_of`."""
    rows, dims = matrix.shape
    bounds = pa.array(np.arange(0, rows * dims + 1, dims, dtype=np.int32)) if dims else pa.array([0] * (rows + 1), pa.int32())
    return pa.ListArray.from_arrays(bounds, pa.array(np.ascontiguousarray(matrix).ravel(), kind))
