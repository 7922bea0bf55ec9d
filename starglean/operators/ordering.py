"""Global positions, running totals and exact percentiles without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

def running_total(
    df: DataFrame, weight: str, order: Sequence[str], by: Sequence[str] = (), out: str = "running"
) -> DataFrame:
    """Inclusive running sum of ``weight`` in ``order``, optionally inside each group of ``by``.

    Rows are range-partitioned on ``(by, order)``, so a hot group spans
    many tasks.  Each range then only needs the sums of the ranges before it:
    one row per (range, group), which is at most ranges + groups rows.
    ``order`` must be unique within a group.
    """
    by, order = list(by), list(order)
    ranges = cut_lineage(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranges.groupBy(*by, "_range").agg(F.sum(weight).alias("_sum"))
        .withColumn("_shift", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    )
    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranges.withColumn("_part", F.sum(weight).over(inside))
        .join(shifts, [*by, "_range"])
        .withColumn(out, F.col("_part") + F.col("_shift"))
        .drop("_range", "_part", "_shift")
    )


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "position") -> DataFrame:
    """1-based position of each row in ``order`` (which must be unique)."""
    numbered = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order, out=out)
    return numbered.drop("_one")


def label_index(df: DataFrame, label: str, out: str = "label_index") -> DataFrame:
    """Distinct labels with their 0-based rank in label order."""
    ranked = global_row_number(df.select(label).distinct(), [label], out)
    return ranked.withColumn(out, (F.col(out) - 1).cast("int"))


def every_nth(df: DataFrame, order: str, n: int = 10, out: str = "is_marked") -> DataFrame:
    """Flag rows 1, n+1, 2n+1, ... in ``order``: axis label thinning."""
    ranked = global_row_number(df, [order], "_position")
    return ranked.withColumn(out, (F.col("_position") - 1) % n == 0).drop("_position")


def slice_rows(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows at 0-based positions ``start`` (inclusive) to ``stop`` (exclusive)."""
    ranked = global_row_number(df, order, "_position")
    return ranked.filter((F.col("_position") > start) & (F.col("_position") <= stop)).drop("_position")


def percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated percentiles in long form: ``by``, ``probability``, ``value``.

    Values are first reduced to (value, count); the rank of each distinct value
    is its running count.  A percentile needs the values at two ranks, found by
    a range predicate against the distinct values, so neither a group nor the
    whole column is ever held by one task.
    """
    by = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_value")).count()
    ranked = cut_lineage(running_total(counts, "count", ["_value"], by, "_upto"))
    sizes = ranked.groupBy(*by).agg(F.max("_upto").alias("_rows"))
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    # Position of each percentile on the 0-based row axis, per group.
    spread = ranked.join(sizes, by) if by else ranked.withColumn("_rows", F.lit(_only(sizes)))
    hit = spread.withColumn("_p", F.explode(wanted)).withColumn("_at", F.col("_p") * (F.col("_rows") - 1))
    first, last = F.col("_upto") - F.col("count"), F.col("_upto") - 1
    lower, upper = F.floor("_at"), F.ceil("_at")
    found = hit.filter((lower.between(first, last)) | (upper.between(first, last)))
    at_lower = F.max(F.when(lower.between(first, last), F.col("_value")))
    at_upper = F.max(F.when(upper.between(first, last), F.col("_value")))
    share = F.first(F.col("_at") - lower)
    return found.groupBy(*by, F.col("_p").alias("probability")).agg(
        (at_lower + (at_upper - at_lower) * share).cast("double").alias("value")
    )


def _only(sizes: DataFrame) -> int | None:
    return sizes.first()[0]
