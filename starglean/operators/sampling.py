"""Exact-size seeded samples that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_order(key: str, seed: int = 42) -> Column:
    """A reproducible pseudo-random order: the md5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")).cast("binary"))


def sample_exact(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer), the same ones for the same seed.

    The sample never passes through a top-k in one task: the hash order is cut
    into 65,536 prefixes, whose counts tell which prefixes are wholly inside the
    sample.  Only the one prefix across the cut is ranked.  ``key`` must be unique.
    """
    order = sample_order(key, seed)
    prefixed = df.withColumn("_prefix", F.substring(order, 1, 4))
    taken, cut = 0, None
    for prefix, count in sorted(prefixed.groupBy("_prefix").count().collect()):
        if taken + count > n:
            cut = prefix
            break
        taken += count
    if cut is None:
        return df
    inside = prefixed.filter(F.col("_prefix") < cut)
    rest = prefixed.filter(F.col("_prefix") == cut).orderBy(order).limit(n - taken)
    return inside.unionByName(rest).drop("_prefix")


def sample_labels(df: DataFrame, label: str, n: int = 10, seed: int = 42) -> DataFrame:
    """``n`` distinct labels chosen at random; all of them if there are fewer."""
    return sample_exact(df.select(label).distinct(), n, label, seed)
