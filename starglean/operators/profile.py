"""Corpus profiling: null profile, value counts, summaries, histograms, character audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .ordering import percentiles


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, null count.  A single scan."""
    counts = df.agg(
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)], F.count(F.lit(1)).alias("n")
    )
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
            F.col(f"c{i}").alias("non_null"), (F.col("n") - F.col(f"c{i}")).alias("nulls"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ])
    return counts.select(F.inline(rows))


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows meeting each condition."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def value_counts(df: DataFrame, column: str, by_key: bool = False, out: str = "n") -> DataFrame:
    """Counts per non-null value, by falling count or in key order."""
    counts = df.filter(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(f"`{column}`") if by_key else counts.orderBy(F.desc(out), f"`{column}`")


def largest_count(df: DataFrame, column: str) -> DataFrame:
    return value_counts(df, column).agg(F.max("n").alias("largest"))


def group_sizes(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    return df.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias(out))


def describe(df: DataFrame, column: str, bounded_domain: bool = False) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max; quartiles are exact and interpolated.

    ``bounded_domain`` says the column has few distinct values (word counts,
    stars), so the built-in percentile's value-to-count buffer stays small.
    """
    value = F.col(f"`{column}`")
    basic = [
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
    ]
    names = ["q25", "q50", "q75"]
    if bounded_domain:
        return df.agg(*basic, *[F.percentile(value, F.lit(p)).alias(n) for n, p in zip(names, (0.25, 0.5, 0.75))])
    quartiles = {round(r["probability"], 2): r["value"] for r in percentiles(df, column, [0.25, 0.5, 0.75]).collect()}
    literals = [F.lit(quartiles.get(p)).cast("double").alias(n) for n, p in zip(names, (0.25, 0.5, 0.75))]
    return df.agg(*basic).select("*", *literals)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last bin closed; empty bins are kept.

    Two narrow passes: the two bounds are scalars, so binning needs no join.
    A constant column gets the range value ± 0.5.
    """
    value = F.col(f"`{column}`").cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    binned = df.filter(value.isNotNull()).groupBy(
        F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(binned, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def rare_characters(df: DataFrame, text: str, below: int = 50) -> DataFrame:
    """Characters that are neither letters nor numbers and occur fewer than ``below`` times.

    Letters and numbers are stripped before the explode, so only the few
    candidate characters become rows; counting combines map-side.
    """
    candidates = F.regexp_replace(F.col(f"`{text}`"), r"[\p{L}\p{N}]+", "")
    return _character_counts(df, candidates).filter(F.col("n") < below)


def top_non_ascii(df: DataFrame, text: str, k: int = 30) -> DataFrame:
    only = F.regexp_replace(F.col(f"`{text}`"), r"[\x00-\x7F]+", "")
    return _character_counts(df, only).orderBy(F.desc("n"), "ch").limit(k)


def _character_counts(df: DataFrame, text: Column) -> DataFrame:
    chars = df.select(F.explode(F.split(text, "")).alias("ch")).filter(F.col("ch") != "")
    return chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def clean_audit(df: DataFrame, text: str) -> DataFrame:
    """Row counts of everything cleaning should have removed; all checks in one scan."""
    c = F.col(f"`{text}`")
    return conditional_counts(
        df,
        digits=c.rlike(r"\p{Nd}"),
        punctuation=c.rlike(t.PUNCTUATION),
        extra_spaces=c.rlike(f"[{t.SPACES}]{{2,}}"),
        uppercase=c.rlike("[A-Z]"),
        control_chars=c.rlike(t.CONTROL_CHARS),
        urls=c.rlike(t.URLS),
        listed_chars=t.has_any_char(c),
        non_ascii=t.has_non_ascii(c),
    )


def cluster_noise_counts(df: DataFrame, label: str) -> DataFrame:
    """Number of clusters without noise, and number of noise rows."""
    c = F.col(label)
    return df.agg(
        F.count_distinct(F.when(c != -1, c)).alias("n_clusters"), F.count_if(c == -1).alias("n_noise")
    )
