"""Row predicates and conditional columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..schema import CLEAN, LANG


def keep_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def drop_missing(df: DataFrame, *names: str) -> DataFrame:
    """Drop rows where any named column is null or NaN."""
    return df.na.drop(subset=list(names))


def drop_uncleaned(df: DataFrame, column: str = CLEAN, drop_empty: bool = False) -> DataFrame:
    """Drop null texts.  Empty strings count as present unless ``drop_empty`` is set."""
    kept = drop_missing(df, column)
    return kept.filter(F.col(column) != "") if drop_empty else kept


def ascii_only(df: DataFrame, column: str = CLEAN) -> DataFrame:
    return df.filter(~t.has_non_ascii(F.col(column)))


def blank_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(t.is_blank(F.col(f"`{column}`")))


def in_language(df: DataFrame, language: str = "en") -> DataFrame:
    return df.filter(F.col(LANG) == language)


def changed_rows(df: DataFrame, before: str, after: str) -> DataFrame:
    """Rows that a cleaning step altered; null-safe."""
    return df.filter(~F.col(f"`{before}`").eqNullSafe(F.col(f"`{after}`")))


def short_text_language(language: Column, text: Column, min_tokens: int = 1) -> Column:
    """``unknown`` where the text has fewer than ``min_tokens`` words."""
    if min_tokens <= 0:
        return language
    return F.when(t.word_count(text) < min_tokens, F.lit("unknown")).otherwise(language)


def without_noise(df: DataFrame, label: str = "cluster_dbscan") -> DataFrame:
    return df.filter(F.col(label) != -1)


def exceeds(value: Column, threshold: Column) -> Column:
    """Comparison where an unknown threshold means False."""
    return F.coalesce(value > threshold, F.lit(False))


def in_clusters(df: DataFrame, chosen: DataFrame, label: str) -> DataFrame:
    """Rows whose cluster is in ``chosen``."""
    return df.join(chosen.select(label).distinct(), label, "left_semi")
