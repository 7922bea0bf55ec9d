"""Row checks shared by batch and stream jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CLEAN, SCORE


def split_bad_rows(df: DataFrame, text: str = CLEAN, score: str = SCORE) -> DataFrame:
    """Add ``_error``: why a row cannot be processed, or null.  One bad row spoils no other."""
    as_number = F.col(f"`{score}`").try_cast("double")
    reason = (
        F.when(F.col(f"`{text}`").isNull(), "missing text")
        .when(F.col(f"`{score}`").isNull(), "missing score")
        .when(as_number.isNull(), "score is not a number")
    )
    return df.withColumn("_error", reason)
