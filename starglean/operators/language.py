"""Language tagging with character-trigram profiles learned from labelled text.

Learning is a distributed count (explode, combine).  A model that fits
``MODEL_BYTES`` is shipped to the tasks, and scoring is a narrow Arrow function:
no shuffle in batch, no state in a stream.  A larger one stays a table, and
:func:`scores_by_join` meets it by a join.  All trigrams count, or the most
frequent ``features`` of each language if that is asked for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import costly, cut_lineage
from .filters import short_text_language

UNKNOWN = "unknown"
#: Most bytes of model shipped to the tasks.
MODEL_BYTES = 64 << 20
#: Characters scored at once.
LETTERS = 1 << 21


@dataclass(frozen=True)
class Profiles:
    """Sorted trigram codes, their log-probability gains over the floor, and the floor per language."""

    languages: list[str]
    codes: np.ndarray
    gains: np.ndarray
    floors: np.ndarray


def trigrams(text: Column) -> Column:
    """All overlapping character trigrams of the lower-cased text; each match moves on by one whole character."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?s)\G(?=(...))."), 1)


def _code(gram: str) -> int:
    """Three code points of 21 bits packed in one integer."""
    return sum(ord(c) << (21 * i) for i, c in enumerate(gram))


def profile_counts(df: DataFrame, text: str, lang: str = "lang", features: int | None = None) -> DataFrame:
    """``lang, gram, n, total``: the trigrams of each language, all or the ``features`` most frequent, and the language's total."""
    grams = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(trigrams(F.col(f"`{text}`"))).alias("gram"))
    counts = grams.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    if features is not None:
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
        counts = counts.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= features).drop("_r")
    return counts.join(totals, "lang")


def smoothing(counts: DataFrame, features: int | None) -> int:
    """What is added to each language's total: the features kept, or the distinct trigrams of all languages."""
    return features if features is not None else counts.agg(F.count_distinct("gram")).first()[0]


def train_profiles(df: DataFrame, text: str, lang: str = "lang", features: int | None = 2000) -> Profiles:
    """Add-one smoothed log-probabilities of the selected trigrams; None takes all."""
    languages = sorted(r[0] for r in df.select(lang).filter(F.col(lang).isNotNull()).distinct().collect())
    counts = cut_lineage(profile_counts(df, text, lang, features))
    return ship_profiles(counts, languages, smoothing(counts, features))


def ship_profiles(counts: DataFrame, languages: list[str], added: int) -> Profiles:
    """A counts table as arrays, if its distinct trigrams times languages fit ``MODEL_BYTES``."""
    size = counts.agg(F.count_distinct("gram")).first()[0]
    if (len(languages) + 1) * size * 8 > MODEL_BYTES:
        raise ValueError("the model is too large to ship; score by join or lower features")
    rows = counts.select("lang", "gram", "n", "total").toArrow()
    langs, grams = rows.column("lang").to_pylist(), rows.column("gram").to_pylist()
    totals = dict(zip(langs, rows.column("total").to_pylist()))
    floors = np.array([-math.log(totals.get(name, 0) + added) for name in languages])
    of_row = np.array([_code(g) for g in grams], dtype=np.uint64)
    codes = np.unique(of_row)
    gains = np.zeros((len(codes), len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    gains[np.searchsorted(codes, of_row), [place[name] for name in langs]] = np.log(rows.column("n").to_numpy() + 1.0)
    return Profiles(languages, codes, gains, floors)


def _flat_scores(texts: list[str], profiles: Profiles) -> np.ndarray:
    """Scores of some texts, their trigrams looked up in one pass; rows without a trigram are NaN."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    found = np.full((len(texts), len(profiles.languages)), np.nan)
    windows = np.maximum(lengths - 2, 0)
    if not windows.any() or not len(profiles.codes):
        return found
    # Windows that run into the next text are left out.
    row = np.repeat(np.arange(len(texts)), windows)
    first = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(np.cumsum(lengths) - lengths, windows)
    grams = points[first] | (points[first + 1] << np.uint64(21)) | (points[first + 2] << np.uint64(42))
    at = np.minimum(np.searchsorted(profiles.codes, grams), len(profiles.codes) - 1)
    hit = profiles.codes[at] == grams
    row, at = row[hit], at[hit]
    for i, floor in enumerate(profiles.floors):
        found[:, i] = np.bincount(row, weights=profiles.gains[at, i], minlength=len(texts)) + windows * floor
    found[windows == 0] = np.nan
    return found


def language_scores(text: Column, profiles: Profiles) -> Column:
    """Log-probability of the text under each language, in language order; null if it has no trigram."""

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def score(texts: pa.Array) -> pa.Array:
        out: list[list[float] | None] = []
        values = [t or "" for t in texts.to_pylist()]
        start = 0
        while start < len(values):
            # Some texts at a time, so that memory follows the longest text and not the batch.
            stop, size = start, 0
            while stop < len(values) and (stop == start or size + len(values[stop]) <= LETTERS):
                size += len(values[stop])
                stop += 1
            part = _flat_scores(values[start:stop], profiles)
            out += [None if np.isnan(s[:1]).any() or not len(s) else s for s in part]
            start = stop
        return pa.array([None if s is None else s.tolist() for s in out], pa.list_(pa.float64()))

    return costly(score)(F.lower(text))


def scores_by_join(df: DataFrame, key: str, text: str, counts: DataFrame, added: int) -> DataFrame:
    """``key, lang, score`` for a model of any size: the trigrams of all rows meet the counts table.

    Rows without a trigram have no score.  A frequent trigram is counted within
    its row first, and the join is one that adaptive execution can split.  The
    model's side has one row per trigram, so no row is multiplied by languages.
    """
    grams = df.select(key, F.explode(trigrams(F.col(f"`{text}`"))).alias("gram")).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("c"))
    totals = counts.groupBy("lang").agg(F.first("total").alias("total")).collect()
    # One row per trigram with its gains in all languages, so that a row's trigrams meet each one once.
    gain = lambda name: F.sum(F.when(F.col("lang") == name, F.log(F.col("n") + 1.0)))
    model = counts.groupBy("gram").agg(F.array(*[F.coalesce(gain(r["lang"]), F.lit(0.0)) for r in totals]).alias("gains"))
    met = grams.join(model, "gram", "left").groupBy(key).agg(
        F.sum("c").alias("m"), *[F.sum(F.col("c") * F.col("gains")[i]).alias(f"_gain{i}") for i in range(len(totals))])
    # Rows without a key have no gains: they meet no others.
    known = lambda i: F.coalesce(F.when(F.col(key).isNotNull(), F.col(f"_gain{i}")), F.lit(0.0))
    scores = [F.struct(F.lit(r["lang"]).alias("lang"), (known(i) + F.col("m") * F.lit(-math.log(r["total"] + added))).alias("score")) for i, r in enumerate(totals)]
    return met.select(key, F.inline(F.array(*scores)))


def tag_language(df: DataFrame, profiles: Profiles, text: str, min_tokens: int = 1, out: str = "lang") -> DataFrame:
    """Best language per row; too short, empty or unscorable rows are ``unknown``, each for itself."""
    names = F.array(*[F.lit(n) for n in profiles.languages])
    scored = df.withColumn("_scores", language_scores(F.col(f"`{text}`"), profiles))
    best = F.element_at(names, F.array_position("_scores", F.array_max("_scores")).cast("int"))
    tagged = F.when(F.col("_scores").isNotNull(), best).otherwise(F.lit(UNKNOWN))
    return scored.withColumn(out, short_text_language(tagged, F.col(f"`{text}`"), min_tokens)).drop("_scores")
