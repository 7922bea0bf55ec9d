"""Registered queries and, where SQL can say it, their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL fragments shared by the equivalents -------------------------------------------------

WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

REVIEWS = """reviews AS (
  SELECT doc_id AS review_id, source AS item, CAST(1 + n_chars % 5 AS DOUBLE) AS score, text AS body, lang
  FROM documents)"""

LABELLED = REVIEWS + """, labelled AS (
  SELECT r.*, l.quality, l.toxic FROM reviews r LEFT JOIN labels l ON r.review_id = l.doc_id)"""

RESULTS = """results AS (
  SELECT vec_id AS review_id, CAST(1 + (vec_id * 7 + label * 3) % 5 AS BIGINT) AS rating,
         CAST(0.25 + ((vec_id * 37) % 550) / 100.0 AS DOUBLE) AS sentiment_score,
         label AS cluster_kmeans, label - 1 AS cluster_dbscan
  FROM embeddings)"""

POINTS = "points AS (SELECT vec_id AS review_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"
POINTS2 = "points AS (SELECT vec_id AS review_id, CAST(embedding[1:2] AS DOUBLE[]) AS vec, label FROM embeddings)"


def sub(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def collapse(text: str) -> str:
    return f"trim({sub(text, f'[{WS}]+', ' ')}, ' ')"


def no_urls(text: str) -> str:
    return sub(text, f"http[^{WS}]+|www[^{WS}]+", "")


def no_controls(text: str) -> str:
    return sub(text, r"[\x00-\x1F\x7F]", "")


def breaks_to_space(text: str) -> str:
    return sub(text, r"[\r\n\t]+", " ")


def clean(text: str) -> str:
    return collapse(breaks_to_space(no_urls(no_controls(text))))


def no_punctuation(text: str) -> str:
    return sub(text, rf"[^\p{{L}}\p{{N}}_{WS}]", "")


def no_digits(text: str) -> str:
    return sub(text, r"\p{Nd}+", "")


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{WS}]+'), lambda w: w <> '')"


def no_stopwords(text: str) -> str:
    from ...functions.text import STOPWORDS

    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)
    return f"coalesce(array_to_string(list_filter({words(text)}, lambda s: s NOT IN ({stop})), ' '), '')"


def script_normal(text: str) -> str:
    return no_stopwords(collapse(no_digits(no_punctuation(f"lower({text})"))))
