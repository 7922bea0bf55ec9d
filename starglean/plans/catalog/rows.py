"""Scans, projections, predicates, ordered positions, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as t
from ...functions.vectors import sentiment_category
from ...operators import filters, ordering, profile, sampling
from ...schema import ITEM, KEY, SCORE, TEXT
from ...sources import files, views
from .registry import LABELLED, RESULTS, REVIEWS, WS, clean, query, words


@query("a5_parquet_folder_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    return files.read_parquet_folder(spark, sf, "documents.parquet")


@query("a7_pruned_scan", f"""WITH {RESULTS}
  SELECT r.review_id, r.rating, round(r.sentiment_score, 6) AS sentiment_score, len(e.embedding) AS dims,
         round(CAST(e.embedding[1] AS DOUBLE), 6) AS first_component
  FROM results r JOIN embeddings e ON r.review_id = e.vec_id""")
def _(spark, sf):
    vectors = views.points(spark, sf).select(KEY, F.size("vec").cast("bigint").alias("dims"), F.round(F.col("vec")[0], 6).alias("first_component"))
    meta = views.cluster_results(spark, sf).select(KEY, "rating", F.round("sentiment_score", 6).alias("sentiment_score"))
    return meta.join(vectors, KEY)


@query("a8_full_scan", "SELECT page_id, url, html FROM pages")
def _(spark, sf):
    return views.table(spark, sf, "pages")


@query("a17_typed_table", f"""WITH {REVIEWS}
  SELECT review_id, CAST(item AS VARCHAR) AS row_id, score, body AS clean_text, CAST(length(body) AS FLOAT) AS size
  FROM reviews""")
def _(spark, sf):
    r = views.reviews(spark, sf)
    return r.select(
        KEY, F.col(ITEM).cast("string").alias("row_id"), F.col(f"`{SCORE}`").cast("string").try_cast("double").alias("score"),
        F.col(f"`{TEXT}`").alias("clean_text"), F.length(f"`{TEXT}`").cast("float").alias("size"),
    )


@query("b1_column_subset", f"WITH {REVIEWS} SELECT item, score, body FROM reviews")
def _(spark, sf):
    kept = filters.keep_columns(views.reviews(spark, sf), ITEM, SCORE, TEXT)
    return kept.toDF("item", "score", "body")


@query("b2_drop_missing", f"WITH {LABELLED} SELECT review_id, score, quality FROM labelled WHERE quality IS NOT NULL AND score IS NOT NULL")
def _(spark, sf):
    kept = filters.drop_missing(views.labelled_reviews(spark, sf), "quality", SCORE)
    return kept.select(KEY, F.col(f"`{SCORE}`").alias("score"), "quality")


def _cleaned(spark, sf):
    return views.reviews(spark, sf, spread=True).withColumn("cleanText", t.clean_text(F.col(f"`{TEXT}`")))


@query("b3_drop_uncleaned", f"""WITH {REVIEWS}, cleaned AS (SELECT review_id, {clean('body')} AS c FROM reviews)
  SELECT 'parity' AS mode, count(*) AS n FROM cleaned WHERE c IS NOT NULL
  UNION ALL SELECT 'drop_empty', count(*) FROM cleaned WHERE c IS NOT NULL AND c <> ''""")
def _(spark, sf):
    df = _cleaned(spark, sf)
    count = lambda mode, d: d.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"))
    return count("parity", filters.drop_uncleaned(df)).unionByName(
        count("drop_empty", filters.drop_uncleaned(df, drop_empty=True)))


@query("b4_blank_text", f"""SELECT conv_id, turn, (text IS NULL OR regexp_replace(text, '[{WS}]+', '', 'g') = '') AS is_blank
  FROM conversations""")
def _(spark, sf):
    return views.table(spark, sf, "conversations").select("conv_id", "turn", t.is_blank(F.col("text")).alias("is_blank"))


@query("b5_ascii_only", f"""WITH {REVIEWS} SELECT review_id, score FROM reviews
  WHERE NOT regexp_matches({clean('body')}, '[^\\x00-\\x7F]')""")
def _(spark, sf):
    return filters.ascii_only(_cleaned(spark, sf)).select(KEY, F.col(f"`{SCORE}`").alias("score"))


@query("b6_language_filter", f"WITH {REVIEWS} SELECT review_id, lang, lang = 'unknown' AS is_unknown FROM reviews WHERE lang = 'en'")
def _(spark, sf):
    return filters.in_language(views.reviews(spark, sf)).select(KEY, "lang", (F.col("lang") == "unknown").alias("is_unknown"))


@query("b7_length_bands", f"""WITH {REVIEWS}, sized AS (SELECT review_id, len({words('body')}) AS n_words FROM reviews)
  SELECT review_id, n_words, CASE WHEN n_words < 2 THEN 'one' WHEN n_words < 5 THEN 'short' ELSE 'long' END AS band
  FROM sized WHERE n_words < 5 OR n_words > 5000""")
def _(spark, sf):
    n = F.col("n_words")
    sized = views.reviews(spark, sf, spread=True).select(KEY, t.word_count(F.col(f"`{TEXT}`")).cast("bigint").alias("n_words"))
    return sized.filter((n < 5) | (n > 5000)).withColumn("band", F.when(n < 2, "one").when(n < 5, "short").otherwise("long"))


@query("b8_changed_rows", f"WITH {REVIEWS} SELECT review_id FROM reviews WHERE {clean('body')} IS DISTINCT FROM body")
def _(spark, sf):
    return filters.changed_rows(_cleaned(spark, sf), TEXT, "cleanText").select(KEY)


@query("b9_without_noise", f"WITH {RESULTS} SELECT review_id, rating, cluster_dbscan FROM results WHERE cluster_dbscan <> -1")
def _(spark, sf):
    return filters.without_noise(views.cluster_results(spark, sf)).select(KEY, "rating", "cluster_dbscan")


@query("b10_short_text_language", f"""WITH {REVIEWS}
  SELECT review_id, CASE WHEN len({words('body')}) < 20 THEN 'unknown' ELSE lang END AS lang FROM reviews""")
def _(spark, sf):
    lang = filters.short_text_language(F.col("lang"), F.col(f"`{TEXT}`"), min_tokens=20)
    return views.reviews(spark, sf, spread=True).select(KEY, lang.alias("lang"))


@query("b11_casts", f"""WITH {RESULTS}
  SELECT review_id, CAST(rating AS VARCHAR) AS rating_text, CAST(rating AS DOUBLE) AS rating_double,
         CAST(trunc(sentiment_score) AS INTEGER) AS score_int, TRY_CAST(CAST(cluster_dbscan AS VARCHAR) AS INTEGER) AS label
  FROM results""")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(
        KEY, F.col("rating").cast("string").alias("rating_text"), F.col("rating").cast("double").alias("rating_double"),
        F.col("sentiment_score").cast("int").alias("score_int"), F.col("cluster_dbscan").cast("string").try_cast("int").alias("label"))


@query("b12_null_fill", f"WITH {LABELLED} SELECT review_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM labelled")
def _(spark, sf):
    return views.labelled_reviews(spark, sf).select(KEY, "quality", "toxic").na.fill({"quality": -1, "toxic": 0})


@query("b13_arithmetic", f"""WITH {RESULTS}
  SELECT review_id, cluster_kmeans + 1 AS cluster, round(rating + 0.5 * sentiment_score, 6) AS threshold FROM results""")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(
        KEY, (F.col("cluster_kmeans") + 1).alias("cluster"),
        F.round(F.col("rating") + F.lit(0.5) * F.col("sentiment_score"), 6).alias("threshold"))


@query("b14_flag_null_is_false", f"""WITH {LABELLED}
  SELECT review_id, coalesce(score > 2 + 2 * quality, FALSE) AS flag FROM labelled""")
def _(spark, sf):
    return views.labelled_reviews(spark, sf).select(
        KEY, filters.exceeds(F.col(f"`{SCORE}`"), 2 + 2 * F.col("quality")).alias("flag"))


@query("b15_either_predicate", f"""WITH {REVIEWS}
  SELECT review_id FROM reviews WHERE contains(body, '|') OR contains(body, '"')""")
def _(spark, sf):
    c = F.col(f"`{TEXT}`")
    return views.reviews(spark, sf).filter(c.contains("|") | c.contains('"')).select(KEY)


@query("b16_listed_characters", f"""WITH {REVIEWS}
  SELECT review_id, regexp_matches(body, '[\\x{{a}}\\x{{7c}}\\x{{23}}]') AS found FROM reviews""")
def _(spark, sf):
    return views.reviews(spark, sf).select(KEY, t.has_any_char(F.col(f"`{TEXT}`"), ["\n", "|", "#"]).alias("found"))


@query("b17_literal_substring", "SELECT page_id AS review_id FROM pages WHERE contains(html, '&amp;')")
def _(spark, sf):
    return views.html_text(spark, sf).filter(F.col(f"`{TEXT}`").contains("&amp;")).select(KEY)


@query("b18_result_columns", f"""WITH {RESULTS}
  SELECT review_id AS row_id, CAST(rating AS DOUBLE) AS stars, cluster_kmeans AS cluster FROM results""")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(
        F.col(KEY).alias("row_id"), F.col("rating").cast("double").alias("stars"), F.col("cluster_kmeans").alias("cluster"))


@query("b19_row_slice", f"WITH {REVIEWS} SELECT review_id, item FROM reviews ORDER BY review_id LIMIT 5 OFFSET 70")
def _(spark, sf):
    return ordering.slice_rows(views.reviews(spark, sf).select(KEY, F.col(ITEM).alias("item")), [KEY], 70, 75)


@query("e1_label_index", f"""WITH {RESULTS}
  SELECT review_id, cluster_dbscan, CAST(dense_rank() OVER (ORDER BY cluster_dbscan) - 1 AS INTEGER) AS label_index FROM results""")
def _(spark, sf):
    from ...session import join_small

    rows = views.cluster_results(spark, sf).select(KEY, "cluster_dbscan")
    return join_small(rows, ordering.label_index(rows, "cluster_dbscan"), "cluster_dbscan")


@query("e3_every_tenth_label", f"""WITH {REVIEWS}, c AS (SELECT item, count(*) AS n FROM reviews GROUP BY item)
  SELECT item, n, (row_number() OVER (ORDER BY item) - 1) % 10 = 0 AS is_marked FROM c""")
def _(spark, sf):
    counts = profile.value_counts(views.reviews(spark, sf).select(F.col(ITEM).alias("item")), "item", by_key=True)
    return ordering.every_nth(counts, "item", 10)


@query("e4_running_row_id", f"""WITH {REVIEWS}
  SELECT review_id, row_number() OVER (ORDER BY md5(body), review_id) AS position FROM reviews""")
def _(spark, sf):
    rows = views.reviews(spark, sf).select(KEY, F.md5(F.col(f"`{TEXT}`").cast("binary")).alias("h"))
    return ordering.global_row_number(rows, ["h", KEY]).select(KEY, "position")


@query("f1_sorted_rows", f"WITH {RESULTS} SELECT cluster_kmeans, rating, review_id FROM results ORDER BY cluster_kmeans DESC, rating, review_id")
def _(spark, sf):
    return views.cluster_results(spark, sf).select("cluster_kmeans", "rating", KEY).orderBy(F.desc("cluster_kmeans"), "rating", KEY)


@query("f2_first_rows", f"WITH {RESULTS} SELECT review_id, rating FROM results ORDER BY review_id LIMIT 10")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(KEY, "rating").orderBy(KEY).limit(10)


@query("f4_exact_sample", f"""WITH {REVIEWS}
  SELECT review_id, item FROM reviews ORDER BY md5('42:' || review_id) LIMIT 150""")
def _(spark, sf):
    rows = views.reviews(spark, sf).select(KEY, F.col(ITEM).alias("item"))
    return sampling.sample_exact(rows, 150, KEY, seed=42)


@query("f5_point_sample", """SELECT vec_id AS review_id, label FROM embeddings ORDER BY md5('7:' || vec_id) LIMIT 100""")
def _(spark, sf):
    rows = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias(KEY), "label")
    return sampling.sample_exact(rows, 100, KEY, seed=7)


@query("f6_sample_clusters", """SELECT label AS cluster FROM (SELECT DISTINCT label FROM embeddings) ORDER BY md5('42:' || label) LIMIT 5""")
def _(spark, sf):
    return sampling.sample_labels(views.table(spark, sf, "embeddings").select(F.col("label").alias("cluster")), "cluster", 5)


@query("f7_one_random_row", f"WITH {REVIEWS} SELECT review_id, body FROM reviews ORDER BY md5('42:' || review_id) LIMIT 1")
def _(spark, sf):
    return sampling.sample_exact(views.reviews(spark, sf).select(KEY, F.col(f"`{TEXT}`").alias("body")), 1, KEY)


@query("f8_bag_union", """SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark
  UNION ALL SELECT page_id, html FROM pages""")
def _(spark, sf):
    docs = views.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    items = views.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    pages = views.table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(items).unionByName(pages)


@query("h5_sentiment_category", f"""WITH {RESULTS}
  SELECT review_id, least(greatest(CAST(round_even(sentiment_score, 0) AS INTEGER), 1), 5) AS category FROM results""")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(KEY, sentiment_category(F.col("sentiment_score")).alias("category"))


@query("h6_one_decimal", f"WITH {RESULTS} SELECT review_id, CAST(round_even(sentiment_score * 0.37, 1) AS DOUBLE) AS rounded FROM results")
def _(spark, sf):
    return views.cluster_results(spark, sf).select(KEY, F.bround(F.col("sentiment_score") * F.lit(0.37), 1).alias("rounded"))
