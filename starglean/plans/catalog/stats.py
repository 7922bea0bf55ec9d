"""Aggregations, rating analysis, and the joins of small aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as t
from ...operators import analysis, filters, profile, sampling
from ...operators.ordering import percentiles
from ...schema import ITEM, KEY, SCORE, TEXT
from ...sources import views
from .registry import LABELLED, POINTS, RESULTS, REVIEWS, query, words


def _rated(spark, sf):
    return views.cluster_results(spark, sf).withColumnRenamed("cluster_kmeans", "cluster")


RATED = RESULTS + ", rated AS (SELECT review_id, cluster_kmeans AS cluster, rating, sentiment_score, cluster_dbscan FROM results)"


def _plain(spark, sf, spread=False):
    r = views.reviews(spark, sf, spread)
    return r.select(KEY, F.col(ITEM).alias("item"), F.col(f"`{SCORE}`").alias("score"), F.col(f"`{TEXT}`").alias("body"), "lang")


@query("c1_attach_cluster_stats", f"""WITH {RATED}, s AS (SELECT cluster, avg(rating) AS mean, stddev_samp(rating) AS std FROM rated GROUP BY cluster)
  SELECT review_id, cluster, rating, round(mean, 6) AS mean, round(std, 6) AS std, round(mean + 0.5 * std, 6) AS threshold,
         coalesce(rating > mean + 0.5 * std, FALSE) AS is_overrating FROM rated LEFT JOIN s USING (cluster)""")
def _(spark, sf):
    f = analysis.flag_overrating(_rated(spark, sf))
    return f.select(KEY, "cluster", "rating", *[F.round(c, 6).alias(c) for c in ("mean", "std", "threshold")], "is_overrating")


@query("c2_joined_summary", f"""WITH {RATED}, s AS (SELECT cluster, avg(rating) AS mean, stddev_samp(rating) AS std FROM rated GROUP BY cluster),
  f AS (SELECT rated.*, coalesce(rating > mean + 0.5 * std, FALSE) AS o FROM rated LEFT JOIN s USING (cluster))
  SELECT cluster, round(mean, 6) AS mean, round(std, 6) AS std, CAST(count(*) FILTER (o) AS BIGINT) AS overrating_count, count(rating) AS total_reviews
  FROM f JOIN s USING (cluster) GROUP BY cluster, mean, std""")
def _(spark, sf):
    j = analysis.joined_summary(_rated(spark, sf))
    return j.select("cluster", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "overrating_count", "total_reviews")


@query("c3_attach_by_key", f"""WITH {RESULTS}, {POINTS}
  SELECT review_id, rating, sentiment_score, cluster_kmeans, cluster_dbscan, CAST(len(vec) AS INTEGER) AS dims FROM results JOIN points USING (review_id)""")
def _(spark, sf):
    return views.cluster_results(spark, sf).join(views.points(spark, sf).select(KEY, F.size("vec").alias("dims")), KEY)


@query("c8_chosen_clusters", f"""WITH {RESULTS}, chosen AS (
    SELECT cluster_dbscan FROM (SELECT DISTINCT cluster_dbscan FROM results) ORDER BY md5('42:' || cluster_dbscan) LIMIT 4)
  SELECT review_id, cluster_dbscan FROM results WHERE cluster_dbscan IN (SELECT cluster_dbscan FROM chosen)""")
def _(spark, sf):
    rows = views.cluster_results(spark, sf)
    return filters.in_clusters(rows, sampling.sample_labels(rows, "cluster_dbscan", 4), "cluster_dbscan").select(KEY, "cluster_dbscan")


@query("d1_row_count", "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM documents")
def _(spark, sf):
    df = views.reviews(spark, sf)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


@query("d2_null_profile", f"""WITH {LABELLED}
  SELECT 'review_id' AS column_name, 'bigint' AS data_type, count(review_id) AS non_null, count(*) - count(review_id) AS nulls FROM labelled
  UNION ALL SELECT 'lang', 'string', count(lang), count(*) - count(lang) FROM labelled
  UNION ALL SELECT 'quality', 'int', count(quality), count(*) - count(quality) FROM labelled
  UNION ALL SELECT 'toxic', 'int', count(toxic), count(*) - count(toxic) FROM labelled""")
def _(spark, sf):
    return profile.null_profile(views.labelled_reviews(spark, sf).select(KEY, "lang", "quality", "toxic"))


@query("d3_conditional_counts", f"""WITH {LABELLED} SELECT count(*) FILTER (quality IS NULL) AS unlabelled,
  count(*) FILTER (lang = 'en') AS english, count(*) FILTER (regexp_matches(body, '[^\\x00-\\x7F]')) AS non_ascii FROM labelled""")
def _(spark, sf):
    return profile.conditional_counts(
        views.labelled_reviews(spark, sf), unlabelled=F.col("quality").isNull(), english=F.col("lang") == "en",
        non_ascii=t.has_non_ascii(F.col(f"`{TEXT}`")))


@query("d4_value_counts", f"WITH {LABELLED} SELECT quality, count(*) AS n FROM labelled WHERE quality IS NOT NULL GROUP BY quality ORDER BY n DESC, quality")
def _(spark, sf):
    return profile.value_counts(views.labelled_reviews(spark, sf), "quality")


@query("d5_value_counts_by_key", f"WITH {REVIEWS} SELECT score, count(*) AS n FROM reviews GROUP BY score ORDER BY score")
def _(spark, sf):
    return profile.value_counts(_plain(spark, sf), "score", by_key=True)


@query("d6_label_counts", f"WITH {RESULTS} SELECT cluster_dbscan, count(*) AS n FROM results GROUP BY cluster_dbscan ORDER BY cluster_dbscan")
def _(spark, sf):
    return profile.value_counts(views.cluster_results(spark, sf), "cluster_dbscan", by_key=True)


def _wide_sql(cell: str) -> str:
    return ", ".join(cell.format(r=r) + f" AS r{r}" for r in range(1, 6))


_COUNT = "count(*) FILTER (rating = {r})"


@query("d7_contingency", f"WITH {RATED} SELECT cluster, {_wide_sql(_COUNT)} FROM rated GROUP BY cluster")
def _(spark, sf):
    return analysis.contingency(_rated(spark, sf))


def _column_share(scale: float) -> str:
    cell = "round({s} * count(*) FILTER (rating = {{r}}) / (SELECT count(*) FROM rated WHERE rating = {{r}}), 6)".format(s=scale)
    return f"WITH {RATED} SELECT cluster, {_wide_sql(cell)} FROM rated GROUP BY cluster"


def _row_share(scale: float) -> str:
    cell = "round({s} * count(*) FILTER (rating = {{r}}) / count(*), 6)".format(s=scale)
    return f"WITH {RATED} SELECT cluster, {_wide_sql(cell)} FROM rated GROUP BY cluster"


def _share(within: str, scale: float):
    def build(spark, sf):
        wide = analysis.contingency_share(_rated(spark, sf), within=within, scale=scale)
        return wide.select("cluster", *[F.round(f"r{r}", 6).alias(f"r{r}") for r in range(1, 6)])

    return build


query("d8_contingency_column_share", _column_share(1.0))(_share("rating", 1.0))
query("d9_contingency_column_percent", _column_share(100.0))(_share("rating", 100.0))
query("d10_contingency_row_percent", _row_share(100.0))(_share("cluster", 100.0))
query("d11_cluster_rating_proportions", _row_share(1.0))(_share("cluster", 1.0))


@query("d12_cluster_rating_counts", f"WITH {RESULTS} SELECT cluster_dbscan AS cluster, {_wide_sql(_COUNT)} FROM results GROUP BY 1")
def _(spark, sf):
    return analysis.contingency(views.cluster_results(spark, sf), cluster="cluster_dbscan")


@query("d13_cluster_mean_std", f"WITH {RATED} SELECT cluster, round(avg(rating), 6) AS mean, round(stddev_samp(rating), 6) AS std FROM rated GROUP BY cluster")
def _(spark, sf):
    return analysis.cluster_stats(_rated(spark, sf)).select("cluster", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


_OVER = f"""WITH {RATED}, s AS (SELECT cluster, avg(rating) AS mean, stddev_samp(rating) AS std, count(rating) AS total_reviews FROM rated GROUP BY cluster),
  o AS (SELECT cluster, count(*) FILTER (rating > mean + 0.5 * std) AS overrating_count FROM rated JOIN s USING (cluster) GROUP BY cluster)"""


@query("d14_overrating_totals", f"{_OVER} SELECT cluster, overrating_count, total_reviews FROM s JOIN o USING (cluster)")
def _(spark, sf):
    return analysis.overrating_totals(analysis.flag_overrating(_rated(spark, sf)))


@query("d15_overrating_rate", f"""{_OVER} SELECT cluster, round(mean, 6) AS mean, round(std, 6) AS std, overrating_count, total_reviews,
  CAST(round_even(100.0 * overrating_count / total_reviews, 1) AS DOUBLE) AS overrating_pct FROM s JOIN o USING (cluster)""")
def overrating(spark, sf):
    rate = analysis.overrating_rate(_rated(spark, sf))
    return rate.select("cluster", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "overrating_count", "total_reviews", "overrating_pct")


@query("d15_overrating_rate_by_item", f"""WITH {REVIEWS}, s AS (SELECT item, avg(score) AS mean, stddev_samp(score) AS std, count(score) AS total_reviews FROM reviews GROUP BY item),
  o AS (SELECT item, count(*) FILTER (score > mean + 0.5 * std) AS overrating_count FROM reviews JOIN s USING (item) GROUP BY item)
  SELECT item AS cluster, overrating_count, total_reviews, CAST(round_even(100.0 * overrating_count / total_reviews, 1) AS DOUBLE) AS overrating_pct
  FROM s JOIN o USING (item)""")
def _(spark, sf):
    rate = analysis.overrating_rate(_plain(spark, sf), "item", "score")
    return rate.select("cluster", "overrating_count", "total_reviews", "overrating_pct")


@query("d16_distinct_count", f"WITH {REVIEWS} SELECT count(DISTINCT item) AS items, count(DISTINCT body) AS bodies FROM reviews")
def _(spark, sf):
    return _plain(spark, sf).agg(F.count_distinct("item").alias("items"), F.count_distinct("body").alias("bodies"))


@query("d17_group_sizes", f"WITH {REVIEWS} SELECT item, count(*) AS n FROM reviews GROUP BY item")
def _(spark, sf):
    return profile.group_sizes(_plain(spark, sf), "item")


def _describe_sql(source: str, column: str) -> str:
    q = ", ".join(f"round(quantile_cont({column}, {p}), 6) AS q{n}" for n, p in ((25, 0.25), (50, 0.5), (75, 0.75)))
    return f"""SELECT count({column}) AS count, round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
      CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, {q} FROM {source}"""


def _rounded(df):
    return df.select("count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max", "q25", "q50", "q75")])


@query("d18_describe_group_sizes", f"""WITH {REVIEWS}, g AS (SELECT item, CAST(count(*) AS DOUBLE) AS n FROM reviews GROUP BY item)
  {_describe_sql('g', 'n')}""")
def _(spark, sf):
    return _rounded(profile.describe(profile.group_sizes(_plain(spark, sf), "item"), "n"))


def _word_counts(spark, sf):
    return _plain(spark, sf, spread=True).select(KEY, t.word_count(F.col("body")).alias("n_words"))


WORD_COUNTS = f"{REVIEWS}, w AS (SELECT review_id, CAST(len({words('body')}) AS DOUBLE) AS n_words FROM reviews)"


@query("d18_describe_word_counts", f"WITH {WORD_COUNTS} {_describe_sql('w', 'n_words')}")
def _(spark, sf):
    return _rounded(profile.describe(_word_counts(spark, sf), "n_words", bounded_domain=True))


@query("d19_distinct_values", f"WITH {RESULTS} SELECT DISTINCT rating, cluster_dbscan FROM results ORDER BY rating, cluster_dbscan")
def _(spark, sf):
    return views.cluster_results(spark, sf).select("rating", "cluster_dbscan").distinct().orderBy("rating", "cluster_dbscan")


@query("d20_largest_count", f"WITH {REVIEWS} SELECT max(n) AS largest FROM (SELECT count(*) AS n FROM reviews GROUP BY score)")
def _(spark, sf):
    return profile.largest_count(_plain(spark, sf), "score")


@query("d21_percentiles", f"""WITH {RESULTS}, p(probability) AS (VALUES (0.9::DOUBLE), (0.95::DOUBLE))
  SELECT probability, round(CASE probability WHEN 0.9 THEN (SELECT quantile_cont(sentiment_score, 0.9) FROM results)
    ELSE (SELECT quantile_cont(sentiment_score, 0.95) FROM results) END, 6) AS value FROM p""")
def _(spark, sf):
    return percentiles(views.cluster_results(spark, sf), "sentiment_score", [0.9, 0.95]).select("probability", F.round("value", 6).alias("value"))


@query("d22_histogram", f"""WITH {WORD_COUNTS}, b AS (SELECT min(n_words) AS lo, max(n_words) AS hi FROM w),
  h AS (SELECT CAST(least(floor((n_words - lo) / ((hi - lo) / 50)), 49) AS INTEGER) AS bin, count(*) AS n FROM w, b GROUP BY 1)
  SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 50), 6) AS lower, round(lo + (i + 1) * ((hi - lo) / 50), 6) AS upper, coalesce(n, 0) AS n
  FROM range(50) g(i) CROSS JOIN b LEFT JOIN h ON h.bin = g.i""")
def _(spark, sf):
    h = profile.histogram(_word_counts(spark, sf), "n_words")
    return h.select("bin", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"), "n")


@query("d23_boxplot_stats", f"""WITH {RATED}, q AS (SELECT cluster, quantile_cont(sentiment_score, 0.25) AS q1, quantile_cont(sentiment_score, 0.5) AS median,
    quantile_cont(sentiment_score, 0.75) AS q3 FROM rated GROUP BY cluster),
  f AS (SELECT q.*, sentiment_score AS v, sentiment_score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM rated JOIN q USING (cluster))
  SELECT cluster, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    round(coalesce(min(v) FILTER (inside AND v <= q1), q1), 6) AS whisker_low, round(coalesce(max(v) FILTER (inside AND v >= q3), q3), 6) AS whisker_high,
    count(*) FILTER (NOT inside) AS outliers FROM f GROUP BY cluster, q1, median, q3""")
def _(spark, sf):
    b = analysis.boxplot_stats(_rated(spark, sf), "cluster", "sentiment_score")
    return b.select("cluster", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


@query("d24_rating_vs_sentiment", f"""WITH {RESULTS}, chosen AS (
    SELECT cluster_dbscan AS cluster FROM (SELECT DISTINCT cluster_dbscan FROM results WHERE cluster_dbscan <> -1) ORDER BY md5('42:' || cluster_dbscan) LIMIT 5),
  stars AS (SELECT DISTINCT CAST(rating AS INTEGER) AS rating FROM results WHERE cluster_dbscan <> -1)
  SELECT cluster, stars.rating, count(*) FILTER (r.rating = stars.rating) AS count_rating,
    count(*) FILTER (least(greatest(CAST(round_even(sentiment_score, 0) AS INTEGER), 1), 5) = stars.rating) AS count_sentiment
  FROM chosen CROSS JOIN stars LEFT JOIN results r ON r.cluster_dbscan = chosen.cluster GROUP BY cluster, stars.rating""")
def _(spark, sf):
    rows = filters.without_noise(views.cluster_results(spark, sf))
    return analysis.rating_vs_sentiment(rows, sampling.sample_labels(rows, "cluster_dbscan", 5))


@query("d25_language_stats", f"""WITH {REVIEWS} SELECT lang AS language, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
  FROM reviews GROUP BY lang ORDER BY count DESC, language""")
def _(spark, sf):
    return analysis.language_stats(views.reviews(spark, sf)).withColumn("percent", F.round("percent", 6))


@query("d26_language_totals", f"""WITH {REVIEWS} SELECT count(*) AS total, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'unknown') AS unknown,
  count(*) - count(*) FILTER (lang IN ('en', 'unknown')) AS non_en FROM reviews""")
def _(spark, sf):
    return analysis.language_totals(views.reviews(spark, sf))


@query("d31_cluster_noise_counts", f"""WITH {RESULTS} SELECT count(DISTINCT CASE WHEN cluster_dbscan <> -1 THEN cluster_dbscan END) AS n_clusters,
  count(*) FILTER (cluster_dbscan = -1) AS n_noise FROM results""")
def _(spark, sf):
    return profile.cluster_noise_counts(views.cluster_results(spark, sf), "cluster_dbscan")


@query("f3_largest_clusters", f"""WITH {REVIEWS}, c AS (SELECT item AS cluster, count(*) AS n FROM reviews GROUP BY item)
  SELECT cluster, n, greatest((SELECT count(*) FROM c) - 10, 0) AS remaining FROM c ORDER BY n DESC, cluster LIMIT 10""")
def _(spark, sf):
    return analysis.largest_clusters(_plain(spark, sf), "item")


@query("k3_multi_aggregate", f"""WITH {RATED} SELECT cluster, count(*) AS n, min(rating) AS low, max(rating) AS high, round(avg(rating), 6) AS mean,
  round(stddev_samp(sentiment_score), 6) AS std FROM rated GROUP BY cluster""")
def _(spark, sf):
    return _rated(spark, sf).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.min("rating").alias("low"), F.max("rating").alias("high"),
        F.round(F.avg("rating"), 6).alias("mean"), F.round(F.stddev_samp("sentiment_score"), 6).alias("std"))
