"""Ratings against clusters: contingency tables, over-rating, box plots, language totals.

Everything starts from (cluster, rating) counts: one map-side-combined shuffle
whose result has clusters x star values rows, however many reviews a hot
cluster holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import sentiment_category
from ..session import join_small
from .filters import exceeds, in_clusters
from .ordering import percentiles

STARS = (1, 2, 3, 4, 5)


def rating_counts(df: DataFrame, cluster: str = "cluster", rating: str = "rating") -> DataFrame:
    """Long contingency table: ``cluster``, ``rating``, ``n``; null ratings and clusters are skipped."""
    return (
        df.select(F.col(cluster).alias("cluster"), F.col(rating).alias("rating"))
        .na.drop().groupBy("cluster", "rating").agg(F.count(F.lit(1)).alias("n"))
    )


def contingency(df: DataFrame, cluster: str = "cluster", rating: str = "rating", ratings: Sequence = STARS) -> DataFrame:
    """Wide counts, one column ``r<rating>`` per star, absent combinations 0; any other rating raises."""
    return _widen(_on_scale(rating_counts(df, cluster, rating), ratings), "n", ratings, fill=0)


def contingency_share(
    df: DataFrame, cluster: str = "cluster", rating: str = "rating", within: str = "rating",
    scale: float = 1.0, ratings: Sequence = STARS,
) -> DataFrame:
    """Wide shares of each cell within its rating column or its cluster row.

    Absent combinations are 0, but a rating nobody gave has no share at all (null).
    """
    counts = _on_scale(rating_counts(df, cluster, rating), ratings)
    total = F.sum("n").over(Window.partitionBy(within))
    shares = counts.withColumn("share", F.col("n") / total * F.lit(scale))
    wide = _widen(shares, "share", ratings, fill=0.0)
    if within != "rating":
        return wide
    given = {row[0] for row in counts.filter(F.col("rating").isin(list(ratings))).select("rating").distinct().collect()}
    return wide.select(
        "cluster", *[(F.col(f"r{r}") if r in given else F.lit(None).cast("double")).alias(f"r{r}") for r in ratings]
    )


def _on_scale(counts: DataFrame, ratings: Sequence) -> DataFrame:
    """``counts`` as they are; a rating without a column of its own raises when it is met."""
    odd = F.raise_error(F.concat(F.lit("not on the rating scale: "), F.col("rating").cast("string"))).cast("bigint")
    return counts.withColumn("n", F.when(F.col("rating").isin(list(ratings)), F.col("n")).otherwise(odd))


def _widen(counts: DataFrame, value: str, ratings: Sequence, fill: float) -> DataFrame:
    wide = counts.groupBy("cluster").pivot("rating", list(ratings)).agg(F.first(value))
    return wide.select("cluster", *[F.coalesce(F.col(f"`{r}`"), F.lit(fill)).alias(f"r{r}") for r in ratings])


def cluster_stats(df: DataFrame, cluster: str = "cluster", rating: str = "rating") -> DataFrame:
    """Mean and sample standard deviation; the deviation of a single review is null.

    As in :func:`rating_counts`, rows whose cluster or rating is null or NaN take no part.
    """
    return df.na.drop(subset=[cluster, rating]).groupBy(F.col(cluster).alias("cluster")).agg(
        F.avg(rating).alias("mean"), F.stddev_samp(rating).alias("std")
    )


def flag_overrating(df: DataFrame, cluster: str = "cluster", rating: str = "rating", k: float = 0.5) -> DataFrame:
    """Each row with its cluster's mean, std, the threshold mean + k std, and whether it exceeds it."""
    rows = df if cluster == "cluster" else df.withColumnRenamed(cluster, "cluster")
    flagged = join_small(rows, cluster_stats(rows, "cluster", rating), "cluster", "left")
    flagged = flagged.withColumn("threshold", F.col("mean") + F.lit(k) * F.col("std"))
    return flagged.withColumn("is_overrating", exceeds(F.col(rating), F.col("threshold")))


def overrating_totals(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("cluster").agg(
        F.count_if("is_overrating").alias("overrating_count"), F.count("rating").alias("total_reviews")
    )


def overrating_rate(df: DataFrame, cluster: str = "cluster", rating: str = "rating", k: float = 0.5) -> DataFrame:
    """Share of reviews rated above mean + k std of their cluster, in percent with one decimal.

    Works on (cluster, rating, n): the reviews themselves are shuffled zero
    times, and the windows see one row per star value of a cluster.
    """
    counts = rating_counts(df, cluster, rating)
    group = Window.partitionBy("cluster")
    n, r = F.col("n"), F.col("rating").cast("double")
    with_mean = counts.withColumn("total_reviews", F.sum(n).over(group)).withColumn(
        "mean", F.sum(n * r).over(group) / F.col("total_reviews")
    )
    squares = F.sum(n * (r - F.col("mean")) * (r - F.col("mean"))).over(group)
    with_std = with_mean.withColumn("std", F.sqrt(F.try_divide(squares, F.col("total_reviews") - 1)))
    over = F.sum(F.when(exceeds(r, F.col("mean") + F.lit(k) * F.col("std")), n).otherwise(0))
    result = with_std.groupBy("cluster").agg(
        F.first("mean").alias("mean"), F.first("std").alias("std"),
        over.alias("overrating_count"), F.first("total_reviews").alias("total_reviews"),
    )
    percent = F.bround(F.col("overrating_count") / F.col("total_reviews") * 100, 1)
    return result.withColumn("overrating_pct", percent)


def joined_summary(df: DataFrame, cluster: str = "cluster", rating: str = "rating") -> DataFrame:
    """The same summary as a chain of joins of per-cluster aggregates."""
    flagged = flag_overrating(df, cluster, rating)
    totals = flagged.groupBy("cluster").agg(F.count("rating").alias("total_reviews"))
    over = flagged.groupBy("cluster").agg(F.count_if("is_overrating").alias("overrating_count"))
    rows = df if cluster == "cluster" else df.withColumnRenamed(cluster, "cluster")
    return cluster_stats(rows, "cluster", rating).join(over, "cluster").join(totals, "cluster")


def largest_clusters(df: DataFrame, label: str, k: int = 10) -> DataFrame:
    """The k largest clusters with their sizes and the number of clusters left out."""
    counts = df.groupBy(F.col(label).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    clusters = counts.count()
    top = counts.orderBy(F.desc("n"), "cluster").limit(k)
    return top.withColumn("remaining", F.lit(max(clusters - k, 0)).cast("bigint"))


def boxplot_stats(df: DataFrame, cluster: str, value: str) -> DataFrame:
    """Quartiles, whiskers at the outermost points within 1.5 IQR of the box, and the outlier count."""
    rows = df.select(F.col(cluster).alias("cluster"), F.col(value).cast("double").alias("v")).na.drop()
    long = percentiles(rows, "v", [0.25, 0.5, 0.75], by=["cluster"])
    pick = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    box = long.groupBy("cluster").agg(pick(0.25).alias("q1"), pick(0.5).alias("median"), pick(0.75).alias("q3"))
    fenced = join_small(rows, box, "cluster").withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    inside = F.col("v").between(F.col("q1") - F.col("reach"), F.col("q3") + F.col("reach"))
    stats = fenced.groupBy("cluster", "q1", "median", "q3").agg(
        F.min(F.when(inside & (F.col("v") <= F.col("q1")), F.col("v"))).alias("low"),
        F.max(F.when(inside & (F.col("v") >= F.col("q3")), F.col("v"))).alias("high"),
        F.count_if(~inside).alias("outliers"),
    )
    return stats.select(
        "cluster", "q1", "median", "q3",
        F.coalesce("low", "q1").alias("whisker_low"), F.coalesce("high", "q3").alias("whisker_high"), "outliers",
    )


def rating_vs_sentiment(
    df: DataFrame, chosen: DataFrame, cluster: str = "cluster_dbscan", rating: str = "rating",
    sentiment: str = "sentiment_score",
) -> DataFrame:
    """For each rating and chosen cluster: rows rated so, and rows whose sentiment category says so.

    Both counts come from one pass that turns a row into its two (class, kind)
    pairs; the zero-filled grid is each chosen cluster times the ratings present.
    """
    rows = in_clusters(df, chosen, cluster)
    pairs = rows.select(
        F.col(cluster).alias("cluster"),
        F.inline(F.array(
            F.struct(_whole(rating).alias("rating"), F.lit(1).alias("by_rating"), F.lit(0).alias("by_sentiment")),
            F.struct(sentiment_category(F.col(sentiment)).alias("rating"), F.lit(0).alias("by_rating"), F.lit(1).alias("by_sentiment")),
        )),
    )
    counts = pairs.groupBy("cluster", "rating").agg(
        F.sum("by_rating").alias("count_rating"), F.sum("by_sentiment").alias("count_sentiment")
    )
    stars = sorted(r[0] for r in pairs.filter("by_rating = 1 and rating is not null").select("rating").distinct().collect())
    grid = chosen.select(F.col(cluster).alias("cluster"), F.explode(F.array(*map(F.lit, stars))).alias("rating"))
    return grid.join(counts, ["cluster", "rating"], "left").na.fill(0, ["count_rating", "count_sentiment"])


def _whole(rating: str) -> Column:
    """A rating as a whole number of stars; half stars raise instead of being cut."""
    value = F.col(rating)
    odd = F.raise_error(F.concat(F.lit("not a whole rating: "), value.cast("string"))).cast("int")
    return F.when(value.isNull() | F.isnan(value.cast("double")), None).when(value.cast("double") == F.floor(value.cast("double")), value.cast("int")).otherwise(odd)


def language_stats(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Count and percent per language; the total is taken over the language counts, not the rows."""
    counts = df.groupBy(F.col(lang).alias("language")).agg(F.count(F.lit(1)).alias("count"))
    everything = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percent", F.col("count") / everything * 100).orderBy(F.desc("count"), "language")


def language_totals(df: DataFrame, lang: str = "lang") -> DataFrame:
    c = F.col(lang)
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(c == "en").alias("en"), F.count_if(c == "unknown").alias("unknown"))
    return counts.withColumn("non_en", F.col("total") - F.col("en") - F.col("unknown"))
