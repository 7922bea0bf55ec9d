"""Sources and sinks, models, streams and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as t
from ...operators import analysis, encode, language
from ...schema import CLEAN, EMBEDDINGS, ITEM, KEY, RAW_REVIEWS, SCORE, SUMMARY, TEXT, USER, as_table
from ...session import cut_lineage, scratch_path
from ...sources import files, views
from ...streaming import reviews as streams
from .. import jobs
from . import registry as r
from .registry import REVIEWS, query


def _cleaned(spark, sf):
    rows = views.reviews(spark, sf, spread=True)
    return rows.select(KEY, ITEM, F.col(f"`{SCORE}`"), t.clean_text(F.col(f"`{TEXT}`"), newline_as_space=True).alias(CLEAN), "lang")


def _raw(spark, sf):
    """The raw review layout; the document number serves as item so rows can be told apart."""
    return views.reviews(spark, sf, spread=True).select(
        F.col(KEY).cast("string").alias(ITEM), F.col(f"`{SCORE}`"), F.lit("").alias(SUMMARY), F.col(f"`{TEXT}`"),
        F.col(ITEM).alias(USER))


def _csv(spark, df):
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    return path


@query("a1_csv_round_trip", f"WITH {REVIEWS} SELECT CAST(review_id AS VARCHAR) AS item, score, md5(body) AS digest FROM reviews")
def _(spark, sf):
    back = files.read_csv(spark, _csv(spark, _raw(spark, sf)), RAW_REVIEWS)
    return back.select(F.col(ITEM).alias("item"), F.col(f"`{SCORE}`").alias("score"), F.md5(F.col(f"`{TEXT}`").cast("binary")).alias("digest"))


@query("a2_csv_all_text", f"WITH {REVIEWS} SELECT CAST(review_id AS VARCHAR) AS item, '' AS summary, length(body) AS n_chars, item AS user_id FROM reviews")
def _(spark, sf):
    path = _csv(spark, _raw(spark, sf))
    back = files.read_csv_text(spark, files.require_path(spark, path), [ITEM, SCORE, SUMMARY, TEXT, USER])
    return back.select(F.col(ITEM).alias("item"), F.col(f"`{SUMMARY}`").alias("summary"),
                       F.length(f"`{TEXT}`").cast("bigint").alias("n_chars"), F.col(USER).alias("user_id"))


@query("a3_csv_typed_columns", f"WITH {r.RESULTS} SELECT CAST(review_id AS VARCHAR) AS row_id, rating, cluster_kmeans FROM results")
def _(spark, sf):
    rows = views.cluster_results(spark, sf).select(F.col(KEY).alias("row_id"), "rating", "cluster_kmeans")
    from pyspark.sql import types as T

    schema = T.StructType().add("row_id", T.StringType()).add("rating", T.LongType()).add("cluster_kmeans", T.IntegerType())
    return files.read_csv(spark, _csv(spark, rows), schema)


@query("a4_required_columns", "SELECT count(*) AS n FROM documents")
def _(spark, sf):
    return files.require_columns(views.reviews(spark, sf), ITEM, SCORE, TEXT).agg(F.count(F.lit(1)).alias("n"))


def _parts(spark, sf, parts=4):
    """Cluster results as a folder of key-ordered part files."""
    path = scratch_path(spark, "parts")
    files.write_parquet(views.cluster_results(spark, sf).repartitionByRange(parts, KEY), path, "zstd")
    return path


@query("a6_first_files")
def _(spark, sf):
    return files.first_files(spark, _parts(spark, sf), 2)


@query("a10_csv_append", f"WITH {r.RESULTS} SELECT review_id, rating FROM results WHERE rating > 2 UNION ALL SELECT review_id, rating FROM results WHERE rating <= 2")
def _(spark, sf):
    from pyspark.sql import types as T

    rows, path = views.cluster_results(spark, sf).select(KEY, "rating"), scratch_path(spark, "csv")
    files.write_csv(rows.filter("rating > 2"), path)
    files.write_csv(rows.filter("rating <= 2"), path, mode="append")
    return files.read_csv(spark, path, T.StructType().add(KEY, T.LongType()).add("rating", T.LongType()))


@query("a9_csv_sink", f"WITH {r.RESULTS} SELECT review_id, rating, cluster_dbscan FROM results")
def _(spark, sf):
    from pyspark.sql import types as T

    rows = views.cluster_results(spark, sf).select(KEY, "rating", "cluster_dbscan")
    schema = T.StructType().add(KEY, T.LongType()).add("rating", T.LongType()).add("cluster_dbscan", T.IntegerType())
    return files.read_csv(spark, _csv(spark, rows), schema)


@query("a11_parquet_codecs", f"WITH {r.RESULTS} SELECT codec, count(*) AS n, sum(rating)::BIGINT AS stars FROM results, (VALUES ('snappy'), ('gzip'), ('zstd'), ('none')) c(codec) GROUP BY codec")
def _(spark, sf):
    frames = []
    for codec in ("snappy", "gzip", "zstd", "none"):
        path = scratch_path(spark, codec)
        files.write_parquet(views.cluster_results(spark, sf), path, codec)
        frames.append(spark.read.parquet(path).agg(F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars")))
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other)
    return first


@query("a12_rerun_partition", f"WITH {r.RESULTS} SELECT rating, count(*) AS n FROM results GROUP BY rating")
def _(spark, sf):
    rows, path = views.cluster_results(spark, sf), scratch_path(spark, "published")
    files.publish_partition(rows, path, "rating")
    files.publish_partition(rows.filter("rating >= 3"), path, "rating")
    return spark.read.parquet(path).groupBy(F.col("rating").cast("bigint").alias("rating")).agg(F.count(F.lit(1)).alias("n"))


@query("a13_resume_pending", f"WITH {r.RESULTS} SELECT review_id FROM results WHERE rating <= 3")
def _(spark, sf):
    rows, path = views.cluster_results(spark, sf), scratch_path(spark, "written")
    files.write_parquet(rows.filter("rating > 3"), path)
    return files.pending_rows(rows, spark.read.parquet(path)).select(KEY)


@query("a14_part_audit", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM embeddings")
def _(spark, sf):
    return files.part_audit(spark, _parts(spark, sf)).agg(F.sum("n_rows").alias("n_rows"))


@query("a14_part_audit_rows")
def _(spark, sf):
    return files.part_audit(spark, _parts(spark, sf)).select("part", "n_rows", "created")


@query("a15_run_summary", "SELECT count(*) AS total, count(*) AS written, CAST(0 AS BIGINT) AS failed, CAST(4 AS BIGINT) AS parts FROM embeddings")
def _(spark, sf):
    return files.run_summary(spark, _parts(spark, sf), views.cluster_results(spark, sf).count())


@query("a16_parquet_magic", """SELECT unnest(string_split('region nation customer supplier part orders lineitem events documents embeddings
  pages benchmark labels conversations', ' ')) || '.parquet' AS file_name, TRUE AS intact""".replace("\n ", ""))
def _(spark, sf):
    return files.parquet_magic_check(spark, sf)


@query("g19_part_number")
def _(spark, sf):
    return spark.read.parquet(_parts(spark, sf)).select(t.part_number(F.col("_metadata.file_name")).alias("part")).groupBy("part").count()


# --- language ----------------------------------------------------------------------------------

_FEATURES = 300


def _scores_sql(features: int | None) -> str:
    """Scores by the most frequent trigrams of each language, or by all."""
    top = "SELECT * FROM counts" if features is None else (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS k FROM counts) WHERE k <= {features}")
    added = "(SELECT count(DISTINCT gram) FROM counts)" if features is None else features
    return f"""{REVIEWS}, low AS (SELECT review_id, lang, lower(body) AS s FROM reviews),
  chars AS (SELECT review_id, lang, string_split(s, '') AS c FROM low),
  grams AS (SELECT review_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram FROM chars),
  counts AS (SELECT lang, gram, count(*) AS n FROM grams GROUP BY lang, gram),
  totals AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
  top AS ({top}),
  sizes AS (SELECT review_id, gram, count(*) AS c FROM grams GROUP BY review_id, gram),
  gains AS (SELECT review_id, top.lang, sum(c * ln(n + 1)) AS gain FROM sizes JOIN top USING (gram) GROUP BY review_id, top.lang),
  lens AS (SELECT review_id, length(s) - 2 AS m FROM low WHERE length(s) > 2),
  scores AS (SELECT review_id, t.lang, coalesce(gain, 0) - m * ln(total + {added}) AS score FROM lens CROSS JOIN totals t LEFT JOIN gains USING (review_id, lang))"""


_SCORES, _ALL_SCORES = _scores_sql(_FEATURES), _scores_sql(None)


def _profiles(spark, sf, features=_FEATURES):
    return language.train_profiles(views.reviews(spark, sf, spread=True), TEXT, features=features)


@query("i1_language_scores", f"WITH {_SCORES} SELECT review_id, lang, round(score, 4) AS score FROM scores")
def _(spark, sf):
    p = _profiles(spark, sf)
    names = F.array(*[F.lit(n) for n in p.languages])
    scored = views.reviews(spark, sf, spread=True).select(KEY, language.language_scores(F.col(f"`{TEXT}`"), p).alias("s"))
    return scored.select(KEY, F.inline(F.arrays_zip(names.alias("lang"), F.col("s").alias("score")))).toDF(KEY, "lang", "score").withColumn("score", F.round("score", 4))


@query("i1_tag_language", f"WITH {_SCORES} SELECT review_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY score DESC, lang) AS k FROM scores) WHERE k = 1")
def _(spark, sf):
    return language.tag_language(views.reviews(spark, sf, spread=True).drop("lang"), _profiles(spark, sf), TEXT).select(KEY, "lang")


@query("i1_tag_language_all", f"WITH {_ALL_SCORES} SELECT review_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY score DESC, lang) AS k FROM scores) WHERE k = 1")
def _(spark, sf):
    """By all trigrams; the model is stored and read again, as a stream would."""
    path = scratch_path(spark, "profiles")
    files.write_parquet(language.profile_counts(views.reviews(spark, sf, spread=True), TEXT), path)
    counts = spark.read.parquet(path)
    names = sorted(row["lang"] for row in counts.select("lang").distinct().collect())
    profiles = language.ship_profiles(counts, names, language.smoothing(counts, None))
    return language.tag_language(views.reviews(spark, sf, spread=True).drop("lang"), profiles, TEXT).select(KEY, "lang")


@query("i1_scores_by_join", f"WITH {_ALL_SCORES} SELECT review_id, lang, round(score, 4) AS score FROM scores")
def _(spark, sf):
    rows = views.reviews(spark, sf, spread=True)
    counts = cut_lineage(language.profile_counts(rows, TEXT))
    return language.scores_by_join(rows.drop("lang"), KEY, TEXT, counts, language.smoothing(counts, None)).withColumn("score", F.round("score", 4))


# --- encoders ----------------------------------------------------------------------------------

@query("i2_hash_embedding", f"""WITH {REVIEWS}, tok AS (SELECT review_id, unnest({r.words('lower(body)')}) AS w FROM reviews),
  h AS (SELECT review_id, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM tok),
  b AS (SELECT review_id, h % 32 AS pos, sum(CASE WHEN (h // 32) % 2 = 0 THEN 1 ELSE -1 END) AS x FROM h GROUP BY 1, 2),
  n AS (SELECT review_id, sqrt(sum(x * x)) AS size FROM b GROUP BY 1)
  SELECT review_id, CAST(i AS INTEGER) AS pos, round(coalesce(x / CASE WHEN size = 0 THEN 1 ELSE size END, 0), 4) + 0.0 AS x
  FROM reviews CROSS JOIN range(32) g(i) LEFT JOIN b ON b.review_id = reviews.review_id AND b.pos = i LEFT JOIN n ON n.review_id = reviews.review_id""".replace("SELECT review_id, CAST(i", "SELECT reviews.review_id AS review_id, CAST(i"))
def _(spark, sf):
    rows = views.reviews(spark, sf, spread=True).select(KEY, encode.hash_embedding(F.col(f"`{TEXT}`"), 32).alias("v"))
    return rows.select(KEY, F.posexplode("v").alias("pos", "x")).withColumn("x", F.round(F.col("x").cast("double"), 4) + 0.0)


class TokenStatistics:
    """A stand-in for a user's model: batch of texts in, three numbers per text out."""

    def __call__(self):
        import numpy as np

        return lambda texts: np.array([[len(s), s.count(" ") + 1, s.count("e")] for s in texts], dtype=np.float32)


@query("k2_batch_model", f"WITH {REVIEWS} SELECT review_id, length(body)::DOUBLE AS n_chars, (length(body) - length(replace(body, 'e', '')))::DOUBLE AS n_e FROM reviews")
def _(spark, sf):
    rows = encode.embed_text(views.reviews(spark, sf, spread=True), TEXT, encoder=TokenStatistics())
    return rows.select(KEY, F.col("embedding")[0].cast("double").alias("n_chars"), F.col("embedding")[2].cast("double").alias("n_e"))


def _class_model(spark, sf):
    # Rows without the label teach nothing, so they are dropped before the costly step.
    labelled = views.labelled_reviews(spark, sf, spread=True).filter(F.col("quality").isNotNull())
    return encode.fit_class_model(encode.embed_text(labelled, TEXT, dims=32), "quality")


@query("i3_expected_class")
def _(spark, sf):
    rows = encode.embed_text(views.reviews(spark, sf, spread=True), TEXT, dims=32)
    return encode.score_expected_class(rows, _class_model(spark, sf)).select(KEY, "sentiment_score")


# --- jobs --------------------------------------------------------------------------------------

@query("i0_preprocess", f"""WITH {REVIEWS}, c AS (SELECT review_id, item, score, {r.clean('body')} AS t FROM reviews)
  SELECT review_id, item, score, replace(replace(t, '\\''', ''''), '\\"', '"') AS clean_text FROM c WHERE NOT regexp_matches(t, '[^\\x00-\\x7F]')""")
def _(spark, sf):
    return jobs.preprocess(views.reviews(spark, sf, spread=True)).toDF(KEY, "item", "score", "clean_text")


@query("i4_embedding_job", f"WITH {REVIEWS} SELECT review_id, item AS row_id, score FROM reviews")
def _(spark, sf):
    rows, out, model = _cleaned(spark, sf).drop("lang"), scratch_path(spark, "embeddings"), _class_model(spark, sf)
    jobs.embedding_job(rows.filter(f"`{SCORE}` > 2"), out, model, dims=32)
    jobs.embedding_job(rows, out, model, dims=32)
    return spark.read.parquet(out).select(KEY, "row_id", F.col(f"`{SCORE}`").alias("score"))


def _unreadable(rows):
    """The score of every fifth star class is no number."""
    return rows.withColumn(SCORE, F.when(F.col(f"`{SCORE}`") == 5, "n/a").otherwise(F.col(f"`{SCORE}`").cast("string")))


@query("a15_measured_run", f"""WITH {REVIEWS}, n AS (SELECT count(*) AS total, count(*) FILTER (score <> 5) AS good, count(*) FILTER (score = 5) AS bad,
    count(*) FILTER (score <= 2) AS early FROM reviews)
  SELECT 1 AS run, early AS total, early AS written, CAST(0 AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped FROM n
  UNION ALL SELECT 2, total, good - early, bad, early FROM n UNION ALL SELECT 3, total, 0, 0, total FROM n""")
def _(spark, sf):
    """Three runs over growing input: what each met, wrote, failed on and skipped."""
    rows, model = _unreadable(_cleaned(spark, sf).drop("lang")), _class_model(spark, sf)
    out, dead = scratch_path(spark, "embeddings"), scratch_path(spark, "dead")
    early = rows.filter(F.col(f"`{SCORE}`").isin("1.0", "2.0"))
    found = [jobs.embedding_run(part, out, dead, model, dims=32).table(spark).withColumn("run", F.lit(i)) for i, part in enumerate((early, rows, rows), 1)]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("i19_csv_to_clusters", f"""WITH {REVIEWS}, c AS (SELECT review_id, score, {r.clean('body')} AS t FROM reviews),
    kept AS (SELECT * FROM c WHERE NOT regexp_matches(t, '[^\x00-\x7F]'))
  SELECT CAST(review_id AS VARCHAR) AS row_id, score AS rating, TRUE AS clustered FROM kept WHERE score <> 5""")
def _(spark, sf):
    """From written CSV files, some scores unreadable, to the CSV results of reduction, k-means and density clustering."""
    from pyspark.sql import types as T

    folder = scratch_path(spark, "csv-job")
    jobs.from_csv(spark, _csv(spark, _unreadable(_raw(spark, sf))), folder, _class_model(spark, sf), k=5, dims=32, method="density", min_samples=5, min_cluster_size=20)
    schema = T.StructType().add(KEY, T.LongType()).add("row_id", T.StringType()).add("rating", T.DoubleType()).add("sentiment_score", T.DoubleType()).add(
        "cluster_kmeans", T.IntegerType()).add("cluster_dbscan", T.IntegerType())
    results = files.read_csv(spark, f"{folder}/results", schema)
    return results.select("row_id", "rating", (F.col("cluster_kmeans").between(0, 4) & (F.col("cluster_dbscan") >= -1)).alias("clustered"))


def _vectors(spark, sf):
    meta = views.cluster_results(spark, sf).select(KEY, "rating", "sentiment_score")
    return meta.join(views.points(spark, sf), KEY)


@query("i19_clustering_job")
def _(spark, sf):
    return jobs.cluster_table(_vectors(spark, sf), k=5, dims=10, min_samples=5, min_cluster_size=20)[0]


@query("i19_clustering_job_scores")
def _(spark, sf):
    two = _vectors(spark, sf).withColumn("vec", F.slice("vec", 1, 2))
    return jobs.cluster_table(two, k=5, method="dbscan", eps=0.02, min_samples=4)[1]


@query("i20_signature_clustering")
def _(spark, sf):
    signatures = jobs.minhash_table(_cleaned(spark, sf))
    from ...operators import kmeans

    clusters = kmeans.kmeans(jobs.signature_vectors(signatures), 5, n_init=1).select(KEY, "rating", "cluster")
    return analysis.contingency(clusters)


@query("i20_signature_clusters")
def _(spark, sf):
    """Ten starts of k-means, and DBSCAN and density clusters of the reduction, on the signatures of all documents."""
    return jobs.signature_clusters(jobs.minhash_table(_cleaned(spark, sf)), dims=5)[0]


@query("i20_signature_noise", f"WITH {REVIEWS} SELECT unnest(['cluster_dbscan', 'cluster_density', 'cluster_kmeans']) AS method, count(*) AS rows, TRUE AS adds_up FROM reviews")
def _(spark, sf):
    """Whether the noise and the clusters reported are those of the labels, and all rows are labelled once."""
    labels, scores = jobs.signature_clusters(jobs.minhash_table(_cleaned(spark, sf)), dims=5)
    long = labels.select(F.explode(F.create_map(*[x for c in ("cluster_kmeans", "cluster_dbscan", "cluster_density") for x in (F.lit(c), F.col(c))])).alias("method", "label"))
    again = long.groupBy("method").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == -1).alias("noisy"), F.count_distinct(F.when(F.col("label") >= 0, F.col("label"))).alias("found"))
    good = (F.col("noisy") == F.col("noise")) & (F.col("found") == F.col("clusters")) & ((F.col("clusters") < 2) == F.col("dbi").isNull())
    return again.join(scores, "method").select("method", "rows", good.alias("adds_up"))


# --- streams -----------------------------------------------------------------------------------

def _stream(spark, sf):
    schema = views.table(spark, sf, "documents").schema
    return streams.read_folder(spark, sf, schema, "documents.parquet").withColumnRenamed("lang", "given")


_TAGGED = f"{_SCORES}, tagged AS (SELECT review_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY score DESC, lang) AS k FROM scores) WHERE k = 1)"


@query("j1_filter_stream", f"WITH {_TAGGED} SELECT review_id AS doc_id, lang FROM tagged WHERE lang = 'en'")
def _(spark, sf):
    out = scratch_path(spark, "english")
    streams.filter_language(_stream(spark, sf), _profiles(spark, sf), "text", out, scratch_path(spark, "progress"))
    return spark.read.parquet(out).select("doc_id", "lang")


@query("j2_language_count_stream", f"WITH {_TAGGED} SELECT lang, count(*) AS count FROM tagged GROUP BY lang")
def _(spark, sf):
    out = scratch_path(spark, "counts")
    streams.count_languages(_stream(spark, sf), _profiles(spark, sf), "text", out, scratch_path(spark, "progress"))
    return streams.latest_counts(spark, out)


def _embedding_stream(spark, sf):
    """Cleaned reviews as a file stream; the score of every fifth star class is unreadable."""
    folder, out = scratch_path(spark, "incoming"), scratch_path(spark, "embedded")
    dead, progress = scratch_path(spark, "dead"), scratch_path(spark, "progress")
    rows = _cleaned(spark, sf).drop("lang").withColumn(SCORE, F.when(F.col(f"`{SCORE}`") == 5, "n/a").otherwise(F.col(f"`{SCORE}`").cast("string")))
    files.write_parquet(rows, folder)
    model, schema = _class_model(spark, sf), spark.read.parquet(folder).schema
    for _ in range(2):  # the second start finds nothing new
        streams.embed_stream(streams.read_folder(spark, folder, schema), model, out, dead, progress, dims=32)
    return out, dead


@query("j3_embedding_stream", f"WITH {REVIEWS} SELECT review_id, item AS row_id, score FROM reviews WHERE score <> 5")
def _(spark, sf):
    out, _ = _embedding_stream(spark, sf)
    return as_table(spark.read.parquet(out), EMBEDDINGS).select(KEY, "row_id", F.col(f"`{SCORE}`").alias("score"))


@query("j4_dead_letters", f"WITH {REVIEWS} SELECT review_id, 'score is not a number' AS error FROM reviews WHERE score = 5")
def _(spark, sf):
    _, dead = _embedding_stream(spark, sf)
    return spark.read.parquet(dead).select(KEY, F.col("_error").alias("error"))
