"""Keys, measured runs, versioned counts and language models as a user meets them."""

import pytest
from pyspark.sql import functions as F

from starglean.session import cut_lineage
from starglean.operators import language
from starglean.plans import jobs
from starglean.schema import CLEAN, ITEM, KEY, SCORE, with_review_id
from starglean.session import scratch_path
from starglean.streaming import reviews as streams


def test_review_ids_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(f"item {i % 7}", None if i % 5 == 0 else f"text {i % 11}", -1) for i in range(60)], f"item string, text string, {KEY} int")
    first, second = (with_review_id(rows.repartition(n)).collect() for n in (1, 7))
    assert sorted(r[KEY] for r in first) == list(range(60))
    assert sorted(map(str, first)) == sorted(map(str, second))
    assert sorted(r[KEY] for r in with_review_id(rows, start=1000).collect()) == list(range(1000, 1060))
    assert with_review_id(rows.limit(0)).collect() == []


class Length:
    def __call__(self):
        import numpy as np

        return lambda texts: np.array([[len(s), 1.0] for s in texts], dtype=np.float32)


def test_run_counts_what_it_wrote_and_failed_on(spark):
    rows = spark.createDataFrame(
        [(i, f"item{i}", {0: "4.5", 1: "n/a", 2: None}[i % 3], None if i == 3 else f"some text {i}") for i in range(12)],
        f"{KEY} long, {ITEM} string, `{SCORE}` string, {CLEAN} string")
    out, dead = scratch_path(spark, "out"), scratch_path(spark, "dead")
    run = lambda part: jobs.embedding_run(part, out, dead, Length(), Length())
    assert run(rows.filter(f"{KEY} < 6")) == jobs.Run(6, 1, 5, 0)
    assert run(rows) == jobs.Run(12, 2, 4, 6)
    assert run(rows) == jobs.Run(12, 0, 0, 12)
    errors = spark.read.parquet(dead).groupBy("_error").count().collect()
    assert {r["_error"]: r["count"] for r in errors} == {"missing text": 1, "missing score": 4, "score is not a number": 4}
    assert sorted(r[KEY] for r in spark.read.parquet(out).select(KEY).collect()) == [0, 6, 9]


def test_counts_survive_a_stop_between_write_and_commit(spark):
    out = scratch_path(spark, "counts")
    table = lambda n: spark.createDataFrame([("en", n)], "lang string, count long")
    with pytest.raises(FileNotFoundError):
        streams.latest_counts(spark, out)
    streams.write_version(table(1), out, 0)
    # Version 1 is written, and the job stops before it is marked.
    table(2).write.parquet(f"{out}/version=1")
    assert streams.latest_version(spark, out) == 0 and streams.latest_counts(spark, out).first()["count"] == 1
    for _ in range(2):  # the batch is replayed, twice
        streams.write_version(table(3), out, 1)
        assert streams.latest_version(spark, out) == 1 and streams.latest_counts(spark, out).first()["count"] == 3


def test_language_scores_agree_and_odd_texts_have_none(spark):
    texts = [("en", "the cat sat on the mat"), ("de", "die Katze saß auf der Matte 😀"), ("en", "ab"), ("de", ""), ("en", None), ("fr", "le chat 😀😀😀"), (None, "no language")]
    df = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(texts)], "id long, lang string, text string")
    counts = language.profile_counts(df, "text")
    added = language.smoothing(counts, None)
    profiles = language.ship_profiles(counts, ["de", "en", "fr"], added)
    scored = df.select("id", language.language_scores(F.col("text"), profiles).alias("s")).collect()
    shipped = {(r["id"], lang): x for r in scored if r["s"] is not None for lang, x in zip(profiles.languages, r["s"])}
    joined = {(r["id"], r["lang"]): r["score"] for r in language.scores_by_join(df.drop("lang"), "id", "text", counts, added).collect()}
    assert shipped == pytest.approx(joined) and {i for i, _ in shipped} == {0, 1, 5, 6}
    tags = {r["id"]: r["lang"] for r in language.tag_language(df.drop("lang"), profiles, "text").collect()}
    assert tags[0] == "en" and tags[1] == "de" and tags[5] == "fr" and tags[2] == tags[3] == tags[4] == "unknown"


def test_a_trigram_meets_the_model_once_whatever_the_languages(spark):
    rows = [(i, f"l{i % 9}", "the same words") for i in range(18)] + [(None, "l1", "the same words")]
    df = spark.createDataFrame(rows, "id long, lang string, text string")
    counts = cut_lineage(language.profile_counts(df, "text"))
    scored = language.scores_by_join(df.drop("lang"), "id", "text", counts, 12)
    found = {(r["id"], r["lang"]): r["score"] for r in scored.collect()}
    assert len(found) == 19 * 9 and found[0, "l3"] == pytest.approx(found[5, "l3"])
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_a_model_too_large_to_ship_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MODEL_BYTES", 100)
    df = spark.createDataFrame([("en", "the cat sat on the mat")], "lang string, text string")
    with pytest.raises(ValueError):
        language.train_profiles(df, "text", features=None)


def test_tables_written_as_folders_of_parts_are_scanned_and_streamed(spark):
    """The supplied tables are single files at small sizes and folders of part files at large ones."""
    from starglean.sources import files
    from starglean.streaming.reviews import read_folder

    folder = scratch_path(spark, "tables")
    rows = spark.range(40).selectExpr("id", "concat('text ', id) AS text")
    rows.repartition(3).write.parquet(f"{folder}/documents.parquet")
    rows.limit(2).write.parquet(f"{folder}/labels.parquet")
    found = files.read_parquet_folder(spark, folder, "documents.parquet")
    assert sorted(r["id"] for r in found.collect()) == list(range(40))
    assert len(files.first_files(spark, folder, 2, "documents.parquet").inputFiles()) == 2
    out, progress = scratch_path(spark, "out"), scratch_path(spark, "progress")
    for _ in range(2):  # the second start finds nothing new
        stream = read_folder(spark, folder, rows.schema, "documents.parquet")
        stream.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(40))


def test_single_files_and_partitions_are_still_read(spark):
    from starglean.sources import files

    folder = scratch_path(spark, "flat")
    spark.range(10).selectExpr("id", "id % 2 AS k").write.partitionBy("k").parquet(folder)
    assert sorted(map(tuple, files.read_parquet_folder(spark, folder).collect())) == [(i, i % 2) for i in range(10)]
    assert sorted(map(tuple, files.read_parquet_folder(spark, folder, "*").collect())) == [(i, i % 2) for i in range(10)]


def test_fitting_a_class_model_makes_each_embedding_once(spark):
    from pyspark.sql import functions as F

    from starglean.operators import encode

    made = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def embedded(i):
        made.add(1)
        return [float(i % 3), float(i % 2)]

    rows = spark.range(40).select((F.col("id") % 2).alias("label"), embedded.asNondeterministic()("id").alias("embedding"))
    encode.fit_class_model(rows, "label")
    assert made.value == 40
