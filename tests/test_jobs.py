"""Sources, sinks, models, streams and jobs on temporary folders."""

import pytest
from pyspark.sql import functions as F

from starglean.operators import encode, language
from starglean.plans import jobs
from starglean.plans.catalog import QUERIES
from starglean.schema import CLEAN, ITEM, KEY, RAW_REVIEWS, SCORE, TEXT
from starglean.session import join_small, shared_dir, spread_rows
from starglean.sources import files
from starglean.streaming import reviews as streams

AWKWARD = ['plain', 'a "quoted", text', "line one\nline two", "  spaces  ", "", "comma, and \\ backslash", 'ends with quote"']


def test_csv_keeps_awkward_text(spark, tmp_path):
    rows = [(str(i), float(i), "", s, "u") for i, s in enumerate(AWKWARD)]
    files.write_csv(spark.createDataFrame(rows, RAW_REVIEWS), str(tmp_path / "c"))
    back = files.read_csv_text(spark, str(tmp_path / "c"), RAW_REVIEWS.names)
    assert {r[ITEM]: r[TEXT] for r in back.collect()} == {str(i): s for i, s in enumerate(AWKWARD)}


def test_bad_lines_separator_and_encoding(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("Id;t\n1;café\n2;a;too;many\n3;\n".encode("latin-1"))
    got = files.read_csv_text(spark, str(tmp_path / "x.csv"), ["Id", "t"], sep=";", encoding="ISO-8859-1").collect()
    assert {(r["Id"], r["t"]) for r in got} == {("1", "café"), ("3", "")}


def test_missing_input_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.require_path(spark, str(tmp_path / "none"))
    with pytest.raises(KeyError):
        files.require_columns(spark.range(1), "id", "text")
    with pytest.raises(ValueError, match="brotli"):
        files.write_parquet(spark.range(1), str(tmp_path / "b"), "brotli")


def test_magic_check_sees_damage(spark, tmp_path):
    files.write_parquet(spark.range(10).coalesce(1), str(tmp_path / "p"))
    (tmp_path / "p" / "bad.parquet").write_bytes(b"PAR1 truncated")
    got = {r["file_name"]: r["intact"] for r in files.parquet_magic_check(spark, str(tmp_path / "p")).collect()}
    assert got.pop("bad.parquet") is False and list(got.values()) == [True]


def test_large_small_side_is_not_broadcast(spark):
    left, right = spark.range(50), spark.range(40).withColumn("x", F.lit(1))
    small = join_small(left, right, "id")
    large = join_small(left, right, "id", max_bytes=10)
    assert small.count() == large.count() == 40
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()


def test_spread_only_when_there_are_too_few_splits(spark, tmp_path):
    files.write_parquet(spark.range(100).coalesce(1), str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert spread_rows(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert spread_rows(many) is many


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


@pytest.fixture(scope="module")
def profiles(spark):
    texts = [("en", "this book was amazing and the story is what they wanted with all of the heart")] * 3 + [
        ("de", "das buch war super und die geschichte ist was sie mit dem ganzen herzen wollten")] * 3
    return language.train_profiles(spark.createDataFrame(texts, "lang string, t string"), "t")


def test_language_rows(spark, profiles):
    rows = [("This book was amazing!",), ("Das Buch war super!",), ("",), (None,), ("  ",), ("ab",)]
    tagged = language.tag_language(spark.createDataFrame(rows, "t string"), profiles, "t").collect()
    assert [r["lang"] for r in tagged] == ["en", "de", "unknown", "unknown", "unknown", "unknown"]


def test_language_accuracy_on_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    train, rest = docs.filter("doc_id % 5 <> 0"), docs.filter("doc_id % 5 = 0").withColumnRenamed("lang", "truth")
    tagged = language.tag_language(rest, language.train_profiles(train, "text"), "text")
    assert tagged.agg(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0] > 0.9


class FixedLogits:
    def __call__(self):
        import numpy as np

        return lambda texts: np.array([[0, 0, 0, 0, 50.0 if "good" in t else 0] for t in texts], dtype=np.float32)


def test_user_model_scores_expected_stars(spark):
    df = spark.createDataFrame([("so good",), ("meh",)], "t string")
    got = [r["sentiment_score"] for r in encode.score_expected_class(df, FixedLogits(), "t").collect()]
    assert got == pytest.approx([5.0, 3.0], abs=1e-5)


def cleaned(spark, n, start=0):
    rows = [(start + i, f"b{i % 3}", float(1 + i % 5), "good book" if i % 2 else "bad one") for i in range(n)]
    return spark.createDataFrame(rows, f"{KEY} long, {ITEM} string, `{SCORE}` double, {CLEAN} string")


def test_embedding_job_resumes_without_duplicates(spark, tmp_path):
    out = str(tmp_path / "e")
    first = jobs.embedding_job(cleaned(spark, 10), out, FixedLogits(), dims=8).first()
    again = jobs.embedding_job(cleaned(spark, 16), out, FixedLogits(), dims=8).first()
    assert (first["written"], again["written"], again["total"]) == (10, 16, 16)
    assert spark.read.parquet(out).select(KEY).distinct().count() == 16


def test_stream_replay_and_dead_letters(spark, tmp_path):
    src, out, dead, progress = (str(tmp_path / n) for n in ("src", "out", "dead", "progress"))
    rows = cleaned(spark, 10).withColumn(SCORE, F.when(F.col(KEY) == 3, "x").otherwise(F.col(f"`{SCORE}`").cast("string")))
    rows = rows.withColumn(CLEAN, F.when(F.col(KEY) == 4, None).otherwise(F.col(CLEAN)))
    rows.write.mode("append").parquet(src)
    for fresh in (None, cleaned(spark, 4, start=50).withColumn(SCORE, F.col(f"`{SCORE}`").cast("string"))):
        if fresh is not None:
            fresh.write.mode("append").parquet(src)
        for _ in range(2):
            streams.embed_stream(streams.read_folder(spark, src, rows.schema), FixedLogits(), out, dead, progress, dims=8)
    ids = [r[KEY] for r in spark.read.parquet(out).select(KEY).collect()]
    assert sorted(ids) == sorted(set(range(10)) - {3, 4} | set(range(50, 54)))
    assert {r[KEY]: r["_error"] for r in spark.read.parquet(dead).collect()} == {3: "score is not a number", 4: "missing text"}


def test_preprocess_drops_and_cleans(spark):
    rows = [(1, "a", 5.0, "x &amp; y"), (2, "a", None, "t"), (3, "a", 1.0, None), (4, "a", 1.0, "café"), (5, "a", 2.0, "it\\'s\n"), (6, "a", 2.0, " ")]
    raw = spark.createDataFrame(rows, f"{KEY} long, {ITEM} string, `{SCORE}` double, `{TEXT}` string")
    got = {r[KEY]: r[CLEAN] for r in jobs.preprocess(raw).collect()}
    assert got == {1: "x & y", 5: "it's", 6: ""}
    assert {r[KEY] for r in jobs.preprocess(raw, drop_empty=True).collect()} == {1, 5}


@pytest.mark.parametrize("name", ["a6_first_files", "a16_parquet_magic", "i3_expected_class", "i14_pca", "i19_clustering_job_scores"])
def test_queries_without_sql_give_rows(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0
