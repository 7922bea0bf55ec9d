import pytest

import corpus_pipeline
from starglean.llm import bpe, omh, pulearn, templates
from starglean.llm.vocabulary import byte_bpe_path
from tests.llm.test_linetree import by_sql


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """Input and output of each stage, written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "bpe":
            assert after.columns == before.columns and after.dtypes == before.dtypes, name


def test_toxicity_rejects_what_the_classifier_rejects(spark, sf, steps):
    before, after = steps["toxicity"]
    model = pulearn.train(before, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id for r in pulearn.score(before, model).collect() if not r.predicted}
    assert set(rows(after)) == kept


def test_lines_go_as_sql_says(steps):
    before, after = steps["line_dedup"]
    expected = {r[0]: r[1] for r in by_sql([(r.doc_id, r.text) for r in before.collect()])}
    assert {i: r.text for i, r in rows(after).items()} == expected
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_document_of_each_class_stays(steps):
    before, after = steps["near_dedup"]
    classes = omh.near_duplicates(before).collect()
    assert set(rows(after)) == {r.class_id for r in classes}


def test_contaminated_documents_go(spark, sf, steps):
    before, after = steps["decontamination"]
    found = {r.doc_id for r in templates.matches(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert set(rows(after)) == set(rows(before)) - found


def test_last_stage_and_run(spark, sf, steps):
    before, after = steps["bpe"]
    assert sorted(map(tuple, bpe.encoding_digest(before, byte_bpe_path()).collect())) == sorted(map(tuple, after.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, after.collect()))
