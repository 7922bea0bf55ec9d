"""Registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import bpe, collocations, freqtrie, histosort, linetree, multiindex, omh, pulearn, records, sanitise, templates, urlrules, wrappers
from .vocabulary import byte_bpe_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies of every document."""
    return omh.near_duplicates(table(spark, folder, "documents"))


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urlrules.judge(table(spark, folder, "pages"), urlrules.example_rules(spark))


def op3_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.main_text(table(spark, folder, "pages"))


def op4_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return multiindex.links(table(spark, folder, "embeddings"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return sanitise.personal_data(table(spark, folder, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_records(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the record files written for all documents, taken from the files."""
    where, manifest = records.write_records(table(spark, folder, "documents"), byte_bpe_path(), end_id=2)
    return records.record_digest(records.read_records(spark, where, manifest))


def op7_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark items found in them."""
    return templates.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents")
    return pulearn.score(docs, pulearn.train(docs, table(spark, folder, "labels")))


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of ids and decoded text of every document."""
    return bpe.encoding_digest(table(spark, folder, "documents"), byte_bpe_path())


def op10_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the line templates that recur."""
    return linetree.drop_common_lines(table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


def op11_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and place of every document."""
    return histosort.shard_digest(table(spark, folder, "documents"))


def op12_spelling_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their more frequent near spelling."""
    return freqtrie.spelling_variants(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(table(spark, folder, "documents"))


OPERATORS = (op1_order_minhash, op2_url_rules, op3_wrappers, op4_multi_index, op5_personal_data, op6_records, op7_templates, op8_toxicity, op9_bpe, op10_line_templates, op11_histogram_sort, op12_spelling_trie, op13_collocations)
QUERIES = {f.__name__: f for f in OPERATORS} | {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {
    "op2_url_rules": urlrules.URL_SQL,
    "op4_multi_index": multiindex.LINK_SQL,
    "op11_histogram_sort": histosort.SHARD_SQL,
    "op12_spelling_trie": freqtrie.VARIANT_SQL,
    "op13_collocations": collocations.PHRASE_SQL,
    "op10_line_templates": linetree.LINE_SQL.format(docs="documents") + "SELECT doc_id, text, n_lines, n_dropped FROM cleaned",
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
