import duckdb
import pandas as pd

from starglean.llm import linetree


def by_sql(rows):
    """The rows as DuckDB's SQL cleans them."""
    con = duckdb.connect()
    frame = pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], dtype="Int64"), "text": [r[1] for r in rows]})
    con.register("docs_", frame)
    con.execute("CREATE TABLE d AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text FROM docs_")
    return sorted(map(tuple, con.execute(linetree.LINE_SQL.format(docs="d") + "SELECT doc_id, text, n_lines, n_dropped FROM cleaned").fetchall()), key=repr)


def test_templates_with_fields(spark):
    rows = [(i, f"{'abcdefghij'[i] * 3} writes {'klmnopqrst'[i] * 4} own line {'abcdefghij'[i] * 5}\nPrinted on 2024-01-{i:02d} at host{i}\r\nAll rights are reserved\n\nshort one") for i in range(8)]
    rows += [(20 + i, f"Read more about {w} in our shop\nbody {w} stays as it is") for i, w in enumerate(["cats", "dogs", "cats", "birds", "cats", "fish"])]
    rows += [(40, "All rights are reserved"), (40, "All rights are reserved\nand more text follows"), (None, "All rights are reserved"),
             (41, ""), (42, "\n\n"), (43, "word " * 20_000)]
    docs = spark.createDataFrame(rows + [(44, None), (44, None)], "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "5 AS n_lines", "'k' AS row", "1 AS dropped", "2 AS line", "length(text) AS n_chars")
    frame = linetree.drop_common_lines(docs).cache()
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in frame.collect()), key=repr)
    assert got == sorted(by_sql(rows) + [(44, None, 0, 0)] * 2, key=repr)
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert "Printed" in texts[0] and "Printed" not in texts[1] and "short one" in texts[1]
    assert "reserved" in texts[0] and "reserved" not in texts[7] and "own line" in texts[7]
    assert linetree.drop_common_lines(docs.limit(0)).collect() == []
    whole = linetree.clean_documents(docs)
    assert whole.columns == docs.columns
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in whole.collect())


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "one line said again and again")] * 9 + [(2, "one line said again and again")]
    got = linetree.drop_common_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == 10 and all(r.n_dropped == 0 for r in got)


def test_lines_of_numbers_are_kept(spark):
    """Rows of data differ in every field; only a row that is the same in many documents is boilerplate."""
    rows = [(i, f"{i}7.5 {i}4 90{i}\n12.5 14 901\nrow {i} of the table of values") for i in range(9)] + [(20, "a1 b2 c3"), (21, "a1  b2 c4"), (None, "1 2 3")]
    got = {r.doc_id: r.text for r in linetree.drop_common_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(f"{i}7.5 {i}4 90{i}" in got[i] for i in range(9)) and "12.5 14 901" in got[0] and "12.5 14 901" not in got[3] and "row 3" not in got[3]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, linetree.drop_common_lines(docs).collect()), key=repr) == by_sql(rows)


def test_columns_of_any_name_pass_through(spark):
    docs = spark.createDataFrame([(i, "the same line in all", "a", "b", "c", "d") for i in range(6)], "doc_id bigint, text string, _row string, _gone string, doc string, `x.y` string")
    got = linetree.drop_common_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert {(r["_row"], r["_gone"], r["doc"], r["x.y"]) for r in got.collect()} == {("a", "b", "c", "d")}
