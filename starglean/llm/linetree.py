"""Line de-duplication with a log-template tree, in DataFrame operations only.

A line's place in the tree is fixed in depth: its token count, then its first
``LEADING`` tokens; tokens with digits or ``@`` are variable fields and read
``<*>`` from the start, unless a line has no others: such a line is data and
recurs only where it is the same.  In each leaf the most frequent token of every position
makes the leaf's template; lines that agree with it in at least ``AGREE`` of
their positions belong to it, and the positions where they differ are variable
fields too.  Other lines are templates of their own.  A template that occurs in
``MIN_DOCS`` or more documents is boilerplate: its lines are dropped everywhere
but in the first document, so no content is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, row_key, small_side, spread, stored

MIN_DOCS = 5
MIN_TOKENS = 3
LEADING = 3
AGREE = 0.8
FIELD = "<*>"
VARIABLE = "[0-9@]"
LINE_END = r"\r?\n"


def lines_of(text: Column) -> Column:
    return F.split(text, LINE_END, -1)


def masked_line(line: Column) -> Column:
    """The tokens of a line with single spaces between them, variable fields masked."""
    spaced = F.array_remove(F.split(F.replace(line, F.lit("\t"), F.lit(" ")), " "), "")
    masked = F.transform(spaced, lambda t: F.when(t.rlike(VARIABLE), FIELD).otherwise(t))
    as_is = ~(line.contains("  ") | line.contains("\t") | line.startswith(" ") | line.endswith(" ") | line.rlike(VARIABLE))
    fields_only = lambda m: (F.replace(F.replace(m, F.lit(FIELD), F.lit("")), F.lit(" "), F.lit("")) == "") & ~line.contains(FIELD)
    kept = let(F.array_join(masked, " "), lambda m: F.when(fields_only(m), F.array_join(spaced, " ")).otherwise(m))
    return F.when(as_is, line).otherwise(kept)


def placed_lines(docs: DataFrame, min_tokens: int) -> DataFrame:
    """``row, doc_id, line_no, line, leaf, body`` of each line with enough tokens.

    Lines are masked before they become rows, so each is read once: the outer
    form of ``posexplode`` keeps the optimizer from adding a filter that would
    mask all lines again.  ``leaf`` names a line's place in the tree, ``body``
    its masked tokens.
    """
    lines = docs.filter("text is not null").select(
        row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id", F.transform(lines_of(F.col("text")), masked_line).alias("lines"))
    count = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return lines.select("row", "doc_id", F.posexplode_outer("lines").alias("line_no", "line")).filter((F.col("line") != "") & (count >= min_tokens)).select(
        "*", F.xxhash64(count, F.substring_index("line", " ", LEADING)).alias("leaf"), F.md5("line").alias("body"))


def leaf_templates(lines: DataFrame, table: DataFrame, min_docs: int, agree: float) -> DataFrame:
    """``body, template`` for bodies that belong to the template of their leaf.

    Only leaves that hold several bodies and lines of ``min_docs`` documents
    need a template; their bodies alone are looked at token by token.
    """
    bodies = table.select("leaf", "body", "row").distinct().groupBy("leaf", "body").agg(F.count(F.lit(1)).alias("docs"))
    leaves = bodies.groupBy("leaf").agg(F.count(F.lit(1)).alias("bodies"), F.sum("docs").alias("docs")).filter(
        (F.col("bodies") > 1) & (F.col("docs") >= min_docs)).select("leaf")
    leaves = stored(leaves, "leaves")
    known = lines.join(small_side(leaves, leaves.count(), 32), "leaf", "left_semi") \
        .groupBy("leaf", "body").agg(F.first("line").alias("line"))
    known = stored(known.join(bodies, ["leaf", "body"]).select("leaf", "body", "docs", F.split("line", " ").alias("tokens")), "bodies")
    votes = known.select("leaf", "docs", F.posexplode("tokens").alias("pos", "token")) \
        .groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("docs")) \
        .groupBy("leaf", "pos").agg(F.max(F.struct("docs", "token")).alias("top"))
    heads = votes.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("pos", "top.token"))).alias("head"))
    same = F.zip_with("tokens", "head.token", lambda a, b: F.when(a == b, 1).otherwise(0))
    share = F.aggregate(same, F.lit(0), lambda acc, x: acc + x) / F.size("tokens")
    return known.join(heads, "leaf").filter(share >= agree).select("body", F.col("leaf").cast("string").alias("template"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, agree: float = AGREE) -> DataFrame:
    """``row, dropped array<int>``: the line numbers that go, per distinct ``doc_id`` and text."""
    lines = placed_lines(spread(docs.select("doc_id", "text")), min_tokens)
    table = stored(lines.select("row", "doc_id", "line_no", "leaf", "body"), "lines")
    general = leaf_templates(lines, table, min_docs, agree)
    named = table.select("row", "doc_id", "line_no", "body").join(general, "body", "left").select(
        "row", "doc_id", "line_no", F.coalesce("template", "body").alias("template"))
    named = stored(named, "named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    per_row = named.groupBy("template", "row").agg(F.min("doc_id").alias("doc_id"))
    common = per_row.groupBy("template").agg(F.count(F.lit(1)).alias("docs"), first.alias("first")).filter(
        F.col("docs") >= min_docs).select("template", F.col("first.row").alias("first"))
    return named.join(common, "template").filter("row <> first").groupBy("row").agg(F.collect_set("line_no").alias("dropped"))


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, agree: float = AGREE) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and ``n_lines``, ``n_dropped``.

    Documents without such lines keep their text as it is; null text stays null
    with no lines, empty text has one empty line.  Lines under ``min_tokens``
    tokens say too little and stay.  Rows that repeat ``doc_id`` and text count
    as one document and get the same text; the first document of a template is
    the one with the least ``doc_id`` (null last), then the least content name.
    Other columns pass through, whatever their names; ``n_lines`` and ``n_dropped`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("row"))
    met = keyed.join(dropped_lines(docs, min_docs, min_tokens, agree), "row", "left")
    text, dropped = F.col("doc.text"), F.col("dropped")
    lines = lines_of(text)
    left = F.filter(lines, lambda line, i: ~F.array_contains(dropped, i))
    cleaned = F.when(dropped.isNull(), text).otherwise(F.array_join(left, "\n"))
    return met.select(
        *[cleaned.alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in names],
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("bigint").alias("n_dropped"))


def clean_documents(docs: DataFrame) -> DataFrame:
    """:func:`drop_common_lines` with the columns of ``docs`` alone; ``n_chars``, if there, is counted anew."""
    cleaned = drop_common_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                                     .otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


#: The same in DuckDB's SQL; ``{docs}`` names the input table.
LINE_SQL = f"""
WITH rows_ AS (SELECT DISTINCT doc_id, text FROM {{docs}} WHERE text IS NOT NULL),
keyed AS (SELECT row_number() OVER () AS row_, md5(concat_ws(chr(1), coalesce('v' || CAST(doc_id AS VARCHAR), 'n'), 'v' || text)) AS name_,
                 doc_id, text, regexp_split_to_array(text, '\\r?\\n') AS lines FROM rows_),
split_ AS (SELECT row_, name_, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM keyed),
toks AS (SELECT row_, name_, doc_id, line_no, list_filter(regexp_split_to_array(line, '[ \\t]+'), lambda t: t <> '') AS raw FROM split_),
parsed AS (SELECT row_, name_, doc_id, line_no,
                  CASE WHEN len(list_filter(raw, lambda t: NOT regexp_matches(t, '[0-9@]'))) = 0 THEN raw
                       ELSE list_transform(raw, lambda t: CASE WHEN regexp_matches(t, '[0-9@]') THEN '{FIELD}' ELSE t END) END AS tokens
           FROM toks WHERE len(raw) >= {MIN_TOKENS}),
placed AS (SELECT *, CAST(len(tokens) AS VARCHAR) || ' ' || array_to_string(tokens[1:{LEADING}], ' ') AS leaf,
                  array_to_string(tokens, ' ') AS body FROM parsed),
bodies AS (SELECT leaf, body, any_value(tokens) AS tokens, count(DISTINCT row_) AS docs FROM placed GROUP BY leaf, body),
leaves AS (SELECT leaf FROM bodies GROUP BY leaf HAVING count(*) > 1 AND sum(docs) >= {MIN_DOCS}),
known AS (SELECT * FROM bodies WHERE leaf IN (SELECT leaf FROM leaves)),
positions AS (SELECT leaf, docs, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM known),
votes AS (SELECT leaf, pos, token, sum(docs) AS docs FROM positions GROUP BY leaf, pos, token),
tops AS (SELECT leaf, pos, arg_max(token, ROW(docs, token)) AS token FROM votes GROUP BY leaf, pos),
heads AS (SELECT leaf, list(token ORDER BY pos) AS head FROM tops GROUP BY leaf),
general AS (SELECT k.body, k.leaf AS template FROM known k JOIN heads h ON k.leaf = h.leaf
            WHERE list_sum(list_transform(list_zip(k.tokens, h.head), lambda p: CASE WHEN p[1] = p[2] THEN 1 ELSE 0 END)) / len(k.tokens) >= {AGREE}),
named AS (SELECT p.row_, p.name_, p.doc_id, p.line_no, coalesce('leaf ' || g.template, 'body ' || p.body) AS template
          FROM placed p LEFT JOIN general g ON p.body = g.body),
common AS (SELECT template, arg_min(row_, ROW(doc_id IS NULL, coalesce(doc_id, 0), name_)) AS first_ FROM named
           GROUP BY template HAVING count(DISTINCT row_) >= {MIN_DOCS}),
gone AS (SELECT n.row_, list(DISTINCT n.line_no) AS dropped FROM named n JOIN common c ON n.template = c.template WHERE n.row_ <> c.first_ GROUP BY n.row_),
cleaned AS (SELECT k.doc_id, k.text AS was, CAST(len(k.lines) AS BIGINT) AS n_lines, CAST(coalesce(len(g.dropped), 0) AS BIGINT) AS n_dropped,
                   CASE WHEN g.dropped IS NULL THEN k.text ELSE array_to_string(
                     list_filter(k.lines, lambda l, i: NOT list_contains(g.dropped, i - 1)), chr(10)) END AS text
            FROM keyed k LEFT JOIN gone g ON k.row_ = g.row_)
"""
