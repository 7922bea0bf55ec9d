"""Cleaning, tokenising, hashing and character audits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ...functions import hashing, text as t
from ...operators import profile
from ...schema import KEY, TEXT
from ...sources import views
from . import registry as r
from .registry import REVIEWS, query


def _body() -> Column:
    return F.col(f"`{TEXT}`")


def _each(name: str, sql: str, expression):
    """Register a one-column text function over every review."""

    @query(name, f"WITH {REVIEWS} SELECT review_id, {sql} AS value FROM reviews")
    def _(spark, sf):
        return views.reviews(spark, sf, spread=True).select(KEY, expression(_body()).alias("value"))


@query("g1_unescape_html", f"""SELECT page_id AS review_id,
  {r.sub(r.sub(r.sub(r.sub('html', '&middot;?', '·'), '&copy;?', '©'), '&quot;?', '"'), '&amp;?', '&')} AS value FROM pages""")
def _(spark, sf):
    return views.html_text(spark, sf).select(KEY, t.unescape_html(_body()).alias("value"))


@query("g3_remove_urls", f"SELECT page_id AS review_id, {r.no_urls('html')} AS value FROM pages")
def _(spark, sf):
    return views.html_text(spark, sf).select(KEY, t.remove_urls(_body()).alias("value"))


@query("g6_clean_text_html", f"SELECT page_id AS review_id, {r.clean('html')} AS value FROM pages")
def _(spark, sf):
    return views.html_text(spark, sf).select(KEY, t.clean_text(_body()).alias("value"))


@query("g16_html_tag", "SELECT page_id AS review_id, regexp_matches(html, '<.*?>') AS has_tag FROM pages")
def _(spark, sf):
    return views.html_text(spark, sf).select(KEY, t.has_html_tag(_body()).alias("has_tag"))


_each("g2_remove_control_chars", r.no_controls("body"), t.remove_control_chars)
_each("g4_line_breaks_to_space", r.breaks_to_space("body"), t.line_breaks_to_space)
_each("g5_collapse_spaces", r.collapse("body"), t.collapse_spaces)
_each("g6_clean_text", r.clean("body"), t.clean_text)
_each("g6_clean_text_spaced", r.clean(r.breaks_to_space("body")), lambda c: t.clean_text(c, newline_as_space=True))
_each("g7_clean_special_chars",
      r.collapse(r.sub(r.breaks_to_space(r.no_urls("body")), r"[^\x00-\x7F]+", " ")), t.clean_special_chars)
# JSON-escaping the text first gives every quote a backslash to remove.
_each("g8_unescape_quotes", "body", lambda c: t.unescape_quotes(F.replace(F.replace(c, F.lit("'"), F.lit("\\'")), F.lit('"'), F.lit('\\"'))))
_each("g9_remove_punctuation", r.no_punctuation("body"), t.remove_punctuation)
_each("g10_remove_digits", r.no_digits("body"), t.remove_digits)
_each("g11_remove_stopwords", r.no_stopwords("body"), t.remove_stopwords)
_each("g12_lower", "lower(body)", F.lower)
_each("g13_normalize_notebook", f"lower({r.collapse(r.no_stopwords(r.no_digits(r.no_punctuation('body'))))})",
      lambda c: t.normalize_for_shingles(c, "notebook"))
_each("g14_normalize_script", r.script_normal("body"), t.normalize_for_shingles)
_each("g15_word_count", f"len({r.words('body')})", lambda c: t.word_count(c).cast("bigint"))


@query("g17_strip_label_prefix", "SELECT doc_id AS review_id, lang AS value FROM documents")
def _(spark, sf):
    tagged = views.reviews(spark, sf, spread=True).select(KEY, F.concat(F.lit("__label__"), "lang").alias("tag"))
    return tagged.select(KEY, t.strip_label_prefix(F.col("tag")).alias("value"))


@query("g18_parse_int_list", """WITH p AS (SELECT vec_id AS review_id,
    unnest(list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 1000) AS BIGINT))) AS n,
    generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
  SELECT review_id, CAST(pos AS INTEGER) AS pos, n FROM p""")
def _(spark, sf):
    ints = F.transform("vec", lambda x: (x * 1000).cast("bigint").cast("string"))
    written = views.points(spark, sf).select(KEY, F.concat(F.lit("["), F.array_join(ints, " "), F.lit("\n]")).alias("s"))
    return written.select(KEY, F.posexplode(t.parse_int_list(F.col("s"))).alias("pos", "n"))


_SHINGLES2 = f"""shingled AS (SELECT review_id, w, CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END AS s
  FROM (SELECT review_id, {r.words(r.clean('body'))} AS w FROM reviews))"""


@query("h1_word_shingles", f"""WITH {REVIEWS}, {_SHINGLES2}
  SELECT review_id, len(s) AS n, array_to_string(s, '|') AS joined FROM shingled""")
def _(spark, sf):
    s = F.col("s")
    rows = views.reviews(spark, sf, spread=True).select(KEY, hashing.shingles(t.clean_text(_body()), 2).alias("s"))
    return rows.select(KEY, F.size(s).cast("bigint").alias("n"), F.array_join(s, "|").alias("joined"))


_MD5_32 = "('0x' || substr(md5({0}), 1, 8))::BIGINT"


@query("h2_base_hash", f"""WITH {REVIEWS}, tokens AS (SELECT DISTINCT unnest({r.words('body')}) AS token FROM reviews)
  SELECT token, {_MD5_32.format('token')} AS h FROM tokens""")
def _(spark, sf):
    tokens = views.reviews(spark, sf, spread=True).select(F.explode(t.words(_body())).alias("token")).distinct()
    return tokens.select("token", hashing.md5_hash32(F.col("token")).alias("h"))


# MurmurHash3 in SQL: 4-byte blocks are read from the hex form of the UTF-8 bytes.
def _murmur_sql(token: str) -> str:
    m = "4294967295"
    rot = lambda x, s: f"((({x} << {s}) & {m}) | ({x} >> {32 - s}))"
    mul = lambda x, c: f"CAST((CAST({x} AS HUGEINT) * {c}) % 4294967296 AS BIGINT)"
    scramble = lambda k: mul(rot(mul(k, hashing.MURMUR_C1), 15), hashing.MURMUR_C2)
    byte = lambda i: f"coalesce(('0x' || nullif(substr(hx, 2 * ({i}) + 1, 2), ''))::BIGINT, 0)"
    block = lambda i: f"({byte(f'4*({i})')} + 256 * {byte(f'4*({i})+1')} + 65536 * {byte(f'4*({i})+2')} + 16777216 * {byte(f'4*({i})+3')})"
    step = f"CAST((CAST({rot(f'xor(acc, {scramble('k')})', 13)} AS HUGEINT) * 5 + {hashing.MURMUR_N}) % 4294967296 AS BIGINT)"
    return f"""
  hexed AS (SELECT {token} AS token, hex(encode({token})) AS hx, octet_length(encode({token})) AS nb FROM tokens),
  blocks AS (SELECT token, nb, list_transform(range(0, nb // 4), lambda i: {block('i')}) AS bs, {block('nb // 4')} AS tail FROM hexed),
  body AS (SELECT token, nb, tail, list_reduce(list_prepend(CAST(0 AS BIGINT), bs), lambda acc, k: {step}) AS s FROM blocks),
  tailed AS (SELECT token, xor(CASE WHEN nb % 4 > 0 THEN xor(s, {scramble('tail')}) ELSE s END, CAST(nb AS BIGINT)) AS s FROM body),
  mix1 AS (SELECT token, {mul('xor(s, s >> 16)', hashing.MURMUR_MIX1)} AS s FROM tailed),
  mix2 AS (SELECT token, {mul('xor(s, s >> 13)', hashing.MURMUR_MIX2)} AS s FROM mix1),
  murmur AS (SELECT token, xor(s, s >> 16) AS h FROM mix2)"""


@query("h2_murmur3_hash", f"""WITH {REVIEWS}, tokens AS (SELECT DISTINCT unnest({r.words('body')}) AS token FROM reviews),
  {_murmur_sql('token')} SELECT token, h FROM murmur""")
def _(spark, sf):
    tokens = views.reviews(spark, sf, spread=True).select(F.explode(t.words(_body())).alias("token")).distinct()
    return tokens.select("token", hashing.base_hashes(F.array("token"), "murmur3")[0].alias("h"))


def _signature_sql(source: str) -> str:
    """Signatures from a CTE ``hashed(review_id, h)`` with one row per distinct shingle hash."""
    a, b = hashing.hash_coefficients()
    pairs = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())))
    return f"""{source}, ab(i, a, b) AS (VALUES {pairs}),
  sig AS (SELECT review_id, i, min((CAST(a AS HUGEINT) * h + b) % {hashing.HASH_SPACE}) AS v FROM hashed, ab GROUP BY review_id, i)
  SELECT review_id, string_agg(CAST(v AS VARCHAR), ' ' ORDER BY i) AS signature FROM sig GROUP BY review_id"""


def _joined_signature(df):
    return df.select(KEY, F.array_join(F.transform("sig", lambda x: x.cast("string")), " ").alias("signature"))


_NORMAL_WORDS = f"""normal AS (SELECT review_id, {r.words(r.script_normal(r.clean('body')))} AS w FROM reviews),
  shingled AS (SELECT DISTINCT review_id, unnest(CASE WHEN len(w) < 1 THEN [''] ELSE w END) AS token FROM normal)"""


@query("h3_minhash_signature", f"""WITH {REVIEWS}, {_SHINGLES2},
  pieces AS (SELECT DISTINCT review_id, unnest(s) AS token FROM shingled),
  """ + _signature_sql(f"hashed AS (SELECT review_id, {_MD5_32.format('token')} AS h FROM pieces)"))
def _(spark, sf):
    sig = hashing.text_signature(t.clean_text(_body()), q=2, base="md5")
    return _joined_signature(views.reviews(spark, sf, spread=True).select(KEY, sig.alias("sig")))


@query("h4_minhash_dataset", f"""WITH {REVIEWS}, {_NORMAL_WORDS}, tokens AS (SELECT DISTINCT token FROM shingled),
  {_murmur_sql('token')},
  """ + _signature_sql("hashed AS (SELECT review_id, h FROM shingled JOIN murmur USING (token))"))
def _(spark, sf):
    sig = hashing.text_signature(t.normalize_for_shingles(t.clean_text(_body())))
    return _joined_signature(views.reviews(spark, sf, spread=True).select(KEY, sig.alias("sig")))


@query("d27_rare_characters", f"""WITH {REVIEWS}, c AS (SELECT unnest(string_split(body, '')) AS ch FROM reviews)
  SELECT ch, count(*) AS n FROM c WHERE ch <> '' AND NOT regexp_matches(ch, '[\\p{{L}}\\p{{N}}]') GROUP BY ch HAVING count(*) < 50""")
def _(spark, sf):
    return profile.rare_characters(views.reviews(spark, sf, spread=True), TEXT)


@query("d28_top_non_ascii", f"""WITH {REVIEWS}, c AS (SELECT unnest(regexp_extract_all(body, '[^\\x00-\\x7F]')) AS ch FROM reviews)
  SELECT ch, count(*) AS n FROM c GROUP BY ch ORDER BY n DESC, ch LIMIT 30""")
def _(spark, sf):
    return profile.top_non_ascii(views.reviews(spark, sf, spread=True), TEXT)


def _audit_sql(text: str) -> str:
    checks = {
        "digits": r"\p{Nd}", "punctuation": rf"[^\p{{L}}\p{{N}}_{r.WS}]", "extra_spaces": f"[{r.WS}]{{2,}}",
        "uppercase": "[A-Z]", "control_chars": r"[\x00-\x1F\x7F]", "urls": f"http[^{r.WS}]+|www[^{r.WS}]+",
        "listed_chars": "[" + "".join(f"\\x{{{ord(c):x}}}" for c in t.LISTED_CONTROL_CHARS) + "]", "non_ascii": r"[^\x00-\x7F]",
    }
    return ", ".join(f"count(*) FILTER (regexp_matches({text}, '{p}')) AS {name}" for name, p in checks.items())


@query("d29_normalized_audit", f"""WITH {REVIEWS}, n AS (SELECT {r.script_normal('body')} AS c FROM reviews)
  SELECT {_audit_sql('c')} FROM n""")
def _(spark, sf):
    return profile.clean_audit(views.reviews(spark, sf, spread=True).select(t.normalize_for_shingles(_body()).alias("c")), "c")


@query("d30_clean_audit", f"""WITH raw AS (SELECT html AS c FROM pages)
  SELECT 'raw' AS stage, {_audit_sql('c')} FROM raw UNION ALL SELECT 'clean', {_audit_sql(r.clean('c'))} FROM raw""")
def _(spark, sf):
    pages = views.html_text(spark, sf)
    raw = profile.clean_audit(pages.select(_body().alias("c")), "c").select(F.lit("raw").alias("stage"), "*")
    done = profile.clean_audit(pages.select(t.clean_text(_body()).alias("c")), "c").select(F.lit("clean").alias("stage"), "*")
    return raw.unionByName(done)


@query("k1_scalar_text_function", f"WITH {REVIEWS} SELECT review_id, item, length({r.clean('body')}) AS n_chars FROM reviews")
def _(spark, sf):
    return views.reviews(spark, sf, spread=True).select(KEY, F.col("Id").alias("item"), F.length(t.clean_text(_body())).cast("bigint").alias("n_chars"))
