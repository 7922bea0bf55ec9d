"""Benchmark decontamination by template windows, in DataFrame operations only.

Text becomes tokens (runs of letters and digits).  Numbers, names (capitalised
words that do not start a sentence) and units (a listed word after a number)
are slots: a window of ``WINDOW`` tokens has a literal form and, if it holds
slots, a template form with typed placeholders.  Windows of documents and of
the benchmark are hash-joined in both forms.

A template match counts only if its slots are consistent: along one alignment
of a document with an item, each value of the item stands for one value of the
document and the other way round.  A document is contaminated by an item if
matched windows cover at least ``COVERAGE`` of the item's windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, row_key, small_side, spread, stored

WINDOW = 5
COVERAGE = 0.5
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Words that name a unit where they follow a number.
UNITS = (
    "cent cents dollar dollars euro euros pound pounds percent kilogram kilograms gram grams kg g mg ton tons tonnes "
    "meter meters metre metres kilometer kilometers km m cm mm mile miles foot feet inch inches yard yards "
    "liter liters litre litres l ml gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years degree degrees watt watts volt volts byte bytes"
).split()
SENTENCE = r"(^|[.!?:\n]\s*)(\p{Lu})"
MARK = "\u0001"
PARTS = r"[^\p{L}\p{N}\x01]+"
IS_NAME = r"^\p{Lu}\p{Ll}+$"


def tokens_of(text: Column) -> Column:
    """Tokens; one that starts a sentence with a capital bears a mark in front."""
    plain = F.translate(F.coalesce(text, F.lit("")), MARK, " ")
    joined = F.regexp_replace(plain, r"([0-9])[.,]([0-9])", "$1$2")
    return F.filter(F.split(F.regexp_replace(joined, SENTENCE, f"$1{MARK}$2"), PARTS), lambda t: (t != "") & (t != MARK))


def kind(token: Column, before: Column) -> Column:
    """Placeholder of a token, or null if it is literal."""
    return (F.when(token.rlike(r"^[0-9]"), NUMBER)
            .when(before.rlike(r"^[0-9]") & F.lower(token).isin(UNITS), UNIT)
            .when(token.rlike(IS_NAME), NAME))


def windows(table: DataFrame, key: str) -> DataFrame:
    """``key, n, pos, form, window, slots``: literal and template windows of each text.

    ``slots`` of a template window has the values of its placeholders by place;
    ``n`` is the number of window places of the text.
    """
    tokens = F.transform("tokens", lambda t: F.translate(F.lower(t), MARK, ""))
    kinds = F.transform("tokens", lambda t, i: kind(t, F.when(i > 0, F.get("tokens", i - 1)).otherwise("")))
    base = table.select(key, tokens_of(F.col("text")).alias("tokens")) \
        .filter(F.size("tokens") >= WINDOW).select(key, tokens.alias("plain"), kinds.alias("kinds"))
    places = F.sequence(F.lit(1), F.size("plain") - F.lit(WINDOW - 1))
    literal = F.transform(hashed("plain"), lambda w, i: F.struct(
        i.alias("pos"), F.lit(0).alias("form"), w.alias("window"), F.lit(None).cast("array<string>").alias("slots")))
    slotted = F.filter(places, lambda p: F.exists(F.slice("kinds", p, WINDOW), lambda k: k.isNotNull()))
    template = F.transform(slotted, lambda p: F.struct(
        (p - 1).alias("pos"), F.lit(1).alias("form"),
        F.xxhash64(F.concat_ws(" ", F.zip_with(F.slice("kinds", p, WINDOW), F.slice("plain", p, WINDOW), lambda k, v: F.coalesce(k, v)))).alias("window"),
        F.zip_with(F.slice("kinds", p, WINDOW), F.slice("plain", p, WINDOW), lambda k, v: F.when(k.isNotNull(), F.concat(k, v))).alias("slots")))
    has_slots = F.exists("kinds", lambda k: k.isNotNull())
    found = F.when(has_slots, F.concat(literal, template)).otherwise(literal)
    return base.select(key, (F.size("plain") - F.lit(WINDOW - 1)).alias("n"), found.alias("all")).select(
        key, "n", F.inline_outer("all"))  # the inner form would work out all windows once more to test for none


def hashed(column: str) -> Column:
    """Hash of each window of five tokens, made of hashes of two and four."""
    pair = lambda a, b: F.xxhash64(a, b)
    later = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))
    one = F.transform(column, lambda t: F.xxhash64(t))
    full = let(one, lambda h: let(F.zip_with(h, later(h, 1), pair), lambda two: let(
        F.zip_with(two, later(two, 2), pair), lambda four: F.zip_with(four, later(h, 4), pair))))
    return F.slice(full, 1, F.size(column) - F.lit(WINDOW - 1))


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_matched, n_windows, literal``: documents and the items found in them.

    ``n_matched`` of the item's ``n_windows`` windows are in the document,
    ``literal`` of them word for word.  Items and documents under ``WINDOW``
    tokens (null and empty text among them) have no window and match nothing.
    Repeated rows of one id count as one text each and their windows together;
    rows with null ids are compared too and come out with a null.
    """
    items = stored(windows(benchmark.select("item_id", "text").distinct(), "item_id"), "windows")
    names = items.select("form", "window").distinct()
    hits = windows(spread(docs.select("doc_id", "text")), "doc_id").drop("n")
    hits = stored(hits.join(small_side(names, items.count(), 40), ["form", "window"], "left_semi"), "hits")
    item_side = items.select("item_id", "n", "form", "window", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    met = hits.join(item_side, ["form", "window"])
    literal = met.filter("form = 0").select("doc_id", "item_id", "n", "item_pos", F.lit(1).alias("literal"))
    template = met.filter("form = 1").withColumn("shift", F.col("pos") - F.col("item_pos"))
    template = consistent(template).select("doc_id", "item_id", "n", "item_pos", F.lit(0).alias("literal"))
    # Count each place of an item once per document, before any row meets another key.
    places = literal.unionByName(template).groupBy("doc_id", "item_id", "n", "item_pos").agg(F.max("literal").alias("literal"))
    return places.groupBy("doc_id", "item_id", "n").agg(
        F.count(F.lit(1)).alias("n_matched"), F.sum("literal").alias("literal")).filter(
        F.col("n_matched") >= coverage * F.col("n")).select(
        "doc_id", "item_id", "n_matched", F.col("n").cast("bigint").alias("n_windows"), "literal")


def consistent(met: DataFrame) -> DataFrame:
    """Template matches on alignments whose slot values map one to one."""
    where = ["doc_id", "item_id", "shift"]
    pairs = met.select(*where, F.explode(F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b"))).alias("s")) \
        .select(*where, F.col("s.a").alias("a"), F.col("s.b").alias("b")).filter("a is not null").distinct()
    broken = pairs.groupBy(*where, "a").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select(*where).unionByName(
        pairs.groupBy(*where, "b").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select(*where)).distinct()
    same = [met[c].eqNullSafe(broken[c]) for c in where]
    return met.join(broken, same, "left_anti")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` in which no item is found.

    Each row is judged by its own text, also where rows share an id or have
    none; rows that repeat both are judged alike.  All columns pass through,
    whatever their names.
    """
    names = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("row"))
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("doc_id"), "text")
    found = matches(texts, benchmark, coverage).select(F.col("doc_id").alias("row")).distinct()
    return keyed.join(found, "row", "left_anti").select(*[F.col(f"doc.`{c}`").alias(c) for c in names])
