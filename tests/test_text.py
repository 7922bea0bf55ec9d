"""Literal rows for what the supplied texts do not contain."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starglean.functions import hashing, text as t


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "s string").select(expression(F.col("s"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("a &amp; b", "a & b"), ("x&nbsp;y", "x y"), ("&lt;b&gt;", "<b>"), ("no entity", "no entity"), (None, None),
])
def test_unescape_html(spark, raw, expected):
    assert one(spark, raw, t.unescape_html) == expected


@pytest.mark.parametrize("raw, expected", [
    ("see http://a.b/c now", "see now"), ("wwwhat is", "is"), ("ahttp://x b", "a b"), ("l1\nl2", "l1l2"), ("tab\there", "tabhere"),
    ("\x01bad\x7f", "bad"), ("x y", "x y"), ("  a   b  ", "a b"), ("   ", ""), ("", ""), (None, None),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, raw, t.clean_text) == expected


def test_clean_text_can_keep_lines_apart(spark):
    assert one(spark, "l1\nl2\tl3", lambda c: t.clean_text(c, newline_as_space=True)) == "l1 l2 l3"


def test_clean_special_chars(spark):
    assert one(spark, "caféé on\nwww.x.y top", t.clean_special_chars) == "caf on top"


@pytest.mark.parametrize("raw, expected", [("it\\'s", "it's"), ('\\"q\\"', '"q"'), ("plain", "plain")])
def test_unescape_quotes(spark, raw, expected):
    assert one(spark, raw, t.unescape_quotes) == expected


def test_punctuation_keeps_letters_of_all_scripts(spark):
    assert one(spark, "café, d'or_1 ½!", t.remove_punctuation) == "café dor_1 ½"


def test_orders_differ_on_capital_stopwords(spark):
    raw = "The cat, the dog: 2 dogs don't"
    assert one(spark, raw, t.normalize_for_shingles) == "cat dog dogs dont"
    assert one(spark, raw, lambda c: t.normalize_for_shingles(c, "notebook")) == "the cat dog dogs dont"


def test_repeated_words_survive_stopword_removal(spark):
    assert one(spark, "good the good", t.remove_stopwords) == "good good"


@pytest.mark.parametrize("raw, expected", [("[ 12 345\n 6]", [12, 345, 6]), ("[-1]", [-1]), ("", [])])
def test_parse_int_list(spark, raw, expected):
    assert one(spark, raw, t.parse_int_list) == expected


@pytest.mark.parametrize("raw, q, expected", [
    (None, 1, [""]), ("", 1, [""]), ("", 2, [""]), ("one", 1, ["one"]), ("one", 2, ["one"]),
    ("one two three", 1, ["one", "two", "three"]), ("one two three", 2, ["one two", "two three"]),
    ("one two three", 5, ["one two three"]), ("  a b a b ", 2, ["a b", "b a", "a b"]),
])
def test_shingles(spark, raw, q, expected):
    assert one(spark, raw, lambda c: hashing.shingles(c, q)) == expected


@pytest.mark.parametrize("data, expected", [(b"", 0), (b"hello", 613153351), (b"hello, world", 345750399), (b"The quick brown fox jumps over the lazy dog", 776992547)])
def test_murmur3_known_values(data, expected):
    assert hashing.murmur3_32(data) == expected


def test_signature_equals_plain_arithmetic(spark):
    a, b = hashing.hash_coefficients()
    words = ["alpha", "beta", "gamma"]
    expected = [min((int(x) * hashing.murmur3_32(w.encode()) + int(y)) % hashing.HASH_SPACE for w in words) for x, y in zip(a, b)]
    assert one(spark, "alpha beta gamma beta", hashing.text_signature) == expected
    empty = [int(y) % hashing.HASH_SPACE for y in b]
    assert one(spark, None, hashing.text_signature) == empty


def test_label_prefix_and_part_number(spark):
    assert one(spark, "__label__en", t.strip_label_prefix) == "en"
    assert one(spark, "part-00017.parquet", t.part_number) == 17
    assert one(spark, "other.parquet", t.part_number) is None


def test_word_hashes_of_a_column_are_those_of_single_words(monkeypatch):
    def one_by_one(data, seed=0):
        raise AssertionError("hashed on its own")

    words = ["", "a", "ab", "abc", "abcd", "é" * 7, "😀", "\x00", "x" * 101] * 20
    want = [hashing.murmur3_32(w.encode()) for w in words]
    long = ["y" * 4003, "z" * 9]
    assert hashing.murmur3_all(pa.array(words + long)).tolist() == [*want, *(hashing.murmur3_32(w.encode()) for w in long)]
    assert hashing.murmur3_all(pa.array(words).slice(3, 9)).tolist() == want[3:12]
    assert hashing.murmur3_all(pa.array([], pa.string())).tolist() == []
    monkeypatch.setattr(hashing, "murmur3_32", one_by_one)
    assert hashing.murmur3_all(pa.array(words)).tolist() == want


def test_narrowed_classes_hold_the_same_characters(spark):
    """Every character of the basic plane and some beyond, one row each."""
    codes = [c for c in [*range(0x10000), 0x1D7CE, 0x1F600, 0x20000, 0x10FFFF] if not 0xD800 <= c <= 0xDFFF]
    rows = spark.createDataFrame([(chr(c),) for c in codes], "x string")
    plain = {t.SPACE: f"[{t.SPACES}]", t.PUNCTUATION: rf"[^\p{{L}}\p{{N}}_{t.SPACES}]", t.DIGITS: r"\p{Nd}+"}
    for new, old in plain.items():
        assert rows.filter(F.col("x").rlike(new) != F.col("x").rlike(old)).count() == 0
