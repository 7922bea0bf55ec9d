"""Text cleaning as column expressions.

The character classes are spelled out because Python's ``\\s``, ``\\w`` and ``\\d``
are Unicode-aware while Java's are ASCII, and Java's Unicode mode still differs
from Python's (marks, information separators).
"""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import costly

# Character classes and patterns the results depend on.
SPACES = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as a class that turns most letters away by two comparisons, before the long list is gone through.
SPACE = rf"[\x00-\x20\x7f-\x{{10ffff}}&&[{SPACES}]]"
CONTROL_CHARS = r"[\x00-\x1F\x7F]"
URLS = rf"http[^{SPACES}]+|www[^{SPACES}]+"
LINE_BREAKS = r"[\r\n\t]+"
NON_ASCII = r"[^\x00-\x7F]"
PUNCTUATION = rf"[\x00-\x60\x7b-\x{{10ffff}}&&[^\p{{L}}\p{{N}}_{SPACES}]]"
DIGITS = r"[0-9\x{660}-\x{10ffff}&&[\p{Nd}]]+"
HTML_TAG = r"<.*?>"
LABEL_PREFIX = "__label__"
LISTED_CONTROL_CHARS = [
    "\x01", "\x11", "\x7f", "\x17", "\x13", "\x14", "\x16", "\x04", "\x18", "\x1d", "\x0f",
    "\x1b", "\x1f", "\x05", "\x10", "\x19", "\x0e", "\x08", "\x06", "\x02", "\x07", "\x15",
]

# The public English stopword list used for shingling.
STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
wasn wasn't weren weren't won won't wouldn wouldn't
""".split()


@arrow_udf(T.StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())


def unescape_html(text: Column) -> Column:
    """HTML entities to characters; texts without ``&`` never leave the JVM."""
    candidate = F.when(text.contains("&"), text)
    return F.coalesce(costly(_unescape)(candidate), text)


def remove_control_chars(text: Column) -> Column:
    """Control characters vanish, newlines and tabs included, so adjacent lines fuse."""
    return F.regexp_replace(text, CONTROL_CHARS, "")


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URLS, "")


def line_breaks_to_space(text: Column) -> Column:
    return F.regexp_replace(text, LINE_BREAKS, " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def clean_text(text: Column, newline_as_space: bool = False) -> Column:
    """The canonical cleaner.  ``newline_as_space`` keeps words on adjacent lines apart.

    Line breaks are control characters, so by default none is left to turn into
    a space after the first step.
    """
    if newline_as_space:
        text = line_breaks_to_space(text)
    return collapse_spaces(remove_urls(remove_control_chars(text)))


def clean_special_chars(text: Column) -> Column:
    """The alternative cleaner: runs of non-ASCII characters become one space."""
    spaced = F.regexp_replace(line_breaks_to_space(remove_urls(text)), f"{NON_ASCII}+", " ")
    return collapse_spaces(spaced)


def unescape_quotes(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\'"), F.lit("'")), F.lit('\\"'), F.lit('"'))


def remove_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


def remove_digits(text: Column) -> Column:
    return F.regexp_replace(text, DIGITS, "")


def words(text: Column) -> Column:
    """Whitespace tokens, without empty ones; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def remove_stopwords(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Drop exact stopwords and re-join with one space; repeats of kept words stay."""
    return F.array_join(F.filter(words(text), lambda w: ~w.isin(stopwords)), " ")


def normalize_for_shingles(text: Column, order: str = "script") -> Column:
    """Extra normalisation before shingling.

    ``script`` lowers first; ``notebook`` removes stopwords while the text still
    has its capitals, so "The" survives as "the".
    """
    if order == "script":
        return remove_stopwords(remove_digits(remove_punctuation(F.lower(text))))
    if order == "notebook":
        return F.lower(remove_stopwords(remove_digits(remove_punctuation(text))))
    raise ValueError(f"unknown order: {order}")


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.regexp_replace(text, f"{SPACE}+", "") == "")


def has_non_ascii(text: Column) -> Column:
    return text.rlike(NON_ASCII)


def has_html_tag(text: Column) -> Column:
    return text.rlike(HTML_TAG)


def has_any_char(text: Column, chars: list[str] = LISTED_CONTROL_CHARS) -> Column:
    """True if any of the literal characters occurs."""
    return text.rlike("[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]")


def has_escaped_quote(text: Column) -> Column:
    return text.contains("\\'") | text.contains('\\"')


def strip_label_prefix(label: Column) -> Column:
    return F.replace(label, F.lit(LABEL_PREFIX), F.lit(""))


def parse_int_list(text: Column) -> Column:
    """``"[ 12 -3\\n 6]"`` to an array of longs."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(-?\d+)")), lambda x: x.cast("bigint"))


def part_number(file_name: Column) -> Column:
    return F.regexp_extract(file_name, r"part-(\d+)", 1).try_cast("int")
