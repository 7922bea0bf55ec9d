"""Personal data, and terms that disclose it, by information-theoretic sanitisation.

Patterns find the protected entities.  The corpus then tells what else gives
them away: a term in the documents of an entity ``e`` discloses it as far as it
lowers its surprise, measured as ``PMI(e, t) / IC(e)`` from document counts over
the whole collection (1: whoever reads ``t`` can be sure of ``e``).  Terms that
reach ``GENERALISE`` are replaced by a general word, those that reach ``REMOVE``
are taken out, at every place in every document that holds the entity.  A term
must stand with the entity in ``SUPPORT`` different texts at least; one text
alone is no evidence of co-occurrence.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_side, spread, stored, words

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.95
#: Lower-case words below this many letters are no terms; short names, numbers and words of other scripts are.
LEAST_LETTERS = 3

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The patterns of the contract, written so that a long run of one kind of character is read once:
# a local part goes back from its "@", digits and separators are taken without giving back.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = regex.compile(r"[\p{L}\p{N}]+")

Span = tuple[int, int, int]


def emails(text: str):
    before = 0
    for match in DOMAIN.finditer(text):
        start = match.start()
        while start > before and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            before = match.end()
            yield start, before


def small_number(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of e-mail and network addresses, cards and phones, in order."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(map(small_number, m[0].split("."))):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def entity_name(kind: int, value: str) -> str:
    """One name for all ways to write an entity."""
    if kind == 0:
        return f"{KINDS[kind]}:{value.lower()}"
    if kind == 1:
        return f"{KINDS[kind]}:{'.'.join(n.lstrip('0') or '0' for n in value.split('.'))}"
    return f"{KINDS[kind]}:{''.join(DIGIT.findall(value))}"


def contexts(text: str, spans: list[Span]) -> tuple[set[str], dict[str, list[tuple[int, int]]]]:
    """The entities of ``text``, and where its other terms stand."""
    covered = iter(sorted((a, b) for a, _, b in spans))
    where: dict[str, list[tuple[int, int]]] = {}
    inside = next(covered, None)
    for m in TERM.finditer(text):
        while inside and inside[1] <= m.start():
            inside = next(covered, None)
        if inside and inside[0] < m.end():
            continue
        if m.end() - m.start() >= LEAST_LETTERS or not m[0].islower():
            where.setdefault(m[0].lower(), []).append((m.start(), m.end()))
    return {entity_name(kind, text[a:b]) for a, kind, b in spans}, where


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


SPAN = "struct<start:int, kind:int, stop:int>"
SCAN = (
    f"doc_id bigint, digest string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, base array<{SPAN}>, "
    f"entities array<string>, places array<struct<term:string, spans:array<{SPAN}>>>"
)


def scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: base spans, and for texts that have some their context."""
    kind_of = {f.name: f.type for f in _arrow(SCAN)}

    def make():
        def work(batch: pa.RecordBatch):
            rows: dict[str, list] = {name: [] for name in kind_of if name != "doc_id"}
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                entities, where = contexts(text, spans) if spans else (set(), {})
                for kind, name in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
                    rows[name].append(sum(s[1] == kind for s in spans))
                rows["base_sha256"].append(hashlib.sha256(shown(spans).encode()).hexdigest())
                rows["digest"].append(hashlib.md5(text.encode()).hexdigest() if spans else None)
                rows["base"].append([{"start": a, "kind": k, "stop": b} for a, k, b in spans])
                rows["entities"].append(sorted(entities))
                rows["places"].append([{"term": t, "spans": [{"start": a, "kind": 4, "stop": b} for a, b in where[t]]} for t in sorted(where)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(rows[name], kind_of[name]) for name in rows)], ["doc_id", *rows])

        return work

    return map_batches(spread(docs.select("doc_id", "text")), make, SCAN)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def disclosing(scanned: DataFrame, docs: DataFrame) -> DataFrame:
    """``entity, term, disclosure``: the terms that give an entity away.

    Documents are counted over the whole table: those with the entity, those
    with the term anywhere, those with both.  Copies of one text meet first, so
    that each text is looked at once.
    """
    held = scanned.filter(F.size("entities") > 0)
    texts = held.groupBy("digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n")).select("row", "n")
    each = stored(held.select("row", "entities").join(texts, "row"), "texts")
    entities = each.select("n", F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.sum("n").alias("with_entity"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= SUPPORT).drop("texts")
    entities = stored(entities, "entities")
    named = each.select("row", "n", F.explode("entities").alias("entity")).join(small_side(entities, entities.count(), 128), "entity", "left_semi")
    pairs = held.select("row", F.transform("places", lambda p: p.term).alias("terms")).join(named, "row") \
        .select("entity", "n", F.explode("terms").alias("term")) \
        .groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= SUPPORT)
    pairs = stored(pairs, "pairs")
    candidates = stored(pairs.select(F.col("term").alias("word")).distinct(), "terms")
    found = docs.select(F.explode_outer(F.array_distinct(words(F.col("text")))).alias("word"))  # outer: the words are worked out once
    rows = candidates.count()
    if rows * 64 <= 16 << 20:
        counts = found.join(small_side(candidates, rows, 64), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("with_term"))
    else:  # too many to send around: count all words first, where their partial counts are made
        counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("with_term")).join(candidates, "word", "left_semi")
    total = F.log2(F.lit(float(max(1, docs.count()))))
    surprise = total - F.log2("with_entity")
    shared = total + F.log2("together") - F.log2("with_entity") - F.log2(F.greatest("together", F.coalesce("with_term", "together")))
    return pairs.join(entities, "entity").join(counts, F.col("term") == F.col("word"), "left").select(
        "entity", "term", F.when(surprise > 0, shared / surprise).otherwise(0.0).alias("disclosure")).filter(F.col("disclosure") >= GENERALISE)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, terms`` of every row.

    ``spans`` holds the base spans and one span for each place of a disclosing
    term in a text that has the entity it discloses; ``terms`` holds those
    spans with ``removed`` telling what happens to them.  Null text counts as
    empty; repeated rows and null ids are rows of their own; an empty table has
    no rows.  Positions count code points, ends are exclusive.
    """
    scanned = stored(scan(docs).withColumn("row", F.monotonically_increasing_id()), "scan")  # numbered once, then read
    given_away = stored(disclosing(scanned, docs), "disclosing")
    told = scanned.filter(F.size("entities") > 0).select("row", "entities", F.explode(F.transform("places", lambda p: p.term)).alias("term")) \
        .select("row", "term", F.explode("entities").alias("entity")).join(small_side(given_away, given_away.count(), 128), ["entity", "term"]) \
        .groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    places = scanned.filter(F.size("places") > 0).select("row", F.explode("places").alias("p")).select("row", "p.term", "p.spans")
    added = told.join(places, ["row", "term"]).groupBy("row").agg(F.flatten(F.collect_list(F.transform(
        "spans", lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.stop.alias("stop"), (F.col("disclosure") >= REMOVE).alias("removed"))))).alias("terms"))
    bare = F.transform(F.coalesce("terms", F.array().cast(f"array<{SPAN[:-1]}, removed:boolean>>")),
                       lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.stop.alias("stop")))
    names = F.array(*map(F.lit, KINDS))
    return scanned.join(added, "row", "left").withColumn("every", F.sort_array(F.concat("base", bare))).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.array_join(F.transform("every", lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.stop)), ",").alias("spans"), "terms", "base", "digest")


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``: ``[email]`` and so on for base spans, ``[term]`` for
    generalised terms, nothing for removed ones.  Rows are told apart by ``doc_id`` and text; null text stays null.
    """
    found = personal_data(docs).select("doc_id", "digest", "base", "terms").filter(F.size("base") > 0)

    @F.udf("string", useArrow=True)
    def rewrite(text, base, terms):
        if text is None or not base:
            return text
        spans = [(s.start, s.stop, f"[{KINDS[s.kind]}]") for s in base] + [(s.start, s.stop, "" if s.removed else "[term]") for s in terms or ()]
        out, at = [], 0
        for start, stop, mask in sorted(spans):
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, stop)
        return "".join(out) + text[at:]

    one = found.groupBy("doc_id", "digest").agg(F.first("base").alias("_base"), F.first("terms").alias("_terms")).withColumnsRenamed(
        {"doc_id": "_id", "digest": "_digest"})
    same = docs.doc_id.eqNullSafe(one._id) & (F.md5(F.col("text").cast("binary")) == one._digest)
    return docs.join(one, same, "left").withColumn("text", rewrite("text", "_base", "_terms")).drop("_id", "_digest", "_base", "_terms")
