"""Phrase collocations by best-first branch and bound.

A phrase of two to four words is scored by its weakest cut into two parts,
``a`` occurrences of the phrase against ``l`` and ``r`` of the parts.  What a
phrase can still grow into is bounded by its count alone: a longer phrase that
starts with ``p`` occurs ``f(p)`` times at most, and cutting it behind its first
word ``w`` scores ``2000000 f(p) / (f(w) + f(p))`` at most.  The same holds from
the other end.  Per language a threshold is taken from the scores known so far;
only phrases whose bounds reach it grow, with all languages and all phrases of
one length growing in one pass over the corpus.  Whatever scores the threshold
or more is then known exactly, and whether a longer phrase swallows it.  If
fewer phrases than wanted survive, the threshold falls and the frontier grows.

Words are counted once; the corpus is then kept as 64-bit word numbers, which
are checked to be unique, and later passes read only these.  Sets that steer a
pass (frequent words and pairs, the frontier) travel as Bloom filters of bounded
size: a false hit counts a phrase in vain, which the exact counts show.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import running_total
from .common import map_batches, slices, spread, stored, texts_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters that part pieces, and those that part words.
PIECE_END, WORD_END = ".,;:!?\n\x0b\x0c\r", " \t"
NO_LANGUAGE = "und"
LONGEST = 4
LEAST_COUNT = 30
TOP = 2000
SCALE = 2_000_000
#: A longer phrase swallows a shorter one from this share of its count on, in percent.
SWALLOW = 80
#: Words remembered per task, and letters and tokens handled at once.
REMEMBERED, LETTERS, TOKENS = 1 << 18, 1 << 23, 1 << 21
#: Bits of a Bloom filter per member, and at most.
MEMBER_BITS, MOST_BITS = 16, 1 << 26
BREAK, NOTHING = 0, 1

_BYTES = bytes.maketrans((UPPER + PIECE_END + WORD_END).encode(), (LOWER + "\n" * len(PIECE_END) + " " * len(WORD_END)).encode())
CODED = "tokens array<bigint>, lang string, code bigint, word string, n bigint"


class Coder(dict):
    """Place of each word of one language in its lists of words and numbers; breaks and empty strings come first."""

    def __init__(self, lang: str, seed: int):
        super().__init__({b"\n": 0, b"": 1})
        self.start, self.seed = lang.encode() + b"\0", seed
        self.words, self.numbers = [b"\n", b""], [BREAK, NOTHING]

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(self.start + word, self.seed) | 2
        self.words.append(word)
        self.numbers.append(number - (1 << 64) if number >= 1 << 63 else number)
        self[word] = place = len(self)
        return place


def coded_corpus(docs: DataFrame, seed: int) -> DataFrame:
    """Rows of two kinds: a document's ``tokens``, and ``lang, code, word, n`` of the words of some documents."""

    def code():
        coders: dict[str, Coder] = {}

        def some(langs: list[str | None], texts: list[str]) -> Iterator[pa.RecordBatch]:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs, texts):
                lang = NO_LANGUAGE if lang is None else lang
                coder = coders.get(lang)
                if coder is None:
                    coder = coders[lang] = Coder(lang, seed)
                words = text.encode().translate(_BYTES).replace(b"\n", b" \n ").split(b" ")
                words.append(b"\n")
                by_lang.setdefault(lang, []).append(np.fromiter(map(coder.__getitem__, words), np.int64, len(words)))
            for lang, rows in by_lang.items():
                coder = coders[lang]
                numbers = np.array(coder.numbers, np.int64)
                yield _coded(tokens=pa.array([numbers[r[r != 1]] for r in rows], pa.list_(pa.int64())), rows=len(rows))
                counts = np.bincount(np.concatenate(rows), minlength=len(numbers))
                counts[:2] = 0
                seen = np.flatnonzero(counts)
                words = pa.array([coder.words[i].decode() for i in seen.tolist()], pa.string())
                yield _coded(lang=pa.array([lang] * len(seen), pa.string()), code=pa.array(numbers[seen]), word=words, n=pa.array(counts[seen]), rows=len(seen))
            if sum(map(len, coders.values())) > REMEMBERED:
                coders.clear()

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lengths = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            for start, stop in slices(lengths, LETTERS):
                part = batch.slice(start, stop - start)
                yield from some(part.column("lang").to_pylist(), texts_of(part.column("text")))
        return work

    return map_batches(spread(docs.select("lang", "text")), code, CODED)


def _coded(rows: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"tokens": pa.list_(pa.int64()), "lang": pa.string(), "code": pa.int64(), "word": pa.string(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, k)) for c, k in kinds.items()], list(kinds))


def mixed(left: Column | np.ndarray, right: Column | np.ndarray) -> Column | np.ndarray:
    """One number for two, the same in a column and in an array."""
    if isinstance(left, np.ndarray):
        wide = left.view(np.uint64)
        return ((wide << np.uint64(23)) | (wide >> np.uint64(41))).view(np.int64) ^ right
    return F.shiftleft(left, 23).bitwiseOR(F.shiftrightunsigned(left, 41)).bitwiseXOR(right)


class Bloom:
    """A set of 64-bit numbers, with false hits but no false misses."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    @classmethod
    def of(cls, members: DataFrame, number: Column) -> Bloom:
        """Built by tasks that merge bits; the driver sees the bits set, at most ``MOST_BITS``."""
        size = 1 << 12
        while size < MEMBER_BITS * members.count() and size < MOST_BITS:
            size *= 2
        spots = members.select(number.alias("h")).select(F.explode(F.array(
            F.col("h").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(size - 1)))).alias("at"))
        bits = spots.groupBy(F.shiftright("at", 6).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
        words = np.zeros(size // 64, np.uint64)
        words[bits.column("slot").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
        return cls(words)

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        wide = numbers.view(np.uint64)
        return self._bit(wide & self.mask) & self._bit((wide >> np.uint64(32)) & self.mask)

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


Steer = Callable[[np.ndarray], np.ndarray]


def counted(coded: DataFrame, length: int, steer: Steer, least: int) -> DataFrame:
    """``phrase array<bigint>, a`` of all phrases of ``length`` that ``steer`` lets through, from ``least`` occurrences on.

    ``steer`` gets the tokens of some documents and says where a phrase to count may start.
    """
    names = [f"c{i}" for i in range(length)]

    def count():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            tokens = batch.column("tokens").flatten().to_numpy()
            for start in range(0, len(tokens), TOKENS):
                part = tokens[start : start + TOKENS + length - 1]
                if len(part) < length:
                    continue
                starts = np.flatnonzero(steer(part))
                if not len(starts):
                    continue
                values, dense = np.unique(part, return_inverse=True)
                number = dense[starts]
                for i in range(1, length):
                    number = number * len(values) + dense[starts + i]
                    if i < length - 1:
                        number = np.unique(number, return_inverse=True)[1]
                _, first, n = np.unique(number, return_index=True, return_counts=True)
                columns = [pa.array(part[starts[first] + i]) for i in range(length)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n)], [*names, "n"])
        return work

    found = map_batches(coded.filter("tokens is not null").select("tokens"), count, ", ".join(f"{c} bigint" for c in names) + ", n bigint")
    return found.groupBy(*names).agg(F.sum("n").alias("a")).filter(F.col("a") >= least).select(F.array(*names).alias("phrase"), "a")


def _whole(column: Column) -> Column:
    """Room for products beyond 64 bits."""
    return column.cast("decimal(19,0)")


def _div(top: Column, bottom: Column) -> Column:
    # Both are whole and positive: what is left over goes first, so the quotient is exact.
    return ((top - top % bottom) / bottom).cast("bigint")


@dataclass
class Corpus:
    coded: DataFrame
    words: DataFrame  # phrase, lang, word, f: words frequent enough for phrases
    totals: DataFrame  # lang, n: all words


def read_corpus(docs: DataFrame, least: int) -> Corpus:
    """Count words and number them; if two words share a number, all are numbered anew."""
    seed = 0
    while True:
        coded = stored(coded_corpus(docs, seed), "coded")
        listed = coded.filter("code is not null").groupBy("code", "lang", "word").agg(F.sum("n").alias("f"))
        words = stored(listed, "words")
        if not words.groupBy("code").agg(F.count(F.lit(1)).alias("words")).filter("words > 1").limit(1).count():
            break
        seed += 1
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = words.filter(F.col("f") >= least).select(F.array("code").alias("phrase"), "lang", "word", "f")
    return Corpus(coded, stored(frequent, "frequent"), totals)


def scored(phrases: DataFrame, known: DataFrame, length: int) -> DataFrame:
    """``phrase, lang, a, l, r, score`` by the weakest cut; phrases with a part that is not known are left out.

    ``known`` has ``phrase, f`` of all shorter phrases that may be parts.
    """
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), F.slice("phrase", 1, k).alias("left"), F.slice("phrase", k + 1, length - k).alias("right")) for k in range(1, length)])
    parts = phrases.select("phrase", "a", F.inline(cuts))
    left = known.select(F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select(F.col("phrase").alias("right"), F.col("f").alias("r"))
    judged = parts.join(left, "left").join(right, "right").withColumn("score", _score("a", F.col("l"), F.col("r")))
    weakest = judged.groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.count(F.lit(1)).alias("cuts"))
    return weakest.filter(F.col("cuts") == length - 1).select("phrase", "a", "cut.l", "cut.r", "cut.score")


def _score(a: str, l: Column, r: Column) -> Column:  # noqa: E741
    return _div(F.lit(SCALE).cast("decimal(7,0)") * _whole(F.col(a)), _whole(l) + _whole(r))


def ranked_score(scores: DataFrame, wanted: DataFrame) -> DataFrame:
    """``lang, floor``: the score at rank ``wanted`` of each language of ``wanted`` (``lang, wanted``), 0 if there are fewer.

    Ranks are read off the counts per score, of which there are a million at most.
    """
    counts = scores.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score"))))
    hit = upto.join(wanted, "lang").filter(F.col("upto") >= F.col("wanted")).groupBy("lang").agg(F.max("score").alias("floor"))
    return wanted.join(hit, "lang", "left").select("lang", F.coalesce("floor", F.lit(0)).cast("bigint").alias("floor"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST_COUNT, ahead: int = 2) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    Null text is empty and null ``lang`` is ``und``; repeated rows count as often
    as they occur; ``doc_id`` and other columns do not matter.  Ties in score go
    by count, then by phrase.  An empty table, or one without frequent phrases,
    gives an empty result.  ``ahead`` is how many times ``top`` scores the first
    threshold lets through; it changes the work, not the result.
    """
    corpus = read_corpus(docs, least)
    word_f = corpus.words.select("phrase", "f")
    first_f = corpus.words.select(F.col("phrase")[0].alias("first"), "lang", F.col("f").alias("first_f"))
    last_f = corpus.words.select(F.col("phrase")[0].alias("last"), F.col("f").alias("last_f"))
    frequent = Bloom.of(corpus.words, F.col("phrase")[0])

    def both_frequent(t: np.ndarray) -> np.ndarray:
        ok = frequent.holds(t) & (t != BREAK)
        return ok[:-1] & ok[1:]

    def ends(phrases: DataFrame) -> DataFrame:
        """With language and the two bounds."""
        both = phrases.withColumns({"first": F.col("phrase")[0], "last": F.element_at("phrase", -1)}).join(first_f, "first").join(last_f, "last")
        return both.withColumns({"grown": _score("a", F.col("first_f"), F.col("a")), "led": _score("a", F.col("last_f"), F.col("a"))}).drop("first", "last", "first_f", "last_f")

    pairs = counted(corpus.coded, 2, both_frequent, least)
    pairs = stored(ends(scored(stored(pairs, "pairs"), word_f, 2)), "pairs")
    pair_f = pairs.select("phrase", F.col("a").alias("f"))
    is_pair = Bloom.of(pairs, mixed(F.col("phrase")[0], F.col("phrase")[1]))
    wanted = pairs.select("lang").distinct().withColumn("wanted", F.lit(ahead * top))
    floors = stored(ranked_score(pairs, wanted), "floors")
    while True:
        marked = stored(pairs.join(floors, "lang"), "marked")
        triples = stored(_triples(corpus, marked, is_pair, least), "triples")
        known = word_f.unionByName(pair_f)
        good3 = stored(ends(scored(triples, known, 3)), "good3")
        known = known.unionByName(triples.select("phrase", F.col("a").alias("f")))
        quads = stored(_quads(corpus, stored(good3.join(floors, "lang"), "marked"), is_pair, least), "quads")
        good4 = stored(ends(scored(quads, known, 4)), "good4")
        columns = ["phrase", "lang", "a", "l", "r", "score"]
        candidates = pairs.select(*columns).unionByName(good3.select(*columns)).unionByName(good4.select(*columns))
        swallowed = _longer(triples, 3).unionByName(_longer(quads, 4)).groupBy("phrase").agg(F.max("a").alias("longer"))
        reached = candidates.join(floors, "lang").filter("score >= floor").join(swallowed, "phrase", "left")
        alive = F.col("longer").isNull() | (_whole(F.col("longer")) * 100 < _whole(F.col("a")) * SWALLOW)
        reached = stored(reached.withColumn("alive", alive), "reached")
        # A language is settled if enough phrases live, or if nothing was held back.
        short = reached.groupBy("lang").agg(F.count_if("alive").alias("living"), F.count(F.lit(1)).alias("seen"))
        short = floors.join(short, "lang", "left").filter((F.col("floor") > 0) & (F.coalesce("living", F.lit(0)) < top))
        lower = stored(ranked_score(candidates, short.select("lang", (F.coalesce("seen", F.lit(0)) * 2 + top).alias("wanted"))), "floors")
        if not lower.limit(1).count():
            break
        floors = stored(floors.join(lower.withColumnRenamed("floor", "lower"), "lang", "left").select("lang", F.coalesce("lower", "floor").alias("floor")), "floors")
    # Words come back, and the order is complete.
    spelled = reached.filter("alive").select(*columns, F.posexplode("phrase").alias("pos", "code"))
    names = corpus.words.select(F.col("phrase")[0].alias("code"), "word")
    phrases = spelled.join(names, "code").groupBy("phrase", "lang", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
    spelled = phrases.select("lang", F.array_join("words.word", " ").alias("phrase"), "a", "l", "r", "score", (-F.col("score")).alias("below"), (-F.col("a")).alias("rarer"), F.lit(1).cast("bigint").alias("one"))
    ranked = running_total(spelled, "one", ["below", "rarer", "phrase"], ["lang"], "rank").filter(F.col("rank") <= top)
    return ranked.join(corpus.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _longer(phrases: DataFrame, length: int) -> DataFrame:
    """The two phrases one word shorter, with the longer one's count."""
    inside = F.array(F.slice("phrase", 1, length - 1), F.slice("phrase", 2, length - 1))
    return phrases.select(F.explode(inside).alias("phrase"), "a")


def _triples(corpus: Corpus, marked: DataFrame, is_pair: Bloom, least: int) -> DataFrame:
    """Phrases of three words that grow from a pair at either end whose bound reaches the threshold."""
    number = mixed(F.col("phrase")[0], F.col("phrase")[1])
    grows, led = Bloom.of(marked.filter("grown >= floor"), number), Bloom.of(marked.filter("led >= floor"), number)

    def steer(t: np.ndarray) -> np.ndarray:
        pair = mixed(t[:-1], t[1:])
        ok = is_pair.holds(pair) & (t[:-1] != BREAK) & (t[1:] != BREAK)
        return ok[:-1] & ok[1:] & (grows.holds(pair)[:-1] | led.holds(pair)[1:])

    return counted(corpus.coded, 3, steer, least)


def _quads(corpus: Corpus, marked: DataFrame, is_pair: Bloom, least: int) -> DataFrame:
    """Phrases of four words that can reach the threshold, or may swallow one of three words that does."""
    number = mixed(mixed(F.col("phrase")[0], F.col("phrase")[1]), F.col("phrase")[2])
    grows, led, reach = (Bloom.of(marked.filter(f"{c} >= floor"), number) for c in ("grown", "led", "score"))

    def steer(t: np.ndarray) -> np.ndarray:
        pair = mixed(t[:-1], t[1:])
        triple = mixed(pair[:-1], t[2:])
        ok = is_pair.holds(pair) & (t[:-1] != BREAK) & (t[1:] != BREAK)
        head, tail = triple[:-1], triple[1:]
        wanted = (grows.holds(head) & led.holds(tail)) | reach.holds(head) | reach.holds(tail)
        return ok[:-2] & ok[1:-1] & ok[2:] & wanted

    return counted(corpus.coded, 4, steer, least)


def _grams(length: int) -> str:
    words = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(length))
    return f"SELECT lang, {words} AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {length - 2})) AS i FROM pieces)"


#: The same in DuckDB's SQL, with all phrases counted.
PHRASE_SQL = f"""
WITH lowered AS (SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[\\x20\\x09]'), lambda x: x <> '') AS w FROM lowered),
grams AS (SELECT 1 AS m, * FROM ({_grams(1)}) UNION ALL SELECT 2, * FROM ({_grams(2)}) UNION ALL SELECT 3, * FROM ({_grams(3)}) UNION ALL SELECT 4, * FROM ({_grams(4)})),
counts AS (SELECT m, lang, phrase, string_split(phrase, ' ') AS w, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY m, lang, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang),
cands AS (SELECT m, lang, phrase, w, f AS a FROM counts WHERE m > 1 AND f >= {LEAST_COUNT}),
cuts AS (SELECT m, lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:m], ' ') AS rp FROM (SELECT *, unnest(range(1, m)) AS k FROM cands)),
parts AS (SELECT c.*, x.f AS l, y.f AS r, {SCALE} * a // (x.f + y.f) AS score FROM cuts c
          JOIN counts x ON x.lang = c.lang AND x.phrase = c.lp JOIN counts y ON y.lang = c.lang AND y.phrase = c.rp),
weakest AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase
           FROM (SELECT *, unnest(range(1, m - size + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS size FROM cands WHERE m > 2))),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY lang, phrase),
alive AS (SELECT c.* FROM weakest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE longer IS NULL OR 100 * longer < {SWALLOW} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive)
SELECT r.lang, r.rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {TOP}
"""
