"""Spelling variants by a trie of letter-group counts.

Every word has a signature: how often it holds the letters of each of sixteen
groups, four bits a group, counts above fifteen cut to fifteen.  The signatures
form a trie, one group a level.  An inserted letter raises one count by one, a
deleted one lowers one, a replaced one does both; cutting counts brings them
closer, never apart.  So the words one edit away from a word lie where a search
from the root arrives that may go one above the word's count once (surplus) and
one below it once (deficit).

Nearness goes both ways, so a search goes above before it goes below: it finds
the words whose signature comes later, and those with the same one, and the
former learn of it in return.

The upper trie, nodes that hold many words, is found by counting prefixes; its
leaves are buckets of a bounded number of words.  A word is sent to each bucket
its search arrives at; there the search goes on depth-first through the
bucket's own subtrie, and the words at its leaves are verified letter by
letter.  Only counts and the best word per searching word leave a task, never
pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, spread, stored, texts_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTER = "[a-zÀ-ÿ]"
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Spellings counted in memory before they are handed on.
SEEN = 1 << 18
#: Of so many spellings one is garbled on purpose.
GARBLE = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A word's form is at least so many times as frequent.
TIMES = 2
LEVELS = 16
#: The most frequent letters have a level of their own; the others share the rest.
SINGLE = 12
#: Words of a bucket, unless that makes more than ``MOST_SPLITS`` nodes of a level too large; then buckets grow.
BUCKET_WORDS, MOST_SPLITS = 8192, 4096
#: Searching words per task, search states handled at once, word pairs verified at once.
VISITORS, STATES, PAIRS = 1 << 14, 1 << 16, 1 << 17
#: Longer words are verified one by one.
WIDTH = 40

WORDS = "word string, n bigint, signature bigint"
FOUND = "word string, n_near bigint, best_n bigint, best string"


def lowered(text: str) -> str:
    """A-Z in lower case, all other letters as they are."""
    return text.lower() if text.isascii() else text.encode().translate(_LOWER).decode()


def spellings(doc_id: str, text: str, least_letters: int) -> Iterator[tuple[str, int]]:
    """The spellings of a text and how often each occurs; garbled ones lack a letter."""
    start = zlib.crc32(f"{doc_id}:".encode())
    # A run loses one letter at most, so shorter ones are left out at once.
    for run, n in Counter(re.findall(f"{LETTER}{{{least_letters},}}", lowered(text))).items():
        h = zlib.crc32(run.encode(), start)
        if h % GARBLE:
            yield run, n
        elif len(run) > least_letters:
            at = h % len(run)
            yield run[:at] + run[at + 1 :], n


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` over all texts; a null ``doc_id`` counts as empty in the garbling."""

    def count():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            seen: dict[str, int] = {}
            for doc_id, text in zip(texts_of(batch.column("doc")), texts_of(batch.column("text"))):
                for word, n in spellings(doc_id, text, least_letters):
                    seen[word] = seen.get(word, 0) + n
                if len(seen) > SEEN:
                    yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})
                    seen = {}
            yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
        return work

    rows = spread(docs.select("doc_id", "text")).select(F.col("doc_id").cast("string").alias("doc"), "text")
    return map_batches(rows, count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_levels(words: DataFrame) -> np.ndarray:
    """The level of each of the 256 letters, from their counts over the distinct words."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    ranked = sorted(((-r["count"], r["letter"]) for r in letters.collect() if r["letter"]))
    level = np.full(256, LEVELS - 1, np.uint8)
    for i, (_, letter) in enumerate(ranked):
        level[ord(letter)] = i if i < SINGLE else SINGLE + (i - SINGLE) % (LEVELS - SINGLE)
    return level


def signatures(words: list[bytes], level: np.ndarray) -> np.ndarray:
    """Four bits a level, the first level on top."""
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), lengths)
    letters = np.frombuffer(b"".join(words), np.uint8)
    counts = np.bincount(row * LEVELS + level[letters], minlength=len(words) * LEVELS).reshape(-1, LEVELS)
    shifts = np.arange(LEVELS - 1, -1, -1, dtype=np.uint64) * np.uint64(4)
    return (np.minimum(counts, 15).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)


def prefixes(signature: np.ndarray, depth: int) -> np.ndarray:
    return signature >> np.uint64(4 * (LEVELS - depth)) if depth else np.zeros_like(signature)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where sorted ``known`` holds each value, and -1 elsewhere."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


class Trie:
    """Prefixes per depth, sorted; a prefix that has no longer one below is a leaf."""

    def __init__(self, levels: list[np.ndarray], leaves: list[np.ndarray]):
        self.levels, self.leaves = levels, leaves

    @classmethod
    def whole(cls, signature: np.ndarray) -> Trie:
        levels = [np.unique(prefixes(signature, d)) for d in range(LEVELS + 1)]
        none = np.zeros(0, np.uint64)
        return cls(levels, [none] * LEVELS + [levels[-1]])

    def search(self, signature: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Depth-first search of many words at once: words' positions, and prefix and depth of a leaf they reach.

        A state is a word, a node, and whether surplus and deficit are spent.
        States of one depth are handled together, so many at a time, and those
        they lead to come before all others.  The deficit is spent after the
        surplus only, which leaves the signatures not before a word's own.
        """
        n = len(signature)
        stack = [(0, np.arange(n), np.zeros(n, np.uint64), np.zeros(n, bool), np.zeros(n, bool))]
        while stack:
            depth, who, node, above, below = stack.pop()
            if len(who) > STATES:
                stack.append((depth, who[STATES:], node[STATES:], above[STATES:], below[STATES:]))
                who, node, above, below = who[:STATES], node[:STATES], above[:STATES], below[:STATES]
            ends = among(node, self.leaves[depth]) >= 0
            if ends.any():
                yield who[ends], node[ends], depth
                who, node, above, below = who[~ends], node[~ends], above[~ends], below[~ends]
            if depth == LEVELS or not len(who):
                continue
            count = (prefixes(signature[who], depth + 1) & np.uint64(15)).astype(np.int64)
            step = [np.arange(len(who)), np.flatnonzero(~above & (count < 15)), np.flatnonzero(above & ~below & (count > 0))]
            shift = np.repeat([0, 1, -1], [len(s) for s in step])
            at = np.concatenate(step)
            child = (node[at] << np.uint64(4)) | (count[at] + shift).astype(np.uint64)
            there = among(child, self.levels[depth + 1]) >= 0
            at, shift, child = at[there], shift[there], child[there]
            if len(at):
                stack.append((depth + 1, who[at], child, above[at] | (shift > 0), below[at] | (shift < 0)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    head = next((i for i in range(short) if a[i] != b[i]), short)
    rest = 1 if len(a) == len(b) else 0
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    return longer[head + 1 :] == shorter[head + rest :]


class Letters:
    """Words as two letter matrices, one flush left and one flush right."""

    def __init__(self, words: list[bytes], pad: int):
        self.words = words
        self.lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
        # Long words get an empty row here.
        fit = [w if len(w) <= WIDTH else b"" for w in words]
        fill = bytes([pad])
        self.left = np.frombuffer(b"".join(w.ljust(WIDTH, fill) for w in fit), np.uint8).reshape(-1, WIDTH)
        self.right = np.frombuffer(b"".join(w[::-1].ljust(WIDTH, fill) for w in fit), np.uint8).reshape(-1, WIDTH)


def _equal_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    same = a == b
    return np.where(same.all(axis=1), WIDTH, same.argmin(axis=1))


def verified(left: Letters, right: Letters, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart: what agrees at both ends leaves at most one letter of the longer word."""
    la, lb = left.lengths[a], right.lengths[b]
    ok = np.abs(la - lb) <= 1
    longest = np.maximum(la, lb)
    short = np.flatnonzero(ok & (longest <= WIDTH))
    agree = _equal_run(left.left[a[short]], right.left[b[short]])
    apart = agree < longest[short]
    agree += _equal_run(left.right[a[short]], right.right[b[short]])
    out = np.zeros(len(a), bool)
    out[short] = apart & (agree >= longest[short] - 1)
    for i in np.flatnonzero(ok & (longest > WIDTH)).tolist():
        out[i] = one_edit(left.words[a[i]], right.words[b[i]])
    return out


def _ranks(n: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Best first: most frequent, then least word."""
    spelled = np.empty(len(n), np.int64)
    spelled[np.array(sorted(range(len(n)), key=words.__getitem__), np.int64)] = np.arange(len(n))
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((spelled, -n))] = np.arange(len(n))
    return rank


class _Tally:
    """How many words are near each of some words, and which of them is best."""

    def __init__(self, table: pa.Table, others: pa.Table, rank: np.ndarray):
        self.table, self.others, self.rank = table, others, rank
        self.near = np.zeros(table.num_rows, np.int64)
        self.best = np.full(table.num_rows, others.num_rows, np.int64)

    def add(self, word: np.ndarray, other: np.ndarray) -> None:
        self.near += np.bincount(word, minlength=len(self.near))
        np.minimum.at(self.best, word, self.rank[other])

    def result(self) -> pa.Table:
        some = np.flatnonzero(self.near)
        top = pa.array(np.argsort(self.rank)[self.best[some]])
        return pa.table({
            "word": self.table.column("word").take(pa.array(some)), "n_near": self.near[some],
            "best_n": self.others.column("n").take(top), "best": self.others.column("word").take(top)})


def near_words(visitors: pa.Table, members: pa.Table) -> pa.Table:
    """Near pairs of a visitor and a member, summed up for each of them.

    Pairs of one signature count for the visitor only: each of the two visits.
    """
    texts = [[w.encode("latin-1") for w in t.column("word").to_pylist()] for t in (visitors, members)]
    sigs = [t.column("signature").to_numpy().view(np.uint64) for t in (visitors, members)]
    ranks = [_ranks(t.column("n").to_numpy(), w) for t, w in zip((visitors, members), texts)]
    left, right = Letters(texts[0], 0), Letters(texts[1], 1)
    order = np.argsort(sigs[1], kind="stable")
    ordered = sigs[1][order]
    mine, theirs = _Tally(visitors, members, ranks[1]), _Tally(members, visitors, ranks[0])
    for who, leaf, _ in Trie.whole(sigs[1]).search(sigs[0]):
        first, last = np.searchsorted(ordered, leaf, "left"), np.searchsorted(ordered, leaf, "right")
        ends = np.cumsum(last - first)
        for start in range(0, int(ends[-1]), PAIRS):
            flat = np.arange(start, min(start + PAIRS, int(ends[-1])))
            state = np.searchsorted(ends, flat, "right")
            a, b = who[state], order[last[state] - (ends[state] - flat)]
            good = verified(left, right, a, b)
            a, b = a[good], b[good]
            mine.add(a, b)
            later = sigs[0][a] != sigs[1][b]
            theirs.add(b[later], a[later])
    return pa.concat_tables([mine.result(), theirs.result()])


def _prefix(depth: int) -> Column:
    return F.expr(f"shiftrightunsigned(signature, {4 * (LEVELS - depth)})") if depth else F.lit(0).cast("bigint")


def upper_trie(signed: DataFrame, bucket_words: int) -> Trie:
    """Nodes with more than ``bucket_words`` words, down to their first descendants with fewer.

    At most ``words / bucket_words`` nodes of a level have more, each with
    sixteen children, so what comes to the driver is bounded.
    """
    none = np.zeros(0, np.uint64)
    levels, leaves = [np.zeros(1, np.uint64)], [none]
    sums = stored(signed.groupBy("signature").agg(F.count(F.lit(1)).alias("words")), "signatures")
    inside = sums
    for depth in range(1, LEVELS + 1):
        nodes = inside.groupBy(_prefix(depth).alias("node")).agg(F.sum("words").alias("words")).toArrow()
        node, words = nodes.column("node").to_numpy().view(np.uint64), nodes.column("words").to_numpy()
        large = node[words > bucket_words] if depth < LEVELS else none
        levels.append(np.sort(node))
        leaves.append(np.sort(np.setdiff1d(node, large)))
        if not len(large):
            break
        rows = ", ".join(f"({x}L)" for x in large.view(np.int64).tolist())
        split = signed.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(above)")
        inside = sums.join(F.broadcast(split), F.col("above") == _prefix(depth), "left_semi")
    depth = len(levels)
    return Trie(levels + [none] * (LEVELS + 1 - depth), leaves + [none] * (LEVELS + 1 - depth))


def home_of(signature: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray]:
    """Prefix and depth of the leaf each word lies below."""
    leaf, at = np.zeros(len(signature), np.uint64), np.full(len(signature), -1)
    for depth, leaves in enumerate(trie.leaves):
        node = prefixes(signature, depth)
        here = (among(node, leaves) >= 0) & (at < 0)
        leaf[here], at[here] = node[here], depth
    return leaf, at


def near_summary(words: DataFrame, bucket_words: int | None = None, visitors: int = VISITORS) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``words`` (``word, n``) that has a near word.

    Words must consist of U+0000 to U+00FF beyond U+0001.  ``best`` is the near
    word of largest ``n``, of those the least.
    """
    level = letter_levels(words)

    def sign():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(signatures(texts, level).view(np.int64))], ["word", "n", "signature"])
        return work

    signed = stored(map_batches(words.select("word", "n"), sign, WORDS), "signed")
    if bucket_words is None:
        bucket_words = max(BUCKET_WORDS, -(-signed.count() // MOST_SPLITS))
    trie = upper_trie(signed, bucket_words)

    def route():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            signature = batch.column("signature").to_numpy().view(np.uint64)
            own, at = home_of(signature, trie)
            for who, node, depth in trie.search(signature):
                home = (own[who] == node) & (at[who] == depth)
                taken = batch.take(pa.array(who))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.full(len(who), depth, np.int32)), pa.array(node.view(np.int64)), pa.array(home)],
                    ["word", "n", "signature", "depth", "bucket", "home"])
        return work

    visits = stored(map_batches(signed, route, WORDS + ", depth int, bucket bigint, home boolean"), "visits")
    key = ["depth", "bucket"]
    sizes = visits.groupBy(*key).agg(F.count(F.lit(1)).alias("visitors"), F.count_if("home").alias("members"))
    # Many visitors are cut into blocks that each see all members, many members (of one signature) into blocks all visitors see.
    blocks = sizes.select(*key, F.ceil(F.col("visitors") / visitors).cast("int").alias("across"), F.ceil(F.col("members") / (2 * bucket_words)).cast("int").alias("down"))
    blocks = stored(blocks, "blocks")
    dealt = visits.join(blocks, key)
    mine = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = [*key, "a", "d", "word", "n", "signature"]
    searching = dealt.withColumn("a", mine("across")).withColumn("d", every("down")).select(*columns, F.lit(True).alias("searching"))
    searched = dealt.filter("home").withColumn("d", mine("down")).withColumn("a", every("across")).select(*columns, F.lit(False).alias("searching"))
    empty = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def run(block: pa.Table) -> pa.Table:
        mask = block.column("searching")
        q, x = block.filter(mask), block.filter(pc.invert(mask))
        return near_words(q, x).cast(empty) if q.num_rows and x.num_rows else empty.empty_table()

    found = searching.unionByName(searched).groupBy(*columns[:4]).applyInArrow(run, FOUND)
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: the last word that following ``word -> form`` arrives at.

    A form is at least twice as frequent, so paths are short; each round doubles
    the steps taken.
    """
    known = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not moved.filter("moved").limit(1).count():
            return known
        known = moved.drop("moved")


def spelling_variants(docs: DataFrame, bucket_words: int | None = None, visitors: int = VISITORS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word met often enough in ``docs``.

    Null and empty texts have no words; a null ``doc_id`` counts as empty;
    repeated rows count as often as they occur; other columns do not matter.  An
    empty table gives an empty result.  Words of any length are compared whole.
    """
    words = stored(word_counts(docs), "words")
    found = near_summary(words, bucket_words, visitors)
    judged = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best_n") >= TIMES * F.col("n"), F.struct("best", "best_n")).alias("top"))
    judged = stored(judged.select("word", F.col("top.best").alias("form"), "n", "n_near", F.col("top.best_n").alias("form_n")), "judged")
    ends = roots(judged.filter("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same in DuckDB's SQL: near words meet in the spellings that lack one letter.
VARIANT_SQL = f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_concat([CAST(n AS BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END) ORDER BY n) AS steps FROM range(256) r(n)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS word FROM documents),
told AS (SELECT doc, word, count(*) AS n FROM runs GROUP BY doc, word HAVING length(word) >= {LEAST_LETTERS}),
hashed AS (SELECT word, n, xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                list_transform(regexp_extract_all(hex(encode(doc || ':' || word)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h FROM told, crc),
spelled AS (SELECT CASE WHEN h % {GARBLE} = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
lacking AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word AS word, b.word AS near, b.n AS near_n FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM lacking a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM lacking a JOIN words b ON a.rest = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
judged AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN near_n >= {TIMES} * w.n THEN near END AS form, CASE WHEN near_n >= {TIMES} * w.n THEN near_n END AS form_n
           FROM words w LEFT JOIN ranked r ON r.word = w.word AND k = 1),
path AS (SELECT word, coalesce(form, word) AS root FROM judged UNION SELECT p.word, j.form FROM path p JOIN judged j ON j.word = p.root WHERE j.form IS NOT NULL),
ends AS (SELECT p.word, p.root FROM path p JOIN judged j ON j.word = p.root WHERE j.form IS NULL)
SELECT j.word, j.form, e.root, j.n, CAST(j.n_near AS BIGINT) AS n_near, CAST(j.form_n AS BIGINT) AS form_n FROM judged j JOIN ends e ON e.word = j.word
"""
