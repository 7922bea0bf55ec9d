"""Near-duplicates by Order MinHash with verification by banded alignment.

A text becomes the sequence of its five-word shingles, each labelled with how
often it occurred before, so that labelled shingles are unique.  For each of
``SKETCHES`` hash orders the two least labelled shingles are taken and kept in
text order; two texts agree with a chance that falls with edits and with
changes of order.  ``ROWS`` sketches make one band.

Texts of a band are compared through leaders: each round has one leader per
bucket and aligns the others with it.  Texts of buckets that are not one class
after ``ROUNDS`` are compared block by block inside their tasks.  Members of
one class need no further comparison, so a group of thousands of copies costs
its size and not its square, and no link between classes that meet in a bucket
is left out.

The alignment is the longest common subsequence of labelled shingles in the
diagonal band that a similarity of ``THRESHOLD`` leaves possible; with ``c``
shared shingles of ``n`` and ``m`` the similarity is ``c / (n + m - c)``.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import cut_lineage
from .common import map_batches, slices, spread, stored, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 30
ROWS = 3
SKETCHES = BANDS * ROWS
ROUNDS = 1
#: Texts of one block, and columns of one matrix product, where classes of a family are compared.
BLOCK = 512
COLUMNS = 4096
#: Shingles sketched at a time in one task; a longer text stands alone.
AT_ONCE = 400_000

_DRAW = np.random.Generator(np.random.PCG64(20))
FACTORS = _DRAW.integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _DRAW.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A full-avalanche step on 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def labelled_shingles(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of rows ``bounds[i]:bounds[i+1]`` of word hashes, and their bounds.

    A row with fewer words than a shingle has one shingle of all its words.
    """
    lengths = np.diff(bounds)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - SHINGLE + 1, 1))
    ends = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(lengths)), counts)
    first = bounds[:-1][row] + (np.arange(ends[-1]) - ends[:-1][row])
    stop = bounds[1:][row]
    padded = np.concatenate([hashes, np.zeros(SHINGLE, np.uint64)])
    value = np.zeros(len(first), np.uint64)
    for k in range(SHINGLE):
        at = first + k
        value = mix(value + np.where(at < stop, padded[at], np.uint64(k + 1)) + np.uint64(1))
    # Label by occurrence: equal shingles of a row stand together, in order, after a stable sort.
    order = np.lexsort((value, row))
    same = np.zeros(len(value), bool)
    if len(value):
        same[1:] = (value[order][1:] == value[order][:-1]) & (row[order][1:] == row[order][:-1])
    place = np.arange(len(value))
    occurrence = np.empty(len(value), np.uint64)
    occurrence[order] = (place - np.maximum.accumulate(np.where(same, 0, place))).astype(np.uint64)
    return np.where(occurrence > 0, mix(value + occurrence * np.uint64(0xD6E8FEB86659FD93)), value), ends


def band_keys(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One key per row and band; every row must have a shingle."""
    starts, counts = ends[:-1], np.diff(ends)
    place = np.arange(len(shingles))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    keys = np.zeros((len(starts), BANDS), np.uint64)
    for s in range(SKETCHES):
        value = shingles * FACTORS[s] + SHIFTS[s]
        value ^= value >> np.uint64(33)
        least = np.minimum.reduceat(value, starts)
        hit = value == np.repeat(least, counts)
        first = np.minimum.reduceat(np.where(hit, place, len(place)), starts)
        value[hit] = top
        second = np.minimum.reduceat(value, starts)
        after = np.minimum.reduceat(np.where(value == np.repeat(second, counts), place, len(place)), starts)
        ordered = first <= after
        band = s // ROWS
        keys[:, band] = mix(keys[:, band] + np.where(ordered, least, second))
        keys[:, band] = mix(keys[:, band] + np.where(ordered, second, least) + np.uint64(band + 1))
    return keys


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two labelled shingle sequences, or 0 where it cannot reach ``threshold``."""
    n, m = len(a), len(b)
    need = threshold * (n + m) / (1 + threshold)
    if min(n, m) < need - 1e-9:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < need - 1e-9:
        return 0.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    j = j[np.abs(i - j) <= max(n, m) - need + 1e-9]  # an alignment that good never leaves this band
    if len(j) and np.all(j[1:] > j[:-1]):
        common = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        common = len(tails)
    found = common / (n + m - common) if n + m else 1.0
    return found if found >= threshold else 0.0


def content_key(text: Column, tokens: Column) -> Column:
    """Equal for texts with the same words; texts without any word go by their characters."""
    return F.md5(F.when(F.size(tokens) > 0, F.array_join(tokens, " "))
                 .otherwise(F.concat(F.lit("\x01"), F.coalesce(text, F.lit("")))))


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, content, shingles binary, bands array<bigint>``; texts without words have no bands."""
    tokens = words(F.col("text"))
    prepared = spread(docs.select("doc_id", "text")).select("doc_id", "text", tokens.alias("tokens")).select(
        "doc_id", content_key(F.col("text"), F.col("tokens")).alias("content"),
        F.transform("tokens", lambda w: F.xxhash64(w)).alias("hashes"))

    def make():
        def work(batch: pa.RecordBatch):
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy().view(np.uint64)
            for start, stop in slices(np.diff(bounds).tolist(), AT_ONCE):
                part = bounds[start : stop + 1]
                values, ends = labelled_shingles(flat[part[0] : part[-1]], part - part[0])
                full = np.flatnonzero(np.diff(ends))
                keys = [None] * (stop - start)
                if len(full):
                    closed = np.concatenate([ends[full], ends[-1:]])
                    for i, row in zip(full.tolist(), band_keys(values, closed).view(np.int64)):
                        keys[i] = row
                short = values.astype(np.uint32)
                blobs = [short[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start),
                     pa.array(blobs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "content", "shingles", "bands"])

        return work

    return map_batches(prepared, make, "doc_id bigint, content string, shingles binary, bands array<bigint>")


def aligned(pairs: DataFrame, sequences: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``x, y`` of ``pairs`` whose sequences are similar enough."""

    def make():
        def work(batch: pa.RecordBatch):
            keep, cache = [], {}
            x, y = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(batch.num_rows):
                if x[k] not in cache:
                    cache = {x[k]: np.frombuffer(batch.column(2)[k].as_buffer(), np.uint32)}
                other = np.frombuffer(batch.column(3)[k].as_buffer(), np.uint32)
                keep.append(distinct_similarity(cache[x[k]], other, threshold) > 0)
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], ["x", "y"])

        return work

    left = sequences.select(F.col("doc_id").alias("x"), F.col("shingles").alias("a"))
    right = sequences.select(F.col("doc_id").alias("y"), F.col("shingles").alias("b"))
    joined = pairs.join(right, "y").join(left, "x").select("x", "y", "a", "b")
    return map_batches(joined, make, "x bigint, y bigint")


def distinct_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """:func:`similarity`, also where shortened labels of one text collide."""
    if len(a) + len(b) > 20_000:
        a, b = first_of_each(a), first_of_each(b)
    try:
        return similarity(a, b, threshold)
    except ValueError:
        return similarity(first_of_each(a), first_of_each(b), threshold)


def first_of_each(a: np.ndarray) -> np.ndarray:
    return a[np.sort(np.unique(a, return_index=True)[1])]


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, class_id, kept`` for every row: near copies share the least ``doc_id`` of their class.

    Rows with the same words are one class at once; others are linked where
    their similarity is at least ``threshold``, and classes are what links
    reach.  Texts without words (null, empty, punctuation) are copies only of
    equal texts; null counts as empty.  A repeated ``doc_id`` is one document
    whose rows share their class.  A null ``doc_id`` is never a representative;
    such a row has the class of its copies, or null.  ``kept`` marks
    ``doc_id = class_id``.  Other columns are ignored; ties go to the least id.
    """
    sketches = stored(sketch(docs), "sketch")
    groups = sketches.groupBy("content").agg(F.min("doc_id").alias("first"))
    members = sketches.select("doc_id", "content").join(groups, "content").select("doc_id", "first")
    heads = sketches.filter("bands is not null and doc_id is not null").select("doc_id", "content", "bands").join(
        groups, "content").filter("doc_id = first")
    buckets = heads.select("doc_id", "content", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count_distinct("doc_id").alias("n")).filter("n > 1")
    buckets = cut_lineage(buckets.join(shared, "key"))
    weights = buckets.groupBy("doc_id", "content").agg(F.sum("n").alias("weight"))
    sequences = stored(sketches.select("doc_id", "content", "shingles").join(weights, ["doc_id", "content"], "left_semi")
                       .select("doc_id", "shingles"), "shingles")
    buckets = buckets.select("doc_id", "key").distinct().join(
        weights.groupBy("doc_id").agg(F.sum("weight").alias("weight")), "doc_id")
    # A repeated id may stand in several groups of copies; these belong together from the start.
    several = members.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min("first").alias("lo"), F.max("first").alias("hi")).filter("lo < hi").select("doc_id", "lo")
    links = cut_lineage(members.join(several, "doc_id").filter("lo < first").select(
        F.col("lo").alias("x"), F.col("first").alias("y")))
    classes = _classes(links)
    tried = links
    for turn in range(rounds + 1):
        apart = _classed(buckets, classes)
        mixed = apart.groupBy("key").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi"), F.min("doc_id").alias("least")).filter("lo < hi")
        apart = cut_lineage(apart.join(mixed.select("key", "least"), "key"))
        if apart.isEmpty():
            break
        if turn < rounds:
            pairs = _with_leaders(apart, turn).distinct().join(tried, ["x", "y"], "left_anti")
            pairs = cut_lineage(pairs)
            tried = tried.unionByName(pairs)
            found = cut_lineage(aligned(pairs, sequences, threshold))
        else:
            found = cut_lineage(_within_families(apart, sequences, threshold))
        if not found.isEmpty():
            links = links.unionByName(found)
            classes = _classes(links)
    return members.join(classes.withColumnRenamed("node", "first"), "first", "left").select(
        "doc_id", F.coalesce("component", "first").alias("class_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def _classes(links: DataFrame) -> DataFrame:
    if links.isEmpty():
        return links.select(F.col("x").alias("node"), F.col("y").alias("component"))
    return components(links, "x", "y")


def _classed(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    return buckets.join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "key", "weight", F.coalesce("component", "doc_id").alias("class_id"))


def _with_leaders(apart: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with its leader, if that is of another class.

    The text that meets most others over all buckets leads: it is the likely
    source of the copies around it.  In later turns the leader comes from
    outside the class that led before.
    """
    best = F.max(F.struct("weight", (-F.col("doc_id")).alias("order"), F.col("doc_id").alias("leader"), F.col("class_id").alias("leader_class")))
    leaders = apart.groupBy("key").agg(best.alias("m")).select("key", "m.leader", "m.leader_class")
    for _ in range(turn):
        rest = apart.join(leaders, "key").filter("class_id <> leader_class").drop("leader", "leader_class")
        leaders = rest.groupBy("key").agg(best.alias("m")).select("key", "m.leader", "m.leader_class")
    return apart.join(leaders, "key").filter("class_id <> leader_class").select(
        F.least("leader", "doc_id").alias("x"), F.greatest("leader", "doc_id").alias("y"))


def _within_families(apart: DataFrame, sequences: DataFrame, threshold: float) -> DataFrame:
    """Links between classes among texts that buckets connect.

    Texts connected through buckets form a family.  A family is cut into blocks,
    and one task compares one block with one other: shared shingles of all pairs
    are counted by matrix products, pairs of two classes that share enough are
    aligned.  A task returns links that join its classes, never pairs.
    """
    families = components(apart.filter("doc_id <> least").select("least", "doc_id"), "least", "doc_id").withColumnRenamed("node", "doc_id")
    texts = apart.select("doc_id", "class_id").distinct().join(families, "doc_id")
    sizes = texts.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    texts = texts.join(sizes, "component").join(sequences, "doc_id").withColumn("own", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    placed = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc_id", "class_id", "shingles")

    def run(key, table):
        ids, classes = table.column("doc_id").to_numpy(), table.column("class_id").to_numpy()
        rows = [first_of_each(np.frombuffer(b, np.uint32)) for b in table.column("shingles").to_pylist()]
        x, y = joining_pairs(rows, classes, threshold)
        return pa.table({"x": pa.array(np.minimum(ids[x], ids[y])), "y": pa.array(np.maximum(ids[x], ids[y]))})

    return placed.groupBy("component", "i", "j").applyInArrow(run, "x bigint, y bigint").distinct()


def joining_pairs(rows: list[np.ndarray], classes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Similar pairs of ``rows`` that join their classes to what similarity makes of them."""
    count = len(rows)
    sizes = np.array([len(r) for r in rows], np.float64)
    owner = np.repeat(np.arange(count), sizes.astype(np.int64))
    values, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    useful = times[column] > 1
    owner, column = owner[useful], column[useful]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((count, count), np.float32)
    at = 0
    while at < len(column):  # columns in slices, so that long texts cost time and not memory
        stop = int(np.searchsorted(column, column[at] + COLUMNS))
        names, local = np.unique(column[at:stop], return_inverse=True)
        held = np.zeros((count, len(names)), np.float32)
        held[owner[at:stop], local] = 1
        shared += held @ held.T
        at = stop
    enough = shared >= threshold / (1 + threshold) * (sizes[:, None] + sizes[None, :]) - 1e-3
    x, y = np.nonzero(np.triu(enough & (classes[:, None] != classes[None, :]), 1))
    parent = {c: c for c in classes.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    kept: list[int] = []
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = root(int(classes[i])), root(int(classes[j]))
        if a != b and similarity(rows[i], rows[j], threshold) > 0:
            parent[max(a, b)] = min(a, b)
            kept.append(k)
    return x[kept], y[kept]


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their class.

    Rows with a null ``doc_id`` stay, as do all rows of a kept ``doc_id``.
    """
    classes = near_duplicates(docs, threshold)
    gone = classes.filter("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
