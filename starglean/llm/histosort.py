"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a key of several non-negative numbers.  Wanted are the keys
that cut this order into ``shards`` runs of nearly equal bytes.  A round counts
the exact bytes and rows below candidate keys (probes) in every partition, and
each cut that no probe meets closely enough gets finer probes between its two
neighbours; only rows between such neighbours are looked at again.  What a
round sends to the driver is bounded by the probes, never by rows.  When all
cuts are known, rows are exchanged once.

A shard may span several tasks: looser cuts inside the shards, found by the
same rounds, part the exchange, and a row's place in its shard is its place in
its task plus the exact count of rows below that task's first key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import spread, stored

SHARDS = 40
#: Bytes every row takes besides its text.
ROW_BYTES = 16
#: Equal texts that take up to this share of a shard's bytes are not cut apart.
TOLERANCE = 0.05
#: Share of a task's bytes by which cuts inside a shard may miss their goal.
LOOSE = 0.25
#: Probes of the first round, and of later rounds together.
PROBES = 1 << 12
BUCKETS = 1 << 12
LAW = "bytes"


def text_number(text: Column) -> Column:
    """Sixty bits of the text's digest, so that equal texts are neighbours; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("bigint")


def ordered_parts(number: Column) -> list[Column]:
    """Two non-negative numbers that order as the bigint does, null first."""
    high = F.shiftright(number, 32) + F.lit((1 << 31) + 1)
    return [F.coalesce(high, F.lit(0)).cast("bigint"), F.coalesce(number.bitwiseAND(F.lit((1 << 32) - 1)), F.lit(0)).cast("bigint")]


@dataclass(frozen=True)
class Cut:
    """The least key right of a cut, what lies left of it, and how many shard borders it is."""

    key: tuple[int, ...]
    bytes: int
    rows: int
    borders: int


@dataclass
class Span:
    """Rows between two neighbouring probes: what they hold, and what lies left of them."""

    prefix: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]
    bytes: int
    rows: int
    bytes_before: int
    rows_before: int
    goals: list[int]

    @property
    def depth(self) -> int:
        """The first part of the key that differs within."""
        return next((i for i, (a, b) in enumerate(zip(self.low, self.high)) if a < b), len(self.low))

    def edge(self, after: bool) -> tuple[int, ...]:
        at = len(self.prefix)
        if at == len(self.low):
            at -= 1
        number = self.high[at] + 1 if after else self.low[at]
        return (*self.low[:at], number, *[0] * (len(self.low) - at - 1))


class _Search:
    """Driver side of the rounds: which spans still hold goals that no probe meets."""

    def __init__(self, total: int, shards: int, pieces: int, tolerance: float):
        self.total, self.parts, self.pieces = total, shards * pieces, pieces
        self.together = tolerance * total / shards
        self.loose = LOOSE * total / self.parts
        self.open: list[Span] = []
        self.found: dict[tuple[int, ...], Cut] = {}

    def place(self, span: Span) -> None:
        """Meet the goals of a span at its edges, or keep it for finer probes."""
        group = not span.prefix and span.low[0] == span.high[0]
        alone = span.rows == 1 or span.depth == len(span.low) or (group and span.bytes <= self.together)
        later = []
        for goal in span.goals:
            if alone or (goal % self.pieces and span.bytes <= self.loose):
                # The whole span goes to the side that holds its middle.
                after = (2 * span.bytes_before + span.bytes) * self.parts < 2 * goal * self.total
                self.meet(goal, span, after)
            else:
                later.append(goal)
        if later:
            span.goals = later
            self.open.append(span)

    def meet(self, goal: int, span: Span, after: bool) -> None:
        key = span.edge(after)
        cut = self.found.get(key)
        borders = (cut.borders if cut else 0) + (goal % self.pieces == 0)
        self.found[key] = Cut(key, span.bytes_before + after * span.bytes, span.rows_before + after * span.rows, borders)

    def divide(self, span: Span, bins: Sequence) -> None:
        """Deal the goals of a span to its bins, which come in key order."""
        weight, count, goals = span.bytes_before, span.rows_before, iter(span.goals)
        goal = next(goals, None)
        for row in bins:
            mine = []
            while goal is not None and goal * self.total < (weight + row["bytes"]) * self.parts:
                mine.append(goal)
                goal = next(goals, None)
            if mine:
                low, high = tuple(row["low"]), tuple(row["high"])
                self.place(Span(low[: span.depth], low, high, row["bytes"], row["rows"], weight, count, mine))
            weight, count = weight + row["bytes"], count + row["rows"]


def inline_table(spark: SparkSession, rows: list[str], names: str) -> DataFrame:
    """A few literal rows as a table."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")


def _held(keys: int) -> list[Column]:
    low = F.array(*[F.min(F.col("key")[i]) for i in range(keys)]).alias("low")
    high = F.array(*[F.max(F.col("key")[i]) for i in range(keys)]).alias("high")
    return [F.sum("size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("rows"), low, high]


def find_cuts(rows: DataFrame, keys: int, shards: int, pieces: int, tolerance: float) -> tuple[list[Cut], Span | None]:
    """Cuts of ``rows`` (``key array<bigint>``, ``size bigint``) in key order, and the span of all rows."""
    whole = rows.agg(*_held(keys)).first()
    if not whole["rows"]:
        return [], None
    every = Span((), tuple(whole["low"]), tuple(whole["high"]), whole["bytes"], whole["rows"], 0, 0, list(range(1, shards * pieces)))
    search = _Search(whole["bytes"], shards, pieces, tolerance)
    search.place(every)
    left = rows.select("key", "size", F.lit(0).alias("span"))
    while search.open:
        spans, search.open = search.open, []
        fan = max(16, PROBES // len(spans))
        lines = []
        for s in spans:
            at = s.depth
            lines.append((at, s.low[at], -(-(s.high[at] - s.low[at] + 1) // fan)))
        if len(spans) == 1:
            depth, least, width = lines[0]
            binned = left.select("key", "size", F.lit(0).alias("span"), F.expr(f"(key[{depth}] - {least}L) div {width}L").alias("bin"))
        else:
            probes = F.broadcast(inline_table(rows.sparkSession, [f"({i}, {d}, {low}L, {w}L)" for i, (d, low, w) in enumerate(lines)], "span, depth, least, width"))
            binned = left.join(probes, "span").select("key", "size", "span", F.expr("(element_at(key, depth + 1) - least) div width").alias("bin"))
        counted = binned.groupBy("span", "bin").agg(*_held(keys)).collect()
        by_span: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["span"], r["bin"])):
            by_span.setdefault(row["span"], []).append(row)
        children = []
        for i, s in enumerate(spans):
            known = len(search.open)
            search.divide(s, by_span[i])
            starts = {tuple(r["low"]): r["bin"] for r in by_span[i]}
            children += [f"({i}, {starts[c.low]}L, {known + j})" for j, c in enumerate(search.open[known:])]
        if children:
            kept = F.broadcast(inline_table(rows.sparkSession, children, "span, bin, child"))
            left = stored(binned.join(kept, ["span", "bin"]).select("key", "size", F.col("child").alias("span")), "between")
    return sorted(search.found.values(), key=lambda c: c.key), every


def _part_of(rows: DataFrame, cuts: list[Cut], every: Span) -> DataFrame:
    """Add ``part``, the number of cuts at or below each row's key."""
    keys = len(every.low)
    least = every.low[0]
    width = -(-(every.high[0] - least + 1) // BUCKETS)
    marks: dict[int, list[Cut]] = {}
    for c in cuts:
        marks.setdefault((c.key[0] - least) // width, []).append(c)
    lines, below = [], 0
    for b in range(BUCKETS):
        inside = marks.get(b, [])
        listed = ", ".join(f"array({', '.join(f'{k}L' for k in c.key)})" for c in inside)
        lines.append(f"({b}L, {below}, cast(array({listed}) as array<array<bigint>>))")
        below += len(inside)
    grid = F.broadcast(inline_table(rows.sparkSession, lines, "bucket, below, inside"))
    placed = rows.withColumn("bucket", F.expr(f"(key[0] - {least}L) div {width}L")).join(grid, "bucket")
    return placed.withColumn("part", (F.col("below") + F.size(F.filter("inside", lambda c: c <= F.col("key")))).cast("int")).drop("bucket", "below", "inside")


def shard_rows(
    df: DataFrame, size: Column, key: Sequence[Column], shards: int = SHARDS, tolerance: float = TOLERANCE, pieces: int | None = None
) -> DataFrame:
    """``df`` with ``shard int`` and ``slot bigint``, shards of nearly equal ``size`` in ``key`` order.

    ``key`` lists non-negative bigints (see :func:`text_number`, :func:`ordered_parts`);
    rows with equal keys are told apart by their number in the stored input, so
    repeated rows are cut like any others.  Rows that share the first number of
    the key stay in one shard up to ``tolerance`` of a shard's bytes; beyond that
    their run is cut between rows, so a shard misses its share by half a row or
    half of ``tolerance`` at either end.  With fewer rows than shards some shards
    are empty.  An empty table gives an empty result.  Columns named ``shard``
    and ``slot`` are replaced; all others pass through, whatever their names.
    ``pieces`` is the number of tasks a shard is exchanged to, by default as many
    as the session's shuffle partitions allow; the result does not depend on it.
    """
    spark = df.sparkSession
    if pieces is None:
        pieces = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    names = [c for c in df.columns if c not in ("shard", "slot")]
    numbers = F.array(*key, F.monotonically_increasing_id())
    rows = stored(df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), numbers.alias("key"), size.cast("bigint").alias("size")), "unsorted")
    cuts, every = find_cuts(rows, len(key) + 1, shards, pieces, tolerance)
    whole = F.col("row.*")
    if every is None:
        return rows.select(whole, F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    lines, shard, rows_before = ["(0, 0, 0L)"], 0, [0]
    for i, c in enumerate(cuts):
        if c.borders:
            shard += c.borders
            rows_before.append(c.rows)
        lines.append(f"({i + 1}, {shard}, {c.rows - rows_before[-1]}L)")
    parts = F.broadcast(inline_table(spark, lines, "part, shard, before"))
    dealt = _part_of(rows, cuts, every).repartitionById(len(lines), F.col("part"))
    inside = Window.partitionBy("part").orderBy("key")
    placed = dealt.withColumn("place", F.row_number().over(inside)).join(parts, "part")
    return placed.select(whole, "shard", (F.col("before") + F.col("place") - 1).cast("bigint").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, pieces: int | None = None) -> DataFrame:
    """Whole documents with ``shard`` and ``slot``; a document's size is its text in UTF-8 and ``ROW_BYTES``.

    The order is that of the text's digest, then ``doc_id`` (null first): copies of
    a text are neighbours.  Null text takes no bytes.
    """
    return shard_rows(docs, _bytes(F.col("text")), _document_key(), shards, tolerance, pieces)


def write_shards(docs: DataFrame, folder: str, **options: int) -> None:
    """:func:`shard_documents` written as one folder per shard, rows in slot order within each file."""
    placed = shard_documents(docs, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES


def _document_key() -> list[Column]:
    return [text_number(F.col("text")), *ordered_parts(F.col("doc_id"))]


def shard_digest(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = spread(docs.select("doc_id", "text")).select(
        "doc_id", _bytes(F.col("text")).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.array(*_document_key()).alias("key"))
    key = [F.col("key")[i] for i in range(3)]
    return shard_rows(slim, F.col("size"), key, shards, tolerance).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same in DuckDB's SQL: whole groups of equal texts are units, except those above the tolerance.
SHARD_SQL = f"""
WITH crc AS (SELECT list(list_reduce(list_concat([CAST(n AS BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda c, z: CASE WHEN c % 2 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END) ORDER BY n) AS steps FROM range(256) r(n)),
texts AS (SELECT text, xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS crc
          FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents), crc),
keyed AS (SELECT row_number() OVER () AS row_, doc_id, crc, CAST(coalesce(strlen(d.text), 0) + {ROW_BYTES} AS HUGEINT) AS size,
                 CAST('0x' || substr(md5(coalesce(d.text, '')), 1, 15) AS BIGINT) AS h
          FROM documents d JOIN texts t ON coalesce(d.text, '') = t.text),
whole AS (SELECT sum(size) AS total FROM keyed),
sums AS (SELECT *, sum(size) OVER (PARTITION BY h) AS held, sum(size) OVER (ORDER BY h) - sum(size) OVER (PARTITION BY h) AS held_before,
                coalesce(sum(size) OVER (ORDER BY h, doc_id NULLS FIRST, row_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_ FROM keyed),
units AS (SELECT *, CASE WHEN held * {SHARDS} <= CAST({TOLERANCE} AS DECIMAL(9, 6)) * total THEN 2 * held_before + held ELSE 2 * before_ + size END AS middle FROM sums, whole),
placed AS (SELECT *, CAST(middle * {SHARDS} // (2 * total) AS INTEGER) AS shard FROM units)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, '{LAW}' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id NULLS FIRST, row_) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM placed
"""
