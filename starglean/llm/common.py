"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

#: A side is broadcast only if its counted rows times its row width stay below this many bytes.
BROADCAST_BYTES = 16 << 20
#: Everything that is not a letter or digit parts words.
NOT_WORD = r"[^\p{L}\p{N}]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def row_key(*columns: Column) -> Column:
    """A 128-bit name for a row's content; null and the empty string differ."""
    parts = [F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns]
    return F.md5(F.concat_ws("\x01", *parts))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later steps read the written table, so a lost executor costs a re-read of a
    part and never a second run of the work above it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Hint a broadcast only where ``rows`` of ``width`` bytes prove to be small."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many parts as there are cores, if it is a scan with fewer."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.repartition(cores) if parts < cores else df


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """``mapInArrow`` with ``make()`` called once per task to set up what its batches share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null counts as the empty text."""
    return [t or "" for t in column.to_pylist()]


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``most`` units each; a longer row stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
