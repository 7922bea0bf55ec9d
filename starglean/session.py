"""Session set-up, the shared working folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its rows, written out, measure at most this many bytes.
BROADCAST_BYTES = 8 << 20

_FALLBACK: dict[str, str] = {}


def local_session(cpus: str | int = "*", app: str = "starglean") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; a cluster without
    the setting is an error, because executors could not see each other's files.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        # The setting cannot be changed in a running session, so the folder is remembered here.
        path = _FALLBACK.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="starglean-")
        _FALLBACK[context.applicationId] = path
    if context.getCheckpointDir() is None or not context.getCheckpointDir().startswith(
        (path, f"file:{path}")
    ):
        context.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def cut_round(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` for loops.

    A checkpoint inherits the estimated size of its plan.  A join estimates the
    product of its sides, so each round of a loop would double the digits of the
    estimate, until planning takes longer than the work.  A frame made from the
    checkpoint's rows starts without an estimate.
    """
    spark, rows = df.sparkSession, cut_lineage(df)._jdf
    return DataFrame(spark._jsparkSession.createDataFrame(rows.toJavaRDD(), rows.schema()), spark)


def costly(udf: Callable[..., Column]) -> Callable[..., Column]:
    """Have the optimizer evaluate a model-like function once per row.

    A deterministic function may be copied into a pushed-down or inferred
    filter and so run twice; marking it non-deterministic keeps it in place.
    """
    return udf.asNondeterministic()  # type: ignore[attr-defined]


def spread_rows(scan: DataFrame) -> DataFrame:
    """Use all cores on a scan that has too few splits.

    A multi-line CSV file or a Parquet file with one row group is one task,
    however large.  With splits for more than half of the cores (any sizeable
    folder) nothing happens: text is not shuffled for a few missing splits.
    Call it on a scan: counting splits must not run a job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if 2 * scan.rdd.getNumPartitions() <= cores and cores > 1 else scan


def join_small(
    left: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join with a side that is *usually* small.

    ``small`` is materialised once and its rows are measured.  Up to
    ``max_bytes`` it is broadcast, so a hot key in ``left`` never moves; beyond
    that the join is a plain shuffle join, where adaptive execution splits
    skewed partitions.
    """
    small = cut_lineage(small)
    row = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in small.columns])))
    if (small.agg(F.sum(row + 16)).first()[0] or 0) <= max_bytes:
        small = F.broadcast(small)
    return left.join(small, on, how)
