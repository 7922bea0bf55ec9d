"""Incremental jobs: filter and append, running counts, resumable embedding, dead letters.

All read a folder of files as a stream, run what is there (``availableNow``) and
remember progress in a checkpoint, so a second start handles new files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rows import split_bad_rows
from ..operators.filters import in_language
from ..operators.language import Profiles, tag_language
from ..plans.jobs import embed_rows
from ..schema import KEY, SCORE
from ..sources.files import named_entries


def read_folder(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files that ``pattern`` names in ``folder``, or of the part files in folders that it names."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if named_entries(spark, folder, pattern)[1]:
        return reader.parquet(f"{folder.rstrip('/')}/{pattern}")
    return reader.option("pathGlobFilter", pattern).parquet(folder)


def filter_language(stream: DataFrame, profiles: Profiles, text: str, out: str, checkpoint: str, language: str = "en", min_tokens: int = 1) -> None:
    """Tag each new row and append the rows of one language."""
    kept = in_language(tag_language(stream, profiles, text, min_tokens), language)
    query = kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start(out).awaitTermination()


def count_languages(stream: DataFrame, profiles: Profiles, text: str, out: str, checkpoint: str, min_tokens: int = 1) -> None:
    """Running language counts, a complete table per micro-batch; :func:`latest_counts` reads the last one.

    A batch writes its table below ``out/version=N`` and then an empty file
    ``out/done/N``.  Readers go by the marks, so they never see half a table,
    and a batch that is replayed writes the same version again.
    """
    counts = tag_language(stream, profiles, text, min_tokens).groupBy("lang").count()

    def publish(batch: DataFrame, number: int) -> None:
        write_version(batch, out, number)

    query = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish)
    query.trigger(availableNow=True).start().awaitTermination()


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_version(table: DataFrame, out: str, number: int) -> None:
    """Write a complete table and, once it is there, mark it as such."""
    table.write.mode("overwrite").parquet(f"{out}/version={number}")
    mark, system = _folder(table.sparkSession, f"{out}/done/{number}")
    system.create(mark, True).close()


def latest_version(spark: SparkSession, out: str) -> int | None:
    """The last version that is marked as complete."""
    marks, system = _folder(spark, f"{out}/done")
    if not system.exists(marks):
        return None
    return max((int(f.getPath().getName()) for f in system.listStatus(marks)), default=None)


def latest_counts(spark: SparkSession, out: str) -> DataFrame:
    """The last complete table; none yet is an error."""
    number = latest_version(spark, out)
    if number is None:
        raise FileNotFoundError(f"no complete version in {out}")
    return spark.read.parquet(f"{out}/version={number}")


def embed_stream(stream: DataFrame, model, out: str, dead_letters: str, checkpoint: str, dims: int = 64) -> None:
    """Embed each micro-batch into its own partition; a replayed batch overwrites itself.

    Rows that cannot be processed go to ``dead_letters`` with the reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = split_bad_rows(batch).persist()
        try:
            bad, good = batch.filter("_error is not null"), batch.filter("_error is null").drop("_error")
            bad.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
            typed = good.withColumn(SCORE, F.col(f"`{SCORE}`").cast("double"))
            embed_rows(typed, model, dims=dims).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    query.trigger(availableNow=True).start().awaitTermination()


__all__ = ["KEY", "count_languages", "embed_stream", "filter_language", "latest_counts", "latest_version", "read_folder", "split_bad_rows", "write_version"]
