"""Readers, sinks, re-runnable publishing, resume, audit."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.text import part_number
from ..schema import KEY
from ..session import spread_rows

# Accepted Parquet codecs, and the Parquet magic bytes.
CODECS = ("snappy", "gzip", "brotli", "zstd", "none")
PARQUET_MAGIC = b"PAR1"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """Headered CSV whose quoted text may hold separators, quotes and newlines."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    reader = reader.option("quote", '"').option("escape", '"').option("sep", sep).option("encoding", encoding)
    return spread_rows(reader.csv(path))


def read_csv_text(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", encoding: str = "utf-8"
) -> DataFrame:
    """CSV with every column a string, empty cells kept as empty strings, malformed lines skipped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("mode", "DROPMALFORMED")
    reader = reader.option("quote", '"').option("escape", '"').option("sep", sep).option("encoding", encoding)
    return spread_rows(reader.csv(path)).na.fill("")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any work if a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing columns {missing}; present: {df.columns}")
    return df


def require_path(spark: SparkSession, path: str) -> str:
    """Fail early if ``path`` (any file system Spark can reach) does not exist."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        raise FileNotFoundError(path)
    return path


def named_entries(spark: SparkSession, folder: str, pattern: str) -> tuple[list[str], list[str]]:
    """Files, and folders of part files (not partitions ``k=v``), that ``pattern`` names in ``folder``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    tables = [f.getPath().toString() for f in found if f.isDirectory() and "=" not in f.getPath().getName()]
    return [f.getPath().toString() for f in found if f.isFile()], tables


def read_parquet_folder(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """All that ``pattern`` names in ``folder``: files, or folders of part files as Spark writes a table."""
    flat, tables = named_entries(spark, folder, pattern)
    if tables:
        return spark.read.parquet(*flat, *tables)
    return spark.read.option("pathGlobFilter", pattern).parquet(folder)


def first_files(spark: SparkSession, folder: str, n: int, pattern: str = "*.parquet") -> DataFrame:
    """The first ``n`` files in name order.  The others are never opened."""
    listing = sorted(read_parquet_folder(spark, folder, pattern).inputFiles())
    return spark.read.parquet(*listing[:n])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in each part file; ``mode="append"`` adds parts.

    Empty strings are written quoted, so they do not come back as null.
    """
    (
        df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", mode: str = "overwrite") -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}: {codec}")
    if codec == "brotli":
        raise ValueError("brotli needs a codec library that stock Spark does not ship; use zstd")
    df.write.mode(mode).option("compression", codec).parquet(path)


def publish_partition(df: DataFrame, path: str, partition: str, codec: str = "snappy") -> None:
    """Atomic and re-runnable: a second run replaces the partitions it touches and no others."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec)
        .partitionBy(partition).parquet(path)
    )


def pending_rows(df: DataFrame, written: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not yet written: where a resumed job goes on."""
    return df.join(written.select(key), key, "left_anti")


def part_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per part file: its number, rows, and the time of the audit."""
    parts = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return parts.withColumn("part", part_number(F.col("file_name"))).withColumn("created", F.current_timestamp())


def run_summary(spark: SparkSession, path: str, total: int, failed: int = 0) -> DataFrame:
    """Rows offered, rows written, rows failed, number of parts."""
    out = spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("written"), F.count_distinct("_metadata.file_name").alias("parts")
    )
    return out.select(
        F.lit(total).cast("bigint").alias("total"), "written", F.lit(failed).cast("bigint").alias("failed"), "parts"
    )


@arrow_udf(T.BooleanType())
def _has_magic(paths: pa.Array) -> pa.Array:
    def intact(uri: str) -> bool:
        system, path = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
        with system.open_input_file(path) as handle:
            size = handle.size()
            return size >= 8 and handle.read_at(4, 0) == handle.read_at(4, size - 4) == PARQUET_MAGIC

    return pa.array([intact(p) for p in paths.to_pylist()])


def parquet_magic_check(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Whether each file starts and ends with the Parquet magic bytes; reads eight bytes per file."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return listed.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), _has_magic("path").alias("intact"))
