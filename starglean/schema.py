"""Column layouts of the stage tables and the surrogate row key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import cut_lineage

# Column names of the raw review files.
ITEM = "Id"
SCORE = "review/score"
SUMMARY = "review/summary"
TEXT = "review/text"
USER = "User_id"
CLEAN = "cleanText"
LANG = "lang"
SENTIMENT = "sentiment_score"
KEY = "review_id"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STRING, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
VECTOR = T.ArrayType(T.FloatType())

RAW_REVIEWS = _struct((ITEM, STRING), (SCORE, DOUBLE), (SUMMARY, STRING), (TEXT, STRING), (USER, STRING))
CLEANED = _struct((KEY, LONG), (ITEM, STRING), (SCORE, DOUBLE), (CLEAN, STRING))
LANGUAGE_TAGGED = _struct((KEY, LONG), (ITEM, STRING), (SCORE, DOUBLE), (CLEAN, STRING), (LANG, STRING))
LANGUAGE_STATS = _struct(("language", STRING), ("count", LONG), ("percent", DOUBLE))
MINHASH = _struct((KEY, LONG), ("signature", T.ArrayType(LONG)), ("rating", DOUBLE))
EMBEDDINGS = _struct(
    (KEY, LONG), ("row_id", STRING), (SCORE, DOUBLE), (CLEAN, STRING),
    ("embedding", VECTOR), (SENTIMENT, T.FloatType()),
)
PCA_EMBEDDINGS = _struct(
    (KEY, LONG), ("row_id", STRING), (SCORE, DOUBLE), (SENTIMENT, T.FloatType()), ("embedding_pca", VECTOR)
)
REDUCED_EMBEDDINGS = _struct(
    (KEY, LONG), ("row_id", STRING), (SCORE, DOUBLE), (SENTIMENT, T.FloatType()), ("embedding_umap_15", VECTOR)
)
CLUSTER_RESULTS = _struct(
    (KEY, LONG), ("row_id", STRING), ("rating", DOUBLE), (SENTIMENT, DOUBLE),
    ("cluster_kmeans", INT), ("cluster_dbscan", INT),
)
CLUSTER_SUMMARY = _struct(
    ("cluster", INT), ("mean", DOUBLE), ("std", DOUBLE), ("overrating_count", LONG),
    ("total_reviews", LONG), ("overrating_pct", DOUBLE),
)


def as_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: names, order and types.

    A measure that cannot be cast becomes null; a key that cannot be cast
    raises, since a null key would silently lose its row in later joins.
    """
    def typed(field: T.StructField) -> Column:
        source = F.col(f"`{field.name}`")
        value = source.try_cast(field.dataType)
        if field.name == KEY:
            lost = source.isNotNull() & value.isNull()
            value = F.when(lost, F.raise_error(F.concat(F.lit(f"not a {KEY}: "), source.cast("string"))).cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return df.select([typed(f) for f in schema.fields])


def with_content_key(df: DataFrame, slots: int | None = None) -> DataFrame:
    """Add a ``review_key`` that depends on row content only: content hash plus copy number.

    Numbering the copies inside one group would put a hot group into one task,
    so copies are spread over ``slots`` (the number of shuffle partitions unless
    given), numbered per slot, and shifted by the slot sizes before.  The set of keys is the same whatever
    the partitioning.  Mint the key once, persist it, and join on nothing else.
    """
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.withColumn("_content", F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256))
    slotted = cut_lineage(hashed.withColumn("_slot", F.spark_partition_id() % slots))
    earlier = Window.partitionBy("_content").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        slotted.groupBy("_content", "_slot").count()
        .withColumn("_shift", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    )
    within = Window.partitionBy("_content", "_slot").orderBy("_content")
    return (
        slotted.withColumn("_rank", F.row_number().over(within))
        .join(shifts, ["_content", "_slot"])
        .withColumn("review_key", F.concat_ws("-", "_content", F.col("_shift") + F.col("_rank")))
        .drop("_content", "_slot", "_shift", "_rank")
    )


def with_review_id(df: DataFrame, start: int = 0) -> DataFrame:
    """Add the bigint ``review_id`` that all stages join on: ``start`` plus the place of the row's content key.

    It depends on the rows' contents only, not on their files or partitions.
    Only keys are put in order; rows meet their number by one join.  Mint it
    once for each lot of files, with ``start`` beyond the numbers given so far,
    and write it down with the rows.  A column of that name is replaced.
    """
    from .operators.ordering import global_row_number

    keyed = cut_lineage(with_content_key(df.drop(KEY)))
    numbers = global_row_number(keyed.select("review_key"), ["review_key"], KEY)
    return keyed.join(numbers, "review_key").withColumn(KEY, F.col(KEY) + F.lit(start - 1)).drop("review_key")
