"""URL rules by a sort-merge range join, in DataFrame operations only.

A host in canonical form has its labels reversed, each with a dot behind
(``www.example.com`` is ``com.example.www.``), so a rule's host and all its
subdomains are one interval of keys.  Rules with one path form a class; within
a class intervals are nested or apart.  A url enters the class of each rule
path its own path starts with, as one key per distinct host and class.

Keys and the two ends of each interval are sorted together, in ranges.  A
sweep keeps the stack of open rules: an opening end raises the depth, a closing
end lowers it, and the rule on top at depth ``d`` is the last one opened at
depth ``d``.  An interval that runs on into later ranges is opened again at the
start of each of them, which costs at most the depth of the stack per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Verdict where no rule fits.
OTHERWISE = "allow"
CLOSE, CARRY, OPEN, KEY = -1, 0, 1, 2

RULES = "action string, host string, path string"
#: The rules of the registered query.
EXAMPLE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """One row per host and path.  Rules without host, path or action are void; ``block`` wins where both are given."""
    usable = rules.filter("action in ('allow', 'block') and host <> '' and path <> ''").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "action")
    return usable.groupBy("host", "path").agg(F.max("action").alias("action")).select(
        "host", "path", "action", canonical(F.col("host")).alias("low"))


def sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """For ``path, host`` of ``keys`` the innermost rule of class ``path`` that covers the host."""
    spark = keys.sparkSession
    none = F.lit(None).cast("string")
    low = rules.withColumnRenamed("low", "key")
    # '.' ends every key; '/' is the next character, so it closes what '.' opens.
    high = rules.select("host", "path", "action", F.regexp_replace("low", r"\.$", "/").alias("key"))
    points = low.select("path", "key", F.lit(OPEN).alias("kind"), "host", "action").unionByName(
        high.select("path", "key", F.lit(CLOSE).alias("kind"), "host", "action")).unionByName(
        keys.select("path", canonical(F.col("host")).alias("key"), F.lit(KEY).alias("kind"), "host", none.alias("action")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = points.repartitionByRange(parts, "path", "key", "kind").withColumn("part", F.spark_partition_id())
    points = stored(points, "points")
    ends = points.filter(F.col("kind") == CLOSE).select("path", "host", F.col("part").alias("last"))
    carried = points.filter(F.col("kind") == OPEN).join(ends, ["path", "host"]).filter("part < last").select(
        "path", "key", F.lit(CARRY).alias("kind"), "host", "action", F.explode(F.sequence(F.col("part") + 1, F.col("last"))).alias("part"))
    # Carried rules come first in their range, outer ones before inner ones.
    order = [F.col("kind") != CARRY, F.col("path"), F.col("key"), F.col("kind")]
    every = points.unionByName(carried)
    so_far = Window.partitionBy("part", "path").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.col("kind").isin(OPEN, CARRY)
    depth = F.sum(F.when(opens, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)).over(so_far)
    slot = Window.partitionBy("part", "path", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    top = F.last(F.when(opens, F.struct("host", "action")), ignorenulls=True).over(slot)
    return every.withColumn("depth", depth).withColumn("top", top).filter((F.col("kind") == KEY) & (F.col("depth") > 0)).select(
        "path", "host", F.col("top.host").alias("rule_host"), F.col("top.action").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``rule`` is the longest rule (host and path together, then host) that fits,
    or null.  A null url, or one without ``://``, has an empty host and path
    and no rule.  Repeated rows each get their verdict; null ``page_id`` passes
    through; without rules every verdict is ``otherwise``.  Other columns are
    ignored.
    """
    rules = stored(prepared_rules(rules), "rules")
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    paths = rules.select(F.col("path").alias("prefix")).distinct()
    # Distinct lengths of rule paths: no more than the longest rule path has characters.
    lengths = [r[0] for r in paths.select(F.length("prefix")).distinct().collect()]
    if not lengths:
        lengths = [1]
    urls = parsed.select("host", "path").distinct()
    prefixes = F.transform(F.filter(F.array(*map(F.lit, sorted(lengths))), lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    entered = stored(urls.select("host", "path", F.explode(prefixes).alias("prefix")).join(paths, "prefix", "left_semi"), "entered")
    tops = sweep(entered.select("host", F.col("prefix").alias("path")).distinct(), rules)
    found = entered.join(tops.withColumnRenamed("path", "prefix"), ["prefix", "host"])
    best = F.max(F.struct((F.length("rule_host") + F.length("prefix")).alias("n"), F.length("rule_host").alias("h"),
                          F.concat("rule_host", "prefix").alias("rule"), "action"))
    verdicts = found.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.action")
    return parsed.join(verdicts, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.lit(otherwise)).alias("verdict"))


def example_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXAMPLE_RULES, RULES)


#: The registered query in DuckDB's SQL, rule by rule.
URL_SQL = """
WITH rules(action, host, path) AS (VALUES """ + ", ".join(str(r) for r in EXAMPLE_RULES) + f"""),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parsed AS (SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ranked AS (SELECT p.n, r.host || r.path AS rule, r.action,
                  row_number() OVER (PARTITION BY p.n ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS k
           FROM parsed p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, k.rule, coalesce(k.action, '{OTHERWISE}') AS verdict
FROM parsed p LEFT JOIN ranked k ON k.n = p.n AND k.k = 1
"""
