"""Judge urls by rules on host and path, as a sort-merge range join in DataFrame operations.

A rule covers its host, all subdomains of it, and every path that starts with the rule's path. The
canonical key of a host is its labels in reverse (``com.example.www``), so each host above a url's host is a
prefix of its key. At one host a rule's paths form an interval of the sorted paths: from the rule's path to
the last string that starts with it. Such intervals lie inside each other or apart.

The sweep sorts rules and urls of a host by path. Each rule opens its interval and carries the stack of
intervals that are open there (the rules around it, then itself). A url takes the stack of the last rule
opened before it and pops the intervals that have ended; the top of what is left is the longest rule of that
host. A url meets the rules of each host above its own that has rules, and its longest rule wins.

Scale: work is done once per distinct (host, path). A host that holds more than a fair share of them (``com``
may hold half) is swept in several blocks, each with a copy of that host's rules; the number of blocks comes
from counts over all urls. Only the list of such hosts is broadcast: at most label levels times partitions.

Defined results: a null url, or one without ``://``, has an empty host and path. The longest rule is the one
with the longest host plus path; of equally long ones that with the longer host. A rule given twice blocks
if one of the two blocks. Rules without a host fit nothing; a rule's null path is an empty one. Without a
fitting rule the verdict is ``default``. Repeated rows come back as often as given; further columns come back
inside ``page``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold_ascii

#: Fixed by the query's contract: host, path and verdict of each rule.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, fold_ascii(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))).otherwise("")


def url_path(url: Column) -> Column:
    return F.when(
        F.instr(url, "://") > 0, F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)
    ).otherwise("")


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def host_key(host: Column) -> Column:
    """Labels in reverse order: subdomains of a host share its key as a prefix."""
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def keys_above(host: Column, levels: int) -> Column:
    """The keys of the host and of all hosts above it, down to as many labels as the longest rule has."""
    labels = F.reverse(F.split(host, r"\.", -1))
    deepest = F.least(F.size(labels), F.lit(levels))
    return F.transform(F.sequence(F.lit(1), deepest), lambda n: F.array_join(F.slice(labels, 1, n), "."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    names = ("host", "path", "verdict")
    listed = F.array(*(F.struct(*(F.lit(value).alias(name) for name, value in zip(names, rule))) for rule in rules))
    return spark.range(1).select(F.inline(listed))


def nested_rules(rules: DataFrame) -> DataFrame:
    """Each rule once, by key and path, with ``stack``: the rules of its host around it and itself, outer first."""
    once = (
        rules.select(fold_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .where(F.length("host") > 0)
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", host_key(F.col("host")))
    )
    starts = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    inner = once.select("key", F.col("path").alias("inner_path"), F.explode(starts).alias("path"))
    return (
        inner.join(once, ["key", "path"])
        .groupBy("key", F.col("inner_path").alias("path"))
        .agg(F.sort_array(F.collect_list(F.struct("path", "host", "verdict"))).alias("stack"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, url_column: str = "url"
) -> DataFrame:
    """Rows ``page`` (the row as given), ``host``, ``path``, ``rule`` (null without one) and ``verdict``."""
    spark = pages.sparkSession
    judged = pages.select(F.struct("*").alias("page"), F.col(url_column).alias("url")).select(
        "page", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    judged = judged.withColumns({name: F.coalesce(name, F.lit("")) for name in ("host", "path")})
    places = judged.select("host", "path").distinct()
    stacks = nested_rules(rules)
    levels = stacks.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    blocks = _blocks(spark, places, levels)

    probes = (
        places.where(F.length("host") > 0)
        .select("host", "path", F.explode(keys_above(F.col("host"), levels)).alias("key"))
        .join(stacks.select("key").distinct(), "key", "left_semi")
        .join(F.broadcast(blocks), "key", "left")
        .withColumn("block", F.pmod(F.xxhash64("host", "path"), F.coalesce("blocks", F.lit(1))))
        .select("key", "block", "path", F.lit(1).alias("is_url"), "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    )
    opened = (
        stacks.join(F.broadcast(blocks), "key", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
        .select("key", "block", "path", F.lit(0).alias("is_url"), F.lit(None).cast("string").alias("host"), "stack")
    )
    sweep = (
        Window.partitionBy("key", "block")
        .orderBy("path", "is_url")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    open_here = F.filter("open", lambda rule: F.startswith(F.col("path"), rule["path"]))
    best = (
        probes.unionByName(opened)
        .withColumn("open", F.last("stack", ignorenulls=True).over(sweep))
        .where("is_url = 1 AND open IS NOT NULL")
        .withColumn("top", F.try_element_at(open_here, F.lit(-1)))
        .where("top IS NOT NULL")
        .select("host", "path", F.concat("top.host", "top.path").alias("rule"), "top.verdict", F.length("top.host").alias("host_length"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("length"), "host_length", "rule", "verdict")).alias("best"))
    )
    return judged.join(best, ["host", "path"], "left").select(
        "page", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def _blocks(spark: SparkSession, places: DataFrame, levels: int) -> DataFrame:
    """How many blocks each host key with more than a fair share of the distinct places is swept in."""
    per_key = (
        places.groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("n", F.explode(keys_above(F.col("host"), levels)).alias("key"))
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = places.count()
    return per_key.where(F.col("n") * shares > total).select(
        "key", F.ceil(F.col("n") * shares / max(total, 1)).cast("long").alias("blocks")
    )
