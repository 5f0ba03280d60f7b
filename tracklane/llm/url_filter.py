"""URL rules by a sort-merge range join.

A rule ``host/path`` fits its host and every subdomain, for URLs whose path starts with the rule's path. Hosts are
turned round (``a.example.net`` -> ``net.example.a.``), so a host with all its subdomains is one interval of keys, and
intervals either nest or lie apart. URLs and interval bounds are sorted together; the last bound before a URL carries
the stack of rules that are open there, and the longest of them whose path fits decides.

Edge cases: a null URL, or one without ``://``, has an empty host and path and no rule fits it. An empty path does not
start with ``/``. Rules may repeat; repeated rules with different verdicts block. Extra columns, whatever their names,
are neither read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane.llm.common import stored


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: What a row of the sweep is, in sorting order: first key of a range, end and start of intervals, URL.
FIRST, END, START, URL = -1, 0, 1, 2
RULE = T.StructType([T.StructField(n, T.StringType()) for n in Rule._fields])


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the top level down, each with a dot behind it; byte order keeps a host and its subdomains together."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def interval_bounds(rules: DataFrame) -> DataFrame:
    """One row per bound of a rule's interval: ``key`` and the ``stack`` of rules open from there on, longest last.

    A bound's stack holds the rules of the hosts above it, found by joining the host's own ancestors; how deep that
    goes is the number of labels of a host, not the number of rules.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" over "allow"
    hosts = rules.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("own"))
    labels = F.split("host", r"\.")
    above = hosts.select(
        "host", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("up", "above")
    )
    found = above.join(hosts.select(F.col("host").alias("above"), "own"), "above")
    sized = lambda r: F.struct((F.char_length(r["host"]) + F.char_length(r["path"])).alias("size"), F.char_length(r["host"]).alias("depth"), r["host"].alias("host"), r["path"].alias("path"), r["verdict"].alias("verdict"))
    ordered = lambda lists: F.array_sort(F.transform(F.flatten(lists), sized))
    opened = found.groupBy("host").agg(F.collect_list("own").alias("all"), F.collect_list(F.when(F.col("up") > 0, F.col("own"))).alias("outer"))
    key = reversed_host(F.col("host"))
    ends = opened.select(F.concat(key.substr(F.lit(1), F.char_length(key) - 1), F.lit("/")).alias("key"), F.lit(END).alias("kind"), ordered(F.col("outer")).alias("stack"))
    starts = opened.select(key.alias("key"), F.lit(START).alias("kind"), ordered(F.col("all")).alias("stack"))
    return ends.unionByName(starts)


def judge_urls(urls: DataFrame, rules: Iterable[Rule] | DataFrame, url_col: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow") -> DataFrame:
    """``keep``, host, path, rule and verdict of every URL.

    The sorted order is cut into ranges of equal row counts, so a host with a third of all rows is swept by many
    tasks; each range starts from the stack that is open at its first key.
    """
    spark = urls.sparkSession
    rules = rules if isinstance(rules, DataFrame) else spark.createDataFrame([tuple(r) for r in rules], RULE)
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")
    rows = urls.select(kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).withColumn("key", reversed_host(F.col("host")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal keys are told apart by path and row hash, or one host would be one range.
    spread = rows.withColumn("spread", F.xxhash64("kept", "path")).repartitionByRange(parts, "key", "spread")
    ranged = stored(spread.select("kept", "host", "path", "key", F.spark_partition_id().alias("part")), "urls")
    bounds = interval_bounds(rules)
    no_stack = F.lit(None).cast(bounds.schema["stack"].dataType)

    # First sweep, over bounds and the first key of each range (a few rows per task and per rule): the range a bound is
    # in, and the stack a range begins with.
    edges = ranged.groupBy("part").agg(F.min("key").alias("key"), F.max("key").alias("last_key"))
    first = edges.select("key", F.lit(FIRST).alias("kind"), no_stack.alias("stack"), "part")
    sweep = W.orderBy("key", "kind", "part").rowsBetween(W.unboundedPreceding, 0)
    swept = first.unionByName(bounds.withColumn("part", F.lit(None).cast("int"))).select(
        "key", "kind", F.last("part", True).over(sweep).alias("part"), F.last("stack", True).over(sweep).alias("stack")
    )
    # A range that ends on a bound's own key holds URLs of that key, too.
    ending = bounds.join(edges.select(F.col("last_key").alias("key"), "part"), "key").select("key", "kind", "part", "stack")
    events = swept.where("part IS NOT NULL").unionByName(ending)

    # Second sweep, within each range: the last bound at or before a URL's key carries the open rules.
    blank = [F.lit(None).cast(ranged.schema[c].dataType).alias(c) for c in ("kept", "host", "path")]
    union = ranged.select("part", "key", F.lit(URL).alias("kind"), no_stack.alias("stack"), "kept", "host", "path", F.lit(True).alias("is_url")).unionByName(
        events.select("part", "key", "kind", "stack", *blank, F.lit(False).alias("is_url"))
    )
    within = W.partitionBy("part").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    judged = union.withColumn("open", F.last("stack", True).over(within)).where("is_url")
    fits = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    judged = judged.withColumn("best", F.try_element_at(fits, F.lit(-1)))
    return judged.select("kept.*", "host", "path", F.concat(F.col("best.host"), F.col("best.path")).alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
