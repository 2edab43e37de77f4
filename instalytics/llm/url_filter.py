"""URL filters by a sort-merge range join.

A rule is a host and a path; it fits the host and all its subdomains if the
url's path starts with the rule's. Reversed hosts (``org.example``) make each
rule an interval of keys (host, path): all keys of that host whose path begins
with the rule's. A url has one probe key for each of its host's suffixes, no
longer than the longest rule host (a longer one cannot be a rule's). Probes and
rules are sorted together by range partitions; a sweep in key order carries the
stack of the rules open at the last rule passed, and what is open at a probe is
in that stack, since prefixes nest. The stack at the start of a partition comes
from the last rule before it (one row per partition, broadcast). The longest
fitting rule (host and path together, then host) decides; without one the
verdict is ``default``.

The sort key ends in the row's number, so a url or host with any share of the
rows spreads over many partitions. Only urls and the carried columns are
shuffled. Null url, or one without ``://``: empty host and path, no rule.
Repeated rows give one result each. Empty tables give empty results; without
rules every verdict is ``default``. A rule without host is ignored; of equal
rules with different verdicts ``block`` holds. Hosts of rules are compared in
lower case (A-Z). Columns not carried are not read, whatever their names. The
stack of a rule takes as many look-ups as its path has characters.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, staged, table

# fixed rules of the query
RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")

KEY = ["_host", "_path"]


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_table(spark: SparkSession, rules: tuple[str, ...]) -> DataFrame:
    """host, path, verdict of rules written as ``block example.org/es/``."""
    rows = []
    for text in rules:
        verdict, where = text.split(" ", 1)
        host, slash, path = where.partition("/")
        rows.append((host, slash + path, verdict))
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """_host (reversed), _path, _stack of each rule: the rules of the same host
    whose path is a prefix of its own, itself last."""
    r = rules.select(_ascii_lower(F.col("host")).alias("h"), F.coalesce(F.col("path"), F.lit("")).alias("_path"), "verdict")
    r = r.where(F.length("h") > 0).groupBy("h", "_path").agg(F.max("verdict").alias("verdict"))
    r = r.select(F.array_join(_reversed(F.col("h")), ".").alias("_host"), "_path", F.concat("h", "_path").alias("rule"),
                 F.length("h").alias("of_host"), "verdict")
    begins = r.select("_host", "_path", F.explode(F.sequence(F.lit(0), F.length("_path"))).alias("_n"))
    begins = begins.select("_host", "_path", F.expr("substring(_path, 1, _n)").alias("_begin"))
    open_ = r.select(F.col("_host").alias("_h"), F.col("_path").alias("path"), "rule", "of_host", "verdict")
    found = begins.join(open_, (F.col("_host") == F.col("_h")) & (F.col("_begin") == F.col("path")))
    one = F.struct(F.length("path").alias("n"), "path", "rule", "of_host", "verdict")
    return found.groupBy(*KEY).agg(F.sort_array(F.collect_list(one)).alias("rules")).select(
        *KEY, F.struct(F.col("_host").alias("host"), "rules").alias("_stack"))


def judge(urls: DataFrame, rules: DataFrame, carry: tuple[str, ...] = ("page_id",), url: str = "url", default: str = "allow") -> DataFrame:
    """The carried columns, host, path, rule (null if none fits) and verdict of every row."""
    events = staged(rule_stacks(rules), "url-rules")
    labels = F.coalesce(events.agg(F.max(F.size(F.split("_host", r"\.")))).scalar(), F.lit(1))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("carried")
    d = urls.select(row, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("_path"))
    d = d.withColumn("_rid", F.monotonically_increasing_id()).withColumn("_labels", _reversed(F.col("host"))).withColumn("_most", labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size("_labels"), "_most")),
                           lambda j: F.array_join(F.slice("_labels", F.lit(1), j), "."))
    d = d.select("carried", "host", "_path", "_rid", F.posexplode(suffixes).alias("_at", "_host"))
    # the first probe carries the row
    probes = d.select(*KEY, F.lit(1).alias("_kind"), "_rid", F.when(F.col("_at") == 0, F.struct("carried", "host")).alias("_row"),
                      F.lit(None).cast(events.schema["_stack"].dataType).alias("_stack"))
    starts = events.select(*KEY, F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_rid"),
                           F.lit(None).cast(probes.schema["_row"].dataType).alias("_row"), "_stack")
    order = [*KEY, "_kind", "_rid"]
    both = probes.unionByName(starts).repartitionByRange(shuffle_partitions(urls.sparkSession), *order)
    both = staged(both.withColumn("_part", F.spark_partition_id()), "url-sweep")

    last = F.max_by("_stack", F.struct(*KEY)).alias("_last")
    parts = both.groupBy("_part").agg(F.max("_kind")).join(both.where("_kind = 0").groupBy("_part").agg(last), "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    sweep = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("_open", F.last("_stack", ignorenulls=True).over(sweep)).join(F.broadcast(parts), "_part")
    swept = swept.where("_kind = 1").withColumn("_open", F.coalesce("_open", "_before"))
    fits = F.when(F.col("_open.host") == F.col("_host"), F.filter("_open.rules", lambda x: F.startswith(F.col("_path"), x["path"])))
    swept = swept.withColumn("_fits", fits)
    best = F.get("_fits", F.size("_fits") - 1)
    swept = swept.withColumn("_best", F.when(F.size("_fits") > 0, F.struct(
        F.length(best["rule"]).alias("n"), best["of_host"].alias("h"), best["rule"].alias("rule"), best["verdict"].alias("verdict"))))
    swept = swept.where(F.col("_best").isNotNull() | F.col("_row").isNotNull())
    one = swept.groupBy("_rid").agg(F.first("_row", ignorenulls=True).alias("_row"), F.max("_path").alias("path"), F.max("_best").alias("_best"))
    return one.select(*[F.col(f"_row.carried.c{i}").alias(c) for i, c in enumerate(carry)], F.col("_row.host").alias("host"), "path",
                      F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


SQL = """
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
