"""Line de-duplication by distinct-site spread.

A line is boilerplate if it occurs on at least ``min_sites`` different sites
(sources). Sites are counted per line hash with HyperLogLog sketches, merged
by aggregation, so a hot line moves one sketch per task. Where the estimate is
too near the threshold to decide (within three standard errors) the distinct
sites are counted exactly. Boilerplate lines are removed from all documents.

Lines are split at \\n and compared without surrounding white space; every line
with a word counts, whatever its length, and blank lines never do. Lines are known by
a 128-bit hash. A null source is a site of its own. Null or empty text has no
lines and stays as it is. Equal rows give equal results, one each. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

MIN_SITES = 8
LG_K = 10
HOT_SHARE = 1000

KEY = ["_a", "_b"]


def lines_of(docs: DataFrame) -> DataFrame:
    """_id, _h (hash of the text), _site, _pos and the line hash _a, _b of every line with a word."""
    d = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"),
                    F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("_site"),
                    F.posexplode(F.split("text", "\n")).alias("_pos", "_raw"))
    d = d.withColumn("_line", F.btrim("_raw", F.lit(" \t\r\x0b\x0c"))).where(F.length("_line") > 0)
    return d.select("_id", "_h", "_site", "_pos", F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), F.col("_line")).alias("_b"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Line hashes found on ``min_sites`` sites or more, with their rows."""
    error = 3 * 1.04 / (1 << LG_K) ** 0.5
    sk = lines.groupBy(*KEY).agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("sites"), F.count(F.lit(1)).alias("n"))
    # fewer rows than sites asked for: never boilerplate
    sk = staged(sk.where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites * (1 - error))), "line-sketches")
    sure = sk.where(F.col("sites") > min_sites * (1 + error)).select(*KEY, "n")
    near = sk.where(F.col("sites") <= min_sites * (1 + error)).select(*KEY, "n")
    pairs = lines.groupBy(*KEY, "_site").agg(F.count(F.lit(1)).alias("_x"))  # a hot line is one row per site
    exact = (pairs.join(near, KEY).groupBy(*KEY).agg(F.count(F.lit(1)).alias("sites"), F.max("n").alias("n"))
             .where(F.col("sites") >= min_sites).select(*KEY, "n"))
    return sure.unionByName(exact)


def remove_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed and the cleaned text."""
    lines = lines_of(docs)
    bad = staged(boilerplate(lines, min_sites), "line-boilerplate")
    total = bad.agg(F.sum("n")).first()[0] or 0
    # lines with over a thousandth of the boilerplate rows: fewer than a thousand, broadcast; no other is hot
    hot = F.broadcast(bad.where(F.col("n") * HOT_SHARE > total).select(*KEY))
    cold = bad.where(F.col("n") * HOT_SHARE <= total).select(*KEY)
    found = lines.join(hot, KEY).unionByName(lines.join(hot, KEY, "left_anti").join(cold, KEY))
    # equal rows have equal places; the set takes them once
    gone = found.groupBy("_id", "_h").agg(F.collect_set("_pos").alias("_gone"))
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("_th")).alias("d")
    g = gone.alias("g")
    d = d.join(g, F.col("d.doc_id").eqNullSafe(F.col("g._id")) & (F.col("d._th") == F.col("g._h")), "left")
    d = d.withColumn("_lines", F.split("text", "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array_sort(left), lambda i: F.get("_lines", i)), "\n"))
    n = F.when(F.length("text") > 0, F.size("_lines")).otherwise(0)
    return d.select("doc_id", n.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"), text.alias("text"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_lines(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, coalesce('s' || source, 'n') AS site FROM documents),
l AS (SELECT rid, site, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT rid, site, raw, pos, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM l),
bad AS (SELECT line FROM k WHERE length(line) > 0 GROUP BY line HAVING count(DISTINCT site) >= 8),
m AS (SELECT k.*, bad.line IS NOT NULL AS gone FROM k LEFT JOIN bad ON bad.line = k.line)
SELECT doc_id, CASE WHEN length(any_value(text)) > 0 THEN count(pos) ELSE 0 END::BIGINT AS n_lines,
       count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       CASE WHEN count(*) FILTER (WHERE gone) = 0 THEN any_value(text)
            ELSE coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') END AS text
FROM d LEFT JOIN m USING (rid) GROUP BY rid, doc_id
"""
