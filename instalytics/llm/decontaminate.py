"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

Words are runs outside ASCII punctuation, space and controls, A-Z lower-cased.
A window is 13 consecutive words of an item, or the whole item if it is
shorter. Containment of a whole window needs every one of its words, so the
prefix of a window, ordered by rarity in the corpus, is its single rarest
word. Document words join the windows on that word; the word's place in the
window fixes the start, which the positional bound (start >= 0) and the length
bound (window ends within the text) must allow; then the slice of the text is
compared with the window word by word. Everything up to here is one pass over
the text in one code-generated stage, nothing of it is shuffled.

The window table is broadcast in blocks of ``block`` windows at most, one pass
per block, so the broadcast is bounded whatever the benchmark's size. Hits of
a document are merged by a running maximum over its own sorted hits. Document
word counts come from all documents, for the benchmark's own words only.

Null or empty text: no words, not contaminated. Items without words have no
window. Equal documents give equal rows, one each; repeated items with the
same id and text count once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ with every character listed: Java keeps single characters of a class
# in one table, but asks range after range for each character of a text
WORD = "[^" + "".join(rf"\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _doc_words(docs: DataFrame) -> DataFrame:
    """A row per document word, after one of an empty word at place 0 that
    stands for the document; outer, so that Spark adds no second evaluation of
    the words as a filter."""
    words = F.concat(F.array(F.lit("")), words_of(F.col("text")))
    d = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), words.alias("_words"))
    return d.select("_id", "_hash", "_words", F.posexplode_outer("_words").alias("_pos", "_word"))


def windows(benchmark: DataFrame) -> DataFrame:
    """item_id and the words of every window, each once."""
    b = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - WINDOW + 1, F.lit(1)))
    return (b.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice("w", F.col("s"), F.lit(WINDOW)).alias("win")).distinct())


def anchored(docs: DataFrame, benchmark: DataFrame, vocab_block: int = 200_000) -> DataFrame:
    """Distinct windows with their rarest word and its place (from 0). Words
    that no document holds make a window that cannot occur; it is left out."""
    win = staged(windows(benchmark), "windows")
    vocab = staged(win.select(F.explode("win").alias("_word")).distinct(), "window-words")
    blocks = max(1, math.ceil(vocab.count() / vocab_block))
    counts = None
    for k in range(blocks):
        part = vocab.where(F.pmod(F.xxhash64("_word"), F.lit(blocks)) == k)
        # the words only: places and texts stay behind
        d = docs.select(F.explode_outer(words_of(F.col("text"))).alias("_word"))
        c = d.join(F.broadcast(part), "_word").groupBy("_word").agg(F.count(F.lit(1)).alias("n"))
        counts = c if counts is None else counts.unionByName(c)
    counts = staged(counts, "window-word-counts")
    seen = (win.select("win").distinct().withColumn("len", F.size("win"))
            .select("win", "len", F.posexplode("win").alias("off", "_word"))
            .join(counts, "_word", "left"))
    return (seen.groupBy("win", "len").agg(F.count("n").alias("known"),
                                           F.min(F.struct("n", "_word", "off")).alias("r"))
            .where(F.col("known") == F.col("len"))
            .select("win", "len", F.col("r._word").alias("_word"), F.col("r.off").alias("off")))


def occurrences(docs: DataFrame, anchors: DataFrame, block: int = 100_000) -> DataFrame:
    """Rows (_id, _hash, n_words, start, win): one with a null window for each
    document, and one for each place where a window occurs."""
    anchors = staged(anchors, "anchors")
    blocks = max(1, math.ceil(anchors.count() / block))
    out = None
    for k in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == k)
        d = _doc_words(docs).join(F.broadcast(part), "_word", "left")
        start = F.col("_pos") - F.col("off")  # the first word is at place 1
        hit = (start >= 1) & (start + F.col("len") <= F.size("_words")) & (F.slice("_words", F.greatest(start, F.lit(1)) + 1, F.col("len")) == F.col("win"))
        mark = (F.col("_pos") == 0) if k == 0 else F.lit(False)
        rows = (d.withColumn("_hit", F.coalesce(hit, F.lit(False))).withColumn("_mark", mark).where("_hit or _mark")
                .select("_id", "_hash", F.when(F.col("_mark"), F.size("_words") - 1).alias("n_words"),
                        F.when(F.col("_hit"), start).alias("start"), F.when(F.col("_hit"), F.col("win")).alias("win")))
        out = rows if out is None else out.unionByName(rows)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: doc_id, _hash (of its text), n_words, n_hit,
    n_items, items_sha256, contaminated."""
    win = windows(benchmark)
    occ = staged(occurrences(docs, anchored(docs, benchmark)), "occurrences")
    key = ["_id", "_hash"]
    rows = occ.where("n_words is not null").groupBy(*key).agg(F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"))
    hits = occ.where("win is not null").select(*key, "start", "win").distinct()
    spans = hits.select(*key, "start", (F.col("start") + F.size("win")).alias("end")).distinct()
    w = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.col("start"), F.coalesce(F.max("end").over(w), F.lit(0)))
    covered = (spans.withColumn("_new", F.greatest(F.col("end") - reach, F.lit(0)))
               .groupBy(*key).agg(F.sum("_new").alias("n_hit")))
    items = (hits.select(*key, "win").distinct().join(win, "win").groupBy(*key)
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    def same(x: str, y: str) -> Column:  # a null id matches a null id
        return F.col(f"{x}._id").eqNullSafe(F.col(f"{y}._id")) & F.col(f"{x}._hash").eqNullSafe(F.col(f"{y}._hash"))

    out = (rows.alias("r").join(covered.alias("c"), same("r", "c"), "left")
           .join(items.alias("i"), same("r", "i"), "left"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    names = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    out = out.select(F.col("r._id").alias("doc_id"), F.col("r._hash").alias("_hash"), F.col("n_words").cast("long").alias("n_words"),
                     n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
                     F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), F.col("copies"))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "_copy")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_hash")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    bad = decontaminate(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_id"), "_hash").distinct()
    tagged = docs.withColumn("__hash", F.xxhash64("text"))
    cond = tagged["doc_id"].eqNullSafe(bad["_id"]) & (tagged["__hash"] == bad["_hash"])
    return tagged.join(bad, cond, "left_anti").select(*[tagged[f"`{c}`"] for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 12], ' ') AS win, len(w[s:s + 12]) AS size
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
shingle AS (
  SELECT rid, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT rid, s, shingle.size, item_id FROM shingle JOIN win ON win.win = shingle.win AND win.size = shingle.size),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + size - 1)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
