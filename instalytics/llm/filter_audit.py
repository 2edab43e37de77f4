"""Filter interaction audit: what each filter removes in every order.

Five filters give each document a mask of failures. Four look at the text
alone. The fifth, "identical to the text of a smaller id", is found after a
prepass with a counting Bloom sketch: every text adds one to ``HASHES`` cells of
one block of 32,768; the counts are merged by aggregation, map side first. A
text with a cell that only it counted is surely unique and is cleared. The
cells counted once are bitmaps of 4 KB a block, and only texts without such a
cell go on: their whole text is shuffled, after a partial minimum per task, for
its smallest id. The masks, joined with the labels, become counts per part and
mask (32 a part), from which every order and step is added up.

The sketch has a block for each ``DOCS_PER_BLOCK`` rows, at most ``MAX_BLOCKS``
(64 MB, broadcast); with more documents than about 33 million it clears fewer
texts, so more are compared, and nothing else changes.

Null text: empty. Null source: the empty part. Null ids are no smaller ids and
have none, so they never fail E. Rows with the same id and text are no repeats
of each other. Repeated labels: any row with the value counts. Repeated rows
count each. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

FILTERS = "ABCDE"
HASHES = 4
CELLS = 32_768  # of a block; what Spark's bitmap functions hold
DOCS_PER_BLOCK = 2048
MAX_BLOCKS = 16_384


def text_flags(text: Column) -> list[Column]:
    """Failures of the filters A to D."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    return [n < 50, 100 * F.size(F.array_distinct(words)) < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike(r"[#$%&*|]")]


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, part, text, and two hashes of the text."""
    d = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return d.withColumn("_h1", F.xxhash64("text")).withColumn("_h2", F.xxhash64(F.lit(1), F.col("text")))


def _cell(i: int) -> Column:
    return F.shiftrightunsigned("_h2", 15 * i).bitwiseAND(F.lit(CELLS - 1))


def once_counted(rows: DataFrame, blocks: int) -> DataFrame:
    """The merged sketch: _block and a bitmap of the cells that one row alone counted."""
    cells = F.array_distinct(F.array(*[_cell(i) for i in range(HASHES)]))
    c = rows.select(F.pmod("_h1", F.lit(blocks)).alias("_block"), F.explode(cells).alias("_cell"))
    c = c.groupBy("_block", "_cell").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return c.groupBy("_block").agg(F.bitmap_construct_agg("_cell").alias("_bits"))


def possible_repeats(rows: DataFrame, sketch: DataFrame, blocks: int) -> DataFrame:
    """The rows whose text has no cell of its own."""
    d = rows.withColumn("_block", F.pmod("_h1", F.lit(blocks))).join(F.broadcast(sketch), "_block", "left")
    alone = F.lit(False)
    for i in range(HASHES):
        byte = F.conv(F.hex(F.substring("_bits", (_cell(i) / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        alone = alone | (byte.bitwiseAND(F.expr(f"shiftleft(1, cast(shiftrightunsigned(_h2, {15 * i}) & 7 as int))")) > 0)
    return d.where(~F.coalesce(alone, F.lit(False))).drop("_block", "_bits")


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and _mask of each row, bit i for the filter i."""
    d = _hashed(docs)
    mask = F.lit(0)
    for i, flag in enumerate(text_flags(F.col("text"))):
        mask = mask + F.when(flag, F.lit(1 << i)).otherwise(F.lit(0))
    flags = staged(d.select("doc_id", "part", mask.alias("_mask"), "_h1", "_h2"), "audit-flags")
    blocks = min(MAX_BLOCKS, flags.count() // DOCS_PER_BLOCK + 1)
    sketch = staged(once_counted(flags.select("_h1", "_h2"), blocks), "audit-sketch")
    # the smallest id of each text that may occur more than once, compared as whole texts
    texts = possible_repeats(d.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "_h1", "_h2"), sketch, blocks)
    first = texts.groupBy("text", "_h1", "_h2").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("doc_id", "_h1", "_h2", F.lit(True).alias("_first")).distinct()
    firsts = staged(first, "audit-firsts")
    suspects = possible_repeats(flags, sketch, blocks).select("doc_id", "_h1", "_h2").where(F.col("doc_id").isNotNull()).distinct()
    later = suspects.join(firsts, ["doc_id", "_h1", "_h2"], "left_anti").withColumn("_later", F.lit(1 << 4))
    known, unknown = flags.where(F.col("doc_id").isNotNull()), flags.where(F.col("doc_id").isNull())
    known = known.join(later, ["doc_id", "_h1", "_h2"], "left")
    return known.select("doc_id", "part", (F.col("_mask") + F.coalesce("_later", F.lit(0))).alias("_mask")).unionByName(
        unknown.select("doc_id", "part", "_mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: arrays n, good and toxic of 32 counts, by mask."""
    lab = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("_good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("_toxic"))
    known = masks.where(F.col("doc_id").isNotNull()).join(lab, "doc_id", "left")
    rows = known.select("part", "_mask", "_good", "_toxic").unionByName(
        masks.where(F.col("doc_id").isNull()).select("part", "_mask", F.lit(None).cast("int").alias("_good"), F.lit(None).cast("int").alias("_toxic")))
    c = rows.groupBy("part", "_mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("_good", F.lit(0))).alias("good"), F.sum(F.coalesce("_toxic", F.lit(0))).alias("toxic"))
    per = [F.array(*[F.sum(F.when(F.col("_mask") == m, F.col(v)).otherwise(0)) for m in range(1 << len(FILTERS))]).alias(v) for v in ("n", "good", "toxic")]
    return c.groupBy("part").agg(*per)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    counts = staged(mask_counts(failure_masks(docs), labels), "audit-counts")
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        for step, f in enumerate(order):
            steps.append(("".join(FILTERS[i] for i in order), step + 1, 1 << f, sum(1 << i for i in order[:step])))
    plan = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(s).alias("s"), F.lit(f).alias("f"), F.lit(p).alias("p")) for o, s, f, p in steps])
    d = counts.select("part", "n", "good", "toxic", F.explode(plan).alias("x"))
    d = d.select("part", "n", "good", "toxic", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"), F.col("x.f").alias("f"), F.col("x.p").alias("p"))

    def total(values: str, test) -> Column:
        kept = F.transform(values, lambda v, m: F.when(test(m), v).otherwise(F.lit(0).cast("long")))
        return F.aggregate(kept, F.lit(0).cast("long"), lambda a, x: a + x)

    def fails(m: Column) -> Column:
        return m.bitwiseAND(F.col("f")) > 0

    def gone(m: Column) -> Column:
        return m.bitwiseAND(F.col("p")) > 0

    orders = F.transform("n", lambda v, m: F.when(fails(m), (F.lit(120) / F.bit_count(m)).cast("long") * v).otherwise(F.lit(0).cast("long")))
    return d.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", lambda m: fails(m) & ~gone(m)).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m == F.col("f")).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~gone(m)).alias("good_lost"),
        total("toxic", lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
        F.aggregate(orders, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, doc_id, len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS fc, regexp_matches(t, '[#$%&*|]') AS fd,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fe
  FROM d),
c AS (
  SELECT part, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN lab USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x) JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS p FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, b,
         sum(CASE WHEN mask & (b | p) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & b > 0 AND mask & p = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & b > 0 AND mask & p > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = b THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & b > 0 AND mask & p = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & b > 0 AND mask & p = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, b)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, b)::BIGINT AS shapley
FROM r
"""
