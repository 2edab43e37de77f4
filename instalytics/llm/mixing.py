"""Mixing sources to target weights by Pfair scheduling.

Target weights are given for each source, and then the mixture either stops
when the first source runs out, or sources that run out are repeated until all
documents of every named source are in it; sources not named are not in the
mixture. Without given weights, the target of a source is its natural share, but
no source may take more than ``cap`` of the mixture: a larger one is cut to that
share, the others keep all they have (if there are too few sources to hold the
cap, none is cut). Weights are rounded to ``a`` parts of ``resolution`` (at least one
part each, the rest by largest remainder), which is the period of the schedule.

Documents of a source stand in the order of a hash of their id and form blocks
of ``block_rows``. Block i of a source with weight a / W is released at slot
floor(i W / a) and due by slot ceil((i + 1) W / a); every slot takes the
released block with the earliest deadline. All windows close at the end of a
period, so the schedule repeats: one period is computed, by a fold over its
slots on a single row whose size depends on ``resolution`` and the number of
sources only (the fold is one task and walks all sources at each slot, which
bounds the sources to some thousands), and joined to the blocks. As long as every source has blocks,
any prefix of the stream differs from the target by less than one block for
each source. When a source runs out, its slots stay empty.

Nothing is dropped: each document has its place, ``in_mixture`` marks those
that belong to the mixture at the target weights. Null source: a source of its
own. Null ids sort first. Repeated rows take a place each. Extra columns are
carried or ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

CAP = (1, 4)
WHOLE = (1, 1)  # natural shares: no source is cut
BLOCK_ROWS = 64
RESOLUTION = 1000
BROADCAST_SOURCES = 100_000


def _src(source: Column) -> Column:
    """A key that tells a null source from any text."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def target_weights(counts: DataFrame, cap: tuple[int, int] = CAP, resolution: int = RESOLUTION) -> DataFrame:
    """counts: _src, n. Adds _quota (documents in the mixture), _parts and
    _period by natural shares. Windows here run over one row per source."""
    num, den = cap
    by_size = Window.orderBy(F.desc("n"), "_src")
    every = Window.partitionBy()
    c = counts.withColumn("_k", (F.row_number().over(by_size) - 1).cast("long"))
    rest = F.sum("n").over(by_size.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    room = F.lit(den) - F.col("_k") * num
    # the level that the _k larger sources are cut to if this and the smaller ones stay whole
    c = c.withColumn("_level", F.when(room > 0, F.floor(rest * num / F.greatest(room, F.lit(1)))))
    c = c.withColumn("_fits", F.when(F.col("n") <= F.col("_level"), F.col("_k")))
    c = c.withColumn("_cut", F.min("_fits").over(every))
    c = c.withColumn("_to", F.max(F.when(F.col("_k") == F.col("_cut"), F.col("_level"))).over(every))
    c = c.withColumn("_quota", F.when(F.col("_k") < F.col("_cut"), F.least("n", "_to")).otherwise(F.col("n")))
    return _in_parts(c, "_quota", resolution)


def _in_parts(c: DataFrame, weight: str, resolution: int) -> DataFrame:
    """Rounds the integer weights to parts of a period. Windows run over one row per source."""
    every = Window.partitionBy()
    c = c.withColumn("_s", F.count(F.lit(1)).over(every)).withColumn("_m", F.sum(weight).over(every))
    c = c.withColumn("_period", F.greatest(F.lit(resolution), 4 * F.col("_s")).cast("long"))
    share = (F.col("_period") - F.col("_s")) * F.col(weight)
    c = c.withColumn("_base", 1 + F.expr(f"((_period - _s) * {weight}) div _m")).withColumn("_left", share % F.col("_m"))
    c = c.withColumn("_more", F.col("_period") - F.sum("_base").over(every))
    turn = F.row_number().over(Window.orderBy(F.desc("_left"), "_src"))
    return c.withColumn("_parts", F.col("_base") + F.when(turn <= F.col("_more"), 1).otherwise(0)).select("_src", "n", "_quota", "_parts", "_period")


def given_weights(counts: DataFrame, weights: dict[str | None, float], repeat: bool = False, resolution: int = RESOLUTION) -> DataFrame:
    """counts: _src, n. As ``target_weights``, for stated weights (any positive
    numbers; only their ratios count). The mixture holds _quota documents of a
    source: with ``repeat`` as many as let the source that is longest against its
    weight stand in it once, so that the others recur, else as many as the
    shortest allows; then a named source without documents leaves it empty."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("target weights are positive numbers")
    total = sum(weights.values())
    # in parts of a million million, at least one: whole numbers from here on
    rows = [("n" if s is None else f"s{s}", max(1, round(1e12 * w / total))) for s, w in weights.items()]
    w = counts.sparkSession.createDataFrame(rows, "_src string, _w long")
    c = w.join(counts, "_src", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if repeat:
        c = c.where("n > 0")
    every = Window.partitionBy()
    reach = F.col("n") / F.col("_w")
    c = c.withColumn("_reach", (F.max(reach) if repeat else F.min(reach)).over(every))
    exact = F.col("_reach") * F.col("_w")
    quota = F.ceil(exact - 1e-6) if repeat else F.least(F.col("n"), F.floor(exact + 1e-6))
    # whole numbers small enough that the share of a period fits in 64 bits
    return _in_parts(c.withColumn("_quota", quota.cast("long")).withColumn("_w", F.expr("greatest(1L, _w div 1000000)")), "_w", resolution)


def period_schedule(weights: DataFrame) -> DataFrame:
    """_src, _j, _at: the slot of block _j of each source within one period."""
    one = weights.groupBy().agg(F.array_sort(F.collect_list(F.struct("_src", "_parts"))).alias("s"), F.max("_period").alias("w"))
    one = one.where(F.size("s") > 0).select(F.transform("s", lambda x: x["_src"]).alias("src"), F.transform("s", lambda x: x["_parts"]).alias("a"), "w")
    fold = F.expr("""aggregate(
        sequence(0L, w - 1L),
        named_struct('done', transform(a, x -> 0L), 'picks', cast(array() as array<int>)),
        (acc, t) -> transform(
            array(array_min(filter(
                transform(a, (p, i) -> named_struct(
                    'due', ((acc.done[i] + 1L) * w + p - 1L) div p,
                    'i', i,
                    'ok', acc.done[i] < p and (acc.done[i] * w) div p <= t)),
                c -> c.ok)).i),
            best -> named_struct(
                'done', transform(acc.done, (d, i) -> if(i = best, d + 1L, d)),
                'picks', concat(acc.picks, array(best))))[0],
        acc -> acc.picks)""")
    slots = one.select("src", F.posexplode(fold).alias("_at", "_i"))
    slots = slots.select(F.get("src", F.col("_i")).alias("_src"), F.col("_at").cast("long").alias("_at"))
    return slots.withColumn("_j", (F.row_number().over(Window.partitionBy("_src").orderBy("_at")) - 1).cast("long"))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with _src and _idx, the place of a document within its source
    (from 0) in hash order: offsets of 4096 hash buckets of each source plus the
    row number inside a bucket, so that a hot source is spread."""
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    d = docs.withColumn("_src", _src(F.col("source"))).withColumn("_h", h)
    d = d.withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    n = d.groupBy("_src", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_src").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("_src", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    tie = [F.xxhash64("text")] if "text" in docs.columns else []
    inside = Window.partitionBy("_src", "_b").orderBy("_h", F.col("doc_id").asc_nulls_first(), *tie)
    d = d.withColumn("_i", F.row_number().over(inside)).join(n, ["_src", "_b"])
    return d.withColumn("_idx", F.col("_from") + F.col("_i") - 1).drop("_h", "_b", "_i", "_from")


def weights_of(docs: DataFrame, cap: tuple[int, int] = CAP, resolution: int = RESOLUTION,
               weights: dict[str | None, float] | None = None, repeat: bool = False) -> DataFrame:
    counts = docs.groupBy(_src(F.col("source")).alias("_src")).agg(F.count(F.lit(1)).alias("n"))
    by = target_weights(counts, cap, resolution) if weights is None else given_weights(counts, weights, repeat, resolution)
    return staged(by, "mix-weights")


def _small(df: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(df) if sources <= BROADCAST_SOURCES else df


def _scheduled(rows: DataFrame, weights: DataFrame, block_rows: int, repeat: bool = False) -> DataFrame:
    """``rows`` of the sources with a weight, with block, _idx, _start (of the
    period), _at and _j of the schedule; with ``repeat`` a row for each epoch."""
    sources = weights.count()
    plan = staged(period_schedule(weights), "mix-period")
    d = numbered(rows).join(_small(weights.withColumnRenamed("n", "_size"), sources), "_src")
    if repeat:
        d = d.withColumn("epoch", F.explode(F.expr("sequence(0L, greatest(_quota - _idx - 1, 0L) div _size)")))
        d = d.withColumn("_idx", F.col("_idx") + F.col("epoch") * F.col("_size"))
    d = d.withColumn("block", F.expr(f"_idx div {block_rows}")).withColumn("_c", F.expr("block div _parts")).withColumn("_j", F.col("block") % F.col("_parts"))
    return d.join(_small(plan, sources), ["_src", "_j"]).withColumn("_start", F.col("_c") * F.col("_period"))


def mix(docs: DataFrame, cap: tuple[int, int] = CAP, block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION,
        weights: dict[str | None, float] | None = None, repeat: bool = False) -> DataFrame:
    """One row per document: doc_id, source, weight, block, release, deadline,
    slot, place (of the document inside its block), in_mixture. With given
    ``weights``, documents of sources not named have weight 0 and no slot; with
    ``repeat`` a document has a row for each time it stands in the mixture, with
    its epoch (from 0)."""
    rows = docs.select("doc_id", "source")
    by = weights_of(rows, cap, resolution, weights, repeat)
    d, start = _scheduled(rows, by, block_rows, repeat), F.col("_start")
    out = d.select(
        "doc_id", "source", (F.col("_parts") / F.col("_period")).alias("weight"), F.col("block"),
        (start + F.expr("(_j * _period) div _parts")).alias("release"),
        (start + F.expr("((_j + 1) * _period + _parts - 1) div _parts")).alias("deadline"),
        (start + F.col("_at")).alias("slot"),
        (F.col("_idx") % block_rows).alias("place"),
        (F.col("_idx") < F.col("_quota")).alias("in_mixture"), *(["epoch"] if repeat else []))
    if weights is None:
        return out
    rest = rows.join(F.broadcast(by.select(F.col("_src").alias("_s"))), _src(F.col("source")) == F.col("_s"), "left_anti")
    return out.unionByName(rest.select("doc_id", "source", F.lit(0.0).alias("weight"), F.lit(False).alias("in_mixture")), allowMissingColumns=True)


def mixture(docs: DataFrame, cap: tuple[int, int] = WHOLE, block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION,
            weights: dict[str | None, float] | None = None, repeat: bool = False) -> DataFrame:
    """The documents of the mixture, all columns, in the order of the schedule's
    slots and of the places inside them. By default each source's target is its
    natural share, under which every document stays; with a smaller ``cap``
    what a capped source has above its target goes, with ``weights`` what the
    stated mixture does not hold, and with ``repeat`` documents recur."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # whatever the columns are called
    rows = docs.select(row, "doc_id", "source", F.xxhash64("text").alias("text"))
    d = _scheduled(rows, weights_of(docs, cap, resolution, weights, repeat), block_rows, repeat).where("_idx < _quota")
    return d.orderBy(F.col("_start") + F.col("_at"), F.col("_idx") % block_rows).select("_row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


SQL = """
WITH RECURSIVE
d AS (SELECT doc_id, source, coalesce('s' || source, 'n') AS src FROM documents),
c AS (SELECT src, count(*) AS n FROM d GROUP BY src),
lv AS (
  SELECT src, n, row_number() OVER (ORDER BY n DESC, src) - 1 AS k,
         sum(n) OVER (ORDER BY n DESC, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
lv2 AS (SELECT *, CASE WHEN k < 4 THEN floor(rest / (4 - k)) END AS level FROM lv),
cut AS (SELECT min(k) AS k FROM lv2 WHERE n <= level),
q AS (
  SELECT src, n, CASE WHEN lv2.k < (SELECT k FROM cut) THEN least(n, (SELECT level FROM lv2 JOIN cut USING (k))) ELSE n END::BIGINT AS quota FROM lv2),
tot AS (SELECT count(*) AS s, sum(quota)::BIGINT AS m, greatest(1000, 4 * count(*))::BIGINT AS w FROM q),
base AS (SELECT src, quota, w, 1 + ((w - s) * quota) // m AS base, ((w - s) * quota) % m AS rem FROM q, tot),
parts AS (
  SELECT src, quota, w, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, src) <= w - (SELECT sum(base) FROM base) THEN 1 ELSE 0 END AS a FROM base),
idx AS (SELECT *, row_number() OVER (ORDER BY src) AS i FROM parts),
lists AS (SELECT list(a ORDER BY i) AS a, max(w) AS w FROM idx),
run(t, pick, done) AS (
  SELECT -1::BIGINT, 0::BIGINT, (SELECT list_transform(a, lambda x: 0::BIGINT) FROM lists)
  UNION ALL
  SELECT t, pick, list_transform(done, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END)
  FROM (
    SELECT r.t + 1 AS t, r.done,
           (SELECT g.i FROM (SELECT unnest(generate_series(1, len(r.done))) AS i) g
            WHERE r.done[g.i] < l.a[g.i] AND (r.done[g.i] * l.w) // l.a[g.i] <= r.t + 1
            ORDER BY ((r.done[g.i] + 1) * l.w + l.a[g.i] - 1) // l.a[g.i], g.i LIMIT 1) AS pick
    FROM run r, lists l WHERE r.t + 1 < l.w)),
plan AS (SELECT src, t AS slot_at, row_number() OVER (PARTITION BY src ORDER BY t) - 1 AS j FROM run JOIN idx ON idx.i = run.pick WHERE t >= 0),
num AS (SELECT doc_id, source, src, row_number() OVER (PARTITION BY src ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS x FROM d)
SELECT doc_id, source, a / w AS weight, x // 64 AS block,
       ((x // 64) // a) * w + (((x // 64) % a) * w) // a AS release,
       ((x // 64) // a) * w + (((x // 64) % a + 1) * w + a - 1) // a AS deadline,
       ((x // 64) // a) * w + slot_at AS slot, x % 64 AS place, x < quota AS in_mixture
FROM num JOIN parts USING (src) JOIN plan ON plan.src = num.src AND plan.j = (x // 64) % a
"""
