"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are the documents with equal texts; a group goes into one shard whole.
Groups are summed first (a hot text is one row), then packed in two steps so
that what one task packs does not grow with the corpus:

* every group larger than a quantum (the total over ``shards * grain``) is an
  item of its own: there are at most ``shards * grain`` of those;
* the others are strung together, largest first inside each of a fixed number
  of hash buckets, and cut at every quantum: at most as many again, plus one
  for each bucket.

The items, sorted by size, enter the bin with the tightest remaining capacity
that still holds them, found in a balanced tree of remaining capacities. For a
fixed number of shards the capacity is the least one, by bisection, at which
best fit needs no more bins; items above the fair share get bins of their own
first. ``pack`` with a capacity instead minimises the number of shards.

Slots number a shard's documents from 0 without gaps, by two-level counting: in
the order of a hash of their ids, or in the order in which the rows stand in
their files (``in_file_order``), so that an order that was written, as that of a
mixture, is the order inside every shard.
Null text: no bytes, the group of the empty text. Equal rows keep one slot
each. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

GRAIN = 128
BUCKETS = 256
ROW_BYTES = 16


class _Node:
    __slots__ = ("key", "rank", "left", "right")

    def __init__(self, key, rank):
        self.key, self.rank, self.left, self.right = key, rank, None, None


class CapacityTree:
    """A treap over (remaining capacity, bin): balanced by seeded ranks."""

    def __init__(self):
        self.root, self._seed = None, 88172645463325252

    def _rank(self) -> int:
        x = self._seed
        x ^= (x << 13) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 7
        x ^= (x << 17) & 0xFFFFFFFFFFFFFFFF
        self._seed = x
        return x

    def _split(self, node, key):
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, more = self._split(node.right, key)
            return node, more
        less, node.left = self._split(node.left, key)
        return less, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a.rank > b.rank:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def add(self, key) -> None:
        less, more = self._split(self.root, key)
        self.root = self._merge(self._merge(less, _Node(key, self._rank())), more)

    def take_least_from(self, key):
        """Removes and returns the least key that is not below ``key``, or None."""
        less, more = self._split(self.root, key)
        if more is None:
            self.root = less
            return None
        parent, node = None, more
        while node.left is not None:
            parent, node = node, node.left
        if parent is None:
            more = node.right
        else:
            parent.left = node.right
        self.root = self._merge(less, more)
        return node.key


def best_fit(sizes: list[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin of each size (sorted, largest first). None if more than ``max_bins`` are needed."""
    tree, bins, out = CapacityTree(), 0, []
    for size in sizes:
        found = tree.take_least_from((size, -1))
        if found is None:
            if max_bins is not None and bins >= max_bins:
                return None
            found = (max(capacity, size), bins)
            bins += 1
        out.append(found[1])
        tree.add((found[0] - size, found[1]))
    return out


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Bin of each size (sorted, largest first) for a fixed number of bins, near equal."""
    out, first, left = [], 0, sum(sizes)
    while first < len(sizes) and shards - first > 1 and sizes[first] * (shards - first) > left:
        out.append(first)  # larger than the fair share of the rest: a bin of its own
        left -= sizes[first]
        first += 1
    rest, bins = sizes[first:], shards - first
    if not rest:
        return out
    lo, hi = max(rest[0], -(-left // bins)), max(rest[0], -(-left // bins)) + rest[0] + 1
    best = best_fit(rest, hi, bins)
    while best is None:
        lo, hi = hi, hi * 2
        best = best_fit(rest, hi, bins)
    step = max(1, lo // 4096)  # near equal to a part in four thousand
    while hi - lo > step:
        mid = (lo + hi) // 2
        got = best_fit(rest, mid, bins)
        if got is None:
            lo = mid
        else:
            hi, best = mid, got
    got = best_fit(rest, lo, bins)
    return out + [first + b for b in (got or best)]


def _text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def light_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """What packing needs of a document: id, size, checksum and group."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (_text_bytes(t) + ROW_BYTES).alias("size"), F.crc32(t).alias("text_crc32"), F.md5(t).alias("grp"), *more)


def _pack_items(items: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """items: unit, bytes (a bounded number of rows); adds the shard."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "unit"], ascending=[False, True])
        sizes = [int(x) for x in pdf["bytes"]]
        bins = pack_into(sizes, shards) if shards is not None else best_fit(sizes, capacity)
        return pd.DataFrame({"unit": pdf["unit"], "shard": bins}).astype({"shard": "int32"})

    return items.groupBy().applyInPandas(pack, "unit string, shard int")


def place_groups(rows: DataFrame, shards: int | None = 40, capacity: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables (grp, shard): the large groups, at most a fixed number, and
    the others. One of ``shards`` and ``capacity`` is given."""
    groups = staged(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.sum("bytes"), F.sum("n")).first()
    bins = shards if shards is not None else max(1, math.ceil((total[0] or 0) / capacity))
    quantum = max(1, (total[0] or 0) // (bins * GRAIN))
    many = max(1, (total[1] or 0) // (bins * GRAIN))
    # by bytes or by rows: either bounds the number of large groups
    large = groups.where((F.col("bytes") > quantum) | (F.col("n") > many)).withColumn("unit", F.concat(F.lit("g"), F.col("grp")))
    small = groups.where((F.col("bytes") <= quantum) & (F.col("n") <= many))
    bucket = F.conv(F.substring("grp", 1, 2), 16, 10).cast("int")
    w = Window.partitionBy("bucket").orderBy(F.desc("bytes"), "grp").rowsBetween(Window.unboundedPreceding, -1)
    small = (small.withColumn("bucket", bucket)
             .withColumn("before", F.coalesce(F.sum("bytes").over(w), F.lit(0)))
             .withColumn("unit", F.concat(F.lit("s"), F.col("bucket"), F.lit("-"), F.floor(F.col("before") / F.lit(quantum)))))
    small = staged(small.select("grp", "bytes", "unit"), "shard-small")
    items = large.select("unit", "bytes").unionByName(small.groupBy("unit").agg(F.sum("bytes").alias("bytes")))
    plan = F.broadcast(staged(_pack_items(items, shards, capacity), "shard-plan"))  # a row for each item
    return (large.join(plan, "unit").select("grp", "shard"), small.join(plan, "unit").select("grp", "shard"))


def with_shard(rows: DataFrame, placed: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` (with grp) and their shard: the few large groups are broadcast,
    so that no hot group meets in the join of the others."""
    large, small = placed
    hot = F.broadcast(large)
    return rows.join(hot, "grp").unionByName(rows.join(hot, "grp", "left_anti").join(small, "grp"))


def id_bucket() -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 3), 16, 10).cast("int")


def has_file_order(docs: DataFrame) -> bool:
    """Whether ``docs`` is read from files that Spark numbered (``part-00000...``)."""
    try:
        docs.select(docs.metadataColumn("_metadata").getField("row_index"))
        return True
    except AnalysisException:
        return False


def with_slot(rows: DataFrame, order: list[str], bucket: Column | None = None) -> DataFrame:
    """Numbers the rows of each shard from 0 by bucket, then ``order``: counts
    of (shard, bucket) give the offsets, row numbers inside a bucket the rest."""
    d = rows.withColumn("_b", id_bucket() if bucket is None else bucket)
    d = staged(d, "shard-rows")
    n = d.groupBy("shard", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("shard", "_b", "_from")  # at most shards * buckets rows
    inside = Window.partitionBy("shard", "_b").orderBy(*order)
    return (d.withColumn("_i", F.row_number().over(inside)).join(n, ["shard", "_b"])
            .withColumn("slot", F.col("_from") + F.col("_i") - 1).drop("_b", "_i", "_from"))


def shard_documents(docs: DataFrame, shards: int = 40, in_file_order: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, grp, shard, slot."""
    if not in_file_order:
        rows = staged(light_rows(docs), "shard-light")
        return with_slot(with_shard(rows, place_groups(rows, shards)), ["doc_id", "text_crc32"])
    meta = docs.metadataColumn("_metadata")
    file = F.regexp_extract(meta.getField("file_name"), r"part-(\d+)", 1).cast("long")
    rows = staged(light_rows(docs, file.alias("_file"), meta.getField("row_index").alias("_at")), "shard-light")
    return with_slot(with_shard(rows, place_groups(rows, shards)), ["_at"], F.col("_file")).drop("_file", "_at")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
