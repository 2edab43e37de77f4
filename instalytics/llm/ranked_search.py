"""Ranked lexical search over hashed max-sketches.

The index holds for each document its number of terms, its distinct terms with
their counts, and a sketch: a byte vector of a power of two of at least
``CELLS`` cells per distinct term, into which the counts fold as coordinatewise
maxima at two hashed places of each term (counts above 254 as 255, which stands
for any). For a fixed document a term's impact grows with its count, so the
smaller of the two cells gives an upper bound of the impact, and the bounds of
a query's terms add up to one of its score. Queries are looked up in batches:
one pass of the sketches per batch, all its terms at once. Inside a task,
documents are scored exactly in the order of falling bounds, until the bound is
below the k-th best score found so far; ties on the bound are scored as well.
The tasks' best k meet in a two-level top k.

The index is built once over all documents and staged; counts of documents and
terms are taken from it by aggregation. Batches are cut by number of terms
(``BATCH_TERMS``); what a task holds is one batch, k rows a query and one Arrow
batch of documents. The numbers of documents per term shuffle after a partial
count.

Null or empty texts have no terms: such a document is in no result, such a
query gives no rows. Repeated documents are ranked each, repeated queries are
answered each. Equal scores stand by ascending id, null ids last. Ids of
documents are integers. Extra columns are not read. Empty tables give an empty
result. Very long texts are taken whole, one at a time.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

TOP = 50
CELLS = 8
BATCH_TERMS = 200_000
CHUNK = 512
MIXER = np.uint32(2654435761)
BEYOND = 1_000_000  # no impact factor reaches this

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

INDEX = "_rid long, doc_id long, n long, terms array<binary>, counts array<int>, sketch binary"


def terms_of(text: bytes | None) -> Counter:
    """Terms of a UTF-8 text: runs of ASCII letters, digits and all other characters, A-Z lower-cased."""
    return Counter(_TERM.findall((text or b"").translate(_LOWER)))


def hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms), np.uint32, len(terms))


def places(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of each hash in a sketch of ``width`` (a power of two) cells."""
    return h & np.uint32(width - 1), (h * MIXER) >> np.uint32(32 - (width - 1).bit_length())


def fold(h: np.ndarray, counts: np.ndarray) -> bytes:
    """The sketch: maxima of the counts at both places of every term."""
    width = 1 << max(6, (CELLS * len(h) - 1).bit_length())
    rising = np.argsort(counts, kind="stable")
    cells = np.zeros(width, np.uint8)
    value = np.minimum(counts[rising], 255).astype(np.uint8)
    a, b = places(h[rising], width)
    # in rising order the last value written to a cell is its maximum
    cells[a] = value
    other = np.zeros(width, np.uint8)
    other[b] = value
    return np.maximum(cells, other).tobytes()


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, CHUNK) for i in range(0, batch.num_rows, CHUNK)):
                total, sizes, flat, counts, sketches = [], [0], [], [], []
                for t in part.column("text"):
                    c = terms_of(t.as_py())
                    terms = list(c)
                    n = np.fromiter(c.values(), np.int64, len(c))
                    total.append(int(n.sum()))
                    sizes.append(sizes[-1] + len(terms))
                    flat.extend(terms)
                    counts.append(n.astype(np.int32))
                    sketches.append(fold(hashes(terms), n))
                at = pa.array(sizes, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_rid"), part.column("doc_id"), pa.array(total, pa.int64()), pa.ListArray.from_arrays(at, pa.array(flat, pa.binary())),
                     pa.ListArray.from_arrays(at, pa.array(np.concatenate(counts), pa.int32())), pa.array(sketches, pa.binary())],
                    names=["_rid", "doc_id", "n", "terms", "counts", "sketch"])

    d = docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                    F.col(f"`{text}`").cast("binary").alias("text"))
    return d.mapInArrow(build, INDEX)


def document_counts(index: DataFrame) -> DataFrame:
    """term, df over all documents."""
    return index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


class Batch:
    """The queries of one pass: their distinct terms, weights and places."""

    def __init__(self, rows: list, n_docs: int):
        self.queries = [r["_rid"] for r in rows]
        weights: dict[bytes, int] = {}
        at: list[int] = []
        starts: list[int] = []
        self.index: dict[bytes, int] = {}
        for r in rows:
            starts.append(len(at))
            for x in r["terms"]:
                term = bytes(x["term"])
                weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x["df"] + 1)))
                at.append(self.index.setdefault(term, len(self.index)))
        self.h = hashes(list(self.index))
        self.weight = np.fromiter((weights[t] for t in self.index), np.int64, len(self.index))
        self.at, self.starts = np.array(at, np.int64), np.array(starts, np.int64)

    def sums(self, factors: np.ndarray) -> np.ndarray:
        """Each query's sum of weight times factor over its terms."""
        return np.add.reduceat((self.weight * factors)[self.at], self.starts)

    def bounds(self, sketch: bytes, m: int) -> np.ndarray:
        cells = np.frombuffer(sketch, np.uint8)
        a, b = places(self.h, len(cells))
        factor = impact(np.arange(256, dtype=np.int64), m)
        factor[255] = BEYOND
        return self.sums(factor[np.minimum(cells[a], cells[b])])

    def exact(self, terms: list[bytes], counts: np.ndarray, m: int) -> np.ndarray:
        known = [(i, self.index[t]) for i, t in enumerate(terms) if t in self.index]
        tf = np.zeros(len(self.index), np.int64)
        if known:
            i, j = np.array(known).T
            tf[j] = counts[i]
        return self.sums(impact(tf, m))


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def search_batch(index: DataFrame, batch: Batch, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """_query, doc_id, score: each task's best k documents of each query."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in batch.queries]
        least = np.ones(len(batch.queries), np.int64)  # a score must be above 0
        for whole in batches:
            for part in (whole.slice(i, CHUNK) for i in range(0, whole.num_rows, CHUNK)):
                ids, terms, counts = part.column("doc_id"), part.column("terms"), part.column("counts")
                # m of each document: 50 + 50 n N div L
                m = [50 + (50 * n * n_docs) // n_terms for n in part.column("n").to_pylist()]
                upper = np.array([batch.bounds(s.as_py(), x) for s, x in zip(part.column("sketch"), m, strict=True)]).reshape(len(m), -1)
                scores: dict[int, np.ndarray] = {}
                for q in np.flatnonzero((upper >= least).any(axis=0)):
                    heap = best[q]
                    order = np.argsort(-upper[:, q], kind="stable")
                    for d in order.tolist():
                        if upper[d, q] < least[q]:
                            break
                        if d not in scores:
                            scores[d] = batch.exact(terms[d].as_py(), np.array(counts[d].as_py(), np.int64), m[d])
                        score = int(scores[d][q])
                        if score >= least[q]:
                            i = ids[d].as_py()
                            entry = (score, -math.inf if i is None else -i)
                            if len(heap) < k:
                                heapq.heappush(heap, entry)
                            else:
                                heapq.heappushpop(heap, entry)
                            if len(heap) == k:
                                least[q] = heap[0][0]
        rows = [(query, None if i == -math.inf else -i, score) for query, heap in zip(batch.queries, best, strict=True) for score, i in heap]
        cols = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["_query", "doc_id", "score"])

    return index.select("doc_id", "n", "terms", "counts", "sketch").mapInArrow(scan, "_query long, doc_id long, score long")


def top_rows(rows: DataFrame, k: int) -> DataFrame:
    """The best k of each query and their rank, in two levels."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    local = Window.partitionBy("_query", "_salt").orderBy(*order)
    rows = rows.withColumn("_salt", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(local)).where(F.col("rank") <= k)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("_query").orderBy(*order))).where(F.col("rank") <= k).drop("_salt")


def search(docs: DataFrame, queries: DataFrame, query_id: str = "item_id", k: int = TOP, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """query_id, rank, doc_id, score."""
    index = staged(build_index(docs), "search-index")
    total = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    asked = staged(build_index(queries, query_id), "search-queries").where(F.size("terms") > 0).select("_rid", F.col("doc_id").alias("_qid"), "terms")
    pairs = asked.select("_rid", F.explode("terms").alias("term"))
    known = staged(document_counts(index).join(pairs.select("term").distinct(), "term"), "search-terms")
    weighted = pairs.join(known, "term").groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms"))
    n_batches = (asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // batch_terms + 1
    weighted = staged(weighted.withColumn("_batch", F.pmod(F.xxhash64("_rid"), F.lit(n_batches))), "search-weights")
    found = docs.sparkSession.createDataFrame([], "_query long, doc_id long, score long")
    for b in range(n_batches):
        rows = weighted.where(F.col("_batch") == b).orderBy("_rid").collect()
        if rows:
            found = found.unionByName(search_batch(index, Batch(rows, total["docs"]), total["docs"], total["terms"], k))
    out = top_rows(found, k).join(F.broadcast(asked.select(F.col("_rid").alias("_query"), "_qid")), "_query")
    return out.select(F.col("_qid").alias(query_id), "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH tok AS (
  SELECT 'd' AS side, row_number() OVER () AS rid, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'q', row_number() OVER (), item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM tok WHERE side = 'd' AND len(w) > 0),
terms AS (SELECT side, rid, id, term, count(*) AS tf FROM (SELECT side, rid, id, unnest(w) AS term FROM tok) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM terms, total WHERE side = 'd' GROUP BY term),
m AS (SELECT rid, 50 + (50 * len(w) * n) // l AS m FROM tok, total WHERE side = 'd'),
s AS (
  SELECT q.rid AS qrid, q.id AS item_id, d.rid, d.id AS doc_id, sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 20 * m)))::BIGINT AS score
  FROM terms q JOIN terms d ON q.side = 'q' AND d.side = 'd' AND d.term = q.term JOIN df ON df.term = q.term JOIN m ON m.rid = d.rid
  GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY qrid ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY qrid ORDER BY score DESC, doc_id) <= 50
"""
