"""Language-model scores of whole documents.

Learning: token counts over all training documents, aggregated by Spark; the
recurrent model (``recurrent_lm``) is trained where the documents are, each
task on its own ones, in ``ROUNDS`` rounds that between them take every training
document once (dealt by a hash of id and text, so that rows without an id are
spread as well); the weights are averaged after each round, weighted by tokens.

Scoring: one pass over all texts, states carried through the whole text. The
``DICTIONARY`` most frequent words and the model are broadcast (bounded);
occurrences of other words are summed per document and joined to the counts.

Words are split off and looked up in Arrow, ``lm.TEXTS`` texts at a time.

Null text counts as empty: its only token is the end. Without a training
document all counts are 0 and both scores use them. Equal rows give equal
scores, one row each. Extra columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import recurrent_lm as lm
from .common import crc_mod, one_blas_thread, staged, table

DICTIONARY = 100_000
ROUNDS = 3
MEETINGS = 64
LN10 = float(np.log(10.0))


def _count(batches):
    for batch in batches:
        tokens, n = [pa.array([lm.END], pa.binary())], [pa.array([batch.num_rows], pa.int64())]
        for lo in range(0, batch.num_rows, lm.TEXTS):
            seen = lm.words_of(batch.column("text").slice(lo, lm.TEXTS))[0].value_counts()
            tokens.append(seen.field("values"))
            n.append(seen.field("counts"))
        some = pa.table({"token": pa.concat_arrays(tokens), "n": pa.concat_arrays(n)})
        yield from some.group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"]).to_batches()


def token_counts(training: DataFrame) -> DataFrame:
    """token (bytes), n over all training documents."""
    return training.select("text").mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> lm.Vocabulary:
    """Bounded: the dictionary and at most 65,536 + 256 suffixes."""
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # the least count at which no more words than that have it or more; sorting by count at
    # the driver would send the dictionary once for each task
    by_n = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    more = by_n.withColumn("s", F.sum("k").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    fits = more.where(F.col("s") <= DICTIONARY).agg(F.min("n"), F.max("s")).first()
    least, room = fits[0] if fits[0] is not None else 1 << 62, DICTIONARY - (fits[1] or 0)
    top = counts.where(F.col("n") >= least).collect()
    # of the words with the next lower count, more than there is room for: a share of them by hash
    tied = by_n.where(F.col("n") < least).orderBy(F.desc("n")).first()
    if tied is not None:
        share = int(1_000_000 * room / tied["k"] * 0.95)
        top += counts.where((F.col("n") == tied["n"]) & (F.pmod(F.xxhash64("token"), F.lit(1_000_000)) < share)).limit(room).collect()
    ends = counts.groupBy(F.substring("token", -2, 2).alias("s")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    return lm.Vocabulary({bytes(r["token"]): r["n"] for r in top}, {bytes(r["s"]): (r["n"], r["v"]) for r in ends}, total[0] or 0, total[1])


def _mean(rows) -> tuple[dict, int]:
    """Weights averaged by tokens."""
    total, out = sum(n for n, _ in rows), {}
    for n, raw in rows:
        for k, a in pickle.loads(raw).items():
            out[k] = out.get(k, 0) + a.astype(np.float64) * (n / max(1, total))
    return {k: a.astype(np.float32) for k, a in out.items()}, total


def train(training: DataFrame, v: lm.Vocabulary) -> dict:
    """``training``: doc_id, text."""
    sc = training.sparkSession.sparkContext
    weights, words = lm.fresh(v), sc.broadcast(v)
    for k in range(ROUNDS):
        some = training.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == k).select("text")
        start = sc.broadcast(weights)

        def local(batches, start=start):
            one_blas_thread()
            p, seen, voc = start.value, 0, words.value
            for batch in batches:
                places, classes = [], []
                for lo in range(0, batch.num_rows, lm.TEXTS):
                    at, cls, counts, _, _ = voc.lookup(batch.column("text").slice(lo, lm.TEXTS))
                    cuts = np.cumsum(counts)[:-1]
                    places += np.split(at, cuts)
                    classes += np.split(cls, cuts)
                p, n = lm.train(voc, p, places, classes)
                seen += n
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MEETINGS], pa.int32()), pa.array([seen], pa.int64()),
                                                  pa.array([pickle.dumps(p)], pa.binary())], names=["at", "n", "w"])

        def meet(table: pa.Table) -> pa.Table:
            w, n = _mean(list(zip(table.column("n").to_pylist(), table.column("w").to_pylist(), strict=True)))
            return pa.table({"n": pa.array([n], pa.int64()), "w": pa.array([pickle.dumps(w)], pa.binary())})

        parts = some.mapInArrow(local, "at int, n long, w binary").groupBy("at").applyInArrow(meet, "n long, w binary").collect()
        if parts:
            weights = _mean([(r["n"], bytes(r["w"])) for r in parts])[0]
    return weights


def score(docs: DataFrame, v: lm.Vocabulary, weights: dict, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row of docs."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((v, weights))
    norm = float(np.log10(v.tokens + 0.5 * (v.types + 1)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        one_blas_thread()
        voc, p = shared.value
        # by place; the last entry is for words without one (-1), which have a count of their
        # own and, in their class, a share of that over the total of the class
        log_count, seen = np.append(np.log10(voc.count + 0.5), 0.0), np.append(voc.count > 0, False)
        log_total = np.log10(voc.tail_total)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n_tokens, base, known, share, places, classes, rare, times = [], [], [], [], [], [], [], []
            for lo in range(0, batch.num_rows, lm.TEXTS):
                at, cls, counts, unknown, lost = voc.lookup(batch.column("text").slice(lo, lm.TEXTS))
                stop = np.cumsum(counts)
                first, n, text = stop - counts, len(counts), np.searchsorted(stop, lost, "right")
                n_tokens.append(counts)
                base.append(np.add.reduceat(log_count[at], first))
                known.append(np.add.reduceat(seen[at].astype(np.int64), first))
                share.append(-np.bincount(text, log_total[cls[lost]], n))
                places += np.split(at, stop[:-1])
                classes += np.split(cls, stop[:-1])
                # each unknown word once a text, and how often
                words = unknown.dictionary_encode()
                kinds = max(1, len(words.dictionary))
                each, often = np.unique(text * kinds + words.indices.to_numpy(), return_counts=True)
                cuts = pa.array(np.searchsorted(each // kinds, np.arange(n + 1)), pa.int32())
                rare.append(pa.ListArray.from_arrays(cuts, words.dictionary.take(pa.array(each % kinds))))
                times.append(pa.ListArray.from_arrays(cuts, pa.array(often, pa.int64())))
            if not n_tokens:
                continue
            n_tokens, base, known, share = map(np.concatenate, (n_tokens, base, known, share))
            ln, n = lm.score(voc, p, places, classes), len(n_tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base - n_tokens * norm), pa.array(ln / LN10 + share), pa.concat_arrays(rare), pa.concat_arrays(times)],
                names=["row", "doc_id", "n_tokens", "known", "base", "ln", "rare", "times"])
            row += n

    schema = f"row long, doc_id {kind}, n_tokens long, known long, base double, ln double, rare array<binary>, times array<bigint>"
    rows = staged(docs.select("doc_id", "text").mapInArrow(run, schema), "lm-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    found = rare.join(counts, "token", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    more = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("more"),
                                    F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    out = rows.drop("rare", "times").join(more, "row", "left").fillna(0, ["more", "more_known"])
    return out.select("doc_id", "n_tokens", (F.col("known") + F.col("more_known")).alias("n_known"),
                      (F.col("base") + F.col("more")).alias("base_score"), (F.col("ln") + F.col("more")).alias("score"))


def lm_scores(docs: DataFrame, training: DataFrame) -> tuple[DataFrame, int]:
    """Scores of ``docs`` by what ``training`` teaches, and the training tokens."""
    counts = staged(token_counts(training), "lm-counts")
    v = vocabulary(counts)
    return score(docs, v, train(training, v), counts), v.tokens


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, tokens = lm_scores(docs, docs.where(crc_mod("doc_id", 5) != 1))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
