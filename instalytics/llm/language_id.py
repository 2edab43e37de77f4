"""Language identification by error-correcting output codes.

Every language gets a codeword of +1 / -1 bits. One binary n-gram classifier
per bit (log odds of hashed byte trigrams between the languages at +1 and
those at -1) gives a margin, the mean log odds per trigram of the text. The
prediction is the codeword with the least logistic loss over the margins; the
text is flagged ambiguous where the two best codewords are nearly as near.

Learning reads a bounded sample: of each language about ``docs_per_lang``
training documents, chosen by a hash of the id. Predicting reads whole texts.
Weights are integers, so a result does not depend on how rows are batched.

Null or letterless text: ``und``, score 0. Without any labelled training row
every text is ``und``. With one language every text with a letter is that.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, table

UND = "und"
DIM = 1 << 15
SCALE = 4096
CHUNK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")

# byte classes: A-Z to a-z; every other ASCII byte that is no letter to a space
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32


@dataclass
class Model:
    langs: list[str]
    codes: np.ndarray  # languages x bits, +1 / -1
    weights: np.ndarray  # DIM + 1 rows (the last is zero) x bits, scaled log odds


def codewords(n: int) -> np.ndarray:
    """The exhaustive code for up to 5 languages (all distinct splits), else
    seeded random codes, the best of 200 draws by least Hamming distance."""
    if n <= 1:
        return np.ones((n, 1), np.int64)
    if n <= 5:
        cols = [[1] + [1 if (k >> i) & 1 else -1 for i in range(n - 1)] for k in range(2 ** (n - 1) - 1)]
        return np.array(cols, np.int64).T
    bits, rng = max(15, math.ceil(10 * math.log2(n))), np.random.default_rng(7)
    best, far = None, -1
    for _ in range(200):
        m = rng.choice(np.array([-1, 1]), (n, bits))
        d = min(int((m[i] != m[j]).sum()) for i in range(n) for j in range(i))
        if d > far and (np.abs(m.sum(0)) < n).all():
            best, far = m, d
    return best


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashed trigram at every byte but the last two."""
    x = _FOLD[data]
    return ((x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B)) ^ (x[2:] * np.uint32(0xC2B2AE35))) >> np.uint32(17)


def _buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (null: no bytes)."""
    col = col.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if off[-1] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def gram_sums(data: np.ndarray, off: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: sums of the weights of its trigrams, and how many there are."""
    n_bits, n = weights.shape[1], len(off) - 1
    sums, lens = np.zeros((n, n_bits), np.int64), np.diff(off)
    starts = off[:-1]
    for lo in range(0, len(data), CHUNK):
        hi = min(lo + CHUNK, len(data))
        part = data[lo : hi + 2]
        if len(part) < 3:
            continue
        idx = _grams(part)
        size = len(idx)
        ends = off[1:][lens > 0] - lo  # trigrams must not cross into the next text
        for back in (1, 2):
            cut = ends - back
            cut = cut[(cut >= 0) & (cut < size)]
            idx[cut] = DIM
        first = int(np.searchsorted(off, lo, "right")) - 1
        last = int(np.searchsorted(starts, lo + size, "left"))
        rows = np.arange(first, last)
        rows = rows[lens[rows] > 0]
        if not len(rows):
            continue
        at = np.maximum(starts[rows] - lo, 0)
        sums[rows] += np.add.reduceat(weights[idx], at, axis=0, dtype=np.int64)
    return sums, np.maximum(lens - 2, 0)


def _count(batches):
    for batch in batches:
        data, off = _buffer(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        counts: dict[str, np.ndarray] = {}
        for i, lang in enumerate(langs):
            part = data[off[i] : off[i + 1]]
            if len(part) >= 3:
                counts.setdefault(lang, np.zeros(DIM, np.int64))
                counts[lang] += np.bincount(_grams(part), minlength=DIM)
        yield pa.RecordBatch.from_pydict({"lang": list(counts), "counts": [c.tobytes() for c in counts.values()]},
                                         schema=pa.schema([("lang", pa.string()), ("counts", pa.binary())]))


def fit(train: DataFrame, docs_per_lang: int = 1000) -> Model:
    """``train``: doc_id, text, lang. The sample is bounded, so its counts are."""
    spark = train.sparkSession
    rows = train.select(F.col("doc_id"), F.col("text"), F.col("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], codewords(0), np.zeros((DIM + 1, 1), np.int32))
    share = spark.createDataFrame([(k, int(min(1.0, docs_per_lang / n) * (1 << 30))) for k, n in sizes.items()], "lang string, below long")
    picked = (rows.join(F.broadcast(share), "lang")
              .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("below"))
              .select("doc_id", "text", "lang").repartition(8, "doc_id").select("text", "lang"))
    counts = {k: np.zeros(DIM) for k in langs}
    for r in picked.mapInArrow(_count, "lang string, counts binary").toLocalIterator():
        counts[r["lang"]] += np.frombuffer(r["counts"], np.int64)
    # each language weighs the same, whatever its share of the sample
    p = np.array([(counts[k] + 0.02) / (counts[k].sum() + 0.02 * DIM) for k in langs])
    codes = codewords(len(langs))
    w = np.zeros((DIM + 1, codes.shape[1]), np.int32)
    for b in range(codes.shape[1]):
        up, down = p[codes[:, b] > 0], p[codes[:, b] < 0]
        if len(up) and len(down):
            w[:DIM, b] = np.round(SCALE * np.log(up.mean(0) / down.mean(0)))
    return Model(langs, codes, w)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by logistic loss: index, score in 0..1, and the gap
    between the losses of the two nearest codewords per bit."""
    loss = np.logaddexp(0, -4.0 * model.codes[None, :, :] * margins[:, None, :]).mean(2)
    order = np.sort(loss, axis=1)
    like = np.exp(-model.codes.shape[1] * (loss - order[:, :1]))
    gap = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.ones(len(loss))
    return loss.argmin(1), 1.0 / like.sum(1), gap


def _classified(docs: DataFrame, model: Model, tie: float, keep: list[str]) -> tuple[DataFrame, list]:
    """The columns ``keep`` as c0, c1, ... with the verdict, and how to name them back."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    n = len(keep)
    names = [f"c{i}" for i in range(n)]
    src = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, names, strict=True)], F.col("text").alias("body"))
    schema = ", ".join(f"{a} {src.schema[a].dataType.simpleString()}" for a in names)

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column("body")
            ok = np.array([bool(t and _LETTER.search(t)) for t in texts.to_pylist()], bool) if m.langs else np.zeros(len(texts), bool)
            data, off = _buffer(texts)
            if m.langs and len(texts):
                sums, grams = gram_sums(data, off, m.weights)
                best, score, gap = decode(m, sums / (SCALE * np.maximum(grams, 1))[:, None])
            else:
                best, score, gap = np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts))
            pred = [m.langs[b] if good else UND for b, good in zip(best.tolist(), ok.tolist(), strict=True)]
            out = [batch.column(a) for a in names] + [pa.array(pred, pa.string()), pa.array(np.where(ok, score, 0.0)), pa.array(ok & (gap < tie))]
            yield pa.RecordBatch.from_arrays(out, names=[*names, "lang_pred", "score", "ambiguous"])

    res = src.mapInArrow(run, f"{schema}{', ' if n else ''}lang_pred string, score double, ambiguous boolean")
    return res, [F.col(a).alias(c) for c, a in zip(keep, names, strict=True)]


def classify(docs: DataFrame, model: Model, tie: float = 0.02) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous (the losses of the two nearest
    codewords differ by less than ``tie``)."""
    res, named = _classified(docs, model, tie, ["doc_id"])
    return res.select(*named, "lang_pred", "score", "ambiguous")


def identified(docs: DataFrame, model: Model, tie: float = 0.02) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is told and not ambiguous."""
    res, named = _classified(docs, model, tie, docs.columns)
    return res.where((F.col("lang_pred") != UND) & ~F.col("ambiguous")).select(*named)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").where(crc_mod("doc_id", 4) != 2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = classify(docs, fit(training_rows(docs)))
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
