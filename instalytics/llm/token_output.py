"""Token-id files: documents tokenized, written in doc_id order and read back.

A file holds documents that follow each other in ascending doc_id; files are
numbered in that order. Layout, little-endian: ``MAGIC``, number of documents,
of blocks and of tokens (uint64), of each document its id (int64), whether it
has one (uint8) and its token count (uint32), of each block its token count,
crc32 and words (uint32), then the payloads of the blocks (see
``range_coder``). Documents run on across blocks.

Files are written to the shared checkpoint folder under a temporary name and
renamed, so a retried task replaces its own file by equal bytes. What was
written is listed by a small table (one row per file), from which reading
starts. Texts are cut before spaces, where the tokenizer cuts as well, and each
different word is encoded once per task, so the ids are those of the whole
text; a text where a cut could part a run of white space, or that holds one of
the tokenizer's special tokens (taken as the library does by default), is encoded
as it is.

Reading takes everything from the files: ids and counts of documents, their
tokens, and where a file begins from the token numbers in the heads of the files
before it; the table gives their paths and order.

Ids are integers. Null text counts as empty; its document is the end id alone. Null ids come
first; equal ids stand in the order of a checksum of their text. A row per
document row, repeated ones included. An empty table writes nothing.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import range_coder
from .common import shared_path, staged, table

MAGIC = b"IDS\x02"
HEAD = 28
END = 0
FILE_BYTES = 24 << 20
WORDS = 400_000
# white space before a space and after it (or the end): there a cut would part a run of white space
RUN = r"[\t-\r\x{85}\p{Z}] (?:[\t-\r\x{85}\p{Z}]|$)"


class Encoder:
    """Ids of whole texts by the tokenizers library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, list[int]] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of the texts (no nulls), the end id included, and all ids."""
        whole = pc.match_substring_regex(texts, RUN)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        parts = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        coded = parts.flatten().dictionary_encode()
        words = [" " + w for w in coded.dictionary.to_pylist()]
        if len(self.known) > WORDS:
            self.known.clear()
        known = self.known
        new = [w for w in words if w not in known]
        known.update(zip(new, self._encode(new), strict=True))
        # the first part of a text has no space before it; a text that is not cut is all in its first part
        at = coded.indices.to_numpy().astype(np.int64)
        first = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        heads = [t if w else words[k][1:] for t, w, k in zip(texts.to_pylist(), whole.to_pylist(), at[first].tolist(), strict=True)]
        at[first] = len(words) + np.arange(len(heads))
        units = [known[w] for w in words] + self._encode(heads)
        size = np.fromiter(map(len, units), np.int64, len(units))
        flat = np.fromiter(chain.from_iterable(units), np.uint32, int(size.sum()))
        n = size[at]
        from_ = (np.cumsum(size) - size)[at] - (np.cumsum(n) - n)
        out = flat[np.repeat(from_, n) + np.arange(int(n.sum()))]
        counts = np.add.reduceat(n, first) if len(first) else n
        return counts + 1, np.insert(out, np.cumsum(counts), END).astype(np.uint32)


def _open(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_file(path: str, docs: pa.Array, counts: np.ndarray, ids: np.ndarray) -> int:
    """Writes one file of documents (int64 ids, null or not); its size in bytes."""
    blocks = range_coder.encode(ids)
    head = [MAGIC, struct.pack("<QQQ", len(counts), len(blocks), len(ids)), pc.fill_null(docs, 0).to_numpy().astype("<i8").tobytes(),
            docs.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes(), counts.astype("<u4").tobytes()]
    head += [struct.pack("<III", n, crc, len(data) // 4) for n, crc, data in blocks]
    raw = b"".join(head + [data for _, _, data in blocks])
    fs, name = _open(path)
    fs.create_dir(name.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(temp := f"{name}.{uuid.uuid4().hex}") as f:
        f.write(raw)
    fs.move(temp, name)
    return len(raw)


def read_tokens(path: str) -> int:
    """The number of tokens in a file, from its head."""
    fs, name = _open(path)
    with fs.open_input_stream(name) as f:
        raw = f.read(HEAD)
    if raw[:4] != MAGIC:
        raise ValueError(f"{path}: no id file")
    return struct.unpack_from("<QQQ", raw, 4)[2]


def read_file(path: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids of the documents, their token counts, and all token ids. Raises ValueError on damage."""
    fs, name = _open(path)
    with fs.open_input_stream(name) as f:
        raw = f.read()
    if raw[:4] != MAGIC:
        raise ValueError(f"{path}: no id file")
    docs, n, total = struct.unpack_from("<QQQ", raw, 4)
    known = np.frombuffer(raw, "u1", docs, HEAD + 8 * docs) == 0
    keys = pa.array(np.frombuffer(raw, "<i8", docs, HEAD), mask=known)
    counts = np.frombuffer(raw, "<u4", docs, HEAD + 9 * docs)
    at = HEAD + 13 * docs
    info = np.frombuffer(raw, "<u4", 3 * n, at).reshape(n, 3).tolist()
    at += 12 * n
    blocks = []
    for tokens, crc, words in info:
        blocks.append((tokens, crc, raw[at : at + 4 * words]))
        at += 4 * words
    ids = range_coder.decode(blocks)
    if at != len(raw) or not len(ids) == total == int(counts.sum()):
        raise ValueError(f"{path}: length does not match")
    return keys, counts, ids


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``docs`` (doc_id, text) and returns the list of files: part, path, bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.crc32(text).alias("tie"))
    rows = (rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text"))

    def run(batches):
        enc, part = Encoder(tokenizer_path), TaskContext.get().partitionId()
        ids, counts, keys = [], [], []
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                n, some = enc.ids(batch.column("text").slice(lo, 500))
                counts.append(n)
                ids.append(some)
            keys.append(batch.column("doc_id"))
        if not ids:
            return
        keys = pa.concat_arrays(keys)
        counts, flat = np.concatenate(counts), np.concatenate(ids)
        del ids
        path = f"{folder}/part-{part:06d}.ids"
        written = write_file(path, keys, counts, flat)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([written], pa.int64())], names=["part", "path", "bytes"])

    return staged(rows.mapInArrow(run, "part int, path string, bytes long"), "id-files")


def read_ids(files: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    n = max(1, files.count())
    paths = files.select("part", "path").repartitionByRange(n, "part")

    def heads(batches):
        for batch in batches:
            tokens = [read_tokens(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], names=["part", "path", "tokens"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    sized = staged(paths.mapInArrow(heads, "part int, path string, tokens long"), "id-heads")
    src = sized.select("part", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")).repartitionByRange(n, "part")

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                keys, counts, ids = read_file(path)
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([keys, pa.array(starts + base), pa.array(counts.astype(np.int64)), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return src.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_path(spark, f"ids-{uuid.uuid4().hex}")
    files = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_ids(files)
