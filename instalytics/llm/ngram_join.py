"""N-gram Jaccard self-join by chosen paths, with classes of near duplicates.

Texts are sets of five-word shingles (words between ASCII white space, A-Z
lower-cased; a text of fewer words is one shingle). Two texts are linked if
the Jaccard similarity of their sets is ``threshold`` or more.

1. Equal texts become one row. A text is embedded as 64 min-hash tokens.
2. Chosen paths: each run samples tokens shared by everyone at a node, with
   1 / (threshold * 64) each, so 1.25 on average, and splits the texts by the
   value there. Buckets of at most ``leaf`` texts are compared by brute force
   on the tokens; larger ones are split again at tokens sampled by their own
   path; what cannot be split within ``levels`` is compared in pairs of blocks.
   The number of runs follows from the target recall.
3. Texts of a bucket whose tokens agree in ``screen`` or more are joined into
   candidate components. Within those all pairs are compared exactly, in pairs
   of blocks, so nothing is lost between texts of a component, and no list of
   pairs is made: a block pair yields a forest of verified links and the number
   of links of each text. Blocks hold 256 texts, in components of more than 64
   such blocks up to 2,048, and 16 megabytes: a text is sent once to each block
   of its component, and two blocks fit in a task.
4. The components of verified links are the classes.

One row per document: class_id (the least doc_id of the class), n_links (other
documents linked to this one, equal ones included), class_docs and is_first,
true for one document of each class (null texts: each one's own class, no link).
Texts without words are linked to equal texts only. Shingles and texts are
known by 64 and 128-bit hashes. Repeated rows count as copies; is_first is
then true for each of them. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import one_blas_thread, spread_join, staged, table

N = 5
THRESHOLD = 0.8
TOKENS = 64
RECALL = 0.999
SCREEN = 0.62
LEAF = 500
LEVELS = 3
BLOCK, WIDEST, GRID, BLOCK_BYTES = 256, 2048, 64, 1 << 24

_rng = np.random.default_rng(20)
_MUL = _rng.integers(1 << 62, size=TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1 << 62, size=TOKENS, dtype=np.uint64)
_STEP = _rng.integers(1 << 62, size=N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(data: bytes, words: dict) -> np.ndarray:
    """Hashes of the shingles of a text, repeats included; empty without words."""
    w = data.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.array([words[x] for x in w], np.uint64)
    n = min(N, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out += h[k : len(h) - n + 1 + k] * _STEP[k]
    return _mixed(out)


def _embed(batches):
    words = _WordHash()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        sig, wordy = np.zeros((len(texts), TOKENS), np.uint32), np.zeros(len(texts), bool)
        lo = 0
        while lo < len(texts):  # texts of about two megabytes at a time
            rows, sets, n = [], [], 0
            while lo < len(texts) and n < 1 << 21:
                s = shingles(texts[lo], words)
                if len(s):
                    rows.append(lo)
                    sets.append(s)
                n += len(texts[lo])
                lo += 1
            if rows:
                wordy[rows] = True
                flat = np.concatenate(sets)
                at = np.cumsum([0] + [len(s) for s in sets[:-1]])
                for t in range(TOKENS):
                    sig[rows, t] = np.minimum.reduceat(((flat * _MUL[t] + _ADD[t]) >> np.uint64(32)).astype(np.uint32), at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.md5(t).hexdigest() for t in texts]), batch.column("doc_id"), pa.array(wordy),
             pa.array([s.tobytes() for s in sig], pa.binary()), pa.array([len(t) for t in texts], pa.int64())],
            names=["key", "doc_id", "wordy", "sig", "size"])


def embed(docs: DataFrame) -> DataFrame:
    """key, copies, first_id, wordy, sig, size of each distinct text."""
    src = docs.select("doc_id", "text").where("text is not null")
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = src.mapInArrow(_embed, f"key string, doc_id {kind}, wordy boolean, sig binary, size long")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"),
                                   F.max("wordy").alias("wordy"), F.min("sig").alias("sig"), F.max("size").alias("size"))


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs so that a pair at the threshold meets in a bucket of the second
    level: a run succeeds at one level with 1 - 1/e, at the next with 1 - exp(-that)."""
    p = 1 - math.exp(-(1 - math.exp(-1)))
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two texts or more, and the size n of the node."""
    n = staged(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "path-sizes")
    total = n.agg(F.sum("n")).first()[0] or 0
    return spread_join(rows, n, "node", "n", total)


def buckets(sigs: DataFrame, leaf: int = LEAF, levels: int = LEVELS, threshold: float = THRESHOLD) -> DataFrame:
    """node, key of all buckets to be compared by brute force, each at most
    about ``2 * leaf`` texts. sigs: key, sig."""
    per_run = 1 / threshold
    runs = runs_for(threshold=threshold)
    order = np.random.default_rng(4).permutation(TOKENS)
    picks, used = [], 0
    for r in range(runs):  # 1.25 tokens for each run on average, all different
        take = math.floor(per_run * (r + 1)) - math.floor(per_run * r)
        picks += [(r, int(order[(used + k) % TOKENS])) for k in range(take)]
        used += take
    # the bytes of a token are its value; any fixed order of bytes will do
    nodes = F.array(*[F.xxhash64(F.lit(r), F.lit(i), F.substring("sig", F.lit(4 * i + 1), F.lit(4))) for r, i in picks])
    at = staged(_sized(sigs.select("key", F.explode(nodes).alias("node"))), "paths-1")
    out = at.where(F.col("n") <= leaf).select("node", "key")
    big = at.where(F.col("n") > leaf)
    for level in range(2, levels + 1):
        if big.isEmpty():
            return out
        one = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(TOKENS)).cast("int")
        two = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(TOKENS)).cast("int")
        more = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < F.lit(int(1000 * (per_run - 1)))
        chosen = F.when(more & (one != two), F.array(one, two)).otherwise(F.array(one))
        split = (big.select("node", "key").join(sigs, "key").withColumn("at", F.explode(chosen))
                 .select("key", F.xxhash64("node", "at", F.substring("sig", F.col("at") * 4 + 1, F.lit(4))).alias("node")))
        at = staged(_sized(split), f"paths-{level}")
        out = out.unionByName(at.where(F.col("n") <= leaf).select("node", "key"))
        big = at.where(F.col("n") > leaf)
    # too alike to be split: every pair of blocks of the node
    k = F.ceil(F.col("n") / leaf).cast("int")
    mine = F.pmod(F.xxhash64("key"), k).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.xxhash64("node", F.least("mine", j), F.greatest("mine", j)))
    rest = big.withColumn("k", k).withColumn("mine", mine).select("key", F.explode(pairs).alias("node"))
    return out.unionByName(rest.select("node", "key"))


def _groups(batches, column):
    """Runs of equal values of a column over batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and held[0].column(column)[0].as_py() != part.column(column)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _stars(n: int, pairs_of) -> list[tuple[int, int]]:
    """Edges from the least member of each component to the others. ``pairs_of``
    yields (i, array of linked j)."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, js in pairs_of:
        for j in js:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(find(i), i) for i in range(n) if find(i) != i]


EDGE = pa.schema([("a", pa.string()), ("b", pa.string())])


def _compare(batches):
    """Candidate edges of each bucket, by agreeing tokens."""
    need = math.ceil(SCREEN * TOKENS)
    a, b = [], []
    for g in _groups(batches, "node"):
        # the same text once: a text can reach a node by two paths
        keys = g.column("key").to_pylist()
        order = sorted({k: i for i, k in enumerate(keys)}.items())
        if len(order) > 1:
            sig = g.column("sig").to_pylist()
            m = np.frombuffer(b"".join(sig[i] for _, i in order), np.uint32).reshape(-1, TOKENS)
            if len(order) == 2:
                edges = [(0, 1)] if int((m[0] == m[1]).sum()) >= need else []
            else:
                step = max(1, (1 << 22) // m.size)

                def linked(m=m, step=step):
                    for lo in range(0, len(m), step):
                        hit = (m[lo : lo + step, None, :] == m[None, :, :]).sum(2, dtype=np.uint8) >= need
                        for r in range(len(hit)):
                            yield lo + r, np.flatnonzero(hit[r, : lo + r])

                edges = _stars(len(m), linked())
            for x, y in edges:
                a.append(order[x][0])
                b.append(order[y][0])
        if len(a) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], schema=EDGE)
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], schema=EDGE)


def components(edges: DataFrame, name: str) -> DataFrame:
    """key, comp of every key with an edge: the least key reached. Labels move
    along edges and then jump to the label of their label, until none changes."""
    e = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = staged(e.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("_m")).select("key", F.least("key", "_m").alias("comp")), f"{name}-labels")
    while True:
        near = (e.join(labels, e["a"] == labels["key"]).groupBy(e["b"].alias("key")).agg(F.min("comp").alias("_near")))
        step = labels.join(near, "key").select("key", F.col("comp").alias("_old"), F.least("comp", "_near").alias("comp"))
        step = staged(step, f"{name}-step")
        far = step.select(F.col("key").alias("_k"), F.col("comp").alias("_far"))
        new = staged(step.join(far, step["comp"] == far["_k"], "left").select("key", "_old", F.least("comp", F.coalesce("_far", "comp")).alias("comp")), f"{name}-labels")
        labels = new.select("key", "comp")
        if new.where("_old <> comp").isEmpty():
            return labels


def _exact(threshold):
    def run(batches):
        one_blas_thread()
        words = _WordHash()
        out: dict[str, list] = {"key": [], "links": [], "a": [], "b": []}

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(out["key"], pa.string()), pa.array(out["links"], pa.int64()),
                                                pa.array(out["a"], pa.string()), pa.array(out["b"], pa.string())], names=list(out))
            for v in out.values():
                v.clear()
            return batch

        for g in _groups(batches, "task"):
            cols = {c: g.column(c).to_pylist() for c in ("key", "text", "copies", "side")}
            order = sorted(range(len(cols["key"])), key=lambda i, c=cols: (c["side"][i], c["key"][i]))
            keys = [cols["key"][i] for i in order]
            copies = np.array([cols["copies"][i] for i in order], np.int64)
            sets = [np.unique(shingles(cols["text"][i].encode(), words)) for i in order]
            size = np.array([len(s) for s in sets], np.int64)
            # side 0 and 1 are two blocks: only pairs across; side 2 is one block: all its pairs
            one = cols["side"][order[0]] == 2
            cut = len(keys) if one else sum(cols["side"][i] == 0 for i in order)
            rest = slice(0 if one else cut, len(keys))
            if cut == 0 or rest.start == len(keys):  # the other block is empty: no pair
                out["key"] += keys
                out["links"] += [0] * len(keys)
                out["a"] += [None] * len(keys)
                out["b"] += [None] * len(keys)
                continue
            common = _intersections(sets) if one else _intersections(sets[:cut], sets[rest])
            link = common >= threshold * (size[:cut, None] + size[None, rest] - common) - 1e-9
            if one:
                np.fill_diagonal(link, False)
                links = link @ copies
            else:
                links = np.concatenate([link @ copies[rest], copies[:cut] @ link])
            out["key"] += keys
            out["links"] += links.tolist()
            edges = _stars(len(keys), ((i, np.flatnonzero(link[i]) + rest.start) for i in range(cut)))
            out["a"] += [None] * len(keys) + [keys[x] for x, _ in edges]
            out["b"] += [None] * len(keys) + [keys[y] for _, y in edges]
            out["key"] += [None] * len(edges)
            out["links"] += [None] * len(edges)
            if len(out["key"]) > 5000:
                yield flush()
        yield flush()

    return run


def _intersections(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the
    right (None: the left ones again, where the diagonal is of no use); tokens
    that can be in no intersection are left out."""
    if right is None:
        right = left
        both, n = np.unique(np.concatenate(left), return_counts=True)
        both = both[n > 1]
    else:
        both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.int64)
    step = max(64, (1 << 23) // max(out.shape))
    for lo in range(0, len(both), step):
        some = both[lo : lo + step]
        mine = _holds(left, some)
        out += (mine @ (mine if right is left else _holds(right, some)).T).astype(np.int64)
    return out


def _holds(sets: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    """1 where a set (in order) holds one of the ``tokens`` (in order), else 0."""
    out = np.zeros((len(sets), len(tokens)), np.float32)
    for row, s in zip(out, sets, strict=True):
        s = s[np.searchsorted(s, tokens[0]) : np.searchsorted(s, tokens[-1], "right")]
        at = np.searchsorted(tokens, s)
        row[at[tokens[at] == s]] = 1
    return out


def verified(texts: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """key, links of each text of a component, and verified edges a, b.
    texts: key, text, copies; comps: key, comp, size (of the text in bytes)."""
    size = staged(comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "component-sizes")
    m = spread_join(comps, size, "comp", "n", size.agg(F.sum("n")).first()[0] or 0)
    blocks = F.greatest(F.least(F.ceil(F.col("n") / BLOCK), F.lit(GRID)), F.ceil(F.col("n") / WIDEST), F.ceil(F.col("bytes") / BLOCK_BYTES))
    m = m.withColumn("k", blocks.cast("int"))
    m = m.withColumn("mine", F.pmod(F.xxhash64("key"), F.col("k")).cast("int"))
    # a task for each block alone and each pair of blocks
    m = m.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    m = m.select("key", F.xxhash64("comp", F.least("mine", "j"), F.greatest("mine", "j")).alias("task"),
                 F.when(F.col("mine") == F.col("j"), 2).when(F.col("mine") < F.col("j"), 0).otherwise(1).alias("side"))
    m = m.join(texts, "key").repartition("task").sortWithinPartitions("task")
    return m.select("task", "key", "side", "copies", "text").mapInArrow(_exact(threshold), "key string, links long, a string, b string")


def similarity_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, key (md5 of the text), class_id,
    n_links, class_docs, is_first."""
    groups = staged(embed(docs), "texts")
    sigs = groups.where("wordy").select("key", "sig")
    found = buckets(sigs, threshold=threshold).join(sigs, "key").repartition("node").sortWithinPartitions("node")
    near = components(staged(found.select("node", "key", "sig").mapInArrow(_compare, "a string, b string"), "candidates"), "near")
    # the text of each member once
    members = near.join(groups.select("key", "copies", "first_id", "size"), "key")
    src = docs.select("doc_id", "text", F.md5("text").alias("key")).where("text is not null")
    mine = src.alias("d").join(members.alias("m"), (F.col("d.key") == F.col("m.key")) & F.col("d.doc_id").eqNullSafe(F.col("m.first_id")))
    texts = mine.select("m.key", "d.text", "m.copies").dropDuplicates(["key"])
    checked = staged(verified(texts, members.select("key", "comp", "size"), threshold), "verified")
    classes = components(checked.where("a is not null").select("a", "b"), "class")
    links = checked.where("key is not null").groupBy("key").agg(F.sum("links").alias("links"))
    info = (groups.select("key", "copies", "first_id").join(classes, "key", "left").join(links, "key", "left")
            .withColumn("comp", F.coalesce("comp", "key")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1))
    info = staged(info, "class-texts")
    heads = info.groupBy("comp").agg(F.min(F.struct(F.col("first_id").isNull().alias("z"), "first_id", "key")).alias("h"), F.sum("copies").alias("class_docs"))
    info = staged(info.join(heads, "comp").select("key", "copies", "links", "first_id", "class_docs", F.col("h.first_id").alias("class_id"), (F.col("h.key") == F.col("key")).alias("head")), "classes")
    total = info.agg(F.sum("copies")).first()[0] or 0
    rows = docs.select("doc_id", F.md5("text").alias("key"))
    full = rows.where("key is not null")
    out = spread_join(full, info, "key", "copies", total)
    first = F.col("head") & F.col("doc_id").eqNullSafe(F.col("first_id"))
    out = out.select("doc_id", "key", "class_id", F.col("links").alias("n_links"), "class_docs", first.alias("is_first"))
    none = rows.where("key is null").select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                            F.lit(1).cast("long").alias("class_docs"), F.lit(True).alias("is_first"))
    return out.unionByName(none)


def first_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, all columns."""
    rows = staged(similarity_classes(docs, threshold), "class-rows")
    gone = rows.where("not is_first").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    tagged = docs.withColumn("__key", F.md5("text"))
    out = tagged.join(gone, tagged["doc_id"].eqNullSafe(gone["_id"]) & (tagged["__key"] == gone["_key"]), "left_anti")
    if not rows.where("is_first and key is not null").groupBy("doc_id", "key").count().where("count > 1").isEmpty():
        # rows that repeat id and text: one of them
        some = out.where("__key is not null").dropDuplicates(["doc_id", "__key"])
        out = some.unionByName(out.where("__key is null"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents")).drop("key")
