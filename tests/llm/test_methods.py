"""Each operator against brute force, an exact round trip, held-out accuracy
or its oracle SQL."""

import collections
import math
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from instalytics.llm import decontaminate, html_extract, language_id, lm_scoring, mixing, ngram_join, range_coder, registry, sharding, token_output
from instalytics.llm.common import shared_path
from instalytics.oracle.compare import compare, duckdb_conn

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", registry.ORACLE_SQL)
def test_matches_its_oracle(spark, name):
    con = duckdb_conn(SF)
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    r = compare(registry.QUERIES[name](spark, SF), con, registry.ORACLE_SQL[name])
    assert r["columns_match"] and r["types_match"] and r["values_match"], r


def test_schedule_keeps_every_prefix_within_a_block(spark):
    sizes = {"a": 5000, "b": 700, "c": 690, "d": 40}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    d = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.mix(d, cap=(1, 2), block_rows=4, resolution=100).toPandas()
    assert len(out) == len(rows) and out[out.source == "a"].in_mixture.sum() == 1430
    blocks = out.drop_duplicates(["source", "block"])
    assert not blocks.slot.duplicated().any() and (blocks.release <= blocks.slot).all() and (blocks.slot < blocks.deadline).all()
    weight = dict(zip(blocks.source, blocks.weight, strict=True))
    assert abs(sum(weight.values()) - 1) < 1e-9
    live = min(blocks.groupby("source").slot.max())
    seen = collections.Counter()
    for t, s in sorted(zip(blocks.slot, blocks.source, strict=True)):
        if t > live:
            break
        seen[s] += 1
        assert all(abs(seen[k] - weight[k] * (t + 1)) < 1 for k in sizes)


def _in_order(rows):
    return [r.source for r in sorted((r for r in rows if r.in_mixture), key=lambda r: (r.slot, r.place))]


def test_given_weights_stop_at_the_first_source_that_runs_out(spark):
    sizes = {"a": 600, "b": 90, "c": 500, None: 40}
    d = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    rows = mixing.mix(d, block_rows=1, resolution=100, weights={"a": 2, "b": 1, None: 1}).collect()
    assert len(rows) == 1230
    kept = collections.Counter(r.source for r in rows if r.in_mixture)
    assert kept == {"a": 80, "b": 40, None: 40}
    assert {(r.weight, r.slot) for r in rows if r.source == "c"} == {(0.0, None)}
    seen = collections.Counter()
    for t, s in enumerate(_in_order(rows)):
        seen[s] += 1
        assert all(abs(seen[k] - w * (t + 1)) < 1 for k, w in (("a", 0.5), ("b", 0.25), (None, 0.25)))
    assert not any(r.in_mixture for r in mixing.mix(d, weights={"a": 1, "unknown": 1}).collect())
    with pytest.raises(ValueError, match="positive"):
        mixing.mix(d, weights={"a": 0})


def test_given_weights_repeat_sources_that_run_out(spark):
    sizes = {"a": 300, "b": 30, "c": 7}
    d = spark.createDataFrame([(1000 * j + i, s) for j, (s, n) in enumerate(sizes.items()) for i in range(n)], "doc_id long, source string")
    rows = [r for r in mixing.mix(d, block_rows=1, resolution=100, weights={"a": 0.5, "b": 0.4, "c": 0.1}, repeat=True).collect() if r.in_mixture]
    times = collections.Counter(r.doc_id for r in rows)
    of = collections.Counter(r.source for r in rows)
    assert of == {"a": 300, "b": 240, "c": 60} and set(times) == {r.doc_id for r in d.collect()}
    for s, n in sizes.items():
        mine = [times[r.doc_id] for r in d.where(f"source = '{s}'").collect()]
        assert max(mine) - min(mine) <= 1 and sum(mine) == of[s]
    assert {(r.doc_id, r.epoch) for r in rows} == {(i, e) for i, n in times.items() for e in range(n)}
    docs = d.selectExpr("*", "'t' AS text")
    assert collections.Counter(r.source for r in mixing.mixture(docs, weights={"a": 0.5, "b": 0.4, "c": 0.1}, repeat=True).collect()) == of


def _links(texts):
    sets = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids, links = sorted(sets), collections.defaultdict(set)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if texts[a] == texts[b] or (both and both >= 0.8 * len(sets[a] | sets[b])):
                links[a].add(b)
                links[b].add(a)
    return links


def test_similarity_classes_equal_brute_force(spark, texts):
    base = " ".join(f"word{i}" for i in range(200)).split()
    some = dict(list(texts.items())[:80])
    for k in range(40):  # near copies: each differs from the base in a few places
        w = list(base)
        for j in range(k % 5):
            w[(k * 7 + j * 31) % 200] = f"other{k}"
        some[10_000 + k] = " ".join(w)
    d = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join.similarity_classes(d).collect()}
    links = _links(some)
    root = {}
    for d0 in sorted(some):
        if d0 not in root:
            todo = [d0]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = d0
                    todo += links[x]
    assert {k: r.class_id for k, r in got.items()} == root
    assert {k: r.n_links for k, r in got.items()} == {k: len(links[k]) for k in some}
    firsts = [r.doc_id for r in got.values() if r.is_first]
    assert sorted(firsts) == sorted(set(root.values()))


def test_large_buckets_are_split_without_losing_a_pair(spark):
    base = [f"word{i}" for i in range(120)]
    rows = [(k, " ".join([*base[:60], f"x{k}", *base[60:]])) for k in range(60)]
    sigs = ngram_join.embed(spark.createDataFrame(rows, "doc_id long, text string")).select("key", "sig")
    got = ngram_join.buckets(sigs, leaf=8, levels=2).collect()
    members = collections.defaultdict(set)
    for r in got:
        members[r.node].add(r.key)
    assert max(map(len, members.values())) < 60
    met = {(a, b) for m in members.values() for a in m for b in m if a < b}
    assert len(met) == 60 * 59 // 2


def _parts(n, pairs):
    part = list(range(n))
    for i, j in pairs:
        part = [part[i] if p == part[j] else p for p in part]
    return {frozenset(i for i in range(n) if part[i] == p) for p in part}


@pytest.mark.parametrize("sizes", [{}, {"BLOCK": 4, "GRID": 3, "WIDEST": 8}, {"BLOCK_BYTES": 900}])
def test_links_between_blocks_of_a_component(spark, monkeypatch, sizes):
    """Links and classes of one component do not depend on how it is cut into blocks."""
    for k, n in sizes.items():
        monkeypatch.setattr(ngram_join, k, n)
    base = [f"t{i}" for i in range(60)]
    # each text differs from the base in a few words at the end or at the start
    texts = [" ".join(base[i % 7 :] + [f"x{i % 3}"] * (i % 5)) for i in range(40)] + ["", "alone here"]
    keys = [f"k{i:02d}" for i in range(len(texts))]
    copies = [1 + i % 3 for i in range(len(texts))]
    sets = [{tuple(t.split()[j : j + 5]) for j in range(max(1, len(t.split()) - 4))} if t else set() for t in texts]
    linked = lambda i, j: i != j and bool(sets[i] & sets[j]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    want = {keys[i]: sum(copies[j] for j in range(len(keys)) if linked(i, j)) for i in range(len(keys)) if texts[i]}
    rows = spark.createDataFrame([(k, t, c) for k, t, c in zip(keys, texts, copies, strict=True) if t], "key string, text string, copies long")
    comps = rows.select("key", F.lit("c").alias("comp"), F.octet_length("text").cast("long").alias("size"))
    got = ngram_join.verified(rows, comps, 0.8).cache()
    links = {r["key"]: r["n"] for r in got.where("key is not null").groupBy("key").agg(F.sum("links").alias("n")).collect()}
    assert links == want
    pairs = [(keys.index(a), keys.index(b)) for a, b in got.where("a is not null").select("a", "b").collect()]
    every = [(i, j) for i in range(len(keys)) for j in range(i) if linked(i, j)]
    assert _parts(len(keys), pairs) == _parts(len(keys), every)
    assert sum(want.values()) > 300


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    assert sharding.best_fit([7, 6, 3, 2], 10) == [0, 1, 0, 1]
    assert sharding.best_fit([12, 1], 10) == [0, 1]  # larger than any bin: one of its own
    sizes = sorted(np.random.default_rng(1).integers(1, 900, 4000).tolist(), reverse=True)
    bins = sharding.best_fit(sizes, 1000)
    load = collections.Counter()
    for s, b in zip(sizes, bins, strict=True):
        load[b] += s
    assert max(load.values()) <= 1000 and len(load) <= 1.03 * sum(sizes) / 1000 + 2
    into = sharding.pack_into([5000, *sizes], 40)
    load = collections.Counter()
    for s, b in zip([5000, *sizes], into, strict=True):
        load[b] += s
    assert set(load) == set(range(40)) and max(load.values()) - min(load.values()) <= 0.01 * max(load.values())


def test_shards_are_near_equal_gapless_and_keep_groups(spark, texts):
    rows = [(d, t) for d, t in texts.items()] + [(1000 + i, "one hot text") for i in range(100)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5).toPandas()
    load = out.groupby("shard")["size"].sum()
    assert len(out) == len(rows) and set(load.index) == set(range(5)) and load.max() - load.min() < 0.02 * load.mean()
    assert out.groupby("grp").shard.nunique().max() == 1
    for _, s in out.groupby("shard").slot:
        assert sorted(s) == list(range(len(s)))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=300), st.integers(1, 60))
def test_range_coder_round_trip(ids, block):
    a = np.array(ids, np.int64)
    assert (range_coder.decode(range_coder.encode(a, block, lanes=4), lanes=3) == a).all()


def test_range_coder_learns_and_finds_damage():
    a = np.tile(np.arange(50), 200)
    blocks = range_coder.encode(a)
    assert sum(len(b[2]) for b in blocks) < len(a) // 3
    n, crc, data = blocks[1]
    with pytest.raises(ValueError, match="block 1"):
        range_coder.decode([blocks[0], (n, crc, bytes([data[0] ^ 1]) + data[1:]), *blocks[2:]])


def test_ids_of_whole_texts_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    more = dict(texts) | {-1: "it's  two  spaces\n\n and\ttabs <|endoftext|> 12x", 5000: None, 5001: "a <|endoftext|> b",
                          5002: "<|endoftext|>", 5003: "one<|endoftext|>two words <|endoftext|>  x", 5004: "< |endoftext| >", 5005: ""}
    files = token_output.write_ids(spark.createDataFrame(list(more.items()), "doc_id long, text string"), path, shared_path(spark, "test-ids"), 1 << 17)
    assert files.count() > 1
    got = {r.doc_id: r for r in token_output.read_ids(files).collect()}
    start = 0
    for d in sorted(more):
        ids = np.array([*t.encode(more[d] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_scores_equal_brute_force_and_beat_the_base(spark):
    sf = SF.replace("0.001", "0.01")
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    out = lm_scoring.op7_lm_scoring(spark, sf).toPandas().set_index("doc_id")
    tokens = {d: [*t.encode().lower().split(), b"\n"] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    c = collections.Counter(w for d, t in tokens.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    for d, t in tokens.items():
        r = out.loc[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
    h = out[out.held_out]
    assert h.score.sum() > 0.99 * h.base_score.sum()


def test_model_is_a_distribution_and_does_not_depend_on_neighbours():
    from instalytics.llm import recurrent_lm as lm

    counts = {f"w{i}".encode(): 900 - i for i in range(800)} | {lm.END: 50}
    ends = collections.defaultdict(lambda: [0, 0])
    for w, k in counts.items():
        ends[w[-2:]][0] += k
        ends[w[-2:]][1] += 1
    v = lm.Vocabulary(counts, {s: tuple(x) for s, x in ends.items()}, sum(counts.values()), len(counts))
    p = lm.fresh(v)
    words = [*v.place, b"unknown"]
    one = [v.encode([b"w3", w]) for w in words]
    ln = lm.score(v, p, [x[0] for x in one], [x[1] for x in one]) - lm.score(v, p, [one[0][0][:1]], [one[0][1][:1]])[0]
    tail = sum(0.5 / v.tail_total[k] * q for k, q in _class_shares(v, p).items())  # the unknown of each tail class
    assert abs(np.exp(ln[:-1]).sum() + tail - 1) < 1e-3
    texts = [v.encode([b"w%d" % ((i * j) % 800) for j in range(3 + 40 * (i % 4))]) for i in range(1, 30)]
    together = lm.score(v, p, [x[0] for x in texts], [x[1] for x in texts])
    alone = [lm.score(v, p, [x[0]], [x[1]])[0] for x in texts]
    assert np.allclose(together, alone, rtol=1e-4)


def test_backpropagation_follows_the_numerical_gradient():
    """The first step of a pass moves each weight against the gradient of the
    texts' log probability, as differences of the scores give it."""
    from instalytics.llm import recurrent_lm as lm

    counts = {f"w{i}".encode(): 40 - i for i in range(30)} | {lm.END: 50}
    ends = collections.defaultdict(lambda: [0, 0])
    for w, k in counts.items():
        ends[w[-2:]][0] += k
        ends[w[-2:]][1] += 1
    v = lm.Vocabulary(counts, {s: tuple(x) for s, x in ends.items()}, sum(counts.values()), len(counts))
    p = lm.fresh(v)
    texts = [v.encode([b"w%d" % ((3 * i + j * j) % 30) for j in range(min(lm.STEPS, 12) - 2)] + [b"other", lm.END]) for i in range(6)]
    places, classes = [x[0] for x in texts], [x[1] for x in texts]
    after = lm.train(v, p, places, classes, rate=1e-3)[0]
    checked = 0
    for name in ("U", "E", "Wc", "Wk", "bc", "bk"):
        moved = (after[name] - p[name]).ravel()
        # the entries that differences of 32-bit scores can tell: a few of the used ones
        at = np.random.default_rng(5).choice(np.flatnonzero(moved), min(60, np.count_nonzero(moved)), replace=False)
        for i in at:
            side = []
            for step in (0.05, -0.05):
                q = {k: a.copy() for k, a in p.items()}
                q[name].ravel()[i] += step
                side.append(lm.score(v, q, places, classes).sum())
            slope = (side[0] - side[1]) / 0.1
            if abs(slope) > 0.02:
                assert np.sign(slope) == np.sign(moved[i]), (name, i, slope, moved[i])
                checked += 1
    assert checked > 100


def test_dictionary_takes_a_share_of_the_words_that_tie(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "DICTIONARY", 300)
    d = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(2000))), (2, "often often"), (3, "often two two")], "doc_id long, text string")
    v = lm_scoring.vocabulary(lm_scoring.token_counts(d))
    assert 200 < len(v.counts) <= 300 and v.counts[b"often"] == 3 and v.types == 2003
    same = lm_scoring.vocabulary(lm_scoring.token_counts(d.where("doc_id = 1")))
    assert 200 < len(same.counts) <= 300


def test_the_model_learns_from_every_training_document(spark):
    from instalytics.llm import recurrent_lm as lm

    d = spark.createDataFrame([(None if i == 3 else i, "one two three " * 20 + str(i)) for i in range(4)], "doc_id long, text string").cache()
    v = lm_scoring.vocabulary(lm_scoring.token_counts(d))
    for i in range(4):
        weights = lm_scoring.train(d.where(f"text LIKE '% {i}'"), v)
        assert not np.array_equal(weights["U"], lm.fresh(v)["U"]), i


def _class_shares(v, p):
    from instalytics.llm import recurrent_lm as lm

    at, cls, _ = v.encode([b"w3"])
    h = lm._step(p, v.inputs(at, cls), np.zeros((1, lm.H), np.float32))[0]
    q = lm._softmax(h @ p["Wc"] + p["bc"])[0]
    return {k: q[k] for k in range(lm.HEAD // lm.WIDE, v.classes)}


def test_language_accuracy_on_held_out(spark):
    sf = SF.replace("0.001", "0.01")
    out = language_id.op8_language_id(spark, sf).toPandas()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    held = out[out.held_out]
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97 and held.score.between(0, 1).all()


def test_gram_sums_equal_a_plain_count(monkeypatch):
    monkeypatch.setattr(language_id, "CHUNK", 64)  # texts across chunks
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(32, 120, n).astype(np.uint8)) for n in (0, 1, 2, 3, 200, 0, 63, 64, 65, 5)]
    w = rng.integers(-9, 9, (language_id.DIM + 1, 3)).astype(np.int32)
    w[-1] = 0
    off = np.cumsum([0] + [len(t) for t in texts])
    sums, n = language_id.gram_sums(np.frombuffer(b"".join(texts), np.uint8), off, w)
    for i, t in enumerate(texts):
        want = w[language_id._grams(np.frombuffer(t, np.uint8))].sum(0) if len(t) >= 3 else np.zeros(3)
        assert (sums[i] == want).all() and n[i] == max(len(t) - 2, 0)


def test_codewords_differ():
    for n in (2, 4, 7, 30):
        m = language_id.codewords(n)
        assert min((m[i] != m[j]).sum() for i in range(n) for j in range(i)) >= max(1, m.shape[1] // 4)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a>Menu one</a></nav>
<div class="cookie-notice">We use cookies, many of them.</div><div class="sidebar"><p>Side text, with marks. And more.</p></div>
<main><h1>Head &amp; line</h1><p>First   paragraph, with <b>bold</b> text.
It goes on, and on.<p>Second &#8212; here; and there.</p><ul><li>Point one.<li>Point two.</ul>
<form>Name <input></form><script>var a = "<p>no</p>";</script><p>Short</p></main>
<div id="comments"><p>A reader's comment, quite long, with marks, and more. Yes, it is.</p></div><footer>&copy; all</footer></body></html>"""


def test_extracts_the_article_alone():
    assert html_extract.extract(PAGE) == "\n".join(
        ["Head & line", "First paragraph, with bold text. It goes on, and on.", "Second — here; and there.", "Point one.", "Point two.", "Short"])
    assert html_extract.extract(PAGE.replace("<main>", '<div class="body">').replace("</main>", "</div>")) == html_extract.extract(PAGE)


def test_extracts_all_selected_nodes():
    lead, body = "The lead, in short.", "A sentence, of the body; with marks. " * 6
    page = f"<body><div><div class=lead><p>{lead}</p></div><div class=body><p>{body}</p><p>{body}</p></div></div></body>"
    text = "\n".join([lead, body.strip(), body.strip()])
    assert html_extract.extract(page) == text
    # a list of the article stays whole, in an article and in a named div
    items = [f"item {i} of the list without marks" for i in range(30)]
    listed = f"<p>{body}</p><ul>{''.join(f'<li>{x}' for x in items)}</ul><p>{body}</p>"
    for around in ("<article>{}</article>", "<div class=post>{}</div>"):
        assert html_extract.extract(f"<body>{around.format(listed)}</body>") == "\n".join([body.strip(), *items, body.strip()])
    # a long list of links is not the article's for lying in it; its ends are smoothed with their neighbours
    links = "<div><ul>" + "<li><a>Another page of this site</a>" * 40 + "</ul></div>"
    got = html_extract.extract(f"<article><div><p>{body}</p></div>{links}<div><p>{body}</p></div></article>").split("\n")
    assert got[0] == got[-1] == body.strip() and len(got) <= 4


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "with-sidebar", "no-sidebar", "has-banner"])
def test_a_name_or_form_does_not_hide_the_content(name):
    body = "A sentence, of the body; with marks. " * 6
    side = "<div class=sidebar><p>Side text, with marks.</p></div>"
    assert html_extract.extract(f"<body><div class={name}><p>{body}</p>{side}</div></body>") == body.strip()
    assert html_extract.extract(f"<body><form><div><p>{body}</p>{side}</div></form></body>") == body.strip()


@pytest.mark.parametrize("page", [
    "<article>{body}<section id=comments>{comments}</section></article>", "<article>{body}</article><div class='comments-area wide'>{comments}</div>",
    "<div><div class=post>{body}</div><div id=comments>{comments}</div></div>", "<main>{body}<ol class=commentlist>{comments}</ol></main>"])
def test_reader_comments_stay_out_however_long(page):
    body = "<p>A sentence, of the body; with marks. It is the article's own, and short.</p>"
    comments = "".join(f"<div class=comment><p>Reader {i} writes, at length, on this and that; and more. {'Well, yes. ' * 30}</p></div>" for i in range(8))
    assert html_extract.extract(f"<body>{page.format(body=body, comments=comments)}</body>") == body[3:-4]


def test_a_name_that_mentions_comments_does_not_hide_the_content():
    body = "A sentence, of the body; with marks. " * 6
    for name in ("post comments-open", "has-comments", "comments"):
        assert html_extract.extract(f"<body><div class='{name}'><p>{body}</p></div></body>") == body.strip()


@pytest.mark.parametrize("piece", ["<font><p>{}</p>", "<div>{}", "<b><i>{}", "<ul><li>{}", "<span>{}</p>", "<table><tr><td>{}"])
def test_unclosed_elements_take_linear_time(piece):
    import time

    def seconds(n):
        page = "<body>" + "".join(piece.format(f"A line, number {i}; with marks. ") for i in range(n))
        t = time.process_time()
        assert html_extract.extract(page).count("with marks") == n
        return time.process_time() - t

    seconds(500)
    assert seconds(25_000) < 25  # about a megabyte


def test_extracts_from_odd_pages():
    assert html_extract.extract(None) == html_extract.extract("") == html_extract.extract("<html><body></body></html>") == ""
    assert html_extract.extract("plain text, no markup") == "plain text, no markup"
    assert html_extract.extract("<body><article><h1>Only</h1>") == "Only"
    assert html_extract.extract("<article><p>cut off &am") == "cut off &am"


def test_extracts_the_given_pages():
    import html
    import re

    for (h,) in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*?)(?:</article>|$)", h, re.S)[1]
        body = re.sub(r"<[a-z/!][^>]*$", "", body)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body))
        assert html_extract.extract(h) == "\n".join(x for x in parts if x)


def test_words_are_those_of_the_ranges_in_a_fraction_of_the_time(spark):
    ranges = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def by_ranges(text):
        return F.regexp_extract_all(F.translate(text, decontaminate.UPPER, decontaminate.LOWER), F.lit(ranges), F.lit(0))

    points = "".join(chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    some = spark.createDataFrame([(points,), ("x".join(points),), (" ".join(points),), ("Ab-ç\n",)], "text string")
    assert some.where(decontaminate.words_of(F.col("text")) == by_ranges(F.col("text"))).count() == 4
    text = F.concat(F.lit("The quick, brown fox's "), F.col("id").cast("string"))
    long = spark.range(300).select(F.repeat(text, 1000).alias("text")).localCheckpoint()

    def seconds(words):
        t = time.time()
        long.agg(F.sum(F.size(words(F.col("text"))))).first()
        return time.time() - t

    new, old = (min(seconds(f) for _ in range(3)) for f in (decontaminate.words_of, by_ranges))
    assert 2 * new < old


def test_texts_encoded_at_once_are_as_their_words_one_by_one():
    from instalytics.llm import recurrent_lm as lm

    texts = [None, "", "  ", "\x0b a\x0cB\r\n", "É Ü X\x1cY \x85z w", "\x00 q\x00", "end \n", "A b a", "zz b qq zz"]
    words = [(t or "").encode().lower().split() + [lm.END] for t in texts]
    counts = collections.Counter(w for x in words for w in x)
    ends = {}
    for w, n in counts.items():
        e = ends.setdefault(w[-2:], (0, 0))
        ends[w[-2:]] = (e[0] + n, e[1] + 1)
    v = lm.Vocabulary({w: counts[w] for w in (lm.END, b"a", b"b", b"q\x00")}, ends, sum(counts.values()), len(counts))
    for some in (pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string()).slice(1)):
        for one, at, cls, lost in zip(words, *v.encode_batch(some), strict=True):
            expected = v.encode(one)
            assert at.tolist() == expected[0].tolist() and cls.tolist() == expected[1].tolist() and lost == expected[2]
        seen = collections.Counter()
        for batch in lm_scoring._count([pa.RecordBatch.from_arrays([some], names=["text"])]):
            seen.update(dict(zip(batch["token"].to_pylist(), batch["n"].to_pylist(), strict=True)))
        assert seen == counts


def test_lookup_is_as_the_words_one_by_one():
    from instalytics.llm import recurrent_lm as lm

    words = [[b"a", b"zz", b"b", b"zz"], [], [b"q"], [b"xa", b"a"]]
    v = lm.Vocabulary({lm.END: 4, b"a": 2, b"b": 1}, {b"\n": (4, 1), b"a": (2, 1), b"b": (1, 1), b"zz": (2, 1), b"q": (1, 1), b"xa": (1, 1)}, 11, 6)
    at, cls, counts, unknown, lost = v.lookup(pa.array([" ".join(w.decode() for w in x) for x in words]))
    expected = [v.encode([*x, lm.END]) for x in words]
    assert at.tolist() == [i for x in expected for i in x[0]] and cls.tolist() == [i for x in expected for i in x[1]]
    assert counts.tolist() == [5, 1, 2, 3] and unknown.to_pylist() == [b"zz", b"zz", b"q", b"xa"] and lost.tolist() == np.flatnonzero(at < 0).tolist()


def test_words_beyond_the_dictionary_count_in_full(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "DICTIONARY", 4)
    texts = {i: " ".join(f"w{(i * j) % 23}" for j in range(i % 40)) + (" new new other" if i % 3 == 0 else "") for i in range(1200)}
    d = spark.createDataFrame([*texts.items(), (1200, None)], "doc_id long, text string").repartition(2)
    out, n = lm_scoring.lm_scores(d, d.where("doc_id % 3 = 1"))
    tokens = {k: [*(t or "").encode().split(), b"\n"] for k, t in [*texts.items(), (1200, None)]}
    c = collections.Counter(w for k, t in tokens.items() if k % 3 == 1 for w in t)
    norm = math.log10(c.total() + 0.5 * (len(c) + 1))
    got = {r.doc_id: r for r in out.collect()}
    assert n == c.total() and len(got) == 1201
    for k, t in tokens.items():
        assert (got[k].n_tokens, got[k].n_known) == (len(t), sum(c[w] > 0 for w in t))
        assert math.isclose(got[k].base_score, sum(math.log10(c[w] + 0.5) - norm for w in t), rel_tol=1e-9)
