"""URL filters, ranked search and the filter audit against brute force."""

import itertools
import math
import random
import re

import pytest

from instalytics.llm import filter_audit, ranked_search, url_filter

SF = "/root/testdata/sf0.001"


def _rule_of(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def _split(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_urls_against_every_rule(spark, partitions):
    rnd = random.Random(4)
    hosts = ["org", "b.org", "a.b.org", "xb.org", "com", "A.Com", "", "b.org.", ".org", "org.b", "org:80", "é.org"]
    pieces = ["", "/", "/a", "/ab", "/a/", "/a/b", "/é", "//", "/a?x=/a/b", "/ab#/", "?q", "#f", "/\U0010ffff", "/A"]
    urls = [None, "", "no scheme/", "://", "x://y://b.org/a"] + [f"http://{rnd.choice(hosts)}{rnd.choice(pieces)}{rnd.choice(pieces)}" for _ in range(600)]
    urls += ["https://a.b.org/a/b"] * 300  # a third of the rows
    rules = list({(h.lower(), p): (h.lower(), p, rnd.choice(["allow", "block"])) for h in hosts for p in rnd.sample(["", "/", "/a", "/ab", "/a/", "/a/b", "/é", "/\U0010ffff"], 5)}.values())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        r = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = {x.page_id: tuple(x)[1:] for x in url_filter.judge(d, r).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = _split(u)
        assert got[i] == (host, path, *_rule_of(host, path, rules)), u


def test_url_edge_cases(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "http://a.org/", "y"), (2, "http://" + "a." * 3000 + "org/" + "p" * 100_000, None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS path", "3 AS rule", "4 AS _rid", "5 AS _row")
    rules = url_filter.rule_table(spark, url_filter.RULES)
    got = sorted(map(tuple, url_filter.judge(d, rules).select("page_id", "rule", "verdict").collect()), key=str)
    assert got == sorted([(1, None, "allow"), (1, None, "allow"), (None, "org/", "allow"), (2, "org/", "allow")], key=str)
    assert url_filter.judge(d.where("false"), rules).count() == 0
    assert [r.verdict for r in url_filter.judge(d, rules.where("false"), default="block").collect()] == ["block"] * 4
    both = spark.createDataFrame([("ORG", "/", "allow"), ("org", "/", "block"), (None, None, "block"), ("", "", "block")], rules.schema)
    assert {r.verdict for r in url_filter.judge(d.where("page_id = 2"), both).collect()} == {"block"}


def _score(docs, queries, k):
    term = re.compile("[0-9a-z\x80-\U0010ffff]+")
    words = [term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in docs]
    n, total = sum(1 for w in words if w), sum(map(len, words))
    df = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in queries:
        q = set(term.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for (i, _), w in zip(docs, words, strict=True):
            s = 0
            for t in q & set(w):
                m = 50 + (50 * len(w) * n) // total
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m))
            if s > 0:
                scored.append((-s, math.inf if i is None else i))
        out += [(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("batch_terms", [200_000, 40])
def test_search_against_all_scores(spark, batch_terms):
    rnd = random.Random(8)
    vocabulary = [f"W{i}x" for i in range(300)] + ["é", "Ünter", "1", "日本"]
    docs = [(i, " ".join(rnd.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=rnd.choice([1, 5, 30, 200, 900])))) for i in range(300)]
    docs += [(1000, docs[5][1]), (1001, docs[5][1]), (5, docs[5][1]), (None, docs[5][1]), (None, None), (1002, ""), (1003, " -- "), (1004, "W7x " * 3000)]
    queries = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 20, 80])))) for i in range(30)]
    queries += [(2, "W5x"), (None, "W7x é"), (90, None), (91, ""), (92, "unknown words"), (93, docs[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS score", "3 AS terms", "4 AS rank").repartition(5)
    q = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS n")
    got = sorted(map(tuple, ranked_search.search(d, q, k=10, batch_terms=batch_terms).collect()), key=str)
    assert got == _score(docs, queries, 10)
    assert ranked_search.search(d.where("false"), q).count() == 0
    assert ranked_search.search(d, q.where("false")).count() == 0


def test_sketch_bounds_are_never_below_the_score():
    import numpy as np

    rnd = random.Random(2)
    for size in (1, 7, 60, 900):
        terms = [f"t{i}".encode() for i in rnd.sample(range(5000), size)]
        counts = np.array([rnd.choice([1, 1, 2, 9, 254, 255, 4000]) for _ in terms], np.int64)
        rows = [{"_rid": i, "terms": [{"term": t, "df": rnd.randint(1, 99)} for t in rnd.sample(terms, min(size, 40)) + [f"o{i}{j}".encode() for j in range(20)]]} for i in range(9)]
        batch = ranked_search.Batch(rows, 100)
        sketch = ranked_search.fold(ranked_search.hashes(terms), counts)
        for m in (50, 75, 90_000):
            upper, exact = batch.bounds(sketch, m), batch.exact(terms, counts, m)
            assert (upper >= exact).all()
            if counts.max() < 255:
                assert upper.sum() <= 1.5 * exact.sum()


def test_search_skips_documents_below_the_threshold(spark, monkeypatch):
    """Only documents whose bound reaches the threshold are scored exactly."""
    import numpy as np

    docs = [({"doc_id": i, "n": 40, "terms": [f"c{i}_{j}".encode() for j in range(39)] + [b"rare" if i < 10 else b"often"]}) for i in range(400)]
    rows = [{"_rid": 0, "terms": [{"term": b"rare", "df": 10}, {"term": b"often", "df": 390}]}]
    batch = ranked_search.Batch(rows, 400)
    reach = 0
    scores = sorted((batch.exact(d["terms"], np.ones(40, np.int64), 100)[0] for d in docs), reverse=True)
    for d in docs:
        reach += batch.bounds(ranked_search.fold(ranked_search.hashes(d["terms"]), np.ones(40, np.int64)), 100)[0] >= scores[9]
    assert reach < 60


def _audit(docs, labels):
    masks = []
    for i, t, s in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        capitals = len(re.findall("[A-Z]", t))
        twin = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        fails = {f for f, x in zip("ABCDE", [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * capitals > 5 * len(t), re.search(r"[#$%&*|]", t), twin], strict=True) if x}
        mine = [r for r in labels if i is not None and r[0] == i]
        masks.append((s or "", fails, any(r[1] == 1 for r in mine), any(r[2] == 1 for r in mine)))
    out, removed = {}, {}
    for part in {m[0] for m in masks}:
        rows = [m for m in masks if m[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                failing = [m for m in rows if f in m[1]]
                out[part, "".join(order), step + 1] = [len(left), len(gone), len(failing) - len(gone), sum(m[1] == {f} for m in rows), sum(m[2] for m in gone), sum(m[3] for m in gone)]
                removed[part, f] = removed.get((part, f), 0) + len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_every_order(spark):
    rnd = random.Random(6)
    texts = [None, "", "ABC DEF #1", " ".join(f"w{i}" for i in range(80)), " ".join(f"W{i}" for i in range(80)), "same words " * 40, "é\u2003x $ " * 30,
             " ".join(f"v{i % 60}" for i in range(9000))]
    docs = [(i, rnd.choice([*texts, f"{rnd.choice(texts)} {i}"]), rnd.choice(["a", "b", None, ""])) for i in range(300)]
    docs += [docs[3], docs[3], (7, docs[9][1], "a"), (None, texts[3], "b"), (None, texts[3], None), (None, None, None)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in rnd.sample(range(300), 150)] + [(5, 0, 0), (5, 1, 1), (None, 1, 1), (9999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "2 AS _mask", "'x' AS quality", "4 AS n")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS source", "2 AS part", "3 AS _mask")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(d, lab).collect()}
    assert got == _audit(docs, labels)
    assert filter_audit.audit(d.where("false"), lab).count() == 0
    assert filter_audit.audit(d, lab.where("false")).where("good_lost + toxic_lost > 0").count() == 0


def test_sketch_clears_unique_texts_and_no_other(spark):
    rows = [(i, f"text {i}", "s") for i in range(6000)] + [(10_000 + i, f"text {i}", "s") for i in range(0, 6000, 50)]
    d = filter_audit._hashed(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    blocks = 3
    left = {r.text for r in filter_audit.possible_repeats(d, filter_audit.once_counted(d, blocks), blocks).collect()}
    twice = {f"text {i}" for i in range(0, 6000, 50)}
    assert twice <= left and len(left - twice) < 60
