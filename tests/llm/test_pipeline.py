"""The pipeline, stage by stage, against brute force over each stage's input."""

import collections
import re

import pytest

import corpus_pipeline as cp
from instalytics.llm import language_id, mixing
from instalytics.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, f in cp.STAGES:
        before, docs = docs, staged(f(spark, docs, SF), name)
        out.append((name, before, docs))
    return out


def _rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(spark, stages):
    assert [s[0] for s in stages] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.exceptAll(before).count() == 0
    assert cp.run(spark, SF).exceptAll(stages[-1][2]).count() == 0


def test_language_stage_drops_only_rejects(stages):
    _, before, after = stages[0]
    out = language_id.classify(before, language_id.fit(language_id.training_rows(before)))
    keep = {r.doc_id for r in out.collect() if r.lang_pred != "und" and not r.ambiguous}
    assert set(_rows(after)) == keep and len(keep) >= 0.99 * before.count()


def test_near_duplicate_stage_keeps_one_of_each_class(stages):
    from test_methods import _links

    _, before, after = stages[1]
    texts = {d: r.text for d, r in _rows(before).items()}
    links, seen, want = _links(texts), set(), set()
    for d in sorted(texts):
        if d not in seen:
            want.add(d)
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += links[x]
    assert set(_rows(after)) == want


def test_decontamination_stage(spark, stages):
    _, before, after = stages[2]

    def words(t):
        t = t.translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    wins = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words(r.text or "")
        wins |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12)) if w}
    sizes = {len(w) for w in wins}
    keep = set()
    for d, r in _rows(before).items():
        w, hit = words(r.text), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            keep.add(d)
    assert set(_rows(after)) == keep


def test_mixing_stage_keeps_all_in_slot_order(spark):
    rows = [(i, f"text {i}", "a" if i < 700 else "b" if i < 900 else "c") for i in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r.doc_id for r in cp.mix_sources(spark, d, SF).collect()]
    plan = {r.doc_id: (r.slot, r.place) for r in mixing.mix(d, mixing.WHOLE).collect()}
    assert got == sorted(plan, key=plan.get) and sorted(got) == list(range(1000))
    assert len({plan[i][0] for i in got}) == 17  # blocks of 64: 11 + 4 + 2


def test_sharding_stage(stages):
    _, before, after = stages[4]
    got, texts = _rows(after), {d: r.text for d, r in _rows(before).items()}
    assert set(got) == set(texts) and all(r.size == len(texts[d].encode()) + 16 for d, r in got.items())
    slots = collections.defaultdict(list)
    for r in got.values():
        slots[r.shard].append(r.slot)
    assert all(0 <= k < 40 for k in slots) and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_slots_of_a_shard_follow_the_schedule(spark, stages, monkeypatch):
    """Each shard's slots are in the order of the schedule, so another schedule gives other slots."""
    _, before, after = stages[4]
    want = {r.doc_id: (r.slot, r.place) for r in mixing.mix(before, mixing.WHOLE).collect()}
    by_shard = collections.defaultdict(list)
    for r in after.collect():
        by_shard[r.shard].append((r.slot, want[r.doc_id]))
    for rows in by_shard.values():
        order = [w for _, w in sorted(rows)]
        assert order == sorted(order)
    docs = stages[3][1]
    monkeypatch.setattr(cp.mixing, "mixture", lambda d: d.orderBy("doc_id"))
    other = cp.shard(spark, staged(cp.mix_sources(spark, docs, SF), "other"), SF)
    assert {(r.doc_id, r.shard) for r in other.collect()} == {(r.doc_id, r.shard) for r in after.collect()}
    assert {(r.doc_id, r.slot) for r in other.collect()} != {(r.doc_id, r.slot) for r in after.collect()}
