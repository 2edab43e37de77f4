"""Nulls in any column, empty and long texts, repeated rows, empty tables and
extra columns with clashing names, through every operator."""

import pytest

from instalytics.llm import (decontaminate, html_extract, language_id, line_dedup, lm_scoring, mixing, ngram_join, quality_rules, sharding, token_output)
from instalytics.llm.common import shared_path

LONG = " ".join(f"w{i % 977}x" for i in range(60_000))
TEXTS = [None, "", "   \n\t ", "one", "the same text of a few words here", "the same text of a few words here", LONG,
         "línea uno é\nlínea uno é\n" * 30, "!!! ### 123", "a" * 50_000]
# names that the operators use inside, of other types than there
EXTRA = ", 'x' AS key, 'x' AS n, 'x' AS sig, 'x' AS node, 'x' AS shard, 'x' AS slot, 'x' AS words, 'x' AS _src, 'x' AS lang_pred, 'x' AS block, 'x' AS grp"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i % 4 == 0 else f"s{i % 3}", 0 if t is None else len(t)) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "text without an id", "en", "s1", None), (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").createOrReplaceTempView("edge_docs")
    return spark.sql(f"SELECT *{EXTRA} FROM edge_docs").cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def _bench(spark):
    return spark.createDataFrame([(1, "the same text of a few words here"), (None, "w1x w2x w3x"), (2, None), (3, ""), (2, None)], "item_id long, text string")


def _write(spark, d):
    import public_tokenizers

    files = token_output.write_ids(d, public_tokenizers.path("byte_bpe_50k.json"), shared_path(spark, "edge-ids"))
    return token_output.read_ids(files)


OPS = {
    "mix": lambda s, d: mixing.mix(d),
    "quality": lambda s, d: quality_rules.apply_rules(d),
    "lines": lambda s, d: line_dedup.remove_lines(d, min_sites=2),
    "classes": lambda s, d: ngram_join.similarity_classes(d),
    "shards": lambda s, d: sharding.shard_documents(d, 4),
    "ids": _write,
    "lm": lambda s, d: lm_scoring.lm_scores(d, d.where("doc_id is null or doc_id <> 6"))[0],
    "language": lambda s, d: language_id.classify(d, language_id.fit(d)),
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, _bench(s)),
    "html": lambda s, d: html_extract.extract_pages(d.selectExpr("doc_id AS page_id", "source AS url", "text AS html", "key", "n")),
}


@pytest.mark.parametrize("name", OPS)
def test_a_row_for_each_row(spark, docs, name):
    rows = OPS[name](spark, docs).collect()
    assert len(rows) == docs.count()
    ids = [r[0] for r in rows] if name == "html" else [r.doc_id for r in rows]
    assert sorted(ids, key=str) == sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str)


@pytest.mark.parametrize("name", OPS)
def test_an_empty_table_gives_an_empty_result(spark, empty, name):
    assert OPS[name](spark, empty).collect() == []


def test_defined_results(spark, docs):
    q = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    assert q[0].n_words == q[1].n_words == q[2].n_words == 0 and q[0].base_failed and not q[0].kept
    assert q[7].n_dup_lines == 59 and q[7].base_failed
    # what holds no failed line stays as it is, blank lines too
    assert q[0].clean_text == q[1].clean_text == "" and q[2].clean_text == TEXTS[2] and q[7].clean_text == TEXTS[7] and q[8].clean_text == ""
    lang = {r.doc_id: r for r in language_id.classify(docs, language_id.fit(docs)).collect()}
    assert [lang[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and lang[0].score == 0 and lang[3].lang_pred == "en"
    c = {r.doc_id: r for r in ngram_join.similarity_classes(docs).collect()}
    assert c[0].n_links == 0 and c[5].class_id == 4 and c[4].n_links == 3 and c[5].n_links == 3 and c[3].class_id == 3
    d = {r.doc_id: r for r in decontaminate.decontaminate(docs, _bench(spark)).collect()}
    assert d[4].contaminated and d[4].n_hit == 8 and d[6].n_hit >= 3 and d[0].n_words == 0 and not d[0].contaminated


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_take_the_same_rows(spark, docs, empty, stage, tmp_path):
    import corpus_pipeline

    _bench(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, docs, str(tmp_path))
    if stage < 4:
        assert out.columns == docs.columns
    assert 0 < out.count() <= docs.count()
    assert f(spark, empty, str(tmp_path)).count() == 0


def test_cleaned_text_in_four_languages(spark):
    keep = "A plain line of text that stays.\n\n  \nUna línea que queda.\nEine Zeile, die bleibt."
    gone = ["Read more", "Tous droits réservés.", "Leer más", "Datenschutzerklärung", "HOME NEWS SPORT NOW", "a | b | c", "Wir verwenden Cookies", "#### $$$$"]
    stay = ["spread moreover", "unanmeldenden Wort", "tout droits réservés"]
    rows = [(1, keep), (2, "\n".join([gone[0], *keep.split("\n"), *gone[1:], *stay])), (3, "\n".join(gone)), (4, "\n".join(gone * 2000))]
    q = {r.doc_id: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert q[1].clean_text == keep and q[1].n_failed_lines == 0
    assert q[2].clean_text == "\n".join([keep, *stay]) and q[2].n_failed_lines == len(gone)
    assert q[3].clean_text == "" and q[4].clean_text == "" and q[4].n_failed_lines == 2000 * len(gone)
    own = quality_rules.apply_rules(spark.createDataFrame([(1, "Klikk her\nread more")], "doc_id long, text string"), menu_phrases=("klikk her",), notice_phrases=())
    assert own.first().clean_text == "read more"
