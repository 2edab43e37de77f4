"""Line-first quality rules, per document and without any shuffle.

Each line is judged alone. It fails by the symbol rule (too many of
``#*$%&|<>`` among its characters), the capitals rule (three or more words,
shouted), the navigation rule (a list of links: several separators between
few words, or a menu phrase), the punctuation rule (a long line that holds no
sentence end at all) or the boilerplate rule (a phrase of legal notices,
cookie banners and the like). Symbols, capitals, separators and sentence ends
are judged alike in every language; phrases are parameters, with lists for
English, Spanish, French and German. Failed lines are removed, all others stay as
they are, blank ones too; a document is rejected if the failed lines hold more
than ``max_lost`` of its word characters. A text's lines are judged a second time
only if one of them fails, so the cost is in proportion to the text.

The base figures (words, symbols, repeated lines, repeated 8-word windows) are
exact but for the windows, which are compared by a 64-bit hash within the one
text. Null and empty text: all counts 0, base_failed true, kept false. Extra
columns are not read. Equal rows give equal results, one each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# fixed phrases of the line rules, by language, in lower case
MENU = (
    "skip to content", "main menu", "sign in", "log in", "read more", "back to top", "next page", "previous page", "site map",
    "saltar al contenido", "iniciar sesión", "leer más", "volver arriba", "página siguiente", "mapa del sitio",
    "aller au contenu", "se connecter", "lire la suite", "haut de page", "page suivante", "plan du site",
    "zum inhalt springen", "anmelden", "weiterlesen", "nach oben", "nächste seite", "seitenübersicht",
)
NOTICE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "we use cookies",
    "accept cookies", "enable javascript", "subscribe to our newsletter", "unsubscribe", "lorem ipsum",
    "todos los derechos reservados", "política de privacidad", "política de cookies", "utilizamos cookies", "aceptar cookies",
    "tous droits réservés", "politique de confidentialité", "conditions d'utilisation", "nous utilisons des cookies", "accepter les cookies",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "wir verwenden cookies", "cookies akzeptieren",
)


def _any_phrase(phrases: tuple[str, ...]) -> str:
    """Any of the phrases as whole words, for ``rlike`` on lower-cased text."""
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(re.escape(p) for p in phrases) + r")($|[^\p{L}\p{N}_])"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def _word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def line_fails(line: Column, max_symbols: float = 0.1, menu_phrases: tuple[str, ...] = MENU) -> Column:
    """True where a line with a word fails a rule (but for the boilerplate
    rule); the cheap tests come first."""
    words = F.regexp_count(line, F.lit(WORD_GAP)) + 1
    symbols = line.rlike("[#*$%&|<>]") & (F.regexp_count(line, F.lit("[#*$%&|<>]")) > F.lit(max_symbols) * F.length(line))
    shouted = ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}\p{Lu}") & (words >= 3)
    marks = F.regexp_count(line, F.lit("[|>»·•]"))
    links = line.rlike("[|>»·•]") & (marks >= 2) & (4 * marks >= words)
    menu = (F.length(line) <= 60) & (words <= 6) & F.lower(line).rlike(_any_phrase(menu_phrases))
    endless = (F.length(line) >= 120) & ~line.rlike(r"[.!?…;:。！？]") & (words >= 60)
    return symbols | shouted | links | menu | endless


def _pairwise(a: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on; as many as have one."""
    b = F.slice(a, F.lit(step + 1), F.greatest(F.size(a) - step, F.lit(0)))
    return F.zip_with(F.slice(a, F.lit(1), F.greatest(F.size(a) - step, F.lit(0))), b, lambda x, y: F.xxhash64(x, y))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, text, the lines that hold a word, and the base figures."""
    d = docs.select("doc_id", "text", F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    d = d.withColumn("_w", _words(F.col("_t")))
    # windows of 2, 4, then 8 words, each a hash of two halves
    d = d.withColumn("_w2", _pairwise(F.col("_w"), 1))
    d = d.withColumn("_w4", _pairwise(F.col("_w2"), 2))
    d = d.withColumn("_win", _pairwise(F.col("_w4"), 4))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # windows sorted by (hash, place); one is repeated if a neighbour has its hash.
    # Only texts with a repeated window pay for the sort.
    pairs = F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), pairs))
    s = F.col("_s")
    hit = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    d = d.withColumn("_p", F.sort_array(F.transform(hit, lambda x: x["p"])))
    p = F.col("_p")
    cover = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                        F.lit(0), lambda a, x: a + x)
    return d.select(
        "doc_id", "text", "_t", "_lines",
        F.size("_w").cast("long").alias("n_words"),
        _word_chars(F.col("_w")).alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"))


def apply_rules(docs: DataFrame, max_lost: float = 0.5, max_symbols: float = 0.1,
                menu_phrases: tuple[str, ...] = MENU, notice_phrases: tuple[str, ...] = NOTICE) -> DataFrame:
    """One row per document: base figures, lines and word characters lost to
    the line rules, the cleaned text and the verdict. Phrases in lower case."""
    d = measure(docs).withColumn("_low", F.lower("_t"))
    noticed = F.lit(False)
    for phrase in notice_phrases:
        noticed = noticed | F.contains(F.col("_low"), F.lit(phrase))

    def fails(x: Column) -> Column:
        return line_fails(x, max_symbols, menu_phrases)

    def fails_or_notice(x: Column) -> Column:
        return fails(x) | F.lower(x).rlike(_any_phrase(notice_phrases))

    # phrases of notices are looked for line by line only in texts that hold one
    d = d.withColumn("_noticed", noticed)
    d = d.withColumn("_bad", F.when(F.col("_noticed"), F.filter("_lines", fails_or_notice)).otherwise(F.filter("_lines", fails)))
    every = F.split("_t", "\n")

    def stays(bad):
        return lambda x: ~x.rlike(r"[^\x20\x09-\x0D]") | ~bad(x)

    left = F.when(F.col("_noticed"), F.filter(every, stays(fails_or_notice))).otherwise(F.filter(every, stays(fails)))
    clean = F.when(F.size("_bad") == 0, F.col("_t")).otherwise(F.array_join(left, "\n"))
    lost = F.when(F.size("_bad") == 0, F.lit(0)).otherwise(_word_chars(_words(F.array_join("_bad", "\n"))))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (d.withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_failed_lines", F.size("_bad").cast("long"))
            .withColumn("lost_chars", lost.cast("long"))
            .withColumn("clean_text", clean)
            .withColumn("base_failed", base)
            .withColumn("kept", ~base & (F.col("lost_chars") <= F.lit(max_lost) * F.col("word_chars")))
            .drop("_t", "_low", "_lines", "_noticed", "_bad"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines",
        "lost_chars", "clean_text", "base_failed", "kept")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
win AS (SELECT rid, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS p FROM w WHERE len(w) >= 8)),
rep AS (SELECT rid, p FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2),
cov AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(generate_series(p, p + 7)) AS q FROM rep) GROUP BY rid),
line AS (SELECT rid, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
fig AS (
  SELECT rid, pos, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS has, len(regexp_extract_all(l, '[\x20\x09-\x0D]+')) + 1 AS words,
         len(regexp_extract_all(l, '[#*$%&|<>]')) AS sym, len(regexp_extract_all(l, '[|>»·•]')) AS marks
  FROM line),
judged AS (
  SELECT rid, pos, l, has AND (
        (sym > 0 AND sym > 0.1 * length(l))
     OR (NOT regexp_matches(l, '\p{Ll}') AND regexp_matches(l, '\p{Lu}\p{Lu}') AND words >= 3)
     OR (marks >= 2 AND 4 * marks >= words)
     OR (length(l) <= 60 AND words <= 6 AND regexp_matches(lower(l), '(^|[^\p{L}\p{N}_])(skip to content|main menu|sign in|log in|read more|back to top|next page|previous page|site map|saltar al contenido|iniciar sesión|leer más|volver arriba|página siguiente|mapa del sitio|aller au contenu|se connecter|lire la suite|haut de page|page suivante|plan du site|zum inhalt springen|anmelden|weiterlesen|nach oben|nächste seite|seitenübersicht)($|[^\p{L}\p{N}_])'))
     OR (length(l) >= 120 AND words >= 60 AND NOT regexp_matches(l, '[.!?…;:。！？]'))
     OR regexp_matches(lower(l), '(^|[^\p{L}\p{N}_])(all rights reserved|terms of use|terms of service|privacy policy|cookie policy|we use cookies|accept cookies|enable javascript|subscribe to our newsletter|unsubscribe|lorem ipsum|todos los derechos reservados|política de privacidad|política de cookies|utilizamos cookies|aceptar cookies|tous droits réservés|politique de confidentialité|conditions d''utilisation|nous utilisons des cookies|accepter les cookies|alle rechte vorbehalten|datenschutzerklärung|nutzungsbedingungen|wir verwenden cookies|cookies akzeptieren)($|[^\p{L}\p{N}_])')) AS bad
  FROM fig),
bad AS (
  SELECT rid, count(*) FILTER (bad) AS n, coalesce(sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (bad), 0) AS chars,
         coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS clean
  FROM judged GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
       coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, coalesce(bad.n, 0)::BIGINT AS n_failed_lines,
       coalesce(bad.chars, 0)::BIGINT AS lost_chars, CASE WHEN bad.n > 0 THEN bad.clean ELSE t END AS clean_text,
       len(w) < 20 OR 100 * coalesce(cov.n, 0) > 30 * len(w) AS base_failed,
       NOT (len(w) < 20 OR 100 * coalesce(cov.n, 0) > 30 * len(w)) AND coalesce(bad.chars, 0) <= 0.5 * length(array_to_string(w, '')) AS kept
FROM w LEFT JOIN cov USING (rid) LEFT JOIN bad USING (rid)
"""
