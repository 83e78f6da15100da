"""Quality rules, line first: judge each line, drop the failures, then judge what is left.

Main path: DataFrame expressions inside one projection; no shuffle, no Python.

Line rules (a line without a word passes and carries no weight):

* navigation: at least three ``|`` or ``»`` or ``•`` separators, or at least one for every three words;
* symbols: characters of ``[#*$%&|<>{}]`` are over a tenth of the line's non-space characters;
* shouting: over 70% of its cased letters are capitals, twenty of them or more and three in a row;
* boilerplate: one of the phrases of ``BOILERPLATE``, in any case. That a line is frequent across documents
  is no rule here: where a document has thousands of near copies its own lines are as frequent and as
  often beside different lines as a notice, and all copies would go before near dedup can keep one;
* punctuation: at least 12 words and no mark of ``STOPS`` in the line.

A document is rejected when the base rules fail or when its failed lines hold more than
``max_loss`` of its non-space characters.

Defined results: null or empty text has no words, fails the base rule and is rejected; a null id
passes through; repeated rows are judged each for itself; an empty table gives an empty result;
other columns are untouched.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import SPACES, let, shingle_hashes, words

SYMBOLS = "#*$%&|<>"
#: A character of a word.
WORD = r"[^\x20\x09-\x0D]"
#: What notices about a page, not its subject, say, in the languages of the documents.
BOILERPLATE = (
    "javascript", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "click here", "lorem ipsum", "sign up for our newsletter", "log in to continue", "skip to content",
    "politique de confidentialité", "conditions d'utilisation", "tous droits réservés", "cliquez ici", "accepter les cookies",
    "datenschutzerklärung", "nutzungsbedingungen", "alle rechte vorbehalten", "hier klicken", "cookies akzeptieren",
    "política de privacidad", "términos de uso", "todos los derechos reservados", "haga clic aquí", "aceptar las cookies",
)
#: Marks that end or divide a sentence, in Latin and other scripts.
STOPS = ".!?;:…。！？；：、،؛؟।॥።։"


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in ``chars``."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _solid(text: Column) -> Column:
    """How many characters of ``text`` are in words."""
    return F.char_length(F.translate(text, SPACES, ""))


def line_fails(line: Column) -> Column:
    """Whether a line breaks a line rule; cheap tests stand before the counts they may spare."""
    n = F.size(words(line))
    bars = _count(line, "|»•")
    capitals = F.char_length(F.regexp_replace(line, r"[^\p{Lu}]", ""))
    cased = F.char_length(F.regexp_replace(line, r"[^\p{Lu}\p{Ll}]", ""))
    navigation = line.rlike("[|»•]") & ((bars >= 3) | (bars * 3 >= n))
    symbols = line.rlike("[#*$%&|<>{}]") & (_count(line, SYMBOLS + "{}") * 10 > _solid(line))
    shouting = line.rlike(r"\p{Lu}{3}") & (capitals >= 20) & (capitals * 10 > cased * 7)
    listed = let(F.lower(line), lambda x: reduce(or_, [x.contains(p) for p in BOILERPLATE]))
    return line.rlike(WORD) & (navigation | symbols | shouting | (~line.rlike(f"[{STOPS}]") & (n >= 12)) | listed)


def repeated_words(tokens: Column, size: int = 3) -> Column:
    """How many words lie in a run of ``size`` words that occurs more than once in the text.

    Runs are sorted by hash with their place; equal neighbours give the places of repeated runs,
    and the places, in order, give the length of what they cover. O(n log n) inside the row.
    """

    def places(s: Column) -> Column:
        """Starts of runs equal to a neighbour in the sorted array ``s`` of (hash, start)."""
        n = F.size(s)
        same = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.coalesce(F.get(s, i)["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(F.get(s, i)["h"] == F.get(s, i + 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda i: F.get(s, i)["i"]))

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(-size).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(p, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(size), x - a["last"])).alias("n")), lambda a: a["n"])

    def ranked(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def counted(h: Column) -> Column:
        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0).cast("bigint")).otherwise(let(ranked(h), lambda s: covered(places(s))))

    return let(tokens, lambda w: F.when(F.size(w) >= size, let(shingle_hashes(w, size), counted)).otherwise(F.lit(0).cast("bigint")))


def measures(text: Column, max_loss: float = 0.5, min_words: int = 50, max_repeat: float = 0.5) -> Column:
    """Struct of all counts, verdicts and the cleaned text of ``text``."""
    whole = F.coalesce(text, F.lit(""))

    def judged(tokens: Column) -> Column:
        lines = F.split(whole, "\n")
        solid = F.filter(lines, lambda x: x.rlike(WORD))
        return F.struct(
            F.size(tokens).cast("bigint").alias("n_words"),
            _solid(whole).cast("bigint").alias("word_chars"),
            F.when(whole.rlike(f"[{SYMBOLS}]"), _count(whole, SYMBOLS)).otherwise(0).cast("bigint").alias("n_symbols"),
            let(solid, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeated_words(tokens).alias("n_repeat_words"),
            F.array_join(F.filter(lines, lambda x: ~line_fails(x)), "\n").alias("cleaned"),
        )

    def verdicts(m: Column) -> Column:
        base = (m["n_words"] < min_words) | (m["n_repeat_words"] > m["n_words"] * max_repeat)
        lost = F.when(m["cleaned"] == whole, 0).otherwise(m["word_chars"] - _solid(m["cleaned"]))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[m[x].alias(x) for x in names], base.alias("base_failed"), (~base & (lost <= m["word_chars"] * max_loss)).alias("kept"), m["cleaned"].alias("cleaned"))

    return let(words(text), lambda w: let(judged(w), verdicts))


def assess(docs: DataFrame, max_loss: float = 0.5) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``."""
    m = docs.select("doc_id", measures(F.col("text"), max_loss).alias("m"))
    return m.select("doc_id", *[f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def clean(docs: DataFrame, max_loss: float = 0.5) -> DataFrame:
    """The kept documents without their failed lines; columns stay, an ``n_chars`` among them follows the text."""
    name = "__mizzen_quality"
    # An array of the verdict or of nothing: exploding it filters without a second evaluation.
    verdict = F.filter(F.array(measures(F.col("text"), max_loss)), lambda m: m["kept"])
    kept = docs.select("*", F.explode(verdict).alias(name))
    out = kept.withColumn("text", F.col(name)["cleaned"]).drop(name)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_PHRASES = "|".join(BOILERPLATE).replace("'", "''")
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), runs AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS r
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), rep AS (
  SELECT k, count(DISTINCT i + o)::BIGINT AS n
  FROM (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, r) AS c FROM runs) WHERE c > 1), (SELECT unnest([0, 1, 2]) AS o)
  GROUP BY k
), ln AS (
  SELECT k, l, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS solid,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         length(regexp_replace(l, '[^|»•]', '', 'g')) AS bars,
         length(regexp_replace(l, '[^#*$%&|<>{{}}]', '', 'g')) AS symbols,
         length(regexp_replace(l, '[^\p{{Lu}}]', '', 'g')) AS capitals,
         length(regexp_replace(l, '[^\p{{Lu}}\p{{Ll}}]', '', 'g')) AS cased
  FROM (SELECT k, unnest(lines) AS l FROM d)
), judged AS (
  SELECT k, l, solid,
         n > 0 AND (bars >= 3 OR (bars >= 1 AND bars * 3 >= n) OR symbols * 10 > solid
           OR (regexp_matches(l, '\p{{Lu}}{{3}}') AND capitals >= 20 AND capitals * 10 > cased * 7) OR regexp_matches(lower(l), '{_PHRASES}')
           OR (n >= 12 AND NOT regexp_matches(l, '[{STOPS}]'))) AS fails
  FROM ln
), per AS (
  SELECT k, (count(*) FILTER (solid > 0) - count(DISTINCT l) FILTER (solid > 0))::BIGINT AS dup,
         coalesce(sum(solid), 0)::BIGINT AS chars, coalesce(sum(solid) FILTER (fails), 0)::BIGINT AS lost
  FROM judged GROUP BY k
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, per.chars AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, per.dup AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, per.lost
  FROM d JOIN per USING (k) LEFT JOIN rep USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR n_repeat_words * 2 > n_words) AS base_failed,
       (NOT (n_words < 50 OR n_repeat_words * 2 > n_words) AND lost * 2 <= word_chars) AS kept
FROM m
"""
