"""Line dedup: a suffix array over line ids by distributed prefix doubling, later runs deleted.

Main path: DataFrame operations only.

1. Every document is the sequence of its lines that have a word; a line's id is 128 bits of hash.
   Suffixes start as ranked by the id of their first line. A round ranks them by twice as many
   lines: the ranks at a place and at the place ``depth`` lines on form a pair, the pairs held more
   than once are sorted, and their places in that order are the new ranks. Suffixes of one rank
   are an LCP interval of that depth; a suffix alone in its interval leaves. Rounds go on until all
   have left, so they follow the longest repeat, and every round's ranks are kept.
2. The stored ranks are then descended, deepest first, for the length of the longest prefix that each
   suffix shares with an earlier one, by (doc_id, line). An interval is known by its first suffix.
   A suffix that is not first in a deeper interval is done with the shallower ones, for which the
   first stands; so a level adds one row a suffix, not one a pair. A descent by ``step`` lines
   splits an interval by the ranks that its suffixes have where they stood: those that share one are
   an interval ``step`` lines deeper.
3. What a suffix shares with an earlier one is a maximal repeated run. If it has at least
   ``min_words`` words it is a later copy, and its lines are deleted.

Intervals are counted with partial aggregation, written, and joined back; an interval that a third of
all documents share is rows of a join that adaptive execution splits.

Defined results: lines without a word are kept; null text stays null; a null id is neither a
source nor changed; repeated rows are one document and don't delete each other's lines; texts under
one id are documents whose lines at the same place don't delete each other; an empty table gives an
empty result; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut, removed, stored
from .text import let, words

_VERSION, _GONE = "__mizzen_version", "__mizzen_gone"
_SUFFIX = ["doc", "version", "pos"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _solid(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _needing(lines: Column, min_words: int) -> Column:
    """``lines`` (x, y, size) as (x, y, need): how many lines from each on have ``min_words`` words, at most ``min_words``."""
    start = F.struct(F.lit(0).alias("words"), F.lit(1).alias("lines"))

    def step(had: Column, line: Column) -> Column:
        held = had["words"] + line["size"]
        return F.struct(held.alias("words"), (had["lines"] + F.when(held < min_words, 1).otherwise(0)).alias("lines"))

    def each(line: Column, i: Column, every: Column) -> Column:
        return F.struct(line["x"].alias("x"), line["y"].alias("y"), F.aggregate(F.slice(every, i + 1, max(min_words - 1, 0)), start, step)["lines"].alias("need"))

    return let(lines, lambda every: F.transform(every, lambda x, i: each(x, i, every)))


def suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """Rows (doc, version, pos, x, y, need): each line with a word, its id, and the lines that make ``min_words``."""
    line = lambda x: F.struct(F.xxhash64(x).alias("x"), F.xxhash64(F.lit(1), x).alias("y"), F.size(words(x)).alias("size"))
    each = F.transform(F.filter(_lines(F.col("text")), _solid), line)
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version"), F.posexplode(_needing(each, min_words)).alias("pos", "line"))
    found = cut(rows.select(*_SUFFIX, "line.x", "line.y", "line.need"))
    twice = found.where("pos = 0").groupBy("doc", "version").count().where("count > 1")
    return found if twice.isEmpty() else cut(found.dropDuplicates(_SUFFIX))


def _intervals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The ``keys`` that two or more suffixes have, with the ``first`` of them."""
    first = F.min(F.struct("doc", "pos", "version")).alias("first")
    return rows.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The suffixes in intervals of two or more, with the interval's ``rank`` and ``first``."""
    ranks = cut(_intervals(rows, keys).orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()))
    return cut(rows.join(ranks, keys).select(*_SUFFIX, "need", "rank", "first"))


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Ranks by 1, 2, 4, ... lines, to the last depth at which any suffixes are equal."""
    level, levels = _ranked(lines, ["x", "y"]), []
    while not level.isEmpty():
        levels.append(level)
        behind = level.select("doc", "version", (F.col("pos") - 2 ** (len(levels) - 1)).cast("int").alias("pos"), F.col("rank").alias("then"))
        pairs, path = stored(level.drop("first").withColumnRenamed("rank", "now").join(behind, _SUFFIX))
        level = _ranked(pairs, ["now", "then"])
        removed(lines.sparkSession, path)
    return levels


def _is(first: str) -> Column:
    """Whether the suffix stands where the ``first`` of its interval does."""
    return (F.col("doc") == F.col(first)["doc"]) & (F.col("pos") == F.col(first)["pos"])


def _descended(active: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """``active`` (suffix, need, first, off) where suffixes that share ``step`` more lines are in an interval of their own."""
    at = level.select("doc", "version", F.col("pos").alias("at"), "rank")
    asked = cut(active.withColumn("at", F.col("pos") + F.col("off")).join(at, ["doc", "version", "at"], "left").drop("at"))
    keys = ["first", "off", "rank"]
    deeper = cut(_intervals(asked.where("rank IS NOT NULL").withColumnRenamed("first", "of"), ["of", "off", "rank"]).select(F.col("of").alias("first"), "off", "rank", F.col("first").alias("lead")))
    met = asked.join(deeper, keys, "left")
    here, there = F.struct("first", "off"), F.struct(F.col("lead").alias("first"), (F.col("off") + step).alias("off"))
    both = F.when(F.col("lead").isNull(), F.array(here)).when(_is("lead"), F.array(here, there)).otherwise(F.array(there))
    return met.select(*_SUFFIX, "need", F.explode(both).alias("as")).select(*_SUFFIX, "need", "as.first", "as.off")


def later_runs(levels: list[DataFrame]) -> DataFrame:
    """Rows (doc, version, pos, off): the longest run from a line on that also begins earlier, of enough words.

    A line's shorter runs of the kind may be given too.
    """
    found, active = levels[0].where(~_is("first") & (F.col("need") <= 1)).select(*_SUFFIX, F.lit(1).alias("off")), None
    for k in range(len(levels) - 1, 0, -1):
        enter = levels[k]
        if k + 1 < len(levels):  # what a deeper interval holds, but for its first, is done
            enter = enter.join(levels[k + 1].where(~_is("first")).select(*_SUFFIX), _SUFFIX, "left_anti")
        enter = enter.select(*_SUFFIX, "need", "first", F.lit(2**k).alias("off"))
        active = cut(_descended(enter if active is None else active.unionByName(enter), levels[k - 1], 2 ** (k - 1)))
    if active is None:
        return found
    return found.unionByName(active.where(~_is("first") & (F.col("need") <= F.col("off"))).select(*_SUFFIX, "off"))


def repeated_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """Rows (doc, version, gone): the places, among lines with a word, of each document's later copies."""
    levels = suffix_levels(suffixes(docs, min_words))
    if not levels:
        return docs.sparkSession.createDataFrame([], "doc bigint, version bigint, gone array<int>")
    runs = later_runs(levels).groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("pos", (-F.col("off")).alias("off")))).alias("runs"))
    none = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<low:int,high:int>>").alias("parts"))

    def cover(had: Column, run: Column) -> Column:
        end = run["pos"] - run["off"]
        part = F.struct(F.greatest(run["pos"], had["end"]).alias("low"), end.alias("high"))
        return F.when(end > had["end"], F.struct(end.alias("end"), F.array_append(had["parts"], part).alias("parts"))).otherwise(had)

    parts = F.aggregate("runs", none, cover, lambda had: had["parts"])
    return runs.select("doc", "version", F.flatten(F.transform(parts, lambda p: F.sequence(p["low"], p["high"] - 1))).alias("gone"))


def _rest(text: Column, gone: Column) -> Column:
    """``text`` without the lines at the places ``gone`` of those that have a word."""

    def kept(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        solid = F.filter(every, lambda i: _solid(F.get(lines, i)))
        lost = let(solid, lambda s: F.transform(gone, lambda p: F.get(s, p)))
        return F.array_join(F.transform(F.array_except(every, lost), lambda i: F.get(lines, i)), "\n")

    return F.when(gone.isNull(), text).otherwise(let(_lines(text), kept))


def dedup_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """``docs`` with later copies of line runs deleted from ``text``; an ``n_chars`` among the columns follows the text."""
    out = _applied(docs, min_words).drop(_GONE)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out


def _applied(docs: DataFrame, min_words: int) -> DataFrame:
    gone = repeated_lines(docs, min_words).select(F.col("doc").alias("__mizzen_doc"), F.col("version").alias("__mizzen_v"), F.col("gone").alias(_GONE))
    marked = docs.withColumn(_VERSION, F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("__mizzen_doc")) & (F.col(_VERSION) == F.col("__mizzen_v"))
    return marked.join(gone, same, "left").withColumn("text", _rest(F.col("text"), F.col(_GONE))).drop("__mizzen_doc", "__mizzen_v", _VERSION)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lost = F.coalesce(F.size(F.col(_GONE)), F.lit(0))
    left = F.size(F.filter(_lines(F.col("text")), _solid))
    out = _applied(docs, 5).select("doc_id", left.alias("left"), F.greatest(lost, F.lit(0)).alias("lost"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
    return out.select("doc_id", (F.col("left") + F.col("lost")).cast("bigint").alias("n_lines"), F.col("lost").cast("bigint").alias("n_deleted"), "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, i, ls[i] AS l, len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')) AS n
        FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
solid AS MATERIALIZED (SELECT doc_id, i, l, n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM raw WHERE n > 0),
per AS (SELECT doc_id, count(*) AS n, list(l ORDER BY p) AS ls, list(n ORDER BY p) AS ns FROM solid GROUP BY doc_id),
run AS MATERIALIZED (  -- every run of lines, whatever its length
  SELECT doc_id, p, k, md5(array_to_string(ls[p:p + k - 1], chr(10))) AS t, list_sum(ns[p:p + k - 1]) AS n
  FROM (SELECT doc_id, ls, ns, p, unnest(range(1, len(ls) - p + 2)) AS k FROM (SELECT doc_id, ls, ns, unnest(range(1, len(ls) + 1)) AS p FROM per))
), later AS (
  SELECT doc_id, p, max(k) AS k FROM (SELECT *, min((doc_id, p)) OVER (PARTITION BY k, t) AS f FROM run)
  WHERE n >= 5 AND f < (doc_id, p) GROUP BY doc_id, p
), gone AS (SELECT DISTINCT doc_id, p + o AS p FROM (SELECT doc_id, p, unnest(range(0, k)) AS o FROM later)),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT raw.doc_id, string_agg(raw.l, chr(10) ORDER BY raw.i) AS t
  FROM raw LEFT JOIN solid ON solid.doc_id = raw.doc_id AND solid.i = raw.i
  LEFT JOIN gone ON gone.doc_id = solid.doc_id AND gone.p = solid.p
  WHERE gone.p IS NULL GROUP BY raw.doc_id
)
SELECT d.doc_id, coalesce(per.n, 0)::BIGINT AS n_lines, coalesce(lost.n, 0)::BIGINT AS n_deleted, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
