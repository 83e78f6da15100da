"""Benchmark decontamination: MinHash containment search, partitioned by the size of the test item.

Main path: DataFrame operations only.

A document is far longer than a test item, so their Jaccard similarity says nothing; what counts is
how much of the item's shingle set lies in the document. A collision of an item's minimum with a
document's minimum needs the item's minimal shingle to be in the document at all, and testing just
that gives a collision probability equal to the containment, whatever the document's length.

Items are partitioned by size, in powers of two. An item's sketch is the k least hashes of its
shingle set, and k follows from its partition: with containment ``c`` required, an item of at most u
shingles can miss floor((1 - c) * u) of them, so k one greater leaves no item undetected. Above 64
minima a contained item goes unseen with a probability below (1 - c) ** 64.

An item of fewer words than a shingle is one shingle of all its words, and documents are probed with
shingles of each width that the items have. Candidates (document, item) are then verified by the
exact share of the item's shingles in the document's whole set.

The sketches are broadcast only after a count shows that they fit; otherwise the shingles are
shuffled to them. The same holds for the list of candidate documents.

Defined results: an item without a word matches nothing; items are told apart by their rows, so those
with a null, repeated or equal id are each reported with it; a null doc_id is reported with its
null; repeated rows are each reported; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits
from .text import ascii_lower, let, shingle_hashes, words

#: Rows up to which a table of sketches or of candidates is broadcast, about 24 bytes a row.
BROADCAST_ROWS = 200_000
MOST_MINIMA = 64


def _shingles(text: Column, widths: list[int]) -> Column:
    """Hashes of the runs of each of ``widths`` words."""
    return let(words(ascii_lower(text)), lambda w: F.concat(*[shingle_hashes(w, n) for n in widths]))


def _items(benchmark: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (item, item_id, width, shingles, need, sketch); ``need`` is how many shingles a document must hold."""
    counted = benchmark.withColumn("width", F.least(F.size(words(F.col("text"))), F.lit(size))).where("width > 0")
    sets = counted.select("item_id", "width", F.sort_array(F.array_distinct(_shingles(F.col("text"), [size]))).alias("shingles"))
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles"))))
    minima = F.least(F.floor(upper * (100 - percent) / 100) + 1, F.lit(MOST_MINIMA)).cast("int")
    need = F.ceil(F.size("shingles") * percent / 100).cast("int")
    return sets.select(F.monotonically_increasing_id().alias("item"), "item_id", "width", "shingles", need.alias("need"), F.slice("shingles", F.lit(1), minima).alias("sketch"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it is proven small."""
    return F.broadcast(df) if fits(df, BROADCAST_ROWS) else df


def contained_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, version, item_id, n_shared, n_shingles) for items contained in a document.

    ``version`` is the hash of the text, which tells rows with one doc_id apart.
    """
    items = cut(_items(benchmark.select("item_id", "text"), size, percent))
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [size]  # at most ``size`` rows
    plain = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    probes = plain.select("doc_id", "version", F.explode(_shingles(F.col("text"), widths)).alias("shingle"))
    sketches = items.select("item", F.explode("sketch").alias("shingle"))
    candidates = cut(probes.join(_small(sketches), "shingle").select("doc_id", "version", "item").distinct())

    c = candidates.withColumnRenamed("doc_id", "c_doc").withColumnRenamed("version", "c_version")
    same = F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("version") == F.col("c_version"))
    met = plain.join(_small(c.select("c_doc", "c_version").distinct()), same, "left_semi")
    sets = met.select("doc_id", "version", F.array_distinct(_shingles(F.col("text"), widths)).alias("own"))
    full = sets.join(c, same).drop("c_doc", "c_version").join(items.select("item", "item_id", "shingles", "need"), "item")
    shared = full.withColumn("n_shared", F.size(F.array_intersect("own", "shingles")))
    return shared.where("n_shared >= need").select("doc_id", "version", "item_id", F.col("n_shared").cast("bigint"), F.size("shingles").cast("bigint").alias("n_shingles"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that contain a test item; columns stay."""
    hit = contained_items(docs, benchmark, size, percent).select(F.col("doc_id").alias("__mizzen_doc"), F.col("version").alias("__mizzen_v")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__mizzen_doc")) & (F.xxhash64("text") == F.col("__mizzen_v"))
    return docs.join(_small(cut(hit)), same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contained_items(docs, benchmark).drop("version")


SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM t
), widths AS (SELECT DISTINCT least(len(w), 5) AS n FROM w WHERE kind = 'b' AND len(w) > 0),
wide AS (SELECT kind, id, w, n FROM w, widths WHERE kind = 'd' UNION ALL SELECT kind, id, w, least(len(w), 5) FROM w WHERE kind = 'b' AND len(w) > 0),
s AS MATERIALIZED (
  SELECT DISTINCT kind, id, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT kind, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM wide WHERE len(w) >= n)
), sizes AS (SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, count(*)::BIGINT AS n_shared, any_value(n)::BIGINT AS n_shingles
FROM s d JOIN s b ON b.g = d.g AND d.kind = 'd' AND b.kind = 'b' JOIN sizes ON sizes.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(n)
"""
