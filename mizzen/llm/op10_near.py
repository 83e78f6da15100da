"""Near duplicates: MinHash with banding, signature verification, exact check, connected components.

1. One pass over the texts gives each document's shingle set as a digest, its signature of
   universal hash minima and its band keys. Documents with the same set are one class, which is
   read by its least id.
2. Class representatives meet in band buckets. Each bucket's members are paired with its least
   member only, so a bucket of n gives n - 1 pairs. Signatures discard pairs far below the
   threshold, full shingle sets decide the rest, and the links give components.
3. Buckets whose members still lie in different components are then searched completely. The
   texts in buckets of one least member are a family; a family is dealt into blocks of about ``BLOCK`` texts, and
   each task compares two blocks, giving only enough links to connect what the pairs' links connect. After
   this every pair of a bucket is linked, measured, or inside one component.

The number of bands follows from the threshold, so that a pair just at it meets in no bucket with
a probability of at most ``MISS``: 25 bands of 5 at 85%, 37 at 80%.

Defined results: null or empty text has an empty set and is linked with nothing; a null id gets a
null component and stays; repeated rows are a class like any other; rows with one id and different
texts are linked only as far as their texts are, and what is linked gets the least id of it;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits
from .components import connected_components
from .text import mix, portions, small_batches, word_hashes

#: Texts of a block in the complete search, and shingles compared at a time there.
BLOCK, SLICE = 256, 8192
#: Ids up to which a list of documents is broadcast.
BROADCAST_IDS = 500_000
#: Chance that the bands miss a pair at the threshold.
MISS = 5e-7

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` lower-cased words; fewer words are one run."""
    h = word_hashes(text, lower=True)
    if not h.size:
        return h
    width = min(size, h.size)
    runs = np.full(h.size - width + 1, width, dtype=np.uint64)
    for j in range(width):
        runs = mix(runs * _STEP + h[j : h.size - width + 1 + j])
    return np.unique(runs)


def _key(values: np.ndarray) -> bytes:
    """Digest of a shingle set."""
    return blake2b(values.tobytes(), digest_size=16).digest()


class _Minima:
    """``n`` multiply-shift universal hash functions and the band keys of their minima."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2)

    def signature(self, values: np.ndarray) -> np.ndarray:
        least = np.full(self.a.size, 2**32 - 1, dtype=np.uint64)
        for i in range(0, values.size, 2048):
            part = (values[i : i + 2048, None] * self.a + self.b) >> np.uint64(32)
            least = np.minimum(least, part.min(axis=0))
        return least.astype(np.uint32)

    def keys(self, signature: np.ndarray) -> np.ndarray:
        table = signature.reshape(self.bands, self.rows).astype(np.uint64)
        key = np.arange(self.bands, dtype=np.uint64)
        for j in range(self.rows):
            key = mix(key * _STEP + table[:, j])
        return key.view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Rows (doc_id, version, key, n, sig, bands); an empty set has null key, sig and bands.

    ``version`` is a hash of the text, which tells rows with one doc_id apart; ``key`` is the set's digest.
    """
    minima = _Minima(bands, rows)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            out = []
            for doc_id, version, text in zip(batch["doc_id"], batch["version"], batch["text"]):
                values = shingle_set(text, size)
                if values.size:
                    sig = minima.signature(values)
                    out.append((doc_id, version, _key(values), values.size, sig.tobytes(), minima.keys(sig)))
                else:
                    out.append((doc_id, version, None, 0, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "version", "key", "n", "sig", "bands"]).astype({"doc_id": "Int64"})

    plain = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("version"), "text")
    return plain.mapInPandas(scan, "doc_id bigint, version bigint, key binary, n bigint, sig binary, bands array<bigint>")


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """Rows (node, values): the full shingle sets of ``nodes`` (node, id, key), read from the rows of their id and key."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            each = [shingle_set(t, size) for t in batch["text"]]
            own = [_key(x) == k for x, k in zip(each, batch["key"])]
            yield pd.DataFrame({"node": batch["node"][own], "values": [x.tobytes() for x, mine in zip(each, own) if mine]})

    side = F.broadcast(nodes) if fits(nodes, BROADCAST_IDS) else nodes
    wanted = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(side, "id")
    return wanted.select("node", "key", "text").mapInPandas(scan, "node bigint, values binary")


def _agreement(a: Column, b: Column) -> Column:
    """Share of equal minima of two signatures."""

    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([float(np.mean(np.frombuffer(i, np.uint32) == np.frombuffer(j, np.uint32))) for i, j in zip(x, y)])

    return F.pandas_udf(share, "double")(a, b)


def _common(a: Column, b: Column) -> Column:
    """Size of the intersection of two packed sets."""

    def size(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([np.intersect1d(np.frombuffer(i, np.uint64), np.frombuffer(j, np.uint64), assume_unique=True).size for i, j in zip(x, y)])

    return F.pandas_udf(size, "long")(a, b)


def _measured(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact (a, b, common, total) of the pairs whose signatures don't rule them out.

    A signature of 125 minima agrees in less than the threshold minus a fifth for about one link
    in 10**8.
    """
    left = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    right = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    near = pairs.join(left, "b").join(right, "a").where(_agreement(F.col("sig_a"), F.col("sig_b")) >= percent / 100 - 0.2).select("a", "b")
    full = near.join(sets.select(F.col("node").alias("b"), F.col("values").alias("y")), "b").join(sets.select(F.col("node").alias("a"), F.col("values").alias("x")), "a")
    counted = full.select("a", "b", _common(F.col("x"), F.col("y")).alias("common"), ((F.octet_length("x") + F.octet_length("y")) / 8).cast("bigint").alias("both"))
    return counted.select("a", "b", "common", (F.col("both") - F.col("common")).alias("total"))


def bands_for(percent: int, rows: int) -> int:
    """Bands of ``rows`` minima in which a pair at the threshold meets but for a chance of ``MISS``."""
    meets = (percent / 100) ** rows
    return 1 if meets >= 1 else math.ceil(math.log(MISS) / math.log(1 - meets))


def _components(docs: DataFrame, size: int, percent: int, rows: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, version, n, part, component.

    ``part`` numbers the components, so that two of them stay apart where one id has several texts.
    """
    with small_batches(docs.sparkSession):
        sigs = cut(signatures(docs, size, bands_for(percent, rows), rows))
    grouped = sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("id"))
    same = (F.col("c.key") == F.col("s.key")) & (F.col("c.id") == F.col("s.doc_id"))
    # One row of each class. Its least id stands for it, or a number where an id has several classes.
    rows_of = sigs.alias("s").join(grouped.alias("c"), same).select("c.key", "id", "sig", "bands")
    classes = cut(rows_of.groupBy("key").agg(*[F.first(c).alias(c) for c in ("id", "sig", "bands")], F.count(F.lit(1)).alias("of")))
    alone = classes.groupBy("id").count().where("count > 1").isEmpty()
    classes = classes.withColumn("node", F.col("id")) if alone else cut(classes.orderBy("id").withColumn("node", F.monotonically_increasing_id()))

    banded = classes.select("node", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top").drop("top")
    met = cut(banded.join(hubs, "bucket"))
    stars = met.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    asked = cut(classes.select("node", "id", "key", "of").join(met.select("node").distinct(), "node", "left_semi"))
    sets = _sets(docs, asked.drop("of"), size)
    # Rows of one id and set give the set several times.
    with small_batches(docs.sparkSession):
        sets = cut(sets if asked.where("of > 1").isEmpty() else sets.dropDuplicates(["node"]))
    measured = cut(_measured(stars, classes, sets, percent))
    linked = F.col("common") * 100 >= F.col("total") * percent
    parts = connected_components(measured.where(linked).select("a", "b"))

    more = cut(_missed(met, parts, sets, percent))
    if not more.isEmpty():
        parts = connected_components(parts.select(F.col("vertex").alias("a"), F.col("component").alias("b")).unionByName(more))

    placed = classes.select("key", "id", "node").join(parts, F.col("node") == F.col("vertex"), "left").select("key", "id", F.coalesce("component", "node").alias("part"))
    least = placed.groupBy("part").agg(F.min("id").alias("component"))
    found = cut(placed.join(least, "part").select("key", "part", "component"))
    rows_out = sigs.select("doc_id", "version", "key", "n").join(found, "key", "left")
    known = F.col("doc_id").isNotNull()
    return rows_out.select("doc_id", "version", "n", F.when(known, F.col("part")).alias("part"), F.when(known, F.coalesce("component", "doc_id")).alias("component"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = 5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of
    ``size``-word shingles. Bands have ``rows`` minima; fewer of them for a low ``percent`` need fewer bands.
    """
    out = _components(docs, size, percent, rows).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _spanning(linked: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a symmetric table of links, ends of enough of them to connect the same parts: fewer than there are parts."""
    todo, reached = np.ones(part.max() + 1, dtype=bool), []
    for start in range(todo.size):
        if not todo[start]:
            continue
        todo[start], wave = False, np.flatnonzero(part == start)
        while wave.size:
            to = np.flatnonzero(linked[wave].any(axis=0) & todo[part])
            to = to[np.unique(part[to], return_index=True)[1]]  # one text of each part met
            reached.append((wave[linked[np.ix_(wave, to)].argmax(axis=0)], to))
            todo[part[to]] = False
            wave = np.flatnonzero(np.isin(part, part[to]))
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *[a for a, _ in reached]]), np.concatenate([none, *[b for _, b in reached]])


def _missed(met: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components so far."""
    own = parts.select(F.col("vertex").alias("node"), F.col("component").alias("part"))
    placed = met.join(own, "node", "left").withColumn("part", F.coalesce("part", "node"))
    split = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("bucket")
    # Texts that share a bucket share its hub, so a hub's texts are a family that misses no pair.
    members = cut(placed.join(split, "bucket", "left_semi").select(F.col("hub").alias("family"), "node", "part").distinct())
    # Only families of several blocks are joined: few rows, so that a large family is not one task's.
    blocks = cut(members.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks")).where("n_blocks > 1"))
    several = members.join(F.broadcast(blocks) if fits(blocks, BROADCAST_IDS) else blocks, "family", "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    dealt = several.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")).join(sets, "node")
    others = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met_by = dealt.select("family", "node", "part", "values", "block", others.alias("other"))
    pairs = met_by.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "part", "values")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(x, np.uint64) for x in rows["values"]]
        size = np.array([x.size for x in each])
        part, block, node = (rows[c].to_numpy() for c in ("part", "block", "node"))
        shingle, where = np.unique(np.concatenate(each), return_inverse=True)
        owner = np.repeat(np.arange(len(each)), size)
        order = np.argsort(where, kind="stable")
        where, owner = where[order], owner[order]
        common = np.zeros((len(each), len(each)), dtype=np.float32)
        for low in range(0, shingle.size, SLICE):
            here = slice(*np.searchsorted(where, (low, low + SLICE)))
            table = np.zeros((len(each), SLICE), dtype=np.float32)
            table[owner[here], where[here] - low] = 1
            common += table @ table.T
        common = common.astype(np.int64)
        total = size[:, None] + size[None, :] - common
        apart = part[:, None] != part[None, :]
        if block.min() != block.max():  # pairs inside a block are another task's
            apart &= block[:, None] != block[None, :]
        a, b = _spanning(apart & (common * 100 >= total * percent), np.unique(part, return_inverse=True)[1])
        return pd.DataFrame({"a": node[a], "b": node[b]})

    return pairs.groupBy("family", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: of its least id, the row with the least text hash, once.

    Columns stay. Rows without a word or without an id belong to no component and all stay. Unlinked
    texts under one id are components of their own, each of which keeps its row.
    """
    found = cut(_components(docs.select("doc_id", "text"), size, percent, 5).where("part IS NOT NULL"))
    least = found.where("doc_id = component").groupBy("part").agg(F.min("version").alias("low"), F.max("version").alias("high"), F.count(F.lit(1)).alias("n"))
    tied = cut(least.where("n > 1"))  # the same id several times in one component
    gone = found.where("doc_id <> component").select("doc_id", "version")
    again = None
    if not tied.isEmpty():
        side = F.broadcast(tied) if fits(tied, BROADCAST_IDS) else tied
        rivals = cut(found.where("doc_id = component").join(side, "part").select("doc_id", "version", "low"))
        gone = gone.unionByName(rivals.where("version <> low").select("doc_id", "version"))
        again = _named(rivals.where("version = low").groupBy("doc_id", "version").count().where("count > 1"))
    same = (F.col("doc_id") == F.col("__mizzen_doc")) & (F.xxhash64("text") == F.col("__mizzen_v"))
    out = docs.join(_named(gone.distinct()), same, "left_anti")
    if again is None:
        return out
    once = out.join(again, same, "left_semi").withColumn("__mizzen_v", F.xxhash64("text")).dropDuplicates(["doc_id", "__mizzen_v"]).drop("__mizzen_v")
    return out.join(again, same, "left_anti").unionByName(once)


def _named(rows: DataFrame) -> DataFrame:
    """(doc_id, version) under names that no table of documents has."""
    return rows.select(F.col("doc_id").alias("__mizzen_doc"), F.col("version").alias("__mizzen_v"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=85)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
  FROM d
), e AS MATERIALIZED (SELECT doc_id, unnest(g) AS x FROM s),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM e p JOIN e q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL
), link AS MATERIALIZED (
  SELECT a, b FROM common JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * n >= 85 * (len(p.g) + len(q.g) - n)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM s
  UNION
  SELECT b, r FROM reach JOIN both_ways ON v = a
), c AS (SELECT v, min(r) AS m FROM reach GROUP BY v)
SELECT doc_id, len(g)::BIGINT AS n_shingles, m AS component_id, doc_id = m AS kept FROM s JOIN c ON v = doc_id
"""
