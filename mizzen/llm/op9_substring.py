"""Substring dedup by recompression: repeated passages of ``window`` words, found through shared symbols.

Recompression rewrites each document's word sequence in rounds. A round either names runs of one
symbol or names pairs of a left and a right symbol, the side being a bit of the symbol's name.

1. Short symbols are made where the text is, in ``ROUNDS`` and ``LONGER``: their names are hashes of what they
   stand for, so equal runs and pairs get equal names in every document.
2. Spark rounds go on from there. Each forms the runs or pairs of all documents, counts them by what they consist
   of, gives those that several documents have a global name, a number, with the least doc_id that has
   them, and joins the names back. Symbols that one document alone has leave, and take no part in later
   rounds. Symbols grow to hundreds of words, and there are few of them.
3. A shared symbol of ``window`` words or more is a verified repeat: whatever document has it after the least one
   loses all its words, and none of the windows inside it needs a look.
4. What is left is windows about the ends of such symbols, and repeats too short for one. Each window takes as
   anchor the least-hashed symbol of ``ROUNDS`` that lies whole in its interior, named with the ``REACH`` words on
   both sides of its start, all inside the window. In those rounds only symbols up to a length limit take
   part, so whether a boundary survives is settled by at most ``REACH`` words on either side, and equal
   windows have equal anchors. An anchor that only one text has rules all its windows out; a window without an
   interior symbol (a long run) is its own anchor. Windows with shared anchors are verified by a 128-bit
   digest of all their words, and the least doc_id of each digest decides.

The first symbols are not named in Spark rounds because a row a symbol costs more than the whole search: see the
README for figures.

Identical texts are one class: the least doc_id stands for it, and later copies lose every window
without being searched. Counts and minima are aggregated before each shuffle; a digest that many
documents hold is met in a join that adaptive execution can split.

Defined results: null or empty text has no words; a null id is never matched and keeps its words;
repeated rows with one doc_id don't remove each other; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits, removed, stored
from .text import mix, portions, small_batches, word_hashes

#: (kind, longest symbol in words that takes part) of each round.
ROUNDS = (("run", 1), ("pair", 1), ("pair", 1), ("run", 2), ("pair", 2))
#: The rounds that follow them in the same pass, to symbols of a few dozen words.
LONGER = (("run", 4), *[("pair", n) for n in (4, 4, 8, 8, 8, 16, 16, 16)], ("run", 32), *[("pair", 32)] * 5)
#: The rounds that Spark names. More of them would spare few windows more; results are whole after any number.
SPARK_ROUNDS = ("run", "pair", "pair", "pair")
#: Words on either side that a boundary of the last round depends on.
REACH = sum(limit for _, limit in ROUNDS)
#: Ids up to which a list of documents is broadcast.
BROADCAST_IDS = 1_000_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def _seed(k: int) -> np.uint64:
    return np.uint64(int(_B) * k % 2**64)


def recompress(words: np.ndarray, text: np.ndarray, rounds: tuple = ROUNDS, start: np.ndarray | None = None, lanes: tuple = (_B,), first_round: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """Names, one array a lane, and starts of the symbols after ``rounds``; ``text`` numbers the text of each word.

    The first lane decides what is joined; further lanes are hashes of their own, to tell symbols apart by
    more bits. ``start`` gives the starts of symbols that rounds before have made; ``words`` are then
    their names, one array a lane.
    """
    names = list(words) if isinstance(words, list) else [words] * len(lanes)
    size, start = text.size, np.arange(text.size) if start is None else start
    owner = text[start]
    for k, (kind, limit) in enumerate(rounds, first_round):
        name = names[0]
        able = np.diff(start, append=size) <= limit
        joined = np.zeros(name.size, dtype=bool)  # to the symbol before
        beside = able[1:] & able[:-1] & (owner[1:] == owner[:-1])
        if kind == "run":
            joined[1:] = beside & (name[1:] == name[:-1])
        else:
            right = (mix(name ^ _seed(k + 1)) >> np.uint64(63)).astype(bool)
            joined[1:] = beside & ~right[:-1] & right[1:]
        first = np.flatnonzero(~joined)
        count = np.diff(first, append=name.size)
        for i, (lane, salt) in enumerate(zip(names, lanes)):
            if kind == "run":
                named = mix(lane[first] * _A + count.astype(np.uint64) * salt)
            else:
                named = mix(mix(lane[first] * salt) + lane[np.minimum(first + 1, lane.size - 1)])
            names[i] = np.where(count > 1, named, lane[first])
        start, owner = start[first], owner[first]
    return names, start


def spans(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """64-bit digest of the ``width`` words from each place on, built by doubling."""
    out, have = mix(words + _seed(seed)), 1
    while have < width:
        step = min(have, width - have)
        out, have = mix(out[:-step] * _A + out[step:]), have + step
    return out


def short_symbols(words: np.ndarray, text: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Names in two lanes and starts of the symbols after ``ROUNDS``."""
    return recompress([words, mix(words + _seed(5))], text, ROUNDS, np.arange(words.size), (_B, _C))


def anchors(words: np.ndarray, text: np.ndarray, window: int, name: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one text, and their anchors' names; ``name`` and ``start`` of the short symbols."""
    if words.size < window:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    at = np.flatnonzero(text[: words.size - window + 1] == text[window - 1 :])
    rank, end = mix(name), np.append(start[1:], words.size)
    low, high = np.searchsorted(start, at + REACH), np.searchsorted(end, at + window - REACH, side="right")
    found = high > low
    chosen = np.zeros(at.size, dtype=np.int64)
    best, width = np.arange(name.size), 1  # of each place: the least of so many symbols
    span = high - low
    while found.any() and width <= span.max():
        here = found & (span >= width) & (span < 2 * width)
        x, y = best[low[here]], best[high[here] - width]
        chosen[here] = np.where(rank[y] < rank[x], y, x)
        if best.size <= width:
            break
        x, y = best[:-width], best[width:]
        best, width = np.where(rank[y] < rank[x], y, x), 2 * width
    whole = spans(words, window)[at]
    around = spans(words, 2 * REACH)
    names = np.where(found, around[np.clip(start[chosen] - REACH, 0, around.size - 1)], whole)
    return at, names


def _joined(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes of all texts, each word's text, and each text's first word."""
    each = [word_hashes(t) for t in texts]
    sizes = np.array([x.size for x in each], dtype=np.int64)
    return np.concatenate([*each, np.empty(0, dtype=np.uint64)]), np.repeat(np.arange(len(each)), sizes), np.cumsum(sizes) - sizes


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _digest(text: str | None) -> bytes:
    return sha256(b" ".join(_words(text))).digest()


def _version(digest: bytes) -> int:
    """Tells apart different texts under one doc_id."""
    return int.from_bytes(digest[:4], "big", signed=True)


def _of_version(batch: pd.DataFrame) -> pd.DataFrame:
    """The rows whose text is the version that the row asks for."""
    return batch[[_version(_digest(t)) == v for t, v in zip(batch["text"], batch["version"])]]


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, sha, version, n, marks, parts): digest of all words, their number, the anchors' names, the symbols."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            words, text, first = _joined(batch["text"])
            lanes, start = short_symbols(words, text)
            at, names = anchors(words, text, window, lanes[0], start)
            cuts = np.searchsorted(text[at], np.arange(1, len(batch)))
            marks = [np.unique(x).view(np.int64) for x in np.split(names, cuts)]
            (x, y), start = recompress(lanes, text, LONGER, start, (_B, _C), len(ROUNDS))
            size = np.diff(start, append=words.size)
            ends = np.searchsorted(text[start], np.arange(1, len(batch)))
            start = start - first[text[start]]
            digests = [_digest(t) for t in batch["text"]]
            out = {"doc_id": batch["doc_id"].astype("Int64"), "sha": digests, "version": [_version(d) for d in digests], "n": np.bincount(text, minlength=len(batch)), "marks": marks}
            for name, values in (("starts", start.astype(np.int32)), ("sizes", size.astype(np.int32)), ("xs", x.view(np.int64)), ("ys", y.view(np.int64))):
                out[name] = np.split(values, ends)
            yield pd.DataFrame(out)

    return docs.mapInPandas(scan, "doc_id bigint, sha binary, version int, n bigint, marks array<bigint>, starts array<int>, sizes array<int>, xs array<bigint>, ys array<bigint>")


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The ``keys`` that several documents have, with the least of their ids as ``low``."""
    return rows.groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")


def _round(live: DataFrame, kind: str, k: int) -> DataFrame:
    """``live`` symbols (doc_id, version, start, size, x, y, low) after one round of runs or pairs.

    What several documents have is named by a number that this round gives, in ``x``, beside the round's own
    number, below 0, in ``y``; what one document has is left as it was.
    """
    order = Window.partitionBy("doc_id", "version").orderBy("start")
    before = lambda c: F.lag(c).over(order)
    beside = F.coalesce(before(F.col("start") + F.col("size")) == F.col("start"), F.lit(False))
    followed = F.coalesce(F.lead("start").over(order) == F.col("start") + F.col("size"), F.lit(False))
    if kind == "run":
        joined = beside & (before(F.col("x")) == F.col("x")) & (before(F.col("y")) == F.col("y"))
    else:
        right = F.xxhash64(F.lit(k), "x", "y").bitwiseAND(F.lit(1))
        joined = beside & (before(right) == 0) & (right == 1)
    # A symbol without a shared one beside it can't grow any more.
    dealt = live.select("*", F.coalesce(joined, F.lit(False)).alias("joined"), (beside | followed).alias("met")).where("met").drop("met")
    dealt = cut(dealt.withColumn("part", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("joined"))
    ends = [f(F.struct("start", "x", "y")).alias(c) for f, c in ((F.min, "a"), (F.max, "z"))]
    several = dealt.groupBy("doc_id", "version", "part").agg(*ends, F.sum("size").cast("int").alias("size"), F.count(F.lit(1)).alias("of")).where("of > 1")
    made = several.select("doc_id", "version", "part", F.col("a.start").alias("start"), "size", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("z.x").alias("zx"), F.col("z.y").alias("zy"), "of")
    keys = ["ax", "ay", "zx", "zy", "of"]
    names = cut(_shared(made, keys).withColumn("x", F.monotonically_increasing_id()).withColumn("y", F.lit(-k).cast("bigint")))
    new = made.join(names, keys)
    rest = dealt.join(new.select("doc_id", "version", "part"), ["doc_id", "version", "part"], "left_anti")
    columns = ["doc_id", "version", "start", "size", "x", "y", "low"]
    return rest.select(*columns).unionByName(new.select(*columns))


def verified_spans(leads: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, version, lows, highs): spans of words that an earlier document has as one symbol."""
    rows = leads.select("doc_id", "version", F.explode(F.arrays_zip("starts", "sizes", "xs", "ys")).alias("s"))
    rows = rows.select("doc_id", "version", F.col("s.starts").alias("start"), F.col("s.sizes").alias("size"), F.col("s.xs").alias("x"), F.col("s.ys").alias("y"))
    spark, live = leads.sparkSession, rows.join(cut(_shared(rows, ["x", "y"])), ["x", "y"])
    later = lambda df: df.where((F.col("size") >= window) & (F.col("doc_id") > F.col("low"))).select("doc_id", "version", "start", (F.col("start") + F.col("size")).alias("end"))
    (live, path), found = stored(live), []
    for k, kind in enumerate(SPARK_ROUNDS, 1):
        found.append(cut(later(live)))
        (live, next_path), old = stored(_round(live, kind, k)), path
        removed(spark, old)
        path = next_path
    out = later(live)
    for more in found:
        out = out.unionByName(more)
    spans_ = F.sort_array(F.collect_set(F.struct("start", "end")))
    return out.groupBy("doc_id", "version").agg(spans_.alias("s")).select("doc_id", "version", F.col("s.start").alias("lows"), F.col("s.end").alias("highs"))


def _covered(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in any of the spans."""
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, high, -1)
    return np.cumsum(edge)[:-1] > 0


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Rows (x, y, doc_id, version, place) of the windows of ``texts`` whose anchor is in ``names``, outside verified spans."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in map(_of_version, portions(batches)):
            if batch.empty:
                continue
            words, text, first = _joined(batch["text"])
            (name,), start = recompress(words, text)
            at, names = anchors(words, text, window, name, start)
            shared = np.concatenate([np.asarray(x, dtype=np.int64) for x in batch["names"]])
            wanted = np.isin(names.view(np.int64), shared)
            # A window begins inside a span if it ends there too.
            low = np.concatenate([np.asarray(x, dtype=np.int64) + f for x, f in zip(batch["lows"], first)])
            high = np.concatenate([np.asarray(x, dtype=np.int64) + f - window + 1 for x, f in zip(batch["highs"], first)])
            wanted &= ~_covered(words.size, low, high)[at]
            at = at[wanted]
            if not at.size:
                continue
            owner = text[at]
            x, y = spans(words, window, 1)[at], spans(words, window, 2)[at]
            yield pd.DataFrame({"x": x.view(np.int64), "y": y.view(np.int64), "doc_id": batch["doc_id"].to_numpy()[owner], "version": batch["version"].to_numpy()[owner], "place": (at - first[owner]).astype(np.int32)})

    return texts.mapInPandas(scan, "x bigint, y bigint, doc_id bigint, version int, place int")


def _stripped(found: DataFrame, window: int) -> DataFrame:
    """Rows (doc_id, version, removed, rest): the words that no window in ``places`` and no span covers."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in map(_of_version, portions(batches)):
            removed, rest = [], []
            for text, places, lows, highs in zip(batch["text"], batch["places"], batch["lows"], batch["highs"]):
                words, place = np.array(_words(text), dtype=object), np.asarray(places, dtype=np.int64)
                gone = _covered(words.size, np.concatenate([place, np.asarray(lows, dtype=np.int64)]), np.concatenate([place + window, np.asarray(highs, dtype=np.int64)]))
                removed.append(int(gone.sum()))
                rest.append(b" ".join(words[~gone]).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "version": batch["version"], "removed": removed, "rest": rest})

    return found.mapInPandas(scan, "doc_id bigint, version int, removed bigint, rest string")


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, rest.

    ``rest`` has the kept words where some were removed and is null where none were.
    """
    if window < 2 * REACH + 2:
        raise ValueError(f"a window needs {2 * REACH + 2} words")
    plain = docs.select(F.col("doc_id").cast("bigint"), "text")
    with small_batches(docs.sparkSession):
        base = cut(_scan(plain, window))
    # Texts that several documents have, so that the join below doesn't shuffle the others; cut, so that Spark can split it.
    several = base.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("of")).where("of > 1").drop("of")
    classes = cut(several)
    classes = F.broadcast(classes) if fits(classes, BROADCAST_IDS) else classes
    marked = base.where(F.col("doc_id").isNotNull() & (F.col("n") >= window)).join(classes, "sha", "left")
    leads = marked.where("first_id IS NULL").unionByName(marked.where("doc_id = first_id").dropDuplicates(["sha"]))

    marks = leads.select("doc_id", "version", F.explode("marks").alias("name"))
    shared = _shared(marks, ["name"]).select("name")
    met = cut(marks.join(shared, "name").groupBy("doc_id", "version").agg(F.collect_list("name").alias("names")))
    wanted = met.select("doc_id", "version")
    verified = verified_spans(leads.join(F.broadcast(wanted) if fits(wanted, BROADCAST_IDS) else wanted, ["doc_id", "version"], "left_semi"), window)
    empty = lambda c, kind="int": F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    hits = cut(met.join(verified, ["doc_id", "version"], "left").select("doc_id", "version", "names", empty("lows"), empty("highs")))
    ids = hits.select("doc_id").distinct()
    texts = plain.join(F.broadcast(ids) if fits(ids, BROADCAST_IDS) else ids, "doc_id", "left_semi").join(hits, "doc_id")

    with small_batches(docs.sparkSession):
        wins = cut(_windows(texts, window))
    # Cut, so that the join below has a shuffle of its own, whose large partitions Spark can split.
    lows = cut(_shared(wins, ["x", "y"]))
    places = wins.join(lows, ["x", "y"]).where("doc_id > low").groupBy("doc_id", "version").agg(F.collect_set("place").alias("places"))
    asked = texts.drop("names").join(places, ["doc_id", "version"], "left").where(F.col("places").isNotNull() | (F.size("lows") > 0))
    cuts = _stripped(asked.select("doc_id", "version", "text", "lows", "highs", empty("places")), window).dropDuplicates(["doc_id", "version"])

    copy = F.coalesce((F.col("doc_id") > F.col("first_id")) & (F.col("n") >= window), F.lit(False))
    out = base.select("doc_id", "sha", "version", "n").join(classes, "sha", "left").join(cuts, ["doc_id", "version"], "left")
    rest = F.when(copy, F.lit("")).otherwise(F.col("rest"))
    removed_ = F.when(copy, F.col("n")).otherwise(F.coalesce("removed", F.lit(0).cast("bigint")))
    digest = F.when(copy | F.col("rest").isNotNull(), F.sha2(rest, 256)).otherwise(F.lower(F.hex("sha")))
    return out.select("doc_id", F.col("n").alias("n_words"), removed_.alias("n_removed"), digest.alias("kept_sha256"), rest.alias("rest"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rest")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS MATERIALIZED (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), low AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, i + o AS p
  FROM (SELECT doc_id, i FROM win JOIN low USING (h) WHERE m < doc_id), (SELECT unnest(range(0, 50)) AS o)
), per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, i AS p, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
rest AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN per ON per.doc_id = d.doc_id LEFT JOIN rest ON rest.doc_id = d.doc_id
"""
