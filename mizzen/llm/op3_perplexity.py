"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model counts runs of ``ORDER`` UTF-16 code units, by language, over the whole texts of all
trusted documents; three start marks precede a text and one end mark follows it. A run of four
units packs into one 64-bit key, so a run's context and its suffix are a shift and a mask of its key.

Training is a chain of joins of count tables, sharded by (language, key): the highest order has raw
counts, each lower order the number of distinct units before a run; each order has three
discounts from its counts of counts; contexts' totals and back-off weights are joined to the runs,
and each order's probabilities to the next lower ones'.

Scoring needs, for each run of a document, the longest suffix that the model has. While the model has
at most ``BROADCAST_RUNS`` rows, which is counted first, it is sent to the executors and looked up
where the texts are. A larger model stays sharded: each distinct run of the documents is scored once by
joins with it, and one more join gives the scores to the documents' run counts.
Both ways have the same result.

A document is kept if its perplexity is at most the ``quantile`` of the trusted documents'
perplexities in its language, each under a model that did not see it: trusted texts are dealt into two
folds by their hash, so that copies share a fold, and each fold is scored by the model of the other. The
two folds' models and the whole one are counted and trained together, as models of languages whose
names begin with the fold or with ``WHOLE``, and looked up one after another.

Defined results: null or empty text has only the end mark to score; a null language is a language;
in a language without trusted text perplexity and threshold are null and documents are kept; where all
trusted texts of a language fall in one fold, as a single one does, threshold is null and documents are
kept; a null id is scored like any other; repeated rows are scored each; without documents the result is empty; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits
from .text import portions

ORDER = 4
START, END = 0xFFFE, 0xFFFF
#: First letter of a language's name in the model of all its trusted texts; those of its folds have 0 and 1.
WHOLE = "a"
#: Model rows up to which the model is broadcast: 16 bytes each on the executors.
BROADCAST_RUNS = 2_000_000
#: Trusted ids, and languages, up to which their list is broadcast.
BROADCAST_IDS = 1_000_000
#: Distinct runs that a training task holds before it hands them on.
HELD_RUNS = 2_000_000


def runs(text: str | None) -> np.ndarray:
    """The packed run that ends at each unit of ``text`` and at its end mark."""
    units = np.frombuffer((text or "").encode("utf-16-le", "surrogatepass"), dtype=np.uint16)
    padded = np.concatenate([np.full(ORDER - 1, START), units, [END]]).astype(np.uint64)
    key = np.zeros(units.size + 1, dtype=np.uint64)
    for j in range(ORDER):
        key = (key << np.uint64(16)) | padded[j : j + key.size]
    return key


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def run_counts(trusted: DataFrame) -> DataFrame:
    """Rows (lang, g, c): how often each run occurs in the texts of ``trusted`` (lang, text)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in portions(batches):
            for lang, part in batch.groupby("lang"):
                keys, n = np.unique(np.concatenate([runs(t) for t in part["text"]]), return_counts=True)
                held[lang] = _tally([held[lang], (keys, n)]) if lang in held else (keys, n)
            if sum(k.size for k, _ in held.values()) > HELD_RUNS:
                yield from _frames(held)
                held = {}
        yield from _frames(held)

    return trusted.select("lang", "text").mapInPandas(scan, "lang string, g bigint, c bigint").groupBy("lang", "g").agg(F.sum("c").alias("c"))


def _frames(held: dict) -> Iterator[pd.DataFrame]:
    for lang, (keys, n) in held.items():
        yield pd.DataFrame({"lang": lang, "g": keys.view(np.int64), "c": n})


def _context(g: Column) -> Column:
    return F.shiftrightunsigned(g, 16)


def _suffix(g: Column, order: int) -> Column:
    """The last ``order`` units of a run."""
    return g.bitwiseAND(F.lit((1 << 16 * order) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """Rows (lang, d1, d2, d3) from the counts of counts.

    Where the estimate of one of them isn't above 0 and below its count, all are half their count.
    """
    of = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    n = counts.groupBy("lang").agg(*of).withColumn("y", F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")))
    for k in (1, 2, 3):
        n = n.withColumn(f"d{k}", k - (k + 1) * F.col("y") * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")))
    usable = F.coalesce((F.col("d1") > 0) & (F.col("d1") < 1) & (F.col("d2") > 0) & (F.col("d2") < 2) & (F.col("d3") > 0) & (F.col("d3") < 3), F.lit(False))
    return n.select("lang", *[F.when(usable, F.col(f"d{k}")).otherwise(F.lit(k / 2)).alias(f"d{k}") for k in (1, 2, 3)])


def train(counts: DataFrame) -> DataFrame:
    """Rows (lang, n, g, p, b) of the model: probability of a run of n units, back-off weight of a context of n.

    ``counts`` are those of ``run_counts``. The context of no unit has n = 0 and g = 0; its ``p`` is
    that of a unit unknown to the language before back-off, 1 / (units + 1).
    """
    by_order = {ORDER: cut(counts)}
    for n in range(ORDER - 1, 0, -1):
        by_order[n] = cut(by_order[n + 1].groupBy("lang", _suffix(F.col("g"), n).alias("g")).agg(F.count(F.lit(1)).alias("c")))
    lower = by_order[1].groupBy("lang").agg((1 / (F.count(F.lit(1)) + 1)).alias("p")).select("lang", F.lit(0).cast("bigint").alias("g"), "p")
    probs, backs = [lower.select("lang", F.lit(0).alias("n"), "g", "p")], []
    for n in range(1, ORDER + 1):
        rows = by_order[n].join(_small(cut(_discounts(by_order[n]))), "lang")
        rows = rows.withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
        rows = rows.withColumn("h", _context(F.col("g"))).withColumn("s", _suffix(F.col("g"), n - 1) if n > 1 else F.lit(0).cast("bigint"))
        context = rows.groupBy("lang", "h").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("b"))
        mixed = rows.join(context, ["lang", "h"]).join(lower.select("lang", F.col("g").alias("s"), F.col("p").alias("q")), ["lang", "s"])
        lower = cut(mixed.select("lang", "g", ((F.col("c") - F.col("d")) / F.col("total") + F.col("b") * F.col("q")).alias("p")))
        probs.append(lower.select("lang", F.lit(n).alias("n"), "g", "p"))
        backs.append(context.select("lang", F.lit(n - 1).alias("n"), F.col("h").alias("g"), "b"))
    p, b = probs[0], backs[0]
    for more in probs[1:]:
        p = p.unionByName(more)
    for more in backs[1:]:
        b = b.unionByName(more)
    return cut(p.join(b, ["lang", "n", "g"], "full"))


class _Model:
    """The model of each language as sorted arrays, by order."""

    def __init__(self, model: DataFrame):
        def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for (lang, n), part in batch.groupby(["lang", "n"]):
                    yield pd.DataFrame({"lang": [lang], "n": [n], **{c: [part[c].to_numpy().tobytes()] for c in "gpb"}})

        # Arrays, not rows, come to the driver: 24 bytes for each of at most BROADCAST_RUNS rows.
        rows = model.select("lang", "n", "g", F.log("p").alias("p"), F.log("b").alias("b"))
        parts: dict[tuple[str, int], list] = {}
        for r in rows.mapInPandas(packed, "lang string, n int, g binary, p binary, b binary").collect():
            parts.setdefault((r.lang, r.n), []).append((np.frombuffer(r.g, np.int64), np.frombuffer(r.p), np.frombuffer(r.b)))
        self.tables: dict[str, dict] = {}
        for (lang, n), found in parts.items():
            g, p, b = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(g)
            self.tables.setdefault(lang, {})[n] = (g[order], p[order], b[order])

    def logs(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """The log probability of each run."""
        signed, tables = keys.view(np.int64), self.tables[lang]
        out, open_ = np.zeros(keys.size), np.ones(keys.size, dtype=bool)
        for n in range(ORDER, 0, -1):
            own = signed if n == ORDER else signed & np.int64((1 << 16 * n) - 1)
            value, found = self._at(tables, n, own, 1)
            here = open_ & found
            out[here] += value[here]
            open_ &= ~found
            weight, known = self._at(tables, n - 1, (own.view(np.uint64) >> np.uint64(16)).view(np.int64), 2)
            out[open_ & known] += weight[open_ & known]
        out[open_] += tables[0][1][0]
        return out

    @staticmethod
    def _at(tables: dict, n: int, keys: np.ndarray, what: int) -> tuple[np.ndarray, np.ndarray]:
        if n not in tables:
            return np.zeros(keys.size), np.zeros(keys.size, dtype=bool)
        own = tables[n][0]
        at = np.minimum(np.searchsorted(own, keys), own.size - 1)
        value = tables[n][what][at]
        return value, (own[at] == keys) & ~np.isnan(value)


def _score_local(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Perplexities looked up in a model that every executor holds for as long as this takes."""
    if model.isEmpty():
        return docs.select("doc_id", "lang", "trusted", F.lit(None).cast("double").alias("perplexity"))
    shared = docs.sparkSession.sparkContext.broadcast(_Model(model))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in portions(batches):
            value = np.full(len(batch), np.nan)
            langs = batch["lang"].to_numpy()
            for lang in set(langs) & set(model.tables):
                rows = np.flatnonzero(langs == lang)
                each = [runs(t) for t in batch["text"].iloc[rows]]
                size = np.array([x.size for x in each])
                keys, where = np.unique(np.concatenate(each), return_inverse=True)
                logs = model.logs(lang, keys)[where]
                value[rows] = np.exp(-np.add.reduceat(logs, np.cumsum(size) - size) / size)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang": batch["lang"], "trusted": batch["trusted"], "perplexity": pd.array([None if np.isnan(x) else x for x in value], dtype="Float64")})

    out = cut(docs.select("doc_id", "lang", "trusted", "text").mapInPandas(scan, "doc_id bigint, lang string, trusted boolean, perplexity double"))
    shared.destroy()
    return out


def _small(df: DataFrame) -> DataFrame:
    """A table of a row or so a language, to be broadcast if it is proven small."""
    return F.broadcast(df) if fits(df, BROADCAST_IDS) else df


def _score_sharded(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Perplexities by joins with a model of any size.

    Each distinct run of the documents is scored once, by joins of the tables of runs; one more join gives
    the scores to the documents' counts of runs.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            for row, lang, text in zip(batch["row"], batch["lang"], batch["text"]):
                keys, n = np.unique(runs(text), return_counts=True)
                yield pd.DataFrame({"row": row, "lang": lang, "g": keys.view(np.int64), "n": n})

    plain = docs.withColumn("row", F.monotonically_increasing_id())
    plain = cut(plain.select("row", "doc_id", "lang", "trusted", "text"))
    counts = plain.select("row", "lang", "text").mapInPandas(scan, "row bigint, lang string, g bigint, n bigint")
    found = cut(counts.select("lang", "g").distinct())
    score = F.lit(None).cast("double")
    unknown = F.lit(0.0)
    for n in range(ORDER, 0, -1):
        own = _suffix(F.col("g"), n) if n < ORDER else F.col("g")
        p = model.where(F.col("n") == n).where("p IS NOT NULL").select("lang", F.col("g").alias("key"), F.log("p").alias(f"p{n}"))
        b = model.where((F.col("n") == n - 1) & F.col("b").isNotNull()).select("lang", F.col("g").alias("key"), F.log("b").alias(f"b{n}"))
        found = found.withColumn("key", own).join(p, ["lang", "key"], "left")
        found = found.withColumn("key", _context(own)).join(b, ["lang", "key"], "left").drop("key")
        score = F.coalesce(score, unknown + F.col(f"p{n}"))
        unknown = unknown + F.coalesce(F.col(f"b{n}"), F.lit(0.0))
    base = model.where("n = 0").select("lang", F.log("p").alias("p0"))
    scores = cut(found.join(_small(base), "lang").select("lang", "g", F.coalesce(score, unknown + F.col("p0")).alias("score")))
    sums = counts.join(scores, ["lang", "g"]).groupBy("row").agg(F.exp(-F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("perplexity"))
    return plain.drop("text").join(sums, "row", "left").drop("row")


def _folded(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(2)).cast("int")


def exact_quantile(rows: DataFrame, by: str, value: str, quantile: float) -> DataFrame:
    """Rows (by, value): of each ``by``, the least positive value that a share of at least ``quantile`` doesn't exceed.

    Distinct values are counted, then counted by slices of a thousandth of an octave, which are few; the
    slice that holds the wanted place is opened, and only its values are put in order.
    """
    tally = cut(rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("n")).withColumn("slice", F.floor(F.log2(value) * 1000)))
    upto = lambda key: Window.partitionBy(by).orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = tally.groupBy(by, "slice").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(upto("slice")))
    slices = slices.withColumn("wanted", F.ceil(F.sum("n").over(Window.partitionBy(by)) * quantile))
    opened = slices.where("upto >= wanted AND upto - n < wanted").select(by, "slice", (F.col("wanted") - F.col("upto") + F.col("n")).alias("wanted"))
    inside = tally.join(opened, [by, "slice"]).withColumn("upto", F.sum("n").over(upto(value)))
    return inside.where("upto >= wanted AND upto - n < wanted").select(by, value)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, broadcast_runs: int = BROADCAST_RUNS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text): doc_id, lang, perplexity, threshold, kept.

    Trusted are the documents that ``labels`` (doc_id, quality, toxic) calls good and not toxic.
    """
    good = cut(labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("good_id")).distinct())
    plain = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("lang", F.lit("")).alias("lang"), "text")
    marked = plain.join(_small(good), F.col("doc_id") == F.col("good_id"), "left").withColumn("trusted", F.col("good_id").isNotNull()).drop("good_id")
    fold = _folded(F.col("text"))
    halves = cut(run_counts(marked.where("trusted").withColumn("lang", F.concat(fold.cast("string"), "lang"))))
    whole = halves.groupBy(F.concat(F.lit(WHOLE), F.substring("lang", 2, 1 << 30)).alias("lang"), "g").agg(F.sum("c").alias("c"))
    model = train(halves.unionByName(whole))
    local = fits(model, broadcast_runs)
    scored = None
    for by in ("0", "1", WHOLE):  # one after another, so that the driver holds one model at a time
        asked = marked if by == WHOLE else marked.where(F.col("trusted") & (fold == 1 - int(by)))
        asked, own = asked.withColumn("lang", F.concat(F.lit(by), "lang")), model.where(F.col("lang").startswith(by))
        part = (_score_local(asked, own) if local else cut(_score_sharded(asked, own))).withColumn("by", F.lit(by))
        scored = part if scored is None else scored.unionByName(part)
    scored = scored.select("doc_id", "by", F.substring("lang", 2, 1 << 30).alias("lang"), "perplexity")
    unseen = scored.where(F.col("by") != WHOLE)
    limits = cut(exact_quantile(unseen.where("perplexity IS NOT NULL"), "lang", "perplexity", quantile).withColumnRenamed("perplexity", "threshold"))
    out = scored.where(F.col("by") == WHOLE).join(_small(limits), "lang", "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", "lang", "perplexity", "threshold", kept.alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
