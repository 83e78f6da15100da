"""Shared text definitions: what a word is, how shingles are hashed, how batches of texts are cut.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed
and carriage return. ``bytes.split()`` splits on exactly these six, so the Python side and the
DataFrame side agree on every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\u000b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use in ``body``; inlined into a lambda it would be evaluated per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Array of the words of ``text``; null text has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * 5)
    return F.array_remove(F.split(flat, " "), "")


def shingle_hashes(tokens: Column, size: int) -> Column:
    """Array of 64-bit hashes of the runs of ``size`` words, by start; a shorter, non-empty text is one run."""

    def runs(w: Column) -> Column:
        last = F.size(w) - F.lit(size)
        each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + F.lit(j)) for j in range(size)]))
        return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<bigint>"))

    return let(tokens, runs)


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word of ``text``, in order."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in (raw.lower() if lower else raw).split()], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, elementwise: spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While it lasts, jobs hand at most ``rows`` rows at a time to a Python worker; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def portions(batches: Iterator[pd.DataFrame], chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Arrow batches cut so that the texts of each portion have about ``chars`` characters, or are one text.

    Bounds what a Python worker builds from a batch at a time; Spark bounds the batch itself in bytes.
    """
    for batch in batches:
        size = batch["text"].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
        group = np.cumsum(size) // chars
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(batch)]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                yield batch.iloc[low:high].reset_index(drop=True)
