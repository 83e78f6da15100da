"""Token counts by section: whole documents are encoded once, tokens are attributed by their offsets.

A byte-level vocabulary gives each token's length in bytes, so offsets follow from one encoding by
summing lengths; they are then turned into character spans. Sections are the text's lines, each with
its line feed. Token spans are joined to section intervals by binary search, and a token that
reaches over a boundary is allocated by an explicit rule:

* ``first``: to the section in which it begins;
* ``last``: to the section in which it ends;
* ``largest``: to the section that has most of its characters, the earlier one of equals.

Each token is counted once, so the sections' counts add up to the document's. A token that holds
part of a character counts as spanning that character.

The vocabulary is read on the executors from ``path``, which must exist there. No shuffle.

Defined results: null text has no section and no token; empty text has one section and no token; a
null id passes through; repeated rows are counted each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .text import portions

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's makers cut text before merging; fixed by the vocabulary.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "largest")


@cache
def encoder(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding in ``path`` and the length in bytes of each of its tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("given", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end character of each token of ``text``."""
    encoding, lengths = encoder(path)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    size = lengths[np.array(encoding.encode_ordinary(text), dtype=np.int64)]
    end = np.cumsum(size)
    begin = end - size
    leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters begun before each byte
    inside = (raw[begin] & 0xC0) == 0x80
    first = leads[begin] - inside
    return first, np.maximum(leads[end], first + 1)


def section_starts(text: str) -> np.ndarray:
    """First character of each line."""
    at = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32) == 10)
    return np.concatenate([[0], at + 1])


def allocate(first: np.ndarray, past: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens reach over a boundary."""
    low = np.searchsorted(starts, first, side="right") - 1
    high = np.searchsorted(starts, past - 1, side="right") - 1
    crossing = np.flatnonzero(high > low)
    owner = np.where(high > low, high if rule == "last" else low, low)
    if rule == "largest" and crossing.size:
        ends = np.append(starts[1:], np.iinfo(np.int64).max)
        spread = high[crossing] - low[crossing] + 1
        token = np.repeat(crossing, spread)
        section = low[token] + np.arange(token.size) - np.repeat(np.cumsum(spread) - spread, spread)
        overlap = np.minimum(past[token], ends[section]) - np.maximum(first[token], starts[section])
        best = np.lexsort((section, -overlap, token))
        lead = np.concatenate([[True], token[best][1:] != token[best][:-1]])
        owner[token[best][lead]] = section[best][lead]
    return np.bincount(owner, minlength=starts.size), int(crossing.size)


def count_tokens(docs: DataFrame, path: str = VOCABULARY, rule: str = "largest") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_sections, n_crossing, section_tokens."""
    if rule not in RULES:
        raise ValueError(f"the rule is one of {', '.join(RULES)}")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in portions(batches):
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if text is None:
                    out.append((doc_id, 0, 0, 0, np.empty(0, dtype=np.int64)))
                    continue
                counts, crossing = allocate(*token_spans(text, path), section_starts(text), rule)
                out.append((doc_id, int(counts.sum()), counts.size, crossing, counts))
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"]).astype({"doc_id": "Int64"})

    plain = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return plain.mapInPandas(scan, "doc_id bigint, n_tokens bigint, n_sections bigint, n_crossing bigint, section_tokens array<bigint>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
