"""From raw documents to a training mixture: five stages, each one operator over all that is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mizzen.llm.op2_decontaminate import decontaminate
from mizzen.llm.op5_lines import dedup_lines
from mizzen.llm.op6_mixing import mixture, shuffled_shards
from mizzen.llm.op7_quality import clean
from mizzen.llm.op10_near import drop_near_duplicates
from mizzen.sources.scratch import removed, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, then documents that the rules reject.

    Null and empty texts and texts of under 50 words are rejected; repeated rows and rows with a null id, language or
    source are judged each for itself; an empty table stays empty.
    """
    return clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; a document left without any word goes with them.

    The copy in the least (doc_id, line) stays. Repeated rows don't cut each other, a row with a null id neither cuts
    nor is cut, and a null text goes; an empty table stays empty.
    """
    return dedup_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id.

    Repeated rows become one; texts under one id that aren't near each other all stay, as do rows with a null id or
    without a word; an empty table stays empty.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go.

    Items with a null id count, items without a word don't; repeated rows go or stay together; null texts and ids
    stay; an empty table, of documents or of items, removes nothing.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row with its text for each time a document is taken, in shards, each in shuffled order.

    Null sources are a source; null and empty texts and null ids are taken like any other; repeated rows share out
    what they are given; columns named shard, order, pass or taken make way; an empty table gives an empty mixture.
    """
    docs = docs.drop("shard", "order", "pass", "taken")
    return shuffled_shards(mixture(docs), docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL has no MinHash components or seeded draw; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``; each stage's result is written before the next, its input removed."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        (docs, later), old = stored(stage(spark, docs, sf_dir)), path
        if old:
            removed(spark, old)
        path = later
    return STAGES[-1][1](spark, docs, sf_dir)
