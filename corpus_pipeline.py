"""The corpus pipeline: quality, exact and near copies, benchmark leaks, packing.

Each stage works on all rows its predecessor kept. The first four return rows of ``documents``
with its columns; the last returns packed pieces. Everything a stage decides takes effect, also
on rows without an id: they get keys by which copies and leaks among them are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlemill.llm.common import keyed, settled, table
from candlemill.llm.decontaminate import drop_leaked
from candlemill.llm.exact_dedup import drop_copies
from candlemill.llm.jaccard_join import drop_near_copies
from candlemill.llm.packing import packed
from candlemill.llm.quality import drop_rejected


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id; a row without an id only where none has one."""
    named, key = keyed(docs, "doc_id", below=True)
    return drop_copies(named, key).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that near copies connect the document with the smallest id.

    Shingles of five words and a Jaccard similarity of 0.8 or more. A row without an id stays
    only where none of its group has one.
    """
    named, key = keyed(docs, "doc_id", below=False)
    return drop_near_copies(named, key, size=5, percent=80).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    named, key = keyed(docs, "doc_id", below=True)
    return drop_leaked(named, table(spark, sf_dir, "benchmark"), key).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in sequences of 2048 tokens."""
    return packed(docs)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# SQL cannot express the nearest-neighbour votes or the packing; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; between stages the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
