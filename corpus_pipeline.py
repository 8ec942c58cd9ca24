"""A document pipeline: quality classifier, language identification, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read
back as the ``docs`` of the next one.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duebook.llm.common import staged
from duebook.llm.langid import keep_identified
from duebook.llm.minhash import keep_first
from duebook.llm.packing import length_buckets
from duebook.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out the documents that the quality classifier rejects."""
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without an identified language; ``lang`` is the language found."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near-duplicates (five words, 0.8)."""
    return keep_first(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all kept documents in token-budget batches of optimal length buckets."""
    return length_buckets(docs)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("packing", packing)]

#: Fitted models stand behind two stages, so SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = staged(docs)
    return docs
