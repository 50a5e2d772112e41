"""A corpus pipeline of four stages: language, near-duplicates, contamination, packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, langid, near_dup, packing
from mercato.session import shared_dir, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one language holds half of the words or more; others, and those without a letter, go.

    Null and empty texts go; repeated rows share their fate; without labelled documents all stay.
    """
    return langid.keep_identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8 or more.

    Texts without words (null, empty) are one group. Of a group, repeated rows included, the
    smallest (doc_id, text hash) stays, null ids last.
    """
    return near_dup.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item.

    Null and empty texts share none and stay; repeated rows share their fate; with no items all stay.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: Trained and hashed stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
