"""The corpus pipeline: quality, toxicity, near-duplicates, contamination, tokens.

Each stage takes what its predecessor kept, written as Parquet and read again. The models of the first two learn from the
labelled rows of the tables; every stage works on whole texts of all the rows it is given. Rows without doc_id pass the stages
that name documents by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from countypanel.llm import byte_bpe, decontaminate, quality, simhash_dedup, toxicity
from countypanel.llm.common import share_package, stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    share_package(spark)
    return quality.keep_good(docs, quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity classifier rejects."""
    share_package(spark)
    return toxicity.keep_civil(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    share_package(spark)
    return simhash_dedup.keep_one(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left: one row per document."""
    import public_tokenizers

    share_package(spark)
    return byte_bpe.encode(docs, public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("simhash_dedup", distinct_documents),
    ("decontaminate", clean_documents),
    ("byte_bpe", encoded_documents),
]

#: The first two stages score with trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
