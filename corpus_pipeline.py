"""The corpus pipeline: documents of good quality and a known language, one of each group
of near copies, packed into sequences of tokens.

Every stage takes all rows that its predecessor kept. The first three return the columns of
``documents``; the last returns the pieces with their sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablecheck.llm import jaccard, language, packing, quality
from tablecheck.llm.common import read, ship, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects: a score below 0.3."""
    ship(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"), threshold=0.3)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language is not accepted."""
    ship(spark)
    return language.keep_known(docs, least=0.5)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document by id of each group of near copies: five words, 0.8 or more."""
    ship(spark)
    return jaccard.keep_one(docs, size=5, threshold=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed into sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_copies", near_copies_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what its predecessor has written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
