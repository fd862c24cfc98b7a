"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage works on all rows that the one before kept. The stages but the last return rows
with the columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import common as C
from tidewater.llm import decontaminate, jaccard, packing, pii, quality, queries


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.keep_good(docs, C.table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates."""
    return jaccard.distinct(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth is benchmark text."""
    return decontaminate.clean(docs, C.table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by the names of its kinds."""
    return pii.clean(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(packing.pieces(docs, **queries.tokenizer()))


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("personal data", masked),
    ("best-fit packing", packed),
]

#: A learned classifier and a tokenizer are beyond SQL; tests compare the stages with
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = C.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = C.stored(docs)
    return docs
