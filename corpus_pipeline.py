"""A corpus pipeline: poor documents go, exact and near copies go, sources are mixed to weights, and what is left is packed.

Every stage takes null and empty texts (a null text is empty, but stays null where the row stays), texts of any length, null
and repeated ids, repeated rows, further columns of any name that does not begin with two underscores, and empty tables,
which give empty results. The operators' docstrings say what each case gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronofold.llm.common import materialized
from chronofold.llm.exact_dedup import drop_duplicates
from chronofold.llm.mixing import mixed_documents
from chronofold.llm.near_copies import drop_near_copies
from chronofold.llm.packing import pack_documents
from chronofold.llm.quality import drop_poor
from chronofold.llm.queries import TOKENIZER, documents, fold


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from labelled rows outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~fold("doc_id", 4, 2))
    return drop_poor(docs, docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarities of 0.8 or more over five-word shingles the document with the smallest id stays."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return pack_documents(docs, **TOKENIZER)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# Learned scores, hashes of shingles and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
